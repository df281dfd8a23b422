"""The whole report: load, clean, answer the five questions, write the results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlark.operators.clean import audit_seen, clean_with_audit
from ledgerlark.operators.ordered import ordered_values
from ledgerlark.operators.settle import settle
from ledgerlark.plans import charts, customers as q5, markets, months, orders as q4, products as q3
from ledgerlark.sources import load_raw, write_chart_frames, write_summaries

LINE_COLUMNS = ("InvoiceNo", "Description", "InvoiceDate", "CustomerID", "Country", "Revenue")


def staged(lines: DataFrame) -> DataFrame:
    """Cleaned lines as a Parquet table in the shared folder.

    The source is parsed and cleaned once; each grain then reads only its own columns.
    """
    return settle(lines.select(*LINE_COLUMNS))


def summaries(grains: dict[str, DataFrame]) -> dict[str, tuple[DataFrame, list[str]]]:
    """The five summary tables, named as the files they are written to, with their order."""
    top = q5.customer_value(grains["customers"])
    return {
        "q1_country_revenue": (grains["countries"], ["-Revenue", "Country"]),
        "q2_monthly_revenue": (grains["months"].select("YearMonth", "Revenue"), ["YearMonth"]),
        "q3_top_products": (q3.top_products(grains["products"]), ["-Revenue", "Description"]),
        "q4_large_order_impact": (q4.large_order_impact(grains["invoices"]), ["Threshold"]),
        # Written as the number type the source files hold customers in.
        "q5_top_customers": (
            top.withColumn("CustomerID", F.col("CustomerID").cast("double")),
            ["-TotalRevenue", "CustomerID"],
        ),
    }


def chart_frames(lines: DataFrame, grains: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The frame behind each of the thirteen charts."""
    products, invoices, customers = grains["products"], grains["invoices"], grains["customers"]
    order_values = ordered_values(invoices, "OrderValue")
    return {
        "q1_uk_vs_others": charts.donut(markets.uk_vs_others(lines)),
        "q1_country_revenue": charts.country_bars(grains["countries"]),
        "q2_monthly_revenue": grains["months"],
        "q2_monthly_revenue_bar": grains["months"],
        "q3_pareto": charts.pareto_plot(products),
        "q3_top_products": charts.top_product_bars(q3.top_products(products)),
        "q3_product_segments": charts.product_segments(products),
        "q4_order_value_histogram": charts.histogram(invoices, "OrderValue", values=order_values),
        "q4_order_value_boxplot": charts.box_plot(invoices, "OrderValue", order_values),
        "q5_top_customers": charts.top_customer_bars(q5.customer_value(customers)),
        "q5_customer_segments": charts.customer_segments(customers),
        "q5_customer_revenue_hist": charts.histogram(customers, "TotalRevenue"),
        "q5_vip_seasonal": q5.vip_season(grains["visits"], customers),
    }


def grains_of(lines: DataFrame) -> dict[str, DataFrame]:
    """One settled frame per grain; everything after this reads these."""
    visits = q5.visits_of(lines)
    return {
        "countries": settle(markets.country_revenue(lines)),
        "months": settle(months.monthly_revenue_with_partial_flag(lines)),
        "products": q3.products_of(lines),
        "invoices": q4.invoices_of(lines),
        "visits": visits,
        "customers": q5.customers_of(visits),
    }


def run_report(
    spark: SparkSession, data: str, output: str, file_format: str | None = None, multi_line: bool = False
) -> None:
    """Read sales lines from ``data`` and write summaries, chart data and the cleaning audit to ``output``.

    The audit is counted while the cleaned lines are staged.
    """
    cleaned, seen = clean_with_audit(load_raw(spark, data, None, file_format, multi_line))
    lines = staged(cleaned)
    write_summaries({"cleaning_audit": (audit_seen(spark, seen), ["Step"])}, f"{output}/audit")
    grains = grains_of(lines)
    write_summaries(summaries(grains), f"{output}/summaries")
    write_chart_frames(chart_frames(lines, grains), f"{output}/charts")

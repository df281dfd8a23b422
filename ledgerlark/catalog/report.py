"""Registered queries over what a run of the report writes: all tables, read back whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, StringType

from ledgerlark.catalog import sales
from ledgerlark.operators.clean import clean
from ledgerlark.operators.settle import scratch_path
from ledgerlark.plans import orders as q4, report
from ledgerlark.sources import CSV_OPTIONS, read_set, sales_lines, write_chart_frames, write_summaries

# Name and key of each table, with the SQL of its rows and the kind of each column.
_MONTHS = ("YearMonth", "chart_monthly_line", {"YearMonth": "text", "Revenue": "number", "is_partial": "flag"})
_HISTOGRAM = dict.fromkeys(("Bin", "BinStart", "BinEnd", "n"), "number")
_SEGMENT = {"Segment": "text", "is_top": "flag", "Label": "text"}
CHARTS = {
    "q1_uk_vs_others": (
        "Label", "chart_uk_donut", {"Label": "text", "Revenue": "number", "Share_pct": "number"},
    ),
    "q1_country_revenue": (
        "Country", "chart_country_bars",
        {"Country": "text", "Revenue": "number", "RevenueShare_pct": "number", "place": "number"},
    ),
    "q2_monthly_revenue": _MONTHS,
    "q2_monthly_revenue_bar": _MONTHS,
    "q3_pareto": (
        "Description", "chart_pareto",
        {"Description": "text", "Revenue": "number", "cumulative_pct": "number", "product_rank": "number"},
    ),
    "q3_top_products": (
        "Description", "chart_top_products",
        {"Description": "text", "Revenue": "number", "Label": "text", "place": "number"},
    ),
    "q3_product_segments": (
        "Description", "chart_product_segments",
        {"Description": "text", "Revenue": "number", "Frequency": "number"} | _SEGMENT,
    ),
    "q4_order_value_histogram": ("Bin", "chart_order_histogram", _HISTOGRAM),
    "q4_order_value_boxplot": (
        None, "chart_order_box_plot",
        dict.fromkeys(("Q1", "Median", "Q3", "WhiskerLow", "WhiskerHigh", "Outliers"), "number"),
    ),
    "q5_top_customers": (
        "Customer", "chart_top_customers",
        {"Customer": "text", "TotalRevenue": "number", "Label": "text", "place": "number"},
    ),
    "q5_customer_segments": (
        "CustomerID", "chart_customer_segments",
        {"CustomerID": "number", "TotalRevenue": "number", "OrderCount": "number"} | _SEGMENT,
    ),
    "q5_customer_revenue_hist": ("Bin", "chart_customer_histogram", _HISTOGRAM),
    "q5_vip_seasonal": (
        "YearMonth", "vip_season",
        {"YearMonth": "text", "vip_norm": "number", "non_vip_norm": "number", "VIPs": "number"},
    ),
}


def _long(name: str, table: DataFrame, row: Column) -> DataFrame:
    """One typed row per value of a table: (table_name, row_key, field, text, number, flag)."""

    def value(column: str, kind: type, to: str) -> Column:
        right = isinstance(table.schema[column].dataType, kind)
        return F.col(column) if right else F.lit(None).cast(to)

    fields = []
    for c in table.columns:
        typed = isinstance(table.schema[c].dataType, (StringType, BooleanType))
        number = F.lit(None).cast("double") if typed else F.round(F.col(c).cast("double"), 6)
        fields.append(F.struct(
            F.lit(c).alias("field"), value(c, StringType, "string").alias("text"),
            number.alias("number"), value(c, BooleanType, "boolean").alias("flag"),
        ))
    # The key comes first: it may count rows, and those are no longer there once exploded.
    return table.withColumn("row_key", row.cast("string")).select(
        F.lit(name).alias("table_name"), "row_key", F.explode(F.array(*fields)).alias("v")
    ).select("table_name", "row_key", "v.*")


def _all(frames: list[DataFrame]) -> DataFrame:
    first, *others = frames
    for frame in others:
        first = first.unionByName(frame)
    return first


def summary_tables_as_csv(spark, sf_dir):
    """The five summary tables of a run, written as CSV and read back; rows by their place in the file."""
    folder = f"{scratch_path(spark)}/summaries"
    lines = report.staged(clean(sales_lines(spark, sf_dir)))
    write_summaries(report.summaries(report.grains_of(lines)), folder)
    # Each table is one small file, read by one task from its first row on.
    place = F.monotonically_increasing_id() + 1
    read = read_set(spark, folder, **CSV_OPTIONS)
    return _all([_long(name, table, place) for name, table in read.items()])


def chart_frames_as_parquet(spark, sf_dir):
    """The thirteen chart frames of a run, written as Parquet and read back; rows by their key."""
    folder = f"{scratch_path(spark)}/charts"
    lines = report.staged(clean(sales_lines(spark, sf_dir)))
    write_chart_frames(report.chart_frames(lines, report.grains_of(lines)), folder)
    read = read_set(spark, folder)
    return _all([
        _long(name, table, F.col(CHARTS[name][0]) if CHARTS[name][0] else F.lit("")) for name, table in read.items()
    ])


QUERIES = {f.__name__: f for f in (summary_tables_as_csv, chart_frames_as_parquet)}


# --- the same in SQL ----------------------------------------------------------------


def _long_sql(name: str, row: str, columns: dict[str, str], body: str) -> str:
    def value(column: str, kind: str) -> str:
        parts = {"text": "NULL::VARCHAR", "number": "NULL::DOUBLE", "flag": "NULL::BOOLEAN"}
        parts[kind] = f"round(CAST({column} AS DOUBLE), 6)" if kind == "number" else column
        return f"{{'field': '{column}', " + ", ".join(f"'{k}': {v}" for k, v in parts.items()) + "}"

    values = ", ".join(value(c, kind) for c, kind in columns.items())
    return f"""SELECT '{name}' AS table_name, {row} AS row_key, unnest([{values}], recursive := true)
FROM ({body}) t_{name}"""


def _summary_sql() -> str:
    tables = {
        "q1_country_revenue": (
            "Revenue DESC, Country", {"Country": "text", "Revenue": "number", "RevenueShare_pct": "number"},
            sales.ORACLE["country_revenue"],
        ),
        "q2_monthly_revenue": (
            "YearMonth", {"YearMonth": "text", "Revenue": "number"}, sales.ORACLE["monthly_revenue"],
        ),
        "q3_top_products": (
            "Revenue DESC, Description", {"Description": "text", "Revenue": "number", "FrequencyRank": "number"},
            sales.ORACLE["top_products"],
        ),
        "q4_large_order_impact": (
            "Threshold",
            dict.fromkeys(("Threshold", "OrderCount", "OrderPct", "Revenue", "RevenuePct"), "number"),
            sales.impact_sql(q4.ORDER_THRESHOLDS),
        ),
        "q5_top_customers": (
            "TotalRevenue DESC, CustomerID",
            dict.fromkeys(("CustomerID", "TotalRevenue", "OrderCount", "AvgOrderValue"), "number"),
            sales.ORACLE["top_customers"],
        ),
    }
    return "\nUNION ALL\n".join(
        _long_sql(name, f"CAST(row_number() OVER (ORDER BY {order}) AS VARCHAR)", columns, body)
        for name, (order, columns, body) in tables.items()
    )


ORACLE = {
    "summary_tables_as_csv": _summary_sql(),
    "chart_frames_as_parquet": "\nUNION ALL\n".join(
        _long_sql(name, f"CAST({key} AS VARCHAR)" if key else "''", columns, sales.ORACLE[body])
        for name, (key, body, columns) in CHARTS.items()
    ),
}

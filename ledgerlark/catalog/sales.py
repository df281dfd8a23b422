"""Registered queries of the sales report: cleaning, questions 1 to 5, chart data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlark.catalog.sql import money, query
from ledgerlark.functions import exact_sum
from ledgerlark.operators import clean as rules
from ledgerlark.plans import charts, customers as q5, markets, months, orders as q4, products as q3
from ledgerlark.operators.grain import customer_grain, visit_grain
from ledgerlark.operators.settle import settle
from ledgerlark.plans.report import staged
from ledgerlark.sources import sales_lines

# The order sizes of the tables at hand; the report's own sizes are the default.
THRESHOLDS = (200, 500, 1_000, 1_500)


def _raw(spark, sf_dir) -> DataFrame:
    return sales_lines(spark, sf_dir)


def _clean(spark, sf_dir) -> DataFrame:
    return rules.clean(_raw(spark, sf_dir))


def _products(spark, sf_dir) -> DataFrame:
    return q3.products_of(_clean(spark, sf_dir))


def _invoices(spark, sf_dir) -> DataFrame:
    return q4.invoices_of(_clean(spark, sf_dir))


def _customers(spark, sf_dir) -> DataFrame:
    return q5.customers_of(visit_grain(_clean(spark, sf_dir)))


def _rounded(frame: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return frame.withColumns({c: F.round(c, digits) for c in columns})


# --- cleaning -----------------------------------------------------------------------


def sales_lines_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir)


def country_names(spark, sf_dir):
    return (
        rules.normalise_countries(_raw(spark, sf_dir))
        .groupBy("Country")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def lines_in_real_countries(spark, sf_dir):
    lines = rules.normalise_countries(_raw(spark, sf_dir))
    return rules.remove_non_countries(lines).select("InvoiceNo", "StockCode", "Country")


def lines_with_positive_quantity(spark, sf_dir):
    lines = rules.remove_non_positive_quantity(_raw(spark, sf_dir))
    return lines.select("InvoiceNo", "StockCode", "Quantity")


def lines_with_positive_price(spark, sf_dir):
    lines = rules.remove_non_positive_price(_raw(spark, sf_dir))
    return lines.select("InvoiceNo", "StockCode", "UnitPrice")


def lines_on_sales_invoices(spark, sf_dir):
    lines = rules.remove_non_sales_invoices(_raw(spark, sf_dir))
    return lines.select("InvoiceNo", "StockCode")


def lines_with_revenue(spark, sf_dir):
    lines = rules.add_revenue(_raw(spark, sf_dir))
    return lines.select("InvoiceNo", "StockCode", "Quantity", "UnitPrice", "Revenue")


def cleaned_lines(spark, sf_dir):
    return _clean(spark, sf_dir)


def lines_of_known_customers(spark, sf_dir):
    lines = rules.with_customer(_clean(spark, sf_dir))
    return lines.select("InvoiceNo", "StockCode", "CustomerID", "Revenue")


def lines_of_products(spark, sf_dir):
    lines = rules.remove_non_products(_clean(spark, sf_dir))
    return lines.select("InvoiceNo", "Description", "Revenue")


def cleaning_audit(spark, sf_dir):
    return rules.cleaning_audit(_raw(spark, sf_dir))


def cleaning_audit_of_the_report(spark, sf_dir):
    """The audit that a run of the report takes while it stages the cleaned lines."""
    cleaned, seen = rules.clean_with_audit(_raw(spark, sf_dir))
    staged(cleaned)
    return rules.audit_seen(spark, seen)


# --- question 1 ---------------------------------------------------------------------


def uk_vs_others(spark, sf_dir):
    return markets.uk_vs_others(_clean(spark, sf_dir))


def country_revenue(spark, sf_dir):
    return markets.country_revenue(_clean(spark, sf_dir))


def country_revenue_in_place(spark, sf_dir):
    return markets.countries_in_place(_clean(spark, sf_dir))


# --- question 2 ---------------------------------------------------------------------


def monthly_revenue(spark, sf_dir):
    return months.monthly_revenue(_clean(spark, sf_dir))


def monthly_revenue_growth(spark, sf_dir):
    grown = months.month_over_month(months.monthly_revenue(_clean(spark, sf_dir)))
    return _rounded(grown, "GrowthRate")


def headline_growth(spark, sf_dir):
    monthly = months.monthly_revenue(_clean(spark, sf_dir))
    return _rounded(months.growth_between(monthly, "1995-01", "2001-07"), "GrowthRate")


# --- question 3 ---------------------------------------------------------------------


def top_products(spark, sf_dir):
    return q3.top_products(_products(spark, sf_dir))


def product_frequency_ranks(spark, sf_dir):
    return q3.frequency_ranks(_products(spark, sf_dir))


def product_pareto(spark, sf_dir):
    return _rounded(q3.pareto(_products(spark, sf_dir)), "cumulative_pct")


def product_pareto_curve(spark, sf_dir):
    return _rounded(q3.pareto_curve(_products(spark, sf_dir)), "cumulative_pct", "product_pct")


def product_pareto_summary(spark, sf_dir):
    return _rounded(
        q3.pareto_summary(_products(spark, sf_dir)), "TopFifthShare_pct", "ProductsFor80_pct"
    )


def product_pareto_summary_wide(spark, sf_dir):
    """The profiling variant of the summary, which draws a little less of the curve."""
    return _rounded(
        q3.pareto_summary(_products(spark, sf_dir), plot_margin=1.15),
        "TopFifthShare_pct",
        "ProductsFor80_pct",
    )


def top_fifth_of_products(spark, sf_dir):
    return q3.top_fifth(_products(spark, sf_dir)).select("Description", "Revenue", "product_rank")


def product_scatter(spark, sf_dir):
    return q3.product_scatter(_products(spark, sf_dir))


# --- question 4 ---------------------------------------------------------------------


def order_values(spark, sf_dir):
    return q4.order_values(_invoices(spark, sf_dir))


def largest_orders(spark, sf_dir):
    return q4.largest_orders(q4.invoice_grain(_clean(spark, sf_dir)))


def large_order_impact(spark, sf_dir):
    return q4.large_order_impact(q4.invoice_grain(_clean(spark, sf_dir)), THRESHOLDS)


def order_value_percentiles(spark, sf_dir):
    return _rounded(q4.order_value_ladder(q4.invoice_grain(_clean(spark, sf_dir))), "OrderValue")


# --- question 5 ---------------------------------------------------------------------


def top_customers(spark, sf_dir):
    return q5.customer_value(customer_grain(visit_grain(_clean(spark, sf_dir))))


def customer_value_by_join(spark, sf_dir):
    """Revenue and order counts as two group-bys on one key, joined on it."""
    lines = rules.with_customer(_clean(spark, sf_dir))
    revenue = lines.groupBy("CustomerID").agg(exact_sum("Revenue").alias("TotalRevenue"))
    orders = (
        lines.select("CustomerID", "InvoiceNo")
        .distinct()
        .groupBy("CustomerID")
        .agg(F.count("InvoiceNo").alias("OrderCount"))
    )
    return revenue.join(orders, "CustomerID").withColumn(
        "AvgOrderValue", F.try_divide("TotalRevenue", "OrderCount")
    )


def customer_profile(spark, sf_dir):
    return customer_grain(visit_grain(_clean(spark, sf_dir)))


def vip_customers(spark, sf_dir):
    return q5.vip_ids(_customers(spark, sf_dir))


def customer_pareto(spark, sf_dir):
    return q5.customer_pareto(_customers(spark, sf_dir))


def _lines_and_vips(spark, sf_dir):
    """Cleaned lines, derived once, and the customers who are VIPs."""
    columns = ("InvoiceNo", "StockCode", "InvoiceDate", "CustomerID", "Revenue")
    lines = settle(_clean(spark, sf_dir).select(*columns))
    return lines, q5.vip_ids(q5.customers_of(visit_grain(lines)))


def vip_lines(spark, sf_dir):
    lines, vips = _lines_and_vips(spark, sf_dir)
    return q5.lines_of_vips(lines, vips).select("CustomerID", "InvoiceNo", "StockCode", "Revenue")


def non_vip_lines(spark, sf_dir):
    lines, vips = _lines_and_vips(spark, sf_dir)
    return q5.lines_of_others(lines, vips).select("CustomerID", "InvoiceNo", "StockCode", "Revenue")


def vip_monthly_revenue(spark, sf_dir):
    visits = q5.visits_of(_clean(spark, sf_dir))
    return q5.vip_months(visits, q5.flag_vip(q5.customers_of(visits)))


def vip_season(spark, sf_dir):
    visits = q5.visits_of(_clean(spark, sf_dir))
    season = q5.vip_season(visits, q5.customers_of(visits))
    return _rounded(season, "vip_norm", "non_vip_norm")


def vip_season_against_everyone(spark, sf_dir):
    visits = q5.visits_of(_clean(spark, sf_dir))
    season = q5.vip_season(visits, q5.customers_of(visits), against="everyone")
    return _rounded(season, "vip_norm", "everyone_norm")


# --- chart data ---------------------------------------------------------------------


def chart_uk_donut(spark, sf_dir):
    return charts.donut(markets.uk_vs_others(_clean(spark, sf_dir)))


def chart_country_bars(spark, sf_dir):
    return charts.country_bars(settle(markets.country_revenue(_clean(spark, sf_dir))))


def chart_monthly_line(spark, sf_dir):
    return months.monthly_revenue_with_partial_flag(_clean(spark, sf_dir))


def chart_pareto(spark, sf_dir):
    return _rounded(charts.pareto_plot(_products(spark, sf_dir)), "cumulative_pct")


def chart_top_products(spark, sf_dir):
    return charts.top_product_bars(q3.top_products(_products(spark, sf_dir)))


def chart_top_customers(spark, sf_dir):
    return charts.top_customer_bars(q5.customer_value(customer_grain(visit_grain(_clean(spark, sf_dir)))))


def chart_product_segments(spark, sf_dir):
    return charts.product_segments(_products(spark, sf_dir))


def chart_leading_products(spark, sf_dir):
    return charts.leading_products(_products(spark, sf_dir))


def chart_customer_segments(spark, sf_dir):
    return charts.customer_segments(_customers(spark, sf_dir))


def chart_order_histogram(spark, sf_dir):
    bins = charts.histogram(_invoices(spark, sf_dir), "OrderValue")
    return _rounded(bins, "BinStart", "BinEnd")


def chart_order_histogram_marks(spark, sf_dir):
    marks = charts.histogram_marks(_invoices(spark, sf_dir), "OrderValue")
    return _rounded(marks, "P99", "Median", "Mean", digits=4)


def chart_customer_histogram(spark, sf_dir):
    bins = charts.histogram(_customers(spark, sf_dir), "TotalRevenue")
    return _rounded(bins, "BinStart", "BinEnd")


def chart_customer_histogram_marks(spark, sf_dir):
    marks = charts.histogram_marks(_customers(spark, sf_dir), "TotalRevenue")
    return _rounded(marks, "P99", "Median", "Mean", digits=4)


def chart_order_box_plot(spark, sf_dir):
    return _rounded(
        charts.box_plot(_invoices(spark, sf_dir), "OrderValue"), "Q1", "Median", "Q3", digits=4
    )


def chart_order_box_plot_outliers(spark, sf_dir):
    return charts.box_plot_outliers(_invoices(spark, sf_dir), "InvoiceNo", "OrderValue")


QUERIES = {
    f.__name__: f
    for f in (
        sales_lines_raw,
        country_names,
        lines_in_real_countries,
        lines_with_positive_quantity,
        lines_with_positive_price,
        lines_on_sales_invoices,
        lines_with_revenue,
        cleaned_lines,
        lines_of_known_customers,
        lines_of_products,
        cleaning_audit,
        cleaning_audit_of_the_report,
        uk_vs_others,
        country_revenue,
        country_revenue_in_place,
        monthly_revenue,
        monthly_revenue_growth,
        headline_growth,
        top_products,
        product_frequency_ranks,
        product_pareto,
        product_pareto_curve,
        product_pareto_summary,
        product_pareto_summary_wide,
        top_fifth_of_products,
        product_scatter,
        order_values,
        largest_orders,
        large_order_impact,
        order_value_percentiles,
        top_customers,
        customer_value_by_join,
        customer_profile,
        vip_customers,
        customer_pareto,
        vip_lines,
        non_vip_lines,
        vip_monthly_revenue,
        vip_season,
        vip_season_against_everyone,
        chart_uk_donut,
        chart_country_bars,
        chart_monthly_line,
        chart_pareto,
        chart_top_products,
        chart_top_customers,
        chart_product_segments,
        chart_leading_products,
        chart_customer_segments,
        chart_order_histogram,
        chart_order_histogram_marks,
        chart_customer_histogram,
        chart_customer_histogram_marks,
        chart_order_box_plot,
        chart_order_box_plot_outliers,
    )
}


# --- the same in SQL ----------------------------------------------------------------


def impact_sql(thresholds) -> str:
    rows = [
        f"""SELECT {t} AS Threshold, count(*) FILTER (WHERE OrderValue > {t}) AS OrderCount,
       round_even(CAST(count(*) FILTER (WHERE OrderValue > {t}) AS DOUBLE) / count(*) * 100, 2) AS OrderPct,
       coalesce({money(f"CASE WHEN OrderValue > {t} THEN OrderValue END")}, 0) AS Revenue,
       round_even(coalesce({money(f"CASE WHEN OrderValue > {t} THEN OrderValue END")}, 0)
             / {money("OrderValue")} * 100, 2) AS RevenuePct FROM invoices"""
        for t in thresholds
    ]
    return query(" UNION ALL ".join(rows), "invoices")


def _audit_sql() -> str:
    failed = """SELECT s.Country AS RawCountry, n.Country,
  CASE WHEN n.Country IN ('Unspecified', 'European Community') THEN 0
       WHEN s.Quantity IS NULL OR s.Quantity <= 0 THEN 1
       WHEN s.UnitPrice IS NULL OR s.UnitPrice <= 0 THEN 2
       WHEN regexp_matches(s.InvoiceNo, '^[A-BD-Za-bd-z]') THEN 3 ELSE 4 END AS f
  FROM sales s, (SELECT CASE s2 WHEN 'EIRE' THEN 'Ireland' WHEN 'RSA' THEN 'South Africa' ELSE s2 END AS Country,
                        s2 FROM (SELECT DISTINCT Country AS s2 FROM sales)) n
  WHERE s.Country IS NOT DISTINCT FROM n.s2"""
    names = ("real country", "positive quantity", "positive price", "sales invoice")
    rows = [
        f"""SELECT {i + 1} AS Step, '{name}' AS Rule, count(*) FILTER (WHERE f >= {i}) AS RowsBefore,
       count(*) FILTER (WHERE f = {i}) AS RowsDropped, count(*) FILTER (WHERE f > {i}) AS RowsAfter,
       count(DISTINCT RawCountry) AS CountriesAsWritten, count(DISTINCT Country) AS CountriesNormalised
FROM failed"""
        for i, name in enumerate(names)
    ]
    return query(" UNION ALL ".join(rows), "sales", extra={"failed": failed})


def _pareto_summary_sql(margin: float) -> str:
    return query(
        f"""
SELECT n AS TotalProducts, cut AS TopFifthCount, round(share, 6) AS TopFifthShare_pct,
       n80 AS ProductsFor80, round(n80 / n * 100, 6) AS ProductsFor80_pct,
       CAST(least(n, greatest(floor(n * CAST(0.3 AS DOUBLE)), floor(n80 * CAST({margin} AS DOUBLE)))) AS BIGINT)
         AS PlottedProducts,
       share >= 80 AS StrictPareto
FROM marks""",
        "curve",
        extra={
            "marks": """SELECT max(n) AS n, max(cut) AS cut,
  max(CASE WHEN product_rank = cut THEN cumulative_pct END) AS share,
  min(CASE WHEN cumulative_pct >= 80 THEN product_rank END) AS n80
  FROM (SELECT *, greatest(1, CAST(floor(n * CAST(0.2 AS DOUBLE)) AS BIGINT)) AS cut FROM curve)"""
        },
    )


def _norm_sql(against: str) -> str:
    def scaled(c: str) -> str:
        lo, hi = f"(SELECT min({c}) FROM vip_months)", f"(SELECT max({c}) FROM vip_months)"
        return (
            f"round(CASE WHEN {hi} - {lo} > 0 THEN ({c} - {lo}) / ({hi} - {lo}) * 100 "
            f"ELSE {c} * 0 END, 6) AS {c}_norm"
        )

    return query(
        f"SELECT YearMonth, {scaled('vip')}, {scaled(against)}, (SELECT count(*) FROM vips) AS VIPs FROM vip_months",
        "vip_months",
    )


def _segments_sql(source: str, key: str, revenue: str, often: str, names: tuple, top: int, label: str) -> str:
    return query(
        f"""
SELECT p.{key}, {revenue}, {often},
       CASE WHEN {revenue} > mr AND {often} > mo THEN '{names[0]}' WHEN {revenue} > mr THEN '{names[1]}'
            WHEN {often} > mo THEN '{names[2]}' ELSE '{names[3]}' END AS Segment,
       rn <= {top} AS is_top, CASE WHEN rn <= {top} THEN {label} END AS Label
FROM (SELECT *, row_number() OVER (ORDER BY {revenue} DESC, {key}) AS rn FROM {source}) p,
     (SELECT median({revenue}) AS mr, median({often}) AS mo FROM {source}) m""",
        source,
    )


def _kept(source: str, value: str) -> dict[str, str]:
    return {
        "kept": f"SELECT *, {value} AS x FROM {source} "
        f"WHERE {value} <= (SELECT quantile_cont({value}, 0.99) FROM {source})"
    }


def _histogram_sql(source: str, value: str) -> str:
    return query(
        """
SELECT CAST(b AS INT) AS Bin, round(lo + (hi - lo) / 60 * b, 6) AS BinStart,
       round(lo + (hi - lo) / 60 * (b + 1), 6) AS BinEnd, coalesce(c.n, 0) AS n
FROM range(0, 60) r(b) CROSS JOIN ends
LEFT JOIN (SELECT least(CAST(floor((x - lo) / (hi - lo) * 60) AS BIGINT), 59) AS bin, count(*) AS n
           FROM kept, ends GROUP BY 1) c ON c.bin = b""",
        source,
        extra=_kept(source, value) | {"ends": "SELECT min(x) AS lo, max(x) AS hi FROM kept"},
    )


def _marks_sql(source: str, value: str) -> str:
    return query(
        f"""
SELECT round((SELECT quantile_cont({value}, 0.99) FROM {source}), 4) AS P99, count(*) AS Drawn,
       (SELECT count(*) FROM {source}) - count(*) AS LeftOut, round(median(x), 4) AS Median,
       round({money('x')} / count(*), 4) AS Mean FROM kept""",
        source,
        extra=_kept(source, value),
    )


_QUARTILES = {
    "q": "SELECT quantile_cont(x, 0.25) AS q1, median(x) AS q2, quantile_cont(x, 0.75) AS q3 FROM kept"
}
_TOP20 = """(SELECT Description, Revenue,
  (SELECT count(*) + 1 FROM products o WHERE o.Lines > p.Lines) AS FrequencyRank
  FROM products p ORDER BY Revenue DESC, Description LIMIT 20)"""
_TOP_CUSTOMERS = """(SELECT *, TotalRevenue / OrderCount AS AvgOrderValue FROM customers
  ORDER BY TotalRevenue DESC, CustomerID LIMIT 20)"""

ORACLE = {
    "sales_lines_raw": query("SELECT * FROM sales", "sales"),
    "country_names": query("SELECT Country, count(*) AS n FROM named GROUP BY Country", "named"),
    "lines_in_real_countries": query(
        """SELECT InvoiceNo, StockCode, Country FROM named
WHERE Country IS NULL OR Country NOT IN ('Unspecified', 'European Community')""",
        "named",
    ),
    "lines_with_positive_quantity": query(
        "SELECT InvoiceNo, StockCode, Quantity FROM sales WHERE Quantity > 0", "sales"
    ),
    "lines_with_positive_price": query(
        "SELECT InvoiceNo, StockCode, UnitPrice FROM sales WHERE UnitPrice > 0", "sales"
    ),
    "lines_on_sales_invoices": query(
        """SELECT InvoiceNo, StockCode FROM sales
WHERE InvoiceNo IS NULL OR NOT regexp_matches(InvoiceNo, '^[A-BD-Za-bd-z]')""",
        "sales",
    ),
    "lines_with_revenue": query(
        "SELECT InvoiceNo, StockCode, Quantity, UnitPrice, Quantity * UnitPrice AS Revenue FROM sales",
        "sales",
    ),
    "cleaned_lines": query("SELECT * FROM clean", "clean"),
    "lines_of_known_customers": query(
        "SELECT InvoiceNo, StockCode, CustomerID, Revenue FROM clean WHERE CustomerID IS NOT NULL",
        "clean",
    ),
    "lines_of_products": query("SELECT InvoiceNo, Description, Revenue FROM goods", "goods"),
    "cleaning_audit": _audit_sql(),
    "uk_vs_others": query(
        f"""
SELECT 'United Kingdom' AS Label, {money('Revenue')} AS Revenue FROM clean WHERE Country = 'United Kingdom'
UNION ALL
SELECT 'Other Countries', {money('Revenue')} FROM clean WHERE Country IS DISTINCT FROM 'United Kingdom'""",
        "clean",
    ),
    "country_revenue": query(
        f"""
SELECT Country, {money('Revenue')} AS Revenue,
       round_even({money('Revenue')} / (SELECT {money('Revenue')} FROM clean) * 100, 2) AS RevenueShare_pct
FROM clean WHERE Country <> 'United Kingdom' GROUP BY Country""",
        "clean",
    ),
    "monthly_revenue": query("SELECT YearMonth, Revenue FROM months", "months"),
    "monthly_revenue_growth": query(
        """
SELECT YearMonth, Revenue, lag(Revenue) OVER (ORDER BY YearMonth) AS Previous,
       round((Revenue - lag(Revenue) OVER (ORDER BY YearMonth))
             / nullif(lag(Revenue) OVER (ORDER BY YearMonth), 0), 6) AS GrowthRate
FROM months""",
        "months",
    ),
    "headline_growth": query(
        """
SELECT a.Revenue AS FirstRevenue, b.Revenue AS LastRevenue,
       round((b.Revenue - a.Revenue) / a.Revenue, 6) AS GrowthRate
FROM months a, months b WHERE a.YearMonth = '1995-01' AND b.YearMonth = '2001-07'""",
        "months",
    ),
    "top_products": query(f"SELECT * FROM {_TOP20}", "products"),
    "product_frequency_ranks": query(
        "SELECT Description, Lines, rank() OVER (ORDER BY Lines DESC) AS FrequencyRank FROM products",
        "products",
    ),
    "product_pareto": query(
        "SELECT Description, Revenue, round(cumulative_pct, 6) AS cumulative_pct FROM curve", "curve"
    ),
    "product_pareto_curve": query(
        """SELECT Description, Revenue, cumulative_revenue, round(cumulative_pct, 6) AS cumulative_pct,
product_rank, round(product_pct, 6) AS product_pct FROM curve""",
        "curve",
    ),
    "product_pareto_summary": _pareto_summary_sql(1.2),
    "product_pareto_summary_wide": _pareto_summary_sql(1.15),
    "top_fifth_of_products": query(
        "SELECT Description, Revenue, product_rank FROM curve WHERE product_rank <= floor(n * CAST(0.2 AS DOUBLE))",
        "curve",
    ),
    "product_scatter": query("SELECT Description, Revenue, Frequency FROM products", "products"),
    "order_values": query(
        "SELECT *, row_number() OVER (ORDER BY OrderValue DESC, InvoiceNo) AS place FROM invoices", "invoices"
    ),
    "largest_orders": query(
        "SELECT * FROM invoices ORDER BY OrderValue DESC, InvoiceNo LIMIT 10", "invoices"
    ),
    "large_order_impact": impact_sql(THRESHOLDS),
    "order_value_percentiles": query(
        " UNION ALL ".join(
            f"SELECT CAST({p} AS DOUBLE) AS Percentile, "
            f"round(quantile_cont(OrderValue, {p / 100}), 6) AS OrderValue FROM invoices"
            for p in q4.PERCENTILE_LADDER
        ),
        "invoices",
    ),
    "top_customers": query(f"SELECT * FROM {_TOP_CUSTOMERS}", "customers"),
    "customer_value_by_join": query(
        "SELECT *, TotalRevenue / OrderCount AS AvgOrderValue FROM customers", "customers"
    ),
    "customer_profile": query("SELECT * FROM customers", "customers"),
    "vip_customers": query("SELECT * FROM vips", "vips"),
    "customer_pareto": query(
        f"""
SELECT max(n) AS total_customers, max(cut) AS top_20pct_n,
       round_even({money('CASE WHEN rn <= cut THEN TotalRevenue END')} / {money('TotalRevenue')} * 100, 1)
         AS top_20pct_revenue_share
FROM (SELECT *, row_number() OVER (ORDER BY TotalRevenue DESC, CustomerID) AS rn, count(*) OVER () AS n,
             greatest(1, CAST(floor(count(*) OVER () * CAST(0.2 AS DOUBLE)) AS BIGINT)) AS cut FROM customers)""",
        "customers",
    ),
    "vip_lines": query(
        """SELECT CustomerID, InvoiceNo, StockCode, Revenue FROM clean
WHERE CustomerID IN (SELECT CustomerID FROM vips)""",
        "clean",
        "vips",
    ),
    "non_vip_lines": query(
        """SELECT CustomerID, InvoiceNo, StockCode, Revenue FROM clean
WHERE CustomerID IS NOT NULL AND CustomerID NOT IN (SELECT CustomerID FROM vips)""",
        "clean",
        "vips",
    ),
    "vip_monthly_revenue": query("SELECT * FROM vip_months", "vip_months"),
    "vip_season": _norm_sql("non_vip"),
    "vip_season_against_everyone": _norm_sql("everyone"),
    "chart_uk_donut": query(
        f"""
SELECT Label, Revenue, round_even(Revenue / (SELECT {money('Revenue')} FROM clean) * 100, 1) AS Share_pct
FROM (SELECT CASE WHEN Country = 'United Kingdom' THEN 'United Kingdom' ELSE 'Other Countries' END AS Label,
             {money('Revenue')} AS Revenue FROM clean GROUP BY 1)""",
        "clean",
    ),
    "chart_monthly_line": query(
        """
SELECT YearMonth, Revenue,
       YearMonth = (SELECT max(YearMonth) FROM months) AND LastDay < last_day(LastDay) AS is_partial
FROM months""",
        "months",
    ),
    "chart_pareto": query(
        """
SELECT Description, Revenue, round(cumulative_pct, 6) AS cumulative_pct, product_rank FROM curve
WHERE product_rank <= (
  SELECT least(max(n), greatest(floor(max(n) * CAST(0.3 AS DOUBLE)),
    floor(min(CASE WHEN cumulative_pct >= 80 THEN product_rank END) * CAST(1.2 AS DOUBLE)))) FROM curve)""",
        "curve",
    ),
    "chart_top_products": query(
        f"""SELECT Description, Revenue, 'Freq Rank: #' || FrequencyRank AS Label,
  row_number() OVER (ORDER BY Revenue, Description) AS place FROM {_TOP20}""",
        "products",
    ),
    "chart_top_customers": query(
        f"""SELECT CAST(CustomerID AS VARCHAR) AS Customer, TotalRevenue, OrderCount || ' orders' AS Label,
  row_number() OVER (ORDER BY TotalRevenue, CAST(CustomerID AS VARCHAR)) AS place
FROM {_TOP_CUSTOMERS}""",
        "customers",
    ),
    "chart_product_segments": _segments_sql(
        "products",
        "Description",
        "Revenue",
        "Frequency",
        ("Star Product", "Niche / Premium", "Low-price Popular", "General"),
        5,
        "substr(Description, 1, 25)",
    ),
    "chart_customer_segments": _segments_sql(
        "customers",
        "CustomerID",
        "TotalRevenue",
        "OrderCount",
        ("VIP", "Big Spender", "Loyal Small Buyer", "Casual"),
        10,
        "'ID ' || p.CustomerID",
    ),
    "chart_leading_products": query(
        """
SELECT Description, Revenue, Frequency, substr(Description, 1, 35) AS Label FROM products
WHERE Frequency >= (SELECT median(Frequency) FROM products)
  AND Revenue >= (SELECT median(Revenue) FROM products)
ORDER BY Revenue DESC, Description LIMIT 5""",
        "products",
    ),
    "chart_order_histogram": _histogram_sql("invoices", "OrderValue"),
    "chart_order_histogram_marks": _marks_sql("invoices", "OrderValue"),
    "chart_customer_histogram": _histogram_sql("customers", "TotalRevenue"),
    "chart_customer_histogram_marks": _marks_sql("customers", "TotalRevenue"),
    "chart_order_box_plot": query(
        """
SELECT round(q1, 4) AS Q1, round(q2, 4) AS Median, round(q3, 4) AS Q3,
       (SELECT min(x) FROM kept WHERE x >= q1 - (q3 - q1) * 1.5) AS WhiskerLow,
       (SELECT max(x) FROM kept WHERE x <= q3 + (q3 - q1) * 1.5) AS WhiskerHigh,
       (SELECT count(*) FROM kept WHERE x < q1 - (q3 - q1) * 1.5 OR x > q3 + (q3 - q1) * 1.5) AS Outliers
FROM q""",
        "invoices",
        extra=_kept("invoices", "OrderValue") | _QUARTILES,
    ),
    "chart_order_box_plot_outliers": query(
        """
SELECT InvoiceNo, OrderValue FROM kept, q
WHERE x < q1 - (q3 - q1) * 1.5 OR x > q3 + (q3 - q1) * 1.5""",
        "invoices",
        extra=_kept("invoices", "OrderValue") | _QUARTILES,
    ),
}
ORACLE["cleaning_audit_of_the_report"] = ORACLE["cleaning_audit"]
for _name, _order in (("country_revenue_in_place", "Revenue DESC"), ("chart_country_bars", "Revenue")):
    ORACLE[_name] = f"""SELECT *, row_number() OVER (ORDER BY {_order}, Country) AS place
FROM ({ORACLE["country_revenue"]}) abroad"""

"""Registered profiling queries over the raw and half-cleaned sales lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.catalog.sql import money, query
from ledgerlark.operators import clean as rules, profile
from ledgerlark.operators.grain import customer_grain, invoice_grain, product_grain, visit_grain
from ledgerlark.operators.settle import settle
from ledgerlark.plans import charts, months, products as q3
from ledgerlark.sources import sales_lines

# Prices here end below 10; the profiling default for a high price is 100.
HIGH_PRICE = 8.0
LINE_COLUMNS = ("InvoiceNo", "StockCode", "Description", "Quantity", "UnitPrice", "CustomerID")


def _in_countries(spark, sf_dir):
    """Raw lines after the country rules, the state in which months are counted."""
    lines = sales_lines(spark, sf_dir)
    return lines.transform(rules.normalise_countries).transform(rules.remove_non_countries)


def _valid(spark, sf_dir):
    lines = sales_lines(spark, sf_dir).transform(rules.normalise_countries)
    return rules.add_revenue(rules.valid_sales(lines))


def _description(frame):
    return frame.withColumns({c: F.round(c, 4) for c in frame.columns if c in ("mean", "std", "p25", "p50", "p75")})


def invoice_kinds(spark, sf_dir):
    return profile.invoice_kinds(sales_lines(spark, sf_dir))


def non_sales_invoice_lines(spark, sf_dir):
    lines = profile.with_invoice_kind(sales_lines(spark, sf_dir))
    return lines.filter("inv_type = 'other-letter (non-sales)'").select(*LINE_COLUMNS)


def non_sales_lines_left_in_valid_sales(spark, sf_dir):
    lines = _valid(spark, sf_dir)
    return lines.agg(F.expr(f"count_if(InvoiceNo RLIKE '{rules.NON_SALES_INVOICE}')").alias("n"))


def valid_sales(spark, sf_dir):
    return _valid(spark, sf_dir).select("InvoiceNo", "Description", "Revenue")


def valid_sales_summary(spark, sf_dir):
    names = product_grain(_valid(spark, sf_dir), goods_only=False)
    return names.agg(
        F.sum("Lines").alias("FilteredRows"), F.count(F.lit(1)).alias("UniqueDescriptions")
    )


def suspicious_products(spark, sf_dir):
    names = settle(product_grain(_valid(spark, sf_dir), goods_only=False))
    return q3.suspicious_names(names).select("Description", "Revenue", "product_rank")


def missing_value_slices(spark, sf_dir):
    return profile.missing_value_slices(sales_lines(spark, sf_dir))


def lines_without_description(spark, sf_dir):
    return sales_lines(spark, sf_dir).filter("Description IS NULL").select(*LINE_COLUMNS)


def free_item_summary(spark, sf_dir):
    return profile.free_item_summary(sales_lines(spark, sf_dir))


def free_item_descriptions(spark, sf_dir):
    items = profile.free_items(sales_lines(spark, sf_dir))
    return profile.value_counts(items, "Description", keep_null=True)


def free_item_customers(spark, sf_dir):
    items = profile.free_items(sales_lines(spark, sf_dir))
    return profile.value_counts(items, "CustomerID", keep_null=True)


def zero_price_descriptions(spark, sf_dir):
    lines = sales_lines(spark, sf_dir).filter("UnitPrice = 0")
    return profile.top_values(lines, "Description", 15)


def zero_price_rates(spark, sf_dir):
    lines = sales_lines(spark, sf_dir).filter("UnitPrice = 0")
    return lines.selectExpr(
        "avg(int(CustomerID IS NULL)) AS NoCustomerRate", "avg(int(Quantity < 0)) AS NegativeRate"
    ).selectExpr("round(NoCustomerRate, 6) AS NoCustomerRate", "round(NegativeRate, 6) AS NegativeRate")


def negative_only_summary(spark, sf_dir):
    return profile.negative_only_summary(sales_lines(spark, sf_dir))


def negative_or_free_descriptions(spark, sf_dir):
    """Sorted distinct descriptions of lines that are no sale although not cancelled."""
    lines = sales_lines(spark, sf_dir).filter(
        f"NOT {profile.CANCELLED} AND (Quantity <= 0 OR UnitPrice <= 0) AND Description IS NOT NULL"
    )
    return lines.select("Description").distinct().orderBy("Description")


def negative_and_cancelled(spark, sf_dir):
    return profile.negative_and_cancelled(sales_lines(spark, sf_dir))


def out_of_range_rates(spark, sf_dir):
    return profile.out_of_range_rates(sales_lines(spark, sf_dir))


def price_bands(spark, sf_dir):
    return profile.price_bands(sales_lines(spark, sf_dir), HIGH_PRICE)


def monthly_line_counts(spark, sf_dir):
    return months.monthly_line_counts(rules.add_revenue(_in_countries(spark, sf_dir)))


def country_line_counts(spark, sf_dir):
    return profile.value_counts(sales_lines(spark, sf_dir), "Country")


def country_line_counts_abroad(spark, sf_dir):
    lines = _in_countries(spark, sf_dir)
    abroad = lines.filter(f"NOT (Country <=> '{rules.HOME_COUNTRY}')")
    return profile.value_counts(abroad, "Country")


def line_count_donut(spark, sf_dir):
    """Lines at home against all others; the home count is taken before rows are dropped."""
    lines = sales_lines(spark, sf_dir)
    counts = lines.agg(
        F.expr(f"count_if(Country = '{rules.HOME_COUNTRY}')").alias("home"),
        F.expr(f"count_if({rules.KEEP_RULES['real country']})").alias("kept"),
    )
    sizes = counts.selectExpr(
        f"stack(2, '{rules.HOME_COUNTRY}', home, 'Other Countries', kept - home) AS (Label, n)"
    )
    return charts.donut(sizes, "n")


def quantity_top_products(spark, sf_dir):
    totals = profile.totals_by_product(sales_lines(spark, sf_dir), "sum(Quantity)", "Quantity")
    return totals.orderBy(F.desc("Quantity"), "Description").limit(10)


def quantity_bottom_products(spark, sf_dir):
    totals = profile.totals_by_product(sales_lines(spark, sf_dir), "sum(Quantity)", "Quantity")
    return totals.orderBy("Quantity", "Description").limit(10)


def raw_revenue_top_products(spark, sf_dir):
    lines = rules.add_revenue(sales_lines(spark, sf_dir))
    totals = profile.totals_by_product(
        lines, "double(sum(cast(Revenue AS decimal(24,6))))", "Revenue"
    )
    return totals.orderBy(F.desc("Revenue"), "Description").limit(10)


def null_profile(spark, sf_dir):
    return profile.null_profile(sales_lines(spark, sf_dir))


def number_summary(spark, sf_dir):
    return _description(profile.describe_numbers(sales_lines(spark, sf_dir)))


def text_summary(spark, sf_dir):
    return profile.describe_texts(sales_lines(spark, sf_dir))


def duplicate_lines(spark, sf_dir):
    return profile.duplicate_rows(sales_lines(spark, sf_dir))


def date_range(spark, sf_dir):
    return sales_lines(spark, sf_dir).agg(
        F.min("InvoiceDate").alias("FirstDate"), F.max("InvoiceDate").alias("LastDate")
    )


def distinct_value_counts(spark, sf_dir):
    lines = sales_lines(spark, sf_dir)
    return profile.distinct_counts(lines, ["InvoiceNo", "StockCode", "Description", "CustomerID", "Country"])


def country_list(spark, sf_dir):
    return sales_lines(spark, sf_dir).select("Country").distinct()


def codes_with_several_names(spark, sf_dir):
    return profile.codes_with_several_names(sales_lines(spark, sf_dir))


def names_of_such_codes(spark, sf_dir):
    return profile.names_of_such_codes(sales_lines(spark, sf_dir))


def order_value_summary(spark, sf_dir):
    return _description(profile.describe_numbers(invoice_grain(rules.clean(sales_lines(spark, sf_dir))), ["OrderValue"]))


def customer_summary(spark, sf_dir):
    customers = customer_grain(visit_grain(rules.clean(sales_lines(spark, sf_dir))))
    return _description(profile.describe_numbers(customers, ["TotalRevenue", "OrderCount"]))


def guest_line_summary(spark, sf_dir):
    guests = _valid(spark, sf_dir).filter("CustomerID IS NULL")
    return _description(profile.describe_numbers(guests, ["Quantity", "UnitPrice", "Revenue"]))


def guest_share(spark, sf_dir):
    return profile.guest_summary(_valid(spark, sf_dir))


def guest_countries(spark, sf_dir):
    guests = _valid(spark, sf_dir).filter("CustomerID IS NULL AND Country IS NOT NULL")
    return profile.top_values(guests, "Country", 10)


def top_products_by_frequency(spark, sf_dir):
    return q3.top_by_frequency(product_grain(_valid(spark, sf_dir), goods_only=False))


def quantity_value_counts(spark, sf_dir):
    return profile.top_values(sales_lines(spark, sf_dir), "Quantity", 20)


def lines_with_smallest_quantity(spark, sf_dir):
    return profile.rows_at_extreme(settle(sales_lines(spark, sf_dir).select(*LINE_COLUMNS)), "Quantity", largest=False)


def lines_with_largest_price(spark, sf_dir):
    return profile.rows_at_extreme(settle(sales_lines(spark, sf_dir).select(*LINE_COLUMNS)), "UnitPrice", largest=True)


def lines_by_quantity_size(spark, sf_dir):
    lines = sales_lines(spark, sf_dir).select(*LINE_COLUMNS)
    ties = ("Quantity", "InvoiceNo", "StockCode", "UnitPrice")
    return profile.largest_by_size(lines, "Quantity", 10, *ties)


def highest_prices(spark, sf_dir):
    lines = sales_lines(spark, sf_dir).select(*LINE_COLUMNS)
    return lines.orderBy(F.desc("UnitPrice"), "InvoiceNo", "StockCode", "Quantity").limit(10)


QUERIES = {
    f.__name__: f
    for f in (
        invoice_kinds,
        non_sales_invoice_lines,
        non_sales_lines_left_in_valid_sales,
        valid_sales,
        valid_sales_summary,
        suspicious_products,
        missing_value_slices,
        lines_without_description,
        free_item_summary,
        free_item_descriptions,
        free_item_customers,
        zero_price_descriptions,
        zero_price_rates,
        negative_only_summary,
        negative_or_free_descriptions,
        negative_and_cancelled,
        out_of_range_rates,
        price_bands,
        monthly_line_counts,
        country_line_counts,
        country_line_counts_abroad,
        line_count_donut,
        quantity_top_products,
        quantity_bottom_products,
        raw_revenue_top_products,
        null_profile,
        number_summary,
        text_summary,
        duplicate_lines,
        date_range,
        distinct_value_counts,
        country_list,
        codes_with_several_names,
        names_of_such_codes,
        order_value_summary,
        customer_summary,
        guest_line_summary,
        guest_share,
        guest_countries,
        top_products_by_frequency,
        quantity_value_counts,
        lines_with_smallest_quantity,
        lines_with_largest_price,
        lines_by_quantity_size,
        highest_prices,
    )
}


# --- the same in SQL ----------------------------------------------------------------

_CANCELLED = "coalesce(starts_with(InvoiceNo, 'C'), false)"
_COLUMNS = ", ".join(LINE_COLUMNS)
_REAL = "(Country IS NULL OR Country NOT IN ('Unspecified', 'European Community'))"


def _pct(test: str) -> str:
    return f"round_even(CAST(count(*) FILTER (WHERE {test}) AS DOUBLE) / count(*) * 100, 2)"


def _count(test: str, name: str) -> str:
    return f"count(*) FILTER (WHERE {test}) AS {name}"


def _describe(source: str, columns: tuple[str, ...], *ctes: str, **extra: str) -> str:
    rows = [
        f"""SELECT '{c}' AS "Column", count({c}) AS "count",
       round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
       CAST(min({c}) AS DOUBLE) AS "min", round(quantile_cont({c}, 0.25), 4) AS p25,
       round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75,
       CAST(max({c}) AS DOUBLE) AS "max" FROM {source}"""
        for c in columns
    ]
    return query(" UNION ALL ".join(rows), *ctes, extra=extra)


def _describe_text(columns: tuple[str, ...]) -> str:
    rows = [
        f"""SELECT '{c}' AS "Column", CAST(sum(n) AS BIGINT) AS "count", count(*) AS "unique",
       (SELECT {c} FROM (SELECT {c}, count(*) AS k FROM sales WHERE {c} IS NOT NULL GROUP BY 1)
        ORDER BY k DESC, {c} LIMIT 1) AS top, max(n) AS freq
FROM (SELECT {c}, count(*) AS n FROM sales WHERE {c} IS NOT NULL GROUP BY 1)"""
        for c in columns
    ]
    return query(" UNION ALL ".join(rows), "sales")


def _value_counts(column: str, source: str, where: str, keep_null: bool) -> str:
    shown = "" if keep_null else f"WHERE {column} IS NOT NULL"
    return f"""SELECT * FROM (SELECT {column}, count(*) AS n,
  round_even(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM {source} WHERE {where}) * 100, 2) AS n_pct
  FROM {source} WHERE {where} GROUP BY {column}) {shown}"""


_ALL = ("InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country")
_VALID_PRODUCTS = {
    "names": f"SELECT Description, {money('Revenue')} AS Revenue, count(*) AS Lines FROM valid GROUP BY 1"
}

ORACLE = {
    "invoice_kinds": query(
        f"""
SELECT CASE WHEN {_CANCELLED} THEN 'C-prefix (cancellation)'
            WHEN regexp_matches(InvoiceNo, '[A-Za-z]') THEN 'other-letter (non-sales)'
            ELSE 'numeric-only (normal)' END AS inv_type, count(*) AS n FROM sales GROUP BY 1""",
        "sales",
    ),
    "non_sales_invoice_lines": query(
        f"SELECT {_COLUMNS} FROM sales WHERE NOT {_CANCELLED} AND regexp_matches(InvoiceNo, '[A-Za-z]')",
        "sales",
    ),
    "non_sales_lines_left_in_valid_sales": query(
        "SELECT count(*) AS n FROM valid WHERE regexp_matches(InvoiceNo, '^[A-BD-Za-bd-z]')", "valid"
    ),
    "valid_sales": query("SELECT InvoiceNo, Description, Revenue FROM valid", "valid"),
    "valid_sales_summary": query(
        "SELECT count(*) AS FilteredRows, count(DISTINCT Description) AS UniqueDescriptions FROM valid",
        "valid",
    ),
    "suspicious_products": query(
        f"""
SELECT Description, Revenue, rn AS product_rank
FROM (SELECT *, row_number() OVER (ORDER BY Revenue DESC, Description) AS rn, count(*) OVER () AS n FROM names)
WHERE rn <= floor(n * CAST(0.2 AS DOUBLE)) AND regexp_matches(lower(Description), '{"|".join(q3.CHARGE_WORDS)}')""",
        "valid",
        extra=_VALID_PRODUCTS,
    ),
    "missing_value_slices": query(
        f"""
SELECT {_count("Description IS NULL", "no_description")},
  {_count("Description IS NULL AND CustomerID IS NULL", "no_description_no_customer")},
  {_count("Description IS NULL AND CustomerID IS NOT NULL", "no_description_but_customer")},
  {_count("Description IS NULL AND UnitPrice > 0", "no_description_but_price")},
  {_count("CustomerID IS NULL", "no_customer")},
  {_count("CustomerID IS NULL AND UnitPrice > 0", "no_customer_but_price")},
  {_count(f"CustomerID IS NULL AND {_CANCELLED}", "no_customer_cancelled")},
  {_count(f"CustomerID IS NULL AND NOT {_CANCELLED}", "no_customer_not_cancelled")} FROM sales""",
        "sales",
    ),
    "lines_without_description": query(
        f"SELECT {_COLUMNS} FROM sales WHERE Description IS NULL", "sales"
    ),
    "free_item_summary": query(
        f"""
SELECT count(*) AS FreeItems, {_pct("Description IS NULL")} AS NoDescription_pct,
       {_pct("CustomerID IS NULL")} AS NoCustomer_pct
FROM sales WHERE Quantity > 0 AND UnitPrice = 0""",
        "sales",
    ),
    "free_item_descriptions": query(
        _value_counts("Description", "sales", "Quantity > 0 AND UnitPrice = 0", True), "sales"
    ),
    "free_item_customers": query(
        _value_counts("CustomerID", "sales", "Quantity > 0 AND UnitPrice = 0", True), "sales"
    ),
    "zero_price_descriptions": query(
        """
SELECT Description, count(*) AS n FROM sales WHERE UnitPrice = 0
GROUP BY 1 ORDER BY n DESC, Description NULLS FIRST LIMIT 15""",
        "sales",
    ),
    "zero_price_rates": query(
        """
SELECT round(avg(CASE WHEN CustomerID IS NULL THEN 1 ELSE 0 END), 6) AS NoCustomerRate,
       round(avg(CASE WHEN Quantity < 0 THEN 1 ELSE 0 END), 6) AS NegativeRate
FROM sales WHERE UnitPrice = 0""",
        "sales",
    ),
    "negative_only_summary": query(
        f"""
SELECT count(*) AS n, {_count("UnitPrice = 0", "PriceZero")},
       {_count("UnitPrice IS DISTINCT FROM 0", "PriceNotZero")},
       count(*) FILTER (WHERE UnitPrice IS DISTINCT FROM 0) = 0 AS AllPriceZero
FROM sales WHERE Quantity <= 0 AND NOT {_CANCELLED}""",
        "sales",
    ),
    "negative_or_free_descriptions": query(
        f"""
SELECT DISTINCT Description FROM sales
WHERE NOT {_CANCELLED} AND (Quantity <= 0 OR UnitPrice <= 0) AND Description IS NOT NULL""",
        "sales",
    ),
    "negative_and_cancelled": query(
        f"""
SELECT {_count("Quantity <= 0", "Negative")}, {_count(_CANCELLED, "Cancelled")},
  {_count(f"Quantity <= 0 AND {_CANCELLED}", "Overlap")},
  {_count(f"Quantity <= 0 AND NOT {_CANCELLED}", "NegativeOnly")},
  {_count(f"Quantity > 0 AND {_CANCELLED}", "CancelledOnly")} FROM sales""",
        "sales",
    ),
    "out_of_range_rates": query(
        f"""
SELECT {_count("Quantity <= 0", "NonPositiveQuantity")}, {_pct("Quantity <= 0")} AS NonPositiveQuantity_pct,
  {_count("UnitPrice <= 0", "NonPositivePrice")}, {_pct("UnitPrice <= 0")} AS NonPositivePrice_pct,
  {_count("UnitPrice < 0", "NegativePrice")} FROM sales""",
        "sales",
    ),
    "price_bands": query(
        f"""
SELECT {_count("UnitPrice <= 0", "NotPriced")}, {_count(f"UnitPrice > 0 AND UnitPrice < {HIGH_PRICE}", "Usual")},
  {_count(f"UnitPrice >= {HIGH_PRICE}", "High")} FROM sales""",
        "sales",
    ),
    "monthly_line_counts": query(
        f"SELECT strftime(InvoiceDate, '%Y-%m') AS YearMonth, count(*) AS Lines FROM named WHERE {_REAL} GROUP BY 1",
        "named",
    ),
    "country_line_counts": query(_value_counts("Country", "sales", "true", False), "sales"),
    "country_line_counts_abroad": query(
        _value_counts("Country", "named", f"{_REAL} AND Country IS DISTINCT FROM 'United Kingdom'", False),
        "named",
    ),
    "line_count_donut": query(
        f"""
SELECT Label, n, round_even(CAST(n AS DOUBLE) / (SELECT count(*) FROM sales WHERE {_REAL}) * 100, 1) AS Share_pct
FROM (SELECT CASE WHEN Country = 'United Kingdom' THEN 'United Kingdom' ELSE 'Other Countries' END AS Label,
             count(*) AS n FROM sales WHERE {_REAL} GROUP BY 1)""",
        "sales",
    ),
    "quantity_top_products": query(
        """
SELECT Description, CAST(sum(Quantity) AS BIGINT) AS Quantity FROM sales
WHERE Description IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
        "sales",
    ),
    "quantity_bottom_products": query(
        """
SELECT Description, CAST(sum(Quantity) AS BIGINT) AS Quantity FROM sales
WHERE Description IS NOT NULL GROUP BY 1 ORDER BY 2, 1 LIMIT 10""",
        "sales",
    ),
    "raw_revenue_top_products": query(
        f"""
SELECT Description, {money("Quantity * UnitPrice")} AS Revenue FROM sales
WHERE Description IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
        "sales",
    ),
    "null_profile": query(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "Column", {_count(f"{c} IS NULL", "Missing")}, {_pct(f"{c} IS NULL")} AS Missing_pct FROM sales"""
            for c in _ALL
        ),
        "sales",
    ),
    "number_summary": _describe("sales", ("Quantity", "UnitPrice", "CustomerID"), "sales"),
    "text_summary": _describe_text(("InvoiceNo", "StockCode", "Description", "Country")),
    "duplicate_lines": query(
        "SELECT (SELECT count(*) FROM sales) - (SELECT count(*) FROM (SELECT DISTINCT * FROM sales)) AS DuplicateRows",
        "sales",
    ),
    "date_range": query(
        "SELECT min(InvoiceDate) AS FirstDate, max(InvoiceDate) AS LastDate FROM sales", "sales"
    ),
    "distinct_value_counts": query(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "Column", count(DISTINCT {c}) AS DistinctValues FROM sales"""
            for c in ("InvoiceNo", "StockCode", "Description", "CustomerID", "Country")
        ),
        "sales",
    ),
    "country_list": query("SELECT DISTINCT Country FROM sales", "sales"),
    "codes_with_several_names": query(
        """
SELECT StockCode, count(DISTINCT Description) AS Descriptions FROM sales
GROUP BY 1 HAVING count(DISTINCT Description) >= 2""",
        "sales",
    ),
    "names_of_such_codes": query(
        """
SELECT DISTINCT StockCode, Description FROM sales WHERE StockCode IN (
  SELECT StockCode FROM sales GROUP BY 1 HAVING count(DISTINCT Description) >= 2)""",
        "sales",
    ),
    "order_value_summary": _describe("invoices", ("OrderValue",), "invoices"),
    "customer_summary": _describe("customers", ("TotalRevenue", "OrderCount"), "customers"),
    "guest_line_summary": _describe(
        "guests", ("Quantity", "UnitPrice", "Revenue"), "valid",
        guests="SELECT * FROM valid WHERE CustomerID IS NULL",
    ),
    "guest_share": query(
        f"""
SELECT count(*) AS Lines, count(CustomerID) AS WithCustomer, {_count("CustomerID IS NULL", "Guests")},
       {_pct("CustomerID IS NULL")} AS Guests_pct, count(DISTINCT CustomerID) AS Customers FROM valid""",
        "valid",
    ),
    "guest_countries": query(
        """
SELECT Country, count(*) AS n FROM valid WHERE CustomerID IS NULL AND Country IS NOT NULL
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
        "valid",
    ),
    "top_products_by_frequency": query(
        "SELECT Description, Lines FROM names ORDER BY Lines DESC, Description LIMIT 20",
        "valid",
        extra=_VALID_PRODUCTS,
    ),
    "quantity_value_counts": query(
        "SELECT Quantity, count(*) AS n FROM sales GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20", "sales"
    ),
    "lines_with_smallest_quantity": query(
        f"SELECT {_COLUMNS} FROM sales WHERE Quantity = (SELECT min(Quantity) FROM sales)", "sales"
    ),
    "lines_with_largest_price": query(
        f"SELECT {_COLUMNS} FROM sales WHERE UnitPrice = (SELECT max(UnitPrice) FROM sales)", "sales"
    ),
    "lines_by_quantity_size": query(
        f"""SELECT {_COLUMNS} FROM sales
ORDER BY abs(Quantity) DESC, Quantity, InvoiceNo, StockCode, UnitPrice LIMIT 10""",
        "sales",
    ),
    "highest_prices": query(
        f"SELECT {_COLUMNS} FROM sales ORDER BY UnitPrice DESC, InvoiceNo, StockCode, Quantity LIMIT 10",
        "sales",
    ),
}

"""Cleaning rules for sales lines, and an audit of what each rule removes.

The cleaning run (``clean``) and the audit (``cleaning_audit``) share one definition
of each rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ledgerlark.functions import not_one_of

# The cleaning rules' word lists and patterns.
COUNTRY_NAMES = {"EIRE": "Ireland", "RSA": "South Africa"}
NOT_A_PRODUCT = (
    "DOTCOM POSTAGE",
    "POSTAGE",
    "CARRIAGE",
    "Manual",
    "AMAZON FEE",
    "Adjust bad debt",
)
NON_SALES_INVOICE = "^[A-BD-Za-bd-z]"
HOME_COUNTRY = "United Kingdom"


# Row filters in the order in which they are applied.  Each is true or false, never
# null: a missing country and a missing invoice number pass (the latter leaves when
# lines are grouped by it), a missing quantity or price does not.
KEEP_RULES = {
    "real country": "Country IS NULL OR Country NOT IN ('Unspecified', 'European Community')",
    "positive quantity": "coalesce(Quantity > 0, false)",
    "positive price": "coalesce(UnitPrice > 0, false)",
    "sales invoice": f"NOT coalesce(InvoiceNo RLIKE '{NON_SALES_INVOICE}', false)",
}


def normalise_countries(lines: DataFrame) -> DataFrame:
    return lines.replace(COUNTRY_NAMES, subset=["Country"])


def _apply(rule: str):
    return lambda lines: lines.filter(KEEP_RULES[rule])


remove_non_countries = _apply("real country")
remove_non_positive_quantity = _apply("positive quantity")
remove_non_positive_price = _apply("positive price")
remove_non_sales_invoices = _apply("sales invoice")


def add_revenue(lines: DataFrame) -> DataFrame:
    return lines.selectExpr("*", "Quantity * UnitPrice AS Revenue")


def clean(lines: DataFrame) -> DataFrame:
    """All rules in order; Spark folds them into the scan as one filter."""
    return (
        lines.transform(normalise_countries)
        .transform(remove_non_countries)
        .transform(remove_non_positive_quantity)
        .transform(remove_non_positive_price)
        .transform(remove_non_sales_invoices)
        .transform(add_revenue)
    )


def with_customer(lines: DataFrame) -> DataFrame:
    """Lines of known customers; guests leave only for the customer questions."""
    return lines.filter("CustomerID IS NOT NULL")


def remove_non_products(lines: DataFrame) -> DataFrame:
    """Drop fee and accounting texts (exact match); a missing description stays."""
    return lines.filter(not_one_of("Description", NOT_A_PRODUCT))


def valid_sales(lines: DataFrame) -> DataFrame:
    """The profiling view of a sale: described, priced and with a positive quantity."""
    return lines.filter("Description IS NOT NULL AND UnitPrice > 0 AND Quantity > 0")


def clean_with_audit(lines: DataFrame) -> tuple[DataFrame, Observation]:
    """:func:`clean`, and what it removes, counted on the way by whatever reads the result.

    The lines are not read a second time.  :func:`audit_seen` gives the audit once the
    result has been written whole.  Different country names are told apart by a 64-bit
    hash; their set is all that is held besides counts.
    """
    seen = Observation()
    left = F.lit(True)
    passed = [F.count(F.lit(1)).alias("before_0")]
    normal = normalise_countries(lines.withColumn("_raw_country", F.col("Country")))
    for i, rule in enumerate(KEEP_RULES.values()):
        left = left & F.expr(rule)
        passed.append(F.count_if(left).alias(f"before_{i + 1}"))
    observed = normal.observe(
        seen, *passed,
        F.size(F.collect_set(F.xxhash64("_raw_country") + F.when(F.col("_raw_country").isNotNull(), 0))).alias("raw_countries"),
        F.size(F.collect_set(F.xxhash64("Country") + F.when(F.col("Country").isNotNull(), 0))).alias("countries"),
    )
    kept = observed.filter(" AND ".join(f"({rule})" for rule in KEEP_RULES.values()))
    return add_revenue(kept.drop("_raw_country")), seen


def audit_seen(spark: SparkSession, seen: Observation) -> DataFrame:
    """The audit of :func:`clean_with_audit` in the form of :func:`cleaning_audit`."""
    counts = seen.get
    rows = [
        (
            i + 1, name, counts[f"before_{i}"], counts[f"before_{i}"] - counts[f"before_{i + 1}"],
            counts[f"before_{i + 1}"], counts["raw_countries"], counts["countries"],
        )
        for i, name in enumerate(KEEP_RULES)
    ]
    return spark.createDataFrame(
        rows,
        "Step int, Rule string, RowsBefore bigint, RowsDropped bigint, RowsAfter bigint, "
        "CountriesAsWritten bigint, CountriesNormalised bigint",
    )


def cleaning_audit(lines: DataFrame) -> DataFrame:
    """Rows before, dropped by, and left after each rule, in one pass over the lines.

    A line is charged to the first rule it fails.  The lines collapse to (country,
    rule) counts on the map side, so what is shuffled does not grow with the table.
    """
    names = list(KEEP_RULES)
    tests = " ".join(f"WHEN NOT ({KEEP_RULES[name]}) THEN {i}" for i, name in enumerate(names))
    counts = (
        lines.withColumn("RawCountry", F.col("Country"))
        .transform(normalise_countries)
        .withColumn("Failed", F.expr(f"CASE {tests} ELSE {len(names)} END"))
        .groupBy("RawCountry", "Country", "Failed")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = counts.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("Failed") >= i, F.col("n"))), F.lit(0)).alias(f"before_{i}")
            for i in range(len(names) + 1)
        ],
        F.countDistinct("RawCountry").alias("raw_countries"),
        F.countDistinct("Country").alias("countries"),
    )
    steps = [
        F.struct(
            F.lit(i + 1).alias("Step"),
            F.lit(name).alias("Rule"),
            F.col(f"before_{i}").alias("RowsBefore"),
            (F.col(f"before_{i}") - F.col(f"before_{i + 1}")).alias("RowsDropped"),
            F.col(f"before_{i + 1}").alias("RowsAfter"),
        )
        for i, name in enumerate(names)
    ]
    return totals.select(
        F.explode(F.array(*steps)).alias("s"), "raw_countries", "countries"
    ).select(
        "s.*",
        F.col("raw_countries").alias("CountriesAsWritten"),
        F.col("countries").alias("CountriesNormalised"),
    )

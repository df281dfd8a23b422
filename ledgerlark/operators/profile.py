"""Profiling of a table: nulls, duplicates, distributions, value counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType, StringType

from ledgerlark.functions import percent_of
from ledgerlark.operators.ordered import folded_values, long_form, quantiles_of_folded
from ledgerlark.operators.settle import settle

CANCELLED = "coalesce(startswith(InvoiceNo, 'C'), false)"


def numeric_columns(frame: DataFrame) -> list[str]:
    return [f.name for f in frame.schema.fields if isinstance(f.dataType, NumericType)]


def text_columns(frame: DataFrame) -> list[str]:
    return [f.name for f in frame.schema.fields if isinstance(f.dataType, StringType)]


def null_profile(frame: DataFrame) -> DataFrame:
    """Missing values per column, counted for all columns in one pass."""
    counts = frame.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.expr(f"count_if(`{c}` IS NULL)").alias(c) for c in frame.columns],
    )
    pairs = ", ".join(f"'{c}', `{c}`" for c in frame.columns)
    return counts.selectExpr(
        "_rows", f"stack({len(frame.columns)}, {pairs}) AS (Column, Missing)"
    ).select("Column", "Missing", percent_of("Missing", "_rows").alias("Missing_pct"))


def describe_numbers(frame: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, sample deviation, min, exact quartiles and max, a row per column.

    Missing values and NaN are not counted; a column without values has count 0 and
    nulls.  Moments come from one aggregate over all columns, quartiles from values
    folded to distinct ones; both are a row per column when they meet.
    """
    names = list(columns or numeric_columns(frame))
    measures = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}
    value = "nanvl(double(`{0}`), NULL)"
    moments = frame.agg(*[
        F.expr(f"{function}({value.format(c)})").alias(f"{name}_{i}")
        for i, c in enumerate(names)
        for name, function in {"count": "count", **measures}.items()
    ])
    rows = ", ".join(
        f"'{c}', count_{i}, mean_{i}, std_{i}, min_{i}, max_{i}" for i, c in enumerate(names)
    )
    moments = moments.selectExpr(f"stack({len(names)}, {rows}) AS (Column, count, mean, std, min, max)")
    copies = folded_values(long_form(frame, names), "Value", by=["Column"])
    quartiles = quantiles_of_folded(copies, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, by=["Column"])
    kept = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]
    return (
        moments.unionByName(quartiles, allowMissingColumns=True)
        .groupBy("Column")
        .agg(*[F.max(c).alias(c) for c in kept])
    )


def describe_texts(frame: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, distinct values, most frequent value and its count, a row per column.

    A column without values has count and unique 0 and nulls.
    """
    names = list(columns or text_columns(frame))
    copies = (
        long_form(frame, names, "string")
        .groupBy("Column", "Value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return copies.unionByName(_named(frame, names), allowMissingColumns=True).groupBy("Column").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("count"),
        F.count("Value").alias("unique"),
        F.expr("min_by(Value, struct(-n, Value)) FILTER (WHERE n IS NOT NULL)").alias("top"),
        F.max("n").alias("freq"),
    )


def _named(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A row (Column) per name, so that columns without values are told of as well."""
    each = ", ".join(f"'{c}'" for c in columns)
    return frame.sparkSession.range(1).selectExpr(f"explode(array({each})) AS Column")


def duplicate_rows(frame: DataFrame) -> DataFrame:
    """How many rows repeat an earlier identical row; missing values count as equal.

    Rows are folded to 128 bits of hash first, so that what is shuffled for every row is
    its hash.  Only rows whose hash occurs again are compared whole.
    """
    missing = F.concat(*[F.col(f"`{c}`").isNull().cast("string") for c in frame.columns])
    values = [F.col(f"`{c}`") for c in frame.columns]
    hashed = frame.select(
        "*", F.xxhash64(missing, *values).alias("_a"), F.xxhash64(F.lit("second"), missing, *values).alias("_b")
    )
    again = hashed.groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_a", "_b")
    compared = hashed.join(again, ["_a", "_b"], "left_semi").groupBy("_a", "_b", *values)
    copies = compared.agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("DuplicateRows"))


def value_counts(frame: DataFrame, column: str, keep_null: bool = False) -> DataFrame:
    """Rows per value with their share of all rows; missing ones count in the whole."""
    counts = settle(frame.groupBy(column).agg(F.count(F.lit(1)).alias("n")))
    whole = counts.agg(F.sum("n")).scalar()
    shown = counts if keep_null else counts.filter(F.col(column).isNotNull())
    return shown.withColumn("n_pct", percent_of("n", whole)).orderBy(F.desc("n"), column)


def top_values(frame: DataFrame, column: str, top_n: int) -> DataFrame:
    """The most frequent values, the missing one among them."""
    counts = frame.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), column).limit(top_n)


def distinct_counts(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-null values per column; folded by value, so no set is held whole."""
    return (
        long_form(frame, columns, "string")
        .distinct()
        .unionByName(_named(frame, columns), allowMissingColumns=True)
        .groupBy("Column")
        .agg(F.count("Value").alias("DistinctValues"))
    )


def rows_at_extreme(frame: DataFrame, column: str, largest: bool) -> DataFrame:
    """All rows, ties included, that hold the smallest or the largest value."""
    extreme = frame.agg(F.max(column) if largest else F.min(column)).scalar()
    return frame.filter(F.col(column) == extreme)


def largest_by_size(frame: DataFrame, column: str, top_n: int, *ties: str) -> DataFrame:
    """Rows with the largest magnitude of ``column``."""
    return frame.orderBy(F.desc(F.abs(column)), *ties).limit(top_n)


# --- sales lines --------------------------------------------------------------------


def with_invoice_kind(lines: DataFrame) -> DataFrame:
    """Cancellation, other letters anywhere (a missing number too), or numbers only."""
    # The three texts.
    return lines.selectExpr(
        "*",
        f"""CASE WHEN {CANCELLED} THEN 'C-prefix (cancellation)'
                 WHEN InvoiceNo IS NULL OR InvoiceNo RLIKE '[A-Za-z]' THEN 'other-letter (non-sales)'
                 ELSE 'numeric-only (normal)' END AS inv_type""",
    )


def invoice_kinds(lines: DataFrame) -> DataFrame:
    return with_invoice_kind(lines).groupBy("inv_type").agg(F.count(F.lit(1)).alias("n"))


def missing_value_slices(lines: DataFrame) -> DataFrame:
    """Counts of the slices looked at for missing descriptions and customers."""
    slices = {
        "no_description": "Description IS NULL",
        "no_description_no_customer": "Description IS NULL AND CustomerID IS NULL",
        "no_description_but_customer": "Description IS NULL AND CustomerID IS NOT NULL",
        "no_description_but_price": "Description IS NULL AND UnitPrice > 0",
        "no_customer": "CustomerID IS NULL",
        "no_customer_but_price": "CustomerID IS NULL AND UnitPrice > 0",
        "no_customer_cancelled": f"CustomerID IS NULL AND {CANCELLED}",
        "no_customer_not_cancelled": f"CustomerID IS NULL AND NOT {CANCELLED}",
    }
    return lines.agg(*[F.expr(f"count_if({test})").alias(name) for name, test in slices.items()])


def free_items(lines: DataFrame) -> DataFrame:
    return lines.filter("Quantity > 0 AND UnitPrice = 0")


def free_item_summary(lines: DataFrame) -> DataFrame:
    return free_items(lines).agg(
        F.count(F.lit(1)).alias("FreeItems"),
        percent_of(F.expr("count_if(Description IS NULL)"), F.count(F.lit(1))).alias("NoDescription_pct"),
        percent_of(F.expr("count_if(CustomerID IS NULL)"), F.count(F.lit(1))).alias("NoCustomer_pct"),
    )


def negative_only(lines: DataFrame) -> DataFrame:
    """Lines that take stock back without being on a cancellation."""
    return lines.filter(f"Quantity <= 0 AND NOT {CANCELLED}")


def negative_only_summary(lines: DataFrame) -> DataFrame:
    """Is every such line free?  True as well when there is none."""
    return negative_only(lines).agg(
        F.count(F.lit(1)).alias("n"),
        F.expr("count_if(UnitPrice = 0)").alias("PriceZero"),
        F.expr("count_if(coalesce(UnitPrice <> 0, true))").alias("PriceNotZero"),
        F.expr("coalesce(bool_and(coalesce(UnitPrice = 0, false)), true)").alias("AllPriceZero"),
    )


def negative_and_cancelled(lines: DataFrame) -> DataFrame:
    negative = "coalesce(Quantity <= 0, false)"
    tests = {
        "Negative": negative,
        "Cancelled": CANCELLED,
        "Overlap": f"{negative} AND {CANCELLED}",
        "NegativeOnly": f"{negative} AND NOT {CANCELLED}",
        "CancelledOnly": f"NOT {negative} AND {CANCELLED}",
    }
    return lines.agg(*[F.expr(f"count_if({test})").alias(name) for name, test in tests.items()])


def out_of_range_rates(lines: DataFrame) -> DataFrame:
    """Lines without a positive quantity or price, as counts and percentages."""
    return lines.agg(
        F.expr("count_if(Quantity <= 0)").alias("NonPositiveQuantity"),
        percent_of(F.expr("count_if(Quantity <= 0)"), F.count(F.lit(1))).alias("NonPositiveQuantity_pct"),
        F.expr("count_if(UnitPrice <= 0)").alias("NonPositivePrice"),
        percent_of(F.expr("count_if(UnitPrice <= 0)"), F.count(F.lit(1))).alias("NonPositivePrice_pct"),
        F.expr("count_if(UnitPrice < 0)").alias("NegativePrice"),
    )


def price_bands(lines: DataFrame, high: float) -> DataFrame:
    return lines.agg(
        F.expr("count_if(UnitPrice <= 0)").alias("NotPriced"),
        F.expr(f"count_if(UnitPrice > 0 AND UnitPrice < {high})").alias("Usual"),
        F.expr(f"count_if(UnitPrice >= {high})").alias("High"),
    )


def guest_summary(lines: DataFrame) -> DataFrame:
    """Lines with and without a customer, and how many customers there are."""
    by_customer = lines.groupBy("CustomerID").agg(F.count(F.lit(1)).alias("n"))
    return by_customer.agg(
        F.sum("n").alias("Lines"),
        F.expr("coalesce(sum(IF(CustomerID IS NOT NULL, n, 0)), 0)").alias("WithCustomer"),
        F.expr("coalesce(sum(IF(CustomerID IS NULL, n, 0)), 0)").alias("Guests"),
        percent_of(F.expr("sum(IF(CustomerID IS NULL, n, 0))"), F.sum("n")).alias("Guests_pct"),
        F.count("CustomerID").alias("Customers"),
    )


def totals_by_product(lines: DataFrame, value: str, name: str) -> DataFrame:
    """Sum of an expression per description, returns included."""
    return (
        lines.filter("Description IS NOT NULL")
        .groupBy("Description")
        .agg(F.expr(value).alias(name))
    )


def codes_with_several_names(lines: DataFrame, at_least: int = 2) -> DataFrame:
    """Stock codes sold under several descriptions."""
    names = lines.filter("StockCode IS NOT NULL AND Description IS NOT NULL")
    return (
        names.select("StockCode", "Description")
        .distinct()
        .groupBy("StockCode")
        .agg(F.count(F.lit(1)).alias("Descriptions"))
        .filter(F.col("Descriptions") >= at_least)
    )


def names_of_such_codes(lines: DataFrame, at_least: int = 2) -> DataFrame:
    """Each such code with every description it has, a missing one among them.

    Lines fold to distinct (code, description) pairs before anything is joined.
    """
    pairs = settle(lines.filter("StockCode IS NOT NULL").select("StockCode", "Description").distinct())
    codes = codes_with_several_names(pairs, at_least)
    return pairs.join(codes, "StockCode", "left_semi").orderBy("StockCode", "Description")

"""Row selection, labels and small reshaping steps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def where_equal(frame: DataFrame, **wanted) -> DataFrame:
    """Rows that equal every given value.  A column the frame lacks holds no value."""
    for name, value in wanted.items():
        held = F.col(name) if name in frame.columns else F.lit(None)
        frame = frame.filter(held.eqNullSafe(F.lit(value)))
    return frame


def first_row_where(frame: DataFrame, condition: str, position: str) -> DataFrame:
    """The first row, by position, that meets a condition; all null when none does."""
    row = F.expr(f"min_by(struct(*), {position})")
    return frame.filter(condition).agg(row.alias("row")).select("row.*")


def with_label(
    frame: DataFrame, code: str, labels: Mapping, name: str, default: str = "Unknown"
) -> DataFrame:
    """Attach the label of a code from a fixed list, with a default for the rest."""
    pairs = [F.lit(part) for pair in labels.items() for part in pair]
    found = F.try_element_at(F.create_map(*pairs), F.col(code))
    return frame.withColumn(name, F.coalesce(found, F.lit(default)))


def with_lookup(
    frame: DataFrame, lookup: DataFrame, key: str, value: str, default
) -> DataFrame:
    """Attach ``value`` by key from another table, with a default for missing keys.

    The lookup has one row per key.  Spark broadcasts it when it is known to be small.
    """
    return frame.join(lookup.select(key, value), key, "left").withColumn(
        value, F.coalesce(F.col(value), F.lit(default))
    )


def steps(value: Column | str, limits: Sequence[tuple[float, object]], otherwise) -> Column:
    """The result of the first limit, in the given order, that ``value`` reaches."""
    column = F.col(value) if isinstance(value, str) else value
    result = F
    for limit, outcome in limits:
        result = result.when(column >= limit, F.lit(outcome))
    return result.otherwise(F.lit(otherwise))


# Spending tiers and discount steps, highest first.
TIERS = ((1000, "Gold"), (500, "Silver"))
DISCOUNTS = ((100, 0.10), (50, 0.05))


def with_tier(frame: DataFrame, spend: str) -> DataFrame:
    return frame.withColumn("tier", steps(spend, TIERS, "Bronze"))


def with_discount(frame: DataFrame, amount: str) -> DataFrame:
    return frame.withColumn("discount", steps(amount, DISCOUNTS, 0.0))


def customers_from_text(rows: DataFrame, column: str = "value") -> DataFrame:
    """Parse ``name,total_spend`` rows and attach the tier, highest spend first."""
    parts = rows.selectExpr(
        f"get(split({column}, ','), 0) AS name",
        f"try_cast(get(split({column}, ','), 1) AS double) AS total_spend",
    )
    return with_tier(parts, "total_spend").orderBy(F.desc("total_spend"), "name")


def with_tax(frame: DataFrame, amount: str, rate: float, vip_from: float) -> DataFrame:
    """The amount with tax, and whether the amount itself marks a large buyer."""
    return frame.withColumn("with_tax", F.col(amount) * (1 + rate)).withColumn(
        "is_vip", F.col(amount) >= vip_from
    )


def tidy(
    frame: DataFrame,
    drop: Sequence[str] = (),
    rename: Mapping[str, str] | None = None,
    cast: Mapping[str, str] | None = None,
) -> DataFrame:
    """Drop columns, rename, cast (unparsable is null), then drop repeated rows."""
    kept = frame.drop(*drop).withColumnsRenamed(dict(rename or {}))
    typed = kept.withColumns({c: F.col(c).try_cast(t) for c, t in (cast or {}).items()})
    return typed.dropDuplicates()


def conditional_summary(frame: DataFrame, condition: str, amount: str) -> DataFrame:
    """Rows that meet a condition and their total, next to all rows."""
    return frame.selectExpr(
        "count(*) AS all_rows",
        f"count_if({condition}) AS matching",
        f"double(sum(IF({condition}, cast({amount} AS decimal(24,6)), 0))) AS total",
    )


def any_and_all(frame: DataFrame, any_of: str, all_of: str, by: Sequence[str] = ()) -> DataFrame:
    """``any`` is false and ``all`` is true over no rows."""
    return frame.groupBy(*by).agg(
        F.expr(f"coalesce(bool_or({any_of}), false)").alias("has_any"),
        F.expr(f"coalesce(bool_and({all_of}), true)").alias("has_all"),
    )


def extremes_with_position(frame: DataFrame, value: str, position: str, by: Sequence[str] = ()) -> DataFrame:
    """Largest and smallest value with where each stands first."""
    return (
        frame.groupBy(*by)
        .agg(
            F.expr(f"max_by(struct({position}, {value}), struct({value}, -{position}))").alias("hi"),
            F.expr(f"min_by(struct({position}, {value}), struct({value}, {position}))").alias("lo"),
        )
        .select(
            *by,
            F.col(f"hi.{value}").alias("max_value"),
            F.col(f"hi.{position}").alias("max_position"),
            F.col(f"lo.{value}").alias("min_value"),
            F.col(f"lo.{position}").alias("min_position"),
        )
    )


def grid_counts(frame: DataFrame, values: Mapping[str, Sequence]) -> DataFrame:
    """Rows per combination of the listed values, combinations without rows included.

    The combinations come from the lists in the call, so there are as many as asked for.
    """
    combinations = frame.sparkSession.range(1)
    for name, listed in values.items():
        combinations = combinations.withColumn(name, F.explode(F.array(*map(F.lit, listed))))
    counts = frame.groupBy(*values).agg(F.count(F.lit(1)).alias("n"))
    return combinations.drop("id").join(counts, list(values), "left").fillna(0, ["n"])


def sample_rows(frame: DataFrame, key: str, size: int, seed: int) -> DataFrame:
    """``size`` rows without replacement; the same seed draws the same rows again."""
    ticket = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return frame.orderBy(ticket, key).limit(size)

"""Set and multiset operations between two frames with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def union_of(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right).distinct()


def intersection_of(left: DataFrame, right: DataFrame) -> DataFrame:
    """Values on both sides; rows fold before the shuffle, so no hot value is joined."""
    return _sides(left, right).filter("on_left AND on_right").drop("on_left", "on_right")


def difference_of(left: DataFrame, right: DataFrame) -> DataFrame:
    return _sides(left, right).filter("on_left AND NOT on_right").drop("on_left", "on_right")


def _sides(left: DataFrame, right: DataFrame) -> DataFrame:
    """Each value once with the sides it occurs on: one shuffle, folded on the map side."""
    tagged = left.withColumn("_l", F.lit(True)).withColumn("_r", F.lit(False)).unionByName(
        right.withColumn("_l", F.lit(False)).withColumn("_r", F.lit(True))
    )
    return tagged.groupBy(*left.columns).agg(
        F.bool_or("_l").alias("on_left"), F.bool_or("_r").alias("on_right")
    )


def symmetric_difference_of(left: DataFrame, right: DataFrame) -> DataFrame:
    return _sides(left, right).filter("on_left <> on_right").drop("on_left", "on_right")


def set_relations(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: is left within right, does it contain right, do they share nothing?"""
    return _sides(left, right).agg(
        F.expr("coalesce(bool_and(on_right OR NOT on_left), true)").alias("is_subset"),
        F.expr("coalesce(bool_and(on_left OR NOT on_right), true)").alias("is_superset"),
        F.expr("NOT coalesce(bool_or(on_left AND on_right), false)").alias("is_disjoint"),
    )


def concatenation_of(left: DataFrame, right: DataFrame) -> DataFrame:
    """All rows of both, repeats kept."""
    return left.unionByName(right)


def counts_of(frame: DataFrame, column: str) -> DataFrame:
    return frame.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def added_counts(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    both = counts_of(left, column).unionByName(counts_of(right, column))
    return both.groupBy(column).agg(F.sum("n").alias("n"))


def remaining_counts(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Counts of left less those of right; only what stays above zero is kept."""
    owed = counts_of(right, column).withColumn("n", -F.col("n"))
    both = counts_of(left, column).unionByName(owed)
    return both.groupBy(column).agg(F.sum("n").alias("n")).filter("n > 0")


def ordered_difference(left: DataFrame, right: DataFrame, key: str, position: str) -> DataFrame:
    """Rows of left whose key is not in right, in their order, repeats kept."""
    return left.join(right.select(key).distinct(), key, "left_anti").orderBy(position)

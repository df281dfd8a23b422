"""Comparing two sources by key, and layering one over another."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def reconcile(left: DataFrame, right: DataFrame, key: str, name: str) -> DataFrame:
    """Every key of either side with ``both`` or the side it is missing from.

    ``left`` holds (key, name) once per key; ``right`` may repeat its keys.
    """
    here = left.select(key, name).withColumn("_left", F.lit(True))
    there = right.select(key).distinct().withColumn("_right", F.lit(True))
    return here.join(there, key, "full_outer").select(
        key,
        # The name of an unknown key and the three findings.
        F.coalesce(F.col(name), F.lit("Unknown")).alias(name),
        F.expr(
            "CASE WHEN _right IS NULL THEN 'missing_from_billing' "
            "WHEN _left IS NULL THEN 'missing_from_crm' ELSE 'both' END"
        ).alias("issue"),
    )


def mismatches(left: DataFrame, right: DataFrame, key: str, name: str) -> DataFrame:
    return reconcile(left, right, key, name).filter("issue <> 'both'").orderBy("issue", key)


def layered(defaults: DataFrame, overrides: DataFrame, key: str, value: str) -> DataFrame:
    """Keys of both layers; where both hold a value the override wins."""
    over = overrides.select(key, F.col(value).alias("_over"))
    return defaults.select(key, value).join(over, key, "full_outer").select(
        key, F.coalesce("_over", value).alias(value)
    )

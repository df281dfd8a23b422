"""Question 1: revenue by market.  Input: cleaned lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlark.functions import MONEY, exact_sum, percent_of
from ledgerlark.operators.clean import HOME_COUNTRY
from ledgerlark.operators.ordered import in_global_order
from ledgerlark.operators.settle import settle


def uk_vs_others(lines: DataFrame) -> DataFrame:
    """Two rows: the home market, and everything else including unknown countries."""
    money = F.col("Revenue").cast(MONEY)
    totals = lines.agg(
        F.coalesce(F.sum(money), F.lit(0)).alias("everywhere"),
        F.coalesce(F.sum(F.when(F.col("Country") == HOME_COUNTRY, money)), F.lit(0)).alias("home"),
    )
    return totals.select(
        F.explode(
            F.array(
                F.struct(
                    F.lit(HOME_COUNTRY).alias("Label"), F.col("home").cast("double").alias("Revenue")
                ),
                F.struct(
                    F.lit("Other Countries").alias("Label"),
                    (F.col("everywhere") - F.col("home")).cast("double").alias("Revenue"),
                ),
            )
        ).alias("row")
    ).select("row.*")


def country_revenue(lines: DataFrame) -> DataFrame:
    """Markets abroad by revenue; the share is of all revenue, home market included."""
    # Unknown countries stay a group here, so the total over the groups is the full one.
    by_country = settle(lines.groupBy("Country").agg(exact_sum("Revenue").alias("Revenue")))
    everything = by_country.agg(exact_sum("Revenue")).scalar()
    return (
        by_country.filter(F.col("Country") != HOME_COUNTRY)
        .withColumn("RevenueShare_pct", percent_of("Revenue", everything))
        .orderBy(F.desc("Revenue"), "Country")
    )


def countries_in_place(lines: DataFrame) -> DataFrame:
    """Markets abroad with their place by revenue."""
    return in_global_order(settle(country_revenue(lines)), ["-Revenue", "Country"])

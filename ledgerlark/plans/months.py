"""Question 2: revenue by month.  Input: cleaned lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgerlark.functions import growth_rate
from ledgerlark.operators.grain import month_grain
from ledgerlark.operators.settle import settle


def monthly_revenue(lines: DataFrame) -> DataFrame:
    return month_grain(lines).select("YearMonth", "Revenue").orderBy("YearMonth")


def monthly_line_counts(lines: DataFrame) -> DataFrame:
    return month_grain(lines).select("YearMonth", "Lines").orderBy("YearMonth")


def monthly_revenue_with_partial_flag(lines: DataFrame) -> DataFrame:
    """Monthly revenue; the newest month is partial if its data stop before its end."""
    months = settle(month_grain(lines))
    newest = months.agg(F.max("YearMonth")).scalar()
    unfinished = (F.col("YearMonth") == newest) & (F.col("LastDay") < F.last_day("LastDay"))
    return months.select("YearMonth", "Revenue", unfinished.alias("is_partial")).orderBy("YearMonth")


def growth_between(monthly: DataFrame, first: str, last: str) -> DataFrame:
    """One row: growth of revenue from month ``first`` to month ``last``."""
    ends = monthly.filter(F.col("YearMonth").isin(first, last)).agg(
        F.max(F.when(F.col("YearMonth") == first, F.col("Revenue"))).alias("FirstRevenue"),
        F.max(F.when(F.col("YearMonth") == last, F.col("Revenue"))).alias("LastRevenue"),
    )
    return ends.withColumn("GrowthRate", growth_rate("LastRevenue", "FirstRevenue"))


def month_over_month(
    series: DataFrame, value: str = "Revenue", month: str = "YearMonth", by: str | None = None
) -> DataFrame:
    """Growth against the month before, per series.

    A series has one row per calendar month, so a window holds decades at most.
    """
    window = Window.partitionBy(by or F.col(month).isNull()).orderBy(month)
    previous = F.lag(value).over(window)
    return series.withColumn("Previous", previous).withColumn(
        "GrowthRate", growth_rate(F.col(value), F.col("Previous"))
    )

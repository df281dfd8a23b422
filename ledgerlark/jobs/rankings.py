"""Return on spend, growth, and work queues."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlark.functions import growth_rate
from ledgerlark.operators.sequences import numbered
from ledgerlark.operators.settle import settle


def with_roi(campaigns: DataFrame) -> DataFrame:
    """``(revenue - spend) / spend``; null when nothing was spent."""
    return campaigns.withColumn("roi", growth_rate("revenue", "spend"))


def roi_ranking(campaigns: DataFrame) -> DataFrame:
    """All campaigns, best first; those without spend come last."""
    ranked = numbered(settle(with_roi(campaigns)), ["roi IS NULL", "-roi", "name"])
    return ranked.select("rank", "name", "roi")


def roi_summary(campaigns: DataFrame) -> DataFrame:
    """One row: total spend and the best campaign."""
    return with_roi(campaigns).agg(
        F.expr("double(sum(cast(spend AS decimal(24,6))))").alias("total_spend"),
        F.expr("min_by(name, struct(-roi, name)) FILTER (WHERE roi IS NOT NULL)").alias("best"),
        F.max("roi").alias("best_roi"),
    )


def quarter_growth(quarters: DataFrame) -> DataFrame:
    """``current`` against ``previous``; null when there was nothing before."""
    return quarters.withColumn("growth", growth_rate("current", "previous"))


def work_queue(tickets: DataFrame, arrived: str, priority: str, cancelled: str) -> DataFrame:
    """Hand out the oldest ticket, drop the cancelled, order the rest by priority.

    Equal priorities keep their order of arrival.
    """
    oldest = tickets.agg(F.min(arrived)).scalar()
    waiting = tickets.filter(F.col(arrived) != oldest).filter(f"NOT coalesce({cancelled}, false)")
    return numbered(settle(waiting), [priority, arrived], number="place")

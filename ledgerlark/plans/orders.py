"""Question 4: order sizes.  Input: the invoice grain, settled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerlark.functions import MONEY, half_even, percent_of
from ledgerlark.operators.grain import invoice_grain
from ledgerlark.operators.ordered import in_global_order, ordered_values, quantiles_of_ordered
from ledgerlark.operators.settle import settle

# The order sizes the report asks about.
ORDER_THRESHOLDS = (500, 1_000, 5_000, 10_000)
PERCENTILE_LADDER = (50, 75, 90, 95, 99, 99.9)


def invoices_of(lines: DataFrame) -> DataFrame:
    return settle(invoice_grain(lines))


def order_values(invoices: DataFrame) -> DataFrame:
    """All orders, largest first, with their place."""
    return in_global_order(invoices, ["-OrderValue", "InvoiceNo"])


def largest_orders(invoices: DataFrame, top_n: int = 10) -> DataFrame:
    return invoices.orderBy(F.desc("OrderValue"), "InvoiceNo").limit(top_n)


def large_order_impact(
    invoices: DataFrame, thresholds: Sequence[int] = ORDER_THRESHOLDS
) -> DataFrame:
    """How many orders lie strictly above each threshold and what they bring in.

    All thresholds are counted in one pass over the invoices.
    """
    value = F.col("OrderValue").cast(MONEY)
    sums = []
    for i, threshold in enumerate(thresholds):
        above = F.col("OrderValue") > threshold
        sums.append(F.count_if(above).alias(f"n{i}"))
        sums.append(F.coalesce(F.sum(F.when(above, value)), F.lit(0)).cast("double").alias(f"r{i}"))
    totals = invoices.agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).cast("double").alias("r"), *sums
    )
    rows = [
        F.struct(
            F.lit(threshold).alias("Threshold"),
            F.col(f"n{i}").alias("OrderCount"),
            percent_of(f"n{i}", "n").alias("OrderPct"),
            half_even(f"r{i}", 2).alias("Revenue"),
            percent_of(f"r{i}", "r").alias("RevenuePct"),
        )
        for i, threshold in enumerate(thresholds)
    ]
    return totals.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def order_value_ladder(
    invoices: DataFrame, percentiles: Sequence[float] = PERCENTILE_LADDER
) -> DataFrame:
    """One row per percentile of the order value."""
    names = {f"p{i}": percentile / 100 for i, percentile in enumerate(percentiles)}
    row = quantiles_of_ordered(ordered_values(invoices, "OrderValue"), names)
    return row.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(float(percentile)).alias("Percentile"), F.col(f"p{i}").alias("OrderValue")
                    )
                    for i, percentile in enumerate(percentiles)
                ]
            )
        ).alias("row")
    ).select("row.*")

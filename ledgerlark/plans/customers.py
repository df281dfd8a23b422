"""Question 5: customer value.  Input: visits and the customer grain, settled."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlark.functions import MONEY, exact_sum, percent_of
from ledgerlark.operators.grain import customer_grain, visit_grain
from ledgerlark.operators.ordered import in_order, medians_of
from ledgerlark.operators.settle import settle


def visits_of(lines: DataFrame) -> DataFrame:
    """Revenue per customer, invoice and month: what all customer questions start from."""
    return settle(visit_grain(lines))


def customers_of(visits: DataFrame) -> DataFrame:
    """The customer profile: CustomerID, TotalRevenue, OrderCount."""
    return settle(customer_grain(visits))


def customer_value(customers: DataFrame, top_n: int = 20) -> DataFrame:
    return (
        customers.withColumn("AvgOrderValue", F.try_divide("TotalRevenue", "OrderCount"))
        .orderBy(F.desc("TotalRevenue"), "CustomerID")
        .limit(top_n)
    )


def flag_vip(customers: DataFrame) -> DataFrame:
    """VIPs lie strictly above the median in both revenue and orders."""
    middle_revenue, middle_orders = medians_of(customers, "TotalRevenue", "OrderCount")
    return customers.withColumn(
        "is_vip",
        (F.col("TotalRevenue") > middle_revenue) & (F.col("OrderCount") > middle_orders),
    )


def vip_ids(customers: DataFrame) -> DataFrame:
    return flag_vip(customers).filter("is_vip").select("CustomerID")


def customer_pareto(customers: DataFrame) -> DataFrame:
    """One row: customers, how many make up the top fifth (at least 1), their share."""
    n = customers.agg(F.count(F.lit(1)).cast("bigint")).scalar()
    ranked = in_order(
        customers.select("CustomerID", "TotalRevenue"),
        ["-TotalRevenue", "CustomerID"],
        number="customer_rank",
    )
    cut = F.greatest(F.lit(1), F.floor(n * F.lit(0.2)).cast("bigint"))
    money = F.col("TotalRevenue").cast(MONEY)
    totals = ranked.select("TotalRevenue", "customer_rank", n.alias("n"), cut.alias("cut")).agg(
        F.coalesce(F.max("n"), F.lit(0)).alias("total_customers"),
        F.max("cut").alias("top_20pct_n"),
        F.sum(F.when(F.col("customer_rank") <= F.col("cut"), money)).alias("top"),
        F.sum(money).alias("whole"),
    )
    return totals.select(
        "total_customers", "top_20pct_n", percent_of("top", "whole", 1).alias("top_20pct_revenue_share")
    )


def lines_of_vips(lines: DataFrame, vips: DataFrame) -> DataFrame:
    return lines.join(vips, "CustomerID", "left_semi")


def lines_of_others(lines: DataFrame, vips: DataFrame) -> DataFrame:
    """Lines of known customers who are not VIPs."""
    return lines.filter(F.col("CustomerID").isNotNull()).join(vips, "CustomerID", "left_anti")


def vip_months(visits: DataFrame, flagged: DataFrame) -> DataFrame:
    """Monthly revenue of VIPs, of the others and of all; null where a series has none.

    Visits are folded per (customer, month) before the VIP flag is joined, so the join
    carries at most one row per customer and month.  ``flagged`` comes from ``flag_vip``.
    """
    flags = flagged.select("CustomerID", "is_vip")
    vip, value = F.col("is_vip"), F.col("Revenue")
    return (
        visits.filter("YearMonth IS NOT NULL")
        .groupBy("CustomerID", "YearMonth")
        .agg(exact_sum("Revenue").alias("Revenue"))
        .join(flags, "CustomerID")
        .groupBy("YearMonth")
        .agg(
            exact_sum(F.when(vip, value)).alias("vip"),
            exact_sum(F.when(~vip, value)).alias("non_vip"),
            exact_sum(value).alias("everyone"),
        )
    )


def normalised(months: DataFrame, series: list[str]) -> DataFrame:
    """Scale each series to 0 (its lowest month) .. 100 (its highest); a flat one is 0."""
    scaled = months
    for name in series:
        low = months.agg(F.min(name)).scalar()
        high = months.agg(F.max(name)).scalar()
        spread = high - low
        scaled = scaled.withColumn(
            f"{name}_norm",
            F.when(spread > 0, (F.col(name) - low) / spread * 100).otherwise(F.col(name) * 0),
        )
    return scaled


def vip_season(visits: DataFrame, customers: DataFrame, against: str = "non_vip") -> DataFrame:
    """VIPs against the others (or ``everyone``) by month, each series scaled to 0..100.

    Each month also carries the number of VIPs, which the chart names in its legend.
    """
    flagged = flag_vip(customers)
    months = settle(vip_months(visits, flagged))
    n_vips = flagged.agg(F.count_if("is_vip")).scalar()
    return (
        normalised(months, ["vip", against])
        .select("YearMonth", "vip_norm", f"{against}_norm", n_vips.alias("VIPs"))
        .orderBy("YearMonth")
    )

"""The data behind each chart.  Drawing is left to the reader's tool."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlark.functions import MONEY, exact_sum, percent_of
from ledgerlark.operators.ordered import (
    in_global_order, medians_of, ordered_values, quantiles_of_ordered, top_in_place,
)
from ledgerlark.operators.settle import settle
from ledgerlark.plans.products import pareto_curve, pareto_summary

# Quadrant names, keyed by (high revenue, high frequency).
PRODUCT_QUADRANTS = {
    (True, True): "Star Product",
    (True, False): "Niche / Premium",
    (False, True): "Low-price Popular",
    (False, False): "General",
}
CUSTOMER_QUADRANTS = {
    (True, True): "VIP",
    (True, False): "Big Spender",
    (False, True): "Loyal Small Buyer",
    (False, False): "Casual",
}


def donut(shares: DataFrame, value: str = "Revenue") -> DataFrame:
    """Two labelled amounts with their share in percent."""
    shares = settle(shares)
    whole = shares.agg(exact_sum(value)).scalar()
    return shares.withColumn("Share_pct", percent_of(value, whole, 1))


def country_bars(country_revenue: DataFrame) -> DataFrame:
    """Markets from the bottom bar up, with their place.  Input: settled."""
    return in_global_order(country_revenue, ["Revenue", "Country"])


def pareto_plot(products: DataFrame) -> DataFrame:
    """The leading part of the Pareto curve that is drawn."""
    curve = settle(pareto_curve(products))
    shown = pareto_summary(products, curve=curve).select("PlottedProducts").scalar()
    return curve.filter(F.col("product_rank") <= shown).select(
        "Description", "Revenue", "cumulative_pct", "product_rank"
    )


def top_product_bars(top_products: DataFrame) -> DataFrame:
    label = F.format_string("Freq Rank: #%d", "FrequencyRank")
    return top_in_place(
        top_products.select("Description", "Revenue", label.alias("Label")), ["Revenue", "Description"]
    )


def top_customer_bars(top_customers: DataFrame) -> DataFrame:
    bars = top_customers.select(
        F.col("CustomerID").cast("string").alias("Customer"),
        "TotalRevenue",
        F.format_string("%d orders", "OrderCount").alias("Label"),
    )
    return top_in_place(bars, ["TotalRevenue", "Customer"])


def _quadrant(high_revenue: Column, often: Column, names: dict) -> Column:
    return (
        F.when(high_revenue & often, names[True, True])
        .when(high_revenue, names[True, False])
        .when(often, names[False, True])
        .otherwise(names[False, False])
    )


def _quadrants(frame, key, revenue, frequency, names, top_n):
    """High means strictly above the median, on both axes."""
    middle_revenue, middle_frequency = medians_of(frame, revenue, frequency)
    high, often = F.col(revenue) > middle_revenue, F.col(frequency) > middle_frequency
    place = F.struct((-F.col(revenue)).alias("r"), F.col(key).alias("k"))
    last = frame.orderBy(F.desc(revenue), key).limit(top_n).agg(F.max(place)).scalar()
    return frame.withColumn("Segment", _quadrant(high, often, names)).withColumn(
        "is_top", F.coalesce(place <= last, F.lit(False))
    )


def product_segments(products: DataFrame, top_n: int = 5) -> DataFrame:
    marked = _quadrants(
        products, "Description", "Revenue", "Frequency", PRODUCT_QUADRANTS, top_n
    )
    return marked.select(
        "Description",
        "Revenue",
        "Frequency",
        "Segment",
        "is_top",
        F.when(F.col("is_top"), F.substring("Description", 1, 25)).alias("Label"),
    )


def customer_segments(customers: DataFrame, top_n: int = 10) -> DataFrame:
    marked = _quadrants(
        customers, "CustomerID", "TotalRevenue", "OrderCount", CUSTOMER_QUADRANTS, top_n
    )
    return marked.select(
        "CustomerID",
        "TotalRevenue",
        "OrderCount",
        "Segment",
        "is_top",
        F.when(F.col("is_top"), F.concat(F.lit("ID "), F.col("CustomerID").cast("string"))).alias(
            "Label"
        ),
    )


def leading_products(products: DataFrame, top_n: int = 5) -> DataFrame:
    """Top products among those at or above the median on both axes."""
    middle_revenue, middle_frequency = medians_of(products, "Revenue", "Frequency")
    return (
        products.filter(
            (F.col("Frequency") >= middle_frequency) & (F.col("Revenue") >= middle_revenue)
        )
        .orderBy(F.desc("Revenue"), "Description")
        .limit(top_n)
        .select("Description", "Revenue", "Frequency", F.substring("Description", 1, 35).alias("Label"))
    )


def drawn_values(values: DataFrame) -> tuple[DataFrame, Column]:
    """Values up to the 99th percentile, and that percentile.

    The rest is left out of the picture only.  ``values`` comes from ``ordered_values``.
    """
    p99 = settle(quantiles_of_ordered(values, {"p99": 0.99})).scalar()
    return values.filter(F.col("value") <= p99), p99


def histogram(
    frame: DataFrame, value: str, bins: int = 60, values: DataFrame | None = None
) -> DataFrame:
    """Equal-width bins over [min, max] of the rows up to p99; empty bins are kept.

    The last bin holds its upper edge.  If all values are equal the range is widened
    by one half on each side.  ``values`` is the column by ``ordered_values`` if that is at
    hand, here and below.
    """
    kept, _ = drawn_values(ordered_values(frame, value) if values is None else values)
    ends = settle(
        kept.agg(F.min("value").alias("lo"), F.max("value").alias("hi")).select(
            F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        )
    )
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    position = F.floor((F.col("value") - lo) / (hi - lo) * bins)
    counts = kept.groupBy(F.least(position, F.lit(bins - 1)).cast("int").alias("Bin")).agg(
        F.sum("copies").alias("n")
    )
    edges = ends.select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("Bin"), "lo", "hi"
    ).filter(F.col("lo").isNotNull())
    width = (F.col("hi") - F.col("lo")) / bins
    return edges.join(counts, "Bin", "left").select(
        "Bin",
        (F.col("lo") + width * F.col("Bin")).alias("BinStart"),
        (F.col("lo") + width * (F.col("Bin") + 1)).alias("BinEnd"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def histogram_marks(frame: DataFrame, value: str, values: DataFrame | None = None) -> DataFrame:
    """One row: the p99 cut, and count, median and mean of the rows drawn."""
    values = ordered_values(frame, value) if values is None else values
    kept, p99 = drawn_values(values)
    money = F.col("value").cast(MONEY) * F.col("copies").cast("decimal(12,0)")
    total = values.agg(F.coalesce(F.max("upto"), F.lit(0))).scalar()
    median = quantiles_of_ordered(kept, {"median": 0.5}).scalar()
    drawn = kept.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("Drawn"), F.sum(money).cast("double").alias("whole")
    )
    return drawn.select(
        p99.alias("P99"),
        "Drawn",
        (total - F.col("Drawn")).alias("LeftOut"),
        median.alias("Median"),
        F.try_divide("whole", "Drawn").alias("Mean"),
    )


def _box(values: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Values up to p99, and one row: the quartiles of the rows that hold them and the fences.

    The fences lie 1.5 box lengths outside the box.
    """
    kept, _ = drawn_values(values)
    quartiles = quantiles_of_ordered(kept, {"Q1": 0.25, "Median": 0.5, "Q3": 0.75})
    reach = (F.col("Q3") - F.col("Q1")) * 1.5
    return kept, settle(quartiles.select("*", (F.col("Q1") - reach).alias("Low"), (F.col("Q3") + reach).alias("High")))


def box_plot(frame: DataFrame, value: str, values: DataFrame | None = None) -> DataFrame:
    """One row: quartiles of the rows up to p99, whiskers and number of outliers.

    A whisker ends at the furthest value within the fences, and never inside the box.
    """
    kept, box = _box(ordered_values(frame, value) if values is None else values)
    low, high = box.select("Low").scalar(), box.select("High").scalar()
    inside = F.col("value").between(low, high)
    ends = kept.select("copies", "value", inside.alias("inside")).agg(
        F.min(F.when(F.col("inside"), F.col("value"))).alias("low_end"),
        F.max(F.when(F.col("inside"), F.col("value"))).alias("high_end"),
        F.coalesce(F.sum(F.when(~F.col("inside"), F.col("copies"))), F.lit(0)).alias("Outliers"),
    )
    q1, q2, q3 = (box.select(q).scalar() for q in ("Q1", "Median", "Q3"))
    return ends.select(
        q1.alias("Q1"),
        q2.alias("Median"),
        q3.alias("Q3"),
        F.least("low_end", q1).alias("WhiskerLow"),
        F.greatest("high_end", q3).alias("WhiskerHigh"),
        "Outliers",
    )


def box_plot_outliers(
    frame: DataFrame, key: str, value: str, values: DataFrame | None = None
) -> DataFrame:
    """The rows drawn as single points."""
    values = ordered_values(frame, value) if values is None else values
    kept, box = _box(values)
    low, high = box.select("Low").scalar(), box.select("High").scalar()
    most = kept.agg(F.max("value")).scalar()
    outside = (F.col(value) < low) | (F.col(value) > high)
    return frame.filter((F.col(value) <= most) & outside).select(key, value)

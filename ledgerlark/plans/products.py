"""Question 3: products.  Input: the product grain, settled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlark.functions import MONEY, exact_sum
from ledgerlark.operators.grain import product_grain
from ledgerlark.operators.ordered import in_order, tied_ranks
from ledgerlark.operators.settle import settle

# Words that make a product name look like a charge, in any case.
CHARGE_WORDS = (
    "postage", "manual", "amazon", "fee", "discount",
    "sample", "bank", "voucher", "carriage", "adjust",
)


def products_of(lines: DataFrame) -> DataFrame:
    return settle(product_grain(lines))


def top_products(products: DataFrame, top_n: int = 20) -> DataFrame:
    """Best sellers by revenue, with their rank by number of lines among all products."""
    return (
        _with_frequency_rank(products)
        .select("Description", "Revenue", "FrequencyRank")
        .orderBy(F.desc("Revenue"), "Description")
        .limit(top_n)
    )


def frequency_ranks(products: DataFrame) -> DataFrame:
    return _with_frequency_rank(products).select("Description", "Lines", "FrequencyRank")


def _with_frequency_rank(products: DataFrame) -> DataFrame:
    named = products.select("Description", "Revenue", "Lines")
    return tied_ranks(named, ["-Lines"], ["Description"], "FrequencyRank")


def top_by_frequency(products: DataFrame, top_n: int = 20) -> DataFrame:
    return (
        products.select("Description", "Lines").orderBy(F.desc("Lines"), "Description").limit(top_n)
    )


def pareto_curve(products: DataFrame, ranges: int | None = None) -> DataFrame:
    """Every product with its rank by revenue and the revenue up to and including it."""
    n = products.agg(F.count(F.lit(1))).scalar()
    total = products.agg(exact_sum("Revenue")).scalar()
    ordered = in_order(
        products.select("Description", "Revenue"),
        ["-Revenue", "Description"],
        running={"cumulative_revenue": ("sum", "Revenue")},
        number="product_rank",
        ranges=ranges,
        exact=MONEY,
    )
    return ordered.select(
        "Description",
        "Revenue",
        "cumulative_revenue",
        (F.try_divide(F.col("cumulative_revenue"), total) * 100).alias("cumulative_pct"),
        "product_rank",
        (F.try_divide(F.col("product_rank"), n) * 100).alias("product_pct"),
    )


def pareto(products: DataFrame) -> DataFrame:
    return pareto_curve(products).select("Description", "Revenue", "cumulative_pct")


def fifth_of(n: Column) -> Column:
    """Twenty percent of ``n`` rows, cut down to a whole number."""
    return F.floor(n * F.lit(0.2)).cast("bigint")


def top_fifth(products: DataFrame) -> DataFrame:
    n = products.agg(F.count(F.lit(1))).scalar()
    return pareto_curve(products).filter(F.col("product_rank") <= fifth_of(n))


def suspicious_names(products: DataFrame) -> DataFrame:
    """Products of the top fifth whose name contains a charge word, in any case."""
    pattern = "(?i)" + "|".join(CHARGE_WORDS)
    return top_fifth(products).filter(F.col("Description").rlike(pattern))


def pareto_summary(
    products: DataFrame, plot_margin: float = 1.2, curve: DataFrame | None = None
) -> DataFrame:
    """The 80/20 check in one row, with how many products the curve shows.

    With fewer than five products the top fifth is one product.
    """
    curve = pareto_curve(products) if curve is None else curve
    n = products.agg(F.count(F.lit(1)).cast("bigint")).scalar()
    cut = F.greatest(F.lit(1), fifth_of(n))
    rank, reached = F.col("product_rank"), F.col("cumulative_pct")
    marks = curve.select("product_rank", "cumulative_pct", n.alias("n"), cut.alias("cut")).agg(
        F.max("n").alias("TotalProducts"),
        F.max("cut").alias("TopFifthCount"),
        F.max(F.when(rank == F.col("cut"), reached)).alias("TopFifthShare_pct"),
        F.min(F.when(reached >= 80, rank)).alias("ProductsFor80"),
    )
    n80, all_n = F.col("ProductsFor80"), F.col("TotalProducts")
    return marks.select(
        "TotalProducts",
        "TopFifthCount",
        "TopFifthShare_pct",
        "ProductsFor80",
        (n80 / all_n * 100).alias("ProductsFor80_pct"),
        F.least(
            all_n,
            F.greatest(F.floor(all_n * F.lit(0.3)), F.floor(n80 * F.lit(plot_margin))),
        )
        .cast("bigint")
        .alias("PlottedProducts"),
        (F.col("TopFifthShare_pct") >= 80).alias("StrictPareto"),
    )


def product_scatter(products: DataFrame) -> DataFrame:
    return products.select("Description", "Revenue", "Frequency")

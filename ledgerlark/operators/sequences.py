"""Order-dependent operators on long sequences, per key or overall.

A key may hold a large share of all rows; every step works on ranges of the full sort
order or on blocks of bounded length, never on all rows of one key in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ledgerlark.operators.ordered import in_order, overlapping_blocks, runs_in_order
from ledgerlark.operators.settle import settle


def sliding_windows(
    frame: DataFrame,
    key: str,
    order_by: Sequence[str],
    value: str,
    length: int,
    ranges: int | None = None,
    block_rows: int = 10_000,
) -> DataFrame:
    """Every full run of ``length`` consecutive values per key, by first position."""
    numbered = in_order(frame, order_by, [key], number="position", ranges=ranges)
    blocks = overlapping_blocks(
        numbered.select(key, "position", value), "position", length - 1, max(block_rows, length - 1)
    )
    ahead = Window.partitionBy(key, "block").orderBy("position").rowsBetween(0, length - 1)
    return (
        blocks.withColumn("window", F.collect_list(value).over(ahead))
        .filter((F.size("window") == length) & F.col("at_home"))
        .select(key, "position", "window")
    )


def running_values(
    frame: DataFrame, key: str, order_by: Sequence[str], value: str, ranges: int | None = None
) -> DataFrame:
    """Running sum, maximum and product of a column per key."""
    return in_order(
        frame,
        order_by,
        [key],
        running={
            "running_sum": ("sum", value),
            "running_max": ("max", value),
            "running_product": ("product", value),
        },
        number="position",
        ranges=ranges,
    )


def consecutive_runs(
    frame: DataFrame, key: str, order_by: Sequence[str], value: str, ranges: int | None = None
) -> DataFrame:
    """Adjacent equal values per key as one row: value, length, first position."""
    return runs_in_order(frame, order_by, [key], value, ranges).select(key, value, "first_position", "length")


def first_seen(frame: DataFrame, key: str, position: str) -> DataFrame:
    """Each key once, in the order in which it first occurs."""
    return frame.groupBy(key).agg(F.min(position).alias("first_position")).orderBy("first_position")


def most_common(frame: DataFrame, value: str, position: str, top_n: int) -> DataFrame:
    """The most frequent values; of equal ones, the one seen first comes first."""
    counts = frame.groupBy(value).agg(
        F.count(F.lit(1)).alias("n"), F.min(position).alias("first_position")
    )
    return counts.orderBy(F.desc("n"), "first_position").limit(top_n).select(value, "n")


def numbered(
    frame: DataFrame, order_by: Sequence[str], number: str = "rank", ranges: int | None = None
) -> DataFrame:
    """1-based numbers in the given order."""
    return in_order(frame, order_by, number=number, ranges=ranges)


def shuffled(frame: DataFrame, key: str, seed: int, ranges: int | None = None) -> DataFrame:
    """A repeatable random order, as a position column."""
    ticket = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    drawn = frame.withColumn("_ticket", ticket)
    return in_order(
        drawn, ["_ticket", key], number="position", ranges=ranges
    ).drop("_ticket")


def grouped_members(
    frame: DataFrame,
    key: str,
    member: str,
    page_rows: int = 1_000,
    ranges: int | None = None,
) -> DataFrame:
    """The distinct members of each key as sorted lists.

    A key with more than ``page_rows`` members continues on further pages, so all
    members are kept and no list outgrows a task.
    """
    members = settle(frame.select(key, member).filter(F.col(member).isNotNull()).distinct())
    placed = in_order(members, [member], [key], number="_no", ranges=ranges)
    page = F.floor((F.col("_no") - 1) / page_rows).cast("int")
    return placed.groupBy(key, page.alias("page")).agg(
        F.sort_array(F.collect_list(member)).alias("members")
    )


def pair_counts(
    baskets: DataFrame,
    basket: str,
    item: str,
    ordered: bool = False,
    min_baskets: int = 1,
    block_items: int = 500,
) -> DataFrame:
    """In how many baskets two different items occur together, if in ``min_baskets`` or more.

    An item in fewer baskets cannot be in such a pair and is left out first.  The items
    of a basket are cut into blocks of about ``block_items``, and pairs are formed between
    two blocks at a time, so no basket has to fit into one row or task.  Baskets of one
    block fold to their set of items, and equal sets are counted once.
    """
    held = baskets.filter(F.col(item).isNotNull()).select(
        F.col(basket).alias("_basket"), F.col(item).alias("_item")
    ).distinct()
    if min_baskets > 1:
        often = held.groupBy("_item").count().filter(F.col("count") >= min_baskets).select("_item")
        held = held.join(often, "_item", "left_semi")
    large = held.groupBy("_basket").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > block_items)
    large = large.select(F.col("_basket").alias("_large"), F.ceil(F.col("_n") / block_items).alias("_blocks"))
    placed = held.join(large, F.col("_basket").eqNullSafe(F.col("_large")) & F.col("_blocks").isNotNull(), "left")
    block = F.pmod(F.xxhash64("_item"), F.coalesce("_blocks", F.lit(1)))
    lists = placed.groupBy("_basket", "_blocks", block.alias("_block")).agg(
        F.sort_array(F.collect_list("_item")).alias("items")
    )
    sets = lists.filter("_blocks IS NULL").groupBy("items").agg(F.count(F.lit(1)).alias("n"))
    small = sets.selectExpr("n", "items", "posexplode(items) AS (i, a)").selectExpr(
        "a", "explode(slice(items, i + 2, size(items))) AS b", "n"
    )
    met = lists.filter("_blocks IS NOT NULL").selectExpr(
        "_basket", "_block", "items", "explode(sequence(0, _blocks - 1)) AS other"
    ).selectExpr("_basket", "least(_block, other) AS i", "greatest(_block, other) AS j", "_block", "items")
    two = met.groupBy("_basket", "i", "j").agg(
        F.min_by("items", "_block").alias("first"), F.max_by("items", "_block").alias("second")
    )
    wide = two.selectExpr("i", "j", "second", "explode(first) AS x").selectExpr(
        "i", "j", "x", "explode(second) AS y"
    ).filter("i < j AND x <> y OR x < y").selectExpr("least(x, y) AS a", "greatest(x, y) AS b", "1 AS n")
    pairs = small.unionByName(wide).groupBy("a", "b").agg(F.sum("n").alias("n"))
    pairs = pairs.filter(F.col("n") >= min_baskets)
    if ordered:
        pairs = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "n"))
    return pairs

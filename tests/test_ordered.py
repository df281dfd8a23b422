import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from ledgerlark.functions import MONEY
from ledgerlark.operators.ordered import (
    RANGE, exact_quantiles, in_global_order, in_order, medians_of, ordered_values, quantiles_of_ordered,
    spread_in_order, tied_ranks, top_in_place,
)
from ledgerlark.operators import profile, sequences


@pytest.fixture(scope="module")
def skewed(spark):
    """2,000 rows; one key holds half, many values are equal."""
    draw = random.Random(5)
    data = [
        (i, "hot" if draw.random() < 0.5 else f"k{draw.randrange(20)}", float(draw.choice([1, 1, 1, 2, 3.25, 7])))
        for i in range(2000)
    ]
    data += [(2000, None, 4.0), (2001, None, 5.0)]
    return spark.createDataFrame(data, "id bigint, key string, v double").cache()


@pytest.mark.parametrize("ranges", [2, 3, 16, 64])
def test_global_order_equals_one_window(skewed, ranges):
    got = in_order(skewed, ["-v", "id"], running={"s": ("sum", "v")}, ranges=ranges)
    w = Window.orderBy(F.desc("v"), "id").rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.select(
        "id", "key", "v", F.row_number().over(Window.orderBy(F.desc("v"), "id")).cast("bigint").alias("row_no"),
        F.sum(F.col("v").cast(MONEY)).over(w).cast("double").alias("s"),
    )
    assert got.exceptAll(want.select(got.columns)).count() == 0 and got.count() == 2002


@pytest.mark.parametrize("ranges", [2, 16, 64])
def test_order_per_key_with_a_hot_key_and_missing_keys(skewed, ranges):
    kinds = {"s": ("sum", "v"), "hi": ("max", "v"), "lo": ("min", "v")}
    got = in_order(skewed, ["id"], ["key"], running=kinds, ranges=ranges)
    by = Window.partitionBy("key").orderBy("id")
    w = by.rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.select(
        "id", "key", "v", F.row_number().over(by).cast("bigint").alias("row_no"),
        F.sum(F.col("v").cast(MONEY)).over(w).cast("double").alias("s"),
        F.max("v").over(w).alias("hi"), F.min("v").over(w).alias("lo"),
    )
    assert got.exceptAll(want.select(got.columns)).count() == 0


def test_ranges_hold_a_share_of_a_hot_key_each(skewed):
    sizes = [r["count"] for r in spread_in_order(skewed, ["id"], ["key"], ranges=16).groupBy(RANGE).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2002 / 16 * 3


def test_order_of_an_empty_frame(skewed):
    assert in_order(skewed.limit(0), ["v", "id"], running={"s": ("sum", "v")}).count() == 0


@pytest.mark.parametrize("ranges", [2, 3, 16, 64])
def test_ranks_share_the_lowest_rank_over_range_borders(spark, skewed, ranges):
    frame = spark.createDataFrame([("a", 5), ("b", 3), ("c", 3), ("d", 3), ("e", 1)], "k string, n bigint")
    got = tied_ranks(frame, ["-n"], ["k"], ranges=ranges)
    assert sorted((r.k, r.rank) for r in got.collect()) == [("a", 1), ("b", 2), ("c", 2), ("d", 2), ("e", 5)]
    # 1.0 is half of all rows, so its rank is carried over many ranges; null keys come first.
    for order in (["v"], ["-v"], ["key", "v"]):
        got = tied_ranks(skewed, order, ["id"], ranges=ranges)
        want = skewed.select("*", F.rank().over(Window.orderBy(*[F.expr(e) for e in order])).cast("bigint").alias("rank"))
        assert got.count() == 2002 and got.exceptAll(want).count() == 0
    assert tied_ranks(skewed.limit(0), ["v"], ["id"]).count() == 0


def test_ranks_join_nothing_on_the_ranked_value(spark, skewed):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = tied_ranks(skewed, ["-v"], ["id"], ranges=9)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin [_range") == 1


def test_quantiles_of_a_part_need_no_new_order(spark, skewed):
    pandas = skewed.toPandas()["v"]
    values = ordered_values(skewed, "v", ranges=5)
    assert [tuple(r) for r in values.orderBy("value").tail(1)] == [(7.0, int((pandas == 7).sum()), 2002)]
    part = pandas[pandas <= 3.25]
    got = quantiles_of_ordered(values.filter("value <= 3.25"), {"a": 0.25, "b": 0.6, "c": 0.99, "d": 1.0}).first()
    assert list(got) == [part.quantile(p) for p in (0.25, 0.6, 0.99, 1.0)]
    assert list(quantiles_of_ordered(values.limit(0), {"a": 0.5}).first()) == [None]


@pytest.mark.parametrize("n", [1, 2, 5, 1000])
def test_quantiles_equal_the_array_library(spark, n):
    draw = random.Random(n)
    values = [draw.choice([1.5, 2.25, 100.0]) if draw.random() < 0.4 else draw.uniform(0, 50) for _ in range(n)]
    frame = spark.createDataFrame([(v,) for v in values], "v double").unionByName(
        spark.createDataFrame([(None,)], "v double")
    )
    p = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.99, "e": 0.999, "f": 1.0}
    got = exact_quantiles(frame, "v", p, ranges=7).first()
    np.testing.assert_allclose(list(got), np.quantile(values, list(p.values())), rtol=1e-12)


def test_quantiles_per_group_and_medians_together(skewed):
    pandas = skewed.filter("key IS NOT NULL").toPandas()
    got = {r.key: r.m for r in exact_quantiles(skewed.filter("key IS NOT NULL"), "v", {"m": 0.75}, by=["key"], ranges=5).collect()}
    assert got == pandas.groupby("key")["v"].quantile(0.75).to_dict()
    v, i = medians_of(skewed, "v", "id", ranges=4)
    everything = skewed.toPandas()
    assert tuple(skewed.limit(1).select(v, i).first()) == (everything["v"].median(), everything["id"].median())


@pytest.mark.parametrize("block_rows", [2, 7, 10_000])
def test_sliding_windows_cross_blocks(skewed, block_rows):
    got = sequences.sliding_windows(skewed, "key", ["id"], "id", 3, ranges=9, block_rows=block_rows)
    found = {(r.key, r.position): list(r.window) for r in got.collect()}
    want = {}
    for key, ids in skewed.toPandas().fillna({"key": "-"}).sort_values("id").groupby("key")["id"]:
        ids = list(ids)
        for at in range(len(ids) - 2):
            want[None if key == "-" else key, at + 1] = ids[at : at + 3]
    assert found == want


@pytest.mark.parametrize("ranges", [2, 9, 64, 500])
def test_runs_of_equal_values(skewed, ranges):
    got = sorted(
        (r.key or "-", r.v, r.first_position, r.length)
        for r in sequences.consecutive_runs(skewed, "key", ["id"], "v", ranges=ranges).collect()
    )
    want = []
    for key, values in skewed.toPandas().fillna({"key": "-"}).sort_values("id").groupby("key")["v"]:
        change = values.ne(values.shift()).cumsum()
        position = pd.Series(range(1, len(values) + 1), index=values.index)
        for _, run in values.groupby(change):
            want.append((key, run.iloc[0], position[run.index[0]], len(run)))
    assert got == sorted(want)


def test_a_run_over_many_ranges_is_one_run(spark, rows):
    """Values 1 (50 times), null (700), 2 (1), null (49), 1 (200) of one key, and a second key."""
    values = [1] * 50 + [None] * 700 + [2] + [None] * 49 + [1] * 200
    data = [(i, "a", v) for i, v in enumerate(values)] + [(5_000 + i, "b", 1) for i in range(300)]
    frame = spark.createDataFrame(data, "id bigint, key string, v int")
    want = [("a", None, 51, 700), ("a", None, 752, 49), ("a", 1, 1, 50), ("a", 1, 801, 200), ("a", 2, 751, 1), ("b", 1, 1, 300)]
    for ranges in (2, 7, 60, 400):
        placed = spread_in_order(frame, ["id"], ["key"], ranges)
        reached = {r[RANGE] for r in placed.filter("key = 'a' AND id BETWEEN 50 AND 749").select(RANGE).distinct().collect()}
        assert ranges < 60 or len(reached) > 3
        got = sequences.consecutive_runs(frame, "key", ["id"], "v", ranges=ranges)
        assert rows(got) == want
    # The rows themselves are shuffled once; their second use is that same shuffle.
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning(_range" in line]
    assert ["ReusedExchange" in line for line in shuffles].count(False) == 1 and len(shuffles) == 2


def test_running_product_and_pages(spark, skewed, rows):
    small = spark.createDataFrame([(i, "a", float(i)) for i in range(1, 6)], "id bigint, key string, v double")
    got = sequences.running_values(small, "key", ["id"], "v", ranges=3).orderBy("id").collect()
    assert [r.running_product for r in got] == [1, 2, 6, 24, 120]
    assert [r.running_sum for r in got] == [1, 3, 6, 10, 15]
    pages = sequences.grouped_members(skewed, "key", "id", page_rows=100, ranges=5).collect()
    assert max(len(p.members) for p in pages) <= 100
    hot = sorted((p for p in pages if p.key == "hot"), key=lambda p: p.page)
    joined = [m for p in hot for m in p.members]
    assert joined == sorted(r.id for r in skewed.filter("key = 'hot'").collect())


def test_pairs_are_counted_once_per_basket(spark, rows):
    baskets = spark.createDataFrame(
        [(1, "a"), (1, "b"), (1, "a"), (2, "a"), (2, "b"), (2, "c"), (3, "c")], "basket int, item string"
    )
    assert rows(sequences.pair_counts(baskets, "basket", "item")) == [("a", "b", 2), ("a", "c", 1), ("b", "c", 1)]
    ordered = rows(sequences.pair_counts(baskets, "basket", "item", ordered=True))
    assert len(ordered) == 6 and ("b", "a", 2) in ordered
    assert rows(sequences.pair_counts(baskets, "basket", "item", min_baskets=2)) == [("a", "b", 2)]


def test_pairs_of_many_kinds_and_of_one_large_basket(spark, rows):
    baskets = spark.createDataFrame(
        [(1, f"i{k:03}") for k in range(200)] + [(None, "i000"), (None, "i001"), (2, "i000"), (2, None)],
        "basket int, item string",
    )
    for block_items in (500, 16):
        got = rows(sequences.pair_counts(baskets, "basket", "item", block_items=block_items))
        assert len(got) == 200 * 199 // 2 and got[0] == ("i000", "i001", 2)
        assert all(a < b and n == 1 for a, b, n in got[1:])


def test_window_longer_than_a_block(spark):
    frame = spark.range(1, 41).selectExpr("id", "'k' AS key", "id AS v")
    got = sequences.sliding_windows(frame, "key", ["id"], "v", 30, ranges=3, block_rows=7).orderBy("position").collect()
    assert [r.window for r in got] == [list(range(p, p + 30)) for p in range(1, 12)]


def test_small_and_large_numbers_are_summed_whole(spark, rows):
    small = spark.createDataFrame([(i, "a", v) for i, v in enumerate([1e-8, 3e-8, 5e-8])], "id bigint, key string, v double")
    got = sequences.running_values(small, "key", ["id"], "v", ranges=2).orderBy("id").collect()
    assert [r.running_sum for r in got] == pytest.approx([1e-8, 4e-8, 9e-8], rel=1e-12)
    large = spark.createDataFrame([(4e18, None, float("nan")), (5e18, None, 1.0), (6e18, None, 3.0)], "a double, b double, c double")
    told = {r.Column: r for r in profile.describe_numbers(large).collect()}
    assert (told["a"].mean, told["a"].p50, told["a"]["count"]) == (5e18, 5e18, 3)
    assert (told["b"]["count"], told["b"].mean, told["b"].p50) == (0, None, None)
    assert (told["c"]["count"], told["c"].mean, told["c"].max, told["c"].p50) == (2, 2.0, 3.0, 2.0)
    tiny = {r.Column: r for r in profile.describe_numbers(small.select("v")).collect()}["v"]
    assert tiny.mean == pytest.approx(3e-8) and tiny.std == pytest.approx(2e-8)


def test_columns_without_values_are_told_of(spark):
    empty = spark.createDataFrame([], "a double, t string, u string")
    assert [(r.Column, r["count"]) for r in profile.describe_numbers(empty).collect()] == [("a", 0)]
    assert sorted((r.Column, r["count"], r.unique, r.top) for r in profile.describe_texts(empty).collect()) == [
        ("t", 0, 0, None), ("u", 0, 0, None),
    ]
    some = spark.createDataFrame([("x", None), ("x", None)], "t string, u string")
    assert sorted(map(tuple, profile.distinct_counts(some, ["t", "u"]).collect())) == [("t", 1), ("u", 0)]


def test_no_join_on_a_column_name(spark):
    frame = spark.range(100).selectExpr("double(id) AS a", "double(id % 7) AS b")
    held = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = profile.describe_numbers(frame)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    for keys in re.findall(r"SortMergeJoin(?:\(skew=true\))? \[([^]]*)\]", plan):
        assert "_range" in keys or "_r" in keys


@pytest.mark.parametrize("ranges", [2, 16])
def test_rows_come_in_order_with_their_place(skewed, ranges):
    got = in_global_order(skewed, ["-v", "id"], ranges=ranges).collect()
    assert [r.place for r in got] == list(range(1, 2003))
    assert [(-r.v, r.id) for r in got] == sorted((-r.v, r.id) for r in got)
    short = top_in_place(skewed.orderBy("id").limit(5), ["-id"]).collect()
    assert [(r.id, r.place) for r in short] == [(4, 1), (3, 2), (2, 3), (1, 4), (0, 5)]
    assert top_in_place(skewed.limit(0), ["id"]).collect() == []


def test_duplicates_are_folded_by_hash(spark):
    data = [(None, "a", 1.0), ("a", None, 1.0), ("a", None, 1.0), (None, "a", 1.0), (None, "a", 1.0), ("b", "c", 0.0), ("b", "c", -0.0)]
    frame = spark.createDataFrame(data, "x string, y string, z double")
    assert profile.duplicate_rows(frame).first()[0] == 4
    assert profile.duplicate_rows(frame.limit(0)).first()[0] == 0
    # What every row sends is its hash; whole rows go only after the semi-join.
    plan = profile.duplicate_rows(frame)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Exchange hashpartitioning\(_a#\d+L, _b#\d+L, \d+\)[^\n]*\n[^\n]*HashAggregate\(keys=\[_a#\d+L, _b#\d+L\], functions=\[partial_count", plan)

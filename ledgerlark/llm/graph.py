"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlark.llm.shared import stage


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges`` (a, b); the component is its smallest node.

    Each round every node joins the first of its neighbours and itself, in an order that
    differs from round to round, and the edges are drawn anew between what has joined.
    So hubs and long chains shrink alike, and after the first round few edges are left of a
    group whose nodes share many neighbours.  Each round is written to the shared folder,
    which also cuts the lineage.
    """
    edges = stage(_between(edges, "a", "b"))
    labels, turn = None, 0
    while True:
        # A number whose bits flip the order; flipped again it gives the node back.
        flip = F.lit((0x9E3779B97F4A7C15 * turn) % 2**63)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = F.least(F.col("a").bitwiseXOR(flip), F.min(F.col("b").bitwiseXOR(flip))).bitwiseXOR(flip)
        joined = stage(both.groupBy("a").agg(first.alias("to")).withColumnRenamed("a", "from"))
        if labels is None:
            labels = joined.select(F.col("from").alias("node"), F.col("to").alias("label"))
        else:
            labels = stage(
                labels.join(joined, F.col("label") == F.col("from"), "left")
                .select("node", F.coalesce("to", "label").alias("label"))
            )
        one = joined.select(F.col("from").alias("a"), F.col("to").alias("to_a"))
        two = joined.select(F.col("from").alias("b"), F.col("to").alias("to_b"))
        edges = stage(_between(edges.join(one, "a").join(two, "b"), "to_a", "to_b"))
        turn += 1
        if edges.isEmpty():
            break
    low = labels.groupBy("label").agg(F.min("node").alias("component"))
    return labels.join(low, "label").select("node", "component")


def _between(rows: DataFrame, a: str, b: str) -> DataFrame:
    """Different edges (a, b), the smaller end first, without loops."""
    return rows.filter(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def tiles(members: DataFrame, weight: str, most_rows: int, most_weight: int) -> DataFrame:
    """Cut components into pairs of chunks, so that each pair of members meets exactly once.

    ``members`` holds ``node`` and ``component``.  A component of C chunks gives tiles
    (i, j), i <= j < C; each row goes to the C tiles of its ``chunk``.  Chunks have about
    ``most_rows`` rows and ``most_weight`` in the sum of ``weight``.
    """
    # Written, so that a component with a third of all rows can be split in the join.
    sizes = stage(members.groupBy("component").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / most_rows), F.ceil(F.sum(weight) / most_weight), F.lit(1)
        ).cast("int").alias("chunks")
    ))
    placed = members.join(sizes, "component").withColumn(
        "chunk", F.pmod(F.xxhash64(F.lit("chunk"), "node"), F.col("chunks")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    return (
        placed.select("*", other.alias("_j"))
        .select(
            *[c for c in placed.columns if c != "chunks"],
            F.least("chunk", "_j").alias("i"), F.greatest("chunk", "_j").alias("j"),
        )
    )

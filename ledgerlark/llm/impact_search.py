"""Exact top-k inner products by an impact-ordered index, a score at a time.

Vectors are whole numbers, ``floor(scale * x)`` per component.  They are cut into blocks.
The index of a block quantises every component and files the vectors under (dimension,
quantised value): a posting segment.  A query runs through the segments by descending
impact, that is, by the largest product they can add, and adds the middle of each
segment's range to the scores of its vectors.  At any time a vector's true score lies
within a known distance of its sum: what quantising hides, and the current impact for
each dimension it has not met yet.  A query stops only when these bounds prove that few
vectors can still be among its best; those are scored again exactly.

Blocks and queries meet by key: a task holds one block, and queries stream past it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerlark.llm.arrow_groups import sorted_groups
from ledgerlark.llm.shared import stage, table

LEVELS = 128  # quantised values per sign
ROUNDS = 16  # how often the bounds are looked at
_EXACT = 2.0**50


def _matrix(rows: pa.Table) -> np.ndarray:
    """Vectors of equal length as a matrix of doubles."""
    values = rows.column("value").combine_chunks()
    flat = values.flatten().to_numpy()
    return flat.reshape(rows.num_rows, len(flat) // rows.num_rows)


def exact_products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of whole-number vectors, exact at any size; beyond 64 bits at its ends."""
    if not query.size:
        return np.zeros(len(vectors), np.int64)
    if np.abs(vectors).max(initial=0) * np.abs(query).max() * len(query) < _EXACT:
        return (vectors @ query).astype(np.int64)
    whole = [int(x) for x in query]
    found = [sum(int(a) * b for a, b in zip(v, whole, strict=True)) for v in vectors]
    return np.array([max(-(2**63), min(2**63 - 1, s)) for s in found], np.int64)


class ImpactIndex:
    """The posting segments of one block of whole-number vectors."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.vectors = vectors
        self.n, self.dimensions = vectors.shape
        largest = np.abs(vectors).max(initial=0)
        self.step = max(1.0, 2.0 ** np.ceil(np.log2((largest + 1) / LEVELS)))
        level = np.floor(vectors / self.step)
        rows, dims, low, begin = [], [], [], []
        for d in range(self.dimensions):
            order = np.argsort(level[:, d], kind="stable")
            heads = np.flatnonzero(np.diff(level[order, d], prepend=np.inf))
            begin.append(heads + d * self.n)
            low.append(level[order, d][heads] * self.step)
            dims.append(np.full(len(heads), d))
            rows.append(order)
        self.rows = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        self.dim = np.concatenate(dims) if dims else np.zeros(0, np.int64)
        self.begin = np.concatenate(begin) if begin else np.zeros(0, np.int64)
        self.size = np.diff(self.begin, append=len(self.rows))
        self.half = (self.step - 1) / 2
        self.middle = (np.concatenate(low) if low else np.zeros(0)) + self.half

    def possible(self, query: np.ndarray, k: int, own: int, few: int) -> np.ndarray:
        """Rows that can be among the ``k`` best but ``own``; all others are proved not to be."""
        everyone = np.ones(self.n, bool)
        if own >= 0:
            everyone[own] = False
        reach = np.abs(query).max(initial=0) * (np.abs(self.middle).max(initial=0) + self.half) * max(self.dimensions, 1)
        if self.n - (own >= 0) <= max(k, few) or not self.dimensions or not reach < _EXACT:
            return np.flatnonzero(everyone)
        weight = query[self.dim]
        impact = np.abs(weight) * (np.abs(self.middle) + self.half)
        order = np.argsort(-impact, kind="stable")
        hidden = np.abs(query).sum() * self.half
        met = np.cumsum(self.size[order])
        cuts = np.unique(np.searchsorted(met, met[-1] * np.arange(1, ROUNDS + 1) / ROUNDS) + 1)
        total, seen, at = np.zeros(self.n), np.zeros(self.n), 0
        chance = everyone
        for cut in cuts.tolist():
            part = order[at:cut]
            size = self.size[part]
            ends = np.cumsum(size)
            posting = self.rows[np.repeat(self.begin[part] - (ends - size), size) + np.arange(ends[-1])]
            total += np.bincount(posting, np.repeat(weight[part] * self.middle[part], size), self.n)
            seen += np.bincount(posting, minlength=self.n)
            at = cut
            ahead = impact[order[cut]] if cut < len(order) else 0.0
            away = hidden + (self.dimensions - seen) * ahead
            sure = np.where(everyone, total - away, -np.inf)
            chance = everyone & (total + away >= np.partition(sure, self.n - k)[self.n - k])
            if np.count_nonzero(chance) <= few:
                break
        return np.flatnonzero(chance)


def _answered(k: int, few: int):
    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, index = None, None
        for group, _, _ in sorted_groups(batches, ["size", "block", "chunk", "kind"]):
            here = tuple(group.column(c)[0].as_py() for c in ("size", "block", "chunk"))
            vectors, key, ids = _matrix(group), group.column("key").to_numpy(), group.column("vec_id")
            if group.column("kind")[0].as_py() == 0:
                place, index = here, ImpactIndex(vectors)
                names, known = ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy()
                by_key = np.argsort(key)
                sorted_keys = key[by_key]
                continue
            if place != here:
                continue
            queries, found = [], []
            for q, (query, name) in enumerate(zip(vectors, key, strict=True)):
                spot = int(np.searchsorted(sorted_keys, name))
                own = int(by_key[spot]) if spot < len(sorted_keys) and sorted_keys[spot] == name else -1
                rows = index.possible(query, k, own, few)
                score = exact_products(index.vectors[rows], query)
                best = np.lexsort((names[rows], known[rows], -score))[:k]
                queries.append(np.full(len(best), q))
                found.append(np.stack([rows[best], score[best]]))
            query, (row, score) = np.concatenate(queries), np.concatenate(found, axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key[query]), ids.combine_chunks().take(pa.array(query)),
                    pa.array(names[row], mask=~known[row]), pa.array(score),
                ],
                ["key", "query_id", "vec_id", "score"],
            )

    return answered


def best_products(
    vectors: DataFrame,
    asked: Column,
    k: int = 10,
    scale: float = 1024.0,
    block_rows: int = 20_000,
    chunk_rows: int = 20_000,
    few: int = 1_000,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` largest inner products of each query.

    ``vectors`` has an integer vec_id and embedding; the rows for which ``asked`` holds are
    the queries, all rows but the query's own its candidates.  Each component x counts as
    ``floor(scale * x)``, x as a double.  Equal scores go by vec_id, null first.  ``few`` is
    how many possible members are scored exactly without a further round; it changes no
    result.

    An embedding that is null, or holds a null or a number that is not finite, also after
    scaling, takes no part.  Only embeddings of equal length are compared; the product of
    empty ones is 0.  Rows that repeat vec_id and embedding count once; rows that repeat
    vec_id with another embedding are rows of their own, as queries too.  A score that 64
    bits cannot hold is given as the nearest they can.  Other columns are ignored.  An
    empty table gives no rows.
    """
    value = F.transform(F.col("embedding").cast("array<double>"), lambda x: x * F.lit(scale))
    finite = F.coalesce(F.forall("value", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))
    usable = (
        vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.coalesce(asked, F.lit(False)).alias("asked"), value.alias("value"))
        .filter(finite)
        .groupBy("vec_id", "value").agg(F.max("asked").alias("asked"))
        .select("vec_id", "asked", "value", F.size("value").alias("size"), F.xxhash64("vec_id", "value").alias("key"))
    )
    # Rounded down as doubles: a bigint could overflow.
    rows = stage(usable.mapInArrow(_floored, usable.schema))
    n, n_asked = rows.agg(F.count(F.lit(1)), F.count_if("asked")).first()
    blocks, chunks = max(1, -(-n // block_rows)), max(1, -(-n_asked // chunk_rows))
    shared = ["vec_id", "value", "size", "key"]
    held = rows.select(
        *shared, F.lit(0).alias("kind"), F.pmod(F.xxhash64(F.lit("block"), "key"), F.lit(blocks)).alias("block"),
        F.explode(_numbers(chunks)).alias("chunk"),
    )
    queries = rows.filter("asked").select(
        *shared, F.lit(1).alias("kind"), F.explode(_numbers(blocks)).alias("block"),
        F.pmod(F.xxhash64(F.lit("chunk"), "key"), F.lit(chunks)).alias("chunk"),
    )
    place = ["size", "block", "chunk"]
    found = (
        held.unionByName(queries).repartition(blocks * chunks, *place).sortWithinPartitions(*place, "kind", "key")
        .mapInArrow(_answered(k, few), "key long, query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_first("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))


def _floored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("value")
        lists = batch.column(at)
        floors = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype(np.int32)),
            pa.array(np.floor(lists.flatten().to_numpy())),
        )
        yield batch.set_column(at, batch.schema.field(at), floors)


def impact_search_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 largest inner products of every vector whose vec_id is divisible by 100."""
    return best_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


IMPACT_SEARCH_SQL = r"""
WITH whole AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), products AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
    FROM products
)
SELECT * FROM ranked WHERE rank <= 10
"""

"""Join documents whose sets of word n-grams are alike, with Bayesian pruning.

1. Every document becomes a set of hashed runs of five words and a signature of 128
   MinHash values.  Documents with equal sets fold to one class.
2. Four values make a band; classes that share a band may be alike.  A pair at the
   threshold shares none of 32 bands with a chance of 5e-8.
3. Inside a band MinHash values are compared in steps.  After n values of which m agree
   the chance that the pair reaches the threshold is the tail of a Beta(m+1, n-m+1); a
   pair below the tolerance is dropped.  What is left links classes to groups.  A band
   with thousands of classes is compared in tiles.
4. Groups are cut into tiles of bounded size.  A tile compares the rest of the values in
   the same way, verifies the survivors on the whole sets, and returns counts and a
   spanning forest, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlark.llm.arrow_groups import sorted_groups
from ledgerlark.llm.graph import components, tiles
from ledgerlark.llm.shared import attach, stage, table, with_document_key
from ledgerlark.llm.words import hashed_words, mix, text_batches, word_runs

VALUES, BAND, STEP, SHORT = 128, 4, 16, 32
# Rows of a band that are compared with as many others at a time.
CHUNK = 2_000
_ODD = mix(np.arange(1, VALUES + 1, dtype=np.uint64)) | np.uint64(1)
_XOR = mix(np.arange(1001, VALUES + 1001, dtype=np.uint64))


@lru_cache
def least_matches(threshold: float, tolerance: float, values: int = VALUES) -> tuple[int, ...]:
    """After each step, the fewest agreeing values with which a pair is kept.

    With a uniform prior the posterior chance of a similarity at or above t, given m
    of n agree, is P(Binomial(n + 1, t) <= m).
    """
    found = []
    for n in range(STEP, values + 1, STEP):
        below, m = 0.0, -1
        while below < tolerance:
            m += 1
            below += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        found.append(m)
    return tuple(found)


def shingle_sets(texts: list[str], length: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    runs, number = word_runs(*hashed_words(texts), length)
    at = np.searchsorted(number, np.arange(len(texts) + 1))
    return [np.unique(runs[a:b]) for a, b in zip(at, at[1:], strict=False)]


def signature(shingles: np.ndarray) -> np.ndarray:
    """128 MinHash values, the low 16 bits of each minimum."""
    low = np.empty(VALUES, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(VALUES):
            low[k] = ((shingles ^ _XOR[k]) * _ODD[k]).min()
    return (low & np.uint64(0xFFFF)).astype("<u2")


def _set_hash(shingles: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        total = mix(shingles + np.uint64(7)).sum(dtype=np.uint64)
        return int(mix(np.array([total ^ np.uint64(len(shingles))])).astype(np.int64)[0])


def sketches(docs: DataFrame, length: int) -> DataFrame:
    """``(doc_id, _t, node, n, sig)``: class, set size and signature; node is null without words."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, sigs = [], [], []
            for _, texts in text_batches(batch.column("text").to_pylist()):
                for s in shingle_sets(texts, length):
                    nodes.append(_set_hash(s) if len(s) else None)
                    sizes.append(len(s))
                    sigs.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("_t"), pa.array(nodes, pa.int64()),
                    pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary()),
                ],
                ["doc_id", "_t", "node", "n", "sig"],
            )

    return docs.select("doc_id", "_t", "text").mapInArrow(
        sketch, f"doc_id {kind}, _t long, node long, n long, sig binary"
    )


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), "<u8").reshape(batch.num_rows, -1)
        band = mix(sig + mix(np.arange(sig.shape[1], dtype=np.uint64))[None, :]).astype(np.int64)
        node = np.repeat(batch.column("node").to_numpy(), sig.shape[1])
        for a in range(0, len(node), 1 << 16):
            yield pa.RecordBatch.from_arrays(
                [pa.array(band.ravel()[a : a + (1 << 16)]), pa.array(node[a : a + (1 << 16)])], ["h", "node"]
            )


def agreeing(a: np.ndarray, b: np.ndarray, least: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two signature blocks that survive every step."""
    m = np.zeros((len(a), len(b)), np.int16)
    for k in range(STEP):
        m += a[:, k, None] == b[None, :, k]
    x, y = np.nonzero(m >= least[0])
    same = m[x, y].astype(np.int32)
    for step, fewest in enumerate(least[1:], 1):
        if not len(x):
            break
        for k in range(step * STEP, (step + 1) * STEP):
            same += a[x, k] == b[y, k]
        keep = same >= fewest
        x, y, same = x[keep], y[keep], same[keep]
    return x, y


def forest(x: np.ndarray, y: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the graph with edges (x, y) on ``size`` nodes.

    Each node is tied to the first of its component, so that rows sorted by node give the
    same edges wherever the same nodes meet.
    """
    label = np.arange(size)
    while True:
        low = label.copy()
        np.minimum.at(low, x, label[y])
        np.minimum.at(low, y, label[x])
        low = low[low]
        if np.array_equal(low, label):
            break
        label = low
    inner = np.flatnonzero(label != np.arange(size))
    return inner, label[inner]


def _links_in_bands(least: tuple[int, ...]):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for group, _, _ in sorted_groups(batches, ["h", "i", "j"]):
            if group.num_rows > 1:
                sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), "<u2").reshape(group.num_rows, -1)
                node, chunk = group.column("node").to_numpy(), group.column("chunk").to_numpy()
                i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
                first = np.flatnonzero(chunk == i)
                second = first if i == j else np.flatnonzero(chunk == j)
                seen.update(_alike_in(sig, node, first, second, least))
            if len(seen) > 20_000:
                yield _edge_batch(seen)
                seen = set()
        if seen:
            yield _edge_batch(seen)

    return links


def _alike_in(
    sig: np.ndarray, node: np.ndarray, first: np.ndarray, second: np.ndarray, least: tuple[int, ...]
) -> set[tuple[int, int]]:
    """Spanning edges of the pairs between two chunks that survive; blocks keep at most a forest each."""
    size, edges = 256, [np.zeros((2, 0), np.int64)]
    for a in range(0, len(first), size):
        for b in range(a if first is second else 0, len(second), size):
            rows = [first[a : a + size], second[b : b + size]]
            x, y = agreeing(sig[rows[0]], sig[rows[1]], least)
            p, q = forest(x, y + len(rows[0]), len(rows[0]) + len(rows[1]))
            edges.append(np.concatenate(rows)[np.stack([p, q])])
    x, y = np.concatenate(edges, axis=1)
    p, q = forest(x, y, len(node))
    return set(zip(node[p].tolist(), node[q].tolist(), strict=True))


def _edge_batch(pairs: set[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*sorted(pairs), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def common_counts(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets x[i] and y[i]."""
    if len(x) < 2_000:
        return np.array(
            [len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(x, y, strict=True)], np.int64
        )
    # Many pairs of few sets: products of 0/1 blocks over the elements that two sets share.
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, element, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[element] > 1
    owner, element = owner[shared], element[shared]
    _, element = np.unique(element, return_inverse=True)
    order = np.argsort(element, kind="stable")
    owner, element = owner[order], element[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    width = 4096
    for low in range(0, int(element[-1]) + 1 if len(element) else 0, width):
        a, b = np.searchsorted(element, [low, low + width])
        block = np.zeros((len(sets), width), np.float32)
        block[owner[a:b], element[a:b] - low] = 1
        total += block @ block.T
    return total[x, y].astype(np.int64)


def compare_tile(
    sigs: np.ndarray, sets: list[np.ndarray], first: np.ndarray, second: np.ndarray, threshold: float, least: tuple[int, ...]
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs between rows ``first`` and ``second`` with a Jaccard similarity at the threshold."""
    x, y = agreeing(sigs[first], sigs[second], least)
    x, y = first[x], second[y]
    if first is second:
        x, y = x[x < y], y[x < y]
    if not len(x):
        return x, y
    size = np.array([len(s) for s in sets])
    short = np.minimum(size[x], size[y]) >= threshold * np.maximum(size[x], size[y]) - 1e-9
    x, y = x[short], y[short]
    both = common_counts(sets, x, y)
    # Whole numbers on both sides but for the threshold, so equal ratios count as reached.
    alike = both >= threshold * (size[x] + size[y] - both) - 1e-9
    return x[alike], y[alike]


def _links_in_tiles(threshold: float, least: tuple[int, ...], length: int):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, _, _ in sorted_groups(batches, ["component", "i", "j"]):
            if group.num_rows < 2:
                continue
            sigs = np.frombuffer(b"".join(group.column("sig").to_pylist()), "<u2").reshape(group.num_rows, -1)
            sets = [np.frombuffer(s, "<u8") for s in group.column("grams").to_pylist()]
            node = group.column("node").to_numpy()
            copies = group.column("copies").to_numpy()
            chunk = group.column("chunk").to_numpy()
            i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
            first = np.flatnonzero(chunk == i)
            second = first if i == j else np.flatnonzero(chunk == j)
            x, y = compare_tile(sigs, sets, first, second, threshold, least)
            if not len(x):
                continue
            count = np.bincount(x, copies[y], len(node)) + np.bincount(y, copies[x], len(node))
            p, q = forest(x, y, len(node))
            has = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([node[has], node[p]])),
                    pa.array([None] * len(has) + node[q].tolist(), pa.int64()),
                    pa.array(np.concatenate([count[has].astype(np.int64), np.zeros(len(p), np.int64)])),
                ],
                ["a", "b", "links"],
            )

    return links


def _with_grams(length: int):
    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for _, texts in text_batches(batch.column("text").to_pylist()):
                found += [s.astype("<u8").tobytes() for s in shingle_sets(texts, length)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(found, pa.binary())], ["node", "grams"]
            )

    return grams


def similar_documents(
    docs: DataFrame, threshold: float = 0.8, length: int = 5, tolerance: float = 1e-8
) -> DataFrame:
    """``(doc_id, _t, n_links, class_id, kept)`` for every row of keyed ``docs``.

    Two rows are linked when the Jaccard similarity of their sets of ``length``-word runs
    is at least ``threshold``; a text of fewer words is one run.  ``n_links`` counts the
    other rows linked directly, copies included.  ``class_id`` is the smallest doc_id that
    links reach, ``kept`` marks one row of each class: the one of that doc_id (of several,
    that with the smallest text hash).
    """
    least = least_matches(threshold, tolerance)
    rows = stage(sketches(docs, length))
    classes = stage(
        rows.filter("node IS NOT NULL").groupBy("node").agg(
            F.count(F.lit(1)).alias("copies"),
            F.min(F.struct("doc_id", "_t")).alias("lead"),
            F.first("n").alias("n"), F.first("sig").alias("sig"),
        )
    )
    bands = stage(classes.select("node", "sig").mapInArrow(_bands, "h long, node long"))
    shared = stage(
        bands.groupBy("h").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    )
    chunks = F.ceil(F.col("size") / CHUNK).cast("int")
    met = (
        stage(bands.join(shared, "h")).withColumn("chunk", F.pmod(F.xxhash64(F.lit("chunk"), "node"), chunks).cast("int"))
        .select("h", "node", "chunk", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("_j"))
        .select("h", "node", "chunk", F.least("chunk", "_j").alias("i"), F.greatest("chunk", "_j").alias("j"))
    )
    beginning = classes.select("node", F.substring("sig", 1, 2 * SHORT).alias("sig"))
    groups = components(
        met.join(beginning, "node").repartition("h", "i", "j").sortWithinPartitions("h", "i", "j", "node")
        .mapInArrow(_links_in_bands(least[: SHORT // STEP]), "a long, b long")
    )

    members = stage(groups.join(classes, "node"))
    texts = attach(
        members.select("node", F.col("lead.doc_id").alias("doc_id"), F.col("lead._t").alias("_t")),
        docs.select("doc_id", "_t", "text"), "inner",
    ).select("node", "text").mapInArrow(_with_grams(length), "node long, grams binary")
    grams = texts.groupBy("node").agg(F.first("grams").alias("grams"))
    cut = tiles(members.select("node", "component", "copies", "n", "sig"), "n", 400, 400_000)
    found = stage(
        cut.join(grams, "node").select("component", "i", "j", "chunk", "node", "copies", "sig", "grams")
        .repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "node")
        .mapInArrow(_links_in_tiles(threshold, least, length), "a long, b long, links long")
    )
    links = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    linked = components(found.filter("b IS NOT NULL").select("a", "b"))
    leads = linked.join(classes.select("node", "lead"), "node")
    best = leads.groupBy("component").agg(F.min("lead").alias("best"))
    labels = stage(
        classes.select("node", "copies", "lead")
        .join(links, "node", "left")
        .join(leads.select("node", "component").join(best, "component"), "node", "left")
        .select(
            "node", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("best", "lead").alias("best"),
        )
    )
    out = rows.select("doc_id", "_t", "node").join(labels, "node", "left")
    own = F.struct("doc_id", "_t")
    return out.select(
        "doc_id", "_t",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("class_id"),
        (F.col("best").isNull() | own.eqNullSafe(F.col("best"))).alias("kept"),
    )


def ngram_join(
    docs: DataFrame, threshold: float = 0.8, length: int = 5, tolerance: float = 1e-8
) -> DataFrame:
    """:func:`similar_documents` for any table with doc_id and text.

    Null or empty text, or one without a word: linked with nothing, a class of its own.
    Null doc_id: a document like any other, the smallest.  Repeated rows are linked with
    each other.  Other columns are ignored.  An empty table gives no rows.
    """
    return similar_documents(with_document_key(docs), threshold, length, tolerance).drop("_t")


def ngram_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and class of every document, by five-word runs at a similarity of 0.8."""
    return ngram_join(table(spark, sf_dir, "documents"))


NGRAM_JOIN_SQL = r"""
WITH RECURSIVE words AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents
), grams AS MATERIALIZED (
    SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5
        THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM words
), sets AS MATERIALIZED (
    SELECT list_sort(g) AS g, list(doc_id) AS docs, count(*) AS copies, min(doc_id) AS node, len(any_value(g)) AS n
    FROM grams WHERE len(g) > 0 GROUP BY list_sort(g)
), elements AS MATERIALIZED (
    SELECT node, n, copies, unnest(g) AS e FROM sets
), pairs AS MATERIALIZED (
    SELECT a.node AS a, b.node AS b, any_value(a.copies) AS ca, any_value(b.copies) AS cb
    FROM elements a JOIN elements b ON a.e = b.e AND a.node < b.node AND least(a.n, b.n) >= 0.8 * greatest(a.n, b.n)
    GROUP BY a.node, b.node HAVING count(*) >= 0.8 * (any_value(a.n) + any_value(b.n) - count(*)) - 1e-9
), links AS (
    SELECT node, sum(c) AS links FROM (
        SELECT a AS node, cb AS c FROM pairs UNION ALL SELECT b, ca FROM pairs) GROUP BY node
), edges AS MATERIALIZED (
    SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach(node, low) AS (
    SELECT node, node FROM sets
    UNION
    SELECT e.b, r.low FROM reach r JOIN edges e ON e.a = r.node WHERE r.low < e.b
), classes AS (
    SELECT node, min(low) AS class_id FROM reach GROUP BY node
), members AS (
    SELECT unnest(s.docs) AS doc_id, s.copies - 1 + coalesce(l.links, 0) AS n_links, c.class_id
    FROM sets s JOIN classes c USING (node) LEFT JOIN links l USING (node)
)
SELECT d.doc_id, CAST(coalesce(m.n_links, 0) AS BIGINT) AS n_links, coalesce(m.class_id, d.doc_id) AS class_id,
    coalesce(m.class_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN members m ON m.doc_id = d.doc_id
"""

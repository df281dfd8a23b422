"""Near-duplicate vectors by lattice hashing.

A table projects unit vectors at random to a few blocks of eight coordinates and decodes
each to the nearest point of the E8 lattice; the points together name a cell.  Near
vectors fall into one cell or into neighbouring ones, so each vector is filed under its
own cell and also asks in the cells it nearly fell into: the closest neighbours of one
point, the others kept.  Several tables make a miss unlikely (about 0.6 % at a cosine of
0.9 with the settings below, measured far less on the test data).

The more vectors there are, the more blocks name a cell (see :func:`lattice_size`), so that
a cell holds about as many vectors that are not near at any size; more tables make up for
the near ones that more blocks part.

Vectors that meet in a cell are compared by sign sketches; a cell with thousands of them
is compared in tiles.  The survivors are linked to groups, and tiles of bounded size
verify all pairs of a group by cosine in double precision.  Only counts and spanning
forests leave a tile.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlark.llm.arrow_groups import sorted_groups
from ledgerlark.llm.graph import components, tiles
from ledgerlark.llm.ngram_join import forest
from ledgerlark.llm.shared import stage, table
from ledgerlark.llm.words import mix

PROBES, SCALE = 4, 3.0
# Vectors at a cosine of 0.9 differ in 73.5 of 512 signs on average, deviation 7.9.
SKETCH_BITS, MOST_DIFFERENT = 512, 113
# Rows of a cell that are compared with as many others at a time.
CHUNK = 2_000


def lattice_size(rows: int) -> tuple[int, int]:
    """``(tables, blocks)`` for a number of vectors.

    A block more names about twenty times as many cells that unlike vectors spread over,
    and two near vectors agree in it about seven times in ten.  The tables are as many as
    leave a near pair apart in all of them about as often as eight tables of two blocks.
    """
    blocks = 2
    while rows > 25_000 * 20 ** (blocks - 2):
        blocks += 1
    together = 0.47 ** (blocks / 2)
    return math.ceil(math.log(0.53**8) / math.log(1 - together) - 1e-9), blocks


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer point with an even sum."""
    whole = np.rint(x)
    off = x - whole
    worst = np.abs(off).argmax(axis=1)
    row = np.arange(len(x))
    other = whole.copy()
    other[row, worst] += np.where(off[row, worst] >= 0, 1, -1)
    return np.where((whole.sum(axis=1) % 2 != 0)[:, None], other, whole)


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest point of E8: the even integer points and the same shifted by one half."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    nearer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(nearer[:, None], a, b)


@lru_cache(1)
def shortest_vectors() -> np.ndarray:
    """The 240 vectors from a lattice point to its nearest neighbours."""
    found = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            found.append(v)
    for signs in itertools.product((0.5, -0.5), repeat=8):
        if sum(s < 0 for s in signs) % 2 == 0:
            found.append(np.array(signs))
    return np.array(found)


@lru_cache(8)
def _projection(dimension: int, n_tables: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Projections of all tables, and their shifts."""
    random = np.random.default_rng(dimension)
    width = 8 * blocks
    tables = []
    for _ in range(n_tables):
        square = np.linalg.qr(random.normal(size=(max(dimension, width), width)))[0][:dimension]
        tables.append(square * SCALE * np.sqrt(dimension / 64))
    return np.stack(tables), random.random((n_tables, width))


@lru_cache(8)
def _directions(dimension: int) -> np.ndarray:
    """The directions of the sketch."""
    return np.random.default_rng(1_000_003 + dimension).normal(size=(dimension, SKETCH_BITS))


def _cell_hash(table_no: int, dimension: int, points: list[np.ndarray]) -> np.ndarray:
    h = mix(np.full(len(points[0]), table_no * 1_000_003 + dimension, np.uint64))
    with np.errstate(over="ignore"):
        for block in points:
            for c in range(8):
                h = mix(h * np.uint64(31) + (2 * block[:, c]).astype(np.int64).astype(np.uint64))
    return h.astype(np.int64)


def cells(unit: np.ndarray, n_tables: int, blocks: int) -> Iterator[tuple[np.ndarray, bool]]:
    """Cell hashes of unit vectors, table by table: their own, then those they ask in."""
    project, shift = _projection(unit.shape[1], n_tables, blocks)
    near = shortest_vectors()
    for t in range(n_tables):
        x = unit @ project[t] + shift[t]
        parts = [x[:, 8 * b : 8 * b + 8] for b in range(blocks)]
        own = [nearest_e8(b) for b in parts]
        yield _cell_hash(t, unit.shape[1], own), True
        for b in range(blocks):
            toward = (parts[b] - own[b]) @ near.T
            order = np.argpartition(-toward, PROBES, axis=1)[:, :PROBES]
            for p in range(PROBES):
                moved = list(own)
                moved[b] = own[b] + near[order[:, p]]
                yield _cell_hash(t, unit.shape[1], moved), False


def _unit_vectors(column: pa.ChunkedArray | pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(row numbers, unit vectors)`` for each length of vectors in a column."""
    vectors = column.to_pylist()
    sizes = np.array([len(v) for v in vectors])
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        x = np.array([vectors[r] for r in rows], np.float64)
        x /= np.abs(x).max(axis=1, keepdims=True)
        yield rows, x / np.linalg.norm(x, axis=1, keepdims=True)


def _filed(n_tables: int, blocks: int):
    def filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = batch.column("node").to_numpy()
            for rows, unit in _unit_vectors(batch.column("vector")):
                for h, own in cells(unit, n_tables, blocks):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h), pa.array(node[rows]), pa.array(np.full(len(rows), int(own), np.int32))],
                        ["h", "node", "own"],
                    )

    return filed


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        node = batch.column("node").to_numpy()
        for rows, unit in _unit_vectors(batch.column("vector")):
            bits = np.packbits(unit @ _directions(unit.shape[1]) > 0, axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[rows]), pa.array([b.tobytes() for b in bits], pa.binary())], ["node", "sketch"]
            )


def _links_in_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between two chunks of a cell, or within one: own vectors with all others."""
    for group, _, _ in sorted_groups(batches, ["h", "i", "j"]):
        own = group.column("own").to_numpy() > 0
        if not own.any() or group.num_rows < 2:
            continue
        node, chunk = group.column("node").to_numpy(), group.column("chunk").to_numpy()
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        sketch = np.frombuffer(b"".join(group.column("sketch").to_pylist()), "<u8").reshape(len(node), -1)
        sides = [(i, j)] if i == j else [(i, j), (j, i)]
        xs, ys = [], []
        for one, other in sides:
            asked, met = np.flatnonzero((chunk == one) & own), np.flatnonzero(chunk == other)
            for a in range(0, len(asked), 256):
                part = asked[a : a + 256]
                different = np.bitwise_count(sketch[part, None, :] ^ sketch[None, met, :]).sum(axis=2)
                x, y = np.nonzero(different <= MOST_DIFFERENT)
                p, q = forest(part[x], met[y], len(node))
                xs.append(p)
                ys.append(q)
        p, q = forest(np.concatenate(xs), np.concatenate(ys), len(node))
        differ = node[p] != node[q]
        if differ.any():
            yield pa.RecordBatch.from_arrays([pa.array(node[p][differ]), pa.array(node[q][differ])], ["a", "b"])


def _links_in_tiles(threshold: float):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, _, _ in sorted_groups(batches, ["component", "i", "j"]):
            if group.num_rows < 2:
                continue
            node, copies = group.column("node").to_numpy(), group.column("copies").to_numpy()
            chunk = group.column("chunk").to_numpy()
            i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
            xs, ys = [], []
            for rows, unit in _unit_vectors(group.column("vector")):
                first, second = np.flatnonzero(chunk[rows] == i), np.flatnonzero(chunk[rows] == j)
                x, y = np.nonzero(unit[first] @ unit[second].T >= threshold)
                x, y = rows[first[x]], rows[second[y]]
                keep = x < y if i == j else slice(None)
                xs.append(x[keep])
                ys.append(y[keep])
            x, y = np.concatenate(xs), np.concatenate(ys)
            if not len(x):
                continue
            count = (np.bincount(x, copies[y], len(node)) + np.bincount(y, copies[x], len(node))).astype(np.int64)
            p, q = forest(x, y, len(node))
            has = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([node[has], node[p]])),
                    pa.array([None] * len(has) + node[q].tolist(), pa.int64()),
                    pa.array(np.concatenate([count[has], np.zeros(len(p), np.int64)])),
                ],
                ["a", "b", "links"],
            )

    return links


def near_vectors(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors`` (vec_id, embedding).

    Two rows are linked when the cosine of their embeddings is at least ``threshold``.
    ``component_id`` is the smallest vec_id that links reach, ``kept`` tells whether it is
    the row's own.

    An embedding that is null, empty or zero, or that holds a null or a number that is
    not finite, links with nothing, and embeddings of different lengths never do.  Equal
    embeddings are linked.  Null vec_id: a row like any other that never names a
    component with others.  Repeated rows are linked with each other.  Other columns are
    ignored.  An empty table gives no rows.
    """
    value = F.col("embedding").cast("array<double>")
    finite = F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    usable = F.coalesce(finite & F.exists(value, lambda v: v != 0), F.lit(False))
    rows = stage(
        vectors.select(
            "vec_id", F.when(usable, F.xxhash64(value)).alias("node"), F.when(usable, value).alias("vector")
        )
    )
    classes = stage(
        rows.filter("node IS NOT NULL").groupBy("node").agg(
            F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("low"), F.first("vector").alias("vector")
        )
    )
    filed = stage(classes.select("node", "vector").mapInArrow(
        _filed(*lattice_size(classes.count())), "h long, node long, own int"
    ))
    shared = stage(
        filed.groupBy("h").agg(F.count(F.lit(1)).alias("size"), F.sum("own").alias("owners"))
        .filter("size > 1 AND owners > 0").drop("owners")
    )
    sketches = classes.select("node", "vector").mapInArrow(_sketched, "node long, sketch binary")
    chunks = F.ceil(F.col("size") / CHUNK).cast("int")
    met = (
        stage(filed.join(shared, "h")).withColumn("chunk", F.pmod(F.xxhash64(F.lit("chunk"), "node"), chunks).cast("int"))
        .select("h", "node", "own", "chunk", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("_j"))
        .select("h", "node", "own", "chunk", F.least("chunk", "_j").alias("i"), F.greatest("chunk", "_j").alias("j"))
    )
    pruned = (
        met.join(sketches, "node").repartition("h", "i", "j").sortWithinPartitions("h", "i", "j", "node")
        .mapInArrow(_links_in_cells, "a long, b long")
    )
    members = components(pruned).join(
        classes.select("node", "copies", "vector", F.size("vector").alias("n")), "node"
    )
    found = stage(
        tiles(stage(members), "n", 1_000, 1_000_000)
        .select("component", "i", "j", "chunk", "node", "copies", "vector")
        .repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "node")
        .mapInArrow(_links_in_tiles(threshold), "a long, b long, links long")
    )
    links = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    linked = components(found.filter("b IS NOT NULL").select("a", "b"))
    leads = linked.join(classes.select("node", "low"), "node")
    best = leads.groupBy("component").agg(F.min("low").alias("best"))
    labels = stage(
        classes.select("node", "copies", "low")
        .join(links, "node", "left")
        .join(leads.select("node", "component").join(best, "component"), "node", "left")
        .select(
            "node", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("best", "low").alias("best"),
        )
    )
    return rows.select("vec_id", "node").join(labels, "node", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("best", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("best", "vec_id")).alias("kept"),
    )


def lattice_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at a cosine of 0.9."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


#: Every link there is: on the test data the hashing finds them all.
LATTICE_SQL = r"""
WITH RECURSIVE unit AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS v FROM embeddings
    WHERE len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
        AND len(list_filter(embedding, lambda v: v <> 0)) > 0
), links AS MATERIALIZED (
    SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9
), reach(node, low) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION
    SELECT l.b, r.low FROM reach r JOIN links l ON l.a = r.node WHERE r.low < l.b
), found AS (
    SELECT node, min(low) AS component_id FROM reach GROUP BY node
)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, f.component_id,
    f.component_id = e.vec_id AS kept
FROM embeddings e JOIN found f ON f.node = e.vec_id
"""

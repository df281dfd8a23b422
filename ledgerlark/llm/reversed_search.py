"""Ranked lexical search, reversed: the items are indexed, the documents stream past.

The terms of all items form an inverted index that every task holds.  The documents are
read once: each is counted over the index's terms and written as (length, term numbers,
counts), from which the document frequencies follow.  The counts then run through the
index; each task keeps the best ``k`` documents of every item in heaps of bounded size,
and the heaps of all tasks are merged.

The index is cut into shards of about ``most_postings`` (item, term) pairs, which bounds
what the driver and a task hold; a shard is one pass over the documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerlark.llm.shared import stage, table, text_of

# ASCII letters in lower case, digits and all bytes of other characters; the rest parts terms.
_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))


def term_bytes(kept: bytes) -> bytes:
    """A table for ``bytes.translate``: A-Z in lower case, and a blank for all that is not kept."""
    return bytes(b if b in kept else 0x20 for b in bytes(range(256)).lower())


_TERM_BYTES = term_bytes(_KEPT)
_SLICE = 1 << 20
_CELLS, _STEPS = 1 << 22, 1 << 21


def term_slices(text: bytes, table: bytes = _TERM_BYTES) -> Iterator[list[bytes]]:
    """All terms of a text, a megabyte of it at a time."""
    clean = text.translate(table)
    at = 0
    while at < len(clean):
        end = clean.find(b" ", at + _SLICE)
        end = len(clean) if end < 0 else end
        yield clean[at:end].split()
        at = end


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
            counts: dict[bytes, int] = {}
            for terms in term_slices(text):
                for t in terms:
                    counts[t] = counts.get(t, 0) + 1
            if counts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(counts)), pa.array(list(counts), pa.binary()), pa.array(list(counts.values()))],
                    ["item", "term", "times"],
                )


def _counted(sent) -> object:
    """Documents as (doc_id, n, terms, tfs) over the terms that were sent."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = sent.value.get
        for batch in batches:
            if not batch.num_rows:
                continue
            lengths, terms, tfs, sizes = [], [], [], []
            for text in batch.column("text"):
                n, parts = 0, []
                for slice_terms in term_slices(text.as_py() or b""):
                    n += len(slice_terms)
                    known = np.fromiter(map(get, slice_terms, repeat(-1)), np.int32, len(slice_terms))
                    parts.append(known[known >= 0])
                term, tf = np.unique(np.concatenate(parts), return_counts=True) if parts else ([], [])
                lengths.append(n)
                sizes.append(len(term))
                terms.append(np.asarray(term, np.int32))
                tfs.append(np.asarray(tf, np.int64))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            rows = pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(terms))),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(tfs))),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )
            yield rows.filter(pa.array(np.array(lengths) > 0))

    return counted


@dataclass
class Index:
    """Postings by term: item numbers with weight times occurrences in the item."""

    items: np.ndarray  # names of the items
    first: np.ndarray  # where each term's postings begin
    item: np.ndarray
    weight: np.ndarray

    def scores(self, doc: np.ndarray, term: np.ndarray, share: np.ndarray, n_docs: int) -> np.ndarray:
        """Documents x items: sums of weight x share, exact whole numbers."""
        many = self.first[term + 1] - self.first[term]
        ends = np.cumsum(many)
        posting = np.repeat(self.first[term] - (ends - many), many) + np.arange(many.sum())
        cell = np.repeat(doc, many) * len(self.items) + self.item[posting]
        size = n_docs * len(self.items)
        if float(self.weight.sum()) * 1e6 < 2.0**53:  # no sum can leave what doubles hold exactly
            summed = np.bincount(cell, (self.weight[posting] * np.repeat(share, many)).astype(np.float64), size)
            return summed.astype(np.int64).reshape(n_docs, -1)
        summed = np.zeros(size, np.int64)
        np.add.at(summed, cell, self.weight[posting] * np.repeat(share, many))
        return summed.reshape(n_docs, -1)


class Heaps:
    """The best ``k`` documents of each item: score falling, then null ids, then smaller ids."""

    def __init__(self, n_items: int, k: int) -> None:
        self.k = k
        self.floor = np.ones(n_items, np.int64)  # what a document must reach to enter
        self.kept = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)]
        self.waiting: list[list[np.ndarray]] = []
        self.n_waiting = 0

    def add(self, scores: np.ndarray, known: np.ndarray, doc_id: np.ndarray) -> None:
        doc, item = np.nonzero(scores >= self.floor)
        self.waiting.append([item, scores[doc, item], known[doc], doc_id[doc]])
        self.n_waiting += len(doc)
        if self.n_waiting > 20_000 + len(self.kept[0]) // 2:
            self.settle()

    def settle(self) -> None:
        item, score, known, doc_id = (np.concatenate(c) for c in zip(self.kept, *self.waiting, strict=True))
        order = np.lexsort((doc_id, known, -score, item))
        item, score, known, doc_id = item[order], score[order], known[order], doc_id[order]
        heads = np.searchsorted(item, item)
        place = np.arange(len(item)) - heads
        last = place == self.k - 1
        self.floor[item[last]] = np.maximum(score[last], 1)
        best = place < self.k
        self.kept = [item[best], score[best], known[best], doc_id[best]]
        self.waiting, self.n_waiting = [], 0


def _searched(sent, k: int):
    """Run counted documents (doc_id, m, terms, tfs) through the index that was sent."""

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = sent.value
        heaps = Heaps(len(index.items), k)
        most_docs = max(1, _CELLS // max(len(index.items), 1))
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("doc_id")
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            doc_id = ids.fill_null(0).to_numpy()
            m = batch.column("m").to_numpy()
            lists = batch.column("terms")
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            term = lists.flatten().to_numpy().astype(np.int64)
            tf = batch.column("tfs").flatten().to_numpy()
            doc = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            share = (1_000_000_000 * tf) // (1_000 * tf + 12 * m[doc])
            steps = np.concatenate([[0], np.cumsum(index.first[term + 1] - index.first[term])])[ends]
            a = 0
            while a < batch.num_rows:
                b = int(np.searchsorted(steps, steps[a] + _STEPS, "right")) - 1
                b = min(max(b, a + 1), a + most_docs, batch.num_rows)
                part = slice(ends[a], ends[b])
                scores = index.scores(doc[part] - a, term[part], share[part], b - a)
                heaps.add(scores, known[a:b], doc_id[a:b])
                a = b
        heaps.settle()
        item, score, known, doc_id = heaps.kept
        for a in range(0, len(item), 100_000):
            part = slice(a, a + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(index.items[item[part]]), pa.array(doc_id[part], mask=~known[part]), pa.array(score[part])],
                ["item", "doc_id", "score"],
            )

    return searched


def best_documents(docs: DataFrame, items: DataFrame, k: int = 20, most_postings: int = 2_000_000) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents of each item.

    ``docs`` has an integer doc_id and text, ``items`` item_id and text.  Terms are runs of
    ASCII letters and digits and of all characters beyond ASCII; only A-Z are lower-cased.
    Scores are the whole numbers of a BM25 with rounded weights: with N documents that have
    a term, L terms in all of them, n in one, a term's weight is
    ``floor(1000 ln((2N+2) / (2df+1)))``, a document's ``m = 75 + (25 n N) div L``, and each
    occurrence of a term in the item adds ``weight * ((10**9 tf) div (1000 tf + 12 m))``.
    Documents that score 0 are left out; equal scores go by doc_id, null first.

    Null or empty text has no term: such documents count nowhere, such items find nothing.
    Each row of ``docs`` is a document of its own, repeated rows included.  Rows of
    ``items`` that repeat item_id and text are one item; equal item_ids with other texts
    are items of their own, ranked apart, null ids alike.  Other columns are ignored.  An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    named = stage(
        items.select("item_id", text_of().alias("text")).distinct()
        .select(F.xxhash64("item_id", "text").alias("item"), "item_id", F.col("text").cast("binary").alias("text"))
    )
    terms = stage(named.select("item", "text").mapInArrow(_item_terms, "item long, term binary, times long"))
    shards = max(1, -(-terms.count() // most_postings))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    found = None
    for s in range(shards):
        # About ``most_postings`` rows: the bound of what the driver and each task hold.
        mine = terms.filter(F.pmod(F.xxhash64(F.lit("shard"), "item"), F.lit(shards)) == s).toArrow()
        if not mine.num_rows:
            continue
        words = mine.column("term").combine_chunks().dictionary_encode()
        number = words.indices.to_numpy()
        vocabulary = {t: i for i, t in enumerate(words.dictionary.to_pylist())}
        counted = stage(texts.mapInArrow(
            _counted(spark.sparkContext.broadcast(vocabulary)), "doc_id long, n long, terms array<int>, tfs array<long>"
        ))
        n_docs, n_terms = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
        holding = {
            r.term: r["count"] for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
        }
        weights = np.array([
            math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding.get(i, 0) + 1))) for i in range(len(vocabulary))
        ], np.int64)
        order = np.argsort(number, kind="stable")
        names, item = np.unique(mine.column("item").to_numpy(), return_inverse=True)
        index = Index(
            names, np.searchsorted(number[order], np.arange(len(vocabulary) + 1)),
            item[order], (weights[number] * mine.column("times").to_numpy())[order],
        )
        long = "decimal(38,0)"
        m = F.lit(75) + F.expr(
            f"(cast(n as decimal(12,0)) * cast({25 * n_docs} as decimal(22,0))) div cast({n_terms or 1} as {long})"
        )
        heaps = counted.filter(F.size("terms") > 0).select("doc_id", m.cast("bigint").alias("m"), "terms", "tfs").mapInArrow(
            _searched(spark.sparkContext.broadcast(index), k), "item long, doc_id long, score long"
        )
        found = heaps if found is None else found.unionByName(heaps)
    if found is None:
        found = spark.createDataFrame([], "item long, doc_id long, score long")
    merged = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(merged)).filter(F.col("rank") <= k)
    return named.select("item", "item_id").join(ranked, "item").select("item_id", "rank", "doc_id", "score")


def reversed_search_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return best_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


REVERSED_SEARCH_SQL = r"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
), held AS (
    SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL
), sizes AS (
    SELECT doc_id, sum(tf)::BIGINT AS n FROM held GROUP BY ALL
), corpus AS (
    SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes
), wanted AS (
    SELECT item_id, term, count(*) AS times FROM (
        SELECT item_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark) GROUP BY ALL
), weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM held CROSS JOIN corpus GROUP BY term, docs
), scores AS (
    SELECT item_id, doc_id,
        sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // terms))))::BIGINT AS score
    FROM wanted JOIN held USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id) CROSS JOIN corpus
    GROUP BY ALL
), ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
    FROM scores WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 20
"""

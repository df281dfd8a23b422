"""Find test items inside training documents: BM25 retrieval with block-max pruning.

The items are the indexed side.  Their postings carry BM25 impacts divided by the item's
score for its own text, so 1 means that a passage holds every term of the item, and one
threshold fits all items.  Items lie in blocks; the index knows the largest impact of
each term overall and in each block.  Every passage of every document is a query:

1. a passage whose list maxima do not add up to the threshold is skipped;
2. a block whose maxima do not add up to it is skipped;
3. what is left is scored exactly, and all items at or above the threshold are kept;
4. a kept item must also share enough word runs of its question and of its answer.

Passages overlap, and each item is searched in passages that follow from its own length:
steps of its number of words, rounded up to a power of two, and twice as long.  So each
occurrence lies inside one, and no other item changes what is found.  Items of one length
class share an index.  All classes are searched in one pass over the documents; only where
items have more than ``most_postings`` (item, term) pairs, the bound of what the driver and
a task hold, there is a pass for each further portion of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlark.llm.shared import stage, table, text_of
from ledgerlark.llm.words import hashed_words, text_batches, word_runs

K1, B = 1.2, 0.75
RUN = 3
BLOCK_ITEMS = 16
_SENTENCE_END = re.compile(r"[.!?:]\s+|\n+")


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentence or line is the answer; an item of one sentence is both."""
    cuts = [m for m in _SENTENCE_END.finditer(text) if text[m.end() :].strip()]
    if not cuts:
        return text, text
    return text[: cuts[-1].end()], text[cuts[-1].end() :]


def _part(text: str) -> tuple[bool, np.ndarray]:
    """Whether the part is too short for a run, and its runs, or else its words."""
    words, number = hashed_words([text])
    if len(words) < RUN:
        return True, np.unique(words)
    return False, np.unique(word_runs(words, number, RUN)[0])


@dataclass
class Shard:
    """The index of a bounded number of items."""

    terms: np.ndarray  # sorted term hashes
    first: np.ndarray  # where each term's postings begin
    item: np.ndarray  # postings: item number
    impact: np.ndarray  # postings: share of the item's own score
    list_max: np.ndarray  # largest impact of each term
    block_first: np.ndarray  # where each term's blocks begin
    block: np.ndarray  # blocks of items that hold the term
    block_max: np.ndarray  # and its largest impact in each
    ids: list
    parts: list  # of question and answer, each as from _part()
    half: int  # words from one passage to the next; a passage has twice as many


def build_shard(term: np.ndarray, item: np.ndarray, impact: np.ndarray, ids: list, texts: list[str], longest: int) -> Shard:
    order = np.lexsort((item, term))
    term, item, impact = term[order], item[order], impact[order]
    terms, first = np.unique(term, return_index=True)
    first = np.append(first, len(term))
    at = np.repeat(np.arange(len(terms)), np.diff(first))
    blocks = -(-len(ids) // BLOCK_ITEMS)
    cell, begin = np.unique(at * blocks + item // BLOCK_ITEMS, return_index=True)
    block_max = np.maximum.reduceat(impact, begin) if len(begin) else impact
    block_first = np.searchsorted(cell // max(blocks, 1), np.arange(len(terms) + 1))
    list_max = np.maximum.reduceat(impact, first[:-1]) if len(terms) else impact
    parts = [tuple(_part(p) for p in question_and_answer(t)) for t in texts]
    return Shard(
        terms, first, item, impact, list_max, block_first, cell % max(blocks, 1), block_max, ids, parts, max(longest, 8)
    )


def length_class(words: int) -> int:
    """Words of an item rounded up to a power of two, 8 at least."""
    return 1 << max(3, (words - 1).bit_length())


def _spread(first: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all entries of the lists ``of``, and the position in ``of`` of each."""
    many = first[of + 1] - first[of]
    at = np.repeat(np.arange(len(of)), many)
    return np.repeat(first[of] - (np.cumsum(many) - many), many) + np.arange(many.sum()), at


def _share(part: tuple[bool, np.ndarray], passage: tuple[np.ndarray, np.ndarray]) -> float:
    short, wanted = part
    return float(np.isin(wanted, passage[0 if short else 1]).mean()) if len(wanted) else 1.0


def matches(texts: list[str], shard: Shard, threshold: float, overlap: float) -> list[tuple[int, int, float, float, float]]:
    """``(text, item number, score, question overlap, answer overlap)``, best passage each."""
    ((_, found),) = portion_of([shard]).matches(texts, threshold, overlap)
    return found


@dataclass
class Portion:
    """The indexes of all length classes, and all their terms with the number each has in them."""

    shards: list[Shard]
    terms: np.ndarray
    local: list[np.ndarray]  # for each shard: the number of each term in it, or -1

    def matches(self, texts: list[str], threshold: float, overlap: float) -> Iterator[tuple[Shard, list]]:
        """What each shard finds; the words are hashed and looked up once for all of them."""
        words, number = hashed_words(texts)
        heads = np.searchsorted(number, np.arange(len(texts) + 1))
        spots, at = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(words) and len(self.terms):
            at = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
            spots = np.flatnonzero(self.terms[at] == words)
            at = at[spots]
        for shard, local in zip(self.shards, self.local, strict=True):
            term = local[at]
            held = term >= 0
            yield shard, _matches(words, number, heads, spots[held], term[held], shard, threshold, overlap)


def portion_of(shards: list[Shard]) -> Portion:
    terms = np.unique(np.concatenate([np.zeros(0, np.uint64), *(s.terms for s in shards)]))
    local = []
    for s in shards:
        numbers = np.full(len(terms), -1)
        numbers[np.searchsorted(terms, s.terms)] = np.arange(len(s.terms))
        local.append(numbers)
    return Portion(shards, terms, local)


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values of a sorted array, and the place of each element's value among them."""
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return values[new], np.cumsum(new) - 1


def _matches(
    words: np.ndarray, number: np.ndarray, heads: np.ndarray, spots: np.ndarray, at: np.ndarray,
    shard: Shard, threshold: float, overlap: float,
) -> list[tuple[int, int, float, float, float]]:
    """Matches of one shard, whose terms ``at`` stand at the places ``spots`` of ``words``."""
    if not len(spots):
        return []
    size = len(shard.terms)
    text = number[spots]
    base = (spots - heads[text]) // shard.half
    passages = np.maximum(-(-np.diff(heads) // shard.half) - 1, 1)
    offset = np.concatenate([[0], np.cumsum(passages)])
    # Each word lies in the passage that begins in its part and in the one before.
    here, before = base < passages[text], base > 0
    own = (offset[text] + base) * size + at
    key = np.sort(np.concatenate([own[here], own[before] - size]))
    key, _ = _numbered(key)
    passage, term = key // size, key % size

    slack = threshold - 1e-6
    names, row = _numbered(passage)
    alive = (np.bincount(row, shard.list_max[term]) >= slack)[row]
    passage, term = passage[alive], term[alive]
    if not len(term):
        return []
    # Blocks whose maxima add up to the threshold.
    names, row = _numbered(passage)
    blocks = -(-len(shard.ids) // BLOCK_ITEMS)
    entry, at_term = _spread(shard.block_first, term)
    cell, back = np.unique(row[at_term] * blocks + shard.block[entry], return_inverse=True)
    open_cells = cell[np.bincount(back, shard.block_max[entry]) >= slack]
    if not len(open_cells):
        return []
    # Exact scores of the items in open blocks.
    posting, at_term = _spread(shard.first, term)
    row, item = row[at_term], shard.item[posting]
    wanted = np.isin(row * blocks + item // BLOCK_ITEMS, open_cells)
    pair, back = np.unique(row[wanted] * len(shard.ids) + item[wanted], return_inverse=True)
    score = np.bincount(back, shard.impact[posting[wanted]], len(pair))
    good = score >= threshold - 1e-9
    best: dict[tuple[int, int], tuple[float, float, float]] = {}
    cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for p, s in zip(pair[good].tolist(), score[good].tolist(), strict=True):
        name, i = int(names[p // len(shard.ids)]), p % len(shard.ids)
        text = int(np.searchsorted(offset, name, "right")) - 1
        if name not in cache:
            start = heads[text] + (name - offset[text]) * shard.half
            stop = min(start + 2 * shard.half, heads[text + 1])
            held = words[start:stop]
            cache[name] = held, word_runs(held, number[start:stop], RUN)[0]
        q, a = (_share(part, cache[name]) for part in shard.parts[i])
        if q >= overlap and a >= overlap:
            best[text, i] = max(best.get((text, i), (0.0, 0.0, 0.0)), (min(s, 1.0), q, a))
    return [(t, i, *found) for (t, i), found in sorted(best.items())]


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, texts in text_batches(batch.column("text").to_pylist()):
            words, number = hashed_words(texts)
            pair, tf = np.unique(np.stack([number.astype(np.int64), words.astype(np.int64)]), axis=1, return_counts=True)
            total = np.bincount(number, minlength=len(texts))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item").slice(first, len(texts)).take(pa.array(pair[0])),
                    pa.array(pair[1]), pa.array(tf.astype(np.int64)), pa.array(total[pair[0]].astype(np.int64)),
                ],
                ["item", "term", "tf", "words"],
            )


def impacts(items: DataFrame) -> DataFrame:
    """``(item, term, impact, words)`` of ``(item, text)``: BM25 over all items, divided by the item's own score."""
    terms = stage(items.select("item", "text").mapInArrow(_item_terms, "item long, term long, tf long, words long"))
    sizes = terms.select("item", "words").distinct()
    n, mean = sizes.agg(F.count(F.lit(1)).alias("n"), F.avg("words").alias("m")).first()
    df = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(1 + (F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    length = F.lit(1 - B) + F.lit(B) * F.col("words") / F.lit(float(mean or 1.0))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * length)
    scored = terms.join(df, "term").select("item", "term", "words", weight.alias("w"))
    own = scored.groupBy("item").agg(F.sum("w").alias("own"))
    return scored.join(own, "item").select("item", "term", "words", (F.col("w") / F.col("own")).alias("impact"))


def _index(weights: DataFrame, named: DataFrame) -> Portion:
    """The items of ``weights`` in one index per length class."""
    rows = weights.toPandas()
    rows["half"] = rows["words"].map(length_class)
    texts = {r.item: r.text for r in named.select("item", "text").toLocalIterator()}
    shards = []
    for half, part in rows.groupby("half"):
        ids, number = np.unique(part["item"].to_numpy(), return_inverse=True)
        shards.append(build_shard(
            part["term"].to_numpy(np.int64).astype(np.uint64), number, part["impact"].to_numpy(np.float64),
            ids.tolist(), [texts[i] for i in ids.tolist()], int(half),
        ))
    return portion_of(shards)


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = 0.6,
    overlap: float = 0.5,
    most_postings: int = 2_000_000,
    carry: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``(*carry, item_id, score, question_overlap, answer_overlap)`` of every item found in a document.

    ``docs`` has doc_id and text, ``items`` item_id and text.  ``score`` is the BM25 score of
    the best passage as a share of the item's own; the overlaps are shares of the
    three-word runs of the item's question and answer that the passage holds.

    Null or empty text on either side finds nothing, as do items without a word.  Rows of
    ``items`` are searched one by one, whatever their ids: of several texts with one id, a
    null one included, the result has the best that a document holds.  Documents are told
    apart by ``carry`` and get each item_id once.  Texts are searched whole, however long.
    Other columns are ignored.  Empty tables give no rows.
    """
    spark = docs.sparkSession
    named = stage(
        items.select("item_id", text_of().alias("text")).distinct()
        .withColumn("item", F.xxhash64("item_id", "text"))
    )
    weights = stage(impacts(named))
    portions = max(1, -(-weights.count() // most_postings))
    portion = F.pmod(F.xxhash64(F.lit("portion"), "item"), F.lit(portions))
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in (docs.schema[c] for c in carry)]
    schema = ", ".join([*kinds, "item long, score double, question_overlap double, answer_overlap double"])
    all_found = None
    for p in range(portions):
        sent = spark.sparkContext.broadcast(_index(weights.filter(portion == p), named.filter(portion == p)))

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first, texts in text_batches(batch.column("text").to_pylist()):
                    for shard, found in sent.value.matches(texts, threshold, overlap):
                        if found:
                            t, i, *numbers = zip(*found, strict=True)
                            yield pa.RecordBatch.from_arrays(
                                [
                                    *[batch.column(c).take(pa.array([first + x for x in t])) for c in carry],
                                    pa.array([shard.ids[x] for x in i], pa.int64()),
                                    *[pa.array(x, pa.float64()) for x in numbers],
                                ],
                                [*carry, "item", "score", "question_overlap", "answer_overlap"],
                            )

        found = docs.select(*carry, "text").mapInArrow(search, schema)
        all_found = found if all_found is None else all_found.unionByName(found)
    best = F.max(F.struct("score", "question_overlap", "answer_overlap"))
    return (
        all_found.join(named.select("item", "item_id"), "item")
        .groupBy(*carry, "item_id").agg(best.alias("b")).select(*carry, "item_id", "b.*")
    )


def decontaminate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that training documents hold."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

"""How far the sources of a language differ in the words they use.

Each language has the vocabulary a count vectoriser with ``min_docs`` as minDF and no limit
of size would give it, and each document is counted over its terms exactly.  The counts are
added up per (lang, source) where they arise: a task holds the running sums of its groups,
and the document frequencies beside them, and passes them on when they grow too many.  One
shuffle by (lang, term) then gives sums, frequencies and vocabulary at once; the
vocabulary stays a table and is never gathered in one place.

The divergence of two sources is summed from the terms that either has; what neither has
is one product.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerlark.llm.reversed_search import term_bytes, term_slices
from ledgerlark.llm.shared import stage, table

ONE = 1_000_000_000
# Letters: a-z after lower-casing, and all bytes of characters beyond ASCII.
_LETTERS = term_bytes(b"abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100)))
# Running sums that a task holds before it passes them on.
MOST_SUMS = 400_000


def _sums(most_sums: int):
    """Documents to (lang, source, term, count, docs), added up within the task."""

    def passed_on(groups: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, docs) in groups.items():
            terms = list(counts)
            for a in range(0, len(terms), 50_000):
                part = terms[a : a + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(part)), pa.array([source] * len(part)),
                        pa.array(part, pa.binary()).cast(pa.string()),
                        pa.array(np.fromiter(map(counts.__getitem__, part), np.int64, len(part))),
                        pa.array(np.fromiter(map(docs.__getitem__, part), np.int64, len(part))),
                    ],
                    ["lang", "source", "term", "count", "docs"],
                )

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            for lang, source, text in zip(langs, sources, batch.column("text"), strict=True):
                counts, docs = groups.setdefault((lang, source), (Counter(), Counter()))
                before, once = len(counts), set()
                for terms in term_slices(text.as_py(), _LETTERS):
                    counts.update(terms)
                    once.update(terms)
                docs.update(once)
                held += len(counts) - before
                if held > most_sums:
                    yield from passed_on(groups)
                    groups, held = {}, 0
        yield from passed_on(groups)

    return summed


def group_counts(docs: DataFrame, min_docs: int = 3, most_sums: int = MOST_SUMS) -> tuple[DataFrame, DataFrame]:
    """``(lang, source)`` groups, and ``(lang, source, term, count)`` of kept terms, counts above 0."""
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    groups = stage(plain.select("lang", "source").distinct())
    sums = plain.withColumn("text", F.col("text").cast("binary")).mapInArrow(
        _sums(most_sums), "lang string, source string, term string, count long, docs long"
    )
    # All that follows is grouped by (lang, term) at least, so this is the only shuffle.
    added = sums.repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("count").alias("count"), F.sum("docs").alias("docs")
    )
    in_lang = F.sum("docs").over(Window.partitionBy("lang", "term"))
    kept = added.withColumn("in_lang", in_lang).filter(F.col("in_lang") >= min_docs)
    return groups, kept.select("lang", "source", "term", "count")


def _share(count: Column | str, total: str, terms: str) -> Column:
    """``1 + floor(10**9 (count + 1) / (total + terms))``, exact."""
    above = F.expr(f"cast({ONE} as decimal(10,0))") * (F.col(count) if isinstance(count, str) else count).cast("decimal(20,0)")
    # Without a kept term there is nothing to share and no value depends on it.
    below = F.greatest(F.col(total) + F.col(terms), F.lit(1)).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", above + F.lit(ONE).cast("decimal(20,0)"), below)


def _gap(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def divergences(
    docs: DataFrame, min_docs: int = 3, most_ranks: int = 200, most_sums: int = MOST_SUMS
) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` for every (lang, source) of ``docs``.

    A language keeps the terms (runs of letters, A-Z in lower case) that ``min_docs`` of its
    documents hold, V of them.  A group's share of a term is
    ``p = 1 + floor(10**9 (count + 1) / (N + V))`` with N occurrences of kept terms in the
    group; the language's own share is built alike.  ``f(p, q) = floor((p - q)**2 / q)``.
    Part ``pair`` gives each other source of the language with the sum of f over all kept
    terms, p the group's and q the other's.  Part ``term`` gives the ``most_ranks`` terms of
    the group with the largest f among those it holds more often than the language does.

    Null text, lang and source are read as ''.  A document without terms still makes its
    group occur; a language without kept terms has pairs with value 0.  Repeated rows are
    documents of their own.  Other columns are ignored.  An empty table gives no rows.
    """
    groups, counts = group_counts(docs, min_docs, most_sums)
    counts = stage(counts)
    in_lang = stage(counts.groupBy("lang", "term").agg(F.sum("count").alias("all")))
    langs = in_lang.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("all").alias("lang_n"))
    sizes = counts.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    sized = stage(
        groups.join(langs, "lang", "left").join(sizes, ["lang", "source"], "left")
        .fillna(0, ["v", "lang_n", "n"])
        .select("*", _share(F.lit(0), "n", "v").alias("zero"))
    )
    shares = stage(
        counts.join(sized.select("lang", "source", "n", "v", "zero"), ["lang", "source"])
        .select("lang", "source", "term", "count", "zero", _share("count", "n", "v").alias("p"))
    )
    return _pairs(sized, shares).unionByName(_terms_above(sized, shares, in_lang, most_ranks))


def _pairs(sized: DataFrame, shares: DataFrame) -> DataFrame:
    """All other sources of each group by their divergence.

    f of a term that only one side holds depends on its count alone, so those are folded
    to (share, number of terms) first.  Each sum is taken as what it has above that of two
    groups without the term, which all V terms add.
    """
    a = sized.select("lang", "source", "v", F.col("zero").alias("zero_a"))
    b = sized.select("lang", F.col("source").alias("item"), F.col("zero").alias("zero_b"))
    pairs = stage(a.join(b, "lang").filter("source <> item"))
    folded = stage(shares.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("terms")))
    base = _gap("zero_a", "zero_b")
    key = ["lang", "source", "item"]
    mine = pairs.join(folded, ["lang", "source"]).select(*key, (F.col("terms") * (_gap("p", "zero_b") - base)).alias("value"))
    theirs = pairs.join(folded.withColumnRenamed("source", "item"), ["lang", "item"]).select(
        *key, (F.col("terms") * (_gap("zero_a", "p") - base)).alias("value")
    )
    one = shares.select("lang", "term", "source", F.col("zero").alias("zero_a"), F.col("p").alias("p_a"))
    other = shares.select("lang", "term", F.col("source").alias("item"), F.col("zero").alias("zero_b"), F.col("p").alias("p_b"))
    shared = one.join(other, ["lang", "term"]).filter("source <> item").select(
        *key, (_gap("p_a", "p_b") - _gap("p_a", "zero_b") - _gap("zero_a", "p_b") + base).alias("value")
    )
    none = pairs.select(*key, (F.col("v") * base).alias("value"))
    summed = none.unionByName(mine).unionByName(theirs).unionByName(shared).groupBy(*key).agg(F.sum("value").alias("value"))
    return _ranked(summed, "pair")


def _terms_above(sized: DataFrame, shares: DataFrame, in_lang: DataFrame, most_ranks: int) -> DataFrame:
    """The terms each group has more of than its language."""
    langs = sized.select("lang", "lang_n", "v").distinct()
    whole = in_lang.join(langs, "lang").select("lang", "term", _share("all", "lang_n", "v").alias("q"))
    above = shares.join(whole, ["lang", "term"]).filter("p > q").select(
        "lang", "source", F.col("term").alias("item"), _gap("p", "q").alias("value")
    )
    return _ranked(above, "term").filter(F.col("rank") <= most_ranks)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank")
    )


def divergence_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of all sources of each language, and the terms that mark them."""
    return divergences(table(spark, sf_dir, "documents"))


DIVERGENCE_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
    FROM documents
), words AS (
    SELECT doc, lang, source, unnest(words) AS term FROM docs
), kept AS MATERIALIZED (
    SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 3
), vocabulary AS (
    SELECT lang, count(*) AS v FROM kept GROUP BY lang
), groups AS MATERIALIZED (
    SELECT DISTINCT lang, source FROM docs
), held AS MATERIALIZED (
    SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL
), of_group AS (
    SELECT lang, source, sum(n)::BIGINT AS total FROM held GROUP BY ALL
), of_lang AS (
    SELECT lang, term, sum(n)::BIGINT AS n, (sum(sum(n)) OVER (PARTITION BY lang))::BIGINT AS total FROM held GROUP BY lang, term
), shares AS MATERIALIZED (
    SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n,
        1 + (1000000000 * (coalesce(h.n, 0) + 1)) // (coalesce(t.total, 0) + v) AS p
    FROM groups g JOIN kept k USING (lang) JOIN vocabulary USING (lang)
    LEFT JOIN held h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term
    LEFT JOIN of_group t ON t.lang = g.lang AND t.source = g.source
), sums AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p)::BIGINT AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY ALL
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), above AS (
    SELECT s.lang, s.source, 'term' AS part, s.term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value
    FROM shares s JOIN (
        SELECT lang, term, 1 + (1000000000 * (n + 1)) // (total + v) AS q FROM of_lang JOIN vocabulary USING (lang)
    ) l ON l.lang = s.lang AND l.term = s.term
    WHERE s.n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM above)
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""

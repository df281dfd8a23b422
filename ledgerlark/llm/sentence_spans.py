"""Remove repeated passages by sliding spans of consecutive sentences.

Every run of ``span`` sentences of a document, or more where they are short, is hashed to
128 bits.  Runs that occur
more than once anywhere are found by a count that combines before its shuffle, so a
passage in a third of all documents is no heavier than others.  All occurrences but the
first one, in (doc_id, position) order, lose their sentences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlark.llm.shared import attach, keep_runs, stage, table, with_document_key

BLANKS = " \t\n\f\r"
# A sentence ends after a closing mark with blanks behind it, after a line break with
# blanks behind it, or with the text.
SENTENCE = r"(?s).+?(?:[.!?][ \t\n\f\r]+|\n[ \t\n\f\r]*|\z)"


def sentences(text: Column) -> Column:
    """All of the text as an array of sentences, each with the blanks that follow it."""
    return F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0))


def span_rows(docs: DataFrame, span: int, min_chars: int) -> DataFrame:
    """``(doc_id, _t, pos, n, a, b)``: hash (a, b) of the ``n`` sentences from ``pos`` on.

    ``n`` is ``span``, or more where those have fewer than ``min_chars`` characters: up to
    the sentence that reaches them, or the last one of the document.
    """
    cut = docs.select(
        "doc_id", "_t",
        F.transform(sentences(F.col("text")), lambda s: F.trim(s, F.lit(BLANKS))).alias("keys"),
    ).filter(F.size("keys") > 0)
    hashed = cut.select(
        "doc_id", "_t",
        F.transform("keys", lambda k: F.xxhash64(k)).alias("h"),
        F.transform("keys", lambda k: F.length(k)).alias("n"),
    )
    least = F.least(F.lit(span), F.size("h"))

    def taken(i: Column) -> Column:
        # No sentence but the first can be blank, so these always reach min_chars.
        ahead = F.slice("n", i + 1, F.lit(span + min_chars))
        begin = F.struct(F.lit(0).alias("chars"), F.lit(0).alias("n"))
        longer = F.aggregate(
            ahead, begin,
            lambda acc, x: F.when(acc["chars"] >= min_chars, acc).otherwise(
                F.struct((acc["chars"] + x).alias("chars"), (acc["n"] + 1).alias("n"))
            ),
            lambda acc: acc["n"],
        )
        chars = F.aggregate(F.slice("n", i + 1, least), F.lit(0), lambda x, y: x + y)
        return F.when(chars >= min_chars, least).otherwise(longer)

    runs = F.transform(
        F.sequence(F.lit(0), F.size("h") - least), lambda i: F.struct(i.alias("pos"), taken(i).alias("n"))
    )
    spans = hashed.select(
        "doc_id", "_t",
        F.explode(
            F.transform(
                runs,
                lambda r: F.struct(
                    r["pos"].alias("pos"), r["n"].alias("n"),
                    F.get(F.col("h"), r["pos"]).alias("a"),
                    F.xxhash64(F.slice("h", r["pos"] + 2, r["n"] - 1), r["n"]).alias("b"),
                ),
            )
        ).alias("s"),
    )
    return spans.select("doc_id", "_t", "s.pos", "s.n", "s.a", "s.b")


def removed_sentences(docs: DataFrame, span: int = 2, min_chars: int = 60) -> DataFrame:
    """``(doc_id, _t, dropped)``: sorted positions of the sentences each document loses."""
    spans = span_rows(docs, span, min_chars)
    # Written, so that the join is one of two plain shuffles and a hot span can be split.
    twice = stage(spans.groupBy("a", "b").count().filter("count > 1").select("a", "b"))
    repeated = stage(spans.join(twice, ["a", "b"], "left_semi"))
    first = repeated.groupBy("a", "b").agg(F.min(F.struct("doc_id", "_t", "pos")).alias("f"))
    first = first.select(
        F.col("f.doc_id").alias("_doc"), F.col("f._t").alias("_text"), F.col("f.pos").alias("_pos")
    )
    later = repeated.join(
        first,
        repeated["doc_id"].eqNullSafe(first["_doc"])
        & (repeated["_t"] == first["_text"])
        & (repeated["pos"] == first["_pos"]),
        "left_anti",
    )
    return later.groupBy("doc_id", "_t").agg(F.collect_set(F.struct("pos", "n")).alias("at")).select(
        "doc_id", "_t",
        F.array_sort(
            F.array_distinct(
                F.flatten(F.transform("at", lambda r: F.sequence(r["pos"], r["pos"] + r["n"] - 1)))
            )
        ).alias("dropped"),
    )


def drop_repeated_passages(docs: DataFrame, span: int = 2, min_chars: int = 60) -> DataFrame:
    """``(doc_id, n_sentences, n_removed, keep_runs, kept_text)`` for every row of ``docs``.

    Sentences are compared without the blanks at their ends.  A span is ``span``
    consecutive sentences, and those that follow until it has ``min_chars`` characters or
    the document ends; a document with fewer sentences is one span.  Sentences in any
    occurrence of a span but its first are removed; what stays is left as it was.  Where
    a passage does not end a document, its last sentences can stay if they have fewer than
    ``min_chars`` characters, as their spans reach beyond it.

    Null or empty text: no sentences.  Null doc_id: a document like any other, before all
    others.  Repeated rows (same doc_id and text) count once and each get the result.
    Other columns are ignored.  An empty table gives no rows.
    """
    keyed = with_document_key(docs)
    joined = attach(keyed, removed_sentences(keyed, span, min_chars)).select(
        "doc_id",
        sentences(F.col("text")).alias("_all"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("_dropped"),
    )
    runs = joined.select(
        "doc_id", "_all",
        F.size("_all").cast("bigint").alias("n_sentences"),
        F.size("_dropped").cast("bigint").alias("n_removed"),
        keep_runs(F.col("_dropped"), F.size("_all")).alias("keep_runs"),
    )
    kept = F.transform("keep_runs", lambda r: F.array_join(F.slice("_all", r["start"] + 1, r["length"]), ""))
    return runs.select("doc_id", "n_sentences", "n_removed", "keep_runs", F.array_join(kept, "").alias("kept_text"))


def sentence_spans_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences of passages that an earlier document, or place, already has."""
    return drop_repeated_passages(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_sentences", "n_removed",
        F.size("keep_runs").cast("bigint").alias("n_kept_runs"),
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )


SENTENCE_SPANS_SQL = r"""
WITH cut AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''),
        '(?s).+?(?:[.!?][ \t\n\f\r]+|\n[ \t\n\f\r]*|\z)') AS s
    FROM documents
), keys AS (
    SELECT doc_id, unnest(range(len(s))) AS pos, unnest(s) AS raw, len(s) AS n FROM cut
), trimmed AS (
    SELECT *, trim(raw, ' ' || chr(9) || chr(10) || chr(12) || chr(13)) AS key FROM keys
), sized AS (
    SELECT *, length(key) AS chars, sum(length(key)) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM trimmed
), ends AS (
    -- The second sentence, or the first one later at which the run has 60 characters, or the last one.
    SELECT s.doc_id, s.pos, coalesce(min(e.pos) FILTER (e.upto - s.upto + s.chars >= 60), max(e.pos)) AS last
    FROM sized s JOIN sized e ON e.doc_id = s.doc_id AND e.pos >= s.pos + least(2, s.n) - 1
    GROUP BY s.doc_id, s.pos
), keyed AS (
    SELECT doc_id, list(key ORDER BY pos) AS keys FROM trimmed GROUP BY doc_id
), spans AS (
    SELECT doc_id, pos, last, keys[pos + 1 : last + 1] AS run FROM ends JOIN keyed USING (doc_id)
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) AS occurrence FROM spans
), gone AS (
    SELECT DISTINCT doc_id, p FROM (
        SELECT doc_id, unnest(range(pos, last + 1)) AS p FROM numbered WHERE occurrence > 1)
), marked AS (
    SELECT k.doc_id, k.pos, k.raw, g.p IS NOT NULL AS dropped
    FROM keys k LEFT JOIN gone g ON g.doc_id = k.doc_id AND g.p = k.pos
), flagged AS (
    SELECT *, NOT dropped AND coalesce(lag(dropped) OVER (PARTITION BY doc_id ORDER BY pos), true) AS begins
    FROM marked
), told AS (
    SELECT doc_id, count(*) AS n, sum(dropped::INT) AS r, sum(begins::INT) AS k,
        coalesce(string_agg(raw, '' ORDER BY pos) FILTER (NOT dropped), '') AS kept
    FROM flagged GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_sentences, CAST(coalesce(r, 0) AS BIGINT) AS n_removed,
    CAST(coalesce(k, 0) AS BIGINT) AS n_kept_runs, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN told t ON t.doc_id = d.doc_id
"""

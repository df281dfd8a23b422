"""Drop lines that many documents share.

Only hashes travel.  Every line becomes ``(hash, document, position)``; the rows are
range-partitioned by hash and document and sorted by document and position inside a
range, so one pass over a range meets the occurrences of a line in order.  A line that
fills a third of the corpus is cut between documents and spreads over many ranges: its
document counts are added up per range before they meet.  What comes back for each
document is a run-length coded keep bitmap, never text.

The whole plan is made of DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlark.llm.shared import (
    attach, keep_runs, stage, table, text_of, with_document_key, with_text_key,
)

BLANKS = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _ascii_lower(value: Column) -> Column:
    """Lower-case A-Z only; ``lower`` does the work where no other capital is present."""
    other = F.regexp_like(value, F.lit(r"[[\p{IsUppercase}\p{Lt}]&&[^\x00-\x7F]]"))
    return F.when(other, F.translate(value, _UPPER, _UPPER.lower())).otherwise(F.lower(value))


def line_key(line: Column) -> Column:
    return _ascii_lower(F.trim(line, F.lit(BLANKS)))


def line_positions(docs: DataFrame, min_chars: int) -> DataFrame:
    """``(doc_id, _t, pos, h1, h2)``: every line with a key of at least ``min_chars``."""
    lines = docs.select("doc_id", "_t", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keyed = lines.select("doc_id", "_t", "pos", line_key(F.col("line")).alias("key"))
    return keyed.filter(F.length("key") >= min_chars).select(
        "doc_id", "_t", "pos",
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), F.col("key")).alias("h2"),
    )


def dropped_lines(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False
) -> DataFrame:
    """``(doc_id, _t, dropped)``: sorted positions of the lines each document loses.

    ``docs`` is keyed by :func:`with_document_key`.  With ``keep_first`` the first line
    in (doc_id, position) order of each key stays.  Documents that lose nothing are
    absent.
    """
    ordered = (
        line_positions(docs, min_chars)
        .repartitionByRange("h1", "h2", "doc_id", "_t")
        .sortWithinPartitions("h1", "h2", "doc_id", "_t", "pos")
    )
    # One row per key and document, folded where it lies: a range never cuts a document.
    # Written once, as the texts would be split anew for each of its two readers.
    runs = stage(
        ordered.groupBy("h1", "h2", "doc_id", "_t").agg(
            F.sort_array(F.collect_set("pos")).alias("at")
        )
    )
    # Written as well: a join of two plain shuffles lets a hot key be split.
    common = stage(
        runs.groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "_t")).alias("first"))
        .filter(F.col("n") >= min_docs)
    )
    hit = runs.join(common.select("h1", "h2", "first"), ["h1", "h2"])
    at = F.col("at")
    if keep_first:
        is_first = F.struct("doc_id", "_t").eqNullSafe(F.col("first"))
        at = F.when(is_first, F.slice(at, F.lit(2), F.greatest(F.size(at) - 1, F.lit(0)))).otherwise(at)
    return (
        hit.select("doc_id", "_t", at.alias("at"))
        .filter(F.size("at") > 0)
        .groupBy("doc_id", "_t")
        .agg(F.sort_array(F.flatten(F.collect_list("at"))).alias("dropped"))
    )


def drop_common_lines(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    keep_first: bool = False,
    carry: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """``carry`` columns, ``n_lines, n_dropped, keep_runs, kept_text`` for every row of ``docs``.

    A line's key is the line without blanks (space, tab to carriage return) at its ends,
    A-Z in lower case.  Keys of at least ``min_chars`` characters found in ``min_docs``
    documents or more lose their lines.  A document is a distinct (doc_id, text).
    ``keep_runs`` is the run-length coded keep bitmap: start and length of each run.

    Null or empty text: one empty line, whose key is too short to be dropped unless
    ``min_chars`` is 0.  Null doc_id: a document like any other.  Repeated rows count once
    and each get the result.  Columns that are not carried are ignored.  An empty table
    gives no rows.
    """
    drops = dropped_lines(with_document_key(docs), min_docs, min_chars, keep_first)
    rows = with_text_key(docs.select(*dict.fromkeys(["doc_id", "text", *carry])))
    carried = [F.col(c) for c in carry if c not in ("n_lines", "n_dropped", "keep_runs", "kept_text")]
    joined = attach(rows, drops).select(
        *carried,
        F.split(text_of(), "\n", -1).alias("_lines"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("_dropped"),
    )
    runs = joined.select(
        *carried, "_lines",
        F.size("_lines").cast("bigint").alias("n_lines"),
        F.size("_dropped").cast("bigint").alias("n_dropped"),
        keep_runs(F.col("_dropped"), F.size("_lines")).alias("keep_runs"),
    )
    kept = F.transform(
        "keep_runs", lambda r: F.array_join(F.slice("_lines", r["start"] + 1, r["length"]), "\n")
    )
    return runs.select(
        *carried, "n_lines", "n_dropped", "keep_runs", F.array_join(kept, "\n").alias("kept_text")
    )


def line_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines found in at least ten documents are dropped everywhere."""
    return drop_common_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


LINE_DEDUP_SQL = r"""
WITH lines AS (
    SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), common AS (
    SELECT key FROM keyed WHERE length(key) >= 1
    GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
    SELECT k.*, c.key IS NOT NULL AS gone FROM keyed k LEFT JOIN common c ON c.key = k.key
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(gone::INT) AS BIGINT) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

"""Labelled rows for fitting: a bounded sample without the held-out ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlark.llm.shared import stage


def held_out(doc_id: str = "doc_id") -> Column:
    """Every fifth document by checksum of its id; never used for fitting.  Null id: false."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def fitting_sample(docs: DataFrame, labels: DataFrame, label: str, most_rows: int) -> DataFrame:
    """``(doc_id, text, label)`` of at most ``most_rows`` labelled rows per label value.

    Rows that repeat doc_id and text count once, and a doc_id with both labels has none.
    The bound is on rows: ids first, those with the smallest hash, so that the texts of
    other documents are not moved; then the rows they have, however many share an id,
    again by smallest hash.  A repeated run fits the same rows.
    """
    usable = (
        labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("other"))
        .filter("label = other").select("doc_id", "label")
    )
    mixed = F.xxhash64(F.lit("fitting"), F.col("doc_id"))
    ids = _least(usable, most_rows, mixed, "doc_id")
    text = F.coalesce("text", F.lit(""))
    rows = stage(
        docs.select("doc_id", text.alias("text")).join(F.broadcast(ids), "doc_id")
        .dropDuplicates(["doc_id", "text"]).withColumn("row", F.xxhash64(F.lit("row"), "doc_id", "text"))
    )
    kept = _least(rows.select("doc_id", "row", "label"), most_rows, F.col("row"), "doc_id").select("doc_id", "row")
    return rows.join(F.broadcast(kept), ["doc_id", "row"], "left_semi").select("doc_id", "text", "label")


def _least(rows: DataFrame, most_rows: int, *by: Column | str) -> DataFrame:
    """At most ``most_rows`` of each label, first in the order of ``by``."""
    one, zero = (rows.filter(F.col("label") == value).orderBy(*by).limit(most_rows) for value in (1, 0))
    return one.unionByName(zero)

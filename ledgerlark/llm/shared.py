"""Helpers that several operators of this package use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlark.operators.settle import settle

__all__ = ["attach", "keep_runs", "packed", "settle", "stage", "table", "text_of", "unpacked", "with_document_key", "with_text_key"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(frame: DataFrame) -> DataFrame:
    """Write ``frame`` once as Parquet in the shared checkpoint folder and read it back.

    Unlike a checkpoint the copy is columnar and compressed, so readers take only the
    columns they need.
    """
    return settle(frame, compression="zstd")


def text_of(column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def with_document_key(docs: DataFrame) -> DataFrame:
    """``(doc_id, _t, text)`` and nothing else of ``docs``.

    ``_t`` is a hash of the text: rows that repeat a doc_id with another text stay
    apart, rows that repeat both get the same result.
    """
    text = text_of()
    return docs.select("doc_id", F.xxhash64(text, F.length(text)).alias("_t"), text.alias("text"))


def with_text_key(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` with ``_t`` beside them, to be joined by :func:`attach`."""
    text = text_of()
    return docs.withColumn("_t", F.xxhash64(text, F.length(text)))


def packed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and all other columns in one struct, so that no name can clash."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*rest, F.lit(0).alias("_end")).alias("_rest"))


def unpacked(rows: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """The columns of before :func:`packed`, in their order; ``new`` replaces some."""
    def value(c: str) -> Column:
        if c in new:
            return new[c].alias(c)
        return F.col(c) if c in ("doc_id", "text") else F.col("_rest")[c].alias(c)

    return rows.select(*[value(c) for c in columns])


def attach(docs: DataFrame, found: DataFrame, how: str = "left") -> DataFrame:
    """Join what was found per document, on (doc_id, _t); a null doc_id matches itself."""
    other = found.withColumnsRenamed({"doc_id": "_doc", "_t": "_text"})
    same = docs["doc_id"].eqNullSafe(other["_doc"]) & (docs["_t"] == other["_text"])
    return docs.join(other, same, how).drop("_doc", "_text")


def keep_runs(dropped: Column, n_pieces: Column) -> Column:
    """Run-length coded keep bitmap: (start, length) of each run of kept pieces."""
    edges = F.concat(F.array(F.lit(-1)), dropped, F.array(n_pieces))
    gaps = F.zip_with(
        F.slice(edges, F.lit(1), F.size(edges) - 1),
        F.slice(edges, F.lit(2), F.size(edges) - 1),
        lambda a, b: F.struct((a + 1).alias("start"), (b - a - 1).alias("length")),
    )
    return F.filter(gaps, lambda g: g["length"] > 0)

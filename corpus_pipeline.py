"""From raw documents to token ids, in five stages.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read
again as the next one's documents.  All but the last keep the columns of ``documents``.
Every stage names only the columns it needs, so tables with further columns pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlark.llm.decontaminate import contaminated
from ledgerlark.llm.line_dedup import drop_common_lines
from ledgerlark.llm.ngram_join import similar_documents
from ledgerlark.llm.pieces import encoded
from ledgerlark.llm.quality import fit_quality, quality_scores
from ledgerlark.llm.shared import (
    attach, packed, stage, table, unpacked, with_document_key, with_text_key,
)

QUALITY_AT = 0.3


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores below 0.3 go."""
    weights, bias = fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = quality_scores(packed(docs), weights, bias, carry=("doc_id", "text", "_rest"))
    return unpacked(scored.filter(F.col("score") >= QUALITY_AT), docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents or more share go; a document may become empty but stays.

    ``n_chars`` follows the text.
    """
    cleaned = drop_common_lines(packed(docs), carry=("doc_id", "_rest"))
    text = F.col("kept_text")
    return unpacked(cleaned, docs.columns, text=text, n_chars=F.length(text).cast("bigint"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays."""
    kept = similar_documents(with_document_key(docs)).filter("kept").select("doc_id", "_t").distinct()
    # Rows that repeat doc_id and text are copies too: one of them stays.
    rows = attach(with_text_key(packed(docs)), kept, "inner").dropDuplicates(["doc_id", "_t"])
    return unpacked(rows, docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    rows = with_text_key(packed(docs))
    hits = contaminated(rows, table(spark, sf_dir, "benchmark"), carry=("doc_id", "_t"))
    found = stage(hits.select("doc_id", "_t").distinct())
    return unpacked(attach(rows, found, "left_anti"), docs.columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, with proof that they decode to the same text."""
    # Worker processes go on to other stages, so they do not keep what they have learnt.
    return encoded(docs, kept_segments=150_000, stays=False)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("SentencePiece encoding and decoding", encoding_stage),
]

#: The classifier's weights, BM25 search and piece search are not SQL; the tests hold each
#: stage against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

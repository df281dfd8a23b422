"""Text quality: hashed word n-grams, logistic regression fitted by FTRL-proximal.

Features are counts of hashed tokens and token pairs, and of runs of one to three token
shapes (capital, upper, lower, digits, or the mark itself), divided by the number of
tokens.  A document's score is one sparse dot product, so it costs a lookup per feature.

Fitting takes a bounded sample of labelled rows, cut into shards by a hash of the id.
Every shard runs FTRL over its rows in a fixed order, and the weights are averaged
between rounds; only the weight vector (2**bits doubles) meets on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ledgerlark.llm.labelled import fitting_sample, held_out
from ledgerlark.llm.shared import stage, table
from ledgerlark.llm.words import code_points, mix, text_batches

BITS = 18
SCALE = 20.0
_KINDS = 0x3000  # characters with a class of their own; those beyond count as small letters
_SPACE, _LOWER, _UPPER, _DIGIT, _MARK = range(5)


def _kind_table() -> np.ndarray:
    kinds = np.full(_KINDS, _MARK, np.uint8)
    for c in range(_KINDS):
        ch = chr(c)
        if ch.isspace():
            kinds[c] = _SPACE
        elif ch.isdigit():
            kinds[c] = _DIGIT
        elif ch.isalpha():
            kinds[c] = _UPPER if ch.isupper() else _LOWER
    return kinds


_KIND = _kind_table()
_POWER = np.cumprod(np.full(64, 0x9E3779B97F4A7C15 | 1, np.uint64))


_LETTER = mix(np.arange(1, _KINDS + 1, dtype=np.uint64))


def _letters(points: np.ndarray) -> np.ndarray:
    codes = _LETTER[np.minimum(points, _KINDS - 1)]
    far = points >= _KINDS
    if far.any():
        codes[far] = mix(points[far].astype(np.uint64) + np.uint64(1))
    return codes


def features(texts: list[str], bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hashed feature, number of the text, tokens per text)`` for each occurrence.

    A token is a run of letters, of digits, or of marks.  Of tokens beyond 64 characters
    the hash repeats its 64 weights, so every character counts.
    """
    points = code_points("\n".join(texts))
    ends_at = np.cumsum([len(t) + 1 for t in texts])
    kind = _KIND[np.minimum(points, _KINDS - 1)] if len(points) else np.zeros(0, np.uint8)
    kind = np.where(points >= _KINDS, np.uint8(_LOWER), kind)
    group = np.where(kind == _UPPER, np.uint8(_LOWER), kind)
    head = np.flatnonzero(np.diff(group, prepend=np.uint8(_SPACE)) != 0)
    head = head[group[head] != _SPACE] if len(head) else head
    counts = np.zeros(len(texts), np.int64)
    if not len(head):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), counts
    edge = np.flatnonzero(np.append(np.diff(group) != 0, True)) + 1  # ends of all runs
    tail = edge[np.searchsorted(edge, head, "right")]
    n_chars = tail - head
    text_no = np.searchsorted(ends_at, head, "right")
    np.add.at(counts, text_no, 1)
    with np.errstate(over="ignore"):
        inside = group != _SPACE
        begin = np.cumsum(n_chars) - n_chars
        place = np.arange(int(n_chars.sum())) - np.repeat(begin, n_chars)
        token = mix(np.add.reduceat(_letters(points[inside]) * _POWER[place & 63], begin))
        upper = np.zeros(len(points) + 1, np.int64)
        np.cumsum(kind == _UPPER, out=upper[1:])
        n_upper = upper[tail] - upper[head]
        shape = group[head].astype(np.uint64)
        shape = np.where((group[head] == _LOWER) & (n_upper > 0), np.uint64(5), shape)
        shape = np.where((group[head] == _LOWER) & (n_upper == n_chars) & (n_chars > 1), np.uint64(6), shape)
        shape = mix(np.where(group[head] == _MARK, token, shape * np.uint64(977)))
        same = text_no[1:] == text_no[:-1]
        pair = mix(token[:-1] * np.uint64(31) + token[1:])[same]
        two = (shape[:-1] * np.uint64(37) + shape[1:])
        three = mix(two[:-1] * np.uint64(41) + shape[2:])[same[:-1] & same[1:]]
        found = np.concatenate([token, pair, shape ^ np.uint64(0xA5), mix(two)[same], three])
    numbers = np.concatenate([
        text_no, text_no[1:][same], text_no, text_no[1:][same], text_no[2:][same[:-1] & same[1:]],
    ])
    return (found >> np.uint64(64 - bits)).astype(np.int64), numbers, counts


def margins(texts: list[str], weights: np.ndarray, bias: float) -> np.ndarray:
    """Sparse dot products of the texts' features and the weights."""
    at, number, tokens = features(texts, int(len(weights)).bit_length() - 1)
    total = np.bincount(number, weights[at], len(texts)) if len(at) else np.zeros(len(texts))
    return bias + SCALE * total / np.maximum(tokens, 1)


def ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, int]],
    start: np.ndarray,
    epochs: int,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.1,
) -> np.ndarray:
    """Follow-the-regularised-leader over ``(indices, values, label)`` rows.

    ``start`` holds the weights the leader begins from; the last one is the bias.
    """
    n = np.full(len(start), 1e-6)
    z = -start * ((beta + np.sqrt(n)) / alpha + l2) - np.sign(start) * l1
    for _ in range(epochs):
        for at, value, label in rows:
            zi, ni = z[at], n[at]
            w = np.where(
                np.abs(zi) <= l1, 0.0,
                -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2),
            )
            p = 1.0 / (1.0 + np.exp(-np.clip(np.dot(w, value), -35, 35)))
            g = (p - label) * value
            after = ni + g * g
            z[at] = zi + g - (np.sqrt(after) - np.sqrt(ni)) / alpha * w
            n[at] = after
    return np.where(
        np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2)
    )


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    most_rows: int = 6_000,
    shards: int = 4,
    rounds: int = 2,
    epochs: int = 2,
    bits: int = BITS,
) -> tuple[np.ndarray, float]:
    """Weights and bias, fitted on at most ``most_rows`` labelled rows of each label.

    Without any usable labelled row all weights are zero and every score is 0.5.
    """
    size = 1 << bits
    sample = stage(
        fitting_sample(docs, labels, label, most_rows).select(
            F.pmod(F.xxhash64(F.lit("shard"), "doc_id"), F.lit(shards)).alias("shard"), "doc_id", "text", "label"
        )
    )
    weights = np.zeros(size + 1)
    for _ in range(rounds):
        start = sample.sparkSession.sparkContext.broadcast(weights)

        def one_shard(shard: pd.DataFrame) -> pd.DataFrame:
            rows = []
            shard = shard.sort_values(["doc_id", "label", "text"]).reset_index(drop=True)
            order = np.argsort(mix(np.arange(len(shard), dtype=np.uint64)), kind="stable")
            for i in order:
                at, _, tokens = features([shard.text[i]], bits)
                index, times = np.unique(at, return_counts=True)
                value = SCALE * times / max(int(tokens[0]), 1)
                rows.append((np.append(index, size), np.append(value, 1.0), int(shard.label[i])))
            fitted = ftrl(rows, start.value, epochs)  # noqa: B023 - used within the round
            index = np.flatnonzero(fitted)
            return pd.DataFrame({"at": index, "w": fitted[index]})

        # Averaged over shards; the driver receives at most one row per weight.
        mean = (
            sample.groupBy("shard").applyInPandas(one_shard, "at long, w double")
            .groupBy("at").agg((F.sum("w") / shards).alias("w")).toPandas()
        )
        weights = np.zeros(size + 1)
        weights[mean["at"].to_numpy(np.int64)] = mean["w"].to_numpy(float)
    return weights[:-1], float(weights[-1])


def quality_scores(
    docs: DataFrame, weights: np.ndarray, bias: float, carry: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """The ``carry`` columns and ``score`` for every row: the chance, 0 to 1, that its text is good.

    Null or empty text: the score of a text without features.  A null doc_id stays null,
    repeated rows each get a row, columns that are not carried are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast((weights, bias))
    carry = list(carry)
    rows = docs.select(*dict.fromkeys([*carry, "text"]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for _, texts in text_batches(batch.column("text").to_pylist()):
                scores.append(1.0 / (1.0 + np.exp(-np.clip(margins(texts, *sent.value), -35, 35))))
            values = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carry), pa.array(values)], [*carry, "score"]
            )

    schema = StructType([*docs.select(*carry).schema.fields, StructField("score", DoubleType())])
    return rows.mapInArrow(score, schema)


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents; labels of held-out documents are not used."""
    docs = table(spark, sf_dir, "documents")
    weights, bias = fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality_scores(docs, weights, bias).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )

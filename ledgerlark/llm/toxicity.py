"""Toxicity by compression distance between two zstandard dictionaries.

Both classes share a trained dictionary of ordinary text.  The toxic side adds a second
one, trained on the fragments of toxic text that ordinary text lacks.  A window of a
text is compressed with either; what the toxic dictionary saves, in bytes, is its
evidence.  A small logistic model over the savings of a text's windows, fitted on the
same bounded sample, turns them into a calibrated score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlark.llm.labelled import fitting_sample, held_out
from ledgerlark.llm.shared import table
from ledgerlark.llm.words import hashed_words, mix, word_runs

WINDOW_WORDS = 16
LEVEL = 9
EXTRA_BYTES = 1_024
_WORD = re.compile(r"\w+")
_SHORTEST, _LONGEST = 5, 10  # characters of a word's beginning


@dataclass(frozen=True)
class ToxicityModel:
    """Two dictionary contents and the calibration; a few tens of KB whatever the data."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]


def windows(text: str, size: int = WINDOW_WORDS) -> list[bytes]:
    """The text in lower case, cut into runs of ``size`` blank-separated words.

    Words of more than 400 characters are cut, so a window stays short.  All of the text
    is in some window.
    """
    words = []
    for word in text.lower().split():
        words += [word] if len(word) <= 400 else [word[i : i + 400] for i in range(0, len(word), 400)]
    return [" ".join(words[i : i + size]).encode("utf-8", "surrogatepass") for i in range(0, len(words), size)]


class _Sizes:
    """Compressed length of windows under one dictionary."""

    def __init__(self, content: bytes):
        if content:
            shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            shared.precompute_compress(level=LEVEL)
            plain = {"dict_data": shared}
        else:
            plain = {}
        self._compress = zstandard.ZstdCompressor(
            level=LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False, **plain
        ).compress

    def __call__(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter((len(self._compress(w)) for w in found), np.int64, len(found))


def evidence(saved: np.ndarray) -> np.ndarray:
    """A text's features: bytes saved per window, over all and in the best windows."""
    if not len(saved):
        return np.zeros(6)
    best = np.sort(saved)[-3:]
    return np.array([
        saved.mean(), best.mean(), best[-1], (saved >= 2).mean(), (saved >= 4).mean(),
        np.log1p((saved >= 3).sum()),
    ])


def _fragments(text: str) -> set[str]:
    """Beginnings of the text's words, each with the blank before it, and whole words."""
    found = set()
    for word in set(_WORD.findall(text.lower())):
        padded = f" {word[:400]} "
        found.update(padded[:n] for n in range(_SHORTEST, min(_LONGEST, len(padded)) + 1))
        found.add(padded)
    return found


def _stems(counts: dict[str, int]) -> dict[bytes, int]:
    """Of beginnings that continue one another, the longest that is nearly as frequent."""
    kept: dict[str, int] = {}
    for f in sorted(counts, key=lambda f: (len(f), f)):
        k = counts[f]
        before = next((f[:n] for n in range(len(f) - 1, 0, -1) if f[:n] in kept), None)
        if before is None:
            kept[f] = k
        elif k >= 0.9 * kept[before]:
            del kept[before]
            kept[f] = k
    return {f.encode("utf-8", "surrogatepass"): k for f, k in kept.items()}


def _unlike(texts: list[str]) -> list[str]:
    """The texts without those that share four of eight MinHashes with an earlier one."""
    seen: list[dict] = [{} for _ in range(8)]
    kept = []
    for text in texts:
        runs, _ = word_runs(*hashed_words([text]), 5)
        if not len(runs):
            continue
        mins = [int((mix(runs ^ np.uint64(i * 0x51ED + 1))).min()) for i in range(8)]
        shared = Counter(seen[i][v] for i, v in enumerate(mins) if v in seen[i])
        if not shared or shared.most_common(1)[0][1] < 4:
            kept.append(text)
            for i, v in enumerate(mins):
                seen[i].setdefault(v, len(kept))
    return kept


def _dictionary(size: int, samples: list[bytes]) -> bytes:
    """Trained content; joined samples where there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(dict.fromkeys(samples))[:size]


def fit(texts: list[str], labels: list[int]) -> ToxicityModel:
    """Train both dictionaries and the calibration on labelled texts."""
    toxic = [t for t, y in zip(texts, labels, strict=True) if y == 1]
    plain = [t for t, y in zip(texts, labels, strict=True) if y == 0]
    if not toxic or not plain:  # nothing to tell apart: one score for all
        share = (len(toxic) + 0.5) / (len(texts) + 1.0)
        return ToxicityModel(b"", b"", (float(np.log(share / (1 - share))), *[0.0] * 6))
    # Near copies would make the words of one text look typical of its class.
    unlike_toxic, unlike_plain = _unlike(toxic), _unlike(plain)
    n, m = max(len(unlike_toxic), 1), max(len(unlike_plain), 1)
    in_toxic, in_plain = Counter(), Counter()
    for text in unlike_plain:
        in_plain.update(_fragments(text))
    for text in unlike_toxic:
        in_toxic.update(_fragments(text))
    counts = _stems({
        f: k for f, k in in_toxic.items()
        if k >= max(2, 0.012 * n) and k * m > 25 * (in_plain[f] + 0.5) * n
    })
    picked = [f for f in sorted(counts) for _ in range(counts[f])]
    order = np.random.default_rng(1).permutation(len(picked))
    picked = [picked[i] for i in order[:40_000]]
    base_windows = [w for text in plain for w in windows(text, 8)]
    order = np.random.default_rng(2).permutation(len(base_windows))
    base = _dictionary(24_000, [base_windows[i] for i in order[:60_000]])
    extra = _dictionary(EXTRA_BYTES, picked)
    for f in sorted(counts, key=lambda f: (-counts[f], -len(f), f)):  # few samples train a short one
        if len(extra) + len(f) <= EXTRA_BYTES and f not in extra:
            extra = f + extra
    ordinary, both = base, extra + base

    less, more = _Sizes(ordinary), _Sizes(both)
    rows = []
    for text in texts:
        cut = windows(text)
        rows.append(evidence(less(cut) - more(cut)))
    x = np.column_stack([np.ones(len(rows)), np.array(rows)])
    return ToxicityModel(ordinary, both, tuple(_logistic(x, np.array(labels, float))))


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2) -> np.ndarray:
    """Newton steps for a logistic model of a handful of features, each class half the weight."""
    each = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum()) * len(y)
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        slope = x.T @ (each * (p - y)) + penalty * w
        bend = (x * (each * p * (1 - p))[:, None]).T @ x + (penalty + 1e-6) * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", most_rows: int = 2_000
) -> ToxicityModel:
    """Fit on at most ``most_rows`` labelled rows of each label, in one task."""
    sample = fitting_sample(docs, labels, label, most_rows)

    def train(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "label", "text"])
        model = fit(frame["text"].tolist(), frame["label"].tolist())
        return pd.DataFrame({"o": [model.ordinary], "t": [model.toxic], "w": [list(model.weights)]})

    rows = sample.withColumn("fit", F.lit(1)).groupBy("fit").applyInPandas(train, "o binary, t binary, w array<double>").collect()
    if not rows:
        return fit([], [])
    return ToxicityModel(bytes(rows[0].o), bytes(rows[0].t), tuple(rows[0].w))


def toxicity_scores(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``(doc_id, score)`` for every row: the chance, 0 to 1, that its text is toxic.

    Null or empty text: the score of a text without windows.  A null doc_id stays null,
    repeated rows each get a row, other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        less, more = _Sizes(sent.value.ordinary), _Sizes(sent.value.toxic)
        weights = np.array(sent.value.weights)
        for batch in batches:
            scores = []
            for text in batch.column("text").to_pylist():
                cut = windows(text or "")
                margin = weights[0] + evidence(less(cut) - more(cut)) @ weights[1:]
                scores.append(1 / (1 + np.exp(-np.clip(margin, -35, 35))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, score double")


def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents; labels of held-out documents are not used."""
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity_scores(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )

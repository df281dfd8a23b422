"""Every stage of the pipeline, and all of it, against plain versions; the classifiers' scores and samples too."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from test_decontamination import _plain as plain_decontamination

import corpus_pipeline
from ledgerlark.llm import pieces
from ledgerlark.llm.labelled import fitting_sample
from ledgerlark.llm.quality import SCALE, fit_quality, quality_query, quality_scores
from ledgerlark.llm.toxicity import LEVEL, fit_toxicity, toxicity_query

SF_DIR = "/root/testdata/sf0.001"
WHOLE = (1 << 64) - 1


def _mix(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & WHOLE
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & WHOLE
    return x ^ x >> 31


def _kind(c):
    if ord(c) >= 0x3000:
        return "a"
    if c.isspace():
        return " "
    if c.isdigit():
        return "0"
    return ("A" if c.isupper() else "a") if c.isalpha() else "."


def _plain_features(text, bits):
    """Counts of tokens, pairs, and one to three shapes, one character after the other."""
    tokens, shapes, codes = [], [], {"0": 3, ".": 4, "a": 1}
    runs = []
    for c in text:
        k = _kind(c)
        if runs and runs[-1][0] == k.lower():
            runs[-1][1].append(c)
        else:
            runs.append((k.lower(), [c]))
    for k, run in runs:
        if k == " ":
            continue
        power, total = 1, 0
        for i, c in enumerate(run):
            power = 0x9E3779B97F4A7C15 if i % 64 == 0 else power * 0x9E3779B97F4A7C15 & WHOLE
            total = (total + _mix(ord(c) + 1) * power) & WHOLE
        token = _mix(total)
        capitals = sum(_kind(c) == "A" for c in run)
        shape = codes[k]
        if k == "a" and capitals:
            shape = 6 if capitals == len(run) > 1 else 5
        tokens.append(token)
        shapes.append(_mix(token if k == "." else shape * 977))
    found = Counter()

    def add(value):
        found[value >> 64 - bits] += 1

    for i, (token, shape) in enumerate(zip(tokens, shapes, strict=True)):
        add(token)
        add(shape ^ 0xA5)
        if i:
            add(_mix((tokens[i - 1] * 31 + token) & WHOLE))
            two = (shapes[i - 1] * 37 + shape) & WHOLE
            add(_mix(two))
        if i > 1:
            add(_mix(((shapes[i - 2] * 37 + shapes[i - 1]) * 41 + shape) & WHOLE))
    return found, len(tokens)


def _plain_quality(text, weights, bias):
    found, n = _plain_features(text or "", int(math.log2(len(weights))))
    margin = bias + SCALE * sum(weights[f] * k for f, k in found.items()) / max(n, 1)
    return 1 / (1 + math.exp(-max(-35, min(35, margin))))


def _plain_lines(docs):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})

    held = Counter(k for _, t in docs for k in {key(x) for x in (t or "").split("\n")})
    return {
        (d, t): "\n".join(x for x in (t or "").split("\n") if not (key(x) and held[key(x)] >= 10)) for d, t in docs
    }


def _plain_kept(docs):
    """(doc_id, text) of one document of each group of near copies."""
    sets = {}
    for d, t in docs:
        w = re.findall(r"[^\W_]+", (t or "").lower())
        sets[d, t] = frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()
    names = sorted(sets, key=str)
    low = {k: (k[0], str(k[1])) for k in names}
    changed = True
    while changed:
        changed = False
        for a in names:
            for b in names:
                x, y = sets[a], sets[b]
                if low[a] > low[b] and x and y and len(x & y) >= 0.8 * len(x | y):
                    low[a], changed = low[b], True
    return {k for k in names if low[k] == (k[0], str(k[1]))}


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Good and poor documents, lines in nine and ten of them, near copies and benchmark items."""
    draw = random.Random(12)
    words = [f"{a}{b}" for a in ("ta", "lo", "mir", "sen", "du") for b in ("ne", "ra", "vos", "kel", "pim", "ul")]

    def prose(n):
        return " ".join(draw.choice(words) for _ in range(n)).capitalize() + "."

    items = [(i, f"What is the {draw.choice(words)}{i} of {prose(9)} It is {draw.choice(words)}{i} by {prose(6)}") for i in range(6)]
    docs = []
    for i in range(140):
        body = [prose(draw.randrange(30, 60)) for _ in range(2)]
        if i % 7 == 0:
            body = ["".join(draw.choice("#$%&!0123 ") for _ in range(200)), "BUY NOW!!! 77"]
        if 20 <= i < 34:
            body.insert(1, " Subscribe to our LETTER ")
        if 40 <= i < 49:
            body.insert(0, "In nine documents only")
        if i % 11 == 3:
            body.append("So: " + items[i % 6][1])
        docs.append((i, "\n".join(body)))
    for i in range(8):
        source = docs[draw.randrange(140)]
        docs.append((200 + i, source[1].replace(" ", "  ", 3) + " more" * (i % 3)))
    docs += [(300, None), (301, ""), (302, "one"), (303, docs[5][1]), (303, docs[5][1]), (303, "other text of that id"), (304, "one")]
    path = str(tmp_path_factory.mktemp("pipeline"))
    table = spark.createDataFrame(docs, "doc_id long, text string").selectExpr(
        "*", "'en' AS lang", "'web' AS source", "bigint(length(text)) AS n_chars", "'x' AS _t", "1 AS score"
    )
    table.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    labels = [(i, int(i % 7 != 0), 0) for i in range(140) if i % 3] + [(5, 0, 0), (None, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, items


def _pairs(frame):
    return sorted(((r.doc_id, r.text) for r in frame.collect()), key=str)


def test_every_stage_equals_a_plain_version(spark, sf_dir):
    path, items = sf_dir
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, left = docs.columns, _pairs(docs)
    quality, lines, near, clean, encode = (step for _, step in corpus_pipeline.STAGES)

    weights, bias = fit_quality(docs, spark.read.parquet(f"{path}/labels.parquet"))
    docs = quality(spark, docs, path).checkpoint()
    want = [(d, t) for d, t in left if _plain_quality(t, weights, bias) >= 0.3]
    assert docs.columns == columns and _pairs(docs) == want and 100 < len(want) < len(left)
    assert not {0, 7, 14, 133} & {d for d, _ in want}

    docs, left = lines(spark, docs, path).checkpoint(), want
    kept = _plain_lines(left)
    want = sorted(((d, kept[d, t]) for d, t in left), key=str)
    assert docs.columns == columns and _pairs(docs) == want
    assert not any("Subscribe" in t for _, t in want) and any("nine documents" in t for _, t in want)
    assert all(r.n_chars == len(r.text) for r in docs.collect())

    docs, left = near(spark, docs, path).checkpoint(), want
    want = sorted(_plain_kept(left), key=str)
    assert docs.columns == columns and _pairs(docs) == want and len(want) < len(set(left)) - 5

    docs, left = clean(spark, docs, path).checkpoint(), want
    # Told apart by id and text, as the stage does.
    hit = {left[n] for n, _ in plain_decontamination([(n, t) for n, (_, t) in enumerate(left)], items)}
    want = [k for k in left if k not in hit]
    assert docs.columns == columns and _pairs(docs) == want and len(hit) > 5

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.VOCABULARY)
    plain = sorted((d, library.encode(t), True) for d, t in want)
    for result in (encode(spark, docs, path), corpus_pipeline.run(spark, path)):
        assert sorted((r.doc_id, list(r.ids), r.round_trip) for r in result.collect()) == plain


def test_quality_scores_equal_a_plain_version(spark, documents, odd_rows):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    weights, bias = fit_quality(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in quality_query(spark, SF_DIR).collect():
        assert r.score == pytest.approx(_plain_quality(texts[r.doc_id], weights, bias), abs=1e-9)
    odd = sorted(_plain_quality(t, weights, bias) for _, t in odd_rows)
    assert sorted(r.score for r in quality_scores(documents(odd_rows), weights, bias).collect()) == pytest.approx(odd, abs=1e-9)


def test_toxicity_scores_equal_plain_compression_lengths(spark):
    import zstandard

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = fit_toxicity(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    texts = {r.doc_id: r.text for r in docs.collect()}

    def length(window, content):
        shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        plain = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=shared, write_checksum=False, write_content_size=False, write_dict_id=False
        )
        return len(plain.compress(window))

    rows = toxicity_query(spark, SF_DIR).orderBy("doc_id").limit(40).collect()
    for r in rows:
        words = [w[i : i + 400] for w in texts[r.doc_id].lower().split() for i in range(0, len(w), 400)]
        cut = [" ".join(words[i : i + 16]).encode() for i in range(0, len(words), 16)]
        saved = sorted(length(w, model.ordinary) - length(w, model.toxic) for w in cut)
        told = [0.0] * 6
        if saved:
            told = [
                sum(saved) / len(saved), sum(saved[-3:]) / len(saved[-3:]), saved[-1],
                sum(s >= 2 for s in saved) / len(saved), sum(s >= 4 for s in saved) / len(saved),
                math.log(1 + sum(s >= 3 for s in saved)),
            ]
        margin = model.weights[0] + float(np.dot(told, model.weights[1:]))
        assert r.score == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-9)


def test_the_fitting_sample_is_bounded_in_rows(spark):
    one, *free = [i for i in range(1, 400) if zlib.crc32(str(i).encode()) % 5]
    torn, told_twice = [i for i in free if i % 2 == 0][:2]
    rows = [(one, f"text {i}") for i in range(5_000)] + [(i, f"own {i}") for i in range(one + 1, 300)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = [(one, 1)] + [(i, i % 2) for i in range(one + 1, 300)]
    labels += [(torn, 1), (told_twice, 0), (free[5], None), (None, 1), (free[6], 2)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int")
    small = fitting_sample(docs, frame, "quality", 10).collect()
    assert Counter(r.label for r in small) == {0: 10, 1: 10}
    assert sorted(map(tuple, small)) == sorted(map(tuple, fitting_sample(docs, frame, "quality", 10).collect()))
    every = fitting_sample(docs, frame, "quality", 100_000).collect()
    held = {r.doc_id for r in every}
    assert len(every) == len({(r.doc_id, r.text) for r in every}) and torn not in held and told_twice in held
    assert held == {one, *free} - {torn} - set(range(300, 400))
    assert all(r.label == (1 if r.doc_id == one else r.doc_id % 2) for r in every)
    assert fitting_sample(docs, frame.limit(0), "quality", 10).count() == 0

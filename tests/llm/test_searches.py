"""Ranked lexical search, exact top-k search and source divergence against plain versions."""

import math
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from ledgerlark.llm.divergence import divergences
from ledgerlark.llm.impact_search import ImpactIndex, best_products, exact_products
from ledgerlark.llm.reversed_search import Heaps, best_documents, term_slices

_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _terms(text, pattern=_WORDS):
    return pattern.findall((text or "").translate(_LOW))


def _id(value):
    return (value is not None, value)


def _plain_search(docs, items, k):
    counted = [(d, Counter(_terms(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, n_terms = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in set(items):
        found = []
        for d, c in counted:
            m = 75 + 25 * c.total() * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in _terms(text)
            )
            found += [(score, d)] if score > 0 else []
        found.sort(key=lambda r: (-r[0], _id(r[1])))
        out += [(item, rank, d, score) for rank, (score, d) in enumerate(found[:k], 1)]
    return sorted(out, key=repr)


def _texts(seed, n):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["É", "é", "Straße", "A1", "a1", "x-y", "日本"]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [" ".join(draw.choices(words, weights, k=draw.choice([0, 1, 5, 30, 90]))) for _ in range(n)]


@pytest.mark.parametrize("most_postings", [2_000_000, 7])
def test_search_equals_a_plain_version(spark, documents, odd_rows, most_postings):
    rows = [*odd_rows, *enumerate(_texts(1, 60), 100), *((i, "tie w1 w2") for i in range(300, 330)), (320, "tie w1 w2")]
    items = [(i, t) for i, t in enumerate(_texts(2, 9))]
    items += [(3, "another text of the same id w1"), (0, items[0][1]), (None, "w1 a@b.cd é"), (20, None), (21, "!!"), (22, "none such"), (23, "tie")]
    benchmark = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS term", "'x' AS item")
    found = best_documents(documents(rows), benchmark, 20, most_postings).collect()
    assert sorted((tuple(r) for r in found), key=repr) == _plain_search(rows, items, 20)
    tied = [r for r in found if r.item_id == 23]
    assert [r.doc_id for r in sorted(tied, key=lambda r: r.rank)] == list(range(300, 320))


def test_search_of_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "of nobody")], "item_id long, text string")
    assert best_documents(documents([(1, "a")]), none).collect() == []
    assert best_documents(documents([]), some).collect() == []
    assert best_documents(documents([(1, None), (2, "..")]), some).collect() == []


def test_terms_are_cut_alike_in_slices():
    text = ("Ab-cd É日本 9z\n" * 200_000).encode()
    slices = list(term_slices(text))
    assert len(slices) > 1 and [t.decode() for s in slices for t in s] == _terms(text.decode())


def test_heaps_keep_the_best_of_each_item():
    draw = np.random.default_rng(2)
    heaps, rows = Heaps(3, 4), []
    for _ in range(30):
        scores, ids = draw.integers(0, 9, (50, 3)), draw.integers(0, 1_000_000, 50)
        known = draw.random(50) < 0.9
        heaps.add(scores, known, np.where(known, ids, 0))
        rows += [(i, -s, k, int(d) if k else 0) for r, k, d in zip(scores.tolist(), known.tolist(), ids, strict=True) for i, s in enumerate(r) if s]
        assert len(heaps.kept[0]) <= 12
    heaps.settle()
    plain = [r for i in range(3) for r in sorted(x for x in rows if x[0] == i)[:4]]
    assert [(i, -s, k, d) for i, s, k, d in zip(*(c.tolist() for c in heaps.kept), strict=True)] == plain


def _plain_products(rows, k):
    whole = {}
    for name, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole[name, tuple(v)] = [math.floor(1024 * x) for x in v]
    out = []
    for (q, qv), a in whole.items():
        if q is None or q % 100:
            continue
        scores = [
            (sum(x * y for x, y in zip(a, b, strict=True)), c)
            for (c, cv), b in whole.items() if (c, cv) != (q, qv) and len(a) == len(b)
        ]
        scores.sort(key=lambda r: (-r[0], _id(r[1])))
        out += [(q, rank, c, max(-(2**63), min(2**63 - 1, s))) for rank, (s, c) in enumerate(scores[:k], 1)]
    return sorted(out, key=repr)


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr(
        "*", "'x' AS key", "'y' AS block", "1 AS value", "2 AS rank"
    )


@pytest.mark.parametrize("block_rows, chunk_rows", [(20_000, 20_000), (150, 3)])
def test_products_equal_a_plain_version(spark, block_rows, chunk_rows):
    draw = np.random.default_rng(4)
    near = draw.normal(size=(6, 16))
    rows = [(i, (near[i % 6] + draw.normal(size=16) * 0.3).tolist()) for i in range(700)]
    rows += [(1_000 + i, [0.5] * 16) for i in range(300)]  # ties
    rows += [
        (None, [0.5] * 16), (None, [0.5] * 16), (5_000, None), (5_100, [0.0, None]), (5_200, [float("nan"), 1.0]),
        (5_300, [float("inf"), 1.0]), (5_400, [0.1, -0.1]), (5_401, [0.2, 0.3]), (5_500, []), (5_501, []),
        (5_600, [1e300, 1.0, 2.0]), (5_601, [-1e200, 3.0, 4.0]), (5_602, [1e-9, -1e-9, 0.0]), (300, [9.0] * 16),
        (5_700, [1e306]), (5_701, [1.0]),
    ]
    found = best_products(_vectors(spark, [*rows, rows[100]]), rows_asked(), 10, block_rows=block_rows, chunk_rows=chunk_rows, few=20)
    # Beyond the doubles after scaling: no part.
    plain = _plain_products([r for r in rows if r[0] != 5_700], 10)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain
    assert found.columns == ["query_id", "rank", "vec_id", "score"]


def rows_asked():
    from pyspark.sql import functions as F

    return F.col("vec_id") % 100 == 0


def test_products_of_no_vectors(spark):
    assert best_products(_vectors(spark, []), rows_asked()).collect() == []
    assert best_products(_vectors(spark, [(100, [1.0])]), rows_asked()).collect() == []


def test_index_stops_on_proof():
    draw = np.random.default_rng(5)
    x = draw.normal(size=(4_000, 64))
    x[:30] = x[0] + draw.normal(size=(30, 64)) * 0.1
    whole = np.floor(1024 * x / np.linalg.norm(x, axis=1, keepdims=True))
    index = ImpactIndex(whole)
    for q in (0, 5, 100):
        rows = index.possible(whole[q], 10, q, 256)
        scores = whole @ whole[q]
        scores[q] = -np.inf
        tenth = np.sort(scores)[-10]
        assert q not in rows and set(np.flatnonzero(scores >= tenth)) <= set(rows.tolist())
        assert len(rows) < 2_000
    big = np.array([[2.0**40, 1.0], [2.0**31, 2.0**31]])
    assert exact_products(big, np.array([2.0**20, 3.0])).tolist() == [2**60 + 3, 2**51 + 3 * 2**31]


def _plain_divergences(rows, min_docs, most_ranks):
    docs = [(lang or "", source or "", _terms(text, _LETTERS)) for lang, source, text in rows]
    groups = sorted({d[:2] for d in docs})
    held, counts = Counter(), defaultdict(Counter)
    for lang, source, terms in docs:
        held.update({(lang, t) for t in terms})
        counts[lang, source].update(terms)
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (x, t), n in held.items() if x == lang and n >= min_docs]
        sources = [s for x, s in groups if x == lang]

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (count[t] + 1) // total for t in kept}

        own = {s: shares(counts[lang, s]) for s in sources}
        whole = shares(sum((counts[lang, s] for s in sources), Counter()))

        def f(p, q):
            return (p - q) ** 2 // q

        values = {(s, "pair"): [] for s in sources}
        for a, b in permutations(sources, 2):
            values[a, "pair"].append((b, sum(f(own[a][t], own[b][t]) for t in kept)))
        for s in sources:
            values[s, "term"] = [(t, f(own[s][t], whole[t])) for t in kept if counts[lang, s][t] and own[s][t] > whole[t]]
        for (s, part), found in values.items():
            found.sort(key=lambda r: (-r[1], r[0].encode()))
            for rank, (item, value) in enumerate(found, 1):
                if part == "pair" or rank <= most_ranks:
                    out.append((lang, s, part, item, value, rank))
    return sorted(out)


@pytest.mark.parametrize("most_sums", [400_000, 9])
def test_divergences_equal_a_plain_version(spark, most_sums):
    draw, rows = random.Random(6), []
    for i, text in enumerate(_texts(7, 150)):
        rows.append((draw.choice(["en", "en", "fr", None, "d\0e"]), draw.choice(["web", "news", None, "é"]), text))
    rows += [("it", "a", "uno"), ("it", "b", "due"), ("it", "c", None), ("pt", "only", "um um"), ("pt", "only", "um"), ("pt", "only", "UM dois")]
    rows += [("en", "long", " ".join(f"w{i % 41}" for i in range(60_000)))]
    frame = spark.createDataFrame(rows, "lang string, source string, text string").selectExpr("*", "1 AS term", "2 AS p", "'x' AS item")
    found = divergences(frame, 3, 5, most_sums)
    assert sorted(tuple(r) for r in found.collect()) == _plain_divergences(rows, 3, 5)


def test_divergences_of_no_documents(spark):
    assert divergences(spark.createDataFrame([], "lang string, source string, text string")).collect() == []

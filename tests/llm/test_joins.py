"""The n-gram join, the lattice and their graph helpers against brute force."""

import random

import numpy as np
import pytest

from ledgerlark.llm.graph import components, tiles
from ledgerlark.llm.lattice import near_vectors, nearest_e8, shortest_vectors
from ledgerlark.llm.ngram_join import common_counts, least_matches, ngram_join, shingle_sets


def _components(ids, links):
    low = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


def test_ngram_join_equals_brute_force(spark):
    draw = random.Random(3)
    texts = []
    for _ in range(12):
        base = [f"w{draw.randrange(400)}" for _ in range(draw.choice([4, 30, 90]))]
        for _ in range(draw.randrange(1, 9)):
            copy = list(base)
            for _ in range(draw.randrange(3)):
                copy[draw.randrange(len(copy))] = f"w{draw.randrange(400)}"
            texts.append(" ".join(copy))
    grams = []
    for t in texts:
        w = t.split()
        grams.append({" ".join(w[i : i + 5]) for i in range(len(w) - 4)} or {t})
    links = [
        (i, j) for i in range(len(texts)) for j in range(i)
        if len(grams[i] & grams[j]) >= 0.8 * len(grams[i] | grams[j])
    ]
    low = _components(range(len(texts)), links)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = ngram_join(docs).orderBy("doc_id").collect()
    assert [r.n_links for r in found] == [sum(i in p for p in links) for i in range(len(texts))]
    assert [r.class_id for r in found] == [low[i] for i in range(len(texts))]
    assert [r.kept for r in found] == [low[i] == i for i in range(len(texts))]


def test_ngram_join_of_odd_rows(documents, odd_rows):
    found = {(r.doc_id, r.n_links, r.class_id, r.kept) for r in ngram_join(documents(odd_rows)).collect()}
    assert (5, 1, 5, True) in found and (2, 0, 2, True) in found and (None, 0, None, True) in found
    assert ngram_join(documents([])).collect() == []


def test_pruning_keeps_pairs_at_the_threshold():
    least = least_matches(0.8, 1e-8)
    assert list(least) == sorted(least) and least[-1] < 0.8 * 128
    assert least_matches(0.8, 1e-2)[-1] > least[-1]


def test_common_counts_either_way():
    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(0, 300, 80).astype(np.uint64)) for _ in range(70)]
    x, y = np.triu_indices(70, 1)
    plain = [len(np.intersect1d(sets[i], sets[j])) for i, j in zip(x, y, strict=True)]
    assert len(x) > 2_000 and common_counts(sets, x, y).tolist() == plain
    assert common_counts(sets, x[:50], y[:50]).tolist() == plain[:50]


def test_shingles_ignore_case_and_marks():
    a, b, c = shingle_sets(["One, two three FOUR five six", "one two three four five six!", "one two"], 5)
    assert a.tolist() == b.tolist() and len(a) == 2 and len(c) == 1


def test_components_and_tiles(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)]
    found = dict(map(tuple, components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert {found[i] for i in range(41)} == {0} and found[101] == 100 and len(found) == 43
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
    members = spark.createDataFrame([(i, 0, 1) for i in range(25)] + [(50, 50, 1)], "node long, component long, n long")
    met = {}
    for r in tiles(members, "n", 10, 100).collect():
        met.setdefault((r.component, r.i, r.j), []).append((r.node, r.chunk))
    pairs = []
    for (_, i, j), rows in met.items():
        pairs += [
            tuple(sorted((a, b))) for a, p in rows for b, q in rows
            if a != b and p == i and q == j and (i != j or a < b)
        ]
    assert len(pairs) == len(set(pairs)) == 25 * 24 // 2


def test_lattice_points():
    assert len(shortest_vectors()) == 240
    x = np.random.default_rng(0).normal(size=(200, 8)) * 2
    point = nearest_e8(x)
    away = ((x - point) ** 2).sum(axis=1)
    assert away.max() <= 1 + 1e-9
    for v in shortest_vectors():
        assert (((x - point - v) ** 2).sum(axis=1) >= away - 1e-9).all()


@pytest.fixture(scope="module")
def vectors(spark):
    draw = np.random.default_rng(4)
    rows = []
    for _ in range(40):
        base = draw.normal(size=64)
        for _ in range(draw.integers(1, 9)):
            rows.append((base + draw.normal(size=64) * draw.choice([0.1, 0.3, 0.45])).tolist())
    return rows


def test_near_vectors_against_brute_force(spark, vectors):
    table = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    x = np.array(vectors)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    true = np.argwhere(np.triu(x @ x.T >= 0.9, 1))
    found = near_vectors(table).orderBy("vec_id").collect()
    links = sum(r.n_links for r in found) / 2
    assert 0.97 * len(true) <= links <= len(true)
    low = _components(range(len(x)), true.tolist())
    assert np.mean([r.component_id == low[r.vec_id] for r in found]) > 0.95


def test_odd_vectors(spark):
    rows = [
        (1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, [1.0, 2.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [1.0, None]),
        (8, [float("nan"), 1.0]), (9, [float("inf"), 1.0]), (10, [1.0, 2.0, 0.0]), (None, [-5.0, 1.0]), (1, [1.0, 2.0]),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS node", "2 AS h")
    found = {(r.vec_id, r.n_links, r.component_id) for r in near_vectors(table).collect()}
    assert {(1, 3, 1), (2, 3, 1), (3, 3, 1), (4, 0, 4), (7, 0, 7), (8, 0, 8), (10, 0, 10), (None, 0, None)} <= found
    assert near_vectors(table.limit(0)).collect() == []

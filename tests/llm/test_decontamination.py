"""Which rows and items the decontamination tells apart."""

import math
import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from ledgerlark.llm.decontaminate import contaminated, decontaminate_query

ITEM = "Name the river behind seven green hills."


def test_rows_that_share_an_id_with_a_contaminated_row_stay(spark, documents, tmp_path):
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents([(1, "x " + ITEM), (1, "clean text"), (None, ITEM), (None, "clean as well"), (None, None), (2, ITEM)])
    kept = corpus_pipeline.decontamination_stage(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == [
        "(1, 'clean text')", "(None, 'clean as well')", "(None, None)"
    ]


def _words(text):
    return re.findall(r"[^\W_]+", text.lower())


def _runs(words):
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)} if len(words) >= 3 else set(words)


def _plain(docs, items, threshold=0.6, overlap=0.5):
    """BM25 of every passage of every document against every item, and the overlap rule."""
    items = sorted({(i, t) for i, t in items if _words(t)}, key=str)
    counted = [Counter(_words(t)) for _, t in items]
    n, mean = len(items), sum(c.total() for c in counted) / max(len(items), 1)
    df = Counter(t for c in counted for t in c)
    best = {}
    for (item, text), c in zip(items, counted, strict=True):
        weight = {
            t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * c.total() / mean))
            for t, tf in c.items()
        }
        own, half = sum(weight.values()), 8
        while half < c.total():
            half *= 2
        cuts = [m.end() for m in re.finditer(r"[.!?:]\s+|\n+", text) if text[m.end() :].strip()]
        question, answer = (text[: cuts[-1]], text[cuts[-1] :]) if cuts else (text, text)
        for doc_id, body in docs:
            words = _words(body or "")
            for a in range(0, max(len(words) - half, 1), half):
                passage = words[a : a + 2 * half]
                present = set(passage)
                score = sum(w for t, w in weight.items() if t in present) / own
                if score < threshold - 1e-9:
                    continue
                shares = []
                for part in (_words(question), _words(answer)):
                    wanted, held = _runs(part), _runs(passage) if len(part) >= 3 else set(passage)
                    shares.append(len(wanted & held) / len(wanted) if wanted else 1.0)
                if min(shares) >= overlap:
                    best[doc_id, item] = max(best.get((doc_id, item), (0,)), (min(score, 1.0), *shares))
    return best


def _found(spark, documents, docs, items, **settings):
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS item", "1 AS words")
    rows = contaminated(documents(docs), table, **settings).collect()
    assert len({(r.doc_id, r.item_id) for r in rows}) == len(rows)
    return {(r.doc_id, r.item_id): (r.score, r.question_overlap, r.answer_overlap) for r in rows}


def _same(found, want):
    assert found.keys() == want.keys()
    assert all(found[k] == pytest.approx(want[k], abs=1e-9) for k in want)


@pytest.fixture(scope="module")
def table():
    """Items of 3 to 700 words, and documents that hold them whole, in part, or not."""
    draw = random.Random(9)
    words = [f"t{i}" for i in range(400)]

    def text(n):
        body = draw.choices(words, [1 / (i + 1) for i in range(400)], k=n)
        for _ in range(n // 12):
            body[draw.randrange(n)] += draw.choice([".", "?", ":"])
        return " ".join(body)

    items = [(i, text(draw.choice([3, 7, 8, 9, 20, 60, 700]))) for i in range(40)]
    items += [(None, text(15)), (None, text(30)), (3, text(25)), (90, ""), (91, None), (92, "?!")]
    items = [(i, t) for i, t in items]
    docs = []
    for d in range(80):
        item = draw.choice([t for _, t in items if t])
        held = item.split()
        keep = draw.choice([1.0, 0.9, 0.6, 0.4])
        part = held[: max(1, int(len(held) * keep))]
        docs.append((d, " ".join([text(draw.choice([1, 40, 900])), *part, text(30)])))
    return docs, items


def test_search_equals_plain_bm25_with_overlap(spark, documents, table):
    docs, items = table
    want = _plain(docs, [(i, t or "") for i, t in items])
    assert len(want) > 30 and None in {i for _, i in want}
    for most_postings in (2_000_000, 300):
        _same(_found(spark, documents, docs, items, most_postings=most_postings), want)


def test_query_equals_plain_bm25(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs, items = (
        [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{t}.parquet").select(c, "text").collect()]
        for t, c in (("documents", "doc_id"), ("benchmark", "item_id"))
    )
    rows = decontaminate_query(spark, sf_dir).collect()
    want = _plain(docs, items)
    assert len(want) >= 3
    _same({(r.doc_id, r.item_id): (r.score, r.question_overlap, r.answer_overlap) for r in rows}, want)


def test_other_items_change_nothing(spark, documents):
    """Question and answer 400 words apart are not one passage, however long another item is."""
    draw = random.Random(2)
    items = [(i, f"What is the name of place{i} by river{i}? It is town{i} on hill{i} of old.") for i in range(20)]
    far = " ".join(f"w{draw.randrange(50)}" for _ in range(400))
    docs = [(i, t.replace("? ", f"? {far} ")) for i, t in items] + [(100 + i, f"{far} {t} {far}") for i, t in items]
    alone = _found(spark, documents, docs, items)
    assert alone.keys() == {(100 + i, i) for i in range(20)}
    long_item = (99, " ".join(f"z{draw.randrange(900)}" for _ in range(2_500)))
    assert _found(spark, documents, docs, [*items, long_item]).keys() == alone.keys()
    for most_postings in (60, 150):
        _same(_found(spark, documents, docs, items, most_postings=most_postings), alone)


def test_all_texts_of_one_item_id_are_searched(spark, documents):
    texts = [f"Name the {w} behind seven green hills and nine lakes." for w in ("river", "castle", "garden")]
    other = [(9, "Count the ships of the northern harbour at dawn.")]
    docs = [(i, f"x y {t} z") for i, t in enumerate(texts)]
    for item_id in (7, None):
        found = _found(spark, documents, docs, [*((item_id, t) for t in texts), *other])
        assert found.keys() == {(0, item_id), (1, item_id), (2, item_id)}
        assert all(v == (1.0, 1.0, 1.0) for v in found.values())

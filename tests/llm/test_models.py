"""Quality, toxicity, decontamination, pieces and the pipeline."""

import random

import numpy as np
import pytest
import sentencepiece

import corpus_pipeline
from ledgerlark.llm import decontaminate, pieces
from ledgerlark.llm.labelled import held_out
from ledgerlark.llm.quality import features, fit_quality, ftrl, quality_query, quality_scores
from ledgerlark.llm.toxicity import fit, fit_toxicity, toxicity_query, toxicity_scores, windows

SF_DIR = "/root/testdata/sf0.1"


@pytest.mark.parametrize("query, label, accuracy", [(quality_query, "quality", 0.97), (toxicity_query, "toxic", 0.85)])
def test_held_out_accuracy(spark, query, label, accuracy):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = query(spark, SF_DIR).join(labels, "doc_id").filter("held_out").select("predicted", label).collect()
    assert len(rows) > 500 and np.mean([r[0] == r[1] for r in rows]) >= accuracy


def test_odd_rows_are_scored(spark, documents, odd_rows):
    docs = documents(odd_rows)
    labels = spark.createDataFrame([(4, 1, 1), (5, 0, 0), (6, 1, 0), (None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    for rows in (
        quality_scores(docs, *fit_quality(docs, labels)), toxicity_scores(docs, fit_toxicity(docs, labels)),
        quality_scores(docs, *fit_quality(docs, labels.limit(0))), toxicity_scores(docs, fit_toxicity(docs, labels.limit(0))),
    ):
        scores = [r.score for r in rows.collect()]
        assert len(scores) == len(odd_rows) and all(0 <= s <= 1 for s in scores)
    assert quality_scores(docs.limit(0), np.zeros(4), 0.0).collect() == []
    assert toxicity_scores(docs.limit(0), fit([], [])).collect() == []


def test_held_out_rows_follow_the_checksum(spark):
    import zlib

    rows = spark.range(200).select("id", held_out("id").alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def test_features_are_those_of_each_text_alone():
    texts = ["One two!! three", "", "x" * 500 + " 12", "Ünï中 ok"]
    at, number, tokens = features(texts)
    for i, text in enumerate(texts):
        alone, _, n = features([text])
        assert sorted(at[number == i].tolist()) == sorted(alone.tolist()) and tokens[i] == n[0]


def test_ftrl_learns_a_line():
    draw = np.random.default_rng(0)
    rows = [(np.array([i % 2, 2]), np.array([1.0, 1.0]), i % 2) for i in draw.integers(0, 100, 400)]
    w = ftrl(rows, np.zeros(3), 3)
    assert w[1] + w[2] > 1 and w[0] + w[2] < -1


def test_windows_hold_all_words():
    text = "Ab " * 100 + "c" * 1000
    assert b" ".join(windows(text)).replace(b" ", b"") == text.lower().replace(" ", "").encode()


ITEMS = [
    (1, "What is the colour of the very old zebra in winter? It is pale grey with stripes."),
    (2, "Name the river behind seven green hills."), (3, ""), (4, None), (None, "Whose question is this odd one here?"),
    (2, "Name the river behind seven green hills."),
]


@pytest.mark.parametrize("most_postings", [2_000_000, 7])
def test_items_in_documents(spark, documents, most_postings):
    draw = random.Random(1)
    noise = lambda n: " ".join(draw.choice(["the", "of", "is", "river", "old", "in", "it"]) for _ in range(n))
    rows = [
        (1, noise(150) + " " + ITEMS[0][1] + " " + noise(90)), (2, noise(400)), (3, ITEMS[1][1].upper()),
        (4, noise(5) + ITEMS[0][1].split("?")[0]), (5, None), (6, ""), (None, "x " + ITEMS[4][1] + " " + ITEMS[1][1]),
    ]
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS term")
    found = decontaminate.contaminated(documents(rows), items, most_postings=most_postings).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 1), (3, 2), (None, 2), (None, None)}
    assert all(0.99 < r.score <= 1 for r in found)


def test_items_and_odd_documents(spark, documents, odd_rows):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.contaminated(documents(odd_rows), items).collect() == []
    assert decontaminate.contaminated(documents([]), items).collect() == []
    assert decontaminate.contaminated(documents(odd_rows), items.limit(0)).collect() == []


def test_pruned_search_equals_plain_bm25():
    """Every passage against every item, without any bound."""
    draw = random.Random(7)
    texts = [" ".join(f"t{int(draw.paretovariate(0.6)) % 300}" for _ in range(draw.randrange(5, 60))) for _ in range(80)]
    docs = [" ".join(f"t{int(draw.paretovariate(0.6)) % 300}" for _ in range(200)) + " " + draw.choice(texts) for _ in range(30)]
    term, item, impact = [], [], []
    for i, t in enumerate(texts):
        words, _ = decontaminate.hashed_words([t])
        own = np.unique(words)
        weight = np.random.default_rng(i).random(len(own))
        term += own.tolist()
        item += [i] * len(own)
        impact += (weight / weight.sum()).tolist()
    longest = max(len(t.split()) for t in texts)
    shard = decontaminate.build_shard(np.array(term, np.uint64), np.array(item), np.array(impact), list(range(80)), texts, longest)
    got = {(t, i): s for t, i, s, _, _ in decontaminate.matches(docs, shard, 0.6, -1.0)}
    weights = {}
    for t, i, w in zip(term, item, impact, strict=True):
        weights.setdefault(t, []).append((i, w))
    want = {}
    for d, text in enumerate(docs):
        words, _ = decontaminate.hashed_words([text])
        for a in range(0, max(len(words) - longest, 1), longest):
            score = {}
            for t in set(words[a : a + 2 * longest].tolist()):
                for i, w in weights.get(t, []):
                    score[i] = score.get(i, 0) + w
            for i, s in score.items():
                if s >= 0.6 - 1e-9:
                    want[d, i] = max(want.get((d, i), 0), min(s, 1.0))
    assert got.keys() == want.keys() and len(want) >= 30
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(*pieces.read_vocabulary())


def test_ids_are_those_of_byte_pair_merging(encoder):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.VOCABULARY)
    draw = random.Random(11)
    letters = "abcdefghetheinanion   \n\t.,漢字ñé😀0123456789<s>"
    texts = ["", " ", "  two", "end  ", "a" * 5_000, " " * 100, "▁x"] + [
        "".join(draw.choice(letters) for _ in range(draw.randrange(400))) for _ in range(300)
    ]
    texts += ["".join(draw.choice("abcdehinorstu") for _ in range(20_000))]
    decoder = pieces.Decoder(pieces.read_vocabulary()[0], pieces.read_vocabulary()[2])
    for text in texts:
        ids = encoder.encode(text)
        assert ids.tolist() == library.encode(text)
        assert decoder.decode(ids) == text.replace("▁", " ")


def test_memory_of_the_stream_is_bounded():
    stream = pieces.StreamingEncoder(*pieces.read_vocabulary())
    draw, widest, fed = random.Random(1), 0, ""
    for _ in range(400):
        part = "".join(draw.choice("etaoinshrdlu") for _ in range(50))
        fed += part
        stream.feed(part)
        widest = max(widest, stream.window)
    assert widest < 300
    ids = stream.finish()
    assert "".join(stream.pieces[i] for i in ids) == fed


def test_encoding_of_odd_rows(spark, documents, odd_rows):
    rows = pieces.encoded(documents(odd_rows)).collect()
    assert len(rows) == len(odd_rows) and all(r.round_trip and r.n_ids == len(r.ids) for r in rows)
    back = pieces.decoded(pieces.encoded(documents(odd_rows))).collect()
    assert sorted(r.text for r in back) == sorted(t or "" for _, t in odd_rows)
    assert pieces.encoded(documents([])).collect() == []


def test_stages_keep_columns_and_take_effect(spark, documents, odd_rows, tmp_path):
    sf_dir = str(tmp_path)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    items.write.parquet(f"{sf_dir}/benchmark.parquet")
    spark.createDataFrame([(4, 1, 0), (5, 1, 0), (8, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf_dir}/labels.parquet")
    rows = [*odd_rows, (20, "x " + ITEMS[0][1]), (21, "same words in both of these rows, all of them!")]
    for table in (documents(rows), documents([])):
        docs = table
        for _, step in corpus_pipeline.STAGES[1:-1]:
            docs = step(spark, docs, sf_dir)
            assert docs.columns == table.columns
        kept = [r.doc_id for r in docs.collect()]
        if table.count():
            assert 20 not in kept and 21 not in kept and kept.count(5) == 1
            assert kept.count(10) == 2 and {1, 2, 3, 4, 6, 7, 8, 9, 11} <= set(kept)
        first = corpus_pipeline.STAGES[0][1](spark, table, sf_dir)
        assert first.columns == table.columns and first.count() <= table.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == len(kept)

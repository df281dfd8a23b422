"""Line dedup, sentence spans, byte strings and personal data on small tables."""

import hashlib
from collections import Counter

import pytest

from ledgerlark.llm import suffix_dedup
from ledgerlark.llm.line_dedup import drop_common_lines
from ledgerlark.llm.pii import sanitise
from ledgerlark.llm.sentence_spans import drop_repeated_passages
from ledgerlark.llm.suffix_dedup import (
    _runs, anchors, decoded_run, drop_repeated_strings, front_coded, merged_runs, shared_prefix,
)

OPERATORS = [drop_common_lines, drop_repeated_passages, drop_repeated_strings, sanitise]


@pytest.mark.parametrize("operator", OPERATORS)
def test_odd_rows(documents, odd_rows, operator):
    found = operator(documents(odd_rows)).collect()
    assert sorted(map(str, (r[0] for r in found))) == sorted(map(str, (r[0] for r in odd_rows)))


@pytest.mark.parametrize("operator", OPERATORS)
def test_empty_table(documents, operator):
    assert operator(documents([])).collect() == []


def test_lines_of_many_documents_go_everywhere(documents):
    rows = [(i, f" Shared Line \nown {i}\nshared line\n\n") for i in range(10)] + [(99, "SHARED LINE\t")]
    found = {r.doc_id: r for r in drop_common_lines(documents(rows)).collect()}
    assert found[3].kept_text == "own 3\n\n" and found[3].n_dropped == 2 and found[3].n_lines == 5
    assert [tuple(r) for r in found[3].keep_runs] == [(1, 1), (3, 2)]
    assert found[99].kept_text == "" and found[99].n_dropped == 1


def test_nine_documents_are_too_few_and_case_outside_ascii_counts(documents):
    rows = [(i, "shared") for i in range(9)] + [(20 + i, "Éa") for i in range(5)] + [(30 + i, "éa") for i in range(5)]
    assert all(r.n_dropped == 0 for r in drop_common_lines(documents(rows)).collect())
    firsts = drop_common_lines(documents(rows), min_docs=2, keep_first=True).collect()
    assert sorted(r.doc_id for r in firsts if r.n_dropped == 0) == [0, 20, 30]


def test_later_copies_of_passages_go(documents):
    passage = "The first sentence of a passage here. The second sentence of that same passage. "
    rows = [(2, "Before it stands this. " + passage + "After."), (1, passage + "End of it."), (3, passage.strip())]
    found = {r.doc_id: r for r in drop_repeated_passages(documents(rows)).collect()}
    assert found[1].n_removed == 0 and found[1].kept_text == rows[1][1]
    assert found[2].kept_text == "Before it stands this. After." and found[3].kept_text == ""


def _brute_force(texts, length):
    raw = [t.encode() if t else b"" for t in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(r), sum(gone), spans, kept))
    return out


@pytest.mark.parametrize("most_contexts", [20_000, 2])
def test_byte_strings_equal_brute_force(spark, most_contexts):
    import random

    draw = random.Random(5)
    word = lambda n: "".join(draw.choice("abcdé ") for _ in range(n))
    common = [word(n) for n in (30, 45, 60, 120)]
    texts = ["".join(draw.choice([word(7), word(25), *common]) for _ in range(draw.randrange(9))) for _ in range(60)]
    texts += ["ab" * 100, "a" * 300, None, "", texts[3], texts[3]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = drop_repeated_strings(docs, length=40, gram=16, most_contexts=most_contexts).orderBy("doc_id").collect()
    got = [(r.n_bytes, r.n_removed, len(r.removed), bytes(r.kept)) for r in found]
    assert got == _brute_force(texts, 40)


def test_contexts_are_dealt_evenly_over_ranges():
    import numpy as np
    import pyarrow as pa

    data = np.random.default_rng(3).integers(0, 256, 200_000, np.uint8)
    at, grams = anchors(data, np.full(len(data), len(data)), 200, 64)
    h = pa.array(grams.astype(np.int64))
    ones = pa.array(np.ones(len(at), np.int64))
    context = pa.array([data[a : a + 20].tobytes().ljust(20, b"\0") for a in at], pa.binary())
    batch = pa.RecordBatch.from_arrays([h, ones, ones, ones, context], ["h", "c1", "c2", "n", "context"])
    rows = [r for out in _runs(40)(iter([batch])) for r in out.to_pylist()]
    held = {r["range"]: len(r["counts"]) // 8 for r in rows}
    assert sum(held.values()) == len(at)
    assert max(held.values()) < 2 * len(at) / 40


def test_crowded_gram_sends_one_row_per_context_to_its_range(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)
    plain = suffix_dedup._runs

    def counted(ranges):
        def rows(batches):
            def passed():
                for batch in batches:
                    seen.add(batch.num_rows)
                    yield batch

            yield from plain(ranges)(passed())

        return rows

    monkeypatch.setattr(suffix_dedup, "_runs", counted)
    # Longer than a byte batch holds, so that each of the documents sends its own rows.
    texts = ["".join(f"{i:05d} " for i in range(50_000))] * 12
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = drop_repeated_strings(docs, most_contexts=5).collect()
    contexts = seen.value
    assert [(r.n_bytes, r.n_removed) for r in found] == [(300_000, 300_000)] * 12
    seen.value = 0
    assert len(drop_repeated_strings(docs).collect()) == 12
    # Unfolded, each document sends its own row for every context.
    assert contexts * 12 == seen.value


def test_runs_are_merged_in_order_with_their_prefixes():
    import random

    draw = random.Random(2)
    strings = [bytes(draw.choice(b"ab") for _ in range(12)) for _ in range(300)]
    runs = []
    for k in range(7):
        part = sorted(strings[k::7])
        shared, rests = front_coded(part)
        assert decoded_run(shared, rests, 12) == part
        runs.append((part, shared.tolist()))
    merged = [(runs[r][0][i], n) for r, i, n in merged_runs(runs)]
    assert [s for s, _ in merged] == sorted(strings)
    assert all(n == shared_prefix(a, b, 0) for (a, _), (b, n) in zip(merged, merged[1:], strict=False))


def test_personal_data(documents):
    text = "é a.b@c.de, 1.2.3.4 1.2.3.999 x 4539 5787 6362 1486, +49 (0)30-123456 +12 4539578763621487"
    found = sanitise(documents([(1, text)])).first()
    spans = {k: [(s.start, s.end) for s in found[k]] for k in ("email", "ip", "card", "phone")}
    assert spans["email"] == [(2, 10)] and spans["ip"] == [(12, 19)]
    assert [text[a:b] for a, b in spans["card"]] == ["4539 5787 6362 1486"]
    assert [text[a:b] for a, b in spans["phone"]] == ["+49 (0)30-123456"]
    assert found.clean_text == "é [EMAIL], [IP] 1.2.3.999 x [CARD], [PHONE] +12 4539578763621487"


def test_terms_that_give_an_entity_away(documents):
    rows = [(i, "the zorblat of me@home.org and more\nthe zorblat stays") for i in range(4)]
    rows += [(100 + i, f"the more and other of line {i}") for i in range(4_000)]
    found = {r.doc_id: r for r in sanitise(documents(rows), remove_at=0.95, generalise_at=0.75).collect()}
    assert {s.text for s in found[1].terms} == {"zorblat"} and len(found[1].terms) == 2
    assert "zorblat" not in found[1].clean_text and "[EMAIL]" in found[1].clean_text
    assert found[105].terms == [] and found[105].clean_text == rows[9][1]
    assert len(rows) == len(found)


def test_one_line_is_enough_and_weighs_little(documents):
    """A term seen once, with an entity seen once, is generalised; a common one stays."""
    rows = [(0, "Zorblat of me@home.org said so")]
    rows += [(1 + i, f"so they said of line{i}\nall of it and so on") for i in range(2_000)]
    found = {r.doc_id: r for r in sanitise(documents(rows)).collect()}
    assert [(s.kind, s.text) for s in found[0].terms] == [("generalised", "Zorblat")]
    assert found[0].clean_text == "[WORD] of [EMAIL] said so"
    assert all(found[i].terms == [] for i in range(1, 2_001))


def test_a_line_of_thousands_of_entities_and_terms(documents):
    mails = " ".join(f"u{i}@home{i}.org" for i in range(1_500))
    letters = "abcdefghij"
    words = " ".join("rare" + "".join(letters[int(d)] for d in str(i)) for i in range(1_500))
    rows = [(0, f"{mails} {words} the")] + [(1 + i, f"the line{i}\nthe") for i in range(3_000)]
    found = {r.doc_id: r for r in sanitise(documents(rows)).collect()}
    assert len(found[0].email) == 1_500 and len(found[0].terms) == 1_500
    assert found[0].clean_text.endswith("[WORD] the") and "rare" not in found[0].clean_text


def test_hash_of_kept_bytes(documents):
    row = drop_repeated_strings(documents([(1, "abc")])).first()
    assert hashlib.sha256(bytes(row.kept)).hexdigest() == hashlib.sha256(b"abc").hexdigest()

"""Sentence spans against a plain version, with runs of short sentences."""

import hashlib
import re

from ledgerlark.llm.sentence_spans import drop_repeated_passages, sentence_spans_query

SF_DIR = "/root/testdata/sf0.001"
SENTENCE = re.compile(r"(?s).+?(?:[.!?][ \t\n\f\r]+|\n[ \t\n\f\r]*|\Z)")


def _plain(rows, span=2, min_chars=60):
    """``{doc_id: (n_sentences, n_removed, kept_text)}`` of rows with different ids."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        raw = SENTENCE.findall(text or "")
        keys, gone = [s.strip(" \t\n\f\r") for s in raw], set()
        for i in range(max(len(keys) - span, 0) + 1 if keys else 0):
            end = min(i + span, len(keys))
            while end < len(keys) and sum(map(len, keys[i:end])) < min_chars:
                end += 1
            run = tuple(keys[i:end])
            gone |= set(range(i, end)) if run in seen else set()
            seen.add(run)
        out[doc_id] = len(raw), len(gone), "".join(s for i, s in enumerate(raw) if i not in gone)
    return out


def test_runs_of_short_sentences_go(documents):
    verse = [f"Line {w} sings.\n" for w in ("one", "two", "three", "four", "five", "six", "seven")]
    rows = [
        (1, "".join(verse)), (2, "".join(verse)), (3, "An own first line.\n" + "".join(verse)),
        (4, "Short one."), (5, "Short one."), (6, "Short one. And another."), (7, "Ha. " * 90),
        (8, " \n"), (9, "".join(verse[:5]) + "Another end."), (10, None), (11, "Yes. No."), (12, "Yes. No. Or not."),
    ]
    found = {r.doc_id: (r.n_sentences, r.n_removed, r.kept_text) for r in drop_repeated_passages(documents(rows)).collect()}
    assert found == _plain(rows)
    assert found[2] == (7, 7, "") and found[3][2] == "An own first line.\n" and found[5][2] == ""
    assert found[6][1] == 0 and found[12][1] == 0 and found[9][2].endswith("Another end.")


def test_query_equals_the_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    found = {r.doc_id: (r.n_sentences, r.n_removed, r.kept_sha256) for r in sentence_spans_query(spark, SF_DIR).collect()}
    assert found == {d: (n, k, hashlib.sha256(t.encode()).hexdigest()) for d, (n, k, t) in _plain(rows).items()}

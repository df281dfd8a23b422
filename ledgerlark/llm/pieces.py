"""Encode text to the ids of a SentencePiece BPE vocabulary, and back, in a stream.

BPE as a Viterbi search: every prefix of a text has exactly one encoding that byte-pair
merging would give, and it ends in one piece.  A piece may follow another when merging
the two alone gives those two back, and a sequence is the encoding of its text exactly
when all its neighbours may follow each other.  So a left-to-right pass keeps, for each
position, the last piece of its prefix: the surviving path.  Pieces are at most
``longest`` characters, so only that many positions can be continued.  Whenever the
paths of all of them go through one boundary, the ids before it are committed and
forgotten: memory does not grow with the text.

No piece has a blank mark behind another character, so all paths meet before every blank:
the text between two such places has an encoding of its own, which is kept for the next
time it comes.  Characters without a piece become byte pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from ledgerlark.llm.shared import table
from ledgerlark.llm.words import text_batches

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
KEPT_SEGMENTS = 700_000
_SEGMENT = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")


def read_vocabulary(path: str = VOCABULARY) -> tuple[list[str], list[float], int]:
    """Pieces in id order, their scores, and the id of the first byte piece.

    Control and unknown pieces come as empty strings: no text is encoded to them.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, scores, first_byte = [], [], -1
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            first_byte = i if first_byte < 0 else first_byte
            pieces.append("")
        elif model.is_control(i) or model.is_unknown(i):
            pieces.append("")
        else:
            pieces.append(model.id_to_piece(i))
        scores.append(model.get_score(i))
    return pieces, scores, first_byte


class StreamingEncoder:
    """Viterbi over one segment: feed characters, take committed ids.

    ``window`` is the number of positions held; it stays below twice ``check_every`` plus
    the longest piece as long as paths converge.
    """

    def __init__(self, pieces: Sequence[str], scores: Sequence[float], first_byte: int, check_every: int = 64):
        self.ids = {p: i for i, p in enumerate(pieces) if p}
        self.pieces, self.scores, self.first_byte = pieces, scores, first_byte
        self.longest = max(map(len, self.ids), default=1)
        self.characters = {p for p in self.ids if len(p) == 1}
        self.check_every = check_every
        # The longest piece with these last two characters; others are single characters.
        self.reach: dict[str, int] = {}
        for p in self.ids:
            if len(p) > 1:
                self.reach[p[-2:]] = max(len(p), self.reach.get(p[-2:], 1))
        self.follows: dict[tuple[int, int], bool] = {}
        self.reset()

    def reset(self) -> None:
        self.text, self.last, self.committed = "", [-1], []

    @property
    def window(self) -> int:
        return len(self.last)

    def merged(self, text: str) -> list[str]:
        """Byte-pair merging as it is defined: the best-scored pair, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best = None
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.scores[i] > best[0]):
                    best = (self.scores[i], k)
            if best is None:
                break
            k = best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def may_follow(self, before: int, piece: int) -> bool:
        known = self.follows.get((before, piece))
        if known is None:
            word = self.pieces[piece]
            if before < 0:
                known = self.merged(word) == [word]
            else:
                known = self.merged(self.pieces[before] + word) == [self.pieces[before], word]
            if len(self.follows) < 2_000_000:
                self.follows[before, piece] = known
        return known

    def _extend(self, held: str, last: list[int]) -> None:
        """The last piece of each further prefix of ``held``."""
        find, follows, reach = self.ids.get, self.follows.get, self.reach.get
        for end in range(len(last), len(held) + 1):
            start = end - reach(held[end - 2 : end], 1) if end > 1 else 0
            for at in range(start if start > 0 else 0, end):  # the longest piece first
                piece = find(held[at:end])
                if piece is not None:
                    before = last[at]
                    ok = follows((before, piece))
                    if ok or (ok is None and self.may_follow(before, piece)):
                        last.append(piece)
                        break
            else:
                raise ValueError("a character without a piece")

    def feed(self, text: str) -> None:
        """Go on with more characters of a segment; every one has a piece."""
        self.text += text
        self._extend(self.text, self.last)
        if len(self.text) > self.check_every:
            self._commit()

    def whole(self, text: str) -> list[int]:
        """Ids of a short segment, without a stream."""
        last, found, at = [-1], [], len(text)
        self._extend(text, last)
        while at > 0:
            piece = last[at]
            found.append(piece)
            at -= len(self.pieces[piece])
        found.reverse()
        return found

    def _commit(self) -> None:
        """Commit the ids before the last boundary that all paths share."""
        end = len(self.text)
        shared = None
        for at in range(max(end - self.longest + 1, 1), end + 1):
            path = set()
            while at > 0:
                path.add(at)
                at -= len(self.pieces[self.last[at]])
            shared = path if shared is None else shared & path
            if not shared:
                return
        boundary = max(shared)
        self.committed += self._path(boundary)
        self.text = self.text[boundary:]
        # Position 0 keeps the piece that ends there, for what follows it.
        self.last = self.last[boundary:]

    def _path(self, at: int) -> list[int]:
        found = []
        while at > 0:
            found.append(self.last[at])
            at -= len(self.pieces[self.last[at]])
        return found[::-1]

    def finish(self) -> list[int]:
        """All ids of the segment; the encoder is ready for the next one."""
        found = self.committed + self._path(len(self.text))
        self.reset()
        return found


class Encoder:
    """Whole texts to ids, segment by segment."""

    def __init__(self, pieces: Sequence[str], scores: Sequence[float], first_byte: int, kept: int = KEPT_SEGMENTS):
        self.stream = StreamingEncoder(pieces, scores, first_byte)
        self.blank = self.stream.ids[BLANK]
        self.blanks = max(n for n in range(1, self.stream.longest + 1) if BLANK * n in self.stream.ids)

        class Known(dict):
            def __missing__(known, segment):
                found = np.array(self.segment(segment), "<i4").tobytes()
                if len(known) < kept and len(segment) <= 64:
                    known[segment] = found
                return found

        self.known = Known()

    def segment(self, segment: str) -> list[int]:
        """A run of blanks and what follows up to the next blank."""
        body = segment.lstrip(BLANK)
        n_blanks = len(segment) - len(body)
        if not body:
            return self._blank_run(n_blanks)
        found = self._word((BLANK if n_blanks else "") + body)
        # The last blank belongs to the word; where no piece joins them it is one of the run.
        if n_blanks and found[0] == self.blank:
            return self._blank_run(n_blanks) + found[1:]
        return self._blank_run(n_blanks - 1) + found if n_blanks else found

    def _blank_run(self, n: int) -> list[int]:
        full, rest = divmod(max(n, 0), self.blanks)
        ids = self.stream.ids
        return [ids[BLANK * self.blanks]] * full + ([ids[BLANK * rest]] if rest else [])

    def _word(self, text: str) -> list[int]:
        stream, found, at = self.stream, [], 0
        if stream.characters.issuperset(text):
            return self._known_run(text)
        known = stream.characters
        for i, ch in enumerate(text):
            if ch not in known:
                found += self._known_run(text[at:i])
                found += [stream.first_byte + b for b in ch.encode("utf-8", "surrogatepass")]
                at = i + 1
        return found + self._known_run(text[at:])

    def _known_run(self, text: str) -> list[int]:
        if not text:
            return []
        step = self.stream.check_every
        if len(text) <= step:
            return self.stream.whole(text)
        for a in range(0, len(text), step):
            self.stream.feed(text[a : a + step])
        return self.stream.finish()

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        segments = _SEGMENT.findall(BLANK + text.replace(" ", BLANK))
        return np.frombuffer(b"".join(map(self.known.__getitem__, segments)), "<i4")


_ENCODERS: dict[int, Encoder] = {}


def _encoder(vocabulary: tuple[list[str], list[float], int], kept: int, stays: bool) -> Encoder:
    """A new encoder, or the one that this worker process keeps from task to task."""
    if not stays:
        return Encoder(*vocabulary, kept=kept)
    name = hash((tuple(vocabulary[0]), tuple(vocabulary[1]), vocabulary[2]))
    if name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name] = Encoder(*vocabulary, kept=kept)
    return _ENCODERS[name]


class Decoder:
    """Ids back to text."""

    def __init__(self, pieces: Sequence[str], first_byte: int):
        self.bytes = [p.encode("utf-8") for p in pieces]
        for b in range(256):
            self.bytes[first_byte + b] = bytes([b])

    def decode(self, ids: np.ndarray) -> str:
        joined = b"".join(map(self.bytes.__getitem__, ids.tolist()))
        return joined.decode("utf-8", "surrogatepass").replace(BLANK, " ")[1:]


def encoded(
    docs: DataFrame, vocabulary: str = VOCABULARY, kept_segments: int = KEPT_SEGMENTS, stays: bool = True
) -> DataFrame:
    """``(doc_id, ids, n_ids, round_trip)`` for every row of ``docs``.

    ``kept_segments`` bounds what an encoder remembers, about 200 bytes each.  With ``stays``
    worker processes keep it for later tasks; without, its memory is free after a task.
    Neither changes a result.

    ``round_trip`` tells whether decoding gives the text back, which fails only for a
    text that holds the blank mark U+2581 itself.  Null or empty text: no ids, true.  A
    null doc_id stays null, repeated rows each get a row, other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _encoder(sent.value, kept_segments, stays), Decoder(sent.value[0], sent.value[2])
        for batch in batches:
            for first, texts in text_batches(batch.column("text").to_pylist()):
                found = [encoder.encode(t) for t in texts]
                sizes = np.array([len(f) for f in found], np.int64)
                same = [decoder.decode(f) == t for f, t in zip(found, texts, strict=True)]
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(texts)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found))),
                        pa.array(sizes), pa.array(same, pa.bool_()),
                    ],
                    ["doc_id", "ids", "n_ids", "round_trip"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        encode, f"doc_id {kind}, ids array<int>, n_ids long, round_trip boolean"
    )


def decoded(rows: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``(doc_id, text)`` of rows with ``ids``; null or empty ids give an empty text."""
    sent = rows.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(sent.value[0], sent.value[2])
        for batch in batches:
            texts = [decoder.decode(np.array(i or [], np.int32)) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "ids").mapInArrow(decode, f"doc_id {kind}, text string")


def pieces_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, each decoded again for comparison."""
    return encoded(table(spark, sf_dir, "documents"))

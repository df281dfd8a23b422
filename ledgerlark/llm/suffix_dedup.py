"""Remove byte strings that occur more than once, by sorting suffixes.

A string of ``length`` bytes is found through an anchor: of the ``gram``-byte substrings in
it, the first one with the smallest hash.  Equal strings have their anchors at equal
places, so only suffixes that begin at anchors are sorted, about 2 of every
``length - gram`` positions, and none of them is lost.

1. Anchors whose gram occurs once in all documents are dropped.
2. Around each other anchor a task cuts the context that strings through it can touch:
   the suffix from the anchor and the bytes before it, read backwards.  Equal contexts of
   a task fold to one with a count.
3. Every task sorts its contexts and sends them as front-coded runs: each string as the
   length of the prefix it shares with the one before, and the rest.  Runs are dealt by
   ranges of the sort key, which begins with the gram's hash, mixed anew.
4. A range's runs are combined by a loser tree that carries the common prefix of each
   candidate with the last winner, so that known prefixes are never compared again.  The
   merge yields the prefix lengths of neighbours; contexts whose suffixes share enough
   bytes lie together.
5. For each place the anchor can have in a string, neighbours that also agree on the bytes
   before it hold the same string.  What is covered goes back to the documents.

The contexts of an anchor with more rows than a task should hold are folded in a shuffle
first.  If they are still too many they are not merged: the strings are counted one by one
in a shuffle that folds as well.  Nothing is sampled or capped.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerlark.llm.arrow_groups import sorted_groups
from ledgerlark.llm.shared import attach, stage, table, with_document_key
from ledgerlark.llm.words import mix

LENGTH, GRAM = 200, 64
CHUNK = 1 << 18
CONTEXTS_PER_RANGE = 10_000
MOST_CONTEXTS = 60_000
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))


@lru_cache(1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.cumprod(np.full(CHUNK, _BASE, np.uint64))
        down = np.cumprod(np.full(CHUNK, pow(_BASE, -1, 1 << 64), np.uint64))
    return up, down


def anchors(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and gram hashes of the anchors of all strings of ``length`` bytes in ``data``.

    ``ends`` tells for each byte where its document ends; at most ``CHUNK`` bytes.
    """
    n = len(data)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    up, down = _powers()
    m, width = n - gram + 1, length - gram + 1
    with np.errstate(over="ignore"):
        run = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[:n], out=run[1:])
        grams = mix((run[gram:] - run[:-gram]) * down[:m])
    # Smallest hash first, then the first position; the low bits hold the position.
    low = np.uint64(CHUNK - 1)
    key = (grams & ~low) | np.arange(m, dtype=np.uint64)
    blocks = np.full(-(-m // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[:m] = key
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - length + 1
    least = np.minimum(back[:count], ahead[width - 1 : width - 1 + count])
    inside = ends[:count] >= np.arange(count) + length
    at = (least[inside] & low).astype(np.int64)
    at = at[np.diff(at, prepend=-1) != 0]
    return at, grams[at]


def byte_batches(texts: list[str | None], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(bytes, end of the document, number of the text, offset in it)`` of at most ``CHUNK`` bytes.

    A longer document comes in parts that overlap by ``length - 1`` bytes.
    """
    parts, numbers, offsets, size = [], [], [], 0

    def joined():
        data = np.frombuffer(b"".join(parts), np.uint8)
        sizes = np.array([len(p) for p in parts])
        return data, np.repeat(np.cumsum(sizes), sizes), np.repeat(numbers, sizes), np.repeat(offsets, sizes)

    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        for a in range(0, max(len(raw) - length + 1, 1), CHUNK - length + 1):
            part = raw[a : a + CHUNK]
            if parts and size + len(part) > CHUNK:
                yield joined()
                parts, numbers, offsets, size = [], [], [], 0
            parts.append(part)
            numbers.append(i)
            offsets.append(a)
            size += len(part)
    if size:
        yield joined()


def _anchor_rows(length: int, gram: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            document = batch.column("d").to_numpy()
            for data, ends, number, offset in byte_batches(batch.column("text").to_pylist(), length):
                at, grams = anchors(data, ends, length, gram)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(grams.astype(np.int64)), pa.array(document[number[at]]),
                        pa.array(_places(at, number, offset)),
                    ],
                    ["h", "d", "at"],
                )

    return rows


def _places(at: np.ndarray, number: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Positions within the documents."""
    change = np.flatnonzero(np.diff(number, prepend=-1) | np.diff(offset, prepend=-1))
    begin = change[np.searchsorted(change, at, "right") - 1]
    return (at - begin + offset[at]).astype(np.int64)


def contexts(data: np.ndarray, at: np.ndarray, first: np.ndarray, ends: np.ndarray, length: int, gram: int) -> np.ndarray:
    """One row per anchor: the suffix, the bytes before backwards, and both lengths.

    Bytes beyond the document are zero; the lengths tell them from real ones.
    """
    left = length - gram
    right_size = np.minimum(ends[at] - at, length)
    left_size = np.minimum(at - first, left)
    ahead = at[:, None] + np.arange(length)
    behind = at[:, None] - 1 - np.arange(left)
    right = np.where(np.arange(length) < right_size[:, None], data[np.minimum(ahead, len(data) - 1)], 0)
    before = np.where(np.arange(left) < left_size[:, None], data[np.maximum(behind, 0)], 0)
    sizes = np.stack([right_size >> 8, right_size & 255, left_size >> 8, left_size & 255], axis=1)
    return np.concatenate([right, before, sizes], axis=1).astype(np.uint8)


def _context_rows(length: int, gram: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = [np.array(v or [], np.int64) for v in batch.column("repeated").to_pylist()]
            doc_id, t = batch.column("doc_id"), batch.column("_t")
            for data, ends, number, offset in byte_batches(batch.column("text").to_pylist(), length):
                at, grams = anchors(data, ends, length, gram)
                # A gram that is repeated anywhere is so for every document of the batch.
                known = np.unique(np.concatenate([wanted[i] for i in np.unique(number)]))
                pick = np.isin(grams.astype(np.int64), known)
                at, grams = at[pick], grams[pick].astype(np.int64)
                if not len(at):
                    continue
                place = _places(at, number, offset)
                change = np.flatnonzero(np.diff(number, prepend=-1) | np.diff(offset, prepend=-1))
                first = change[np.searchsorted(change, at, "right") - 1]
                found = []
                for a in range(0, len(at), 1024):
                    part = contexts(data, at[a : a + 1024], first[a : a + 1024], ends, length, gram)
                    found += [r.tobytes() for r in part]
                # Near a cut of a very long document a context is shorter than it could be;
                # the part before or after has the same anchor with the rest.
                names = [xxhash.xxh3_128_digest(c) for c in found]
                times: dict[bytes, int] = {}
                for c in names:
                    times[c] = times.get(c, 0) + 1
                shown: set[bytes] = set()
                text, n = [], []
                for c, whole in zip(names, found, strict=True):
                    text.append(None if c in shown else whole)
                    n.append(0 if c in shown else times[c])
                    shown.add(c)
                pair = np.frombuffer(b"".join(names), "<i8").reshape(-1, 2)
                rows_at = pa.array(number[at])
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_id.take(rows_at), t.take(rows_at), pa.array(place), pa.array(grams),
                        pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array(n, pa.int64()),
                        pa.array(text, pa.binary()),
                    ],
                    ["doc_id", "_t", "at", "h", "c1", "c2", "n", "context"],
                )

    return rows


def front_coded(strings: list[bytes]) -> tuple[np.ndarray, bytes]:
    """Shared prefix lengths with the string before, and all the rests joined."""
    size = len(strings[0])
    grid = np.frombuffer(b"".join(strings), np.uint8).reshape(-1, size)
    shared = np.zeros(len(strings), np.int64)
    same = grid[1:] == grid[:-1]
    shared[1:] = np.where(same.all(axis=1), size, same.argmin(axis=1))
    keep = np.arange(size) >= shared[:, None]
    return shared, grid[keep].tobytes()


def decoded_run(shared: np.ndarray, rests: bytes, size: int) -> list[bytes]:
    found, at, before = [], 0, b""
    for s in shared.tolist():
        before = before[:s] + rests[at : at + size - s]
        at += size - s
        found.append(before)
    return found


def _runs(ranges: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, bytes, int]] = []
        for batch in batches:
            # Anchors have the smallest hashes around them, so hashes are mixed once more:
            # else the first few ranges would hold nearly all contexts.
            high = mix(batch.column("h").to_numpy().astype(np.uint64)).astype(">u8").tobytes()
            text = batch.column("context").to_pylist()
            names = np.stack([batch.column("c1").to_numpy(), batch.column("c2").to_numpy()], axis=1).astype("<i8")
            held += [
                (high[8 * i : 8 * i + 8] + c, names[i].tobytes(), n)
                for i, (c, n) in enumerate(zip(text, batch.column("n").to_pylist(), strict=True))
            ]
            if len(held) > 60_000:
                yield from _sorted_run(held, ranges)
                held = []
        if held:
            yield from _sorted_run(held, ranges)

    return rows


def _sorted_run(held: list[tuple[bytes, bytes, int]], ranges: int) -> Iterator[pa.RecordBatch]:
    held.sort(key=lambda x: x[0])
    high = np.frombuffer(b"".join(x[0][:4] for x in held), ">u4").astype(np.uint64)
    number = ((high * np.uint64(ranges)) >> np.uint64(32)).astype(np.int32)
    cuts = [*np.flatnonzero(np.diff(number, prepend=-1)).tolist(), len(held)]
    columns: list[list] = [[], [], [], [], []]
    for a, b in zip(cuts, cuts[1:], strict=False):
        shared, rests = front_coded([x[0] for x in held[a:b]])
        for column, value in zip(columns, (
            int(number[a]), shared.astype("<u2").tobytes(), rests, b"".join(x[1] for x in held[a:b]),
            np.array([x[2] for x in held[a:b]], "<i8").tobytes(),
        ), strict=True):
            column.append(value)
    yield pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
        ["range", "shared", "rests", "names", "counts"],
    )


def shared_prefix(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix, known to be at least ``at``."""
    end, step = min(len(a), len(b)), 16
    while at < end and a[at : at + step] == b[at : at + step]:
        at += step
        step *= 2
    if at >= end:
        return end
    while step > 1:
        step //= 2
        if a[at : at + step] == b[at : at + step]:
            at += step
    return min(at, end)


def merged_runs(runs: list[tuple[list[bytes], list[int]]]) -> Iterator[tuple[int, int, int]]:
    """``(run, place in it, prefix shared with the string before)`` in sorted order.

    ``runs`` are sorted strings with the prefix each shares with its predecessor.  Every
    candidate carries the prefix it shares with the last winner: the longer one comes
    first, and only equals are compared, from there on.
    """
    width = 1 << max(len(runs) - 1, 0).bit_length()
    place = [0] * width
    head: list[bytes | None] = [runs[r][0][0] if r < len(runs) and runs[r][0] else None for r in range(width)]
    known = [0] * width

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's prefix becomes the one shared with the winner."""
        x, y = head[a], head[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        n = shared_prefix(x, y, known[a])
        if x[n:] <= y[n:]:
            known[b] = n
            return a, b
        known[a] = n
        return b, a

    losers = [0] * width
    winners = list(range(width))
    level = width
    while level > 1:
        following = []
        for i in range(0, level, 2):
            w, lost = play(winners[i], winners[i + 1])
            losers[(level + i) // 2] = lost
            following.append(w)
        winners, level = following, level // 2
    winner = winners[0]
    while head[winner] is not None:
        strings, shared = runs[winner]
        yield winner, place[winner], known[winner]
        place[winner] += 1
        if place[winner] < len(strings):
            head[winner], known[winner] = strings[place[winner]], shared[place[winner]]
        else:
            head[winner] = None
        node = (winner + width) // 2
        while node >= 1:
            winner, losers[node] = play(winner, losers[node])
            node //= 2


def covered(grid: np.ndarray, shared: np.ndarray, counts: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, low, high)``: bytes around the anchor of each context that repeated strings cover.

    ``grid`` holds sorted different contexts behind 8 bytes of gram hash, ``shared`` the
    prefix with the row before.
    """
    left = length - gram
    right_shared = shared - 8
    before = grid[:, 8 + length : 8 + length + left]
    sizes = grid[:, 8 + length + left :].astype(np.int64)
    right_size, left_size = sizes[:, 0] * 256 + sizes[:, 1], sizes[:, 2] * 256 + sizes[:, 3]
    marks = np.zeros((len(grid), left + 3), np.int8)
    seen = np.zeros(len(grid), np.uint64)
    with np.errstate(over="ignore"):
        for o in range(left + 1):
            valid = np.flatnonzero((left_size >= o) & (right_size >= length - o))
            group = np.cumsum(right_shared < length - o).astype(np.uint64)
            key = mix(group[valid] * np.uint64(0x9E3779B97F4A7C15) ^ seen[valid])
            order = np.argsort(key, kind="stable")
            same = key[order][1:] == key[order][:-1]
            twice = counts[valid] > 1
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            marks[valid[twice], o + 1] = 1
            if o < left:
                seen = mix(seen * np.uint64(31) + before[:, o].astype(np.uint64) + np.uint64(1))
    step = np.diff(marks, axis=1)
    row, begin = np.nonzero(step[:, :-1] == 1)
    _, after = np.nonzero(step == -1)
    return row, -(after - 1), length - begin


def _covered_in_ranges(length: int, gram: int):
    size = 8 + length + (length - gram) + 4

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, _, _ in sorted_groups(batches, ["range"]):
            runs, names, counts = [], [], []
            for r in group.select(["shared", "rests", "names", "counts"]).to_pylist():
                shared = np.frombuffer(r["shared"], "<u2")
                runs.append((decoded_run(shared, r["rests"], size), shared.tolist()))
                names.append(np.frombuffer(r["names"], "<i8").reshape(-1, 2))
                counts.append(np.frombuffer(r["counts"], "<i8").tolist())
            strings, shared, who, total = [], [], [], []
            for run, at, prefix in merged_runs(runs):
                if strings and prefix == size:
                    total[-1] += counts[run][at]
                else:
                    strings.append(runs[run][0][at])
                    shared.append(prefix)
                    who.append(names[run][at])
                    total.append(counts[run][at])
            grid = np.frombuffer(b"".join(strings), np.uint8).reshape(-1, size)
            row, low, high = covered(grid, np.array(shared), np.array(total), length, gram)
            if len(row):
                name = np.array(who)[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name[:, 0]), pa.array(name[:, 1]), pa.array(low.astype(np.int64)), pa.array(high.astype(np.int64))],
                    ["c1", "c2", "low", "high"],
                )

    return rows


def _single_strings(length: int, gram: int):
    """Every string through an anchor, hashed: for anchors with very many contexts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = length - gram
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for c1, c2, n, c in zip(*(batch.column(k).to_pylist() for k in ("c1", "c2", "n", "context")), strict=True):
                right_size, left_size = int.from_bytes(c[-4:-2], "big"), int.from_bytes(c[-2:], "big")
                whole = c[length : length + left_size][::-1] + c[:right_size]
                for o in range(left_size + 1):
                    if right_size >= length - o:
                        digest = xxhash.xxh3_128_digest(whole[left_size - o : left_size - o + length])
                        values = (c1, c2, n, o, int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True))
                        for column, value in zip(out, values, strict=True):
                            column.append(value)
                if len(out[0]) > 50_000:
                    yield _long_batch(out)
                    out = [[], [], [], [], [], []]
            if out[0]:
                yield _long_batch(out)

    return rows


def _long_batch(columns: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in columns], ["c1", "c2", "n", "o", "s1", "s2"]
    )


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most_contexts: int = MOST_CONTEXTS
) -> DataFrame:
    """``(doc_id, _t, spans)``: byte ranges (start, end) of keyed ``docs`` that repeated strings cover."""
    keyed = docs.select("doc_id", "_t", F.xxhash64("doc_id", "_t").alias("d"), "text")
    found = keyed.select("d", "text").mapInArrow(_anchor_rows(length, gram), "h long, d long, at long")
    repeated = stage(found.groupBy("h").count().filter("count > 1").select("h"))
    wanted = (
        found.select("h", "d").join(repeated, "h", "left_semi")
        .groupBy("d").agg(F.collect_set("h").alias("repeated"))
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    records = stage(
        keyed.join(wanted, "d").select("doc_id", "_t", "text", "repeated").mapInArrow(
            _context_rows(length, gram),
            f"doc_id {kind}, _t long, at long, h long, c1 long, c2 long, n long, context binary",
        )
    )
    known = records.filter("context IS NOT NULL").select("h", "c1", "c2", "n", "context")
    grams = (
        known.groupBy("h", "c1", "c2").agg(F.count(F.lit(1)).alias("rows"))
        .groupBy("h").agg(F.count(F.lit(1)).alias("contexts"), F.sum("rows").alias("rows"))
    )
    crowded = stage(
        grams.filter(F.col("rows") > most_contexts).select("h", (F.col("contexts") > most_contexts).alias("heavy"))
    )
    ranges = max(1, -(-known.count() // CONTEXTS_PER_RANGE))
    light, heavy = known.join(crowded, "h", "left_anti"), None
    if not crowded.isEmpty():
        # A row per context, however many tasks met it: what is not heavy fits a range then.
        folded = stage(
            known.join(crowded, "h").groupBy("h", "c1", "c2", "heavy")
            .agg(F.sum("n").alias("n"), F.first("context").alias("context"))
        )
        light = light.unionByName(folded.filter(~F.col("heavy")).drop("heavy"))
        heavy = folded.filter("heavy")
    spans = (
        light.mapInArrow(_runs(ranges), "range int, shared binary, rests binary, names binary, counts binary")
        .repartition(ranges, "range").sortWithinPartitions("range")
        .mapInArrow(_covered_in_ranges(length, gram), "c1 long, c2 long, low long, high long")
    )
    if heavy is not None and not heavy.isEmpty():
        single = stage(heavy.select("h", "c1", "c2", "n", "context").mapInArrow(
            _single_strings(length, gram), "c1 long, c2 long, n long, o long, s1 long, s2 long"
        ))
        # Counted by the place of the anchor, as one occurrence may hold several anchors.
        twice = stage(
            single.groupBy("s1", "s2", "o").agg(F.sum("n").alias("n")).filter("n > 1").select("s1", "s2", "o")
        )
        found_at = single.join(twice, ["s1", "s2", "o"], "left_semi").select("c1", "c2", "o").distinct()
        # Neighbouring places of one context are one range, as in a merged run.
        in_context = Window.partitionBy("c1", "c2").orderBy("o")
        island = F.col("o") - F.row_number().over(in_context)
        spans = spans.unionByName(
            found_at.withColumn("island", island).groupBy("c1", "c2", "island").agg(
                (-F.max("o")).alias("low"), (length - F.min("o")).alias("high")
            ).drop("island")
        )
    spans = stage(spans)
    places = records.select("doc_id", "_t", "at", "c1", "c2").join(spans, ["c1", "c2"])
    return places.select("doc_id", "_t", (F.col("at") + F.col("low")).alias("start"), (F.col("at") + F.col("high")).alias("end")) \
        .groupBy("doc_id", "_t").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def joined_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted ranges; those that touch or overlap become one."""
    found: list[list[int]] = []
    for a, b in sorted(spans):
        if found and a <= found[-1][1]:
            found[-1][1] = max(found[-1][1], b)
        else:
            found.append([a, b])
    return [(a, b) for a, b in found]


def _without_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total, removed, ranges, kept = [], [], [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            raw = text.encode("utf-8", "surrogatepass")
            gone = joined_spans([(s["start"], s["end"]) for s in spans or []])
            at, pieces = 0, []
            for a, b in gone:
                pieces.append(raw[at:a])
                at = b
            pieces.append(raw[at:])
            total.append(len(raw))
            removed.append(sum(b - a for a, b in gone))
            ranges.append([{"start": a, "end": b} for a, b in gone])
            kept.append(b"".join(pieces))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                pa.array(ranges, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                pa.array(kept, pa.binary()),
            ],
            ["doc_id", "n_bytes", "n_removed", "removed", "kept"],
        )


def drop_repeated_strings(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most_contexts: int = MOST_CONTEXTS
) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, removed, kept)`` for every row of ``docs``.

    Texts are UTF-8 bytes.  Every byte covered by a string of ``length`` bytes that also
    starts anywhere else, in the same document included, is removed; all occurrences go.
    ``removed`` holds the maximal removed ranges (start, end), ``kept`` the bytes that stay,
    which may begin or end inside a character.

    Null or empty text: no bytes, nothing removed.  Null doc_id: a document like any
    other.  Repeated rows are copies of each other, so all their strings repeat.  Other
    columns are ignored.  An empty table gives no rows.
    """
    keyed = with_document_key(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return attach(keyed, repeated_spans(keyed, length, gram, most_contexts)).select("doc_id", "text", "spans").mapInArrow(
        _without_spans,
        f"doc_id {kind}, n_bytes long, n_removed long, removed array<struct<start:long,end:long>>, kept binary",
    )


def suffix_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes in strings of 200 bytes that occur more than once are removed everywhere."""
    return drop_repeated_strings(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


SUFFIX_DEDUP_SQL = r"""
WITH raw AS MATERIALIZED (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), windows AS MATERIALIZED (
    SELECT doc_id, s, hash(substring(x, 2 * s + 1, 400)) AS w
    FROM (SELECT doc_id, x, unnest(range(greatest(length(x) // 2 - 199, 0))) AS s FROM raw)
), twice AS (
    SELECT w FROM windows GROUP BY w HAVING count(*) > 1
), starts AS (
    SELECT doc_id, s FROM windows WHERE w IN (SELECT w FROM twice)
), islands AS (
    SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s ROWS UNBOUNDED PRECEDING) AS island
    FROM (SELECT *, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 200 THEN 0 ELSE 1 END AS fresh
        FROM starts)
), spans AS (
    SELECT doc_id, min(s) AS a, max(s) + 200 AS b FROM islands GROUP BY doc_id, island
), edges AS (
    SELECT r.doc_id, r.x, p.a, p.b, coalesce(lag(p.b) OVER (PARTITION BY r.doc_id ORDER BY p.a), 0) AS before,
        lead(p.a) OVER (PARTITION BY r.doc_id ORDER BY p.a) AS after
    FROM raw r JOIN spans p ON p.doc_id = r.doc_id
), told AS (
    SELECT doc_id, sum(b - a) AS n, count(*) AS k, string_agg(substring(x, 2 * before + 1, 2 * (a - before))
        || CASE WHEN after IS NULL THEN substring(x, 2 * b + 1) ELSE '' END, '' ORDER BY a) AS kept
    FROM edges GROUP BY doc_id
)
SELECT r.doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
    CAST(coalesce(k, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM raw r LEFT JOIN told t ON t.doc_id = r.doc_id
"""

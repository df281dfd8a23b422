"""Hashes of words and of runs of words, computed in bulk with numpy inside tasks.

A word is a run of letters and digits (Unicode categories L and N) in lower case, each
character mapped alone.  A word's hash is a polynomial over its characters modulo 2**64,
mixed at the end; two different words share one with a chance of about 2**-64.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_LIMIT = 0x110000
_BLOCK = 1 << 16
BATCH_CHARS = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all input bits."""
    x = np.array(x, dtype=np.uint64)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


@lru_cache(1)
def character_codes() -> np.ndarray:
    """For each code point: 0 outside words, else a random number of its lower case."""
    low = np.arange(_WORD_LIMIT, dtype=np.uint64)
    word = np.zeros(_WORD_LIMIT, bool)
    for c in range(_WORD_LIMIT):
        ch = chr(c)
        if unicodedata.category(ch)[0] in "LN":
            word[c] = True
            small = ch.lower()
            if len(small) == 1:
                low[c] = ord(small)
    return np.where(word, mix(low + np.uint64(1)) | np.uint64(1), np.uint64(0))


@lru_cache(4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.cumprod(np.full(n, _BASE, np.uint64))
        down = np.cumprod(np.full(n, pow(_BASE, -1, 1 << 64), np.uint64))
    return up, down


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def hashed_words(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of the texts and the number of the text it is in."""
    points = code_points("\n".join(texts))
    ends_at = np.cumsum([len(t) + 1 for t in texts])
    hashes, starts = [], []
    codes = character_codes()
    at = 0
    while at < len(points):
        upto = min(at + _BLOCK, len(points))
        block = codes[points[at:upto]]
        while upto < len(points) and block[-1]:  # never cut a word
            more = codes[points[upto : upto + _BLOCK]]
            gap = np.flatnonzero(more == 0)
            more = more[: gap[0] + 1] if len(gap) else more
            block, upto = np.concatenate([block, more]), upto + len(more)
        inside = block != 0
        change = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        first, last = change[::2], change[1::2]
        up, down = _powers(max(_BLOCK, 1 << int(len(block) - 1).bit_length()))
        with np.errstate(over="ignore"):
            run = np.zeros(len(block) + 1, np.uint64)
            np.cumsum(block * up[: len(block)], out=run[1:])
            hashes.append(mix((run[last] - run[first]) * down[first]))
        starts.append(first + at)
        at = upto
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.searchsorted(ends_at, np.concatenate(starts), "right")


def word_runs(words: np.ndarray, text_no: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``length`` words within a text, and the text of each.

    A text with at least one word but fewer than ``length`` gives one run: all its words.
    """
    n = len(words)
    if not n:
        return words, text_no
    with np.errstate(over="ignore"):
        runs = np.zeros(max(n - length + 1, 0), np.uint64)
        for i in range(length):
            runs = mix(runs * np.uint64(31) + words[i : n - length + 1 + i]) if len(runs) else runs
        whole = text_no[: len(runs)] == text_no[length - 1 :][: len(runs)]
        runs, run_text = runs[whole], text_no[: len(runs)][whole]
        heads = np.flatnonzero(np.diff(text_no, prepend=-1))
        sizes = np.diff(heads, append=n)
        short = np.flatnonzero(sizes < length)
        if len(short):
            extra = []
            for head, size in zip(heads[short], sizes[short], strict=True):
                h = np.zeros(1, np.uint64)
                for w in words[head : head + size]:
                    h = mix(h * np.uint64(31) + w)
                extra.append(h[0] ^ np.uint64(size))
            runs = np.concatenate([runs, np.array(extra, np.uint64)])
            run_text = np.concatenate([run_text, text_no[heads[short]]])
            order = np.argsort(run_text, kind="stable")
            runs, run_text = runs[order], run_text[order]
    return runs, run_text


def text_batches(texts: Sequence[str | None], chars: int = BATCH_CHARS) -> Iterator[tuple[int, list[str]]]:
    """``(index of the first, texts)`` in batches of about ``chars`` characters; null is empty."""
    first, batch, size = 0, [], 0
    for i, text in enumerate(texts):
        text = text or ""
        if batch and size + len(text) > chars:
            yield first, batch
            first, batch, size = i, [], 0
        batch.append(text)
        size += len(text)
    if batch:
        yield first, batch

"""Words of many texts as 64-bit numbers, found and hashed by array operations without a Python object for each word.

A word is a maximal run of characters other than space and the five control characters from tab to carriage return;
letters A to Z are lowered. Its number is the sum, modulo 2^64, of one pseudo-random number for each place and byte, read
off prefix sums, then mixed with its length. Numbers have no algebra that some family of words could cancel, so two
different words share one with a chance of 2^-64 (3 in 100 for some pair among a billion different words).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
CHUNK = 1 << 18

#: Places of a word whose bytes' numbers are looked up; those of further places are worked out.
PLACES = 256

_BYTES = np.arange(256)
SEPARATOR = np.isin(_BYTES, [32, *range(9, 14)])
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one mix of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _drawn(place_and_byte: np.ndarray) -> np.ndarray:
    """The pseudo-random number of place << 8 | byte."""
    return mixed(mixed(place_and_byte.astype(np.uint64) + np.uint64(BASE)) ^ np.uint64(0xD6E8FEB86659FD93))


TABLE = _drawn(np.arange(PLACES << 8))


def word_numbers(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all words of all texts in order, and for each text where its words begin (one entry more)."""
    numbers, counts = [], np.zeros(len(texts) + 1, np.int64)
    for first, upto, raw, starts in _chunks(texts):
        bytes_ = np.frombuffer(raw, np.uint8)
        separator = SEPARATOR[bytes_]
        edges = np.flatnonzero(separator[1:] != separator[:-1]) + 1
        begin, end = edges[0::2], edges[1::2]
        started = np.zeros(len(raw), np.int32)
        started[begin] = begin
        key = (np.arange(len(raw), dtype=np.int32) - np.maximum.accumulate(started)).astype(np.int64) << 8 | LOWER[bytes_]
        value = TABLE[np.minimum(key, len(TABLE) - 1)]
        if len(far := np.flatnonzero(key >= len(TABLE))):
            value[far] = _drawn(key[far])
        sums = np.cumsum(value)
        numbers.append(mixed(sums[end - 1] - sums[begin - 1] + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        counts[first + 1 : upto + 1] = np.diff(np.searchsorted(begin, starts))
    return np.concatenate(numbers) if numbers else np.zeros(0, np.uint64), np.cumsum(counts)


def _chunks(texts: list[str]) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """Groups of texts as bytes that begin and end with a separator, and where each text (and the end) begins in them."""
    at = 0
    while at < len(texts):
        parts, size, upto = [], 1, at
        while upto < len(texts) and (size == 1 or size < CHUNK):
            parts.append(texts[upto].encode("utf-8", "surrogatepass"))
            size += len(parts[-1]) + 1
            upto += 1
        yield at, upto, b"\n" + b"\n".join(parts) + b"\n", np.cumsum([1, *(len(p) + 1 for p in parts)])
        at = upto


def shingles(numbers: np.ndarray, width: int) -> np.ndarray:
    """The distinct shingles of one text's words, sorted; with fewer words than `width`, all of them as one."""
    n = len(numbers)
    if n == 0:
        return np.zeros(0, np.uint64)
    width = min(width, n)
    total = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        total = mixed(total * np.uint64(BASE) + numbers[i : n - width + 1 + i])
    return np.unique(total)

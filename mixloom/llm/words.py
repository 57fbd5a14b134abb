"""Words and their hashes, for whole batches of texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Longest stretch of bytes that is hashed at once, cut between words.
STRETCH = 1 << 20


def word_bytes() -> np.ndarray:
    """Bytes of words: ASCII letters and digits, and all that is not ASCII."""
    inside = np.zeros(256, bool)
    for first, last in ((48, 57), (65, 90), (97, 122), (128, 255)):
        inside[first : last + 1] = True
    return inside


INSIDE = word_bytes()
TABLE = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """Hashes whose every bit depends on all bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n, 1), BASE)]), dtype=np.uint64)


def _stretches(data: bytes) -> Iterator[tuple[int, bytes]]:
    at = 0
    while at < len(data):
        to = min(len(data), at + STRETCH)
        while to < len(data) and INSIDE[data[to]]:
            to += 1
        yield at, data[at:to]
        at = to


def words_of(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of the words in lower-cased bytes."""
    found = [_words(at, part) for at, part in _stretches(data)]
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return tuple(np.concatenate(columns) for columns in zip(*found))


def _words(at: int, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    b = np.frombuffer(data, np.uint8)
    inside = INSIDE[b]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return starts, ends, np.empty(0, np.uint64)
    lengths = ends - starts
    first = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    place = np.arange(len(first))
    inside_at = place + first
    offset = inside_at - np.repeat(starts, lengths)
    with np.errstate(over="ignore"):
        values = TABLE[b[inside_at]] * powers(int(lengths.max()))[offset]
        hashes = np.add.reduceat(values, np.cumsum(lengths) - lengths)
        return starts + at, ends + at, mixed(hashes)


def shingle_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hashes of every n words in a row."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(count, np.uint64)
        for j, p in enumerate(powers(n)[:n]):
            total += hashes[j : j + count] * p
        return mixed(total)

"""Words and their hashes of many texts at once, as numpy arrays over the bytes of an Arrow string column."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers whose bits all depend on all bits of the input."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def odd_numbers(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        step = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    return mix(step) | np.uint64(1)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array, a blank after each text, and where each text starts (with an end)."""
    parts = [x.encode() if x else b"" for x in texts.to_pylist()]
    starts = np.zeros(len(parts) + 1, dtype=np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=starts[1:])
    return np.frombuffer(b" ".join([*parts, b""]), dtype=np.uint8), starts


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are not white space."""
    space = SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    return edge[0::2], edge[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 7) -> np.ndarray:
    """A 64-bit hash of each word's bytes: a sum of bytes times numbers that depend on the place, then mixed."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    lengths = ends - starts
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    at = place + np.repeat(starts, lengths)
    with np.errstate(over="ignore"):
        terms = (data[at].astype(np.uint64) + np.uint64(1)) * odd_numbers(int(lengths.max()), seed)[place]
        return mix(np.add.reduceat(terms, first) + lengths.astype(np.uint64))


def texts_of_words(doc_starts: np.ndarray, word_starts: np.ndarray) -> np.ndarray:
    """Which text each word is in."""
    return np.searchsorted(doc_starts, word_starts, side="right") - 1

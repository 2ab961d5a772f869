"""Hashed word shingles of many texts at once, with numpy over the texts' bytes.

Words are runs of characters other than blanks, with A-Z lower-cased. A word's hash is a
multilinear sum over its bytes and a shingle's one over its words, each finished by a
64-bit mixer, all from fixed seeds: the same on every worker.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(1, 257, dtype=np.uint64)
_LOWER[0x41:0x5B] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """The finishing steps of the public splitmix64 generator: every bit of ``x`` reaches every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def coefficients(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def word_hashes(texts: pa.Array, blank: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in a row, words up to each text's end) of a large_string array without nulls.

    ``blank`` tells of each byte whether it parts words.
    """
    hashes, ends = prefix_hashes(texts, (), blank)
    return hashes[0], ends


def prefix_hashes(texts: pa.Array, prefixes: tuple[int, ...], blank: np.ndarray = _BLANK) -> tuple[list[np.ndarray], np.ndarray]:
    """As ``word_hashes``, with the hashes of the words' first bytes besides, for each length of ``prefixes``."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    cuts = offsets - offsets[0]
    inside = ~blank[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    at = cuts[:-1][cuts[:-1] < len(raw)]
    begins[at] = inside[at]
    first = np.flatnonzero(begins)
    if not len(first):
        return [np.zeros(0, np.uint64)] * (1 + len(prefixes)), np.zeros(len(texts), np.int64)
    letters = _LOWER[raw[inside]]
    starts = np.cumsum(inside)[first] - 1
    lengths = np.diff(np.concatenate([starts, [len(letters)]]))
    place = np.arange(len(letters)) - np.repeat(starts, lengths)
    with np.errstate(over="ignore"):
        terms = letters * coefficients(int(lengths.max()), 11)[place]
        found = [mixed(np.add.reduceat(terms, starts) + lengths.astype(np.uint64))]
        for n in prefixes:
            short = np.minimum(lengths, n)
            sums = np.add.reduceat(terms[place < n], np.cumsum(short) - short)
            found.append(mixed(sums + short.astype(np.uint64) + np.uint64(n << 32)))
        return found, np.searchsorted(first, cuts[1:], side="left")


def shingle_sets(texts: pa.Array, width: int = 5) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles; of a shorter text one hash of all its words."""
    words, ends = word_hashes(texts)
    c = coefficients(width + 1, 23)
    with np.errstate(over="ignore"):
        n = max(0, len(words) - width + 1)
        sums = np.zeros(n, np.uint64)
        for k in range(width):
            sums += words[k : k + n] * c[k]
        sums = mixed(sums)
        out, begin = [], 0
        for end in ends.tolist():
            if end - begin >= width:
                x = np.sort(sums[begin : end - width + 1])
                out.append(x[np.concatenate([[True], x[1:] != x[:-1]])])
            elif end > begin:
                out.append(mixed(np.sum(words[begin:end] * c[: end - begin], keepdims=True, dtype=np.uint64) + c[width] * np.uint64(end - begin)))
            else:
                out.append(np.zeros(0, np.uint64))
            begin = end
    return out

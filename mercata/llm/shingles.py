"""Sets of word shingles as sorted 64-bit hashes, computed over whole Arrow buffers at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS = 4
BYTES_AT_ONCE = 2 << 20  # text hashed at a time; a longer text is hashed by itself
SEPARATORS = bytes([0x20, *range(0x09, 0x0E)])
GAP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(start: int, count: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed((np.arange(start, start + count, dtype=np.uint64) + np.uint64(1)) * GAP)


BYTE = stream(1 << 32, 256)
for upper in range(ord("A"), ord("Z") + 1):  # A-Z count as a-z, other letters as they are
    BYTE[upper] = BYTE[upper + 32]
IS_SEPARATOR = np.zeros(256, bool)
IS_SEPARATOR[list(SEPARATORS)] = True


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts laid out in ``data``, and how many words each text has."""
    letter = ~IS_SEPARATOR[data]
    start = letter.copy()
    start[1:] &= ~letter[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    start[heads] = letter[heads]
    at = np.flatnonzero(letter)
    first = np.flatnonzero(start)
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    begins = start[at]
    place = at - first[np.cumsum(begins) - 1]
    weight = stream(0, int(place.max()) + 1)
    with np.errstate(over="ignore"):
        sums = np.add.reduceat(BYTE[data[at]] * weight[place], np.flatnonzero(begins))
        lengths = np.diff(np.append(np.flatnonzero(begins), len(at))).astype(np.uint64)
        hashes = mixed(sums + lengths * GAP)
    bounds = np.searchsorted(first, offsets)
    return hashes, np.diff(bounds)


def shingle_hashes(words: np.ndarray, size: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; fewer words are one run."""
    if not len(words):
        return words
    with np.errstate(over="ignore"):
        if len(words) < size:
            run = np.array([len(words)], np.uint64)
            for w in words:
                run = mixed(run * GAP + w)
            return run
        runs = np.zeros(len(words) - size + 1, np.uint64)
        for i in range(size):
            runs = mixed(runs * GAP + words[i:len(words) - size + 1 + i]) if i == size - 1 else runs * GAP + words[i:len(words) - size + 1 + i]
    runs = np.sort(runs.view(np.int64))
    keep = np.ones(len(runs), bool)
    keep[1:] = runs[1:] != runs[:-1]
    return runs[keep]


def shingle_sets(texts: pa.Array, size: int = WORDS) -> Iterator[np.ndarray]:
    """The shingle set of every text, as sorted int64 hashes; a null text has none."""
    texts = texts.cast(pa.large_string())
    for a, b in chunks(texts):
        part = texts.slice(a, b - a)
        buffers = part.buffers()
        offsets = np.frombuffer(buffers[1], np.int64)[part.offset:part.offset + len(part) + 1]
        if buffers[2] is None or offsets[-1] == offsets[0]:
            yield from (np.zeros(0, np.int64) for _ in range(len(part)))
            continue
        data = np.frombuffer(buffers[2], np.uint8)[offsets[0]:offsets[-1]]
        words, counts = word_hashes(data, offsets - offsets[0])
        at = 0
        for count in counts:
            yield shingle_hashes(words[at:at + count], size).view(np.int64)
            at += count


def chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts together have about ``BYTES_AT_ONCE`` bytes."""
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    start = 0
    while start < len(texts):
        end = int(np.searchsorted(offsets, offsets[start] + BYTES_AT_ONCE, side="right")) - 1
        end = min(max(end, start + 1), len(texts))
        yield start, end
        start = end

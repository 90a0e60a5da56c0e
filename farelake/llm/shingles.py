"""Hashed word shingles of whole texts, a slice of an Arrow batch at a time.

Words are runs of bytes other than space and 0x09-0x0D, with A-Z in lower case. A shingle is five words in a row; a text with
fewer words is one shingle, and one without words has none. Words and shingles are 64-bit hashes: two different
shingles of a pair of texts agree with a chance near 2**-64, which no result here can tell from exact comparison.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORDS = 5
#: Bytes hashed at a time inside a very long text.
SEGMENT = 4 << 20

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IS_WORD = np.ones(256, bool)
_IS_WORD[[32, *range(9, 14)]] = False
_BYTE = np.random.default_rng(20240607).integers(0, 1 << 63, 256, dtype=np.uint64)[_FOLD] * np.uint64(2) + np.uint64(1)
_STEP = 0x9E3779B97F4A7C15 | 1
_PLACES = np.random.default_rng(11).integers(0, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_COUNT = np.uint64(0xD6E8FEB86659FD93)
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 64)
        _powers = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, _STEP, np.uint64))), dtype=np.uint64)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all 64; changes ``x`` in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _segments(raw: np.ndarray):
    """Bounds of stretches of about SEGMENT bytes that end between words."""
    start = 0
    while start < len(raw):
        stop = min(len(raw), start + SEGMENT)
        while stop < len(raw) and _IS_WORD[raw[stop]]:
            gap = np.flatnonzero(~_IS_WORD[raw[stop:stop + SEGMENT]])
            stop = stop + int(gap[0]) if len(gap) else min(len(raw), stop + SEGMENT)
        yield start, stop
        start = stop


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts`` end to end, and each text's number of words."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    bounds = offsets - offsets[0]
    hashes, starts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for low, high in _segments(raw):
        part = raw[low:high]
        word = _IS_WORD[part]
        fresh = word.copy()
        fresh[1:] &= ~word[:-1]
        heads = bounds[np.searchsorted(bounds, low):np.searchsorted(bounds, high)] - low
        fresh[heads] = word[heads]
        at = np.flatnonzero(word)
        if not len(at):
            continue
        first = np.flatnonzero(fresh[at])
        sizes = np.diff(np.append(first, len(at)))
        place = np.arange(len(at)) - np.repeat(first, sizes)
        sums = np.add.reduceat(_BYTE[part[at]] * powers(int(sizes.max()))[place], first)
        hashes.append(mix(sums + sizes.astype(np.uint64) * _COUNT))
        starts.append(at[first] + low)
    counts = np.diff(np.searchsorted(np.concatenate(starts), bounds))
    return np.concatenate(hashes), counts


def shingle_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of ``texts`` end to end, in order and with repeats, and each text's number of them."""
    words, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    long = counts >= WORDS
    total = max(0, len(words) - WORDS + 1)
    full = np.zeros(total, np.uint64)
    for place, factor in enumerate(_PLACES):
        full += words[place:place + total] * factor
    sizes = np.where(long, counts - WORDS + 1, (counts > 0).astype(np.int64))
    out_ends = np.cumsum(sizes)
    out = np.empty(int(out_ends[-1]) if len(sizes) else 0, np.uint64)
    kept = np.zeros(total, bool)
    if total:
        edges = np.zeros(total + 1, np.int64)
        np.add.at(edges, (ends - counts)[long], 1)
        np.add.at(edges, (ends - WORDS + 1)[long], -1)
        kept = np.cumsum(edges[:-1]) > 0
    target = np.ones(len(out), bool)
    short = np.flatnonzero((counts > 0) & ~long)
    target[(out_ends - sizes)[short]] = False
    out[target] = mix(full[kept])
    for i in short:
        piece = words[ends[i] - counts[i]:ends[i]]
        parts = np.append(piece * _PLACES[:len(piece)], np.array([len(piece)], np.uint64) * _COUNT)
        out[out_ends[i] - 1] = mix(parts.sum(keepdims=True, dtype=np.uint64))[0]
    return out, sizes


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Each text's distinct shingles in rising order."""
    flat, sizes = shingle_hashes(texts)
    ends = np.cumsum(sizes)
    out = []
    for end, size in zip(ends.tolist(), sizes.tolist()):
        one = np.sort(flat[end - size:end])
        out.append(one[np.concatenate(([True], one[1:] != one[:-1]))] if size else one)
    return out

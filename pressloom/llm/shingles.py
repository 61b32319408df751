"""Sets of word shingles as sorted hashes, computed column-wise on whole batches of texts.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a shingle is five words in a
row; a text of fewer words is one shingle. Hashes have 48 bits, so that a set packs
into about five bytes a shingle; two different shingles of a pair of texts are taken
for one with a chance of about (size of one * size of the other) / 2**48.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SHINGLE = 5
BITS = 48
_R = np.uint64(0x9E3779B97F4A7C15)
LONG_WORD = 512  # bytes of a word that are hashed with those of all other words
_POWERS = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(LONG_WORD, _R, np.uint64)]))
_STEPS = np.random.default_rng(5).integers(1, 1 << 63, SHINGLE + 1, dtype=np.uint64) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit integers (two rounds of xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles; empty without words."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0]:bounds[-1]]
    bounds = bounds - bounds[0]
    raw = np.where((raw >= 65) & (raw <= 90), raw | 32, raw)
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    first = np.zeros(len(raw) + 1, bool)
    first[bounds] = True  # a text's first byte begins a word even after a word of the text before
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | first[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | first[1:])) + 1
    # words in order of length, so that those with a k-th byte come first
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    sorted_starts, sorted_lengths = starts[order], lengths[order]
    h = np.zeros(len(order), np.uint64)
    for k in range(min(int(sorted_lengths[0]), LONG_WORD) if len(order) else 0):
        n = int(np.searchsorted(-sorted_lengths, -k, side="left"))
        h[:n] = h[:n] * _R + raw[sorted_starts[:n] + k] + np.uint64(1)
    for i in range(int(np.searchsorted(-sorted_lengths, -LONG_WORD, side="left"))):  # the rest of long words, a block at a time
        for a in range(int(sorted_starts[i]) + LONG_WORD, int(sorted_starts[i] + sorted_lengths[i]), LONG_WORD):
            block = raw[a:min(a + LONG_WORD, int(sorted_starts[i] + sorted_lengths[i]))].astype(np.uint64) + np.uint64(1)
            h[i:i + 1] = h[i:i + 1] * _POWERS[len(block)] + (block * _POWERS[len(block) - 1::-1]).sum(dtype=np.uint64, keepdims=True)
    words = np.empty(len(order), np.uint64)
    words[order] = mixed(h)
    rolled = np.zeros(max(len(words) - SHINGLE + 1, 0), np.uint64)
    for i in range(SHINGLE):
        rolled += words[i:i + len(rolled)] * _STEPS[i]
    rolled = mixed(rolled) >> np.uint64(64 - BITS)
    sets = []
    at = np.searchsorted(starts, bounds)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= SHINGLE:
            sets.append(np.unique(rolled[a:b - SHINGLE + 1]))
        elif b > a:
            whole = np.append(words[a:b], np.uint64(b - a)) * np.append(_STEPS[:b - a], _STEPS[SHINGLE])
            sets.append(mixed(whole.sum(dtype=np.uint64, keepdims=True)) >> np.uint64(64 - BITS))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def set_key(members: np.ndarray) -> int:
    """64-bit key of a set: equal for equal sets."""
    total = np.append(mixed(members), np.array([len(members)], np.uint64) * _R).sum(dtype=np.uint64, keepdims=True)
    return int(mixed(total).view(np.int64)[0])


def pack(members: np.ndarray) -> bytes:
    """Sorted members as differences, stored byte plane by byte plane (the high planes compress to nothing)."""
    return np.diff(members, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :BITS // 8].T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(BITS // 8, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :BITS // 8] = planes.T
    return np.cumsum(out.view("<u8").ravel(), dtype=np.uint64)


def sketch(members: np.ndarray) -> bytes:
    """How many members have each value of their lowest bits, a byte each: between a quarter and half as many values as members."""
    m = 1 << max(0, (len(members) // 2).bit_length() - 1)
    while True:
        counts = np.bincount((members & np.uint64(m - 1)).astype(np.int64), minlength=m)
        if counts.max() < 256:
            return counts.astype(np.uint8).tobytes()
        m *= 2


def _folded(data: bytes, m: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(-1, m).sum(0, dtype=np.int64)


def overlap_bounds(a: bytes, b: bytes) -> tuple[int, float]:
    """From two sketches: what the overlap of their sets can be at most, and an estimate of it.

    Common members have the same lowest bits. Of the bound, what independent sets with these
    counts would have is taken off for the estimate.
    """
    m = min(len(a), len(b))
    x, y = _folded(a, m), _folded(b, m)
    most, least = int(np.minimum(x, y).sum()), int(min(x.sum(), y.sum()))
    top = int(min(x.max(), y.max()))
    chance = sum(int((x >= k).sum()) * int((y >= k).sum()) for k in range(1, top + 1)) / m
    return most, max(0.0, (most - chance) * least / (least - chance)) if chance < least else float(most)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())

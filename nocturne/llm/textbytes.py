"""Vectorised byte-level views of Arrow string batches: words, shingles and n-grams as 64-bit hashes.

Everything works on whole texts. Long buffers are walked in pieces cut at white space, so working
memory is bounded by the piece and by eight bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 18
U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_CODES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, a bijection on 64-bit words."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _tables(n: int) -> list[np.ndarray]:
    """Powers of an odd base modulo 2^64 and of its inverse, for n positions at least."""
    if not _powers or len(_powers[0]) < n:
        n = max(n, PIECE + 4096)
        inverse = pow(_BASE, -1, 2**64)
        _powers[:] = [np.cumprod(np.concatenate([[U(1)], np.full(n, U(b), np.uint64)])) for b in (_BASE, inverse)]
    return _powers


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; nulls count as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, raw, data = texts.buffers()
    offsets = np.frombuffer(raw, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if raw is not None and len(texts) else np.zeros(len(texts) + 1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer text is a range of its own."""
    _, offsets = buffers(texts)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of each maximal run of bytes other than 20 and 09-0D, with A-Z lower-cased."""
    hashes, starts, at = [], [], 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        if end < len(data):
            cut = np.flatnonzero(SPACE[data[at:end]])
            if len(cut):
                end = at + int(cut[-1]) + 1
            else:
                beyond = np.flatnonzero(SPACE[data[end:]])
                end = end + int(beyond[0]) + 1 if len(beyond) else len(data)
        piece = data[at:end]
        power, inverse = _tables(len(piece) + 1)
        blank = np.concatenate([[True], SPACE[piece], [True]])
        edge = np.flatnonzero(blank[1:] != blank[:-1])
        s, e = edge[::2], edge[1::2]
        total = np.concatenate([[U(0)], np.cumsum(_CODES[FOLD[piece]] * power[: len(piece)])])
        hashes.append(mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64) * U(0xD6E8FEB86659FD93)))
        starts.append(s + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its k-word shingles.

    A text of fewer words gives its whole sequence as one; one without words gives an empty set.
    A zero byte is put between texts so that no word spans two of them.
    """
    data, offsets = buffers(texts)
    n = len(texts)
    joined = np.full(len(data) + n, 0x20, np.uint8)
    joined[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offsets))] = data
    words, starts = word_hashes(joined)
    bounds = np.searchsorted(starts, offsets + np.arange(n + 1))
    rolled = np.zeros(max(0, len(words) - k + 1), np.uint64)
    for j in range(k):
        rolled += words[j : len(words) - k + 1 + j] * U(pow(0xC2B2AE3D27D4EB4F, j + 1, 2**64))
    rolled = mix(rolled)
    for i in range(n):
        lo, hi = int(bounds[i]), int(bounds[i + 1])
        if hi - lo >= k:
            yield np.unique(rolled[lo : hi - k + 1])
        elif hi > lo:
            part = words[lo:hi]
            weight = np.array([pow(0x9FB21C651E98DF25, j + 1, 2**64) for j in range(hi - lo)], np.uint64)
            yield mix(np.array([(part * weight).sum(dtype=np.uint64) + U(hi - lo)], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def ngram_codes(data: np.ndarray, orders: tuple[int, ...], bits: int) -> np.ndarray:
    """Hashed codes below 2^bits of all byte n-grams of the given orders, repeats included."""
    out = []
    for n in orders:
        if len(data) >= n:
            h = np.zeros(len(data) - n + 1, np.uint64)
            for j in range(n):
                h = h * U(0x100000001B3) + (data[j : len(data) - n + 1 + j].astype(np.uint64) + U(1))
            out.append((mix(h + U(n * 0xA24BAED4963EE407 % 2**64)) >> U(64 - bits)).astype(np.int64))
    return np.concatenate(out) if out else np.zeros(0, np.int64)

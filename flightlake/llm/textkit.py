"""Vectorised text kernels over the UTF-8 buffers of Arrow string arrays.

A batch is one byte array with document offsets; words, hashes and n-grams
come from whole-array numpy passes, so a task pays no per-word Python cost.
Hashes are 64-bit polynomial hashes over a random byte table, mixed at the
end: equal strings hash equal everywhere, different ones collide with a chance
of about 2^-60 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: odd multiplier of the polynomial hash and its inverse modulo 2^64
_MULT = 0x9E3779B97F4A7C15 | 3
_MULT_INV = pow(_MULT, -1, 1 << 64)
#: texts of about so many bytes are handled at once (one longer text is handled alone)
BLOCK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """Final mixing of 64-bit hashes (all bits of the input reach all of the output)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(33)
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


_BYTE = mix64(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 64)
        for k, m in ((0, _MULT), (1, _MULT_INV)):
            p = np.full(size, U64(m), U64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """H with H[j] - H[i] = the shifted hash of bytes i..j-1."""
    h = np.empty(len(buf) + 1, U64)
    h[0] = 0
    up, _ = _power_tables(len(buf) + 1)
    np.cumsum(_BYTE[buf] * up[:len(buf)], out=h[1:])
    return h


def span_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte span; equal content hashes equal wherever it stands."""
    _, down = _power_tables(len(h))
    return mix64((h[end] - h[start]) * down[start])


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


def text_blocks(texts: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows with about block_bytes of text; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not (pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)):
        texts = texts.cast(pa.large_binary() if pa.types.is_binary(texts.type) else pa.large_string())
    n = len(texts)
    if n == 0:
        return
    off = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
    data = texts.buffers()[2]
    all_bytes = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if texts.null_count:
        lens = np.where(np.asarray(texts.is_valid()), np.diff(off), 0)
    else:
        lens = np.diff(off)
    i = 0
    ends = np.cumsum(lens)
    while i < n:
        base = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, base + block_bytes, "right")))
        out_off = np.concatenate(([0], np.cumsum(lens[i:j])))
        if (lens[i:j] == np.diff(off[i:j + 1])).all():
            buf = all_bytes[off[i]:off[j]]
        else:
            buf = np.concatenate([all_bytes[off[k]:off[k] + lens[k]] for k in range(i, j)])
        yield i, buf, out_off
        i = j


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of every word `[^\\x20\\x09-\\x0D]+`; words end at document ends."""
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, z
    inner = ~_SPACE[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[off] = True
    before = np.empty(len(buf), bool)
    before[0] = False
    before[1:] = inner[:-1]
    start = np.flatnonzero(inner & (~before | edge[:-1]))
    after = np.empty(len(buf), bool)
    after[-1] = False
    after[:-1] = inner[1:]
    end = np.flatnonzero(inner & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


def ngram_hash(word_hash: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word's index) of every run of n words within one document."""
    m = len(word_hash) - n + 1
    if m <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    h = np.zeros(m, U64)
    for k in range(n):
        h += word_hash[k:k + m] * U64(pow(_MULT, 7 * k + 1, 1 << 64))
    at = np.flatnonzero(doc[:m] == doc[n - 1:n - 1 + m])
    return mix64(h[at]), at

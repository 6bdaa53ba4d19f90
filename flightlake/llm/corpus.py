"""Chunks of a corpus, and questions from chunks to buckets and back.

Operators that need to know something of a text's parts across the corpus (is this
string anywhere else, how often is this word) hash the parts, and each chunk of
documents asks the bucket that owns a hash once for all its documents. Questions and
answers are packed arrays, a row for each chunk and bucket, so what is shuffled is a
few bytes for each distinct part of a chunk; the chunk's texts, packed once, are
joined with the answers. A part that very many texts hold is asked for once a chunk.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm import textkit as T
from flightlake.llm.runtime import bounded_batches, stored

# Arrays of a block are large and short-lived: let the allocator give them back at once instead of
# keeping what one step needed while the next one runs (glibc; elsewhere its own rules hold).
with contextlib.suppress(OSError, AttributeError):
    ctypes.CDLL("libc.so.6").mallopt(-3, 1 << 18)          # -3: the size from which memory is mapped
pa.set_memory_pool(pa.system_memory_pool())

CHUNK = "chunk long, doc_ids array<long>, n_bytes long, offsets binary, texts binary"


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value; bytes of equal weight stand together, so high zero bytes cost nothing."""
    head = [len(arrays)]
    body = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        head += [len(a), a.dtype.itemsize, "uif".index(a.dtype.kind)]
        body.append(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() if len(a) else b"")
    raw = np.array(head, "<i8").tobytes() + b"".join(body)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(value: bytes) -> list[np.ndarray]:
    raw = pa.decompress(value[8:], int.from_bytes(value[:8], "little"), codec="zstd", asbytes=True)
    count = int(np.frombuffer(raw, "<i8", 1)[0])
    head = np.frombuffer(raw, "<i8", 3 * count, 8).reshape(count, 3)
    at, out = 8 + 24 * count, []
    for n, size, kind in head.tolist():
        flat = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n)
        out.append(np.ascontiguousarray(flat.T).view(f"<{'uif'[kind]}{size}").reshape(n) if n else np.zeros(0, f"<{'uif'[kind]}{size}"))
        at += n * size
    return out


@dataclass(frozen=True)
class Sizes:
    chunk_bytes: int
    buckets: int


def sizes(text_bytes: int, chunk_bytes: int = 2 << 20, bucket_bytes: int = 8 << 20) -> Sizes:
    """Chunks and buckets grow with the root of the corpus, so that a question between
    one of each stays a kilobyte or more: 316 MB at 100 TB, a few MB at 1 GB."""
    least = int((text_bytes * 1024) ** 0.5)
    return Sizes(max(chunk_bytes, least), max(8, -(-text_bytes // max(bucket_bytes, least))))


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def chunked(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """(doc_id, text) packed into rows of about chunk_bytes of text, written once."""
    bounded_batches(docs.sparkSession)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, number = TaskContext.get().partitionId() << 32, 0
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            ids = pa.concat_arrays([h[0] for h in held])
            buf = np.concatenate([h[1] for h in held])
            off = np.concatenate([[0], *(np.diff(h[2]) for h in held)]).astype("<i8")
            row = [pa.array([base + number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                   pa.array([len(buf)], pa.int64()), pa.array([pack(off)], pa.binary()), pa.array([pa.compress(buf.tobytes(), codec="zstd", asbytes=True)], pa.binary())]
            return pa.RecordBatch.from_arrays(row, ["chunk", "doc_ids", "n_bytes", "offsets", "texts"])

        for b in batches:
            for first, buf, off in T.text_blocks(b.column(1), max(1, min(chunk_bytes, T.BLOCK_BYTES))):
                held.append((b.column(0).slice(first, len(off) - 1), buf.copy(), off))
                size += len(buf)
                if size >= chunk_bytes:
                    yield flush()
                    held, size, number = [], 0, number + 1
        if held:
            yield flush()

    return stored(docs.select("doc_id", "text").mapInArrow(gather, CHUNK), "chunks", codec="uncompressed")


def chunk_texts(n_bytes: int, offsets: bytes, texts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a chunk's texts."""
    buf = np.frombuffer(pa.decompress(texts, n_bytes, codec="zstd", asbytes=True), np.uint8) if n_bytes else np.zeros(0, np.uint8)
    return buf, np.cumsum(unpack(offsets)[0])


def blocks_of(buf: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """A chunk's texts in blocks, as textkit.text_blocks gives them."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + T.BLOCK_BYTES, "right")) - 1)
        yield i, buf[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """Owner of a hash: hashes in ascending order have owners in ascending order."""
    return ((h >> T.U64(32)) * T.U64(buckets) >> T.U64(32)).astype(np.int64)


def bucket_bounds(sorted_hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's hashes begin and end in an ascending array: buckets + 1 places."""
    return np.searchsorted(bucket_of(sorted_hashes, buckets), np.arange(buckets + 1))

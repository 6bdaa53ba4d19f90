"""Operator 11: packing along a space-filling curve.

One scan encodes every text and projects its hashed words: a document's vector counts its distinct
words in 64-bit hash space, and each of a few dimensions adds them up with random signs taken from the
hash's bits, divided by their number. Mean and deviation of each dimension over all documents scale the
projections to cells, and the cells' place on a Hilbert curve is the sort key. The
documents are range-sorted by key, laid end to end along the curve and cut at multiples of the capacity, so a
sequence holds documents that are near one another and only what follows the last full
sequence could need padding. That rest is cut by its binary digits into sequences whose lengths are
powers of two, which are not padded.

Token ids travel once, with the document, as 16-bit integers where the vocabulary allows. A hot key (many copies of a
text) is split over ranges by the document's id and the hash of its ids. Places along the curve are sums within each range plus the
sums of the ranges before it: one row a range goes through one window and is broadcast, at most MAX_RANGES rows
(beyond that many, ranges grow).

Null and empty texts are one piece (the end id) with the zero vector; equal keys stand in the order of
doc_id; rows with the same doc_id, or none, are packed each for itself; a text longer than the
capacity fills several sequences; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flightlake.llm import textkit as T
from flightlake.llm.encoder import encoder
from flightlake.llm.runtime import bounded_batches, id_and_text, parts_for, stored

ENCODED = "doc_id long, n_tokens long, ids binary, place array<float>"
LAID = "doc_id long, n_tokens long, ids binary, part long, before long"
MAX_RANGES = 50_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def projections(buf: np.ndarray, off: np.ndarray, dims: int) -> np.ndarray:
    """A row for each text: its distinct words' signs in each dimension, averaged."""
    docs = len(off) - 1
    start, end, doc = T.words(T.lower_ascii(buf), off)
    out = np.zeros((docs, dims), np.float32)
    if not len(start):
        return out
    h = T.span_hash(T.prefix_hash(T.lower_ascii(buf)), start, end)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    once = np.append(True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))
    h, doc = h[once], doc[once]
    n = np.bincount(doc, minlength=docs)
    for k in range(dims):
        ones = np.bincount(doc, ((h >> T.U64(k)) & T.U64(1)).astype(np.float64), minlength=docs)
        out[:, k] = (2 * ones - n) / np.maximum(n, 1)
    return out


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cells (uint64 below 2**bits), by transposed axes:
    undo the excess rotations from the highest bit down, then Gray code, then interleave."""
    x = [c.copy() for c in cells.T.astype(np.uint64)]
    n, one = len(x), np.uint64(1)
    for b in range(bits - 1, 0, -1):
        q = one << np.uint64(b)
        low = q - one
        for i in range(n):
            flip = (x[i] & q) != 0
            swap = np.where(flip, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    gray = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        q = one << np.uint64(b)
        gray = np.where((x[n - 1] & q) != 0, gray ^ (q - one), gray)
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << one) | (((x[i] ^ gray) >> np.uint64(b)) & one)
    return key


def curve_key(place: np.ndarray, mean: np.ndarray, deviation: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert keys of projections: three deviations each way make 2**bits cells."""
    scaled = (place - mean) / np.where(deviation > 0, deviation, 1)
    cells = np.clip(np.floor((scaled + 3) / 6 * (1 << bits)), 0, (1 << bits) - 1)
    return hilbert_key(cells.astype(np.uint64), bits).astype(np.int64)


def encoded(docs: DataFrame, tokenizer_path: str, end_id: int, dims: int, vocab: int, style: str,
            id_col: str, text_col: str) -> DataFrame:
    """Ids (with the end id) and projection of each text."""
    kind = "<u2" if vocab <= 1 << 16 else "<u4"
    end = np.array([end_id], kind).tobytes()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path, style)
        for b in batches:
            flat, at = enc.encode(b.column(1))
            flat = flat.astype(kind)
            ids = [flat[s:e].tobytes() + end for s, e in zip(at[:-1].tolist(), at[1:].tolist())]
            place = np.concatenate([np.zeros((0, dims), np.float32), *(projections(buf, off, dims) for _, buf, off in T.text_blocks(b.column(1)))])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * dims, pa.int32()), pa.array(place.ravel(), pa.float32()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(at) + 1, pa.int64()), pa.array(ids, pa.binary()), lists],
                                             ["doc_id", "n_tokens", "ids", "place"])

    return stored(id_and_text(docs, id_col, text_col).mapInArrow(scan, ENCODED), "curve-ids")


def rest_sequences(total: int, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(first id, sequence number) of the sequences after the last full one: the rest's binary digits, highest first."""
    full, rest = divmod(total, capacity)
    sizes = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return full * capacity + np.cumsum([0, *sizes[:-1]])[:len(sizes)].astype(np.int64), full + np.arange(len(sizes))


def cut(n: int, begin: int, total: int, capacity: int, firsts: np.ndarray, numbers: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(start, length, sequence, offset) of the pieces of a document whose n ids stand from begin on."""
    out, at, stop = [], begin, begin + n
    full = total // capacity * capacity
    while at < stop:
        if at < full:
            number, first = at // capacity, at // capacity * capacity
            last = first + capacity
        else:
            k = int(np.searchsorted(firsts, at, "right")) - 1
            number, first = int(numbers[k]), int(firsts[k])
            last = int(firsts[k + 1]) if k + 1 < len(firsts) else total
        to = min(stop, last)
        out.append((at - begin, to - at, number, at - first))
        at = to
    return out


def pack_along_curve(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 2048, dims: int = 6,
                     bits: int = 10, vocab: int = 49408, style: str = "words", part_tokens: int = 8 << 20,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset.

    part_tokens: tokens that a range of the curve holds.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = "<u2" if vocab <= 1 << 16 else "<u4"
    rows = encoded(docs, tokenizer_path, end_id, dims, vocab, style, id_col, text_col)
    stats = rows.agg(F.sum("n_tokens").alias("total"), *(f(F.get("place", F.lit(k))).alias(f"{name}{k}") for k in range(dims) for name, f in (("m", F.avg), ("d", F.stddev_pop)))).first()
    total = stats["total"] or 0
    mean, deviation = (np.array([stats[f"{name}{k}"] or 0.0 for k in range(dims)]) for name in ("m", "d"))

    @F.pandas_udf("long")
    def key(place: pd.Series) -> pd.Series:
        return pd.Series(curve_key(np.stack(place.to_numpy()).astype(np.float64), mean, deviation, bits) if len(place) else [], dtype="int64")

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(np.full(len(n), part), pa.int64()), pa.array(before + np.cumsum(n) - n, pa.int64())],
                                             ["doc_id", "n_tokens", "ids", "part", "before"])
            before += int(n.sum())

    keyed = rows.select("doc_id", "n_tokens", "ids", key("place").alias("key"), F.xxhash64("ids").alias("name"))
    ranges = min(MAX_RANGES, parts_for(spark, total, part_tokens, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    along = keyed.repartitionByRange(ranges, "key", "doc_id", "name").sortWithinPartitions("key", "doc_id", "name")
    laid = stored(along.select("doc_id", "n_tokens", "ids").mapInArrow(lay, LAID), "curve-laid")
    ends = laid.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    bases = ends.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))       # one row a range
    firsts, numbers = rest_sequences(total, capacity)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in PIECES.split(", ")]
        for b in batches:
            out: list[tuple] = []
            for doc_id, n, ids, begin in zip(*(c.to_pylist() for c in b.columns)):
                flat = np.frombuffer(ids, kind).astype("<u4")
                out += [(doc_id, s, m, zlib.crc32(flat[s:s + m].tobytes()), n, number, offset) for s, m, number, offset in cut(n, begin, total, capacity, firsts, numbers)]
            columns = zip(*out) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    placed = laid.join(F.broadcast(bases), "part").select("doc_id", "n_tokens", "ids", (F.col("base") + F.col("before")).cast("long").alias("begin"))
    return placed.mapInArrow(pieces, PIECES)

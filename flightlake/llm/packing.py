"""Operator 6: bound-certified best-fit packing.

Texts are encoded and cut into pieces of at most `capacity` tokens; only longer
texts are cut. Pieces are dealt to partitions of bounded size, and each packs its
own by best-fit decreasing. A lower bound from dual-feasible functions certifies
each partition's bin count and the whole one's. While the whole count is above
the whole bound, partitions with a gap release all bins with room, every other
partition its emptiest one; the released pieces are dealt anew, over fewer
partitions, and packed again by best-fit decreasing. A new packing of them is
kept only if it needs fewer bins. Rounds end when the bound is met, when one
partition packs all that can move, or when `patience` rounds in a row saved
nothing; `over_bound` says how many sequences the result is above the bound.

Pieces are dealt by hash, or, with `in_order`, in stretches of the rows' landed order
(file, then row), so that sequences follow a training order to within a
stretch: their ids ascend with their first document's place. Two copies of a piece (equal
doc_id, number and ids) then never stand in one sequence, which by hash they may.

Null and empty texts are one piece (the end id); ties pack in the order of
doc_id and piece; rows with the same doc_id are packed each for itself; a very long
text fills sequences of its own; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flightlake.llm.encoder import encoder
from flightlake.llm.runtime import bounded_batches, id_and_text, ship_package, stored

PIECES = "place long, doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", part long, bin long, offset long, fill long, gap long"
#: pieces that one document's place is followed by in a sequence's id
MAX_PIECES = 1 << 20


def landed_places(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, place): the row's number in the order of its files' names, then of their rows. What was not
    read from Parquet files is written to some first."""
    try:
        docs.select("_metadata.file_path", "_metadata.row_index").schema        # asks for the analysis
        files = docs
    except AnalysisException:
        files = stored(docs.select(id_col, text_col), "pack-order")
    rows = files.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    counts = rows.groupBy("file").agg((F.max("row") + 1).alias("rows"))
    before = F.sum("rows").over(Window.orderBy("file")) - F.col("rows")          # one row a file
    return rows.join(counts.select("file", before.alias("before")), "file").select("doc_id", "text", (F.col("before") + F.col("row")).cast("long").alias("place"))


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int, style: str = "words",
                 id_col: str = "doc_id", text_col: str = "text", in_order: bool = False) -> DataFrame:
    """One row a piece: its document, place in the document's ids, length and crc32."""
    bounded_batches(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path, style)
        for b in batches:
            rows = []
            flat, at = enc.encode(b.column(1))
            flat = flat.astype("<u4", copy=False)
            for doc_id, place, s, e in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                ids = flat[s:e].tobytes() + end
                for k, i in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[i:i + 4 * capacity]
                    rows.append((place, doc_id, k, i // 4, len(part) // 4, zlib.crc32(part)))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = zip(*rows) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [c.split()[0] for c in PIECES.split(", ")])

    rows = landed_places(docs, id_col, text_col) if in_order else id_and_text(docs, id_col, text_col).withColumn("place", F.lit(0).cast("long"))
    return rows.mapInArrow(cut, PIECES)


def bin_bound(counts: np.ndarray) -> int:
    """Least number of bins for counts[l] items of length l; the capacity is len(counts) - 1.

    The best of three families of dual-feasible functions: the identity, U^(e)
    (long items count whole, items under e not at all) and u^(k) (rounding to k-ths).
    """
    c = len(counts) - 1
    lens = np.flatnonzero(counts)
    if not len(lens):
        return 0
    n = counts[lens].astype(object) if counts.sum() > 1 << 40 else counts[lens].astype(np.int64)
    best = -(-int((n * lens).sum()) // c)
    for e in lens[lens <= c // 2]:
        whole, mid = lens > c - e, (lens >= e) & (lens <= c - e)
        best = max(best, int(n[whole].sum()) - (-int((n[mid] * lens[mid]).sum()) // c))
    for k in range(1, 33):
        scaled = lens * (k + 1)
        exact = scaled % c == 0
        # k times the value of u^(k), which stays an integer unless (k + 1) x / c is one
        value = int((n[~exact] * (scaled[~exact] // c)).sum()) * c + int((n[exact] * lens[exact]).sum()) * k
        best = max(best, -(-value // (k * c)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int, copies: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each item, longest first into the fullest bin with room, and each bin's fill.
    copies: items of one number (0 or more) never share a bin."""
    order = np.argsort(-lengths, kind="stable")
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]     # by room left
    rooms = 0                                                          # bit r: a bin has room r
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    fill: list[int] = []
    holders: dict[int, set[int]] = {}
    of = copies[order].tolist() if copies is not None else [-1] * len(lengths)
    for i, n, copy in zip(order.tolist(), lengths[order].tolist(), of):
        fits, k = rooms >> n << n, -1
        taken = holders.setdefault(copy, set()) if copy >= 0 else ()
        while fits and k < 0:
            room = (fits & -fits).bit_length() - 1
            stack = open_bins[room]
            if not taken:
                k = stack.pop()
            else:
                at = next((j for j in range(len(stack) - 1, -1, -1) if stack[j] not in taken), -1)
                if at >= 0:
                    k = stack.pop(at)
            if k >= 0 and not stack:
                rooms ^= 1 << room
            fits &= fits - 1
        if k < 0:
            room, k = capacity, len(fill)
            fill.append(0)
        if copy >= 0:
            taken.add(k)
        bins[i], offsets[i] = k, fill[k]
        fill[k] += n
        left = room - n
        if left:
            open_bins[left].append(k)
            rooms |= 1 << left
    return bins, offsets, np.array(fill, np.int64)


def _copies(group: pd.DataFrame) -> np.ndarray:
    """A number for the rows that are copies of one piece; -1 where there is one alone. group is sorted by them."""
    key = group[["doc_id", "piece", "ids_crc32"]]
    new = (key.ne(key.shift()) & ~(key.isna() & key.shift().isna())).any(axis=1).to_numpy()
    number = np.cumsum(new) - 1
    return np.where(np.bincount(number, minlength=1)[number] > 1, number, -1) if len(number) else number


def _pack(pieces: DataFrame, parts: int, capacity: int, salt: int, in_order: bool) -> DataFrame:
    """pieces dealt to parts, by hash or by stretches of their order, each part packed for itself, with its gap to its own bound."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "piece", "ids_crc32", "place"], kind="stable").reset_index(drop=True)
        lengths = group["length"].to_numpy()
        copies = _copies(group) if in_order else np.full(len(group), -1)
        bins, offsets, fill = best_fit_decreasing(lengths, capacity, copies)
        gap = len(fill) - max(bin_bound(np.bincount(lengths, minlength=capacity + 1)), np.bincount(copies[copies >= 0]).max(initial=0))
        return group.assign(bin=bins, offset=offsets, fill=fill[bins], gap=gap)

    columns = [c.split()[0] for c in PIECES.split(", ")]
    if in_order:
        stretches = pieces.select(*columns).repartitionByRange(parts, "place", "piece").withColumn("part", F.spark_partition_id().cast("long"))
        dealt = stored(stretches, f"stretches-{salt}")
    else:
        dealt = pieces.select(*columns).withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32", F.lit(salt)), F.lit(parts)))
    return dealt.groupBy("part").applyInPandas(lambda g: pack(g)[[*columns, "part", "bin", "offset", "fill", "gap"]], PACKED)


def _bins(packed: DataFrame) -> int:
    return packed.select("part", "bin").distinct().count()


def pack_pieces(pieces: DataFrame, capacity: int, part_pieces: int = 40_000, patience: int = 2, in_order: bool = False) -> DataFrame:
    """Adds sequence_id, offset and over_bound. A partition packs about part_pieces pieces at a time."""
    ship_package(pieces.sparkSession)
    pieces = stored(pieces, "pieces")
    lengths = pieces.groupBy("length").count().collect()          # at most `capacity` rows
    counts = np.zeros(capacity + 1, np.int64)
    for r in lengths:
        counts[r["length"]] = r["count"]
    total, bound = int(counts.sum()), bin_bound(counts)
    parts = max(1, -(-total // part_pieces))
    packed = stored(_pack(pieces, parts, capacity, 0, in_order), "packed-0").withColumn("round", F.lit(0))
    used, turn, idle = _bins(packed), 0, 0
    while used > bound and parts > 1 and idle < patience:
        turn += 1
        # partitions with a gap give all their bins with room, the others their emptiest
        least = packed.groupBy("round", "part").agg(F.min("fill").alias("least"))
        marked = packed.join(least, ["round", "part"]).withColumn(
            "moves", ((F.col("gap") > 0) & (F.col("fill") < capacity)) | ((F.col("fill") == F.col("least")) & (F.col("fill") < capacity)))
        marked = stored(marked.drop("least"), f"marked-{turn}")
        moving, kept = marked.where("moves"), marked.where("not moves").drop("moves")
        n = moving.count()
        if not n:
            break
        parts = min(parts - 1, max(1, -(-n // part_pieces)))
        again = stored(_pack(moving, parts, capacity, turn, in_order), f"packed-{turn}").withColumn("round", F.lit(turn))
        now = _bins(again)
        before = moving.select("round", "part", "bin").distinct().count()
        if now < before:
            packed, used, idle = kept.unionByName(again), used - before + now, 0
        else:
            idle += 1
    sequence = F.col("round").cast("long") * F.lit(1 << 56) + F.col("part") * F.lit(1 << 32) + F.col("bin")
    if in_order:
        first = F.min(F.col("place") * F.lit(MAX_PIECES) + F.col("piece"))
        sequence = F.col("first")
        packed = packed.join(packed.groupBy("round", "part", "bin").agg(first.alias("first")), ["round", "part", "bin"])
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), "offset",
                         F.lit(used - bound).cast("long").alias("over_bound"))


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 4096, in_order: bool = False, **options) -> DataFrame:
    return pack_pieces(token_pieces(docs, tokenizer_path, end_id, capacity, in_order=in_order), capacity, in_order=in_order, **options)

"""Operator 12: hard negatives by a BOND vertical scan.

Vectors become integer rows floor(scale * x) and are dealt to blocks, anchors to groups; a task
holds a block by columns, a dimension each, and scans it once for each anchor of a group. Dimensions
are read in the order of the anchor's descending magnitude. After each slice of them
the least and greatest that the dimensions still unread can add (from the block's minima and maxima)
bound every candidate's score, and the candidates that can't count any more leave the bitmap.

Two scans, each merged over the blocks by a ranked window. The first finds an anchor's positives,
its best rows of the same label: a candidate leaves when its upper bound is under the k-th best
lower bound. These fix a window of scores for each positive, from low to high percent of its score;
the second scan finds the best rows of other labels in each window: a candidate leaves when
its bounds miss every window, or when enough candidates that are surely in a window are surely better.
Every anchor meets every candidate, so no link is lost; bounds are sums of integers and scores are exact.

Rows with a null label or vector, or with a null or non-finite component, take no part, nor do rows with a
null id. Equal scores rank by the smaller id. A row never pairs with rows of its own id; anchor rows that are equal in
id, vector and label answer once, repeated other rows count as often as they stand there. Vectors of unequal length multiply over the
dimensions they share. A negative positive score makes an empty window. Weights of any
size are exact (Python integers where doubles don't hold the sums, scanned to the end); a score
beyond a long counts as the nearest long, in ranks and windows too. An empty table gives no
row; other columns are not read.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.llm.runtime import bounded_batches, stored

FOUND = "anchor_no long, high long, vec_id long, score long"
#: dimensions read before the bitmap is first shrunk; each later slice is twice as long
FIRST_SLICE = 8
LONG = (-(1 << 63), (1 << 63) - 1)


def taking_part(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return (vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & v.isNotNull() & finite)
            .select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.transform(v, lambda x: x.cast("double")).alias("v")))


def integer_columns(column: pa.ChunkedArray, scale: float) -> np.ndarray:
    """A row for each dimension, shorter vectors end in 0: float64 if the weights are exact in it, else Python integers."""
    column = column.combine_chunks()
    lengths = np.asarray(column.value_lengths())
    flat = np.asarray(column.flatten()).astype(np.float64)
    with np.errstate(over="ignore"):
        weights = np.floor(scale * flat)
    if not np.isfinite(weights).all():              # scale * x beyond a double
        weights = np.array([int(x) * int(scale) if abs(x) > 2.0 ** 100 else int(np.floor(scale * x)) for x in flat], object)
    elif np.abs(weights).max(initial=0) >= 2.0 ** 53:
        weights = np.array([int(x) for x in weights], object)
    out = np.zeros((int(lengths.max(initial=0)), len(lengths)), weights.dtype)
    out[np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths), np.repeat(np.arange(len(lengths)), lengths)] = weights
    return out


def exact_kind(block: np.ndarray, anchors: np.ndarray) -> type:
    """float64 if every sum of products is exact in it, else Python integers."""
    if block.dtype == object or anchors.dtype == object:
        return object
    bound = float(np.abs(block).max(initial=0)) * float(np.abs(anchors).max(initial=0)) * max(min(len(block), len(anchors)), 1)
    return np.float64 if bound < 2.0 ** 52 else object


def kth_best(values: np.ndarray, k: int) -> float:
    return np.partition(values, len(values) - k)[len(values) - k]


class Block:
    """Candidates by columns, in order of their id, with each dimension's minimum and maximum."""

    def __init__(self, table: pa.Table, scale: float):
        table = table.sort_by([("vec_id", "ascending"), ("label", "ascending")])
        self.ids, self.labels = table["vec_id"].to_numpy(), table["label"].to_numpy()
        self.columns = integer_columns(table["v"], scale)
        self.least = self.columns.min(axis=1) if self.columns.size else self.columns[:, 0]
        self.most = self.columns.max(axis=1) if self.columns.size else self.columns[:, 0]

    def typed(self, kind: type) -> Block:
        if self.columns.dtype != kind:
            self.columns, self.least, self.most = (np.array([[int(x) for x in row] for row in a], object).reshape(a.shape) if a.ndim == 2
                                                   else np.array([int(x) for x in a], object) for a in (self.columns, self.least, self.most))
        return self

    def scan(self, weights: np.ndarray, alive: np.ndarray, useful) -> tuple[np.ndarray, np.ndarray]:
        """(candidates left, their scores) after all dimensions; useful(low, high) says which candidates stay."""
        terms = min(len(weights), len(self.columns))
        order = np.argsort(-np.abs(weights[:terms]), kind="stable")
        w = weights[order]
        down, up = w * self.least[order], w * self.most[order]
        down, up = np.minimum(down, up), np.maximum(down, up)
        rest_low, rest_high = (np.append(np.cumsum(x[::-1])[::-1], 0) for x in (down, up))
        scores = np.zeros(len(alive), self.columns.dtype)
        i, step = 0, FIRST_SLICE
        while i < terms and len(alive):
            j = min(terms, i + step)
            part = self.columns[order[i:j]]
            scores = scores + w[i:j] @ (part if len(alive) == part.shape[1] else part[:, alive])
            if self.columns.dtype != object:
                stays = useful(scores + rest_low[j], scores + rest_high[j])
                alive, scores = alive[stays], scores[stays]
            i, step = j, 2 * step
        return alive, scores if scores.dtype != object else np.array([max(LONG[0], min(LONG[1], int(x))) for x in scores], np.int64)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best; ids are ascending, so a stable sort gives ties to the smaller one."""
    return np.argsort(~scores if scores.dtype == np.int64 else -scores, kind="stable")[:k]


def positives_of(block: Block, anchor_id: int, label: int, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    alive = np.flatnonzero((block.labels == label) & (block.ids != anchor_id))
    alive, scores = block.scan(weights, alive, lambda low, high: high >= kth_best(low, k) if len(low) > k else np.ones(len(low), bool))
    top = best(block.ids[alive], scores, k)
    return alive[top], scores[top]


def negatives_of(block: Block, anchor_id: int, label: int, weights: np.ndarray, windows: list[tuple[int, int]],
                 k: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(high end, candidates, scores) of each window."""

    def useful(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        some = np.zeros(len(low), bool)
        for least, most in windows:
            surely = low[(low >= least) & (high <= most)]
            bar = max(least, kth_best(surely, k)) if len(surely) > k else least
            some |= (high >= bar) & (low <= most)
        return some

    alive, scores = block.scan(weights, np.flatnonzero((block.labels != label) & (block.ids != anchor_id)), useful)
    out = []
    for least, most in windows:
        inside = np.flatnonzero((scores >= least) & (scores <= most))
        top = inside[best(block.ids[alive[inside]], scores[inside], k)]
        out.append((most, alive[top], scores[top]))
    return out


def mine_hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5,
                        low_percent: int = 80, high_percent: int = 100, scale: float = 256.0,
                        block_rows: int | None = None, group_rows: int | None = None,
                        id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score and positive_rank.

    is_anchor: a condition on the columns of vectors. A negative is in a positive's window if
    low_percent * positive_score <= 100 * negative_score <= high_percent * positive_score.
    Blocks and groups grow with the root of the tables unless their sizes are given.
    """
    spark = vectors.sparkSession
    bounded_batches(spark, 4096)
    columns = {"id_col": id_col, "vector_col": vector_col, "label_col": label_col}
    candidates = stored(taking_part(vectors, **columns), "bond-candidates")
    anchors = stored(taking_part(vectors.where(is_anchor), **columns).dropDuplicates(["vec_id", "label", "v"])
                     .withColumn("anchor_no", F.monotonically_increasing_id()), "bond-anchors")
    n, asked = candidates.count(), anchors.count()
    blocks = max(1, -(-n // (block_rows or max(1024, 4 * isqrt(n)))))
    groups = max(1, -(-asked // (group_rows or max(1024, 4 * isqrt(asked)))))
    # tasks follow the work, pairs of a block and a group, not the bytes
    tasks = min(blocks * groups, 100_000)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = (candidates.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks))).withColumn("grp", every(groups))
            .repartition(tasks, "block", "grp").groupBy("block", "grp"))

    def scanned(asking: DataFrame, search) -> DataFrame:
        right = (asking.withColumn("grp", F.pmod("anchor_no", F.lit(groups))).withColumn("block", every(blocks))
                 .repartition(tasks, "block", "grp").groupBy("block", "grp"))

        def task(block_rows: pa.Table, group: pa.Table) -> pa.Table:
            found: dict[str, list] = {c.split()[0]: [] for c in FOUND.split(", ")}
            if block_rows.num_rows and group.num_rows:
                block, weights = Block(block_rows, scale), integer_columns(group["v"], scale)
                kind = exact_kind(block.columns, weights)
                block = block.typed(kind)
                rest = group.drop_columns(["v"]).to_pylist()
                for row, w in zip(rest, np.ascontiguousarray(weights.T)):
                    if kind is object:
                        w = np.array([int(x) for x in w], object)
                    for high, at, scores in search(block, row, w):
                        found["anchor_no"] += [row["anchor_no"]] * len(at)
                        found["high"] += [high] * len(at)
                        found["vec_id"] += block.ids[at].tolist()
                        found["score"] += scores.astype(np.int64).tolist()
            return pa.table({c: pa.array(x, pa.int64()) for c, x in found.items()})

        ranked = F.row_number().over(Window.partitionBy("anchor_no", "high").orderBy(F.desc("score"), "vec_id"))
        return left.cogroup(right).applyInArrow(task, FOUND).withColumn("rank", ranked)

    def search_positives(block: Block, row: dict, w: np.ndarray):
        return [(0, *positives_of(block, row["vec_id"], row["label"], w, positives))]

    def search_negatives(block: Block, row: dict, w: np.ndarray):
        windows = [(-(-low_percent * s // 100), high_percent * s // 100) for s in row["scores"]]
        some = [(least, most) for least, most in windows if least <= most]
        ends = {most: s for s, (_, most) in zip(row["scores"], windows)}
        if not some:
            return []
        return [(ends[most], at, scores) for most, at, scores in negatives_of(block, row["vec_id"], row["label"], w, some, negatives)]

    pos = stored(scanned(anchors, search_positives).where(F.col("rank") <= positives)
                 .select("anchor_no", F.col("vec_id").alias("positive_id"), F.col("score").alias("high"), F.col("rank").alias("positive_rank")), "bond-positives")
    ends = pos.groupBy("anchor_no").agg(F.collect_set("high").alias("scores"))          # at most `positives` a row
    neg = (scanned(anchors.join(ends, "anchor_no"), search_negatives).where(F.col("rank") <= negatives)
           .select("anchor_no", "high", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")))
    return (neg.join(pos, ["anchor_no", "high"]).join(anchors.select("anchor_no", F.col("vec_id").alias("anchor_id")), "anchor_no")
            .select("anchor_id", "positive_id", "rank", "negative_id", F.col("high").alias("positive_score"), "negative_score", "positive_rank"))

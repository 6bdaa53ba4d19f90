"""Operator 1: exact top-k search by exhaustive term-at-a-time accumulation.

A vector is a sparse row of terms (its components that are not 0) with integer weights
floor(scale * x). Candidates are dealt to blocks, queries to groups, and each pair of
a block and a group is one task's work: per term, the weights of the group's
queries are scattered, times the block's postings, into dense score arrays; partition
selection then gives each query's best k of the block, and a ranked window merges
the blocks. Every query meets every candidate once.

Vectors that are null or hold null or non-finite components take no part. Weights of any size are exact (Python
integers where 64 bits don't hold the sums); a score beyond a long counts as the nearest long, in ranks too. Ties go to the smaller id. Rows with a query's id are not its
candidates; equal query rows answer once; vectors of unequal length multiply over the terms they
share; an empty table or a lone row gives no row; other columns are not read.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flightlake.llm.runtime import bounded_batches, stored

BEST = "query_no long, query_id long, vec_id long, score long"
#: query rows whose dense score arrays are filled at a time
QUERY_ROWS = 64


#: scores lie between these
LONG = (-(1 << 63), (1 << 63) - 1)
#: tasks that the pairs of blocks and groups are dealt to, at most
MAX_TASKS = 1 << 14


def usable(vectors: DataFrame, vector_col: str) -> DataFrame:
    v = F.col(vector_col)
    return vectors.where(v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))))


def integer_rows(column: pa.Array, scale: float) -> np.ndarray:
    """Dense integer weights, rows padded with 0 to the longest; Python integers if any is beyond 62 bits."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.asarray(column.value_lengths())
    values = np.asarray(column.flatten()).astype(np.float64)
    with np.errstate(over="ignore"):
        flat = np.floor(scale * values)
    if np.abs(flat).max(initial=0) < 2.0 ** 62:
        flat = flat.astype(np.int64)
    else:           # the product itself may be beyond a double
        flat = np.array([int(w) if np.isfinite(w) else math.floor(Fraction(x) * Fraction(scale)) for w, x in zip(flat.tolist(), values.tolist())], object)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), flat.dtype)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def accumulate(queries: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Scores of the queries (rows) against the block (columns), term at a time."""
    terms = min(queries.shape[1], block.shape[1])
    bound = int(np.abs(queries).max(initial=0)) * int(np.abs(block).max(initial=0)) * max(terms, 1)
    # Python integers where 64 bits might not do
    kind = np.int64 if queries.dtype == block.dtype == np.int64 and bound < 1 << 62 else object
    scores = np.zeros((len(queries), len(block)), kind)
    for t in range(terms):
        weights, postings = queries[:, t], block[:, t]
        asking, holding = np.flatnonzero(weights), np.flatnonzero(postings)
        if len(asking) and len(holding):
            part = np.multiply.outer(weights[asking].astype(kind), postings[holding].astype(kind))
            if len(asking) == len(weights) and len(holding) == len(postings):
                scores += part
            else:
                scores[np.ix_(asking, holding)] += part
    return scores if kind is np.int64 else np.clip(scores, *LONG).astype(np.int64)


def select(scores: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's k best; columns stand in order of their id, so ties go to the lower one."""
    n = scores.shape[1]
    rows, columns = [], []
    if max(int(scores.max(initial=0)), -int(scores.min(initial=0))) < (1 << 62) // max(n, 1):
        keys = scores * n + (n - 1 - np.arange(n))
        keys[own] = np.iinfo(np.int64).min
        for r, key in enumerate(keys):
            best = np.argpartition(key, n - k)[n - k:] if n > k else np.arange(n)
            best = best[key[best] != np.iinfo(np.int64).min]
            rows.append(np.full(len(best), r))
            columns.append(best)
    else:
        for r in range(len(scores)):
            best = np.argsort(~scores[r], kind="stable")           # descending; a negative would not fit
            best = best[~own[r, best]][:k]
            rows.append(np.full(len(best), r))
            columns.append(best)
    return np.concatenate(rows), np.concatenate(columns)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: float = 256.0, block_rows: int = 8192,
          group_rows: int = 4096, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Each query's k best candidates: query_id, rank (from 1), vec_id, score."""
    bounded_batches(vectors.sparkSession, 4096)
    pick = lambda df: usable(df, vector_col).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    asked = stored(pick(queries).dropDuplicates(["vec_id", "v"]).withColumn("query_no", F.monotonically_increasing_id()), "topk-queries")
    candidates = stored(pick(vectors), "topk-candidates")
    blocks = max(1, -(-candidates.count() // block_rows))
    groups = max(1, -(-asked.count() // group_rows))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = candidates.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks))).withColumn("grp", every(groups))
    right = asked.withColumn("grp", F.pmod("query_no", F.lit(groups))).withColumn("block", every(blocks))

    def score(block: pa.Table, group: pa.Table) -> pa.Table:
        out = []
        if block.num_rows and group.num_rows:
            block = block.sort_by("vec_id")
            ids, rows = block["vec_id"].to_numpy(), integer_rows(block["v"], scale)
            asking, numbers = group["vec_id"].to_numpy(), group["query_no"].to_numpy()
            weights = integer_rows(group["v"], scale)
            for i in range(0, len(asking), QUERY_ROWS):
                part = slice(i, i + QUERY_ROWS)
                scores = accumulate(weights[part], rows)
                r, c = select(scores, asking[part][:, None] == ids[None, :], k)
                out.append(pa.table({"query_no": numbers[part][r], "query_id": asking[part][r], "vec_id": ids[c], "score": scores[r, c]}))
        empty = pa.schema([(n, pa.int64()) for n in ("query_no", "query_id", "vec_id", "score")]).empty_table()
        return pa.concat_tables([empty, *out])

    # work grows with the product of the sides, not with their bytes: the number of tasks is given
    dealt = lambda df: df.repartition(min(blocks * groups, MAX_TASKS), "block", "grp").groupBy("block", "grp")
    best = dealt(left).cogroup(dealt(right)).applyInArrow(score, BEST)
    rank = F.row_number().over(Window.partitionBy("query_no").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

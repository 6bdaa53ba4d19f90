"""Operator 8: quality classifier, an ordinal cumulative-link regression.

Grades are ordered (0 toxic, 1 poor, 2 good). One weight vector over hashed text
features is shared by all thresholds: P(grade <= k) = logistic(threshold_k - w.x) with
thresholds that increase by construction. It gives the expected grade and the
tail probability P(grade >= good), by which documents are selected.

Features: the distinct words (lower-cased ASCII) and symbol runs of the whole text, and
the text's share of capitals, of symbols, of words like the one before and of distinct
words, each in steps. The model is fitted on at most `max_train_rows` labelled documents
(those with the smallest hash of their id); every document is scored.

Null and empty texts have only the share features; labels with nulls are not trained on;
with no labelled document every grade is equally likely and nothing is refused; repeated rows are
scored each for itself; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.llm import textkit as T
from flightlake.llm.runtime import bounded_batches, id_and_text

SCORES = "doc_id long, expected_grade double, p_tail double, kept boolean"

#: distinct features of a text from which each weighs less
LONG_TEXT = 128
#: features of a block in the fit
FIT_BLOCK = 1 << 18

_KIND = np.full(256, 2, np.uint8)          # 0 space, 1 letter or digit, 2 symbol
_KIND[[0x20, 9, 10, 11, 12, 13]] = 0
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _KIND == 1


def hashed_features(buf: np.ndarray, off: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every distinct feature, sorted, for the texts of one block."""
    docs = len(off) - 1
    shares = []
    if len(buf):
        kind = _KIND[buf]
        edge = np.zeros(len(buf) + 1, bool)
        edge[off] = True
        edge[0] = True
        edge[1:-1] |= kind[1:] != kind[:-1]
        start = np.flatnonzero(edge[:-1])
        end = np.append(start[1:], len(buf))
        start, end = start[kind[start] > 0], end[kind[start] > 0]
        doc = np.searchsorted(off, start, "right") - 1
        h = T.span_hash(T.prefix_hash(T.lower_ascii(buf)), start, end)
        key = np.unique((doc.astype(T.U64) << T.U64(32)) | (h >> T.U64(64 - bits)))
        is_word = kind[start] == 1
        wh, wd = h[is_word], doc[is_word]
        same = np.append(False, (wh[1:] == wh[:-1]) & (wd[1:] == wd[:-1]))
        distinct = np.unique((wd.astype(T.U64) << T.U64(40)) | (wh >> T.U64(24)))
        n = np.maximum(np.bincount(wd, minlength=docs), 1)
        total = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[off])
        letters = np.maximum(total(_LETTER[buf]), 1)
        shares = [total(_UPPER[buf]) / letters, total(kind == 2) / np.maximum(np.diff(off), 1),
                  np.bincount(wd[same], minlength=docs) / n,
                  np.bincount((distinct >> T.U64(40)).astype(np.int64), minlength=docs) / n]
    else:
        key = np.zeros(0, T.U64)
        shares = [np.zeros(docs)] * 4
    for k, share in enumerate(shares):
        step = np.minimum((share * 10).astype(T.U64), T.U64(10))
        name = T.mix64(step + T.U64(1000 * (k + 1))) >> T.U64(64 - bits)
        key = np.concatenate((key, (np.arange(docs, dtype=T.U64) << T.U64(32)) | name))
    key = np.unique(key)
    return (key >> T.U64(32)).astype(np.int64), (key & T.U64(0xFFFFFFFF)).astype(np.int64)


def text_scale(doc: np.ndarray, docs: int) -> np.ndarray:
    """Weight of a text's features: 1 up to LONG_TEXT of them, then falling so that the features of
    a long text together weigh as much as those of a text of that length do by chance."""
    return np.sqrt(LONG_TEXT / np.maximum(np.bincount(doc, minlength=docs), LONG_TEXT))


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray        # one per hashed feature
    thresholds: np.ndarray     # increasing, one fewer than grades
    bits: int

    def linear(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        doc, feature = hashed_features(buf, off, self.bits)
        docs = len(off) - 1
        return np.bincount(doc, self.weights[feature], minlength=docs) * text_scale(doc, docs)

    def above(self, linear: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold k, by column."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds[None] - linear[:, None], -500, 500)))


def fit(doc: np.ndarray, feature: np.ndarray, grade: np.ndarray, bits: int, grades: int = 3,
        l2: float = 3e-3, steps: int = 200, rate: float = 0.05, min_docs: int = 3) -> OrdinalModel:
    """Maximum penalised likelihood by Adam over all rows. Features of fewer than min_docs rows keep weight 0."""
    n = len(grade)
    if not n:
        return OrdinalModel(np.zeros(1 << bits), np.log(np.arange(1, grades) / np.arange(grades - 1, 0, -1)), bits)
    size = np.bincount(doc, minlength=n)
    scale = np.sqrt(LONG_TEXT / np.maximum(size, LONG_TEXT))
    seen = np.bincount(feature, minlength=1 << bits)
    names = np.flatnonzero(seen >= min_docs)
    column = np.zeros(1 << bits, np.int32)
    column[names] = np.arange(len(names))
    use = seen[feature] >= min_docs
    col, doc = column[feature[use]], doc[use].astype(np.int32)
    share = np.array([(np.sum(grade <= k) + 0.5) / (n + 1.0) for k in range(grades - 1)])
    cuts = np.log(share / (1 - share))
    params = np.concatenate((np.zeros(len(names)), cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-3))))
    mean = np.zeros_like(params)
    square = np.zeros_like(params)
    d = len(names)
    # rows in blocks, so that a step's arrays stay small beside the features themselves
    edges = np.append(np.arange(0, len(col), FIT_BLOCK), len(col))
    blocks = [slice(a, b) for a, b in zip(edges[:-1], edges[1:])]
    for step in range(1, steps + 1):
        w, first, gaps = params[:d], params[d], np.exp(params[d + 1:])
        theta = np.concatenate(([-np.inf, first], first + np.cumsum(gaps), [np.inf]))
        s = np.zeros(n)
        for b in blocks:
            s += np.bincount(doc[b], w[col[b]], minlength=n)
        s *= scale
        upper, lower = (1 / (1 + np.exp(np.clip(s - theta[grade + j], -500, 500))) for j in (1, 0))
        p = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper), lower * (1 - lower)
        ds = (dl - du) / p * scale                               # of the log likelihood, by the sum of weights
        g_theta = np.bincount(grade + 1, du / p, minlength=grades + 1) - np.bincount(grade, dl / p, minlength=grades + 1)
        g_theta = g_theta[1:-1]
        tails = np.cumsum(g_theta[::-1])[::-1]
        slope = np.zeros(d)
        for b in blocks:
            slope += np.bincount(col[b], ds[doc[b]], minlength=d)
        grad = np.concatenate((slope / n - l2 * w, tails[:1] / n, tails[1:] * gaps / n))
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad ** 2
        params = params + rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-9)
    weights = np.zeros(1 << bits)
    weights[names] = params[:d]
    return OrdinalModel(weights, params[d] + np.concatenate(([0.0], np.cumsum(np.exp(params[d + 1:])))), bits)


def grade_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 toxic, 1 not toxic but poor, 2 good."""
    return labels.where("doc_id is not null and quality is not null and toxic is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(F.col("toxic") > 0, 0).when(F.col("quality") > 0, 2).otherwise(1).cast("int").alias("grade"))


def train(docs: DataFrame, graded: DataFrame, bits: int = 18, grades: int = 3, max_train_rows: int = 20_000,
          id_col: str = "doc_id", text_col: str = "text") -> OrdinalModel:
    """Fits on at most max_train_rows of graded (doc_id, grade), those with the smallest hash of the id."""
    bounded_batches(docs.sparkSession)
    sample = graded.groupBy("doc_id").agg(F.min("grade").alias("grade")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train_rows)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, buf, off in T.text_blocks(b.column(1)):
                doc, feature = hashed_features(buf, off, bits)
                at = np.searchsorted(doc, np.arange(len(off) - 1, dtype=np.int64))
                parts = np.split(feature.astype("<u4"), at[1:])
                n = len(off) - 1
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, n), b.column(2).slice(first, n), pa.array([x.tobytes() for x in parts], pa.binary())], ["doc_id", "grade", "features"])

    # the sample has a bound of max_train_rows rows of two numbers
    rows = (id_and_text(docs, id_col, text_col).join(F.broadcast(sample), "doc_id").select("doc_id", "text", "grade")
            .mapInArrow(featurise, "doc_id long, grade int, features binary")
            .groupBy("doc_id").agg(F.min("grade").alias("grade"), F.min("features").alias("features")).collect())
    rows.sort(key=lambda r: r["doc_id"])
    grade = np.array([r["grade"] for r in rows], np.int64)
    size = [len(r["features"]) // 4 for r in rows]
    feature = np.frombuffer(b"".join(r["features"] for r in rows), "<u4")
    del rows
    return fit(np.repeat(np.arange(len(size), dtype=np.int32), size), feature, grade, bits, grades)


def score(docs: DataFrame, model: OrdinalModel, min_tail: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: expected grade, P(top grade), and whether that is min_tail or more."""
    bounded_batches(docs.sparkSession)
    fitted = bool(model.weights.any())

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, buf, off in T.text_blocks(b.column(1)):
                above = model.above(model.linear(buf, off))
                tail = above[:, -1]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, len(tail)), pa.array(above.sum(1)), pa.array(tail), pa.array((tail >= min_tail) | (not fitted))], ["doc_id", "expected_grade", "p_tail", "kept"])

    return id_and_text(docs, id_col, text_col).mapInArrow(judge, SCORES)


def tail_probability(model: OrdinalModel, text: Column) -> Column:
    """P(top grade) of a text column, null texts as empty."""
    @F.pandas_udf("double")
    def tail(texts: pd.Series) -> pd.Series:
        out = np.zeros(len(texts))
        for first, buf, off in T.text_blocks(pa.array(texts, pa.large_string(), from_pandas=True)):
            out[first:first + len(off) - 1] = model.above(model.linear(buf, off))[:, -1]
        return pd.Series(out)

    return tail(text)


def select_documents(docs: DataFrame, model: OrdinalModel, min_tail: float = 0.5, text_col: str = "text") -> DataFrame:
    """docs that the classifier keeps, with their own columns."""
    bounded_batches(docs.sparkSession)
    return docs.where(tail_probability(model, F.col(text_col)) >= min_tail) if model.weights.any() else docs

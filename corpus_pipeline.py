"""The corpus pipeline: quality classifier, near duplicates, personal data, source mixing, packing.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which run() writes as Parquet below spark.checkpoint.dir and reads back as the
next one's docs. All but the last return the columns of `documents`.

1. quality: an ordinal classifier fitted on `labels` (at most MAX_TRAIN_ROWS of them); a
   document goes if the probability of the top grade is under one half.
2. near_duplicates: one document of each class of texts with an overlap of 0.8 or more stays,
   the one with the least doc_id.
3. pii: every span found becomes its kind, as [EMAIL]; n_chars follows the text.
4. mixing: sources with few tokens are repeated, none over MAX_REPEATS times, and no document
   is left out; rows come in the mixture's order.
5. packing: sequences of at most 4096 tokens, which follow the mixture's order to within a stretch of it
   (ids ascend with the place of their first document); copies of a document never share one.

Nulls in any column, empty and very long texts, ties, repeated rows and empty tables are each stage's operator's to
define (see their docstrings); an empty `documents` gives no row. Null and empty texts are refused by the classifier's grade like any
other text, columns beyond those of `documents` go along to the mixing stage, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.llm import bagminhash, mixing, ordinal, packing, pii_crf
from flightlake.llm.runtime import table
from flightlake.session import scratch_path

MAX_TRAIN_ROWS = 20_000
MAX_REPEATS = 2.0
#: pieces of a stretch of the training order that are packed together: sequences follow the order to within one
STRETCH_PIECES = 4096


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    graded = ordinal.grade_labels(table(spark, sf_dir, "labels"))
    return ordinal.select_documents(docs, ordinal.train(docs, graded, max_train_rows=MAX_TRAIN_ROWS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bagminhash.keep_first(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii_crf.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_order(mixing.mix_sources(docs, max_repeats=MAX_REPEATS), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), in_order=True, part_pieces=STRETCH_PIECES)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("pii", pii),
    ("mixing", mix),
    ("packing", pack),
]

#: SQL can't express the classifier's fit, the message passing or the tokenizer: the tests use brute force
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

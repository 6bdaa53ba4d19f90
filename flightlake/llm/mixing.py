"""Operator 9: mixing sources to target weights by temperature.

Each source's share of the tokens is raised to an exponent and normalised. The
exponent between 0 (equal weights) and 1 (shares as they are) is narrowed down until the
weights have the target entropy, or until no source is repeated more than
`max_repeats` times. The narrowing sums over the sources in Spark, several exponents a
pass, so the number of sources has no bound.

The budget is by default the least that keeps every document (the source that is
used least is used once). A source's budget is realised in passes: whole passes
over all its blocks, then one over the first blocks of a permutation until the rest of
the budget is spent (to the nearest block). A block is a fixed 1/`blocks` of a source by hash,
so one large source is spread over many keys. Every pass has a permutation of its
own; `mix_key` orders the result so that all sources are spread evenly.

A null source is a source of its own; null and empty texts have no token and go
with their block; sources without a token are used once; repeated rows are
mixed each for itself; very long texts count whole; an empty table gives no row; all columns are kept,
but columns of the input under the five names that are added (ADDED) are replaced by those.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.llm import textkit as T
from flightlake.llm.runtime import bounded_batches, stored

#: the plan is copied so many times to join a source that holds much of the rows
SALTS = 32
#: exponents tried in a pass, and passes: the interval shrinks by 17 each time
TRIED, PASSES = 16, 8


def word_count(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text column; null: 0."""
    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        out = np.zeros(len(texts), np.int64)
        for first, buf, off in T.text_blocks(pa.array(texts, pa.large_string(), from_pandas=True)):
            n = len(off) - 1
            out[first:first + n] = np.bincount(T.words(buf, off)[2], minlength=n)
        return pd.Series(out)

    return count(text)


def find_exponent(totals: DataFrame, target_entropy: float | None, max_repeats: float | None) -> float:
    """The largest exponent in [0, 1] whose weights have at least target_entropy (nats),
    or the smallest under which no source is repeated over max_repeats times.

    totals: (tokens) of every source, all positive.
    """
    if target_entropy is None and max_repeats is None:
        return 1.0
    top = totals.agg(F.max("tokens").cast("double").alias("top"), F.min("tokens").cast("double").alias("low")).first()
    if top["top"] is None:
        return 1.0
    share = F.log(F.col("tokens") / F.lit(top["top"]))           # log of the share, up to a constant

    def holds(exponents: list[float]) -> list[bool]:
        if target_entropy is None:
            # repeats against the largest source: (top / tokens)^(1 - exponent), most for the smallest source
            return [(top["top"] / top["low"]) ** (1 - e) <= max_repeats for e in exponents]
        sums = totals.agg(*[f for k, e in enumerate(exponents) for f in (
            F.sum(F.exp(share * e)).alias(f"z{k}"), F.sum(F.exp(share * e) * share).alias(f"m{k}"))]).first()
        return [np.log(sums[f"z{k}"]) - e * sums[f"m{k}"] / sums[f"z{k}"] >= target_entropy for k, e in enumerate(exponents)]

    rising = target_entropy is None          # repeats: holds from some exponent on; entropy: up to some exponent
    low, high = 0.0, 1.0
    at_low, at_high = holds([low, high])
    if rising and at_low:
        return 0.0
    if not rising and (at_high or not at_low):
        return 1.0 if at_high else 0.0
    for _ in range(PASSES):
        grid = [low + (high - low) * k / (TRIED + 1) for k in range(1, TRIED + 1)]
        for e, ok in zip(grid, holds(grid)):
            if ok == rising:
                high = e
                break
            low = e
    return high if rising else low


def permuted(block: Column, turn: Column, blocks: int) -> Column:
    """Place of a block in the permutation of a pass: an affine map modulo a power of two."""
    return F.pmod(block * (F.pmod(F.xxhash64(turn, F.lit("step")), F.lit(blocks)) * 2 + 1) + F.pmod(F.xxhash64(turn, F.lit("shift")), F.lit(blocks)), F.lit(blocks))


def mixing_plan(counted: DataFrame, blocks: int, target_entropy: float | None, max_repeats: float | None,
                budget_tokens: float | None) -> DataFrame:
    """One row a source: weight, whole passes, and how many blocks of a further pass.

    counted: (mix_source, mix_block, tokens) summed by source and block.
    """
    totals = stored(counted.groupBy("mix_source").agg(F.sum("tokens").alias("tokens")), "mix-totals")
    positive = totals.where("tokens > 0")
    exponent = find_exponent(positive, target_entropy, max_repeats)
    power = F.pow(F.col("tokens").cast("double"), F.lit(exponent))
    norm = positive.agg(F.sum(power).alias("z"), F.max("tokens").cast("double").alias("top")).first()
    z, top = norm["z"] or 1.0, norm["top"] or 1.0
    budget = budget_tokens if budget_tokens is not None else top / (top ** exponent / z)
    weighted = (totals.withColumn("weight", F.when(F.col("tokens") > 0, power / F.lit(z)).otherwise(0.0))
                .withColumn("use", F.when(F.col("tokens") > 0, F.round(F.col("weight") * F.lit(float(budget)) / F.col("tokens"), 9)).otherwise(1.0))
                .withColumn("passes", F.floor("use").cast("int"))
                .withColumn("rest", (F.col("use") - F.col("passes")) * F.col("tokens")))
    # blocks of the last, partial pass in the order of its permutation; at most `blocks` rows a source
    place = permuted(F.col("mix_block"), F.col("passes"), blocks)
    order = Window.partitionBy("mix_source").orderBy("place")
    spent = (counted.alias("c").join(weighted.alias("w"), F.expr("c.mix_source <=> w.mix_source"))
             .select("c.mix_source", place.alias("place"), F.col("c.tokens").alias("in_block"), "rest")
             .withColumn("before", F.sum("in_block").over(order) - F.col("in_block"))
             .where((F.col("rest") > 0) & (F.col("before") + F.col("in_block") / 2 <= F.col("rest")))
             .groupBy("mix_source").agg((F.max("place") + 1).cast("int").alias("extra")))
    return (weighted.alias("w").join(spent.alias("s"), F.expr("w.mix_source <=> s.mix_source"), "left")
            .select("w.mix_source", "weight", "use", "passes", F.coalesce("extra", F.lit(0)).alias("extra")))


ADDED = ("mix_source", "mix_block", "mix_tokens", "mix_pass", "mix_key")


def mix_sources(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text",
                target_entropy: float | None = None, max_repeats: float | None = None,
                budget_tokens: float | None = None, blocks: int = 1024) -> DataFrame:
    """docs, each row once a pass that uses it, with mix_source, mix_block, mix_tokens, mix_pass, mix_key."""
    bounded_batches(docs.sparkSession)
    block = F.pmod(F.xxhash64(F.col(id_col), F.lit("block")), F.lit(blocks)).cast("int")
    kept = [c for c in docs.columns if c not in ADDED]
    # the row travels as one value, so its columns can't clash with the plan's
    row = F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.struct(F.lit(0).alias("none"))
    marked = docs.select(row.alias("row"), F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("mix_source"),
                         block.alias("mix_block"), word_count(F.col(text_col)).alias("mix_tokens"))
    counted = stored(marked.groupBy("mix_source", "mix_block").agg(F.sum("mix_tokens").alias("tokens")), "mix-blocks")
    plan = stored(mixing_plan(counted, blocks, target_entropy, max_repeats, budget_tokens), "mix-plan")
    copies = plan.select(F.col("mix_source").alias("plan_source"), "passes", "extra", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    joined = marked.join(copies, marked["mix_source"].eqNullSafe(copies["plan_source"]) & (F.pmod(F.xxhash64("id", F.lit("salt")), F.lit(SALTS)) == copies["salt"]))
    in_extra = permuted(F.col("mix_block"), F.col("passes"), blocks) < F.col("extra")
    last = F.col("passes") - 1 + in_extra.cast("int")
    used = joined.where(last >= 0).withColumn("mix_pass", F.explode(F.sequence(F.lit(0), last)))
    # where in the source's whole run the block stands, from 0 to 1, then a place of the row's own in the block
    share = (F.col("mix_pass") * blocks + permuted(F.col("mix_block"), F.col("mix_pass"), blocks) + F.pmod(F.xxhash64("id", F.col("mix_pass")), F.lit(1 << 20)) / F.lit(1 << 20))
    key = share / (F.col("passes") * blocks + F.col("extra"))
    return used.withColumn("mix_key", key.cast("double")).select(*[F.col("row").getField(c).alias(c) for c in kept], *ADDED)


def mixed_order(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mixture dealt and sorted by its key: each file is a stretch of the training order."""
    return mixed.repartitionByRange("mix_key").sortWithinPartitions("mix_key").select(*columns)

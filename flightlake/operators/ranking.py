"""Sorts, limits, top-k and per-group ranking (W1, O1-O4).

Every "first row" has a total order: the measure, then key columns, so
results do not depend on partitioning (ties were arbitrary in the original).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.operators.clean import filter_rank


def _order(desc_col: str, tie_breakers: list[str] | None) -> list[Column]:
    return [F.col(desc_col).desc()] + [F.col(c).asc() for c in (tie_breakers or [])]


# O1 / F16
def order_by_desc(df: DataFrame, column: str, tie_breakers: list[str] | None = None) -> DataFrame:
    """Full sort, descending (nulls last): range exchange + sort."""
    return df.orderBy(*_order(column, tie_breakers))


# O2 / O3: TakeOrderedAndProject (per-partition top-k, then a merge of k rows each)
def top_n(df: DataFrame, n: int, column: str, tie_breakers: list[str] | None = None) -> DataFrame:
    return df.orderBy(*_order(column, tie_breakers)).limit(n)


def top1_row(df: DataFrame, column: str, tie_breakers: list[str] | None = None) -> DataFrame:
    return top_n(df, 1, column, tie_breakers)


# top 1 per group (R2b)
def top1_per_group(df: DataFrame, group: list[str], column: str,
                   tie_breakers: list[str] | None = None) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*_order(column, tie_breakers))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


# W1 + C12: dense rank within a group, keep rank <= n (ties all kept).
def dense_rank_top_n(df: DataFrame, group: list[str], column: str, n: int,
                     rank_col: str = "model_rank") -> DataFrame:
    """Planned as WindowGroupLimit (partial, before the shuffle) + Window."""
    w = Window.partitionBy(*group).orderBy(F.col(column).desc())
    return filter_rank(df.withColumn(rank_col, F.dense_rank().over(w)), rank_col, n)

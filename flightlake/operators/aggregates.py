"""Aggregations (A1-A6). All are hash aggregates with a map-side partial
step, so a hot key is combined before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.functions.numeric import rounded_avg


# A1
def count_star_by_key(df: DataFrame, keys: list[str] | str, alias: str = "flight_count") -> DataFrame:
    keys = [keys] if isinstance(keys, str) else keys
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


# A2
def mean_by_key(df: DataFrame, key: str, value: str, alias: str, digits: int | None = None) -> DataFrame:
    """Mean per key as double. With ``digits`` (integral values only) the mean
    is exact and rounded once (functions.numeric.rounded_avg)."""
    agg = F.avg(F.col(value)) if digits is None else rounded_avg(value, digits)
    return df.groupBy(key).agg(agg.alias(alias))


# A3
def grouped_count(df: DataFrame, key: str) -> DataFrame:
    """``groupBy(key).count()``: the count column is named ``count``."""
    return df.groupBy(key).count()


# A4
def count_col_by_keys(df: DataFrame, keys: list[str], column: str, alias: str) -> DataFrame:
    """Non-null count of ``column`` per key tuple."""
    return df.groupBy(*keys).agg(F.count(F.col(column)).alias(alias))


# A5
def count_dict_form(df: DataFrame, key: str, alias: str) -> DataFrame:
    """Dictionary aggregate ``{"*": "count"}``; its generated column ``count(1)``
    is renamed to ``alias``."""
    out = df.groupBy(key).agg({"*": "count"})
    generated = [c for c in out.columns if c != key][0]
    return out.withColumnRenamed(generated, alias)


# A6 = C1 (operators.clean.drop_duplicates)

"""Cleaning operators (C1-C12) and the per-table cleaning phase.

Filters are placed before the null fill: a fill turns a column into
``coalesce(...)`` which blocks Parquet predicate pushdown of later filters.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType, FloatType, IntegerType, LongType, StringType, StructType,
)


# C1 / A6
def drop_duplicates(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Whole-row distinct (or on ``subset``); map-side partial dedup, one shuffle."""
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


# C2 / F1
def lowercase_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.lower(F.col(c)) for c in columns})


def type_defaults(schema: StructType) -> dict[str, object]:
    """Fill value per column: 0.0 for float/double, '' for string, 0 for int/long.
    Columns of other types are left alone."""
    out: dict[str, object] = {}
    for field in schema.fields:
        t = field.dataType
        if isinstance(t, (DoubleType, FloatType)):
            out[field.name] = 0.0
        elif isinstance(t, StringType):
            out[field.name] = ""
        elif isinstance(t, (IntegerType, LongType)):
            out[field.name] = 0
    return out


# C3 / F9
def fill_nulls_by_type(df: DataFrame) -> DataFrame:
    """One projection replacing nulls by the type default of each column."""
    defaults = type_defaults(df.schema)
    return df.na.fill(defaults) if defaults else df


# C4
def fill_nulls_subset(df: DataFrame, subset: list[str], value: object = "") -> DataFrame:
    return df.na.fill(value, subset=subset)


def valid_flight_condition() -> Column:
    """C5 as it behaves: an airline and an origin code that are not '' (null
    fails the comparison too), a departure time, and a model that is not null.
    The written form ``model IS NOT NULL OR model != ''`` reduces to the
    not-null test (an empty model passes)."""
    return (
        (F.col("airline_icao") != "")
        & F.col("departure_time").isNotNull()
        & F.col("aircraft_model").isNotNull()
        & (F.col("origin_airport_iata") != "")
    )


# C5
def filter_valid_flights(df: DataFrame) -> DataFrame:
    return df.where(valid_flight_condition())


# C6
def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


# C8 / F5
def cast_distance(df: DataFrame, column: str = "actual_distance") -> DataFrame:
    """Float km to int, truncating toward zero; out-of-range values become null
    instead of failing the job (ANSI casts raise on overflow)."""
    return df.withColumn(column, F.col(column).try_cast("int"))


# C9
def select_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns)


# C10 / F8
def where_sql(df: DataFrame, predicate: str) -> DataFrame:
    """SQL-string predicate; it may name columns that a later select drops."""
    return df.where(predicate)


# C11 / F7
def filter_not_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    cond = None
    for c in columns:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df if cond is None else df.where(cond)


# C12
def filter_rank(df: DataFrame, rank_column: str, max_rank: int) -> DataFrame:
    return df.where(F.col(rank_column) <= max_rank)


# --- cleaning phase, one function per landed table ---------------------------

def clean_airlines(df: DataFrame) -> DataFrame:
    return fill_nulls_subset(lowercase_columns(drop_duplicates(df), ["Name"]), ["Code"], "")


def clean_znctyn(df: DataFrame) -> DataFrame:
    return fill_nulls_by_type(lowercase_columns(drop_duplicates(df), ["zone_country"]))


def clean_airport(df: DataFrame) -> DataFrame:
    return fill_nulls_by_type(lowercase_columns(drop_duplicates(df), ["country", "name"]))


def clean_flight(df: DataFrame) -> DataFrame:
    """Dedup, keep valid flights, rename departure_time, lower the model, fill.
    The reference's extra column ``aircraft_model|`` (a typo nobody reads) is not made."""
    df = filter_valid_flights(drop_duplicates(df))
    df = rename_columns(df, {"departure_time": "departure_origin"})
    return fill_nulls_by_type(lowercase_columns(df, ["aircraft_model"]))


def clean_acflight(df: DataFrame) -> DataFrame:
    df = lowercase_columns(drop_duplicates(df), ["aircraft_model"])
    df = rename_columns(df, {"departure_time": "departure_origin"})
    return fill_nulls_by_type(df)


def clean_flctry(df: DataFrame) -> DataFrame:
    """Dedup and lower-case the country (the reports compare it with the
    lower-cased airport country)."""
    return lowercase_columns(drop_duplicates(df), ["country"])

"""S3: a small driver-side collection as a DataFrame (lookup rows only; bulk
data enters through the landed-JSON source)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def rows_to_df(spark: SparkSession, rows: Iterable, schema: StructType) -> DataFrame:
    return spark.createDataFrame(list(rows), schema=schema)

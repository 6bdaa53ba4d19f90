"""Parquet scans (S1) and latest-snapshot selection (S2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flightlake.sinks.manifests import TRY_COLUMN, Store, folder_of, records, runs_newest_first
from flightlake.sinks.snapshots import committed_tries, label_of, snapshot_read_schema


def check_columns(df: DataFrame, expected: StructType | list[str]) -> DataFrame:
    names = expected.fieldNames() if isinstance(expected, StructType) else list(expected)
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    return df


# S1
def read_table(spark: SparkSession, path: str, schema: StructType | None = None,
               strict: bool = False) -> DataFrame:
    """Parquet scan. With a schema the footer schema is not inferred (no extra
    job) and a column missing from the files reads as null; ``strict`` reads
    the footer and fails on a missing column instead. Projections and filters
    on the result reach the scan (ReadSchema / PushedFilters)."""
    if schema is None:
        return spark.read.parquet(path)
    if strict:
        check_columns(spark.read.parquet(path), schema)
    return spark.read.schema(schema).parquet(path)


def _open(spark: SparkSession, root: str, files: list[str], schema: StructType | None) -> DataFrame:
    """Data files of a dataset, with the partition columns of their folders; no folder is listed."""
    if schema is None:
        if not files:
            raise ValueError(f"no snapshot in {root}, and no schema for an empty one")
        schema = spark.read.option("basePath", root).parquet(files[0]).schema
    schema = snapshot_read_schema(schema)
    df = spark.read.schema(schema).option("basePath", root).parquet(*files) if files else spark.createDataFrame([], schema)
    return df.drop(TRY_COLUMN)


def _files(folder: str, record: dict) -> list[str]:
    return [f"{folder}/{TRY_COLUMN}={record['try']}/{name}" for name, _ in record["files"]]


def read_snapshots(spark: SparkSession, root: str, schema: StructType | None = None) -> DataFrame:
    """All snapshots of one dataset written by sinks.snapshots, each by the try that holds: data columns, snapshot_ts and the
    partition columns, always as text (without a schema, the files' own is read from a footer)."""
    root = root.rstrip("/")
    store = Store(spark, root)
    held = ((folder, records(store, folder)[-1:]) for _, folder in runs_newest_first(store, root))
    return _open(spark, root, [f for folder, last in held for r in last for f in _files(folder, r)], schema)


def snapshot_runs(spark: SparkSession, root: str) -> list[str]:
    """Names of a dataset's runs in time order (this lists them all; the newest is found without)."""
    return sorted(label for label, _ in runs_newest_first(Store(spark, root), root))


def committed_run(spark: SparkSession, lake: str, datasets: list[str], as_of: str | None = None) -> str | None:
    """The newest run (at or before ``as_of``) that was recorded with all of datasets; None if there is none."""
    found = committed_tries(spark, lake, datasets, as_of)
    return found[0] if found else None


# S2
def read_latest_snapshot(spark: SparkSession, root: str, schema: StructType | None = None,
                         as_of: str | None = None, run: str | None = None, try_id: str | None = None) -> DataFrame:
    """Rows of one run of a dataset: ``run``, or the newest (at or before ``as_of``) that was written whole.

    The run is found by going down the newest folders, and its record names the files of the try
    that holds (or of ``try_id``): those are opened, and neither files nor folders of other runs are listed. The run is also a
    literal partition filter.
    """
    root = root.rstrip("/")
    store = Store(spark, root)
    found = [(run, f"{root}/{folder_of(run)}")] if run else runs_newest_first(store, root, label_of(spark, as_of) if as_of else None)
    for label, folder in found:
        held = [r for r in records(store, folder) if try_id in (None, r["try"])]
        if held:
            return _open(spark, root, _files(folder, held[-1]), schema).where(F.col("run") == F.lit(label))
    return _open(spark, root, [], schema)


def latest_snapshot(df: DataFrame, ts_col: str = "snapshot_ts", as_of: str | None = None) -> DataFrame:
    """Rows of the most recent snapshot of a table that carries its snapshot time as data (max of the
    time, not the last file in a directory walk); ``as_of``: the newest at or before that time.
    For datasets on disk, read_latest_snapshot finds the run without reading data."""
    if as_of is not None:
        df = df.where(F.col(ts_col) <= F.lit(as_of).cast("timestamp"))
    return df.where(F.col(ts_col) == df.select(F.max(ts_col)).scalar())

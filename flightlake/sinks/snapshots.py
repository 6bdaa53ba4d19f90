"""K1 + K3: write one extraction run as a snapshot of a dataset.

Layout: ``<root>/tech_year=2024/tech_month=2024-01/tech_day=2024-01-26/tech_hour=18/run=20240126T180500000000/try=<id>/part-*``
with the run time in data column ``snapshot_ts``. Tasks write in parallel, nothing is coalesced to one file, and
Spark's committer moves the files into the try's folder. Then the run's record switches to
that try (sinks.manifests): a re-run of a run time writes a try of its own beside the one that
readers use, which holds until the new one is whole. Tries that no longer hold stay for readers that opened
them and are removed by remove_old_tries.

A run that wrote all its datasets is recorded by commit_run in ``<lake>/_runs`` with the try of each; a reader that takes
the newest recorded run never mixes runs or tries, whatever a failed run left behind.
"""

from __future__ import annotations

import uuid
from collections import defaultdict

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from flightlake.functions.time import layout_columns, run_label, utc_wall_clock
from flightlake.sinks.manifests import PARTITION_COLUMNS, TRY_COLUMN, Store, commit, folder_of, records, runs_newest_first

RUNS_FOLDER = "_runs"


def add_layout_columns(df: DataFrame, ts: Column | str = "snapshot_ts") -> DataFrame:
    """Partition values from the run time, as UTC wall clock (the same labels
    whatever the session time zone of the writer)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    cols = layout_columns(utc_wall_clock(ts)) | {"run": run_label(ts)}
    return df.withColumns({c: cols[c] for c in PARTITION_COLUMNS})


def snapshot_read_schema(schema: StructType) -> StructType:
    """schema with the run time and the partition columns, which are text whatever they look like."""
    own = [f for f in schema.fields if f.name not in ("snapshot_ts", *PARTITION_COLUMNS, TRY_COLUMN)]
    extra = [StructField("snapshot_ts", TimestampType(), True)]
    extra += [StructField(c, StringType(), True) for c in [*PARTITION_COLUMNS, TRY_COLUMN]]
    return StructType(own + extra)


def _timestamp(run_ts: Column | str | None) -> Column:
    ts = F.current_timestamp() if run_ts is None else F.lit(run_ts) if isinstance(run_ts, str) else run_ts
    return ts.cast("timestamp")


def label_of(spark: SparkSession, run_ts: Column | str | None) -> str:
    """The run name of one time, read in the session's time zone."""
    return spark.range(1).select(run_label(_timestamp(run_ts))).first()[0]


def write_parquet_snapshot(df: DataFrame, root: str, run_ts: Column | str | None = None) -> str:
    """Write ``df`` as the snapshot taken at ``run_ts`` (default: now; a column of df: one snapshot for each value),
    and make it the one that holds for its run. Gives the id of the try."""
    spark, store = df.sparkSession, Store(df.sparkSession, root)
    if run_ts is None:
        run_ts = F.lit(spark.range(1).select(F.current_timestamp().cast("string")).first()[0])
    try_id, seen = uuid.uuid4().hex, Observation()
    out = add_layout_columns(df.withColumn("snapshot_ts", _timestamp(run_ts))).withColumn(TRY_COLUMN, F.lit(try_id))
    # the runs' names come with the write itself: one or, for a column, its distinct times
    (out.observe(seen, F.collect_set("run").alias("runs")).write.partitionBy(*PARTITION_COLUMNS, TRY_COLUMN)
     .mode("append").parquet(root))
    labels = list(seen.get["runs"])
    if not labels:
        try:
            labels = [label_of(spark, run_ts)]      # an empty snapshot is one too, if its time is known without a row
        except AnalysisException:
            labels = []
    for label in labels:
        folder = f"{root.rstrip('/')}/{folder_of(label)}"
        files = [[n, size] for n, size in store.names(f"{folder}/{TRY_COLUMN}={try_id}") if not n.startswith(("_", "."))]
        commit(store, folder, try_id, {"run": label, "files": sorted(files)})
    return try_id


def remove_old_tries(spark: SparkSession, root: str, run: str) -> list[str]:
    """Deletes the files of a run's tries that don't hold (superseded or failed ones); gives their ids."""
    store, folder = Store(spark, root), f"{root.rstrip('/')}/{folder_of(run)}"
    held = [r["try"] for r in records(store, folder)][-1:]
    old = [n.partition("=")[2] for n, _ in store.names(folder) if n.startswith(f"{TRY_COLUMN}=")]
    for try_id in sorted(set(old) - set(held)):
        store.delete(f"{folder}/{TRY_COLUMN}={try_id}")
    return sorted(set(old) - set(held))


def commit_run(spark: SparkSession, lake: str, run_ts: Column | str, datasets: list[str] | dict[str, str | None]) -> None:
    """Record that the run's datasets are all written, by which try each (again for a re-run: the newer record holds)."""
    root = f"{lake.rstrip('/')}/{RUNS_FOLDER}"
    label = label_of(spark, run_ts)
    tries = datasets if isinstance(datasets, dict) else {d: None for d in datasets}
    commit(Store(spark, root), f"{root}/{folder_of(label)}", uuid.uuid4().hex, {"run": label, "tries": tries})


def committed_tries(spark: SparkSession, lake: str, datasets: list[str], as_of: str | None = None) -> tuple[str, dict] | None:
    """(run, try of each dataset) of the newest run (at or before ``as_of``) that was recorded with all of datasets."""
    root = f"{lake.rstrip('/')}/{RUNS_FOLDER}"
    store = Store(spark, root)
    for label, folder in runs_newest_first(store, root, label_of(spark, as_of) if as_of else None):
        for record in reversed(records(store, folder)):
            if set(datasets) <= set(record["tries"]):
                return label, defaultdict(lambda: None, record["tries"])
    return None

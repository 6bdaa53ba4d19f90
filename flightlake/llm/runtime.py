"""What the operators share: table reads, bounded Arrow batches, tables in the shared folder."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, whose workers import its functions (once an application)."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="flightlake-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(archive))      # Spark's own file server hands it out
    _shipped.add(sc.applicationId)


def bounded_batches(spark: SparkSession, rows: int = 256) -> None:
    """Readies a session for the operators' Python tasks: the package is sent, and workers
    get few texts at a time, so a batch of long documents stays small.

    The batch size is read when a plan runs, so it stays set in the session.
    """
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns the operators read, under names of their own (other columns can't clash)."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """df written once below spark.checkpoint.dir and read back: later steps neither
    recompute it nor depend on an executor that made it."""
    return stored_at(df, name, codec)[0]


def stored_at(df: DataFrame, name: str, codec: str = "zstd") -> tuple[DataFrame, str]:
    """stored(), and the folder: a step that has written all that was read from it gives it to remove_scratch()."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def parts_for(spark: SparkSession, n: int, per_part: int, least: int = 1) -> int:
    """Partitions so that each holds about per_part of n."""
    return max(least, -(-n // per_part))

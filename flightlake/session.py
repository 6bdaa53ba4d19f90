"""Session construction and the shared scratch folder.

The library never picks a master: on a cluster the submitter does. The
settings below turn on adaptive execution (runtime broadcast decisions,
partition coalescing and skew-join splitting), which every operator relies
on for joins whose side sizes are only known at run time.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


# Suggested sizes for a 100 TB run on about 1,000 executors x 8 cores (pass as
# ``extra`` or on spark-submit). They follow from the input: scan splits of 1 GB
# give 100,000 map tasks, about 12 waves on 8,000 cores; after column pruning a
# tenth of the input is shuffled, and 10 TB over 20,000 reduce partitions is 512 MB
# each, which spills in a core's share of memory but stays one sort. Shuffle blocks are
# map tasks times reduce partitions, 2 * 10^9 of about 5 KB here: both numbers should grow
# with the root of the input, not with the input. Dimension tables (airlines,
# airports, zones, country points) stay well under the 64 MB broadcast limit, fact
# tables never qualify.
CLUSTER_PROFILE_100TB = {
    "spark.sql.files.maxPartitionBytes": "1g",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def get_spark(app_name: str = "flightlake", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Read from the session. Only a local-mode session without it (tests, a
    laptop) gets a fresh temporary folder; on a cluster a machine-local folder
    would not be visible to other executors, so an unset value is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    local = tempfile.mkdtemp(prefix="flightlake-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared folder."""
    base = shared_dir(spark)
    sep = "" if base.endswith("/") else "/"
    return f"{base}{sep}flightlake-{name}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Deletes a scratch path below the shared folder once nothing reads it any more."""
    if not path.startswith(shared_dir(spark)):
        raise ValueError(f"{path} is not below the shared folder")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)

"""S4: landed API documents, one JSON document per line.

The HTTP client of the original is not rebuilt; whatever fetches the API
lands raw JSON lines in a folder, and this reader turns them into typed
DataFrames. Lines are scanned as text and parsed with ``from_json`` (the
same parser as the JSON source), in PERMISSIVE mode: a malformed line keeps
its raw text in ``_corrupt_record`` and can be split off with
operators.ingest.split_bad_records, whatever columns a later query reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flightlake import schemas


POSITION = "landed_position"


def _lines(spark: SparkSession, path: str, with_position: bool) -> DataFrame:
    lines = spark.read.text(path)
    if with_position:
        # landing order: file path, then a row id that grows with the line
        # offset inside the file (splits of one file keep their order)
        lines = lines.withColumn(POSITION, F.struct(F.col("_metadata.file_path").alias("file"),
                                                    F.monotonically_increasing_id().alias("row")))
    return lines.where(F.trim(F.col("value")) != "")


def read_landed_json(spark: SparkSession, path: str, schema: StructType,
                     keep_corrupt: bool = True, with_position: bool = False) -> DataFrame:
    """Typed documents; ``with_position`` adds ``landed_position`` (file, row)
    for operators whose result depends on the order the API listed items."""
    if not keep_corrupt and not with_position:
        return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT_COLUMN}
    lines = _lines(spark, path, with_position)
    parsed_schema = schemas.with_corrupt_column(schema) if keep_corrupt else schema
    cols = [F.from_json("value", parsed_schema, opts).alias("_j")] + ([F.col(POSITION)] if with_position else [])
    return lines.select(*cols).select("_j.*", *([POSITION] if with_position else []))


def read_json_text(spark: SparkSession, path: str, with_position: bool = False) -> DataFrame:
    """Raw lines (column ``value``) for documents parsed with from_json, such
    as the zones map whose keys are data."""
    return _lines(spark, path, with_position)


def landing_rank(df: DataFrame, position: str = POSITION, alias: str = "landed_rank") -> DataFrame:
    """df with its landed position as one long that keeps the order: first by file path, then by line.

    A dictionary of the splits (file, and the rows that one task read of it) holds how many rows stand before
    each; it is joined once. It has a row a split, so its running sum is one small window.
    df is read twice: stage it."""
    file, row = F.col(f"{position}.file"), F.col(f"{position}.row")
    split = F.shiftright(row, 33)
    splits = df.groupBy(file.alias("_file"), split.alias("_split")).agg(F.min(row).alias("_first"), F.max(row).alias("_last"))
    size = F.col("_last") - F.col("_first") + 1
    before = F.sum(size).over(Window.orderBy("_file", "_first").rowsBetween(Window.unboundedPreceding, 0)) - size
    numbered = splits.select("_file", "_split", "_first", before.alias("_before"))
    rank = (F.col("_before") + row - F.col("_first")).cast("long")
    return df.join(numbered, (file == F.col("_file")) & (split == F.col("_split"))).select(*df.columns, rank.alias(alias))


def newest_per_key(df: DataFrame, key: str, position: str = POSITION) -> DataFrame:
    """The last landed row of each key. Rows without a key can't be told apart and all stay."""
    last = F.row_number().over(Window.partitionBy(key).orderBy(F.col(position).desc()))
    keyed = df.where(F.col(key).isNotNull()).withColumn("_nth", last).where(F.col("_nth") == 1).drop("_nth")
    return keyed.unionByName(df.where(F.col(key).isNull()))


def stitch_details(flights: DataFrame, details: DataFrame, key: str = "id", position: str = POSITION) -> DataFrame:
    """Flight list entries with the details documents that landed apart from them, in whatever files and order:
    of each the newest for a flight. Both are shuffled once, by the flight, for the choice and the join.

    A flight whose details did not land keeps null (or those in its own line); details of no listed flight are left out."""
    found = newest_per_key(details.where(F.col(key).isNotNull()), key, position).select(F.col(key).alias("_id"), F.col("details").alias("_details"))
    listed = newest_per_key(flights, key, position)
    joined = listed.join(found, listed[key] == found["_id"], "left")
    return joined.withColumn("details", F.coalesce("_details", "details")).select(*[c for c in flights.columns if c != position])

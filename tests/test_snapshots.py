import contextlib
import io
import os

from pyspark.sql import functions as F

from flightlake import schemas
from flightlake.sinks.results import write_csv_result
from flightlake.sinks.snapshots import write_parquet_snapshot
from flightlake.sources.parquet import latest_snapshot, read_latest_snapshot, read_snapshots, snapshot_runs
from flightlake.session import scratch_path, shared_dir


def _airlines(spark, tag):
    return spark.createDataFrame([(f"{tag}-a", "1", "A"), (f"{tag}-b", "2", "B")], schemas.AIRLINES)


def test_round_trip_and_layout(spark, tmp_out):
    root = f"{tmp_out}/airlines"
    write_parquet_snapshot(_airlines(spark, "jan"), root, "2024-01-26 18:05:00")
    parts = sorted(p for p in os.listdir(root) if p.startswith("tech_"))
    assert parts == ["tech_year=2024"]
    assert os.path.isdir(f"{root}/tech_year=2024/tech_month=2024-01/tech_day=2024-01-26/tech_hour=18/run=20240126T180500000000")
    back = read_snapshots(spark, root, schemas.AIRLINES)
    assert sorted(r.Name for r in back.collect()) == ["jan-a", "jan-b"]


def test_latest_is_time_order_not_name_order(spark, tmp_out):
    # T1: 'February-2024' < 'January-2024' by name; the latest must be January 2025 vs earlier runs
    root = f"{tmp_out}/airlines"
    write_parquet_snapshot(_airlines(spark, "jan25"), root, "2025-01-03 09:00:00")
    write_parquet_snapshot(_airlines(spark, "feb24"), root, "2024-02-10 09:00:00")
    got = read_latest_snapshot(spark, root, schemas.AIRLINES)
    assert sorted(r.Name for r in got.collect()) == ["jan25-a", "jan25-b"]


def test_two_runs_same_hour_keep_both_files_latest_wins(spark, tmp_out):
    # T2: a rerun within the hour must neither lose data nor mix runs
    root = f"{tmp_out}/airlines"
    write_parquet_snapshot(_airlines(spark, "run1"), root, "2024-03-01 10:05:00")
    write_parquet_snapshot(_airlines(spark, "run2"), root, "2024-03-01 10:45:00")
    allrows = read_snapshots(spark, root, schemas.AIRLINES)
    assert allrows.count() == 4
    assert sorted(r.Name for r in read_latest_snapshot(spark, root, schemas.AIRLINES).collect()) == ["run2-a", "run2-b"]


def test_latest_snapshot_prunes_partitions(spark, tmp_out):
    root = f"{tmp_out}/airlines"
    write_parquet_snapshot(_airlines(spark, "a"), root, "2024-03-01 10:05:00")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        read_latest_snapshot(spark, root, schemas.AIRLINES).explain("formatted")
    text = buf.getvalue()
    assert "run#" in text and "= 20240301T100500000000)" in text.split("PartitionFilters")[1].splitlines()[0]
    assert text.count("Scan parquet") == 1 or text.count("Scan parquet") == 2      # node and detail of one scan; no lookup scan


def test_rerun_replaces_its_content(spark, tmp_out):
    root = f"{tmp_out}/airlines"
    write_parquet_snapshot(_airlines(spark, "first"), root, "2024-03-01 10:05:00")
    write_parquet_snapshot(_airlines(spark, "again"), root, "2024-03-01 10:05:00")
    assert sorted(r.Name for r in read_snapshots(spark, root, schemas.AIRLINES).collect()) == ["again-a", "again-b"]


def test_hours_sort_as_text_without_a_schema(spark, tmp_out):
    root = f"{tmp_out}/airlines"
    for hour in ("09", "18"):
        write_parquet_snapshot(_airlines(spark, hour), root, f"2024-03-01 {hour}:00:00")
    assert dict(read_snapshots(spark, root).dtypes)["tech_hour"] == "string"
    assert [r[-21:-12] for r in snapshot_runs(spark, root)] == ["20240301T", "20240301T"]
    assert sorted(r.Name for r in read_latest_snapshot(spark, root).collect()) == ["18-a", "18-b"]
    assert sorted(r.Name for r in latest_snapshot(read_snapshots(spark, root)).collect()) == ["18-a", "18-b"]


def test_empty_and_missing_datasets(spark, tmp_out):
    root = f"{tmp_out}/airlines"
    write_parquet_snapshot(_airlines(spark, "x").where("false"), root, "2024-03-01 10:05:00")
    assert read_latest_snapshot(spark, root, schemas.AIRLINES).count() == 0


def test_csv_result_no_header_keeps_order(spark, tmp_out):
    df = spark.createDataFrame([("b", 5), ("a", 9), ("", 1), (None, 0)], "Name string, flight_count long")
    path = f"{tmp_out}/r1"
    write_csv_result(df.orderBy(F.col("flight_count").desc()), path, bounded=True)
    files = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert len(files) == 1
    lines = open(f"{path}/{files[0]}").read().splitlines()
    assert lines == ["a,9", "b,5", '"",1', ",0"]


def test_scratch_under_shared_dir(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    assert spark.sparkContext.getCheckpointDir() is not None


def test_as_of_aligns_snapshots(spark, tmp_out):
    # T12: read every dataset at one point in time
    root = f"{tmp_out}/airlines"
    write_parquet_snapshot(_airlines(spark, "early"), root, "2024-03-01 08:00:00")
    write_parquet_snapshot(_airlines(spark, "mid"), root, "2024-03-01 10:15:00")
    write_parquet_snapshot(_airlines(spark, "late"), root, "2024-03-01 12:00:00")
    snaps = read_snapshots(spark, root, schemas.AIRLINES)
    got = read_latest_snapshot(spark, root, schemas.AIRLINES, as_of="2024-03-01 10:30:00")
    assert sorted(r.Name for r in got.collect()) == ["mid-a", "mid-b"]
    got = latest_snapshot(snaps, as_of="2024-03-01 10:30:00")
    assert sorted(r.Name for r in got.collect()) == ["mid-a", "mid-b"]
    got = latest_snapshot(snaps, as_of="2024-03-01 10:00:00")
    assert sorted(r.Name for r in got.collect()) == ["early-a", "early-b"]


def test_labels_and_latest_independent_of_session_zone(spark, tmp_out):
    root = f"{tmp_out}/airlines"
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        write_parquet_snapshot(_airlines(spark, "utc"), root, "2024-03-01 10:05:00")        # 10:05 UTC
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        write_parquet_snapshot(_airlines(spark, "ny"), root, "2024-03-01 06:30:00")          # 11:30 UTC
        assert os.path.isdir(f"{root}/tech_year=2024/tech_month=2024-03/tech_day=2024-03-01/tech_hour=11")
        assert sorted(r.Name for r in read_latest_snapshot(spark, root, schemas.AIRLINES).collect()) == ["ny-a", "ny-b"]
        got = read_latest_snapshot(spark, root, schemas.AIRLINES, as_of="2024-03-01 06:00:00")                            # 11:00 UTC
        assert sorted(r.Name for r in got.collect()) == ["utc-a", "utc-b"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


class CountedStore:
    """Counts what a reader lists."""

    def __init__(self, monkeypatch):
        from flightlake.sinks import manifests
        self.listed = []
        names = manifests.Store.names

        def counted(store, folder):
            found = names(store, folder)
            self.listed += [n for n, _ in found]
            return found

        monkeypatch.setattr(manifests.Store, "names", counted)


def test_newest_run_is_found_without_the_history(spark, tmp_out, monkeypatch):
    """S2: with 3 and with 300 runs of two files, a reader lists about as many names and opens as many files."""
    seen = {}
    for n in (3, 300):
        root = f"{tmp_out}/runs{n}"
        df = spark.range(2 * n).selectExpr("id", f"timestamp '2024-01-01 00:00:00' + make_dt_interval(0, int(id % {n})) as t")
        write_parquet_snapshot(df.repartition(2, "id"), root, F.col("t"))
        counted = CountedStore(monkeypatch)
        got = read_latest_snapshot(spark, root, df.select("id").schema)
        seen[n] = (len(counted.listed), len(got.inputFiles()))
        monkeypatch.undo()
        assert sorted(r.id for r in got.collect()) == [n - 1, 2 * n - 1]
        assert len(snapshot_runs(spark, root)) == n
        middle = read_latest_snapshot(spark, root, df.select("id").schema, as_of="2024-01-01 01:30:00")
        assert {r.id % n for r in middle.collect()} == {1}
    assert seen[300][0] <= seen[3][0] + 60 and seen[300][1] <= 2        # 13 days and 24 hours at most


def test_runs_at_or_before_a_time_cross_folders(spark, tmp_out):
    root = f"{tmp_out}/airlines"
    for ts in ("2023-12-31 23:00:00", "2024-03-01 10:05:00", "2025-01-01 00:00:00"):
        write_parquet_snapshot(_airlines(spark, ts[:4]), root, ts)
    for as_of, tag in (("2024-01-15 00:00:00", "2023"), ("2024-03-01 10:05:00", "2024"), ("2024-12-31 00:00:00", "2024"), ("2030-01-01 00:00:00", "2025")):
        assert {r.Name[:4] for r in read_latest_snapshot(spark, root, schemas.AIRLINES, as_of=as_of).collect()} == {tag}
    assert read_latest_snapshot(spark, root, schemas.AIRLINES, as_of="2023-01-01 00:00:00").count() == 0


def test_readers_see_one_whole_try(spark, tmp_out):
    """K1: a reader that opened a run before its re-run reads what it opened; a later one reads the new try whole."""
    from flightlake.sinks.snapshots import remove_old_tries
    root, ts = f"{tmp_out}/airlines", "2024-03-01 10:05:00"
    first = write_parquet_snapshot(_airlines(spark, "first"), root, ts)
    opened = read_latest_snapshot(spark, root, schemas.AIRLINES)
    again = write_parquet_snapshot(_airlines(spark, "again"), root, ts)
    assert sorted(r.Name for r in opened.collect()) == ["first-a", "first-b"]
    assert sorted(r.Name for r in read_latest_snapshot(spark, root, schemas.AIRLINES).collect()) == ["again-a", "again-b"]
    assert sorted(r.Name for r in read_latest_snapshot(spark, root, schemas.AIRLINES, run="20240301T100500000000", try_id=first).collect()) == ["first-a", "first-b"]
    assert remove_old_tries(spark, root, "20240301T100500000000") == [first] and first != again
    assert read_latest_snapshot(spark, root, schemas.AIRLINES).count() == 2


def test_failed_rerun_changes_nothing(spark, tmp_out):
    root, ts = f"{tmp_out}/airlines", "2024-03-01 10:05:00"
    write_parquet_snapshot(_airlines(spark, "first"), root, ts)
    broken = _airlines(spark, "second").repartition(2, "Name").withColumn(
        "Code", F.when(F.col("Name") == "second-b", F.raise_error(F.lit("stop")).cast("string")).otherwise(F.col("Code")))
    try:
        write_parquet_snapshot(broken, root, ts)
        raise AssertionError("the write must fail")
    except Exception as e:
        assert "stop" in str(e)
    assert sorted(r.Name for r in read_latest_snapshot(spark, root, schemas.AIRLINES).collect()) == ["first-a", "first-b"]
    assert sorted(r.Name for r in read_snapshots(spark, root, schemas.AIRLINES).collect()) == ["first-a", "first-b"]


def test_unrecorded_files_are_not_read(spark, tmp_out):
    """Files that a writer left without a record, as when its driver is lost before the commit."""
    root, ts = f"{tmp_out}/airlines", "2024-03-01 10:05:00"
    write_parquet_snapshot(_airlines(spark, "first"), root, ts)
    folder = f"{root}/tech_year=2024/tech_month=2024-03/tech_day=2024-03-01/tech_hour=10/run=20240301T100500000000"
    _airlines(spark, "lost").write.parquet(f"{folder}/try=lost")
    assert read_latest_snapshot(spark, root, schemas.AIRLINES).count() == 2
    assert read_snapshots(spark, root, schemas.AIRLINES).count() == 2

import pytest
from pyspark.sql import functions as F

from flightlake import schemas
from flightlake.functions.text import first_char, first_word
from flightlake.plans import reports as R
from flightlake.sources.parquet import read_table
from flightlake.sources.rows import rows_to_df
from tests.test_reports import tables


def test_read_table_checks_columns(spark, tmp_out):
    path = f"{tmp_out}/t"
    spark.createDataFrame([("a", "b")], "Name string, Code string").write.parquet(path)
    with pytest.raises(ValueError):
        read_table(spark, path, schemas.AIRLINES, strict=True)      # ICAO missing
    assert read_table(spark, path, schemas.AIRLINES).first().ICAO is None   # schema-on-read
    assert read_table(spark, path).columns == ["Name", "Code"]


def test_rows_to_df_schema(spark):
    df = rows_to_df(spark, [("europe", 72.0, -25.0, 45.0, 33.0)], schemas.ZCTINENT)
    assert df.schema == schemas.ZCTINENT and df.count() == 1


def test_first_word_and_char_edges(spark):
    df = spark.createDataFrame([("Airbus A320",), ("",), (None,), (" lead",), ("one",)], "m string")
    got = [(r.w, r.c) for r in df.select(first_word("m").alias("w"), first_char("m").alias("c")).collect()]
    assert got == [("Airbus", "A"), ("", None), (None, None), ("", " "), ("one", "o")]


def test_t10_first_char_models_group_by_letter(spark):
    ac = [(f"f{i}", 1.0, 1.0, "AFR", "CDG", 1.0, "LHR", "AF", "A", m, 1, 2, "1")
          for i, m in enumerate(["Airbus A320", "ATR 72", "Boeing 737"])]
    t = tables(spark, ac)
    coded = t.acflight.withColumn("aircraft_model", first_char(F.col("aircraft_model")))
    t1 = R.Tables(t.airlines, t.znctyn, t.airport, t.flight, coded, t.flctry)
    assert {tuple(r) for r in R.manufacturer_counts(t1).collect()} == {("a", 2), ("b", 1)}
    assert {tuple(r) for r in R.manufacturer_counts(t).collect()} == {("airbus", 1), ("atr", 1), ("boeing", 1)}


def test_t13_reports_do_not_change_inputs(spark):
    t = tables(spark)
    before = sorted(tuple(r) for r in t.acflight.collect())
    R.longest_live_flight(t).collect()                    # casts actual_distance in its own plan only
    R.mean_flight_length_by_continent(t).collect()
    assert sorted(tuple(r) for r in t.acflight.collect()) == before
    assert dict(t.acflight.dtypes)["actual_distance"] == "float"


def test_run_jobs_runs_all_and_raises():
    from flightlake.plans.etl import run_jobs
    done = []
    run_jobs([lambda i=i: done.append(i) for i in range(6)], parallel=3)
    assert sorted(done) == list(range(6))

    def boom():
        raise RuntimeError("job failed")
    with pytest.raises(RuntimeError):
        run_jobs([lambda: None, boom], parallel=2)

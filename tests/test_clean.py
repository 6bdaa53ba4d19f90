from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, IntegerType, LongType, StringType, StructField, StructType

from flightlake import schemas
from flightlake.operators import clean as C


def flight_rows():
    # flight_id, airline_icao, aircraft_code, origin, dep, arr, model, duration, lat, lon, alt
    return [
        ("f1", "AF", "A1", "CDG", 100, 200, "Airbus A320", "100", 1.0, 2.0, 300),
        ("f1", "AF", "A1", "CDG", 100, 200, "Airbus A320", "100", 1.0, 2.0, 300),   # exact duplicate
        ("f2", "", "B1", "JFK", 100, 300, "Boeing 737", "200", 1.0, 2.0, 300),      # empty airline
        ("f3", None, "B1", "JFK", 100, 300, "Boeing 737", "200", 1.0, 2.0, 300),    # null airline
        ("f4", "BA", "B1", "LHR", None, 300, "Boeing 737", None, 1.0, 2.0, 300),    # no departure
        ("f5", "BA", "B1", "LHR", 100, None, "", None, None, None, None),           # empty model, no arrival
        ("f6", "BA", "B1", "LHR", 100, 400, None, "300", 1.0, 2.0, 300),            # null model
        ("f7", "BA", "B1", "", 100, 400, "Embraer E190", "300", 1.0, 2.0, 300),     # empty origin
        ("f8", "BA", "B1", None, 100, 400, "Embraer E190", "300", 1.0, 2.0, 300),   # null origin
    ]


def test_drop_duplicates_whole_row(spark):
    df = spark.createDataFrame(flight_rows(), schemas.FLIGHT)
    assert C.drop_duplicates(df).count() == 8
    assert C.drop_duplicates(C.drop_duplicates(df)).count() == 8  # idempotent


def test_filter_valid_flights_semantics(spark):
    df = spark.createDataFrame(flight_rows(), schemas.FLIGHT)
    kept = {r.flight_id for r in C.filter_valid_flights(df).collect()}
    # empty model passes (the OR reduces to not-null); nulls fail the != tests
    assert kept == {"f1", "f5"}


def test_fill_nulls_by_type(spark):
    df = spark.createDataFrame(flight_rows(), schemas.FLIGHT)
    out = C.fill_nulls_by_type(df).where(F.col("flight_id") == "f5").first()
    assert out.departure_arrival == 0 and out.flight_duration == ""
    assert out.last_position_latitude == 0.0 and out.last_position_altitude == 0
    assert C.fill_nulls_by_type(df).dtypes == df.dtypes


def test_type_defaults_skip_other_types(spark):
    schema = StructType([StructField("a", FloatType()), StructField("b", StringType()),
                         StructField("c", IntegerType()), StructField("d", LongType()),
                         StructField("e", schemas.ACFLIGHT["flight_id"].dataType)])
    assert C.type_defaults(schema) == {"a": 0.0, "b": "", "c": 0, "d": 0, "e": ""}


def test_fill_nulls_subset_only_code(spark):
    df = spark.createDataFrame([("X", None, None), (None, "C", "I")], schemas.AIRLINES)
    got = {(r.Name, r.Code, r.ICAO) for r in C.fill_nulls_subset(df, ["Code"]).collect()}
    assert got == {("X", "", None), (None, "C", "I")}


def test_clean_airlines_lower_after_distinct(spark):
    df = spark.createDataFrame([("Air A", "1", "A"), ("AIR A", "1", "A"), ("Air A", "1", "A")], schemas.AIRLINES)
    out = C.clean_airlines(df)
    # distinct first, then lower: two rows remain, both 'air a'
    assert sorted(r.Name for r in out.collect()) == ["air a", "air a"]
    assert out.columns == ["Name", "Code", "ICAO"]


def test_cast_distance_truncates_and_overflow_is_null(spark):
    df = spark.createDataFrame([(1.9,), (-1.9,), (3.0e10,), (None,)], "actual_distance float")
    got = [r.actual_distance for r in C.cast_distance(df).collect()]
    assert got == [1, -1, None, None]


def test_where_sql_on_dropped_column(spark):
    df = spark.createDataFrame([("a", "EU", "EU"), ("b", "EU", "AS")], "Name string, o string, d string")
    out = C.where_sql(df, "d = o").select("Name")
    assert [r.Name for r in out.collect()] == ["a"]


def test_filter_not_null_and_rank(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("c", 4)], "k string, r int")
    assert C.filter_not_null(df, ["k"]).count() == 2
    assert C.filter_rank(df, "r", 3).count() == 2


def test_clean_flight_rename_and_lower(spark):
    df = spark.createDataFrame(flight_rows(), schemas.FLIGHT)
    out = C.clean_flight(df)
    assert "departure_origin" in out.columns and "departure_time" not in out.columns
    assert "aircraft_model|" not in out.columns
    assert {r.aircraft_model for r in out.collect()} == {"airbus a320", ""}


def test_lowercase_columns(spark):
    df = spark.createDataFrame([("PARIS", "FRANCE")], "name string, country string")
    assert C.lowercase_columns(df, ["name", "country"]).first() == ("paris", "france")

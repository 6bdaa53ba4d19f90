"""Named queries over one scale folder: every report and every operator of
the inventory that needs its own evidence. Each callable takes
(spark, sf_dir) and returns a lazy DataFrame over the given tables.

Column names equal those of the SQL in plans.oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, MapType, StringType, StructField, StructType, TimestampNTZType,
)

from flightlake import schemas
from flightlake.functions.time import epoch_seconds, layout_columns
from flightlake.operators import clean as C
from flightlake.operators import ingest as E
from flightlake.operators.aggregates import (
    count_col_by_keys, count_dict_form, count_star_by_key, mean_by_key,
)
from flightlake.operators.joins import (
    join_airline, join_origin_airport, join_role_playing_dims, lookup_by_key, mean_over_m2m_join,
)
from flightlake.operators.range_join import within_radius_join
from flightlake.operators.ranking import dense_rank_top_n, order_by_desc, top1_row, top_n
from flightlake.plans import fixtures as X
from flightlake.plans import reports as R
from flightlake.session import scratch_path
from flightlake.sinks.results import write_csv_result
from flightlake.sinks.snapshots import write_parquet_snapshot
from flightlake.sources.landed_json import read_landed_json, stitch_details
from flightlake.sources.parquet import read_latest_snapshot, read_table

Query = Callable[[SparkSession, str], DataFrame]


def raw_tables(spark: SparkSession, d: str) -> R.Tables:
    return R.Tables(
        airlines=X.airlines(spark, d), znctyn=X.znctyn(spark, d), airport=X.airport(spark, d),
        flight=X.flight(spark, d), acflight=X.acflight(spark, d), flctry=X.flctry(spark, d),
    )


def cleaned(spark: SparkSession, d: str) -> R.Tables:
    return R.clean_tables(raw_tables(spark, d))


def _report(fn) -> Query:
    return lambda spark, d: fn(cleaned(spark, d))


# --- sources and sinks -------------------------------------------------------

LINEITEM_SCAN = StructType([
    StructField("l_orderkey", LongType()), StructField("l_partkey", LongType()),
    StructField("l_suppkey", LongType()), StructField("l_linenumber", IntegerType()),
    StructField("l_quantity", DoubleType()), StructField("l_extendedprice", DoubleType()),
    StructField("l_discount", DoubleType()), StructField("l_tax", DoubleType()),
    StructField("l_returnflag", StringType()), StructField("l_linestatus", StringType()),
    StructField("l_shipdate", TimestampNTZType()),
])


def q_scan_parquet(spark, d):
    df = read_table(spark, f"{d}/lineitem.parquet", LINEITEM_SCAN)
    return df.select(*[c for c in LINEITEM_SCAN.fieldNames() if c != "l_shipdate"],
                     epoch_seconds("l_shipdate").alias("l_shipdate_epoch"))


EVENT_DOC = StructType([StructField("event_id", LongType()), StructField("props", StructType([StructField("k", LongType())]))])


def landed_events(spark, d, damaged: bool = False) -> str:
    """Events landed as JSON lines; with ``damaged``, error events arrive without their last character."""
    ev = X.table(spark, d, "events", ["event_id", "event_type", "props"])
    doc = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"props":'), F.col("props"), F.lit("}"))
    ev = ev.select("event_type", doc.alias("value"))
    if damaged:
        cut = F.expr("substring(value, 1, length(value) - 1)")
        ev = ev.withColumn("value", F.when(F.col("event_type") == "error", cut).otherwise(F.col("value")))
    path = scratch_path(spark, "landed-events")
    ev.select("value").write.text(path)
    return path


def q_landed_json_source(spark, d):
    docs, _ = E.split_bad_records(read_landed_json(spark, landed_events(spark, d), EVENT_DOC))
    return docs.select("event_id", F.col("props.k").alias("k"))


def q_skip_bad_records(spark, d):
    """The records that go on with their fields, and the quarantined ones with their raw text."""
    good, bad = E.split_bad_records(read_landed_json(spark, landed_events(spark, d, damaged=True), EVENT_DOC))
    none = F.lit(None)
    return good.select("event_id", F.col("props.k").alias("k"), none.cast("string").alias("bad_record")).unionByName(
        bad.select(none.cast("long").alias("event_id"), none.cast("long").alias("k"), F.col(schemas.CORRUPT_COLUMN).alias("bad_record")))


EVENT_SNAPSHOT = StructType([StructField("event_id", LongType()), StructField("user_id", LongType()),
                             StructField("event_type", StringType()), StructField("value", DoubleType())])


def q_latest_snapshot(spark, d):
    """Every hour of events written as a run of its own; the newest is found from the folders."""
    root = scratch_path(spark, "snapshot-events")
    ev = X.table(spark, d, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    hour = F.date_trunc("hour", "ts").cast("timestamp")
    write_parquet_snapshot(ev.withColumn("hour", hour).drop("ts").repartition("hour"), root, F.col("hour"))
    return read_latest_snapshot(spark, root, EVENT_SNAPSHOT).select("event_id", "user_id", "event_type", "value")


def q_write_parquet_snapshot(spark, d):
    """Written twice for one run time: the second write replaces the first."""
    root = scratch_path(spark, "snapshot-acflight")
    for _ in range(2):
        write_parquet_snapshot(X.acflight(spark, d), root, "2024-01-26 18:05:00")
    return read_latest_snapshot(spark, root, schemas.ACFLIGHT).select(*schemas.ACFLIGHT.fieldNames())


def q_write_csv_result(spark, d):
    path = scratch_path(spark, "result-r1")
    write_csv_result(R.airline_most_live_flights(cleaned(spark, d)), path)
    return spark.read.schema("Name string, flight_count long").csv(path)


def q_write_csv_result_r6(spark, d):
    """The answer that grows with the data, written by all tasks."""
    path = scratch_path(spark, "result-r6")
    write_csv_result(R.top3_models_by_airline_country(cleaned(spark, d)), path)
    return spark.read.schema("Name string, country string, aircraft_model string, model_count long, model_rank int").csv(path)


def q_snapshot_layout(spark, d):
    ev = X.table(spark, d, "events", ["event_id", "ts"])
    cols = layout_columns(F.col("ts"))
    return ev.select("event_id", *[v.alias(k) for k, v in cols.items()])


# --- extraction ----------------------------------------------------------------

def q_flatten_zones(spark, d):
    """All three levels of the zones documents, with the name of the zone above."""
    continents, countries, cities = E.flatten_zones(X.zone_documents_json(spark, d))
    levels = [continents.withColumn("parent", F.lit(None).cast("string")),
              countries.withColumnRenamed("continent", "parent"), cities.withColumnRenamed("country", "parent")]
    named = [df.withColumn("level", F.lit(name)) for df, name in zip(levels, ("continent", "country", "city"))]
    return named[0].unionByName(named[1]).unionByName(named[2])


_TEXT_BOX = [StructField(c, StringType()) for c in E.BOX_COLUMNS]
ZONES_TEXT = MapType(StringType(), StructType(_TEXT_BOX + [
    StructField("subzones", MapType(StringType(), StructType(_TEXT_BOX)))]))


def q_cast_zones(spark, d):
    """Country boxes read as text (no typed reader), then cast to double."""
    docs = X.zone_documents_json(spark, d)
    cont = docs.select(F.explode(E.parse_json("value", ZONES_TEXT)).alias("continent", "_z"))
    raw = cont.select("continent", F.explode("_z.subzones").alias("zone", "_c")).select("zone", "_c.*", "continent")
    return E.cast_zones(raw)


def q_rows_to_df(spark, d):
    """S3: the five continent boxes (driver rows, rows_to_df) used as a lookup
    over every customer position: customers per zone, empty zones kept."""
    zones = X.zones(spark)
    m = E.locate_in_zones(X.customer_positions(spark, d), zones)
    counts = m.groupBy("zone_name").agg(F.count(F.lit(1)).alias("customers"))
    z = zones.select(F.col("zone").alias("zone_name"), "zone_ord")
    return z.join(counts, "zone_name", "left").select(
        "zone_name", "zone_ord", F.coalesce(F.col("customers"), F.lit(0)).cast("long").alias("customers"))


def q_project_airports(spark, d):
    emb = X.table(spark, d, "embeddings", ["vec_id", "embedding", "label"])
    docs = emb.select(
        F.try_element_at("embedding", F.lit(1)).alias("latitude"),
        F.try_element_at("embedding", F.lit(2)).alias("longitude"),
        F.col("label").alias("altitude"),
        F.concat(F.lit("airport "), F.col("vec_id").cast("string")).alias("name"),
        F.concat(F.lit("V"), F.col("vec_id").cast("string")).alias("icao"),
        F.col("vec_id").cast("string").alias("iata"),
        F.col("label").cast("string").alias("country"),
    )
    return E.project_airports(docs)


def customers_in_zones(spark, d) -> DataFrame:
    return E.locate_in_zones(X.customer_positions(spark, d), X.zones(spark))


def _zone_match_columns(df: DataFrame) -> DataFrame:
    return df.select("c_custkey", "c_nationkey", "latitude", "longitude", "zone_name", "zone_ord")


def q_point_in_box(spark, d):
    return _zone_match_columns(customers_in_zones(spark, d))


def q_point_in_box_grid(spark, d):
    """As point_in_box; both keys run the one grid plan."""
    return _zone_match_columns(customers_in_zones(spark, d))


def q_first_match_per_country(spark, d):
    points = X.customer_positions(spark, d).withColumn("zone_country", F.col("c_nationkey").cast("string"))
    return E.first_zone_per_country(points, X.zones(spark), "zone_country", ["latitude", "longitude"], "c_custkey")


def q_skip_bad_zones(spark, d):
    """The zones that can be read, on all three levels, and the text of those that can't."""
    docs = X.zone_documents_with_bad_corners(spark, d)
    continents, countries, cities = E.flatten_zones(docs)
    good = continents.select("zone").unionByName(countries.select("zone")).unionByName(cities.select("zone"))
    bad = E.bad_zone_records(docs).select(F.lit(None).cast("string").alias("zone"), F.col("record").alias("bad_record"))
    return good.withColumn("bad_record", F.lit(None).cast("string")).unionByName(bad)


def q_landed_details_apart(spark, d):
    """Flight list and details landed apart, twice each: the newest of both, stitched and flattened."""
    landing = scratch_path(spark, "landed-apart")
    X.land_flights_apart(spark, d, landing)
    listed, _ = E.split_bad_records(read_landed_json(spark, f"{landing}/flights", schemas.FLIGHT_DOC, with_position=True))
    details, _ = E.split_bad_records(read_landed_json(spark, f"{landing}/details", schemas.FLIGHT_DETAILS_DOC, with_position=True))
    return E.flatten_flights(stitch_details(listed, details))


def parsed_flight_docs(spark, d) -> DataFrame:
    docs = X.flight_documents_json(spark, d)
    return docs.select(E.parse_json("value", schemas.FLIGHT_DOC).alias("_d")).select("_d.*")


def q_flatten_flights(spark, d):
    return E.flatten_flights(parsed_flight_docs(spark, d))


def q_last_trail_point(spark, d):
    """The last point of every landed flight's trail array; null for an empty trail."""
    last = E.last_trail_point("details.trail")
    return parsed_flight_docs(spark, d).select(F.col("id").alias("flight_id"), last["lat"].alias("lat"),
                                               last["lng"].alias("lng"), last["alt"].alias("alt"))


def q_model_first_element(spark, d):
    p = X.table(spark, d, "part", ["p_partkey", "p_name"])
    return p.select("p_partkey", E.model_text("p_name", first_char_only=True).alias("aircraft_model"))


def q_distance_from_origin(spark, d):
    f = E.distance_from_origin(X.acflight(spark, d).drop("actual_distance"), X.airport(spark, d),
                               alias="distance_km")
    return f.select("flight_id", "airline_icao", "origin_airport_iata",
                    F.round("distance_km", 6).alias("distance_km"))


def q_live_subset(spark, d):
    live = E.live_subset(parsed_flight_docs(spark, d))
    live = E.distance_from_origin(live, X.airport(spark, d))
    return E.acflight_projection(live.withColumn("actual_distance", F.round("actual_distance", 3)))


def q_flights_over_country(spark, d):
    """Boxes that end at the date line."""
    return E.flights_over_country(X.znctyn(spark, d), X.acflight(spark, d),
                                  F.lit(X.COUNTRY_BOX_HALF_LAT), F.lit(X.COUNTRY_BOX_HALF_LON), wrap=False)


def q_flights_over_country_wrapped(spark, d):
    """The same boxes going on beyond the date line."""
    return E.flights_over_country(X.znctyn(spark, d), X.acflight(spark, d),
                                  F.lit(X.COUNTRY_BOX_HALF_LAT), F.lit(X.COUNTRY_BOX_HALF_LON))


def q_customers_within_radius(spark, d):
    """Customers within RADIUS_M of a country's point, on the globe."""
    centres = X.znctyn(spark, d).select("zone_country", F.col("latitude").alias("centre_latitude"), F.col("longitude").alias("centre_longitude"))
    pairs = within_radius_join(X.customer_positions(spark, d), centres, X.RADIUS_M)
    return pairs.select("c_custkey", "zone_country", F.round("distance_km", 6).alias("distance_km"))


# --- cleaning --------------------------------------------------------------------

def q_drop_duplicates(spark, d):
    """Whole order lines, those of line number 1 landed twice."""
    li = X.table(spark, d, "lineitem")
    rows = C.drop_duplicates(li.unionByName(li.where("l_linenumber = 1")))
    return rows.withColumn("l_shipdate_epoch", epoch_seconds("l_shipdate")).drop("l_shipdate")


def q_lowercase_columns(spark, d):
    return C.lowercase_columns(X.flctry(spark, d), ["country", "continent"])


def q_fill_nulls_by_type(spark, d):
    return C.fill_nulls_by_type(X.flight(spark, d))


FLIGHT_TEXT = ["flight_id", "airline_icao", "aircraft_code", "origin_airport_iata", "aircraft_model", "flight_duration"]


def q_fill_nulls_subset(spark, d):
    """Only airline_icao is filled; the other text columns keep their nulls."""
    return C.fill_nulls_subset(X.flight(spark, d).select(*FLIGHT_TEXT), ["airline_icao"], "")


def q_filter_valid_flights(spark, d):
    """The surviving flights, with the columns the filter tests."""
    return C.filter_valid_flights(X.flight(spark, d)).select(
        "flight_id", "airline_icao", "origin_airport_iata", "departure_time", "aircraft_model")


def q_rename_columns(spark, d):
    return C.rename_columns(X.acflight(spark, d), {"departure_time": "departure_origin"})


def q_cast_distance(spark, d):
    return C.cast_distance(X.acflight(spark, d)).select("flight_id", "actual_distance")


def q_select_columns(spark, d):
    return C.select_columns(X.acflight(spark, d), ["flight_id", "airline_icao", "origin_airport_iata",
                                                  "destination_airport_iata"])


def q_where_sql_string(spark, d):
    return R.regional_flights(cleaned(spark, d))


def q_filter_not_null(spark, d):
    return C.filter_not_null(X.flight(spark, d), ["airline_icao", "departure_arrival"]).select(
        "flight_id", "airline_icao", "departure_arrival", "origin_airport_iata", "aircraft_model")


# --- joins -----------------------------------------------------------------------

def q_join_airline(spark, d):
    t = cleaned(spark, d)
    return join_airline(t.acflight, t.airlines).select("flight_id", "airline_icao", "Name", "Code")


def q_join_role_playing_dims(spark, d):
    t = cleaned(spark, d)
    j = join_role_playing_dims(t.acflight, t.airport, t.znctyn, "left")
    return j.select("flight_id", "origin_airport_iata", "destination_airport_iata", "country_origin",
                    "continent_origin", "country_destination", "continent_destination")


def q_join_origin_airport(spark, d):
    t = cleaned(spark, d)
    return join_origin_airport(t.flight, t.airport).select("flight_id", "origin_airport_iata", "country", "name")


def q_join_by_country_m2m(spark, d):
    """R4's many-to-many join in aggregated form: per continent the number of
    joined rows and their mean length, without building the joined rows."""
    t = cleaned(spark, d)
    return mean_over_m2m_join(R.flight_lengths_by_country(t), "country", "flight_length", t.flctry, "country",
                              "continent", "mean_flight_length", R.MEAN_DIGITS, rows_alias="joined_rows")


def q_join_flight_country(spark, d):
    return R.flights_with_country(cleaned(spark, d)).select("flight_id", "Name", "country", "continent")


def q_full_outer_counts(spark, d):
    return R.airport_flow_counts(cleaned(spark, d))


def q_lookup_by_collected_key(spark, d):
    t = cleaned(spark, d)
    out = count_star_by_key(t.acflight, "origin_airport_iata", "num_outbound_flights")
    winner = top1_row(out, "num_outbound_flights", ["origin_airport_iata"]).select(
        F.col("origin_airport_iata").alias("airport_iata"))
    return lookup_by_key(winner, "airport_iata", t.airport, "iata", "name")


# --- aggregates, ranking ------------------------------------------------------------

def q_count_star_by_key(spark, d):
    return count_star_by_key(cleaned(spark, d).acflight, "origin_airport_iata", "flight_count")


def q_mean_by_key(spark, d):
    f = cleaned(spark, d).flight.withColumn("flight_length", F.col("departure_arrival") - F.col("departure_origin"))
    return mean_by_key(f, "origin_airport_iata", "flight_length", "mean_flight_length", R.MEAN_DIGITS)


def q_grouped_count_shorthand(spark, d):
    return R.manufacturer_counts(cleaned(spark, d))


def q_count_col_multi_key(spark, d):
    return count_col_by_keys(R.flights_with_country(cleaned(spark, d)), ["Name", "country", "aircraft_model"],
                             "flight_id", "model_count")


def q_count_dict_form(spark, d):
    return count_dict_form(cleaned(spark, d).acflight, "destination_airport_iata", "num_inbound_flights")


def q_dense_rank_topn_per_group(spark, d):
    counts = count_col_by_keys(cleaned(spark, d).acflight, ["origin_airport_iata", "aircraft_model"],
                               "flight_id", "model_count")
    return dense_rank_top_n(counts, ["origin_airport_iata"], "model_count", 3, "model_rank")


def q_order_by_desc(spark, d):
    return order_by_desc(count_star_by_key(cleaned(spark, d).acflight, "airline_icao", "flight_count"),
                         "flight_count", ["airline_icao"])


def q_top1_row(spark, d):
    counts = count_star_by_key(cleaned(spark, d).acflight, "destination_airport_iata", "flight_count")
    return top1_row(counts, "flight_count", ["destination_airport_iata"])


def q_top_k_limit(spark, d):
    counts = count_star_by_key(cleaned(spark, d).acflight, "aircraft_model", "flight_count")
    return top_n(counts, 5, "flight_count", ["aircraft_model"])


QUERIES: dict[str, Query] = {k: _report(fn) for k, fn in R.REPORTS.items()}
QUERIES.update({
    "scan_parquet": q_scan_parquet,
    "rows_to_df": q_rows_to_df,
    "landed_json_source": q_landed_json_source,
    "latest_snapshot": q_latest_snapshot,
    "write_parquet_snapshot": q_write_parquet_snapshot,
    "write_csv_result": q_write_csv_result,
    "write_csv_result_r6": q_write_csv_result_r6,
    "snapshot_layout": q_snapshot_layout,
    "flatten_zones": q_flatten_zones,
    "cast_zones": q_cast_zones,
    "project_airports": q_project_airports,
    "point_in_box": q_point_in_box,
    "point_in_box_grid": q_point_in_box_grid,
    "first_match_per_country": q_first_match_per_country,
    "flatten_flights": q_flatten_flights,
    "last_trail_point": q_last_trail_point,
    "model_first_element": q_model_first_element,
    "distance_from_origin": q_distance_from_origin,
    "live_subset": q_live_subset,
    "skip_bad_records": q_skip_bad_records,
    "skip_bad_zones": q_skip_bad_zones,
    "landed_details_apart": q_landed_details_apart,
    "flights_over_country": q_flights_over_country,
    "flights_over_country_wrapped": q_flights_over_country_wrapped,
    "customers_within_radius": q_customers_within_radius,
    "drop_duplicates": q_drop_duplicates,
    "lowercase_columns": q_lowercase_columns,
    "fill_nulls_by_type": q_fill_nulls_by_type,
    "fill_nulls_subset": q_fill_nulls_subset,
    "filter_valid_flights": q_filter_valid_flights,
    "rename_columns": q_rename_columns,
    "cast_distance": q_cast_distance,
    "select_columns": q_select_columns,
    "where_sql_string": q_where_sql_string,
    "filter_not_null": q_filter_not_null,
    "join_airline": q_join_airline,
    "join_role_playing_dims": q_join_role_playing_dims,
    "join_origin_airport": q_join_origin_airport,
    "join_by_country_m2m": q_join_by_country_m2m,
    "join_flight_country": q_join_flight_country,
    "full_outer_counts": q_full_outer_counts,
    "lookup_by_collected_key": q_lookup_by_collected_key,
    "count_star_by_key": q_count_star_by_key,
    "mean_by_key": q_mean_by_key,
    "grouped_count_shorthand": q_grouped_count_shorthand,
    "count_col_multi_key": q_count_col_multi_key,
    "count_dict_form": q_count_dict_form,
    "dense_rank_topn_per_group": q_dense_rank_topn_per_group,
    "order_by_desc": q_order_by_desc,
    "top1_row": q_top1_row,
    "top_k_limit": q_top_k_limit,
})

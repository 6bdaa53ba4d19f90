"""The driver's TPC-H-like tables read as flight tables.

Each function returns a lazy DataFrame over the Parquet files of one scale
folder, so its work grows with the tables. The same rules are written as
DuckDB SQL in plans.oracle; keep both in step.

    airlines  <- supplier             Name = s_name, Code = ICAO = s_suppkey
    airport   <- nation               iata = n_nationkey, name = country = n_name
    znctyn    <- nation x region      zone_country = n_name, continent = r_name
    flight    <- lineitem x orders x supplier x part x customer (all orders),
                 with missing values set by the rules in FLIGHT_GAPS
    acflight  <- same join, open orders only ('O' = live)
    flctry    <- open orders x customer x nation x region
    positions <- integer hundredths of a degree from a key (POSITION_RULE)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from flightlake import schemas
from flightlake.functions.time import epoch_seconds
from flightlake.sources.parquet import read_table
from flightlake.sources.rows import rows_to_df

# --- fixed values: fixture rules --------------------------------------------
# position of key k, in hundredths of a degree:
#   lat = (k * 7919 mod 18000) - 9000,  lon = (k * 104729 mod 36000) - 18000
POSITION_RULE = {"lat": (7919, 18000, 9000), "lon": (104729, 36000, 18000)}
LIVE_STATUS = "O"
# Continent boxes in degrees (tl_y, tl_x, br_y, br_x) and their order.
ZONE_BOXES = [
    ("asia", 80.0, 40.0, -10.0, 180.0),
    ("africa", 38.0, -20.0, -36.0, 55.0),
    ("europe", 72.0, -25.0, 33.0, 45.0),
    ("n_america", 75.0, -170.0, 10.0, -50.0),
    ("s_america", 14.0, -92.0, -56.0, -30.0),
]
# Half size in degrees of the box around a country point (flights over a country).
COUNTRY_BOX_HALF_LAT = 45.0
COUNTRY_BOX_HALF_LON = 60.0
# Radius in metres around a country point (customers within a radius): circles over poles and date line are among them.
RADIUS_M = 3_000_000.0
# Half size in degrees of the zone boxes in the landed zones documents.
NATION_BOX_HALF = 5.0
REGION_BOX_HALF = 20.0
CITY_BOX_HALF = 1.0

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Schemas of the driver tables: given to the reader, so no footer-inference
# job runs per scan and a changed file fails fast on the column check.
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "conversations": "conv_id long, turn long, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    schema = DRIVER_SCHEMAS.get(name)
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    df = spark.read.schema(schema).parquet(path) if schema else read_table(spark, path)
    return df.select(*columns) if columns else df


def position_hundredths(key: Column | str, axis: str) -> Column:
    mult, mod, off = POSITION_RULE[axis]
    key = F.col(key) if isinstance(key, str) else key
    return (key.cast("long") * F.lit(mult)) % F.lit(mod) - F.lit(off)


def position_deg(key: Column | str, axis: str) -> Column:
    return position_hundredths(key, axis).cast("double") / F.lit(100.0)


def _str(c: str) -> Column:
    return F.col(c).cast("string")


# --- dimensions ---------------------------------------------------------------

def airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier", ["s_suppkey", "s_name"])
    return s.select(F.col("s_name").alias("Name"), _str("s_suppkey").alias("Code"), _str("s_suppkey").alias("ICAO"))


def _nation_altitude() -> Column:
    return (F.col("n_regionkey") * F.lit(100) + F.col("n_nationkey")).cast("int")


def airport(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    return n.select(
        position_deg("n_nationkey", "lat").cast("float").alias("latitude"),
        position_deg("n_nationkey", "lon").cast("float").alias("longitude"),
        _nation_altitude().alias("altitude"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("N"), _str("n_nationkey")).alias("icao"),
        _str("n_nationkey").alias("iata"),
        F.col("n_name").alias("country"),
    )


def znctyn(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(
        F.col("n_name").alias("zone_country"),
        position_deg("n_nationkey", "lat").alias("latitude"),
        position_deg("n_nationkey", "lon").alias("longitude"),
        _nation_altitude().alias("altitude"),
        F.col("r_name").alias("continent"),
    )


def zones(spark: SparkSession) -> DataFrame:
    """The five continent boxes, with their order ``zone_ord``."""
    schema = StructType(schemas.ZCTINENT.fields[:1] + [
        StructField("tl_y", schemas.ZCTINENT["tl_y"].dataType), StructField("tl_x", schemas.ZCTINENT["tl_x"].dataType),
        StructField("br_y", schemas.ZCTINENT["br_y"].dataType), StructField("br_x", schemas.ZCTINENT["br_x"].dataType),
    ])
    df = rows_to_df(spark, ZONE_BOXES, schema)
    ords = F.create_map(*[x for i, z in enumerate(ZONE_BOXES) for x in (F.lit(z[0]), F.lit(i))])
    return df.withColumn("zone_ord", ords[F.col("zone")].cast("int"))


# --- facts --------------------------------------------------------------------

def flight_lines(spark: SparkSession, sf_dir: str, live_only: bool = False, spread: bool = False) -> DataFrame:
    """One row per order line with everything the flight tables need.

    ``spread`` hash-distributes the order lines by order key before the
    joins, as landed data spread over many files would be; everything built
    on top then runs in parallel tasks. At scale this is the distribution
    the sort-merge join with orders needs anyway, so the exchange is reused
    by that join rather than added.
    """
    li = table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                           "l_extendedprice", "l_shipdate", "l_returnflag", "l_linestatus"])
    if spread:
        li = li.repartition("l_orderkey")
    o = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])
    if live_only:
        o = o.where(F.col("o_orderstatus") == LIVE_STATUS)
    s = table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    p = table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_type"])
    c = table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    return (li.join(o, li["l_orderkey"] == o["o_orderkey"])
              .join(s, li["l_suppkey"] == s["s_suppkey"])
              .join(p, li["l_partkey"] == p["p_partkey"])
              .join(c, o["o_custkey"] == c["c_custkey"]))


def _duration() -> Column:
    return (epoch_seconds("l_shipdate") - epoch_seconds("o_orderdate")).cast("string")


def acflight(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = flight_lines(spark, sf_dir, live_only=True)
    return j.select(
        _str("l_orderkey").alias("flight_id"),
        position_deg("c_custkey", "lat").cast("float").alias("latitude"),
        position_deg("c_custkey", "lon").cast("float").alias("longitude"),
        _str("l_suppkey").alias("airline_icao"),
        _str("s_nationkey").alias("origin_airport_iata"),
        F.col("l_extendedprice").cast("float").alias("actual_distance"),
        _str("c_nationkey").alias("destination_airport_iata"),
        _str("l_suppkey").alias("airline_iata"),
        _str("l_partkey").alias("aircraft_code"),
        F.col("p_name").alias("aircraft_model"),
        epoch_seconds("o_orderdate").alias("departure_time"),
        epoch_seconds("l_shipdate").alias("departure_arrival"),
        _duration().alias("flight_duration"),
    )


# Missing values of the all-flights table, as the API delivers them:
#   airline_icao null          when l_returnflag = 'N' and l_linestatus = 'F'
#   origin_airport_iata ''     when l_returnflag = 'A' and l_linestatus = 'F'
#   departure_time null        when l_linenumber = 1
#   arrival, duration null     when l_linestatus = 'O' (still in the air)
#   aircraft_model null / ''   when p_type = 'PROMO' / 'SMALL'
#   last position null         when l_returnflag = 'R' and l_linestatus = 'O'
def flight(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = flight_lines(spark, sf_dir, live_only=False)
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    no_pos = (rf == "R") & (ls == "O")
    flying = ls == "O"
    return j.select(
        _str("l_orderkey").alias("flight_id"),
        F.when((rf == "N") & (ls == "F"), F.lit(None).cast("string")).otherwise(_str("l_suppkey")).alias("airline_icao"),
        _str("l_partkey").alias("aircraft_code"),
        F.when((rf == "A") & (ls == "F"), F.lit("")).otherwise(_str("s_nationkey")).alias("origin_airport_iata"),
        F.when(F.col("l_linenumber") == 1, F.lit(None).cast("long")).otherwise(epoch_seconds("o_orderdate")).alias("departure_time"),
        F.when(flying, F.lit(None).cast("long")).otherwise(epoch_seconds("l_shipdate")).alias("departure_arrival"),
        F.when(F.col("p_type") == "PROMO", F.lit(None).cast("string"))
         .when(F.col("p_type") == "SMALL", F.lit("")).otherwise(F.col("p_name")).alias("aircraft_model"),
        F.when(flying, F.lit(None).cast("string")).otherwise(_duration()).alias("flight_duration"),
        F.when(no_pos, F.lit(None).cast("double")).otherwise(position_deg("c_custkey", "lat")).alias("last_position_latitude"),
        F.when(no_pos, F.lit(None).cast("double")).otherwise(position_deg("c_custkey", "lon")).alias("last_position_longitude"),
        F.when(no_pos, F.lit(None).cast("int")).otherwise((F.col("l_linenumber") * 1000).cast("int")).alias("last_position_altitude"),
    )


def flctry(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"]).where(F.col("o_orderstatus") == LIVE_STATUS)
    c = table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    n = table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    return (o.join(c, o["o_custkey"] == c["c_custkey"])
             .join(n, F.col("c_nationkey") == n["n_nationkey"])
             .join(r, F.col("n_regionkey") == r["r_regionkey"])
             .select(F.col("n_name").alias("country"), F.col("r_name").alias("continent"),
                     _str("o_orderkey").alias("id_flight")))


def customer_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as located points (degrees)."""
    c = table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    return c.select("c_custkey", "c_nationkey",
                    position_deg("c_custkey", "lat").alias("latitude"),
                    position_deg("c_custkey", "lon").alias("longitude"))


# --- landed documents built from the tables ---------------------------------

def flight_documents_json(spark: SparkSession, sf_dir: str, origin: str = "s_nationkey",
                          destination: str = "c_nationkey", position: str = "c_custkey") -> DataFrame:
    """Flight list entries with their details, as landed JSON text (``value``).

    Nulls are left out of the text (absent keys), as the API does:
    no aircraft block for PROMO parts, no arrival while in the air
    (l_linestatus 'O'), an empty trail for returned lines ('R').
    """
    # Landed documents arrive as many files; spread them by flight id the
    # same way (hash partitioning: deterministic if a task is retried).
    j = flight_lines(spark, sf_dir, live_only=False, spread=True)
    lat, lon = position_deg(position, "lat"), position_deg(position, "lon")
    o_lat, o_lon = position_deg(origin, "lat"), position_deg(origin, "lon")
    alt = (F.col("l_linenumber") * 1000).cast("int")
    trail = F.when(F.col("l_returnflag") == "R", F.array().cast(schemas.FLIGHT_DETAILS["trail"].dataType)).otherwise(
        F.array(F.struct(o_lat.alias("lat"), o_lon.alias("lng"), F.lit(0).alias("alt")),
                F.struct(lat.alias("lat"), lon.alias("lng"), alt.alias("alt"))))
    details = F.struct(
        F.when(F.col("p_type") != "PROMO", F.struct(F.struct(F.col("p_name").alias("text")).alias("model"))).alias("aircraft"),
        F.struct(
            F.struct(epoch_seconds("o_orderdate").alias("departure"),
                     F.when(F.col("l_linestatus") != "O", epoch_seconds("l_shipdate")).alias("arrival")).alias("real"),
            F.struct(F.when(F.col("l_linestatus") != "O", _duration()).alias("flighttime")).alias("historical"),
        ).alias("time"),
        F.struct((F.col("o_orderstatus") == LIVE_STATUS).alias("live")).alias("status"),
        trail.alias("trail"),
    )
    doc = F.struct(
        _str("l_orderkey").alias("id"), _str("l_suppkey").alias("airline_icao"),
        _str("l_suppkey").alias("airline_iata"), _str("l_partkey").alias("code"),
        _str(origin).alias("origin_airport_iata"), _str(destination).alias("destination_airport_iata"),
        lat.alias("latitude"), lon.alias("longitude"), details.alias("details"),
    )
    return j.select(F.to_json(doc).alias("value"))


def zone_documents_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones documents, one per customer: the path region -> nation -> city
    of the customer as a three-level map {region: {box, subzones: {nation:
    {box, subzones: {city: {box}}}}}}. Customers with a negative balance land
    without the city level (a zone without subzones). Nothing is grouped, so
    every document stays small however large the tables grow.

    Coordinates are whole hundredths of a degree written as JSON integers
    (the reader must coerce them to double).
    """
    c = table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal"])
    n = table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])

    def box(key: str, half: float) -> list[Column]:
        h = F.lit(int(half * 100))
        y, x = position_hundredths(key, "lat"), position_hundredths(key, "lon")
        return [(y + h).alias("tl_y"), (x - h).alias("tl_x"), (x + h).alias("br_x"), (y - h).alias("br_y")]

    city = F.create_map(F.col("c_name"), F.struct(*box("c_custkey", CITY_BOX_HALF)))
    nation = F.struct(*box("n_nationkey", NATION_BOX_HALF),
                      F.when(F.col("c_acctbal") >= 0, city).alias("subzones"))
    region = F.struct(*box("r_regionkey", REGION_BOX_HALF),
                      F.create_map(F.col("n_name"), nation).alias("subzones"))
    return j.select(F.to_json(F.create_map(F.col("r_name"), region)).alias("value"))


# --- a landing folder for the end-to-end run (plans.etl) ------------------------

def land_documents(spark: SparkSession, sf_dir: str, landing: str) -> None:
    """Write the four landed document kinds, derived from the driver tables,
    as JSON lines below ``landing`` (airlines, zones, airports, flights).

    airlines <- supplier; airports <- customer (iata = c_custkey, country =
    its nation); flights <- order lines: origin airport = the order's
    customer, destination airport = the customer whose key equals the
    supplier key; zones <- the five continent boxes with, below them, the 25 nations
    (one a zone in turn) and a city each: one small document of three levels, as the API returns it.
    """
    s = table(spark, sf_dir, "supplier", ["s_suppkey", "s_name"])
    s.select(F.to_json(F.struct(F.col("s_name").alias("Name"), _str("s_suppkey").alias("Code"),
                                _str("s_suppkey").alias("ICAO"))).alias("value")) \
        .write.mode("overwrite").text(f"{landing}/airlines")

    def box(key: str, half: float) -> list[Column]:
        y, x, h = position_deg(key, "lat"), position_deg(key, "lon"), F.lit(half)
        return [(y + h).alias("tl_y"), (x - h).alias("tl_x"), (x + h).alias("br_x"), (y - h).alias("br_y")]

    city = F.create_map(F.concat(F.col("n_name"), F.lit(" city")), F.struct(*box("n_nationkey", CITY_BOX_HALF)))
    # 25 nations at every scale
    by_zone = table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"]).groupBy("n_regionkey").agg(
        F.map_from_entries(F.collect_list(F.struct("n_name", F.struct(*box("n_nationkey", NATION_BOX_HALF), city.alias("subzones"))))).alias("subzones"))
    names = {i: z for i, z in enumerate(ZONE_BOXES)}

    def of_zone(k: int) -> Column:
        return F.create_map(*[x for i, z in names.items() for x in (F.lit(i), F.lit(z[k]))])[F.col("n_regionkey").cast("int")]

    zone = F.struct(of_zone(1).alias("tl_y"), of_zone(2).alias("tl_x"), of_zone(4).alias("br_x"), of_zone(3).alias("br_y"), "subzones")
    doc = by_zone.agg(F.map_from_entries(F.collect_list(F.struct(of_zone(0).alias("name"), zone.alias("box")))).alias("m"))
    doc.select(F.to_json("m").alias("value")).write.mode("overwrite").text(f"{landing}/zones")

    c = table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey"])
    n = table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    ap = c.join(n, c["c_nationkey"] == n["n_nationkey"]).select(F.to_json(F.struct(
        position_deg("c_custkey", "lat").alias("latitude"), position_deg("c_custkey", "lon").alias("longitude"),
        (F.col("c_nationkey") * 10).alias("altitude"), F.col("c_name").alias("name"),
        F.concat(F.lit("C"), _str("c_custkey")).alias("icao"), _str("c_custkey").alias("iata"),
        F.col("n_name").alias("country"))).alias("value"))
    ap.write.mode("overwrite").text(f"{landing}/airports")

    docs = flight_documents_json(spark, sf_dir, origin="o_custkey", destination="l_suppkey", position="l_partkey")
    docs.write.mode("overwrite").text(f"{landing}/flights")


# --- flights whose details land apart -------------------------------------------

# Orders as listed flights; those of priority '5-LOW' never get details. Both kinds land twice, a stale
# batch (position and times of another key, no trail) and then the one that holds.
def land_flights_apart(spark: SparkSession, sf_dir: str, landing: str) -> None:
    o = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"])

    def listed(position: str, by: str) -> DataFrame:
        return o.repartition(by).select(F.to_json(F.struct(
            _str("o_orderkey").alias("id"), _str("o_custkey").alias("airline_icao"), _str("o_custkey").alias("airline_iata"),
            F.col("o_orderpriority").alias("code"), _str("o_custkey").alias("origin_airport_iata"),
            position_deg(position, "lat").alias("latitude"), position_deg(position, "lon").alias("longitude"))).alias("value"))

    def detailed(stale: bool, by: str) -> DataFrame:
        flying = F.col("o_orderstatus") == LIVE_STATUS
        point = F.struct(position_deg("o_orderkey", "lat").alias("lat"), position_deg("o_orderkey", "lon").alias("lng"), F.lit(1000).alias("alt"))
        when = F.lit(0).cast("long") if stale else epoch_seconds("o_orderdate")
        details = F.struct(
            F.struct(F.struct(F.col("o_orderpriority").alias("text")).alias("model")).alias("aircraft"),
            F.struct(F.struct(when.alias("departure"), F.when(~flying, when + 60).alias("arrival")).alias("real")).alias("time"),
            F.struct(flying.alias("live")).alias("status"),
            (F.array().cast(schemas.FLIGHT_DETAILS["trail"].dataType) if stale else F.array(point)).alias("trail"))
        return o.where(F.col("o_orderpriority") != "5-LOW").repartition(by).select(
            F.to_json(F.struct(_str("o_orderkey").alias("id"), details.alias("details"))).alias("value"))

    listed("o_orderkey", "o_custkey").write.text(f"{landing}/flights/batch=1")
    listed("o_custkey", "o_orderkey").write.text(f"{landing}/flights/batch=2")
    detailed(True, "o_orderkey").write.text(f"{landing}/details/batch=1")
    detailed(False, "o_custkey").write.text(f"{landing}/details/batch=2")


def zone_documents_with_bad_corners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zones documents, in which the box of a nation without a city has a word for its right edge."""
    docs = zone_documents_json(spark, sf_dir)
    bad = F.regexp_replace("value", r'("br_x":)(-?[0-9]+)(,"br_y":-?[0-9]+\}\}\}\})$', '$1"unknown"$3')
    return docs.select(bad.alias("value"))

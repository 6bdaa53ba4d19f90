"""Fixed schemas of the nine flight tables and of the landed API documents.

All columns are nullable. Column names and types are fixed values that the
reports depend on; keep them exactly as written.
"""

from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, FloatType, IntegerType, LongType,
    MapType, StringType, StructField, StructType,
)


def _s(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# --- fixed values: landed table schemas -------------------------------------
AIRLINES = _s(("Name", StringType()), ("Code", StringType()), ("ICAO", StringType()))

ZONE_BOX = [("tl_y", DoubleType()), ("tl_x", DoubleType()), ("br_x", DoubleType()), ("br_y", DoubleType())]
ZCTINENT = _s(("zone", StringType()), *ZONE_BOX)
ZNCTRY = _s(("zone", StringType()), *ZONE_BOX, ("continent", StringType()))
ZNCTY = _s(("zone", StringType()), *ZONE_BOX, ("country", StringType()))

AIRPORT = _s(
    ("latitude", FloatType()), ("longitude", FloatType()), ("altitude", IntegerType()),
    ("name", StringType()), ("icao", StringType()), ("iata", StringType()), ("country", StringType()),
)

ZNCTYN = _s(
    ("zone_country", StringType()), ("latitude", DoubleType()), ("longitude", DoubleType()),
    ("altitude", IntegerType()), ("continent", StringType()),
)

FLIGHT = _s(
    ("flight_id", StringType()), ("airline_icao", StringType()), ("aircraft_code", StringType()),
    ("origin_airport_iata", StringType()), ("departure_time", LongType()),
    ("departure_arrival", LongType()), ("aircraft_model", StringType()),
    ("flight_duration", StringType()), ("last_position_latitude", DoubleType()),
    ("last_position_longitude", DoubleType()), ("last_position_altitude", IntegerType()),
)

ACFLIGHT = _s(
    ("flight_id", StringType()), ("latitude", FloatType()), ("longitude", FloatType()),
    ("airline_icao", StringType()), ("origin_airport_iata", StringType()),
    ("actual_distance", FloatType()), ("destination_airport_iata", StringType()),
    ("airline_iata", StringType()), ("aircraft_code", StringType()), ("aircraft_model", StringType()),
    ("departure_time", LongType()), ("departure_arrival", LongType()), ("flight_duration", StringType()),
)

FLCTRY = _s(("country", StringType()), ("continent", StringType()), ("id_flight", StringType()))

TABLES = {
    "airlines": AIRLINES, "zctinent": ZCTINENT, "znctry": ZNCTRY, "zncty": ZNCTY,
    "airport": AIRPORT, "znctyn": ZNCTYN, "flight": FLIGHT, "acflight": ACFLIGHT,
    "flctry": FLCTRY,
}

# --- landed API documents (JSON lines) --------------------------------------
# Zones: map zone -> box with optional subzones, three levels deep.
_BOX_FIELDS = [StructField(n, t, True) for n, t in ZONE_BOX]
CITY_ZONE = StructType(list(_BOX_FIELDS))
COUNTRY_ZONE = StructType(_BOX_FIELDS + [StructField("subzones", MapType(StringType(), CITY_ZONE), True)])
CONTINENT_ZONE = StructType(_BOX_FIELDS + [StructField("subzones", MapType(StringType(), COUNTRY_ZONE), True)])
ZONES_DOC = MapType(StringType(), CONTINENT_ZONE)

AIRLINE_DOC = AIRLINES

AIRPORT_DOC = _s(
    ("latitude", DoubleType()), ("longitude", DoubleType()), ("altitude", DoubleType()),
    ("name", StringType()), ("icao", StringType()), ("iata", StringType()), ("country", StringType()),
)

TRAIL_POINT = _s(("lat", DoubleType()), ("lng", DoubleType()), ("alt", IntegerType()))

FLIGHT_DETAILS = _s(
    ("aircraft", _s(("model", _s(("text", StringType()))))),
    ("time", _s(
        ("real", _s(("departure", LongType()), ("arrival", LongType()))),
        ("historical", _s(("flighttime", StringType()))),
    )),
    ("status", _s(("live", BooleanType()))),
    ("trail", ArrayType(TRAIL_POINT)),
)

# One landed flight: the list entry plus its details document.
FLIGHT_DOC = _s(
    ("id", StringType()), ("airline_icao", StringType()), ("airline_iata", StringType()),
    ("code", StringType()), ("origin_airport_iata", StringType()),
    ("destination_airport_iata", StringType()), ("latitude", DoubleType()),
    ("longitude", DoubleType()), ("details", FLIGHT_DETAILS),
)

# Details that landed apart from the list, by the flight's id.
FLIGHT_DETAILS_DOC = _s(("id", StringType()), ("details", FLIGHT_DETAILS))

CORRUPT_COLUMN = "_corrupt_record"


def with_corrupt_column(schema: StructType) -> StructType:
    """Schema plus the column Spark fills with unparsable input text."""
    if CORRUPT_COLUMN in schema.fieldNames():
        return schema
    return StructType(schema.fields + [StructField(CORRUPT_COLUMN, StringType(), True)])

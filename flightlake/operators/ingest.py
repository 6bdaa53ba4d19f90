"""Extraction transforms (E1-E12): landed API documents to flight tables.

The original flattened these documents in Python loops on the driver; here
each is a Spark job over the landed JSON (struct access, explode, joins), so
the work is partitioned like any other scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flightlake import schemas
from flightlake.functions.geo import box_around, haversine_km
from flightlake.functions.text import first_char
from flightlake.operators.range_join import point_in_box_join

BOX_COLUMNS = ["tl_y", "tl_x", "br_x", "br_y"]


def parse_json(text: Column | str, schema, with_corrupt: bool = False) -> Column:
    """Typed JSON parse of a text column (numbers coerced per value).
    With ``with_corrupt`` a struct schema gets ``_corrupt_record`` holding
    the raw text of unparsable input."""
    text = F.col(text) if isinstance(text, str) else text
    if with_corrupt and isinstance(schema, StructType):
        return F.from_json(text, schemas.with_corrupt_column(schema),
                           {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT_COLUMN})
    return F.from_json(text, schema)


# E11
def split_bad_records(parsed: DataFrame, corrupt_col: str = schemas.CORRUPT_COLUMN) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine): a bad record goes to quarantine, the others go on."""
    good = parsed.where(F.col(corrupt_col).isNull()).drop(corrupt_col)
    bad = parsed.where(F.col(corrupt_col).isNotNull())
    return good, bad


def split_bad_zones(docs: DataFrame, text_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(good, quarantine) of zones documents, whose keys are data: a map has no place for the raw
    text of a bad one, so a text that gives no map is bad. Both keep their text."""
    no_map = F.from_json(F.col(text_col), ZONE_MAP).isNull()
    return docs.where(~no_map), docs.where(no_map)


#: zones by name, in the document's order; a zone's value stays untyped until a field of it is asked for
ZONE_MAP = "map<string,variant>"
LEVELS = ["continent", "country", "city"]


def zone_entries(docs: DataFrame, text_col: str = "value", keep: tuple[str, ...] = ()) -> list[DataFrame]:
    """The zones of each of the three levels: columns ``keep`` of docs, zone, parent, zone_pos (place among its
    neighbours), the corners as double, whatever their JSON form (null: absent or no number),
    and ``record``: the text of a zone that has a bad corner or subzones that are no object, else null."""
    subzones = F.try_variant_get(F.col("_v"), "$.subzones", ZONE_MAP)
    any_subzones = F.try_variant_get(F.col("_v"), "$.subzones", "variant")
    levels, rows = [], docs.select(*keep, F.lit(None).cast("string").alias("parent"),
                                   F.posexplode(F.from_json(F.col(text_col), ZONE_MAP)).alias("zone_pos", "zone", "_v"))
    for _ in LEVELS:
        corners = [F.try_variant_get(F.col("_v"), f"$.{c}", "double") for c in BOX_COLUMNS]
        whole = F.lit(True)
        for c in corners:
            whole &= c.isNotNull()
        whole &= subzones.isNotNull() | any_subzones.isNull() | F.is_variant_null(any_subzones)
        record = F.when(~whole, F.to_json(F.create_map("zone", "_v")))
        levels.append(rows.select(*keep, "zone", "parent", "zone_pos", *[x.alias(c) for x, c in zip(corners, BOX_COLUMNS)], record.alias("record")))
        rows = rows.select(*keep, F.col("zone").alias("parent"), F.posexplode(subzones).alias("zone_pos", "zone", "_v"))
    return levels


def _with_box(entries: DataFrame) -> DataFrame:
    whole = F.lit(True)
    for c in BOX_COLUMNS:
        whole &= F.col(c).isNotNull()
    return entries.where(whole)


# E11, below the documents
def bad_zone_records(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """``record`` of every zone that can't be read whole (the original's float() failed there and
    with it the whole extraction): {zone: its value}. The other zones of the document go on, those below it too."""
    bad = [level.where(F.col("record").isNotNull()).select("record") for level in zone_entries(docs, text_col)]
    return bad[0].unionByName(bad[1]).unionByName(bad[2])


# E1 + E2
def flatten_zones(docs: DataFrame, text_col: str = "value") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Zones documents (map zone -> box + subzones, three levels) to the
    continent, country and city tables. A zone without subzones adds no child
    row (plain explode). Box values are read as double whatever their JSON
    number form; a zone with a corner that is no number is in no table (bad_zone_records)."""
    cont, ctry, city = (_with_box(level) for level in zone_entries(docs, text_col))
    return (cont.select("zone", *BOX_COLUMNS), ctry.select("zone", *BOX_COLUMNS, F.col("parent").alias("continent")),
            city.select("zone", *BOX_COLUMNS, F.col("parent").alias("country")))


def zone_order(docs: DataFrame, position: str, text_col: str = "value") -> DataFrame:
    """The continents with ``zone_ord``, their number in landed order (document, then place in it). The numbers
    come from one window: a run's documents name a handful of continents."""
    cont = _with_box(zone_entries(docs, text_col, keep=(position,))[0])
    number = F.row_number().over(Window.orderBy(position, "zone_pos")) - 1
    return cont.select("zone", *BOX_COLUMNS, number.alias("zone_ord"))


# E2
def cast_zones(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in BOX_COLUMNS if c in df.columns})


# E3
def project_airports(df: DataFrame) -> DataFrame:
    """Airport documents to the 7-column table: lat/lon as float, altitude int."""
    return df.select(
        F.col("latitude").cast("float").alias("latitude"),
        F.col("longitude").cast("float").alias("longitude"),
        F.col("altitude").cast("int").alias("altitude"),
        F.col("name").cast("string").alias("name"),
        F.col("icao").cast("string").alias("icao"),
        F.col("iata").cast("string").alias("iata"),
        F.col("country").cast("string").alias("country"),
    )


# E4
def locate_in_zones(points: DataFrame, zones: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Every (point, zone) with the point strictly inside the zone box.
    ``zones`` columns are prefixed ``zone_`` (zone_name, zone_tl_y, ...)."""
    z = zones.select(
        F.col("zone").alias("zone_name"),
        *[F.col(c).alias(f"zone_{c}") for c in BOX_COLUMNS],
        *[F.col(c) for c in zones.columns if c not in ["zone", *BOX_COLUMNS]],
    )
    return point_in_box_join(points, z, lat=lat, lon=lon,
                             corners=("zone_tl_y", "zone_tl_x", "zone_br_y", "zone_br_x"))


# E5
def _keep_least(df: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of df whose ``order`` is the least of their ``key``.

    Only the order is aggregated: by hash, grouped by its text parts (a landed file's
    name), with the number as the one buffer; the whole rows are joined back."""
    kind = df.schema[order].dataType
    parts = [f"{order}.{f.name}" for f in kind.fields] if isinstance(kind, StructType) else [order]
    texts, last = parts[:-1], parts[-1]
    names = [f"_t{i}" for i in range(len(texts))]
    by_text = df.groupBy(F.col(key).alias("_key"), *[F.col(t).alias(n) for t, n in zip(texts, names)]).agg(F.min(F.col(last)).alias("_n"))
    least = by_text
    if texts:       # a row for each key and file by now
        least = by_text.groupBy("_key").agg(F.min(F.struct(*names, "_n")).alias("_o")).select("_key", "_o.*")
    same = df[key].eqNullSafe(least["_key"]) & F.col(last).eqNullSafe(F.col("_n"))
    for t, n in zip(texts, names):
        same &= F.col(t).eqNullSafe(F.col(n))
    return df.join(least, same, "left_semi")


def first_match_per_country(matches: DataFrame, country: str, values: list[str],
                            order: list[str]) -> DataFrame:
    """One row per country: the values of the match that is first by ``order``
    (for example airport order, then zone order; a column or a struct of texts and a last
    number). Each order in turn is reduced to its least per country by a hash aggregate
    with a map-side step, so a country with many airports is reduced before the shuffle;
    matches that are equal in every order are equal landed rows, of which one is kept."""
    first = matches
    for column in order:
        first = _keep_least(first, country, column)
    return first.select(country, *values).dropDuplicates([country])


#: zones that one order can number; points may then have 2^43 ranks
MAX_ZONES = 1 << 20


def first_zone_per_country(points: DataFrame, zones: DataFrame, country: str, values: list[str], point_ord: str,
                           zone_ord: str = "zone_ord", lat: str = "latitude", lon: str = "longitude",
                           zone_alias: str = "continent") -> DataFrame:
    """One row per country: ``values`` of its first point (by the long ``point_ord``, one of its own each, 0 or more) that lies in a
    zone, and the first such zone (by ``zone_ord``).

    Both orders make one long, so the range join, which carries no more than the country and that
    long, goes through one hash aggregate with a map-side step; the values are then looked up by the
    two orders of the winners, a row a country. Null countries are one country."""
    matches = locate_in_zones(points.select(country, lat, lon, point_ord), zones.select("zone", *BOX_COLUMNS, zone_ord), lat, lon)
    p, z = F.col(point_ord).cast("long"), F.col(zone_ord).cast("long")
    fits = (p >= 0) & (p < F.lit(1 << 43)) & (z >= 0) & (z < F.lit(MAX_ZONES))
    order = F.when(fits, p * F.lit(MAX_ZONES) + z).otherwise(F.raise_error(F.lit("orders must be 0 or more, below 2^43 and 2^20")).cast("long"))
    first = matches.groupBy(country).agg(F.min(order).alias("_o")).select(
        F.col(country), F.shiftright("_o", 20).alias("_fp"), F.col("_o").bitwiseAND(F.lit(MAX_ZONES - 1)).alias("_fz"))
    looked_up = first.join(points.select(F.col(point_ord).cast("long").alias("_fp"), *values), "_fp")
    named = looked_up.join(zones.select(F.col(zone_ord).cast("long").alias("_fz"), F.col("zone").alias(zone_alias)), "_fz")
    return named.select(country, *values, zone_alias)


# E7
def last_trail_point(trail: Column | str) -> Column:
    """Last element of an array; null for an empty or null array."""
    trail = F.col(trail) if isinstance(trail, str) else trail
    return F.try_element_at(trail, F.lit(-1))


# E8
def model_text(text: Column | str, first_char_only: bool = False) -> Column:
    """Aircraft model: the whole text (default) or, as originally coded, its
    first character (null for null or empty)."""
    text = F.col(text) if isinstance(text, str) else text
    return first_char(text) if first_char_only else text


# E6
def flatten_flights(docs: DataFrame, first_char_only: bool = False,
                    keep_without_trail: bool = False) -> DataFrame:
    """Flight documents (schemas.FLIGHT_DOC) to the 11-column flight table.
    Absent or null nested keys give null. Flights without a trail point were
    dropped by the original (it indexed a missing point); that stays the
    default. The last point is taken by exploding the one-element tail of
    the trail (no element, no row) rather than by a filter, so no predicate
    on a parsed field is pushed below the parse and evaluated a second time."""
    tail = F.slice(F.col("details.trail"), -1, 1)
    gen = F.explode_outer(tail) if keep_without_trail else F.explode(tail)
    out = docs.select(
        F.col("id").alias("flight_id"),
        F.col("airline_icao"),
        F.col("code").alias("aircraft_code"),
        F.col("origin_airport_iata"),
        F.col("details.time.real.departure").cast("long").alias("departure_time"),
        F.col("details.time.real.arrival").cast("long").alias("departure_arrival"),
        model_text("details.aircraft.model.text", first_char_only).alias("aircraft_model"),
        F.col("details.time.historical.flighttime").alias("flight_duration"),
        gen.alias("_last"),
    )
    return out.select(
        *[c for c in out.columns if c != "_last"],
        F.col("_last.lat").cast("double").alias("last_position_latitude"),
        F.col("_last.lng").cast("double").alias("last_position_longitude"),
        F.col("_last.alt").cast("int").alias("last_position_altitude"),
    )


# E9
def distance_from_origin(flights: DataFrame, airport: DataFrame, origin: str = "origin_airport_iata",
                         lat: str = "latitude", lon: str = "longitude",
                         alias: str = "actual_distance") -> DataFrame:
    """Great-circle km from the live position to the origin airport; null when
    the origin code is missing or unknown (left join, no per-flight lookup)."""
    a = (airport.where(F.col("iata").isNotNull() & (F.col("iata") != ""))
         .groupBy("iata").agg(F.min_by(F.struct(F.col("latitude").alias("_alat"),
                                                F.col("longitude").alias("_alon")),
                                       F.struct("latitude", "longitude")).alias("_a"))
         .select(F.col("iata").alias("_iata"), "_a._alat", "_a._alon"))
    j = flights.join(a, flights[origin] == a["_iata"], "left")
    return j.withColumn(alias, haversine_km(F.col(lat), F.col(lon), F.col("_alat"), F.col("_alon"))) \
            .drop("_iata", "_alat", "_alon")


# E10
def live_subset(docs: DataFrame) -> DataFrame:
    """Flights whose details say live (absent flag = not live) and that have a trail point:
    the original failed on, and so skipped, a flight without one before it came to the live
    list. Both rules stand inside one explode of the trail's one-element tail, so no
    predicate on a parsed field is pushed below the parse and evaluated a second time."""
    live = F.coalesce(F.col("details.status.live"), F.lit(False))
    tail = F.when(live, F.slice(F.col("details.trail"), -1, 1))
    return docs.select("*", F.explode(tail).alias("_last")).drop("_last")


def acflight_projection(docs: DataFrame, first_char_only: bool = False) -> DataFrame:
    """The 13-column live-flight table (needs ``actual_distance`` already set)."""
    return docs.select(
        F.col("id").alias("flight_id"),
        F.col("latitude").cast("float").alias("latitude"),
        F.col("longitude").cast("float").alias("longitude"),
        F.col("airline_icao"),
        F.col("origin_airport_iata"),
        F.col("actual_distance").cast("float").alias("actual_distance"),
        F.col("destination_airport_iata"),
        F.col("airline_iata"),
        F.col("code").alias("aircraft_code"),
        model_text("details.aircraft.model.text", first_char_only).alias("aircraft_model"),
        F.col("details.time.real.departure").cast("long").alias("departure_time"),
        F.col("details.time.real.arrival").cast("long").alias("departure_arrival"),
        F.col("details.time.historical.flighttime").alias("flight_duration"),
    )


# E12
def flights_over_country(points: DataFrame, flights: DataFrame, half_lat, half_lon, point_lat: str = "latitude",
                         point_lon: str = "longitude", flight_lat: str = "latitude",
                         flight_lon: str = "longitude", wrap: bool = True) -> DataFrame:
    """(country, continent, id_flight) for every flight inside the box around
    each country's representative point. A flight may be seen over several
    countries; every match is kept. ``half_lat``/``half_lon`` are degrees,
    literal or per-point columns (see functions.geo.radius_to_half_widths). A box goes on beyond
    the date line (``wrap``); without, it ends there."""
    box = box_around(F.col(point_lat), F.col(point_lon), half_lat, half_lon)
    boxes = points.select(
        F.col("zone_country").alias("country"), F.col("continent"),
        *[box[c].alias(f"_b_{c}") for c in ("tl_y", "tl_x", "br_y", "br_x")],
    )
    fl = flights.select(F.col("flight_id").alias("id_flight"),
                        F.col(flight_lat).alias("_f_lat"), F.col(flight_lon).alias("_f_lon"))
    j = point_in_box_join(fl, boxes, lat="_f_lat", lon="_f_lon",
                          corners=("_b_tl_y", "_b_tl_x", "_b_br_y", "_b_br_x"), wrap=wrap)
    return j.select("country", "continent", "id_flight")

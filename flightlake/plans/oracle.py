"""Independent DuckDB SQL for every query of plans.catalog.

Plain SQL over the driver tables (registered as views by the checker):
the fixture rules of plans.fixtures are written out again here, and the
reports are the direct, unoptimised form (R4 builds the many-to-many join
that the Spark plan avoids). Column names and types equal the Spark side.
"""

from __future__ import annotations

from flightlake.plans import fixtures as X

LAT_M, LAT_MOD, LAT_OFF = X.POSITION_RULE["lat"]
LON_M, LON_MOD, LON_OFF = X.POSITION_RULE["lon"]


def lat_h(k: str) -> str:
    return f"((CAST({k} AS BIGINT) * {LAT_M}) % {LAT_MOD} - {LAT_OFF})"


def lon_h(k: str) -> str:
    return f"((CAST({k} AS BIGINT) * {LON_M}) % {LON_MOD} - {LON_OFF})"


def lat(k: str) -> str:
    return f"(CAST({lat_h(k)} AS DOUBLE) / 100.0)"


def lon(k: str) -> str:
    return f"(CAST({lon_h(k)} AS DOUBLE) / 100.0)"


def ep(ts: str) -> str:
    return f"CAST(epoch({ts}) AS BIGINT)"


def s(c: str) -> str:
    return f"CAST({c} AS VARCHAR)"


def exact_mean(x: str) -> str:
    """avg(x) of integers, rounded half away from zero to 6 decimals with
    integer arithmetic, then one division."""
    sm, n = f"CAST(sum({x}) AS HUGEINT)", f"count({x})"
    q = f"((abs({sm}) * 2000000 + {n}) // (2 * {n}))"
    return f"(CASE WHEN {n} > 0 THEN CAST(CASE WHEN {sm} < 0 THEN -{q} ELSE {q} END AS DOUBLE) / 1000000.0 END)"


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    p1, p2 = f"radians(CAST({lat1} AS DOUBLE))", f"radians(CAST({lat2} AS DOUBLE))"
    dlon = f"(radians(CAST({lon2} AS DOUBLE)) - radians(CAST({lon1} AS DOUBLE)))"
    a = f"(pow(sin(({p2} - {p1}) / 2), 2) + cos({p1}) * cos({p2}) * pow(sin({dlon} / 2), 2))"
    return f"({2 * 6371.0} * asin(sqrt({a})))"


DUR = f"{s(f'{ep('l_shipdate')} - {ep('o_orderdate')}')}"
ALT_N = "CAST(n_regionkey * 100 + n_nationkey AS INTEGER)"

BASE = {
    "airlines_raw": f"""SELECT s_name AS "Name", {s('s_suppkey')} AS "Code", {s('s_suppkey')} AS "ICAO" FROM supplier""",
    "airport_raw": f"""SELECT CAST({lat('n_nationkey')} AS FLOAT) AS latitude, CAST({lon('n_nationkey')} AS FLOAT) AS longitude,
        {ALT_N} AS altitude, n_name AS name, 'N' || {s('n_nationkey')} AS icao, {s('n_nationkey')} AS iata,
        n_name AS country FROM nation""",
    "znctyn_raw": f"""SELECT n_name AS zone_country, {lat('n_nationkey')} AS latitude, {lon('n_nationkey')} AS longitude,
        {ALT_N} AS altitude, r_name AS continent FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "lines": """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_shipdate, l_returnflag,
        l_linestatus, o_orderstatus, o_orderdate, s_nationkey, p_name, p_type, c_custkey, c_nationkey
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
        JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey""",
    "acflight_raw": f"""SELECT {s('l_orderkey')} AS flight_id, CAST({lat('c_custkey')} AS FLOAT) AS latitude,
        CAST({lon('c_custkey')} AS FLOAT) AS longitude, {s('l_suppkey')} AS airline_icao,
        {s('s_nationkey')} AS origin_airport_iata, CAST(l_extendedprice AS FLOAT) AS actual_distance,
        {s('c_nationkey')} AS destination_airport_iata, {s('l_suppkey')} AS airline_iata,
        {s('l_partkey')} AS aircraft_code, p_name AS aircraft_model, {ep('o_orderdate')} AS departure_time,
        {ep('l_shipdate')} AS departure_arrival, {DUR} AS flight_duration
        FROM lines WHERE o_orderstatus = 'O'""",
    "flight_raw": f"""SELECT {s('l_orderkey')} AS flight_id,
        CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN NULL ELSE {s('l_suppkey')} END AS airline_icao,
        {s('l_partkey')} AS aircraft_code,
        CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN '' ELSE {s('s_nationkey')} END AS origin_airport_iata,
        CASE WHEN l_linenumber = 1 THEN NULL ELSE {ep('o_orderdate')} END AS departure_time,
        CASE WHEN l_linestatus = 'O' THEN NULL ELSE {ep('l_shipdate')} END AS departure_arrival,
        CASE WHEN p_type = 'PROMO' THEN NULL WHEN p_type = 'SMALL' THEN '' ELSE p_name END AS aircraft_model,
        CASE WHEN l_linestatus = 'O' THEN NULL ELSE {DUR} END AS flight_duration,
        CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN NULL ELSE {lat('c_custkey')} END AS last_position_latitude,
        CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN NULL ELSE {lon('c_custkey')} END AS last_position_longitude,
        CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN NULL ELSE CAST(l_linenumber * 1000 AS INTEGER) END AS last_position_altitude
        FROM lines""",
    "flctry_raw": f"""SELECT n_name AS country, r_name AS continent, {s('o_orderkey')} AS id_flight
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey WHERE o_orderstatus = 'O'""",
    # cleaning phase: distinct, lower, (filter), rename, fill -- in the original order
    "airlines_c": """SELECT lower("Name") AS "Name", coalesce("Code", '') AS "Code", "ICAO"
        FROM (SELECT DISTINCT * FROM airlines_raw)""",
    "znctyn_c": """SELECT coalesce(lower(zone_country), '') AS zone_country, coalesce(latitude, 0.0) AS latitude,
        coalesce(longitude, 0.0) AS longitude, coalesce(altitude, 0) AS altitude, coalesce(continent, '') AS continent
        FROM (SELECT DISTINCT * FROM znctyn_raw)""",
    "airport_c": """SELECT coalesce(latitude, CAST(0 AS FLOAT)) AS latitude, coalesce(longitude, CAST(0 AS FLOAT)) AS longitude,
        coalesce(altitude, 0) AS altitude, coalesce(lower(name), '') AS name, coalesce(icao, '') AS icao,
        coalesce(iata, '') AS iata, coalesce(lower(country), '') AS country
        FROM (SELECT DISTINCT * FROM airport_raw)""",
    "flight_c": """SELECT coalesce(flight_id, '') AS flight_id, coalesce(airline_icao, '') AS airline_icao,
        coalesce(aircraft_code, '') AS aircraft_code, coalesce(origin_airport_iata, '') AS origin_airport_iata,
        coalesce(departure_time, 0) AS departure_origin, coalesce(departure_arrival, 0) AS departure_arrival,
        coalesce(lower(aircraft_model), '') AS aircraft_model, coalesce(flight_duration, '') AS flight_duration,
        coalesce(last_position_latitude, 0.0) AS last_position_latitude,
        coalesce(last_position_longitude, 0.0) AS last_position_longitude,
        coalesce(last_position_altitude, 0) AS last_position_altitude
        FROM (SELECT DISTINCT * FROM flight_raw)
        WHERE airline_icao <> '' AND departure_time IS NOT NULL
          AND (aircraft_model IS NOT NULL OR aircraft_model <> '') AND origin_airport_iata <> ''""",
    "acflight_c": """SELECT coalesce(flight_id, '') AS flight_id, coalesce(latitude, CAST(0 AS FLOAT)) AS latitude,
        coalesce(longitude, CAST(0 AS FLOAT)) AS longitude, coalesce(airline_icao, '') AS airline_icao,
        coalesce(origin_airport_iata, '') AS origin_airport_iata,
        coalesce(actual_distance, CAST(0 AS FLOAT)) AS actual_distance,
        coalesce(destination_airport_iata, '') AS destination_airport_iata, coalesce(airline_iata, '') AS airline_iata,
        coalesce(aircraft_code, '') AS aircraft_code, coalesce(lower(aircraft_model), '') AS aircraft_model,
        coalesce(departure_time, 0) AS departure_origin, coalesce(departure_arrival, 0) AS departure_arrival,
        coalesce(flight_duration, '') AS flight_duration
        FROM (SELECT DISTINCT * FROM acflight_raw)""",
    "flctry_c": "SELECT lower(country) AS country, continent, id_flight FROM (SELECT DISTINCT * FROM flctry_raw)",
    # report building blocks
    "dim": """SELECT a.iata, a.country, z.zone_country, z.continent FROM airport_c a JOIN znctyn_c z ON a.country = z.zone_country""",
    "regional": """SELECT a."Name", o.continent AS continent_origin FROM acflight_c f
        JOIN airlines_c a ON f.airline_icao = a."ICAO"
        JOIN dim o ON f.origin_airport_iata = o.iata JOIN dim d ON f.destination_airport_iata = d.iata
        WHERE d.continent = o.continent""",
    "fa": """SELECT lower(a.country) AS country, f.departure_arrival - f.departure_origin AS flight_length
        FROM flight_c f JOIN airport_c a ON f.origin_airport_iata = a.iata""",
    "fc": """SELECT f.flight_id, a."Name", c.country, c.continent, f.aircraft_model FROM acflight_c f
        JOIN airlines_c a ON f.airline_icao = a."ICAO" JOIN flctry_c c ON f.flight_id = c.id_flight""",
    "flow": """SELECT coalesce(i.k, o.k) AS airport_iata, coalesce(i.n, 0) AS num_inbound_flights,
        coalesce(o.n, 0) AS num_outbound_flights, coalesce(i.n, 0) - coalesce(o.n, 0) AS flight_difference
        FROM (SELECT destination_airport_iata AS k, count(*) AS n FROM acflight_c
              WHERE destination_airport_iata IS NOT NULL GROUP BY 1) i
        FULL OUTER JOIN (SELECT origin_airport_iata AS k, count(*) AS n FROM acflight_c
              WHERE origin_airport_iata IS NOT NULL GROUP BY 1) o ON i.k = o.k""",
    "zone_boxes": "SELECT * FROM (VALUES " + ", ".join(
        f"('{z}', {a}, {b}, {c}, {e}, {i})" for i, (z, a, b, c, e) in enumerate(X.ZONE_BOXES)
    ) + ") AS t(zone_name, zone_tl_y, zone_tl_x, zone_br_y, zone_br_x, zone_ord)",
    "cust_pos": f"""SELECT c_custkey, c_nationkey, {lat('c_custkey')} AS latitude, {lon('c_custkey')} AS longitude FROM customer""",
    "cust_in_zone": """SELECT p.*, b.* FROM cust_pos p JOIN zone_boxes b
        ON p.latitude > least(b.zone_tl_y, b.zone_br_y) AND p.latitude < greatest(b.zone_tl_y, b.zone_br_y)
        AND p.longitude > least(b.zone_tl_x, b.zone_br_x) AND p.longitude < greatest(b.zone_tl_x, b.zone_br_x)""",
}


def with_base(body: str) -> str:
    ctes = ",\n".join(f"{k} AS ({v})" for k, v in BASE.items())
    return f"WITH {ctes}\n{body}"


ACF_TIES = ["flight_id", "latitude", "longitude", "airline_icao", "origin_airport_iata", "destination_airport_iata",
            "airline_iata", "aircraft_code", "aircraft_model", "departure_origin", "departure_arrival", "flight_duration"]

NATION_H = int(X.NATION_BOX_HALF * 100)
REGION_H = int(X.REGION_BOX_HALF * 100)
CITY_H = int(X.CITY_BOX_HALF * 100)

SQL: dict[str, str] = {
    # reports
    "R1": 'SELECT "Name", count(*) AS flight_count FROM acflight_c f JOIN airlines_c a ON f.airline_icao = a."ICAO" '
          'GROUP BY "Name" ORDER BY flight_count DESC, "Name"',
    "R1b": 'SELECT "Name", count(*) AS flight_count FROM acflight_c f JOIN airlines_c a ON f.airline_icao = a."ICAO" '
           'GROUP BY "Name" ORDER BY flight_count DESC, "Name" NULLS FIRST LIMIT 1',
    "R2": 'SELECT "Name", count(*) AS flight_count FROM regional GROUP BY "Name" '
          'ORDER BY flight_count DESC, "Name" NULLS FIRST LIMIT 1',
    "R2b": 'SELECT continent, "Name", flight_count FROM (SELECT continent_origin AS continent, "Name", count(*) AS flight_count, '
           'row_number() OVER (PARTITION BY continent_origin ORDER BY count(*) DESC, "Name" NULLS FIRST) AS rn '
           'FROM regional GROUP BY continent_origin, "Name") WHERE rn = 1',
    "R3": "SELECT flight_id, latitude, longitude, airline_icao, origin_airport_iata, "
          "CAST(trunc(actual_distance) AS INTEGER) AS actual_distance, destination_airport_iata, airline_iata, "
          "aircraft_code, aircraft_model, departure_origin, departure_arrival, flight_duration FROM acflight_c "
          "ORDER BY trunc(actual_distance) DESC NULLS LAST, " + ", ".join(f"{c} NULLS FIRST" for c in ACF_TIES) + " LIMIT 1",
    "R4": f"SELECT c.continent, {exact_mean('fa.flight_length')} AS mean_flight_length "
          "FROM fa JOIN flctry_c c ON fa.country = c.country GROUP BY c.continent",
    "R4b": f"SELECT z.continent, {exact_mean('f.departure_arrival - f.departure_origin')} AS mean_flight_length "
           "FROM flight_c f JOIN airport_c a ON f.origin_airport_iata = a.iata JOIN znctyn_c z ON a.country = z.zone_country "
           "WHERE f.departure_origin > 0 AND f.departure_arrival > f.departure_origin GROUP BY z.continent",
    "R5": "SELECT split_part(aircraft_model, ' ', 1) AS aircraft_type, count(*) AS \"count\" FROM acflight_c "
          "GROUP BY 1 ORDER BY \"count\" DESC, aircraft_type NULLS FIRST LIMIT 5",
    "R5b": "SELECT split_part(aircraft_model, ' ', 1) AS aircraft_type, count(*) AS \"count\" FROM acflight_c "
           "GROUP BY 1 ORDER BY \"count\" DESC, aircraft_type NULLS FIRST LIMIT 1",
    "R6": 'SELECT * FROM (SELECT "Name", country, aircraft_model, count(flight_id) AS model_count, '
          'CAST(dense_rank() OVER (PARTITION BY "Name", country ORDER BY count(flight_id) DESC) AS INTEGER) AS model_rank '
          'FROM fc GROUP BY "Name", country, aircraft_model) WHERE model_rank <= 3',
    "R6b": 'SELECT * FROM (SELECT country, aircraft_model, count(flight_id) AS model_count, '
           'CAST(dense_rank() OVER (PARTITION BY country ORDER BY count(flight_id) DESC) AS INTEGER) AS model_rank '
           'FROM fc GROUP BY country, aircraft_model) WHERE model_rank <= 3',
    "R7": "SELECT min(a.name) AS name FROM (SELECT airport_iata FROM flow ORDER BY flight_difference DESC, "
          "airport_iata NULLS FIRST LIMIT 1) w LEFT JOIN airport_c a ON w.airport_iata = a.iata GROUP BY w.airport_iata",
    "R7b": "SELECT w.*, min(a.name) AS name FROM (SELECT * FROM flow ORDER BY abs(flight_difference) DESC, "
           "airport_iata NULLS FIRST LIMIT 1) w LEFT JOIN airport_c a ON w.airport_iata = a.iata "
           "GROUP BY ALL",
    # sources and sinks
    "scan_parquet": "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
                    f"l_tax, l_returnflag, l_linestatus, {ep('l_shipdate')} AS l_shipdate_epoch FROM lineitem",
    "rows_to_df": "SELECT b.zone_name, b.zone_ord, count(c.c_custkey) AS customers FROM zone_boxes b "
                  "LEFT JOIN cust_in_zone c ON b.zone_name = c.zone_name GROUP BY b.zone_name, b.zone_ord",
    "landed_json_source": "SELECT event_id, CAST(props ->> 'k' AS BIGINT) AS k FROM events",
    "skip_bad_records": "SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id, "
                        "CASE WHEN event_type <> 'error' THEN CAST(props ->> 'k' AS BIGINT) END AS k, "
                        "CASE WHEN event_type = 'error' THEN '{\"event_id\":' || event_id || ',\"props\":' || props END AS bad_record FROM events",
    "latest_snapshot": "SELECT event_id, user_id, event_type, value FROM events "
                       "WHERE date_trunc('hour', ts) = (SELECT max(date_trunc('hour', ts)) FROM events)",
    "write_parquet_snapshot": "SELECT * FROM acflight_raw",
    "write_csv_result": 'SELECT "Name", count(*) AS flight_count FROM acflight_c f JOIN airlines_c a '
                        'ON f.airline_icao = a."ICAO" GROUP BY "Name"',
    "write_csv_result_r6": 'SELECT * FROM (SELECT "Name", country, aircraft_model, count(flight_id) AS model_count, '
                           'CAST(dense_rank() OVER (PARTITION BY "Name", country ORDER BY count(flight_id) DESC) AS INTEGER) AS model_rank '
                           'FROM fc GROUP BY "Name", country, aircraft_model) WHERE model_rank <= 3',
    "snapshot_layout": "SELECT event_id, strftime(ts, '%Y') AS tech_year, strftime(ts, '%Y-%m') AS tech_month, "
                       "strftime(ts, '%Y-%m-%d') AS tech_day, strftime(ts, '%H') AS tech_hour, "
                       "strftime(ts, '%B-%Y') AS tech_month_label FROM events",
    # extraction
    "flatten_zones": f"""SELECT 'continent' AS level, r_name AS zone, CAST({lat_h('r_regionkey')} + {REGION_H} AS DOUBLE) AS tl_y,
        CAST({lon_h('r_regionkey')} - {REGION_H} AS DOUBLE) AS tl_x, CAST({lon_h('r_regionkey')} + {REGION_H} AS DOUBLE) AS br_x,
        CAST({lat_h('r_regionkey')} - {REGION_H} AS DOUBLE) AS br_y, NULL AS parent
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        UNION ALL SELECT 'country', n_name, CAST({lat_h('n_nationkey')} + {NATION_H} AS DOUBLE),
        CAST({lon_h('n_nationkey')} - {NATION_H} AS DOUBLE), CAST({lon_h('n_nationkey')} + {NATION_H} AS DOUBLE),
        CAST({lat_h('n_nationkey')} - {NATION_H} AS DOUBLE), r_name
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        UNION ALL SELECT 'city', c_name, CAST({lat_h('c_custkey')} + {CITY_H} AS DOUBLE),
        CAST({lon_h('c_custkey')} - {CITY_H} AS DOUBLE), CAST({lon_h('c_custkey')} + {CITY_H} AS DOUBLE),
        CAST({lat_h('c_custkey')} - {CITY_H} AS DOUBLE), n_name
        FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal >= 0""",
    "cast_zones": f"""SELECT n_name AS zone, CAST({lat_h('n_nationkey')} + {NATION_H} AS DOUBLE) AS tl_y,
        CAST({lon_h('n_nationkey')} - {NATION_H} AS DOUBLE) AS tl_x, CAST({lon_h('n_nationkey')} + {NATION_H} AS DOUBLE) AS br_x,
        CAST({lat_h('n_nationkey')} - {NATION_H} AS DOUBLE) AS br_y, r_name AS continent
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "project_airports": "SELECT CAST(embedding[1] AS FLOAT) AS latitude, CAST(embedding[2] AS FLOAT) AS longitude, "
                        "CAST(label AS INTEGER) AS altitude, 'airport ' || CAST(vec_id AS VARCHAR) AS name, "
                        "'V' || CAST(vec_id AS VARCHAR) AS icao, CAST(vec_id AS VARCHAR) AS iata, "
                        "CAST(label AS VARCHAR) AS country FROM embeddings",
    "point_in_box": "SELECT c_custkey, c_nationkey, latitude, longitude, zone_name, zone_ord FROM cust_in_zone",
    "point_in_box_grid": "SELECT c_custkey, c_nationkey, latitude, longitude, zone_name, zone_ord FROM cust_in_zone",
    "first_match_per_country": "SELECT zone_country, latitude, longitude, continent FROM ("
                               "SELECT CAST(c_nationkey AS VARCHAR) AS zone_country, latitude, longitude, zone_name AS continent, "
                               "row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey, zone_ord) AS rn "
                               "FROM cust_in_zone) WHERE rn = 1",
    "flatten_flights": f"""SELECT {s('l_orderkey')} AS flight_id, {s('l_suppkey')} AS airline_icao, {s('l_partkey')} AS aircraft_code,
        {s('s_nationkey')} AS origin_airport_iata, {ep('o_orderdate')} AS departure_time,
        CASE WHEN l_linestatus <> 'O' THEN {ep('l_shipdate')} END AS departure_arrival,
        CASE WHEN p_type <> 'PROMO' THEN p_name END AS aircraft_model,
        CASE WHEN l_linestatus <> 'O' THEN {DUR} END AS flight_duration,
        {lat('c_custkey')} AS last_position_latitude, {lon('c_custkey')} AS last_position_longitude,
        CAST(l_linenumber * 1000 AS INTEGER) AS last_position_altitude
        FROM lines WHERE l_returnflag <> 'R'""",
    "last_trail_point": f"""SELECT {s('l_orderkey')} AS flight_id, CASE WHEN l_returnflag <> 'R' THEN {lat('c_custkey')} END AS lat,
        CASE WHEN l_returnflag <> 'R' THEN {lon('c_custkey')} END AS lng,
        CASE WHEN l_returnflag <> 'R' THEN CAST(l_linenumber * 1000 AS INTEGER) END AS alt FROM lines""",
    "model_first_element": "SELECT p_partkey, nullif(substring(p_name, 1, 1), '') AS aircraft_model FROM part",
    "distance_from_origin": f"""SELECT f.flight_id, f.airline_icao, f.origin_airport_iata,
        round({haversine('f.latitude', 'f.longitude', 'a.latitude', 'a.longitude')}, 6) AS distance_km
        FROM acflight_raw f LEFT JOIN airport_raw a ON f.origin_airport_iata = a.iata""",
    "live_subset": f"""SELECT {s('l_orderkey')} AS flight_id, CAST({lat('c_custkey')} AS FLOAT) AS latitude,
        CAST({lon('c_custkey')} AS FLOAT) AS longitude, {s('l_suppkey')} AS airline_icao, {s('s_nationkey')} AS origin_airport_iata,
        CAST(round({haversine(lat('c_custkey'), lon('c_custkey'), 'a.latitude', 'a.longitude')}, 3) AS FLOAT) AS actual_distance,
        {s('c_nationkey')} AS destination_airport_iata, {s('l_suppkey')} AS airline_iata, {s('l_partkey')} AS aircraft_code,
        CASE WHEN p_type <> 'PROMO' THEN p_name END AS aircraft_model, {ep('o_orderdate')} AS departure_time,
        CASE WHEN l_linestatus <> 'O' THEN {ep('l_shipdate')} END AS departure_arrival,
        CASE WHEN l_linestatus <> 'O' THEN {DUR} END AS flight_duration
        FROM lines LEFT JOIN airport_raw a ON {s('s_nationkey')} = a.iata WHERE o_orderstatus = 'O' AND l_returnflag <> 'R'""",
    "flights_over_country": f"""SELECT z.zone_country AS country, z.continent, f.flight_id AS id_flight
        FROM acflight_raw f JOIN znctyn_raw z
        ON f.latitude > least(z.latitude + {X.COUNTRY_BOX_HALF_LAT}, z.latitude - {X.COUNTRY_BOX_HALF_LAT})
        AND f.latitude < greatest(z.latitude + {X.COUNTRY_BOX_HALF_LAT}, z.latitude - {X.COUNTRY_BOX_HALF_LAT})
        AND f.longitude > least(z.longitude - {X.COUNTRY_BOX_HALF_LON}, z.longitude + {X.COUNTRY_BOX_HALF_LON})
        AND f.longitude < greatest(z.longitude - {X.COUNTRY_BOX_HALF_LON}, z.longitude + {X.COUNTRY_BOX_HALF_LON})""",
    "flights_over_country_wrapped": f"""SELECT z.zone_country AS country, z.continent, f.flight_id AS id_flight
        FROM acflight_raw f JOIN znctyn_raw z
        ON f.latitude > z.latitude - {X.COUNTRY_BOX_HALF_LAT} AND f.latitude < z.latitude + {X.COUNTRY_BOX_HALF_LAT}
        AND ((f.longitude > z.longitude - {X.COUNTRY_BOX_HALF_LON} AND f.longitude < z.longitude + {X.COUNTRY_BOX_HALF_LON})
          OR (f.longitude > z.longitude - {X.COUNTRY_BOX_HALF_LON} + 360 AND f.longitude < z.longitude + {X.COUNTRY_BOX_HALF_LON} + 360)
          OR (f.longitude > z.longitude - {X.COUNTRY_BOX_HALF_LON} - 360 AND f.longitude < z.longitude + {X.COUNTRY_BOX_HALF_LON} - 360))""",
    "customers_within_radius": f"""SELECT c_custkey, zone_country, round(km, 6) AS distance_km FROM (
        SELECT p.c_custkey, z.zone_country, {haversine('p.latitude', 'p.longitude', 'z.latitude', 'z.longitude')} AS km
        FROM cust_pos p CROSS JOIN znctyn_raw z) WHERE km <= {X.RADIUS_M / 1000}""",
    "skip_bad_zones": f"""SELECT r_name AS zone, NULL AS bad_record FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        UNION ALL SELECT n_name, NULL FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal >= 0
        UNION ALL SELECT c_name, NULL FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal >= 0
        UNION ALL SELECT NULL, '{{"' || n_name || '":{{"br_x":"unknown","br_y":' || ({lat_h('n_nationkey')} - {NATION_H})
          || ',"tl_x":' || ({lon_h('n_nationkey')} - {NATION_H}) || ',"tl_y":' || ({lat_h('n_nationkey')} + {NATION_H}) || '}}}}'
        FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE NOT c_acctbal >= 0""",
    "landed_details_apart": f"""SELECT {s('o_orderkey')} AS flight_id, {s('o_custkey')} AS airline_icao, o_orderpriority AS aircraft_code,
        {s('o_custkey')} AS origin_airport_iata, {ep('o_orderdate')} AS departure_time,
        CASE WHEN o_orderstatus <> 'O' THEN {ep('o_orderdate')} + 60 END AS departure_arrival, o_orderpriority AS aircraft_model,
        CAST(NULL AS VARCHAR) AS flight_duration, {lat('o_orderkey')} AS last_position_latitude,
        {lon('o_orderkey')} AS last_position_longitude, CAST(1000 AS INTEGER) AS last_position_altitude
        FROM orders WHERE o_orderpriority <> '5-LOW'""",
    # cleaning
    "drop_duplicates": f"""SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
        l_returnflag, l_linestatus, {ep('l_shipdate')} AS l_shipdate_epoch
        FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 1)""",
    "lowercase_columns": "SELECT lower(country) AS country, lower(continent) AS continent, id_flight FROM flctry_raw",
    "fill_nulls_by_type": """SELECT coalesce(flight_id, '') AS flight_id, coalesce(airline_icao, '') AS airline_icao,
        coalesce(aircraft_code, '') AS aircraft_code, coalesce(origin_airport_iata, '') AS origin_airport_iata,
        coalesce(departure_time, 0) AS departure_time, coalesce(departure_arrival, 0) AS departure_arrival,
        coalesce(aircraft_model, '') AS aircraft_model, coalesce(flight_duration, '') AS flight_duration,
        coalesce(last_position_latitude, 0.0) AS last_position_latitude,
        coalesce(last_position_longitude, 0.0) AS last_position_longitude,
        coalesce(last_position_altitude, 0) AS last_position_altitude FROM flight_raw""",
    "fill_nulls_subset": "SELECT flight_id, coalesce(airline_icao, '') AS airline_icao, aircraft_code, origin_airport_iata, "
                         "aircraft_model, flight_duration FROM flight_raw",
    "filter_valid_flights": "SELECT flight_id, airline_icao, origin_airport_iata, departure_time, aircraft_model FROM flight_raw "
                            "WHERE airline_icao <> '' AND departure_time IS NOT NULL "
                            "AND (aircraft_model IS NOT NULL OR aircraft_model <> '') AND origin_airport_iata <> ''",
    "rename_columns": "SELECT * RENAME (departure_time AS departure_origin) FROM acflight_raw",
    "cast_distance": "SELECT flight_id, CAST(trunc(actual_distance) AS INTEGER) AS actual_distance FROM acflight_raw",
    "select_columns": "SELECT flight_id, airline_icao, origin_airport_iata, destination_airport_iata FROM acflight_raw",
    "where_sql_string": 'SELECT "Name", continent_origin FROM regional',
    "filter_not_null": "SELECT flight_id, airline_icao, departure_arrival, origin_airport_iata, aircraft_model FROM flight_raw "
                       "WHERE airline_icao IS NOT NULL AND departure_arrival IS NOT NULL",
    # joins
    "join_airline": 'SELECT f.flight_id, f.airline_icao, a."Name", a."Code" FROM acflight_c f JOIN airlines_c a ON f.airline_icao = a."ICAO"',
    "join_role_playing_dims": """SELECT f.flight_id, f.origin_airport_iata, f.destination_airport_iata,
        o.country AS country_origin, zo.continent AS continent_origin, d.country AS country_destination, zd.continent AS continent_destination
        FROM acflight_c f LEFT JOIN airport_c o ON f.origin_airport_iata = o.iata LEFT JOIN znctyn_c zo ON o.country = zo.zone_country
        LEFT JOIN airport_c d ON f.destination_airport_iata = d.iata LEFT JOIN znctyn_c zd ON d.country = zd.zone_country""",
    "join_origin_airport": "SELECT f.flight_id, f.origin_airport_iata, a.country, a.name FROM flight_c f JOIN airport_c a ON f.origin_airport_iata = a.iata",
    "join_by_country_m2m": f"SELECT c.continent, CAST(count(*) AS DECIMAL(38,0)) AS joined_rows, {exact_mean('fa.flight_length')} AS mean_flight_length "
                           "FROM fa JOIN flctry_c c ON fa.country = c.country GROUP BY c.continent",
    "join_flight_country": 'SELECT flight_id, "Name", country, continent FROM fc',
    "full_outer_counts": "SELECT * FROM flow",
    "lookup_by_collected_key": "SELECT w.airport_iata, min(a.name) AS name FROM (SELECT origin_airport_iata AS airport_iata, "
                               "count(*) AS n FROM acflight_c GROUP BY 1 ORDER BY n DESC, airport_iata NULLS FIRST LIMIT 1) w "
                               "LEFT JOIN airport_c a ON w.airport_iata = a.iata GROUP BY w.airport_iata",
    # aggregates, ranking
    "count_star_by_key": "SELECT origin_airport_iata, count(*) AS flight_count FROM acflight_c GROUP BY 1",
    "mean_by_key": f"SELECT origin_airport_iata, {exact_mean('departure_arrival - departure_origin')} AS mean_flight_length "
                   "FROM flight_c GROUP BY 1",
    "grouped_count_shorthand": "SELECT split_part(aircraft_model, ' ', 1) AS aircraft_type, count(*) AS \"count\" FROM acflight_c GROUP BY 1",
    "count_col_multi_key": 'SELECT "Name", country, aircraft_model, count(flight_id) AS model_count FROM fc GROUP BY ALL',
    "count_dict_form": "SELECT destination_airport_iata, count(*) AS num_inbound_flights FROM acflight_c GROUP BY 1",
    "dense_rank_topn_per_group": "SELECT * FROM (SELECT origin_airport_iata, aircraft_model, count(flight_id) AS model_count, "
                                 "CAST(dense_rank() OVER (PARTITION BY origin_airport_iata ORDER BY count(flight_id) DESC) AS INTEGER) AS model_rank "
                                 "FROM acflight_c GROUP BY 1, 2) WHERE model_rank <= 3",
    "order_by_desc": "SELECT airline_icao, count(*) AS flight_count FROM acflight_c GROUP BY 1 ORDER BY flight_count DESC, airline_icao",
    "top1_row": "SELECT destination_airport_iata, count(*) AS flight_count FROM acflight_c GROUP BY 1 "
                "ORDER BY flight_count DESC, destination_airport_iata NULLS FIRST LIMIT 1",
    "top_k_limit": "SELECT aircraft_model, count(*) AS flight_count FROM acflight_c GROUP BY 1 "
                   "ORDER BY flight_count DESC, aircraft_model NULLS FIRST LIMIT 5",
}


def oracle_sql() -> dict[str, str]:
    return {k: with_base(v) for k, v in SQL.items()}

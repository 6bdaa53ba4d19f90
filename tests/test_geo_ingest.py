import json
import random

import pytest
from pyspark.sql import functions as F

from flightlake import schemas
from flightlake.functions.geo import haversine_km, radius_to_half_widths
from flightlake.operators import ingest as E
from flightlake.operators.range_join import point_in_box_join
from flightlake.sources.landed_json import read_landed_json


def _boxes(spark):
    rows = [("asia", 80.0, 40.0, -10.0, 180.0, 0), ("europe", 72.0, -25.0, 33.0, 45.0, 1),
            ("inner", 60.0, 10.0, 40.0, 30.0, 2)]
    return spark.createDataFrame(rows, "zone string, tl_y double, tl_x double, br_y double, br_x double, zone_ord int")


def test_point_in_box_edges(spark):
    pts = spark.createDataFrame([("on_edge", 72.0, 0.0), ("two_boxes", 50.0, 20.0), ("none", -80.0, 0.0),
                                 ("corner", 33.0, -25.0), ("inside", 50.0, 0.0)],
                                "name string, latitude double, longitude double")
    got = sorted((r.name, r.zone_name) for r in E.locate_in_zones(pts, _boxes(spark)).collect())
    assert got == [("inside", "europe"), ("two_boxes", "europe"), ("two_boxes", "inner")]


BOX = "bid int, tl_y double, tl_x double, br_y double, br_x double"
KW = dict(lat="plat", lon="plon")


def nested_loop(pts, boxes):
    """Every point against every box, in plain Python."""
    out = []
    for p in pts:
        for b in boxes:
            if min(b[1], b[3]) < p[1] < max(b[1], b[3]) and min(b[2], b[4]) < p[2] < max(b[2], b[4]):
                out.append((p[0], b[0]))
    return sorted(out)


def grid_pairs(spark, pts, boxes):
    p = spark.createDataFrame(pts, "pid int, plat double, plon double")
    return sorted(tuple(r) for r in point_in_box_join(p, spark.createDataFrame(boxes, BOX), **KW).select("pid", "bid").collect())


def test_grid_equals_nested_loop_random(spark):
    rnd = random.Random(3)
    pts = [(i, float(rnd.randint(-9000, 9000)) / 100, float(rnd.randint(-18000, 18000)) / 100) for i in range(3000)]
    boxes = []
    for j in range(40):
        y, x = rnd.uniform(-80, 80), rnd.uniform(-170, 170)
        boxes.append((j, y + rnd.uniform(0, 30), x - rnd.uniform(0, 40), y - rnd.uniform(0, 30), x + rnd.uniform(0, 40)))
    assert grid_pairs(spark, pts, boxes) == nested_loop(pts, boxes)


@pytest.mark.parametrize("n", [21, 101])
def test_grid_with_pole_and_world_box(spark, n):
    """The same plan for few and many boxes, whatever their sizes: 500 m boxes, one at the pole, one around the world."""
    rnd = random.Random(n)
    centres = [(j, rnd.uniform(-80, 80), rnd.uniform(-170, 170)) for j in range(n - 2)] + [(n - 2, 90.0, 15.0)]
    c = spark.createDataFrame(centres, "bid int, y double, x double")
    half_lat, half_lon = radius_to_half_widths(F.lit(500.0), F.col("y"))
    box = c.select("bid", (F.col("y") + half_lat).alias("a"), (F.col("x") - half_lon).alias("b"),
                   (F.col("y") - half_lat).alias("c"), (F.col("x") + half_lon).alias("d"))
    boxes = [tuple(r) for r in box.collect()] + [(n - 1, 90.0, -180.0, -90.0, 180.0)]
    pts = [(i, y + rnd.uniform(-0.006, 0.006), x + rnd.uniform(-0.006, 0.006)) for i, (_, y, x) in enumerate(centres)]
    pts += [(1000 + i, 89.999, -170.0 + i) for i in range(20)] + [(2000 + i, rnd.uniform(-89, 89), rnd.uniform(-179, 179)) for i in range(200)]
    got = grid_pairs(spark, pts, boxes)
    assert got == nested_loop(pts, boxes)
    assert {p for p, b in got if b == n - 2} >= {1000 + i for i in range(20)}      # all around the pole
    assert len([1 for _, b in got if b == n - 1]) == len([p for p in pts if p[1] < 90])


def test_boxes_become_few_cells(spark):
    from flightlake.operators.range_join import LEVELS, MAX_CELLS_PER_BOX, cell_of, level_of
    rnd = random.Random(5)
    extents = [0.0, 1e-9, 0.005, 0.0055, 0.01, 1.0, 44.9, 45.0, 90.0, 180.0, 360.0]
    rows = [(y, x, e, e * r) for e in extents for r in (1.0, 0.3) for y, x in [(rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for _ in range(20)]]
    df = spark.createDataFrame(rows, "y double, x double, h double, w double").withColumn("l", level_of(F.greatest("h", "w")))
    cells = lambda c, s, limit: cell_of(F.col(c) + F.col(s), limit, F.col("l")) - cell_of(F.col(c), limit, F.col("l")) + 1
    out = df.select("l", (cells("y", "h", 90.0) * cells("x", "w", 180.0)).alias("n")).collect()
    assert max(r.n for r in out) <= MAX_CELLS_PER_BOX and max(r.l for r in out) == LEVELS - 1


def test_no_action_while_a_range_join_is_planned(spark):
    pts = spark.createDataFrame([(1, 1.0, 1.0)], "pid int, plat double, plon double")
    tracker, jobs = spark.sparkContext.statusTracker(), "range-join-plan"
    spark.sparkContext.setJobGroup(jobs, "planning")
    point_in_box_join(pts, spark.createDataFrame([(0, 2.0, 0.0, 0.0, 2.0)], BOX), **KW)
    assert not tracker.getJobIdsForGroup(jobs)
    spark.sparkContext.setJobGroup("rest", "")


def test_haversine_known_distance(spark):
    df = spark.createDataFrame([(48.8566, 2.3522, 51.5074, -0.1278)], "a double, b double, c double, d double")
    km = df.select(haversine_km("a", "b", "c", "d").alias("km")).first().km
    assert km == pytest.approx(343.56, abs=0.5)


def test_radius_half_widths(spark):
    df = spark.createDataFrame([(111_320.0, 60.0)], "r double, lat double")
    hl, hn = radius_to_half_widths("r", "lat")
    r = df.select(hl.alias("a"), hn.alias("b")).first()
    assert r.a == pytest.approx(1.0) and r.b == pytest.approx(2.0)


def test_first_match_per_country_independent_of_partitioning(spark):
    m = spark.createDataFrame([("fr", 3, 1, "europe", 1.0), ("fr", 1, 2, "asia", 2.0), ("fr", 1, 0, "africa", 3.0),
                               ("de", 5, 0, "europe", 4.0)],
                              "country string, airport_ord int, zone_ord int, continent string, lat double")
    for n in (1, 3):
        got = {(r.country, r.continent, r.lat) for r in
               E.first_match_per_country(m.repartition(n), "country", ["continent", "lat"],
                                         ["airport_ord", "zone_ord"]).collect()}
        assert got == {("fr", "africa", 3.0), ("de", "europe", 4.0)}


ZONES = {
    "europe": {"tl_y": 72, "tl_x": -25, "br_x": 45, "br_y": 33, "subzones": {
        "france": {"tl_y": 51.2, "tl_x": -5, "br_x": 8, "br_y": 42, "subzones": {
            "paris": {"tl_y": 49, "tl_x": 2, "br_x": 3, "br_y": 48}}},
        "germany": {"tl_y": 55, "tl_x": 5, "br_x": 15, "br_y": 47}}},
    "africa": {"tl_y": 38, "tl_x": -20, "br_x": 55, "br_y": -36},
}


def test_flatten_zones_three_levels(spark):
    docs = spark.createDataFrame([(json.dumps(ZONES),)], "value string")
    cont, ctry, city = E.flatten_zones(docs)
    assert sorted(r.zone for r in cont.collect()) == ["africa", "europe"]
    assert sorted((r.zone, r.continent) for r in ctry.collect()) == [("france", "europe"), ("germany", "europe")]
    assert [(r.zone, r.country, r.tl_y) for r in city.collect()] == [("paris", "france", 49.0)]
    assert dict(cont.dtypes)["tl_y"] == "double"


def test_cast_zones_from_text(spark):
    df = spark.createDataFrame([("z", "1", "2", "3", "4")], "zone string, tl_y string, tl_x string, br_x string, br_y string")
    assert set(dict(E.cast_zones(df).dtypes).values()) == {"string", "double"}


def test_project_airports_types(spark):
    df = spark.createDataFrame([(45.5, 2.25, 120.7, "Paris", "LFPG", "CDG", "France")], schemas.AIRPORT_DOC)
    out = E.project_airports(df)
    assert out.dtypes == spark.createDataFrame([], schemas.AIRPORT).dtypes
    assert out.first().altitude == 120


FLIGHT_LINES = [
    {"id": "f1", "airline_icao": "AFR", "code": "A320", "origin_airport_iata": "CDG", "latitude": 45, "longitude": 2.5,
     "details": {"aircraft": {"model": {"text": "Airbus A320"}}, "time": {"real": {"departure": 100, "arrival": 200},
                 "historical": {"flighttime": "100"}}, "status": {"live": True},
                 "trail": [{"lat": 1.0, "lng": 2.0, "alt": 10}, {"lat": 3.0, "lng": 4.0, "alt": 30}]}},
    {"id": "f2", "airline_icao": "BAW", "details": {"time": {"real": None}, "trail": [{"lat": 5, "lng": 6, "alt": 7}]}},
    {"id": "f3", "airline_icao": "BAW", "details": {"status": {"live": False}, "trail": []}},
    {"id": "f4", "details": {"aircraft": {"model": {"text": ""}}, "trail": [{"lat": 5.5, "lng": 6.5, "alt": 8}]}},
]


def _landed(spark, tmp_out, bad_line=True):
    path = f"{tmp_out}/flights"
    import os
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part-0.json", "w") as fh:
        for d in FLIGHT_LINES:
            fh.write(json.dumps(d) + "\n")
        if bad_line:
            fh.write('{"id": "broken", "details": {\n')
    return read_landed_json(spark, path, schemas.FLIGHT_DOC)


def test_flatten_flights_and_quarantine(spark, tmp_out):
    df = _landed(spark, tmp_out).cache()
    good, bad = E.split_bad_records(df)
    assert [r[schemas.CORRUPT_COLUMN] for r in bad.select("id", schemas.CORRUPT_COLUMN).collect()] == [
        '{"id": "broken", "details": {']
    flat = {r.flight_id: r for r in E.flatten_flights(good).collect()}
    assert set(flat) == {"f1", "f2", "f4"}            # f3 has an empty trail
    assert flat["f1"].last_position_latitude == 3.0 and flat["f1"].last_position_altitude == 30
    assert flat["f1"].aircraft_model == "Airbus A320"
    assert flat["f2"].departure_time is None and flat["f2"].aircraft_model is None   # real: null, no aircraft
    assert flat["f4"].aircraft_model == ""
    first = {r.flight_id: r.aircraft_model for r in E.flatten_flights(good, first_char_only=True).collect()}
    assert first == {"f1": "A", "f2": None, "f4": None}
    assert E.flatten_flights(good, keep_without_trail=True).count() == 4
    df.unpersist()


def test_live_subset_and_distance(spark, tmp_out):
    good, _ = E.split_bad_records(_landed(spark, tmp_out, bad_line=False))
    live = E.live_subset(good)
    assert [r.id for r in live.collect()] == ["f1"]
    flying = F.struct(F.lit(True).alias("live"))
    assert [r.id for r in E.live_subset(good.withColumn("details", F.col("details").withField("status", flying))).collect()] == ["f1", "f2", "f4"]    # f3: no trail
    ap = spark.createDataFrame([(45.0, 2.5, 10, "x", "LFPG", "CDG", "fr")], schemas.AIRPORT)
    withd = E.distance_from_origin(good, ap)
    d = {r.id: r.actual_distance for r in withd.collect()}
    assert d["f1"] == pytest.approx(0.0, abs=1e-9) and d["f2"] is None
    ac = E.acflight_projection(E.distance_from_origin(live, ap))
    assert ac.dtypes == spark.createDataFrame([], schemas.ACFLIGHT).dtypes


def test_last_trail_point_empty_is_null(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([],), (None,)], "t array<int>")
    assert [r.x for r in df.select(E.last_trail_point("t").alias("x")).collect()] == [3, None, None]


def test_flights_over_country_multi_match(spark):
    pts = spark.createDataFrame([("fr", 10.0, 10.0, "europe"), ("de", 12.0, 12.0, "europe")],
                                "zone_country string, latitude double, longitude double, continent string")
    fl = spark.createDataFrame([("f1", 11.0, 11.0), ("f2", 14.5, 14.5), ("f3", 50.0, 50.0)],
                               "flight_id string, latitude double, longitude double")
    got = sorted(tuple(r) for r in E.flights_over_country(pts, fl, F.lit(3.0), F.lit(3.0)).collect())
    assert got == [("de", "europe", "f1"), ("de", "europe", "f2"), ("fr", "europe", "f1")]


def test_first_match_order_and_exact_doubles(spark):
    """File name first, then row, then zone; the point keeps its double (not rounded to float32)."""
    rows = [("FR", ("b", 0), 1, 1.0), ("FR", ("a", 7), 1, 2.0), ("FR", ("a", 5), 2, 49.0097), ("FR", ("a", 5), 1, 49.0097), (None, ("z", 1), 1, 3.0)]
    df = spark.createDataFrame(rows, "country string, ord struct<file:string,row:long>, zone int, latitude double")
    got = {r.country: (r.latitude, r.zone) for r in E.first_match_per_country(df, "country", ["latitude", "zone"], ["ord", "zone"]).collect()}
    assert got == {"FR": (49.0097, 1), None: (3.0, 1)}


def test_grid_join_with_hot_cell(spark):
    """A third of all points sit at one coordinate (one hot cell): same pairs
    as the nested loop, no pair lost or repeated."""
    rnd = random.Random(11)
    hot = [(i, 48.85, 2.35) for i in range(1000)]
    rest = [(1000 + i, rnd.uniform(-89, 89), rnd.uniform(-179, 179)) for i in range(2000)]
    boxes = [(0, 50.0, 2.0, 48.0, 3.0), (1, 49.0, 2.3, 48.8, 2.4), (2, 10.0, 10.0, -10.0, 30.0)]
    grid = grid_pairs(spark, hot + rest, boxes)
    assert grid == nested_loop(hot + rest, boxes) and len([p for p in grid if p[0] < 1000]) == 2000


def great_circle_km(a, b, c, d):
    import math
    p, q = math.radians(a), math.radians(c)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(h))


def test_radius_join_equals_spherical_nested_loop(spark):
    """J8: points and circles around the date line and the poles, of 1 m to more than a hemisphere."""
    from flightlake.operators.range_join import within_radius_join
    rnd = random.Random(7)

    def place():
        lat = rnd.choice([rnd.uniform(-89, 89), rnd.uniform(88, 90), rnd.uniform(-90, -88), 90.0, -90.0, 0.0])
        lon = rnd.choice([rnd.uniform(-180, 180), rnd.uniform(178, 180), rnd.uniform(-180, -178), 180.0, -180.0])
        return lat, lon

    pts = [(i, *place()) for i in range(600)]
    circles = [(j, *place(), rnd.choice([1.0, 5_000.0, 100_000.0, 900_000.0, 4_000_000.0, 12_000_000.0])) for j in range(60)]
    circles += [(100, 0.0, 179.9, 100_000.0), (101, 10.0, -180.0, 50_000.0)]
    pts += [(1000, 0.0, -179.9), (1001, 10.0, 180.0)]
    p = spark.createDataFrame(pts, "pid int, latitude double, longitude double")
    c = spark.createDataFrame(circles, "cid int, centre_latitude double, centre_longitude double, r double")
    got = sorted(tuple(r) for r in within_radius_join(p, c, "r").select("pid", "cid").collect())
    want = sorted((i, j) for i, a, b in pts for j, y, x, r in circles if great_circle_km(a, b, y, x) <= r / 1000)
    assert got == want and (1000, 100) in got and (1001, 101) in got


def test_flights_over_the_date_line(spark):
    pts = spark.createDataFrame([("fj", 0.0, 179.9, "oceania"), ("ws", 0.0, -179.95, "oceania")],
                                "zone_country string, latitude double, longitude double, continent string")
    fl = spark.createDataFrame([("east", 0.0, 179.5), ("line", 0.0, 180.0), ("line2", 0.0, -180.0), ("west", 0.0, -179.9), ("far", 0.0, -178.0)],
                               "flight_id string, latitude double, longitude double")
    half = [F.lit(1.0), F.lit(0.5)]
    got = sorted((r.country, r.id_flight) for r in E.flights_over_country(pts, fl, *half).collect())
    near = ["east", "line", "line2", "west"]
    assert got == [("fj", f) for f in near] + [("ws", f) for f in near[1:]]
    assert {(r.country, r.id_flight) for r in E.flights_over_country(pts, fl, *half, wrap=False).collect()} == {
        ("fj", "east"), ("fj", "line"), ("ws", "line2"), ("ws", "west")}


def test_coarse_levels_are_salted(spark):
    """J7: a world box and hot coarse cells, nothing broadcast, no skew rule: no task has over 3x the median."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    rnd = random.Random(2)
    pts = [(i, rnd.uniform(-80, 80), rnd.uniform(-170, 170)) for i in range(4000)] + [(4000 + i, 48.85, 2.35) for i in range(2000)]
    boxes = [(0, 90.0, -180.0, -90.0, 180.0), (1, 80.0, -25.0, 33.0, 45.0), (2, 60.0, 0.0, 40.0, 20.0)]
    try:
        for k, v in zip(old, ("-1", "false", "16")):
            spark.conf.set(k, v)
        p = spark.createDataFrame(pts, "pid int, plat double, plon double").repartition(4, "pid")
        out = point_in_box_join(p, spark.createDataFrame(boxes, BOX), **KW)
        sizes = sorted(r["count"] for r in out.where("bid = 0").groupBy(F.spark_partition_id()).count().collect())
        pairs = sorted((r.pid, r.bid) for r in out.collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(sizes) == 16 and sizes[-1] <= 3 * sizes[len(sizes) // 2]
    assert pairs == nested_loop(pts, boxes)


def test_first_zone_of_countries(spark):
    """E5: the first point in a zone, its first zone; points in no zone don't count, null countries are one."""
    zones = spark.createDataFrame([("low", 10.0, 0.0, 0.0, 10.0, 1), ("high", 20.0, 0.0, 0.0, 20.0, 0), ("far", -50.0, 0.0, -60.0, 10.0, 2)],
                                  "zone string, tl_y double, tl_x double, br_y double, br_x double, zone_ord int")
    pts = spark.createDataFrame([("fr", 7, 5.0, 5.0), ("fr", 3, 15.0, 15.0), ("fr", 1, 80.0, 80.0), ("de", 9, -55.0, 5.0), (None, 4, 5.0, 5.0), ("es", 2, 80.0, 0.0)],
                                "country string, ord long, latitude double, longitude double")
    want = {("fr", 15.0, "high"), ("de", -55.0, "far"), (None, 5.0, "high")}
    for n in (1, 3):
        got = E.first_zone_per_country(pts.repartition(n, "ord"), zones, "country", ["latitude"], "ord").collect()
        assert {tuple(r) for r in got} == want and len(got) == 3


def test_landing_rank_follows_files_and_lines(spark, tmp_out):
    import os
    from flightlake.sources.landed_json import landing_rank
    os.makedirs(f"{tmp_out}/docs")
    for name, ids in (("b", range(5)), ("a", range(10, 400)), ("c", [900])):
        with open(f"{tmp_out}/docs/{name}.json", "w") as fh:
            fh.writelines(json.dumps({"iata": str(i)}) + "\n" + "\n" * (i % 3 == 0) for i in ids)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")          # the long file is read by several tasks
    try:
        df = read_landed_json(spark, f"{tmp_out}/docs", schemas.AIRPORT_DOC, keep_corrupt=False, with_position=True)
        df.write.parquet(f"{tmp_out}/staged")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = landing_rank(spark.read.parquet(f"{tmp_out}/staged")).orderBy("landed_rank").collect()
    assert [int(r.iata) for r in got] == [*range(10, 400), *range(5), 900]
    assert len({r.landed_rank for r in got}) == len(got) and got[0].landed_rank == 0


def test_bad_zone_goes_alone(spark):
    """E11: a corner that is no number takes its zone out, with its text; the other zones stay, those below it too."""
    doc = {"eu": {"tl_y": 72, "tl_x": "-25", "br_x": "abc", "br_y": 33, "subzones": {"fr": {"tl_y": 51.5, "tl_x": -5, "br_x": 8, "br_y": 42},
                                                                                  "de": {"tl_y": None, "tl_x": 5, "br_x": 15, "br_y": 47}}},
           "af": {"tl_y": "38", "tl_x": -20, "br_x": 55, "br_y": -36, "subzones": 5}, "na": {"tl_x": 1}}
    docs = spark.createDataFrame([(json.dumps(doc),), ("{broken",)], "value string")
    good, bad_docs = E.split_bad_zones(docs)
    assert [r.value for r in bad_docs.collect()] == ["{broken"]
    cont, ctry, city = E.flatten_zones(good)
    assert [(r.zone, r.tl_y) for r in cont.collect()] == [("af", 38.0)]
    assert [(r.zone, r.continent, r.tl_y) for r in ctry.collect()] == [("fr", "eu", 51.5)] and city.count() == 0
    records = [json.loads(r.record) for r in E.bad_zone_records(good).collect()]
    assert sorted(k for r in records for k in r) == ["af", "de", "eu", "na"]
    assert {"eu": doc["eu"]} in records and {"de": doc["eu"]["subzones"]["de"]} in records

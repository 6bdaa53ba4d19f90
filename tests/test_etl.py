import json
import os

from flightlake import schemas
from flightlake.plans import etl as P
from flightlake.sources.parquet import read_latest_snapshot

ZONES = {
    "europe": {"tl_y": 72, "tl_x": -25, "br_x": 45, "br_y": 33, "subzones": {
        "france": {"tl_y": 51.2, "tl_x": -5, "br_x": 8, "br_y": 42,
                   "subzones": {"paris": {"tl_y": 49, "tl_x": 2, "br_x": 3, "br_y": 48}}}}},
    "northamerica": {"tl_y": 75, "tl_x": -170, "br_x": -50, "br_y": 10},
    "africa": {"tl_y": 38, "tl_x": -20, "br_x": 55, "br_y": -36},
}
AIRLINES = [{"Name": "Air France", "Code": "AF", "ICAO": "AFR"}, {"Name": "British Airways", "Code": None, "ICAO": "BAW"},
            {"Name": "Air France", "Code": "AF", "ICAO": "AFR"}]
AIRPORTS = [
    {"latitude": 49.0, "longitude": 2.5, "altitude": 392, "name": "Paris CDG", "icao": "LFPG", "iata": "CDG", "country": "France"},
    {"latitude": 48.7, "longitude": 2.4, "altitude": 291, "name": "Paris Orly", "icao": "LFPO", "iata": "ORY", "country": "France"},
    {"latitude": 51.5, "longitude": -0.5, "altitude": 83, "name": "Heathrow", "icao": "EGLL", "iata": "LHR", "country": "United Kingdom"},
    {"latitude": 40.6, "longitude": -73.8, "altitude": 13, "name": "JFK", "icao": "KJFK", "iata": "JFK", "country": "United States"},
    {"latitude": -80.0, "longitude": 0, "altitude": 10, "name": "Pole", "icao": "XPOL", "iata": "", "country": "Antarctica"},
]


def flight(fid, airline, org, dst, live, lat, lon, model="Airbus A320", dep=1000, arr=5000, trail=True):
    return {"id": fid, "airline_icao": airline, "airline_iata": airline[:2], "code": "A320", "origin_airport_iata": org,
            "destination_airport_iata": dst, "latitude": lat, "longitude": lon,
            "details": {"aircraft": {"model": {"text": model}}, "time": {"real": {"departure": dep, "arrival": arr},
                        "historical": {"flighttime": str(arr - dep)}}, "status": {"live": live},
                        "trail": [{"lat": lat, "lng": lon, "alt": 30000}] if trail else []}}


FLIGHTS = [
    flight("f1", "AFR", "CDG", "LHR", True, 50.0, 1.0),
    flight("f2", "AFR", "CDG", "JFK", True, 45.0, -40.0, model="Boeing 777"),
    flight("f3", "BAW", "LHR", "CDG", True, 50.5, 0.5),
    flight("f4", "BAW", "LHR", "JFK", False, 52.0, -20.0),
    flight("f5", "AFR", "ORY", "CDG", True, 48.0, 2.0, trail=False),
]


def land(root, bad=True):
    for name, docs in [("airlines", AIRLINES), ("zones", [ZONES]), ("airports", AIRPORTS), ("flights", FLIGHTS)]:
        os.makedirs(f"{root}/{name}", exist_ok=True)
        with open(f"{root}/{name}/part-0.json", "w") as fh:
            for d in docs:
                fh.write(json.dumps(d) + "\n")
            if bad:
                fh.write("{not json %s\n" % name)


def test_extract_then_transform(spark, tmp_out):
    landing, lake, results = f"{tmp_out}/landing", f"{tmp_out}/lake", f"{tmp_out}/results"
    land(landing)
    quarantine = P.extract(spark, landing, lake, run_ts="2024-05-01 08:00:00", radius_m=600_000)
    for kind in P.DOCUMENT_KINDS:                                                     # stored beside the snapshots
        assert [r.record for r in quarantine[kind].collect()] == [f"{{not json {kind}"], kind
        assert [r.record for r in read_latest_snapshot(spark, P.quarantine_root(lake, kind)).collect()] == [f"{{not json {kind}"]
    for name in P.DATASETS:
        assert os.path.isdir(P.dataset_root(lake, name)), name
    lat = lambda n: read_latest_snapshot(spark, P.dataset_root(lake, n), schemas.TABLES[n])
    zn = {r.zone_country: r for r in lat("znctyn").collect()}
    assert set(zn) == {"France", "United Kingdom", "United States"}
    assert zn["France"].continent == "europe" and zn["France"].altitude == 392       # first airport wins
    assert sorted(r.zone for r in lat("zncty").collect()) == ["paris"]
    assert lat("flight").count() == 4                                                 # f5 has no trail
    assert sorted(r.flight_id for r in lat("acflight").collect()) == ["f1", "f2", "f3"]      # nor f5
    run_times = {r.snapshot_ts for n in P.DATASETS for r in lat(n).select("snapshot_ts").distinct().collect()}
    assert len(run_times) == 1                                                        # one run, one time
    answers = P.transform(spark, lake, results)
    r1 = [tuple(r) for r in answers["R1"].collect()]
    assert r1 == [("air france", 2), ("british airways", 1)]
    assert answers["R3"].first().flight_id == "f2"
    for name in P.REPORT_FILES.values():
        found = [f for _, _, files in os.walk(f"{results}/{name}/rawzone") for f in files if f.endswith(".csv")]
        assert len(found) == 1, name
    answers.close()


def test_rerun_of_a_run_gives_the_same_tables(spark, tmp_out):
    landing, lake = f"{tmp_out}/landing", f"{tmp_out}/lake"
    land(landing)
    for _ in range(2):
        P.extract(spark, landing, lake, run_ts="2024-05-01 08:00:00", radius_m=600_000)
    assert read_latest_snapshot(spark, P.dataset_root(lake, "flight"), schemas.FLIGHT).count() == 4
    assert read_latest_snapshot(spark, P.quarantine_root(lake, "zones")).count() == 1


def test_later_landing_is_read_whole(spark, tmp_out):
    """A second run reads all landed files, the earlier ones too."""
    landing, lake = f"{tmp_out}/landing", f"{tmp_out}/lake"
    land(landing)
    P.extract(spark, landing, lake, run_ts="2024-05-01 08:00:00", radius_m=600_000)
    with open(f"{landing}/airlines/part-1.json", "w") as fh:
        fh.write(json.dumps({"Name": "Delta", "Code": "DL", "ICAO": "DAL"}) + "\n")
    P.extract(spark, landing, lake, run_ts="2024-05-01 10:00:00", radius_m=600_000)
    got = read_latest_snapshot(spark, P.dataset_root(lake, "airlines"), schemas.AIRLINES)
    assert {r.ICAO for r in got.collect()} == {"AFR", "BAW", "DAL"}


def test_reports_never_mix_runs(spark, tmp_out, monkeypatch):
    """The second run fails in one dataset: the reports read the first run whole."""
    landing, lake = f"{tmp_out}/landing", f"{tmp_out}/lake"
    land(landing)
    P.extract(spark, landing, lake, run_ts="2024-05-01 08:00:00", radius_m=600_000)
    write = P.write_parquet_snapshot

    def failing(df, root, ts=None):
        if "/Flight/" in root:
            raise OSError("disk full")
        write(df, root, ts)

    monkeypatch.setattr(P, "write_parquet_snapshot", failing)
    try:
        P.extract(spark, landing, lake, run_ts="2024-05-01 10:00:00", radius_m=600_000)
    except OSError:
        pass
    monkeypatch.undo()
    assert len({r.snapshot_ts for r in read_latest_snapshot(spark, P.dataset_root(lake, "airlines"), schemas.AIRLINES).collect()}) == 1
    from flightlake.sources.parquet import committed_run
    assert committed_run(spark, lake, P.REPORT_DATASETS) == "20240501T080000000000"
    answers = P.transform(spark, lake)
    assert [tuple(r) for r in answers["R1"].collect()] == [("air france", 2), ("british airways", 1)]
    answers.close()


def test_etl_on_driver_tables(spark, tmp_out):
    from flightlake.plans.fixtures import land_documents
    landing, root = f"{tmp_out}/landing", f"{tmp_out}/run"
    land_documents(spark, "/root/testdata/sf0.001", landing)
    answers = P.run(spark, landing, f"{root}/lake", f"{root}/results", radius_m=500_000)
    assert answers["R1"].count() > 0 and answers["R5"].count() == 5
    acf = read_latest_snapshot(spark, P.dataset_root(f"{root}/lake", "acflight"), schemas.ACFLIGHT)
    assert acf.where("actual_distance > 0").count() > 0
    for level, rows in (("zctinent", 5), ("znctry", 25), ("zncty", 25)):
        assert read_latest_snapshot(spark, P.dataset_root(f"{root}/lake", level), schemas.TABLES[level]).count() == rows
    assert read_latest_snapshot(spark, P.dataset_root(f"{root}/lake", "flctry"), schemas.FLCTRY).count() > 0


def test_first_airport_follows_landing_order_across_files(spark, tmp_out):
    landing = f"{tmp_out}/landing"
    land(landing)
    os.remove(f"{landing}/airports/part-0.json")
    first = dict(AIRPORTS[0], name="First", altitude=1)
    later = [dict(AIRPORTS[1], name=f"Later {i}", altitude=1000 + i) for i in range(200)]   # bigger file, read first
    with open(f"{landing}/airports/part-0.json", "w") as fh:
        fh.write(json.dumps(first) + "\n")
    with open(f"{landing}/airports/part-1.json", "w") as fh:
        for d in later:
            fh.write(json.dumps(d) + "\n")
    tables, _ = P.build_tables(spark, landing, radius_m=600_000)
    fr = tables["znctyn"].where("zone_country = 'France'").first()
    assert fr.altitude == 1


def test_cli_run(tmp_out):
    import subprocess
    import sys
    landing = f"{tmp_out}/landing"
    land(landing)
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run(
        [sys.executable, "-m", "flightlake", "run", "--landing", landing, "--lake", f"{tmp_out}/lake",
         "--results", f"{tmp_out}/results", "--radius-m", "600000"],
        cwd=repo, capture_output=True, text=True, timeout=600,
        env=dict(os.environ, PYSPARK_SUBMIT_ARGS="--master local[2] --conf spark.ui.enabled=false pyspark-shell"))
    assert out.returncode == 0, out.stderr[-2000:]
    assert "air france" in out.stdout


def test_details_that_land_apart_give_the_same_tables(spark, tmp_out):
    """S4: list and details in different files and orders, stale ones before; a flight without details is in no flight table."""
    def lines(path, docs):
        os.makedirs(path, exist_ok=True)
        with open(f"{path}/part-0.json", "w") as fh:
            fh.writelines(json.dumps(d) + "\n" for d in docs)

    land(f"{tmp_out}/whole", bad=False)
    land(f"{tmp_out}/apart", bad=False)
    os.remove(f"{tmp_out}/apart/flights/part-0.json")
    listed = [{k: v for k, v in f.items() if k != "details"} for f in FLIGHTS]
    details = [{"id": f["id"], "details": f["details"]} for f in FLIGHTS]
    never = dict(flight("f9", "AFR", "CDG", "LHR", True, 50.0, 1.0))
    del never["details"]
    lines(f"{tmp_out}/apart/flights/batch=1", [dict(x, airline_icao="OLD") for x in listed])
    lines(f"{tmp_out}/apart/flights/batch=2", [*listed[::-1], never])
    lines(f"{tmp_out}/apart/details/batch=1", [dict(x, details={"status": {"live": True}, "trail": [{"lat": 0, "lng": 0, "alt": 0}]}) for x in details])
    lines(f"{tmp_out}/apart/details/batch=2", details[2:] + details[:2] + [{"id": "unlisted", "details": details[0]["details"]}])
    with open(f"{tmp_out}/apart/details/batch=2/part-1.json", "w") as fh:
        fh.write("{not json\n")
    whole, _ = P.build_tables(spark, f"{tmp_out}/whole", radius_m=600_000)
    apart, quarantine = P.build_tables(spark, f"{tmp_out}/apart", radius_m=600_000)
    for name in P.DATASETS:
        rows = lambda t: sorted(map(str, t[name].where("id_flight <> 'f9'" if name == "flctry" else "true").collect()))
        assert rows(whole) == rows(apart), name
    assert apart["flctry"].where("id_flight = 'f9'").count() > 0            # the list alone says where it flies
    assert [r.record for r in quarantine["details"].collect()] == ["{not json"]


def test_bad_zone_is_quarantined_alone(spark, tmp_out):
    landing = f"{tmp_out}/landing"
    land(landing, bad=False)
    zones = json.loads(json.dumps(ZONES))
    zones["africa"]["br_x"] = "abc"
    with open(f"{landing}/zones/part-0.json", "w") as fh:
        fh.write(json.dumps(zones) + "\n")
    tables, quarantine = P.build_tables(spark, landing, radius_m=600_000)
    assert sorted(r.zone for r in tables["zctinent"].collect()) == ["europe", "northamerica"]
    assert [json.loads(r.record) for r in quarantine["zones"].collect()] == [{"africa": zones["africa"]}]


def test_readers_of_a_rerun_see_one_try(spark, tmp_out, monkeypatch):
    """A re-run of a run time that fails halfway: the reports go on with the first try of every dataset."""
    landing, lake = f"{tmp_out}/landing", f"{tmp_out}/lake"
    land(landing)
    P.extract(spark, landing, lake, run_ts="2024-05-01 08:00:00", radius_m=600_000)
    with open(f"{landing}/airlines/part-1.json", "w") as fh:
        fh.write(json.dumps({"Name": "Delta", "Code": "DL", "ICAO": "DAL"}) + "\n")
    write = P.write_parquet_snapshot

    def failing(df, root, ts=None):
        if "/Flctry/" in root:
            raise OSError("disk full")
        return write(df, root, ts)

    monkeypatch.setattr(P, "write_parquet_snapshot", failing)
    try:
        P.extract(spark, landing, lake, run_ts="2024-05-01 08:00:00", radius_m=600_000)
        raise AssertionError("the re-run must fail")
    except OSError:
        pass
    monkeypatch.undo()
    assert P.load_latest(spark, lake).airlines.count() == 3
    P.extract(spark, landing, lake, run_ts="2024-05-01 08:00:00", radius_m=600_000)
    assert P.load_latest(spark, lake).airlines.count() == 4

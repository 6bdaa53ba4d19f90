"""End to end: landed JSON -> nine snapshot tables -> seven report files.

``extract`` replaces the original extraction script (driver loops over API
objects) with Spark jobs over landed documents; ``transform`` replaces the
transformation script. The snapshot tables written by ``extract`` are the
hand-over point: they cut the lineage, so a lost executor in ``transform``
recomputes from Parquet, not from the JSON.

Landing layout (one folder per document kind, JSON lines):
    <landing>/airlines   schemas.AIRLINE_DOC
    <landing>/zones      one zones map per line (schemas.ZONES_DOC)
    <landing>/airports   schemas.AIRPORT_DOC
    <landing>/flights    schemas.FLIGHT_DOC (list entry, with its details or without)
    <landing>/details    schemas.FLIGHT_DETAILS_DOC, where details land apart from the list
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake import schemas
from flightlake.functions.geo import radius_to_half_widths
from flightlake.operators import ingest as E
from flightlake.plans import reports as R
from flightlake.session import remove_scratch, scratch_path
from flightlake.sinks.manifests import Store
from flightlake.sinks.results import write_csv_result
from flightlake.sinks.snapshots import commit_run, committed_tries, label_of, write_parquet_snapshot
from flightlake.sources.landed_json import POSITION, landing_rank, read_json_text, read_landed_json, stitch_details
from flightlake.sources.parquet import read_latest_snapshot

# --- fixed values: dataset and result folder names users already rely on ---
DATASETS = ["airlines", "zctinent", "znctry", "zncty", "airport", "znctyn", "flight", "acflight", "flctry"]
REPORT_FILES = {
    "R1": "ResultatQuestion1", "R2": "ResultatQuestion2", "R3": "ResultatQuestion3",
    "R4": "ResultatQuestion4", "R5": "ResultatQuestion5", "R6": "ResultatQuestion6",
    "R7": "ResultatQuestion7",
}
ZONE_FOLDER = "rawzone"
# answers of a fixed size: one to five rows, or one a continent
BOUNDED_REPORTS = {"R2", "R3", "R4", "R5", "R7"}
DOCUMENT_KINDS = ["airlines", "zones", "airports", "flights"]
REPORT_DATASETS = ["airlines", "znctyn", "airport", "flight", "acflight", "flctry"]


def dataset_root(lake: str, name: str) -> str:
    """<lake>/<Dataset>/rawzone: the snapshots of one dataset (partitions below)."""
    return f"{lake}/{name.capitalize()}/{ZONE_FOLDER}"


def quarantine_root(lake: str, kind: str) -> str:
    """<lake>/Quarantine/<Kind>/rawzone: the bad documents of one kind, a snapshot a run."""
    return f"{lake}/Quarantine/{kind.capitalize()}/{ZONE_FOLDER}"


def result_root(results: str, name: str, run_ts: datetime) -> str:
    """<results>/<Name>/rawzone/tech_year=../tech_month=../tech_day=../tech_hour=../run=<time>:
    one folder per run, so two runs in the same hour never mix or overwrite."""
    return (f"{results}/{name}/{ZONE_FOLDER}/tech_year={run_ts:%Y}/tech_month={run_ts:%Y-%m}/"
            f"tech_day={run_ts:%Y-%m-%d}/tech_hour={run_ts:%H}/run={run_ts:%Y%m%dT%H%M%S%f}")


PARALLEL_JOBS = 4


def run_jobs(jobs: list, parallel: int = PARALLEL_JOBS) -> None:
    """Submit independent Spark actions from a few driver threads: their
    tasks then share the executors instead of queueing one job after the
    other (small jobs leave most cores idle). Errors are raised."""
    if parallel <= 1:
        for job in jobs:
            job()
        return
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        for fut in [pool.submit(job) for job in jobs]:
            fut.result()


def _good(df: DataFrame, quarantine: dict[str, DataFrame], name: str) -> DataFrame:
    good, bad = E.split_bad_records(df)
    quarantine[name] = bad.select(F.col(schemas.CORRUPT_COLUMN).alias("record"))
    return good


class Staging:
    """Tables written once to the shared folder and read back, because several others are
    derived from them; close() removes them when nothing reads them any more."""

    def __init__(self):
        self.paths: list[str] = []

    def __call__(self, spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, f"staged-{name}")
        self.paths.append(path)
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def close(self, spark: SparkSession) -> None:
        for path in self.paths:
            remove_scratch(spark, path)
        self.paths.clear()


def build_tables(spark: SparkSession, landing: str, radius_m: float | None = None,
                 stage=None) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The nine tables of one extraction run (lazy), plus the quarantined documents
    (``record``: the raw text) of each kind. ``stage(spark, df, name)`` may materialise what is used
    more than once: the parsed airports and flights, and the country points."""
    stage = stage or (lambda _spark, df, _name: df)
    quarantine: dict[str, DataFrame] = {}
    out: dict[str, DataFrame] = {}

    airlines = _good(read_landed_json(spark, f"{landing}/airlines", schemas.AIRLINE_DOC), quarantine, "airlines")
    out["airlines"] = airlines.select(*schemas.AIRLINES.fieldNames())

    zones, bad_zones = E.split_bad_zones(read_json_text(spark, f"{landing}/zones", with_position=True))
    quarantine["zones"] = bad_zones.select(F.col("value").alias("record")).unionByName(E.bad_zone_records(zones))
    out["zctinent"], out["znctry"], out["zncty"] = E.flatten_zones(zones)

    # airport order: position in the landed files (T3: the first match wins)
    airports_raw = _good(stage(spark, read_landed_json(spark, f"{landing}/airports", schemas.AIRPORT_DOC,
                                                       with_position=True), "airports"),
                         quarantine, "airports")
    out["airport"] = E.project_airports(airports_raw)
    first = E.first_zone_per_country(
        landing_rank(airports_raw, alias="airport_ord").withColumn("altitude", F.col("altitude").cast("int")),
        E.zone_order(zones, POSITION), "country", ["latitude", "longitude", "altitude"], "airport_ord")
    out["znctyn"] = stage(spark, first.select(F.col("country").alias("zone_country"), "latitude", "longitude",
                                              "altitude", "continent"), "znctyn")

    details_apart = bool(Store(spark, landing).names(f"{landing}/details"))
    flights = _good(stage(spark, read_landed_json(spark, f"{landing}/flights", schemas.FLIGHT_DOC, with_position=details_apart), "flights"),
                    quarantine, "flights")
    if details_apart:
        details = _good(stage(spark, read_landed_json(spark, f"{landing}/details", schemas.FLIGHT_DETAILS_DOC, with_position=True), "details"),
                        quarantine, "details")
        flights = stage(spark, stitch_details(flights, details), "stitched")
    out["flight"] = E.flatten_flights(flights)
    live = E.distance_from_origin(E.live_subset(flights), out["airport"])
    out["acflight"] = E.acflight_projection(live)

    # flights seen over each country: box around the country point; the
    # original passed the airport altitude as the radius (kept as default)
    pts = out["znctyn"]
    radius = F.col("altitude") if radius_m is None else F.lit(float(radius_m))
    half_lat, half_lon = radius_to_half_widths(radius, F.col("latitude"))
    pts = pts.withColumns({"_hl": half_lat, "_hn": half_lon})
    out["flctry"] = E.flights_over_country(
        pts, flights.select(F.col("id").alias("flight_id"), "latitude", "longitude"),
        F.col("_hl"), F.col("_hn"))
    return out, quarantine


def extract(spark: SparkSession, landing: str, lake: str, run_ts: str | None = None,
            radius_m: float | None = None, parallel: int = PARALLEL_JOBS) -> dict[str, DataFrame]:
    """Write the nine tables as snapshots under ``<lake>/<Dataset>/rawzone``, the bad
    documents of all four kinds under ``<lake>/Quarantine``, all with the same run time, and
    then record the run. A re-run of the same time replaces its content, for readers at one moment. Returns the
    quarantined documents (``record``) per kind, as stored."""
    staging = Staging()
    ts = F.lit(run_ts).cast("timestamp") if run_ts else F.lit(datetime.now(timezone.utc))
    run, tries = label_of(spark, ts), {}
    try:
        tables, quarantine = build_tables(spark, landing, radius_m, stage=staging)

        def write(name: str, df: DataFrame, root: str) -> None:
            tries[name] = write_parquet_snapshot(df, root, ts)

        jobs = [lambda n=name: write(n, tables[n], dataset_root(lake, n)) for name in DATASETS]
        jobs += [lambda k=kind, df=df: write(f"quarantine {k}", df, quarantine_root(lake, k)) for kind, df in quarantine.items()]
        run_jobs(jobs, parallel)
        commit_run(spark, lake, ts, tries)
    finally:
        staging.close(spark)
    return {k: read_latest_snapshot(spark, quarantine_root(lake, k), df.schema, run=run, try_id=tries[f"quarantine {k}"]).select("record")
            for k, df in quarantine.items()}


def load_latest(spark: SparkSession, lake: str, as_of: str | None = None) -> R.Tables:
    """The six tables the reports read, all from the newest run (at or before ``as_of``) that
    was recorded as complete, so that the datasets never come from different runs or tries."""
    found = committed_tries(spark, lake, REPORT_DATASETS, as_of)
    if found is None:
        raise ValueError(f"no complete run in {lake}" + (f" at or before {as_of}" if as_of else ""))

    run, tries = found

    def one(name):
        df = read_latest_snapshot(spark, dataset_root(lake, name), schemas.TABLES[name], run=run, try_id=tries[name])
        return df.select(*schemas.TABLES[name].fieldNames())

    return R.Tables(**{n: one(n) for n in REPORT_DATASETS})


def materialize(spark: SparkSession, t: R.Tables, parallel: int = PARALLEL_JOBS,
                stage: Staging | None = None) -> R.Tables:
    """Write each cleaned table once as Parquet in the shared folder and read
    it back: the whole-row dedup shuffles run once instead of once per
    report, and the reports restart from these files, not from the raw
    snapshots, if an executor is lost."""
    stage, done = stage or Staging(), {}
    run_jobs([lambda n=n: done.update({n: stage(spark, getattr(t, n), f"clean-{n}")}) for n in REPORT_DATASETS], parallel)
    return R.Tables(**done)


class Answers(dict):
    """The seven answers by name; close() removes the cleaned tables they read."""

    def __init__(self, spark: SparkSession, answers: dict[str, DataFrame], staging: Staging):
        super().__init__(answers)
        self.spark, self.staging = spark, staging

    def close(self) -> None:
        self.staging.close(self.spark)


def transform(spark: SparkSession, lake: str, results: str | None = None, as_of: str | None = None,
              materialize_clean: bool = True, parallel: int = PARALLEL_JOBS) -> Answers:
    """Clean the newest complete run and answer the seven questions; with
    ``results`` each answer is also written as CSV without header (bounded answers
    as one file). Close the answers when they have been read."""
    staging = Staging()
    t = R.clean_tables(load_latest(spark, lake, as_of))
    if materialize_clean:
        t = materialize(spark, t, parallel, staging)
    answers = {k: R.REPORTS[k](t) for k in REPORT_FILES}
    if results:
        now = datetime.now(timezone.utc)
        run_jobs([lambda k=k, name=name: write_csv_result(answers[k], result_root(results, name, now), k in BOUNDED_REPORTS)
                  for k, name in REPORT_FILES.items()], parallel)
    return Answers(spark, answers, staging)


def run(spark: SparkSession, landing: str, lake: str, results: str, run_ts: str | None = None,
        radius_m: float | None = None) -> Answers:
    """One call: land -> nine snapshots and the quarantine -> seven answers written as CSV."""
    extract(spark, landing, lake, run_ts, radius_m)
    return transform(spark, lake, results)

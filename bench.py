"""Benchmark: the seven reports (and their variants) plus the heavy operators,
each run to completion with the no-op sink (full execution, no collect).

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from flightlake.plans import etl  # noqa: E402
from flightlake.plans.catalog import QUERIES  # noqa: E402
from flightlake.plans.fixtures import land_documents  # noqa: E402
from flightlake.session import get_spark, remove_scratch, scratch_path  # noqa: E402

HEADLINE = [
    "R1", "R1b", "R2", "R2b", "R3", "R4", "R4b", "R5", "R5b", "R6", "R6b", "R7", "R7b",
    "flights_over_country", "point_in_box_grid", "first_match_per_country", "flatten_flights",
    "live_subset", "distance_from_origin", "skip_bad_records", "drop_duplicates", "join_by_country_m2m",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark("flightlake-bench", master=f"local[{cpus}]", shuffle_partitions=cpus * 2,
                      extra={"spark.driver.memory": "16g",
                             # one machine: keep post-shuffle stages spread over the cores
                             "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k"})
    spark.sparkContext.setLogLevel("ERROR")
    # warm-up: JIT and file listing, not timed
    QUERIES["R5b"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for key in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - t0, 3)
    # end to end: landed JSON -> nine snapshot tables -> seven answers (CSV)
    landing = scratch_path(spark, "bench-landing")
    land_documents(spark, sf_dir, landing)          # test input, not timed
    root = scratch_path(spark, "bench-run")
    t0 = time.perf_counter()
    etl.extract(spark, landing, f"{root}/lake", radius_m=500_000)
    times["etl_extract"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    answers = etl.transform(spark, f"{root}/lake", results=f"{root}/results")
    times["etl_transform"] = round(time.perf_counter() - t0, 3)
    answers.close()
    for path in (landing, root):
        remove_scratch(spark, path)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()

"""Command line: the two jobs of the original (extraction, transformation) and both in one call.

    python -m flightlake extract   --landing DIR --lake DIR [--run-ts TS] [--radius-m M]
    python -m flightlake transform --lake DIR --results DIR [--as-of TS]
    python -m flightlake run       --landing DIR --lake DIR --results DIR

Master, memory and sizes come from spark-submit (see session.CLUSTER_PROFILE_100TB).
"""

from __future__ import annotations

import argparse

from flightlake.plans import etl
from flightlake.session import get_spark


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="flightlake")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ex = sub.add_parser("extract")
    tr = sub.add_parser("transform")
    rn = sub.add_parser("run")
    for p in (ex, rn):
        p.add_argument("--landing", required=True)
    for p in (ex, tr, rn):
        p.add_argument("--lake", required=True)
    for p in (tr, rn):
        p.add_argument("--results", required=True)
    for p in (ex, rn):
        p.add_argument("--run-ts")
        p.add_argument("--radius-m", type=float)
    tr.add_argument("--as-of")
    args = ap.parse_args(argv)

    spark = get_spark("flightlake-" + args.cmd)
    if args.cmd == "extract":
        quarantine = etl.extract(spark, args.landing, args.lake, args.run_ts, args.radius_m)
        for name, bad in quarantine.items():
            print(f"{name}: {bad.count()} bad documents in {etl.quarantine_root(args.lake, name)}")
    elif args.cmd == "transform":
        answers = etl.transform(spark, args.lake, args.results, as_of=args.as_of)
        answers["R1"].show(10, truncate=False)
        answers.close()
    else:
        answers = etl.run(spark, args.landing, args.lake, args.results, args.run_ts, args.radius_m)
        answers["R1"].show(10, truncate=False)
        answers.close()
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

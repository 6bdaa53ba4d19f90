from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from flightlake.functions.numeric import rounded_avg, rounded_mean


def _expected(s, n, d=6):
    if n == 0:
        return None
    q = (Decimal(s) / Decimal(n)).quantize(Decimal(1).scaleb(-d), rounding=ROUND_HALF_UP)
    return float(q)


def test_rounded_mean_exact_half_away_from_zero(spark):
    cases = [(1, 2), (-1, 2), (5, 2_000_000), (-5, 2_000_000), (10, 3), (-10, 3), (0, 5), (7, 0),
             (-6580196942348755, 10_000_000), (123456789012345678, 7), (1, 1_000_000 * 2 + 1)]
    df = spark.createDataFrame(cases, "s long, n long")
    got = [r.m for r in df.select(rounded_mean("s", "n").alias("m")).collect()]
    assert got == [_expected(s, n) for s, n in cases]


def test_rounded_avg_matches_python(spark):
    vals = [3, -7, 11, 2**40, -(2**41), 5]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "x long")
    got = df.agg(rounded_avg("x").alias("m")).first().m
    assert got == _expected(sum(vals), len(vals))
    assert spark.createDataFrame([(None,)], "x long").agg(rounded_avg(F.col("x")).alias("m")).first().m is None

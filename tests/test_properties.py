"""Property tests (hypothesis): equal results from different plans."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from flightlake.functions.numeric import rounded_mean
from flightlake.operators.range_join import point_in_box_join

coord = st.integers(min_value=-9000, max_value=9000).map(lambda v: v / 100.0)
lon = st.integers(min_value=-18000, max_value=18000).map(lambda v: v / 100.0)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(points=st.lists(st.tuples(coord, lon), min_size=1, max_size=40),
       boxes=st.lists(st.tuples(coord, lon, coord, lon), min_size=1, max_size=6))
def test_grid_join_equals_nested_loop(spark, points, boxes):
    p = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(points)], "pid int, plat double, plon double")
    b = spark.createDataFrame([(j, *bx) for j, bx in enumerate(boxes)],
                              "bid int, tl_y double, tl_x double, br_y double, br_x double")
    kw = dict(lat="plat", lon="plon")
    grid = sorted(tuple(r) for r in point_in_box_join(p, b, **kw).select("pid", "bid").collect())
    assert grid == sorted((i, j) for i, (y, x) in enumerate(points) for j, (a, l, c, r) in enumerate(boxes)
                          if min(a, c) < y < max(a, c) and min(l, r) < x < max(l, r))


EXACT_RANGE = 2**53 / 10**6      # |mean| below this: the result is the correctly rounded decimal


@SETTINGS
@given(pairs=st.lists(st.tuples(st.integers(-10**15, 10**15), st.integers(1, 10**7))
                      .filter(lambda p: abs(p[0]) / p[1] < EXACT_RANGE), min_size=1, max_size=20))
def test_rounded_mean_equals_decimal(spark, pairs):
    df = spark.createDataFrame(pairs, "s long, n long")
    got = [r.m for r in df.select(rounded_mean("s", "n").alias("m")).collect()]
    want = [float((Decimal(s) / Decimal(n)).quantize(Decimal("0.000001"), rounding=ROUND_HALF_UP)) for s, n in pairs]
    assert got == want

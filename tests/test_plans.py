"""Plan shapes that matter at scale, read from explain() like a user would."""

import contextlib
import io

from flightlake.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_no_cartesian_anywhere(spark):
    for key in ("point_in_box", "point_in_box_grid", "flights_over_country", "first_match_per_country", "R2", "R7"):
        assert "CartesianProduct" not in plan(QUERIES[key](spark, SF)), key


def test_grid_join_is_an_equi_join(spark):
    p = plan(QUERIES["point_in_box_grid"](spark, SF))
    assert "NestedLoopJoin" not in p and ("HashJoin" in p or "SortMergeJoin" in p)


def test_scan_pruning_and_pushdown(spark):
    p = plan(QUERIES["R1"](spark, SF))
    assert "EqualTo(o_orderstatus,O)" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>" in p


def test_rank_limit_is_partial(spark):
    p = plan(QUERIES["R6"](spark, SF))
    assert p.count("WindowGroupLimit") >= 2          # partial before the exchange, final after


def test_r4_joins_aggregates_not_rows(spark):
    """Both inputs of the country join are aggregated first: the plan has an
    aggregate directly under each side of that join, and the raw many-to-many
    join never exists."""
    p = plan(QUERIES["R4"](spark, SF))
    tree = p.split("\n\n")[0]
    lines = tree.splitlines()
    join_idx = [i for i, line in enumerate(lines) if "Join" in line][0]      # top-most join = country join
    below = [line.strip(" :+-|") for line in lines[join_idx + 1:join_idx + 8]]
    assert sum(1 for line in below if line.startswith(("HashAggregate", "Sort", "Exchange", "BroadcastExchange"))) >= 3


def test_top1_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["R3"](spark, SF))


def test_range_joins_have_no_nested_loop(spark):
    for key in ("point_in_box", "point_in_box_grid", "flights_over_country", "first_match_per_country"):
        assert "NestedLoopJoin" not in plan(QUERIES[key](spark, SF)), key


def test_documents_are_parsed_once(spark):
    for key in ("live_subset", "flatten_flights", "last_trail_point"):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            QUERIES[key](spark, SF).explain("extended")
        optimized = buf.getvalue().split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
        assert optimized.count("from_json") == 1, key


def test_first_match_sorts_no_raw_rows(spark):
    p = plan(QUERIES["first_match_per_country"](spark, SF))
    assert "min_by" not in p and "HashAggregate" in p


def test_growing_answer_is_not_one_task(spark, tmp_path):
    from flightlake.sinks.results import write_csv_result
    df = spark.range(10_000).repartition(4, "id").selectExpr("id", "id % 7 as k")
    write_csv_result(df, str(tmp_path / "many"))
    write_csv_result(df.orderBy("id").limit(5), str(tmp_path / "few"), bounded=True)
    assert len(list((tmp_path / "many").glob("part-*.csv"))) == 4
    assert len(list((tmp_path / "few").glob("part-*.csv"))) == 1


def test_first_match_has_one_range_join_and_one_hash_aggregate(spark):
    """E5: the boxes' cells are built once, and nothing but the order is aggregated."""
    p = plan(QUERIES["first_match_per_country"](spark, SF)).split("\n\n")[0]
    tree = p.split("Subqueries")[0]
    assert tree.count("Generate") == 4                # cells (2), salts, the points' levels, once each; and nothing a second time
    assert "SortAggregate" not in tree and tree.count("HashAggregate") == 2

import random

from pyspark.sql import functions as F

from flightlake.operators import joins as J
from flightlake.operators import ranking as K
from flightlake.operators.aggregates import count_dict_form, count_star_by_key, grouped_count


def test_join_airline_fans_out_on_repeated_icao(spark):
    fl = spark.createDataFrame([("f1", "AF"), ("f2", "BA"), ("f3", None)], "flight_id string, airline_icao string")
    al = spark.createDataFrame([("air france", "AF", "AF"), ("air fr", "AF", "AF"), ("ba", "BA", "BA"),
                                ("nul", "X", None)], "Name string, Code string, ICAO string")
    out = J.join_airline(fl, al)
    assert out.count() == 3  # f1 twice, f2 once, null ICAO never matches


def test_role_playing_left_vs_inner(spark):
    fl = spark.createDataFrame([("f1", "1", "2"), ("f2", "1", "9")],
                               "flight_id string, origin_airport_iata string, destination_airport_iata string")
    ap = spark.createDataFrame([("1", "fr"), ("2", "de")], "iata string, country string")
    zc = spark.createDataFrame([("fr", "europe"), ("de", "europe")], "zone_country string, continent string")
    left = J.join_role_playing_dims(fl, ap, zc, "left")
    inner = J.join_role_playing_dims(fl, ap, zc, "inner")
    assert left.count() == 2 and inner.count() == 1
    r = left.where("flight_id = 'f2'").first()
    assert r.continent_origin == "europe" and r.continent_destination is None


def test_full_outer_counts_key_from_either_side(spark):
    fl = spark.createDataFrame([("A", "B"), ("A", "C"), ("B", "A"), ("D", None)],
                               "origin_airport_iata string, destination_airport_iata string")
    dst, org = "destination_airport_iata", "origin_airport_iata"
    inbound = count_dict_form(fl.where(F.col(dst).isNotNull()), dst, "n_in")
    outbound = count_dict_form(fl.where(F.col(org).isNotNull()), org, "n_out")
    got = {tuple(r) for r in J.full_outer_counts(inbound, outbound, dst, org, "n_in", "n_out").collect()}
    # D only outbound, C only inbound: both keep their code (T7)
    assert got == {("A", 1, 2), ("B", 1, 1), ("C", 1, 0), ("D", 0, 1)}


def test_lookup_missing_key_gives_null(spark):
    keys = spark.createDataFrame([("ZZZ",)], "airport_iata string")
    ap = spark.createDataFrame([("CDG", "paris cdg"), ("CDG", "charles de gaulle")], "iata string, name string")
    assert J.lookup_by_key(keys, "airport_iata", ap, "iata", "name").first().name is None   # T8
    keys2 = spark.createDataFrame([("CDG",)], "airport_iata string")
    assert J.lookup_by_key(keys2, "airport_iata", ap, "iata", "name").first().name == "charles de gaulle"


def test_mean_over_m2m_join_equals_direct_join(spark):
    rnd = random.Random(7)
    facts = [(rnd.choice(["a", "b", "c", "d", None]), rnd.choice([None, rnd.randint(-10**9, 10**9)]))
             for _ in range(400)]
    bridge = [(rnd.choice(["a", "b", "c", "e"]), rnd.choice(["EU", "AS", None])) for _ in range(60)]
    f = spark.createDataFrame(facts, "country string, flight_length long")
    b = spark.createDataFrame(bridge, "country string, continent string")
    fast = {r.continent: r.m for r in J.mean_over_m2m_join(f, "country", "flight_length", b, "country", "continent", "m").collect()}
    direct = {r.continent: r.m for r in f.join(b, "country").groupBy("continent").agg(F.avg("flight_length").alias("m")).collect()}
    assert fast.keys() == direct.keys()
    for k in fast:
        assert (fast[k] is None and direct[k] is None) or abs(fast[k] - direct[k]) <= 1e-9 * max(1.0, abs(direct[k]))


def test_top1_total_order_under_ties(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 1)], "Name string, flight_count long")
    for n in (1, 3):
        assert K.top1_row(df.repartition(n), "flight_count", ["Name"]).first().Name == "a"   # T6


def test_dense_rank_keeps_ties(spark):
    data = [("al", "fr", m, c) for m, c in [("m1", 9), ("m2", 7), ("m3", 5), ("m4", 5), ("m5", 5), ("m6", 5), ("m7", 1)]]
    df = spark.createDataFrame(data, "Name string, country string, aircraft_model string, model_count long")
    out = K.dense_rank_top_n(df, ["Name", "country"], "model_count", 3, "model_rank")
    assert sorted((r.aircraft_model, r.model_rank) for r in out.collect()) == [
        ("m1", 1), ("m2", 2), ("m3", 3), ("m4", 3), ("m5", 3), ("m6", 3)]


def test_top1_per_group(spark):
    df = spark.createDataFrame([("EU", "x", 3), ("EU", "a", 3), ("AS", "b", 1)], "continent string, Name string, flight_count long")
    got = {(r.continent, r.Name) for r in K.top1_per_group(df, ["continent"], "flight_count", ["Name"]).collect()}
    assert got == {("EU", "a"), ("AS", "b")}


def test_aggregate_shapes(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert grouped_count(df, "k").columns == ["k", "count"]
    assert {tuple(r) for r in count_star_by_key(df, "k", "n").collect()} == {("a", 2), (None, 1)}
    assert count_dict_form(df, "k", "num").columns == ["k", "num"]

from flightlake import schemas
from flightlake.plans import reports as R


def tables(spark, acflight_rows=None):
    airlines = [("Air France", "AF", "AFR"), ("British", None, "BAW"), ("Lufthansa", "LH", "DLH"),
                ("Air France", "AF", "AFR")]
    airport = [(49.0, 2.5, 100, "Charles de Gaulle", "LFPG", "CDG", "France"),
               (51.5, -0.4, 80, "Heathrow", "EGLL", "LHR", "United Kingdom"),
               (50.0, 8.5, 110, "Frankfurt", "EDDF", "FRA", "Germany"),
               (40.6, -73.8, 4, "JFK", "KJFK", "JFK", "United States"),
               (0.0, 0.0, 0, "No code", "XXXX", None, "Nowhere"),
               (1.0, 1.0, 0, "Empty code", "YYYY", "", "Nowhere")]
    znctyn = [("France", 49.0, 2.5, 100, "europe"), ("United Kingdom", 51.5, -0.4, 80, "europe"),
              ("Germany", 50.0, 8.5, 110, "europe"), ("United States", 40.6, -73.8, 4, "northamerica")]
    ac = acflight_rows if acflight_rows is not None else [
        # id, lat, lon, airline, origin, dist, dest, iata, code, model, dep, arr, dur
        ("f1", 1.0, 1.0, "AFR", "CDG", 900.7, "FRA", "AF", "A320", "Airbus A320", 100, 400, "300"),
        ("f2", 1.0, 1.0, "AFR", "CDG", 5000.2, "JFK", "AF", "B777", "Boeing 777", 100, 900, "800"),
        ("f3", 1.0, 1.0, "BAW", "LHR", 300.0, "CDG", "BA", "A320", "Airbus A321", 100, None, None),
        ("f4", 1.0, 1.0, "BAW", "LHR", 5000.9, "JFK", "BA", "B777", "Boeing 777", 100, 700, "600"),
        ("f5", 1.0, 1.0, "DLH", "FRA", 100.0, "LHR", "LH", "A320", "Airbus A320", 100, 200, "100"),
        ("f5", 1.0, 1.0, "DLH", "FRA", 100.0, "LHR", "LH", "A320", "Airbus A320", 100, 200, "100"),
        ("f6", 1.0, 1.0, "DLH", "JFK", 100.0, "ZZZ", "LH", "A320", None, 100, 200, "100"),
    ]
    flight = [
        ("f1", "AFR", "A320", "CDG", 1000, 4000, "Airbus A320", "3000", 1.0, 1.0, 1),
        ("f2", "AFR", "B777", "CDG", 1000, None, "Boeing 777", None, 1.0, 1.0, 1),
        ("f3", "BAW", "A320", "LHR", 1000, 2000, "", "1000", 1.0, 1.0, 1),
        ("f7", "", "A320", "LHR", 1000, 2000, "x", "1000", 1.0, 1.0, 1),
        ("f8", "BAW", "A320", "LHR", None, 2000, "x", "1000", 1.0, 1.0, 1),
    ]
    flctry = [("France", "europe", "f1"), ("FRANCE", "europe", "f1"), ("France", "europe", "f2"),
              ("Germany", "europe", "f1"), ("United Kingdom", "europe", "f3"), ("United States", "northamerica", "f2")]
    t = R.Tables(
        airlines=spark.createDataFrame(airlines, schemas.AIRLINES), znctyn=spark.createDataFrame(znctyn, schemas.ZNCTYN),
        airport=spark.createDataFrame(airport, schemas.AIRPORT), flight=spark.createDataFrame(flight, schemas.FLIGHT),
        acflight=spark.createDataFrame(ac, schemas.ACFLIGHT), flctry=spark.createDataFrame(flctry, schemas.FLCTRY))
    return R.clean_tables(t)


def test_r1_ranking(spark):
    got = [tuple(r) for r in R.airline_most_live_flights(tables(spark)).collect()]
    assert got == [("air france", 2), ("british", 2), ("lufthansa", 2)]        # f5 deduplicated, ties by name
    assert [tuple(r) for r in R.airline_most_live_flights_top1(tables(spark)).collect()] == [("air france", 2)]


def test_r2_regional(spark):
    t = tables(spark)
    # europe->europe: f1 (AFR CDG->FRA), f3 (BAW LHR->CDG), f5 (DLH FRA->LHR)
    assert [tuple(r) for r in R.airline_most_regional_flights(t).collect()] == [("air france", 1)]
    got = {tuple(r) for r in R.airline_most_regional_flights_per_continent(t).collect()}
    assert got == {("europe", "air france", 1)}


def test_r3_longest_ties_broken(spark):
    r = R.longest_live_flight(tables(spark)).first()
    assert r.actual_distance == 5000 and r.flight_id == "f2"                   # 5000.2 and 5000.9 both truncate to 5000


def test_r4_weighted_vs_unweighted(spark):
    t = tables(spark)
    # valid flights: f1 (CDG, 3000), f2 (CDG, arrival missing -> 0 - 1000 = -1000), f3 (LHR, 1000)
    # flctry weights: france x3 (after lower+distinct: (france,europe,f1),(france,europe,f2)) -> 2 rows
    got = {r.continent: r.mean_flight_length for r in R.mean_flight_length_by_continent(t).collect()}
    # france rows 2 x (3000, -1000), united kingdom 1 x 1000 -> (4000+1000)/5 = 1000
    assert got == {"europe": 1000.0}
    unw = {r.continent: r.mean_flight_length for r in R.mean_flight_length_by_continent_unweighted(t).collect()}
    assert unw == {"europe": 2000.0}                                           # f1 3000, f3 1000; f2 dropped (T5)


def test_r5_manufacturers(spark):
    got = [tuple(r) for r in R.top_manufacturers(tables(spark)).collect()]
    assert got == [("airbus", 3), ("boeing", 2), ("", 1)]
    assert [tuple(r) for r in R.top_manufacturer(tables(spark)).collect()] == [("airbus", 3)]


def test_r6_top_models(spark):
    got = {tuple(r) for r in R.top3_models_by_airline_country(tables(spark)).collect()}
    # 'France' and 'FRANCE' are distinct before lower-casing, so f1 counts twice for france
    assert ("air france", "france", "airbus a320", 2, 1) in got
    assert ("air france", "france", "boeing 777", 1, 2) in got
    by_country = {tuple(r) for r in R.top3_models_by_country(tables(spark)).collect()}
    assert ("france", "airbus a320", 2, 1) in by_country and ("france", "boeing 777", 1, 2) in by_country


def test_r7_flow_gap(spark):
    t = tables(spark)
    counts = {r.airport_iata: (r.num_inbound_flights, r.num_outbound_flights) for r in R.airport_flow_counts(t).collect()}
    assert counts["JFK"] == (2, 1) and counts["ZZZ"] == (1, 0) and counts["CDG"] == (1, 2)
    assert [r.name for r in R.airport_largest_flow_gap(t).collect()] == ["jfk"]
    r = R.airport_largest_flow_gap_abs(t).first()
    assert (r.airport_iata, abs(r.flight_difference)) == ("CDG", 1)


def test_r7_winner_not_in_airports(spark):
    ac = [("f1", 1.0, 1.0, "AFR", "CDG", 1.0, "QQQ", "AF", "A", "m", 1, 2, "1"),
          ("f2", 1.0, 1.0, "AFR", "CDG", 1.0, "QQQ", "AF", "A", "m", 1, 2, "1"),
          ("f3", 1.0, 1.0, "AFR", "QQQ", 1.0, "CDG", "AF", "A", "m", 1, 2, "1")]
    assert [r.name for r in R.airport_largest_flow_gap(tables(spark, ac)).collect()] == [None]    # T8


def test_empty_live_flights(spark):
    t = tables(spark, [])
    for fn in (R.airline_most_live_flights, R.airline_most_regional_flights, R.longest_live_flight,
               R.top_manufacturers, R.top3_models_by_airline_country, R.airport_largest_flow_gap):   # T9
        assert fn(t).count() == 0


def test_t4_filled_empty_code_is_a_key(spark):
    # a live flight without destination and airports without IATA: after the
    # null fill both are '', so '' is counted and looked up like a code (coded form)
    ac = [("f1", 1.0, 1.0, "AFR", "CDG", 1.0, None, "AF", "A", "m", 1, 2, "1"),
          ("f2", 1.0, 1.0, "AFR", "CDG", 1.0, None, "AF", "A", "m", 1, 2, "1"),
          ("f3", 1.0, 1.0, "AFR", "LHR", 1.0, "CDG", "AF", "A", "m", 1, 2, "1")]
    t = tables(spark, ac)
    counts = {r.airport_iata: r.num_inbound_flights for r in R.airport_flow_counts(t).collect()}
    assert counts[""] == 2
    # the airports with null and with '' IATA both become '' ; the smaller name wins
    assert [r.name for r in R.airport_largest_flow_gap(t).collect()] == ["empty code"]


def test_r5_model_text_variants(spark):
    models = ["Airbus A320", "Airbus", "", None, " leading space", "Boeing 777 300"]
    ac = [(f"f{i}", 1.0, 1.0, "AFR", "CDG", 1.0, "LHR", "AF", "A", m, 1, 2, "1") for i, m in enumerate(models)]
    got = {tuple(r) for r in R.manufacturer_counts(tables(spark, ac)).collect()}
    # null is filled with '' before the split; a leading space gives '' too
    assert got == {("airbus", 2), ("", 3), ("boeing", 1)}

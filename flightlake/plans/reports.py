"""The seven reports (R1-R7) and their documented variants (R*b).

Each report is a pure function of cleaned tables (see ``clean_tables``) and
returns one DataFrame; one action per report, no driver round trip.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.functions.text import first_word
from flightlake.operators import clean as C
from flightlake.operators.aggregates import (
    count_col_by_keys, count_dict_form, count_star_by_key, grouped_count, mean_by_key,
)
from flightlake.operators.joins import (
    full_outer_counts, join_airline, join_flight_country, join_origin_airport,
    join_role_playing_dims, lookup_by_key, mean_over_m2m_join,
)
from flightlake.operators.ranking import (
    dense_rank_top_n, order_by_desc, top1_per_group, top1_row, top_n,
)

MEAN_DIGITS = 6   # means of seconds: exact, rounded half away from zero to 6 decimals


@dataclass
class Tables:
    airlines: DataFrame
    znctyn: DataFrame
    airport: DataFrame
    flight: DataFrame
    acflight: DataFrame
    flctry: DataFrame


def clean_tables(t: Tables) -> Tables:
    """The cleaning phase applied to every landed table."""
    return Tables(
        airlines=C.clean_airlines(t.airlines), znctyn=C.clean_znctyn(t.znctyn),
        airport=C.clean_airport(t.airport), flight=C.clean_flight(t.flight),
        acflight=C.clean_acflight(t.acflight), flctry=C.clean_flctry(t.flctry),
    )


# R1
def airline_counts(t: Tables) -> DataFrame:
    return count_star_by_key(join_airline(t.acflight, t.airlines), "Name", "flight_count")


def airline_most_live_flights(t: Tables) -> DataFrame:
    """Whole ranking of airlines by live flights (Name, flight_count)."""
    return order_by_desc(airline_counts(t), "flight_count", ["Name"])


def airline_most_live_flights_top1(t: Tables) -> DataFrame:
    return top1_row(airline_counts(t), "flight_count", ["Name"])


# R2
def regional_flights(t: Tables) -> DataFrame:
    """Live flights whose origin and destination continents are equal
    (Name, continent_origin). The equality rejects nulls, so the left joins
    of the original equal inner joins here."""
    j = join_role_playing_dims(join_airline(t.acflight, t.airlines), t.airport, t.znctyn, "inner")
    return C.where_sql(j, "continent_destination = continent_origin").select("Name", "continent_origin")


def airline_most_regional_flights(t: Tables) -> DataFrame:
    """As coded: one airline overall (counts summed over all continents)."""
    return top1_row(count_star_by_key(regional_flights(t), "Name", "flight_count"), "flight_count", ["Name"])


def airline_most_regional_flights_per_continent(t: Tables) -> DataFrame:
    """As asked: the leading airline of every continent."""
    counts = count_star_by_key(regional_flights(t).withColumnRenamed("continent_origin", "continent"),
                               ["continent", "Name"], "flight_count")
    return top1_per_group(counts, ["continent"], "flight_count", ["Name"])


# R3
def longest_live_flight(t: Tables) -> DataFrame:
    """Live flight with the largest ``actual_distance`` (truncated to int).
    That distance is the way flown so far from the origin, not the route
    length. Ties are broken by the other columns, ascending."""
    df = C.cast_distance(t.acflight)
    return top1_row(df, "actual_distance", [c for c in df.columns if c != "actual_distance"])


# R4
def flight_lengths_by_country(t: Tables) -> DataFrame:
    j = join_origin_airport(t.flight, t.airport)
    return j.select(F.lower(F.col("country")).alias("country"),
                    (F.col("departure_arrival") - F.col("departure_origin")).alias("flight_length"))


def mean_flight_length_by_continent(t: Tables) -> DataFrame:
    """As coded: mean over (flight x airport) joined with flctry on country,
    i.e. weighted by the flctry rows of the origin country. Missing arrivals
    were filled with 0 and count as large negative lengths. Computed without
    materialising the many-to-many join."""
    return mean_over_m2m_join(flight_lengths_by_country(t), "country", "flight_length",
                              t.flctry, "country", "continent", "mean_flight_length", MEAN_DIGITS)


def mean_flight_length_by_continent_unweighted(t: Tables) -> DataFrame:
    """As asked: each flight once, only flights with a departure and a later
    arrival, continent of the origin country from znctyn."""
    f = t.flight.where((F.col("departure_origin") > 0) & (F.col("departure_arrival") > F.col("departure_origin")))
    j = join_origin_airport(f, t.airport)
    z = t.znctyn.select("zone_country", "continent")
    j = j.join(z, j["country"] == z["zone_country"])
    j = j.withColumn("flight_length", F.col("departure_arrival") - F.col("departure_origin"))
    return mean_by_key(j, "continent", "flight_length", "mean_flight_length", MEAN_DIGITS)


# R5
def manufacturer_counts(t: Tables) -> DataFrame:
    return grouped_count(t.acflight.withColumn("aircraft_type", first_word("aircraft_model")), "aircraft_type")


def top_manufacturers(t: Tables, k: int = 5) -> DataFrame:
    return top_n(manufacturer_counts(t), k, "count", ["aircraft_type"])


def top_manufacturer(t: Tables) -> DataFrame:
    return top_manufacturers(t, 1)


# R6
def flights_with_country(t: Tables) -> DataFrame:
    return join_flight_country(join_airline(t.acflight, t.airlines), t.flctry)


def top3_models_by_airline_country(t: Tables) -> DataFrame:
    """Per (airline, country the flight is seen over), models by use; dense
    rank, ties kept, rank <= 3."""
    counts = count_col_by_keys(flights_with_country(t), ["Name", "country", "aircraft_model"],
                               "flight_id", "model_count")
    return dense_rank_top_n(counts, ["Name", "country"], "model_count", 3, "model_rank")


def top3_models_by_country(t: Tables) -> DataFrame:
    counts = count_col_by_keys(flights_with_country(t), ["country", "aircraft_model"], "flight_id", "model_count")
    return dense_rank_top_n(counts, ["country"], "model_count", 3, "model_rank")


# R7
def airport_flow_counts(t: Tables) -> DataFrame:
    """Per airport code: inbound, outbound and inbound - outbound."""
    dst, org = "destination_airport_iata", "origin_airport_iata"
    inbound = count_dict_form(C.filter_not_null(t.acflight, [dst]), dst, "num_inbound_flights")
    outbound = count_dict_form(C.filter_not_null(t.acflight, [org]), org, "num_outbound_flights")
    counts = full_outer_counts(inbound, outbound, dst, org, "num_inbound_flights", "num_outbound_flights")
    return counts.withColumn("flight_difference", F.col("num_inbound_flights") - F.col("num_outbound_flights"))


def airport_largest_flow_gap(t: Tables) -> DataFrame:
    """As coded: the airport with the largest inbound - outbound (signed);
    output its name (null when the code is not in the airport table)."""
    winner = top1_row(airport_flow_counts(t), "flight_difference", ["airport_iata"]).select("airport_iata")
    return lookup_by_key(winner, "airport_iata", t.airport, "iata", "name").select("name")


def airport_largest_flow_gap_abs(t: Tables) -> DataFrame:
    """As asked: largest absolute difference, with code, name and counts."""
    counts = airport_flow_counts(t).withColumn("_abs", F.abs("flight_difference"))
    winner = top1_row(counts, "_abs", ["airport_iata"]).drop("_abs")
    return lookup_by_key(winner, "airport_iata", t.airport, "iata", "name")


REPORTS = {
    "R1": airline_most_live_flights,
    "R1b": airline_most_live_flights_top1,
    "R2": airline_most_regional_flights,
    "R2b": airline_most_regional_flights_per_continent,
    "R3": longest_live_flight,
    "R4": mean_flight_length_by_continent,
    "R4b": mean_flight_length_by_continent_unweighted,
    "R5": top_manufacturers,
    "R5b": top_manufacturer,
    "R6": top3_models_by_airline_country,
    "R6b": top3_models_by_country,
    "R7": airport_largest_flow_gap,
    "R7b": airport_largest_flow_gap_abs,
}

"""Equi-joins of the reports (J1-J6, J9) and the many-to-many pre-aggregation.

No join carries a broadcast hint: Catalyst broadcasts a side only when its
estimated size is under ``spark.sql.autoBroadcastJoinThreshold``, and AQE
re-decides with the real shuffle sizes, falling back to a sort-merge join
(with skew splitting) when a side is large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from flightlake.functions.numeric import rounded_mean


# J1
def join_airline(flights: DataFrame, airlines: DataFrame) -> DataFrame:
    """Flights with their airline row (flights.airline_icao = airlines.ICAO).
    Airlines are unique by whole row, not by ICAO: a repeated ICAO fans out."""
    return flights.join(airlines, flights["airline_icao"] == airlines["ICAO"], "inner")


def airport_continent(airport: DataFrame, znctyn: DataFrame, how: str = "inner") -> DataFrame:
    """Small dimension iata -> (country, zone_country, continent)."""
    a = airport.select("iata", "country")
    z = znctyn.select("zone_country", "continent")
    return a.join(z, a["country"] == z["zone_country"], how)


# J2
def join_role_playing_dims(flights: DataFrame, airport: DataFrame, znctyn: DataFrame,
                           how: str = "inner") -> DataFrame:
    """Origin and destination country/continent of every flight.

    The chain flights-airport-znctyn is written twice in the original (four
    joins of the big side). Joining the two dimensions first is the same
    result for inner and for left joins, and the big side is joined twice.
    """
    dim = airport_continent(airport, znctyn, how)
    roles = (("origin", "origin_airport_iata"), ("destination", "destination_airport_iata"))
    out = flights.alias("_f")
    for role, key in roles:
        # the same dimension plan under two aliases: one broadcast serves both roles
        out = out.join(dim.alias(role), F.col(f"_f.{key}") == F.col(f"{role}.iata"), how)
    renamed = [F.col(f"{role}.{c}").alias(f"{c}_{role}") for role, _ in roles
               for c in ("iata", "country", "zone_country", "continent")]
    return out.select("_f.*", *renamed)


# J3
def join_origin_airport(flights: DataFrame, airport: DataFrame) -> DataFrame:
    return flights.join(airport, flights["origin_airport_iata"] == airport["iata"], "inner")


# J5
def join_flight_country(flights: DataFrame, flctry: DataFrame) -> DataFrame:
    """A flight seen over several countries matches several rows."""
    return flights.join(flctry, flights["flight_id"] == flctry["id_flight"], "inner")


# J6
def full_outer_counts(inbound: DataFrame, outbound: DataFrame, in_key: str, out_key: str,
                      in_count: str, out_count: str, key_alias: str = "airport_iata") -> DataFrame:
    """Full outer join of two per-key counts; missing counts are 0 and the key
    is taken from whichever side has it."""
    i = inbound.select(F.col(in_key).alias("_ik"), F.col(in_count))
    o = outbound.select(F.col(out_key).alias("_ok"), F.col(out_count))
    j = i.join(o, i["_ik"] == o["_ok"], "full")
    return j.select(
        F.coalesce(F.col("_ik"), F.col("_ok")).alias(key_alias),
        F.coalesce(F.col(in_count), F.lit(0)).cast("long").alias(in_count),
        F.coalesce(F.col(out_count), F.lit(0)).cast("long").alias(out_count),
    )


# J9 / O4
def lookup_by_key(keys: DataFrame, key: str, dim: DataFrame, dim_key: str, value: str) -> DataFrame:
    """Value of ``dim`` for each key, as a left join (no match gives null
    instead of an error); several matches give the smallest value."""
    d = dim.select(F.col(dim_key).alias("_dk"), F.col(value).alias("_dv"))
    j = keys.join(d, keys[key] == d["_dk"], "left")
    return j.groupBy(*[keys[c] for c in keys.columns]).agg(F.min("_dv").alias(value))


# J4 (R4): mean over a many-to-many join without materialising it
def mean_over_m2m_join(facts: DataFrame, fact_key: str, value: str,
                       bridge: DataFrame, bridge_key: str, group: str, alias: str,
                       digits: int = 6, rows_alias: str | None = None) -> DataFrame:
    """``avg(value)`` grouped by ``group`` over ``facts JOIN bridge ON key``.

    Each fact row appears once per bridge row of its key, so the mean is
    sum_k(S_k * W_kg) / sum_k(N_k * W_kg) with S, N the sum and non-null count
    of ``value`` per key and W the bridge rows per (key, group). Both sides
    are reduced to one row per key before the join. For an integral value the
    sums are exact (decimal(38,0)) and the mean is rounded once to ``digits``
    decimals (functions.numeric.rounded_mean); otherwise it is a double mean.
    With ``rows_alias`` the number of joined rows with a value comes too, as decimal(38,0):
    at scale it passes a long.
    """
    integral = isinstance(facts.schema[value].dataType, IntegralType)
    v = F.col(value).cast("decimal(38,0)") if integral else F.col(value).cast("double")
    f = facts.groupBy(F.col(fact_key).alias("_k")).agg(
        F.sum(v).alias("_s"), F.count(F.col(value)).alias("_n"))
    b = bridge.groupBy(F.col(bridge_key).alias("_bk"), F.col(group)).agg(F.count(F.lit(1)).alias("_w"))
    j = f.join(b, f["_k"] == b["_bk"], "inner")
    sw = F.sum(F.col("_s") * F.col("_w"))
    nw = F.sum(F.col("_n").cast("decimal(19,0)") * F.col("_w").cast("decimal(18,0)"))
    mean = rounded_mean(sw, nw, digits) if integral else F.try_divide(sw, nw.cast("double"))
    rows = [nw.cast("decimal(38,0)").alias(rows_alias)] if rows_alias else []
    return j.groupBy(group).agg(mean.alias(alias), *rows)

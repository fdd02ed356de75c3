"""Silver → gold aggregates (JOB-2): pure DataFrame → DataFrame functions.

Each is one ``groupBy().agg()``: partial aggregation on the map side, one
exchange on the grouping keys, final aggregation, then the support filter
(a HAVING, which cannot move below the aggregate).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fx
from ..schemas import (DELAY_THRESHOLD_MIN, GOLD_CAUSES, MIN_DELAYED_FLIGHTS,
                       MIN_LIVE_FLIGHTS, MIN_ROUTE_FLIGHTS)

_CAUSE_NAMES = {
    "CARRIER_DELAY": "avg_carrier_delay",
    "WEATHER_DELAY": "avg_weather_delay",
    "NAS_DELAY": "avg_nas_delay",
    "LATE_AIRCRAFT_DELAY": "avg_late_aircraft_delay",
}


def airport_hourly_delay(flights: DataFrame, with_year: bool = False) -> DataFrame:
    """Delay by origin, departure hour and month (AGG-1, PRJ-10/11).

    ``month`` has no year, so two Februaries of a 13-month span merge (T7);
    ``with_year=True`` adds a ``year`` key. ``dep_hour`` keeps 24 for '2400'
    and is null for cancelled flights without a departure time (T6).
    """
    keys = {"dep_hour": fx.hhmm_hour("DEP_TIME"), "month": fx.month_of("FL_DATE")}
    if with_year:
        keys["year"] = fx.year_of("FL_DATE")
    return (flights.withColumns(keys)
            .groupBy("Origin", "dep_hour", "month", *(["year"] if with_year else []))
            .agg(F.avg("DEP_DELAY").alias("avg_delay"),
                 fx.rows().alias("total_flights"),
                 fx.rate("is_delayed").alias("delay_rate")))


def route_delay_summary(flights: DataFrame, min_flights: int = MIN_ROUTE_FLIGHTS) -> DataFrame:
    """Delay by carrier and route with at least ``min_flights`` flights (AGG-2, HAV-1)."""
    return (flights.groupBy("OP_CARRIER", "Origin", "Dest")
            .agg(F.avg("DEP_DELAY").alias("avg_dep_delay"),
                 fx.rows().alias("total_flights"),
                 fx.rate("is_delayed").alias("delay_rate"),
                 *[F.avg(c).alias(a) for c, a in _CAUSE_NAMES.items()])
            .filter(F.col("total_flights") >= min_flights))


def carrier_stats(flights: DataFrame) -> DataFrame:
    """One row per carrier, unordered (AGG-3, AF-4)."""
    return (flights.groupBy("OP_CARRIER")
            .agg(F.avg("DEP_DELAY").alias("avg_dep_delay"),
                 F.avg("ARR_DELAY").alias("avg_arr_delay"),
                 fx.rows().alias("total_flights"),
                 fx.rate("is_delayed").alias("delay_rate"),
                 fx.true_count("is_cancelled").alias("total_cancelled")))


# --- shared partials: route and carrier tables from one pass over silver -----

_PARTIAL_MEASURES = ["DEP_DELAY", "ARR_DELAY", *_CAUSE_NAMES]


def route_partials(flights: DataFrame, apart: list[str] | None = None) -> DataFrame:
    """Per (carrier, origin, dest): row count, and for every measure its sum
    and non-null count (the causes also over delayed flights only), plus
    delayed and cancelled counts (null when all flags are null). The route,
    carrier and cause tables roll up from these exactly, so the nightly job
    scans and shuffles silver once for all three."""
    aggs = [fx.rows().alias("n")]
    for c in _PARTIAL_MEASURES:
        aggs += [F.sum(c).alias(f"s_{c}"), F.count(c).alias(f"c_{c}")]
    delayed = F.col("is_delayed")
    for c in _CAUSE_NAMES:  # cause measures over delayed flights only
        aggs += [F.sum(F.when(delayed, F.col(c))).alias(f"ds_{c}"),
                 F.count(F.when(delayed, F.col(c))).alias(f"dc_{c}")]
    aggs += [fx.true_count("is_delayed").alias("n_delayed"),
             fx.true_count("is_cancelled").alias("n_cancelled")]
    return flights.groupBy(*(apart or []), *_ROUTE).agg(*aggs)


_ROUTE = ["OP_CARRIER", "Origin", "Dest"]
_HOUR = ["Origin", "dep_hour", "month"]


def roll_up(partials: DataFrame, keys: list[str]) -> DataFrame:
    """Partials of any grouping added up to ``keys``: every measure is a sum."""
    sums = [c for c in partials.columns if c.startswith(("s_", "c_", "ds_", "dc_")) or c in ("n", "n_delayed", "n_cancelled")]
    return partials.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def monthly_route_partials(flights: DataFrame, month: str) -> DataFrame:
    """:func:`route_partials` kept apart by the partition column ``month``; added up
    (:func:`routes_from`) they give it exactly."""
    return route_partials(flights, [month])


def monthly_hour_partials(flights: DataFrame, month: str) -> DataFrame:
    """Sums and counts behind :func:`airport_hourly_delay`, kept apart by ``month``."""
    keys = {"dep_hour": fx.hhmm_hour("DEP_TIME"), "month": fx.month_of("FL_DATE")}
    return flights.withColumns(keys).groupBy(*([month] if month != "month" else []), *_HOUR).agg(
        fx.rows().alias("n"), F.sum("DEP_DELAY").alias("s_DEP_DELAY"), F.count("DEP_DELAY").alias("c_DEP_DELAY"),
        fx.true_count("is_delayed").alias("n_delayed"))


def routes_from(partials: DataFrame) -> DataFrame:
    """:func:`route_partials` from :func:`monthly_route_partials`."""
    return roll_up(partials, _ROUTE)


def airport_hourly_delay_from(partials: DataFrame) -> DataFrame:
    """:func:`airport_hourly_delay` from :func:`monthly_hour_partials`."""
    return roll_up(partials, _HOUR).select(
        *_HOUR, _mean("s_DEP_DELAY", "c_DEP_DELAY").alias("avg_delay"), F.col("n").alias("total_flights"),
        (F.col("n_delayed") / F.col("n")).alias("delay_rate"))


def _mean(s: str, c: str):
    # avg semantics: null when no value is present
    return F.when(F.col(c) > 0, F.col(s) / F.col(c))


def route_delay_summary_from(partials: DataFrame,
                             min_flights: int = MIN_ROUTE_FLIGHTS) -> DataFrame:
    """:func:`route_delay_summary` from :func:`route_partials`."""
    return (partials.filter(F.col("n") >= min_flights)
            .select("OP_CARRIER", "Origin", "Dest",
                    _mean("s_DEP_DELAY", "c_DEP_DELAY").alias("avg_dep_delay"),
                    F.col("n").alias("total_flights"),
                    (F.col("n_delayed") / F.col("n")).alias("delay_rate"),
                    *[_mean(f"s_{c}", f"c_{c}").alias(a) for c, a in _CAUSE_NAMES.items()]))


def carrier_performance_from(partials: DataFrame) -> DataFrame:
    """:func:`carrier_performance` rolled up from :func:`route_partials`."""
    sums = ["n", "n_delayed", "n_cancelled", "s_DEP_DELAY", "c_DEP_DELAY",
            "s_ARR_DELAY", "c_ARR_DELAY"]
    c = (partials.groupBy("OP_CARRIER").agg(*[F.sum(x).alias(x) for x in sums])
         .select("OP_CARRIER",
                 _mean("s_DEP_DELAY", "c_DEP_DELAY").alias("avg_dep_delay"),
                 _mean("s_ARR_DELAY", "c_ARR_DELAY").alias("avg_arr_delay"),
                 F.col("n").alias("total_flights"),
                 (F.col("n_delayed") / F.col("n")).alias("delay_rate"),
                 F.col("n_cancelled").alias("total_cancelled")))
    return c.orderBy(F.col("delay_rate").asc_nulls_first(), F.col("OP_CARRIER"))


def delay_cause_breakdown_from(partials: DataFrame,
                               min_delayed: int = MIN_DELAYED_FLIGHTS) -> DataFrame:
    """:func:`delay_cause_breakdown` rolled up from :func:`route_partials`."""
    sums = ["n_delayed"] + [f"{p}_{c}" for c in _CAUSE_NAMES for p in ("ds", "dc")]
    return (partials.groupBy("Origin", "OP_CARRIER").agg(*[F.sum(x).alias(x) for x in sums])
            .filter(F.col("n_delayed") >= min_delayed)
            .select("Origin", "OP_CARRIER",
                    *[_mean(f"ds_{c}", f"dc_{c}").alias(a) for c, a in _CAUSE_NAMES.items()],
                    F.col("n_delayed").alias("total_delayed_flights")))


def carrier_performance(flights: DataFrame) -> DataFrame:
    """One row per carrier, ascending by delay rate (AGG-3, AF-4, SRT-1).

    The sort runs on the aggregated rows only (one per carrier); a written
    file keeps no order, so readers sort again.
    """
    return carrier_stats(flights).orderBy(F.col("delay_rate").asc_nulls_first(),
                                          F.col("OP_CARRIER"))


def delay_cause_breakdown(flights: DataFrame,
                          min_delayed: int = MIN_DELAYED_FLIGHTS) -> DataFrame:
    """Cause averages of delayed flights per origin and carrier (AGG-4, FLT-4, HAV-2).

    The delayed filter (null flags excluded) is pushed into the Parquet scan.
    Delayed rows without cause attribution still count in
    ``total_delayed_flights`` (T11).
    """
    return (flights.filter(F.col("is_delayed"))
            .groupBy("Origin", "OP_CARRIER")
            .agg(*[F.avg(c).alias(a) for c, a in _CAUSE_NAMES.items()],
                 fx.rows().alias("total_delayed_flights"))
            .filter(F.col("total_delayed_flights") >= min_delayed))


def live_route_summary(live: DataFrame, min_flights: int = MIN_LIVE_FLIGHTS) -> DataFrame:
    """Live flights by carrier and route with at least ``min_flights`` (AGG-5, HAV-3).

    ``delayed_flights`` counts a null delay as not delayed, so it is never
    null (AF-5). ``aircraft_type`` is the type of the route's first flight by
    (date, scheduled departure, flight number) — a deterministic ``first``.
    """
    return (live.groupBy("carrier", "origin", "dest")
            .agg(fx.rows().alias("total_flights"),
                 F.avg("dep_delay").alias("avg_dep_delay"),
                 F.avg("arr_delay").alias("avg_arr_delay"),
                 fx.count_when(F.col("dep_delay") > DELAY_THRESHOLD_MIN).alias("delayed_flights"),
                 fx.first_by("aircraft_type", "flight_date", "scheduled_dep",
                             "flight_iata").alias("aircraft_type"))
            .filter(F.col("total_flights") >= min_flights))


__all__ = ["airport_hourly_delay", "route_delay_summary", "carrier_performance", "carrier_stats",
           "route_partials", "monthly_route_partials", "monthly_hour_partials", "routes_from",
           "airport_hourly_delay_from", "route_delay_summary_from", "carrier_performance_from",
           "delay_cause_breakdown_from",
           "delay_cause_breakdown", "live_route_summary", "GOLD_CAUSES"]

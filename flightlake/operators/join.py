"""Flights × weather on the departure station (JOIN-1, PRJ-12..14).

The source job joins every flight to *every* weather row of its station with
no time condition, so n observations per station multiply each flight n
times (T8b). Two modes are offered:

* ``flight_weather`` — each station reduced to its latest observation, then a
  left join: the flight count is preserved.
* ``fanout_summary`` — the faithful all-rows join, evaluated *without*
  emitting the pairs: both sides are pre-aggregated per station (and weather
  category) and the pair counts / pair sums follow by multiplication. The
  result equals grouping the materialised fan-out, at the cost of two small
  aggregates.

The reduced weather side (one row per station) is written once to the
shared checkpoint folder, then broadcast only after its row count is checked
against ``max_broadcast_rows``; beyond that the join is salted, so a hub
airport's flights are spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fx
from ..schemas import ICAO_PREFIX
from ..sources.sinks import materialize_counted
from .dedupe import dedupe

# About 40k airports exist worldwide; 200k station rows stay a few MB wide.
MAX_BROADCAST_ROWS = 200_000

FLIGHT_COLUMNS = ["FL_DATE", "OP_CARRIER", "Origin", "Dest", "DEP_DELAY", "is_delayed"]
WEATHER_COLUMNS = ["visibility_sm", "flight_category", "temp_c", "wind_kt"]


def bounded_broadcast(df: DataFrame, rows: int, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` if it has at most ``max_rows`` rows, else ``df``; ``rows``
    is the count observed when ``df`` was written, not an estimate."""
    return F.broadcast(df) if rows <= max_rows else df


def station_of(flights: DataFrame, station_map: DataFrame | None = None,
               prefix: str = ICAO_PREFIX) -> DataFrame:
    """Add ``origin_icao``: from ``station_map`` (iata, airport_icao) when
    given and matching, else ``prefix`` + IATA code (T8)."""
    rule = fx.station_code("Origin", prefix)
    if station_map is None:
        return flights.withColumn("origin_icao", rule)
    # One code per airport, so the left join never multiplies flights.
    m = dedupe(station_map.select(F.col("iata").alias("_iata"),
                                  F.col("airport_icao").alias("_map_icao")), ["_iata"])
    m = bounded_broadcast(*materialize_counted(m, "station-map"))
    return (flights.join(m, F.col("Origin") == F.col("_iata"), "left")
            .withColumn("origin_icao", F.coalesce(F.col("_map_icao"), rule))
            .drop("_iata", "_map_icao"))


def latest_weather(weather: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per station: its latest observation (by parsed time, then text),
    with the ``keep`` columns — one aggregate that carries no others."""
    keep = WEATHER_COLUMNS if keep is None else keep
    best = F.max(F.struct(fx.obs_timestamp("obs_time").alias("_ts"), F.col("obs_time").alias("_text"),
                          *[F.col(c) for c in keep])).alias("_latest")
    return weather.groupBy("airport_icao").agg(best).select(
        "airport_icao", *[F.col(f"_latest.{c}") for c in keep])


def flight_weather(flights: DataFrame, weather: DataFrame,
                   station_map: DataFrame | None = None,
                   max_broadcast_rows: int = MAX_BROADCAST_ROWS,
                   salts: int | None = None) -> DataFrame:
    """Flights left-joined with the latest weather at the origin station.

    One row per flight (10 columns); flights without a station match keep
    null weather. The source's every-observation join multiplies each flight
    by its station's observation count; its grouped results are computed by
    :func:`fanout_summary` without producing the pairs.

    Strategy: the one-row-per-station weather side is broadcast when its row
    count passes the check. Otherwise the join is salted: each flight gets one
    of ``salts`` buckets (a hash of its row; as many as shuffle partitions by
    default) and every station row is
    replicated once per bucket, so a hub airport holding a third of all
    flights is spread over ``salts`` tasks instead of one.
    """
    w, rows = materialize_counted(latest_weather(weather), "weather-latest")
    salts = salts or int(flights.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    f = station_of(flights.select(*FLIGHT_COLUMNS), station_map)
    if rows <= max_broadcast_rows:
        j = f.join(F.broadcast(w), f["origin_icao"] == w["airport_icao"], "left")
    else:
        f = f.withColumn("_salt", F.pmod(F.xxhash64(*FLIGHT_COLUMNS), F.lit(salts)))
        w = w.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
        j = f.join(w, (f["origin_icao"] == w["airport_icao"]) & (f["_salt"] == w["_salt"]), "left")
    return j.select(*[f[c] for c in FLIGHT_COLUMNS], *[w[c] for c in WEATHER_COLUMNS])


def fanout_summary(flights: DataFrame, weather: DataFrame,
                   station_map: DataFrame | None = None,
                   max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Aggregates of the all-rows join per origin and weather category.

    Equal to grouping the every-observation left join by ``("Origin",
    "flight_category")`` with ``joined_rows = count(*)``,
    ``delayed_rows = sum(is_delayed as int)``, ``avg_dep_delay`` and
    ``avg_temp_c`` over the pairs — but no pair is ever produced: a station
    with m observations in a category contributes m copies of each flight, so
    counts and sums scale by m (and averages cancel it).
    """
    f = (station_of(flights, station_map)
         .groupBy("Origin", "origin_icao")
         .agg(fx.rows().alias("n_flights"),
              F.sum("DEP_DELAY").alias("sum_delay"),
              F.count("DEP_DELAY").alias("n_delay"),
              fx.true_count("is_delayed").alias("n_delayed")))
    w, rows = materialize_counted(weather.groupBy("airport_icao", "flight_category")
                    .agg(fx.rows().alias("n_obs"),
                         F.sum("temp_c").alias("sum_temp"),
                         F.count("temp_c").alias("n_temp")), "weather-by-category")
    w = bounded_broadcast(w, rows, max_broadcast_rows)
    j = f.join(w, f["origin_icao"] == w["airport_icao"], "left")
    m = F.coalesce(F.col("n_obs"), F.lit(1))
    n = F.col("n_flights")
    return j.select(
        F.col("Origin"),
        F.col("flight_category"),
        (n * m).alias("joined_rows"),
        F.when(F.col("n_delay") > 0,
               F.col("sum_delay") / F.col("n_delay")).alias("avg_dep_delay"),
        (F.col("n_delayed") * m).alias("delayed_rows"),
        F.when(F.col("n_temp") > 0,
               F.col("sum_temp") / F.col("n_temp")).alias("avg_temp_c"),
    )

"""Bronze → silver cleaning of the three feeds (JOB-1).

Each function is a pure ``DataFrame -> DataFrame`` transformation; filters
come before the dedupe, and nothing here triggers a job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as fx
from ..schemas import (LIVE_KEY, ONTIME_COLUMNS, ONTIME_DELAY_COLUMNS, ONTIME_KEY,
                       ONTIME_RENAMES, WEATHER_KEY)
from .dedupe import dedupe

# Fixed value of the flight poller's request: the flight status it asks for.
POLL_STATUSES = ["active"]
# Of several rows of a key in the JSON feeds the one ingested last stays.
NEWEST_FIRST = ["_ingested_at"]


def clean_ontime(raw: DataFrame) -> DataFrame:
    """On-time CSV text → typed rows (PRJ-5..9, FLT-3), before the dedupe.

    Keeps the 16 known columns, renames 13 of them, casts the seven delay
    columns with ``try_cast`` (bad text → null), derives ``is_delayed``
    (delay > 15 min) and ``is_cancelled`` (numeric or boolean text), and drops
    rows without an origin.
    """
    typed = (raw.select(*ONTIME_COLUMNS)
             .withColumnsRenamed(ONTIME_RENAMES)
             .withColumns({c: fx.minutes(c) for c in ONTIME_DELAY_COLUMNS}))
    return (typed
            .withColumns({"is_delayed": fx.is_delayed("DEP_DELAY"),
                          "is_cancelled": fx.flag("Cancelled")})
            .filter(F.col("Origin").isNotNull()))


def ontime_silver(raw: DataFrame, extra_keys: list[str] | None = None) -> DataFrame:
    """The silver on-time table: cleaned, one row per 5-column key (DST-2),
    rows with values before rows with nulls. Cancelled flights have no departure
    time, so those of one carrier, route and day share the key; ``extra_keys``
    (e.g. ``["TAIL_NUM"]``) keeps them apart."""
    return dedupe(clean_ontime(raw), ONTIME_KEY + list(extra_keys or []), descending=True, hashed=True)


def present(text: str) -> Column:
    """Blank text as null: a key without a value, however the feed writes it."""
    return F.when(F.trim(F.col(text)) != "", F.col(text))


def flatten_live(envelopes: DataFrame, statuses: list[str] | None = None) -> DataFrame:
    """Flight envelopes → one row per flight with 15 columns (PRJ-1/3, FLT-1).

    ``explode`` drops envelopes whose ``data`` is null or empty (an API error
    body). ``statuses`` keeps only those flight states (FLT-5, e.g.
    ``["active"]``); ``None`` keeps all.
    """
    f = envelopes.select(F.explode("flights.data").alias("f"), "_ingested_at")
    out = f.select(
        present("f.flight_date").alias("flight_date"),
        F.col("f.flight_status").alias("flight_status"),
        present("f.departure.iata").alias("origin"),
        F.col("f.departure.airport").alias("origin_airport"),
        fx.minutes("f.departure.delay").alias("dep_delay"),
        F.col("f.departure.scheduled").alias("scheduled_dep"),
        F.col("f.departure.actual").alias("actual_dep"),
        present("f.arrival.iata").alias("dest"),
        F.col("f.arrival.airport").alias("dest_airport"),
        fx.minutes("f.arrival.delay").alias("arr_delay"),
        F.col("f.airline.name").alias("airline_name"),
        F.col("f.airline.iata").alias("carrier"),
        present("f.flight.iata").alias("flight_iata"),
        F.col("f.aircraft.iata").alias("aircraft_type"),
        F.col("_ingested_at"),
    ).filter(F.col("origin").isNotNull())
    if statuses is not None:
        out = out.filter(F.col("flight_status").isin(list(statuses)))
    return out


def polled_flights(flat: DataFrame, statuses: list[str] | None = None) -> DataFrame:
    """Flattened flights in the statuses the poller asks for (FLT-5). The page
    size of its API is a limit of that service, not of the data kept here."""
    return flat.filter(F.col("flight_status").isin(list(statuses or POLL_STATUSES)))


def live_silver(envelopes: DataFrame, statuses: list[str] | None = None) -> DataFrame:
    """Flattened live flights, one row per (date, flight, origin, dest)
    (DST-1): the one ingested last."""
    return dedupe(flatten_live(envelopes, statuses), LIVE_KEY, NEWEST_FIRST, descending=True)


def flatten_weather(envelopes: DataFrame, stations: DataFrame | None = None) -> DataFrame:
    """Weather envelopes → one row per observation with 8 columns (PRJ-2/4, FLT-2).

    ``stations`` (a one-column frame ``airport_icao``) is the allow-list of
    polled stations (FLT-6), applied as a semi join; ``None`` keeps all.
    """
    r = envelopes.select(F.explode("records").alias("r"), "_ingested_at")
    out = r.select(
        F.col("r.icaoId").alias("airport_icao"),
        F.col("r.obsTime").alias("obs_time"),
        fx.minutes("r.temp").alias("temp_c"),
        fx.minutes("r.wspd").alias("wind_kt"),
        fx.visibility("r.visib").alias("visibility_sm"),
        F.col("r.fltCat").alias("flight_category"),
        F.col("r.rawOb").alias("raw_text"),
        F.col("_ingested_at"),
    ).filter(F.col("airport_icao").isNotNull())
    if stations is not None:
        out = out.join(stations.select("airport_icao"), "airport_icao", "left_semi")
    return out


def weather_silver(envelopes: DataFrame, stations: DataFrame | None = None) -> DataFrame:
    """Flattened weather, one row per (station, observation time): the one
    ingested last."""
    return dedupe(flatten_weather(envelopes, stations), WEATHER_KEY, NEWEST_FIRST, descending=True)


# Storage layout of the weather silver table: partitioned by observation day.
WEATHER_PARTITION = "obs_date"


def with_obs_date(weather: DataFrame) -> DataFrame:
    """Add the observation day (text, from ``obs_time``) used as the weather
    table's partition column. It is a function of the key, so adding it to the
    key changes nothing, and appends can prune to the days in a batch."""
    day = F.date_format(fx.obs_timestamp("obs_time"), "yyyy-MM-dd")
    return weather.withColumn(WEATHER_PARTITION, day)


def station_registry(nation: DataFrame, prefix: str = "K") -> DataFrame:
    """Polled stations derived from a place table: prefix + place name."""
    return nation.select(F.concat(F.lit(prefix), F.col("n_name")).alias("airport_icao"))

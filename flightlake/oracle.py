"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written directly in SQL — window ``row_number`` for the dedupes, a literal
fan-out join for the all-rows weather mode — so it shares no logic with the
Spark implementation, only the rules. Each query is ``WITH <fragments>
SELECT ...`` over the driver's pre-registered tables.
"""

from __future__ import annotations

from .schemas import (LIVE_KEY, LIVE_SILVER, ONTIME_KEY, ONTIME_SILVER, WEATHER_KEY,
                      WEATHER_SILVER)


def _order(cols, desc=False):
    d = "DESC NULLS LAST" if desc else "ASC NULLS FIRST"
    return ", ".join(f"{c} {d}" for c in cols)


def _rest(schema, keys):
    return [f.name for f in schema.fields if f.name not in keys]


def _cols(schema):
    return ", ".join(schema.fieldNames())


FRAGMENTS: dict[str, str] = {}

FRAGMENTS["li"] = """
li AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount,
         CAST(round(l_tax * 100) AS INTEGER) AS tax_pct,
         (l_returnflag = 'R' AND CAST(round(l_tax * 100) AS INTEGER) = 8) AS canc
  FROM lineitem
)"""

FRAGMENTS["ontime_raw"] = """
ontime_raw AS (
  SELECT strftime(o.o_orderdate, '%Y-%m-%d') AS FlightDate,
         substr(o.o_orderpriority, 1, 1) AS Reporting_Airline,
         'N' || CAST(li.l_partkey AS VARCHAR) AS Tail_Number,
         CASE WHEN li.l_suppkey % 50 <> 0 THEN ns.n_name END AS Origin,
         nc.n_name AS Dest,
         CASE WHEN NOT li.canc THEN CAST(((li.l_partkey + li.l_linenumber) % 24) * 100
                                         + li.l_suppkey % 60 AS VARCHAR) END AS DepTime,
         CASE WHEN NOT li.canc THEN CAST(CAST(li.l_quantity AS INTEGER) - 20 AS VARCHAR) || '.00'
              END AS DepDelay,
         CASE WHEN NOT li.canc THEN CAST(((li.l_partkey + li.l_linenumber + 2) % 24) * 100 AS VARCHAR)
              END AS ArrTime,
         CASE WHEN li.canc THEN NULL
              WHEN li.l_partkey % 97 = 0 THEN 'n/a'
              ELSE CAST(CAST(li.l_quantity AS INTEGER) - 24 + li.l_linenumber AS VARCHAR) || '.00'
              END AS ArrDelay,
         CASE WHEN li.canc THEN '1.00' ELSE '0.00' END AS Cancelled,
         CASE WHEN li.canc THEN substr('ABCD', CAST(1 + li.l_partkey % 4 AS INTEGER), 1) END
              AS CancellationCode,
         CASE WHEN NOT li.canc AND li.l_quantity > 35
              THEN CAST(li.l_linenumber AS VARCHAR) || '.00' END AS CarrierDelay,
         CASE WHEN NOT li.canc AND li.l_quantity > 35
              THEN CAST(CAST(round(li.l_discount * 100) AS INTEGER) AS VARCHAR) || '.00' END
              AS WeatherDelay,
         CASE WHEN NOT li.canc AND li.l_quantity > 35
              THEN CAST(li.tax_pct AS VARCHAR) || '.00' END AS NASDelay,
         CASE WHEN NOT li.canc AND li.l_quantity > 35 THEN '0.00' END AS SecurityDelay,
         CASE WHEN NOT li.canc AND li.l_quantity > 35
              THEN CAST(CAST(li.l_quantity AS INTEGER) - 35 AS VARCHAR) || '.00' END
              AS LateAircraftDelay
  FROM li
  JOIN orders o ON li.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation nc ON c.c_nationkey = nc.n_nationkey
  JOIN supplier s ON li.l_suppkey = s.s_suppkey
  JOIN nation ns ON s.s_nationkey = ns.n_nationkey
)"""

FRAGMENTS["ontime_clean"] = """
ontime_clean AS (
  SELECT FlightDate AS FL_DATE, Reporting_Airline AS OP_CARRIER, Tail_Number AS TAIL_NUM,
         Origin, Dest, DepTime AS DEP_TIME,
         TRY_CAST(DepDelay AS DOUBLE) AS DEP_DELAY,
         ArrTime AS ARR_TIME,
         TRY_CAST(ArrDelay AS DOUBLE) AS ARR_DELAY,
         Cancelled,
         CancellationCode AS CANCELLATION_CODE,
         TRY_CAST(CarrierDelay AS DOUBLE) AS CARRIER_DELAY,
         TRY_CAST(WeatherDelay AS DOUBLE) AS WEATHER_DELAY,
         TRY_CAST(NASDelay AS DOUBLE) AS NAS_DELAY,
         TRY_CAST(SecurityDelay AS DOUBLE) AS SECURITY_DELAY,
         TRY_CAST(LateAircraftDelay AS DOUBLE) AS LATE_AIRCRAFT_DELAY,
         TRY_CAST(DepDelay AS DOUBLE) > 15 AS is_delayed,
         CASE WHEN TRY_CAST(Cancelled AS DOUBLE) IS NOT NULL
              THEN TRY_CAST(Cancelled AS DOUBLE) <> 0
              ELSE TRY_CAST(Cancelled AS BOOLEAN) END AS is_cancelled
  FROM ontime_raw
  WHERE Origin IS NOT NULL
)"""

FRAGMENTS["ontime_silver"] = f"""
ontime_silver AS (
  SELECT {_cols(ONTIME_SILVER)} FROM (
    SELECT *, row_number() OVER (PARTITION BY {", ".join(ONTIME_KEY)}
                                 ORDER BY {_order(_rest(ONTIME_SILVER, ONTIME_KEY), desc=True)}) AS rn
    FROM ontime_clean) WHERE rn = 1
)"""

FRAGMENTS["ev_nation"] = """
ev_o AS (
  SELECT e.event_id, e.ts, e.user_id, e.event_type, e.value,
         n.n_name AS o_name, n.n_regionkey AS o_region
  FROM events e JOIN nation n ON e.user_id % 25 = n.n_nationkey
)"""

FRAGMENTS["weather_flat"] = """
weather_flat AS (
  SELECT icaoId AS airport_icao, obsTime AS obs_time,
         TRY_CAST(temp AS DOUBLE) AS temp_c,
         TRY_CAST(wspd AS DOUBLE) AS wind_kt,
         TRY_CAST(rtrim(visib, '+') AS DOUBLE) AS visibility_sm,
         fltCat AS flight_category,
         rawOb AS raw_text,
         _ingested_at
  FROM (
    SELECT CASE WHEN o_region = 4 THEN 'P' ELSE 'K' END || o_name AS icaoId,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS obsTime,
           CAST(CAST(floor(value) AS BIGINT) % 45 - 10 AS VARCHAR) AS temp,
           CAST(user_id % 30 AS VARCHAR) AS wspd,
           CASE WHEN event_type = 'error' THEN ''
                WHEN value > 100 THEN '10+'
                ELSE CAST(CAST(floor(value / 10) AS BIGINT) AS VARCHAR) END AS visib,
           CASE event_type WHEN 'click' THEN 'VFR' WHEN 'view' THEN 'MVFR'
                           WHEN 'purchase' THEN 'IFR' WHEN 'signup' THEN 'LIFR' END AS fltCat,
           CASE WHEN o_region = 4 THEN 'P' ELSE 'K' END || o_name || ' '
             || strftime(ts, '%d%H%M') || 'Z' AS rawOb,
           strftime(ts, '%Y-%m-%d') || 'T22:00:00' AS _ingested_at
    FROM ev_o) r
  WHERE icaoId IS NOT NULL
    AND icaoId IN (SELECT 'K' || n_name FROM nation)
)"""

FRAGMENTS["weather_silver"] = f"""
weather_silver AS (
  SELECT {_cols(WEATHER_SILVER)} FROM (
    SELECT *, row_number() OVER (PARTITION BY {", ".join(WEATHER_KEY)}
                                 ORDER BY {_order(["_ingested_at"] + _rest(WEATHER_SILVER, [*WEATHER_KEY, "_ingested_at"]), desc=True)}) AS rn
    FROM weather_flat) WHERE rn = 1
)"""

FRAGMENTS["weather_latest"] = f"""
weather_latest AS (
  SELECT {_cols(WEATHER_SILVER)} FROM (
    SELECT *, row_number() OVER (PARTITION BY airport_icao
              ORDER BY {_order(["obs_time"] + _rest(WEATHER_SILVER, ["airport_icao", "obs_time"]),
                               desc=True)}) AS rn
    FROM weather_silver) WHERE rn = 1
)"""

FRAGMENTS["live_flat"] = """
live_flat AS (
  SELECT CASE WHEN e.event_id % 53 <> 0 AND e.event_id % 59 <> 0
              THEN strftime(e.ts, '%Y-%m-%d') END AS flight_date,
         e.event_type AS flight_status,
         CASE WHEN e.event_id % 40 <> 0 THEN e.o_name END AS origin,
         e.o_name || ' Intl' AS origin_airport,
         CASE WHEN e.event_id % 11 <> 0 THEN CAST(CAST(floor(e.value) AS BIGINT) AS DOUBLE) END
              AS dep_delay,
         strftime(e.ts, '%Y-%m-%dT%H:%M:%S') AS scheduled_dep,
         CASE WHEN e.event_id % 11 <> 0 THEN strftime(e.ts, '%Y-%m-%dT%H:%M:%S') END AS actual_dep,
         d.n_name AS dest,
         d.n_name || ' Intl' AS dest_airport,
         CAST(CAST(floor(e.value / 2) AS BIGINT) AS DOUBLE) AS arr_delay,
         upper(e.event_type) || ' AIR' AS airline_name,
         upper(substr(e.event_type, 1, 1)) AS carrier,
         'F' || CAST(e.user_id AS VARCHAR) AS flight_iata,
         CASE WHEN e.event_type <> 'error' THEN 'A' || CAST(e.user_id % 4 AS VARCHAR) END
              AS aircraft_type,
         strftime(e.ts + CASE WHEN e.event_id % 3 = 0 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END, '%Y-%m-%d')
           || 'T22:00:00' AS _ingested_at
  FROM ev_o e JOIN nation d ON e.event_id % 25 = d.n_nationkey
  WHERE e.event_id % 40 <> 0
)"""

FRAGMENTS["live_silver"] = f"""
live_silver AS (
  SELECT {_cols(LIVE_SILVER)} FROM (
    SELECT *, row_number() OVER (PARTITION BY {", ".join(LIVE_KEY)}
                                 ORDER BY {_order(["_ingested_at"] + _rest(LIVE_SILVER, [*LIVE_KEY, "_ingested_at"]), desc=True)}) AS rn
    FROM live_flat) WHERE rn = 1
)"""

# Fragment dependencies, in definition order.
_DEPS = {
    "li": [],
    "ontime_raw": ["li"],
    "ontime_clean": ["ontime_raw"],
    "ontime_silver": ["ontime_clean"],
    "ev_nation": [],
    "weather_flat": ["ev_nation"],
    "weather_silver": ["weather_flat"],
    "weather_latest": ["weather_silver"],
    "live_flat": ["ev_nation"],
    "live_silver": ["live_flat"],
}


def with_(*names: str) -> str:
    """A WITH clause holding ``names`` and everything they depend on."""
    need: list[str] = []

    def add(n):
        for d in _DEPS[n]:
            add(d)
        if n not in need:
            need.append(n)
    for n in names:
        add(n)
    order = [n for n in _DEPS if n in need]
    return "WITH " + ",".join(FRAGMENTS[n] for n in order) + "\n"


def _rate(flag: str) -> str:
    return f"CAST(sum(CAST({flag} AS INTEGER)) AS BIGINT) / count(*)"


ORACLE: dict[str, str] = {}

ORACLE["route_delay_summary"] = with_("ontime_silver") + f"""
SELECT OP_CARRIER, Origin, Dest,
       avg(DEP_DELAY) AS avg_dep_delay,
       count(*) AS total_flights,
       {_rate("is_delayed")} AS delay_rate,
       avg(CARRIER_DELAY) AS avg_carrier_delay,
       avg(WEATHER_DELAY) AS avg_weather_delay,
       avg(NAS_DELAY) AS avg_nas_delay,
       avg(LATE_AIRCRAFT_DELAY) AS avg_late_aircraft_delay
FROM ontime_silver
GROUP BY OP_CARRIER, Origin, Dest
HAVING count(*) >= 10"""

ORACLE["airport_hourly_delay"] = with_("ontime_silver") + f"""
SELECT Origin,
       TRY_CAST(substr(lpad(DEP_TIME, 4, '0'), 1, 2) AS INTEGER) AS dep_hour,
       CAST(month(try_strptime(FL_DATE, '%Y-%m-%d')) AS INTEGER) AS month,
       avg(DEP_DELAY) AS avg_delay,
       count(*) AS total_flights,
       {_rate("is_delayed")} AS delay_rate
FROM ontime_silver
GROUP BY 1, 2, 3"""

ORACLE["carrier_performance"] = with_("ontime_silver") + f"""
SELECT OP_CARRIER,
       avg(DEP_DELAY) AS avg_dep_delay,
       avg(ARR_DELAY) AS avg_arr_delay,
       count(*) AS total_flights,
       {_rate("is_delayed")} AS delay_rate,
       CAST(sum(CAST(is_cancelled AS INTEGER)) AS BIGINT) AS total_cancelled
FROM ontime_silver
GROUP BY OP_CARRIER
ORDER BY delay_rate ASC NULLS FIRST, OP_CARRIER"""

ORACLE["delay_cause_breakdown"] = with_("ontime_silver") + """
SELECT Origin, OP_CARRIER,
       avg(CARRIER_DELAY) AS avg_carrier_delay,
       avg(WEATHER_DELAY) AS avg_weather_delay,
       avg(NAS_DELAY) AS avg_nas_delay,
       avg(LATE_AIRCRAFT_DELAY) AS avg_late_aircraft_delay,
       count(*) AS total_delayed_flights
FROM ontime_silver
WHERE is_delayed
GROUP BY Origin, OP_CARRIER
HAVING count(*) >= 5"""

ORACLE["live_route_summary"] = with_("live_silver") + """
SELECT carrier, origin, dest,
       count(*) AS total_flights,
       avg(dep_delay) AS avg_dep_delay,
       avg(arr_delay) AS avg_arr_delay,
       CAST(sum(CASE WHEN dep_delay > 15 THEN 1 ELSE 0 END) AS BIGINT) AS delayed_flights,
       first(aircraft_type ORDER BY flight_date ASC NULLS FIRST, scheduled_dep ASC NULLS FIRST,
             flight_iata ASC NULLS FIRST, aircraft_type ASC NULLS FIRST) AS aircraft_type
FROM live_silver
GROUP BY carrier, origin, dest
HAVING count(*) >= 2"""

ORACLE["flight_weather_latest"] = with_("ontime_silver", "weather_latest") + """
SELECT f.FL_DATE, f.OP_CARRIER, f.Origin, f.Dest, f.DEP_DELAY, f.is_delayed,
       w.visibility_sm, w.flight_category, w.temp_c, w.wind_kt
FROM ontime_silver f
LEFT JOIN weather_latest w ON 'K' || f.Origin = w.airport_icao"""

ORACLE["flight_weather_all"] = with_("ontime_silver", "weather_silver") + """
SELECT f.Origin, w.flight_category,
       count(*) AS joined_rows,
       avg(f.DEP_DELAY) AS avg_dep_delay,
       CAST(sum(CAST(f.is_delayed AS INTEGER)) AS BIGINT) AS delayed_rows,
       avg(w.temp_c) AS avg_temp_c
FROM ontime_silver f
LEFT JOIN weather_silver w ON 'K' || f.Origin = w.airport_icao
GROUP BY f.Origin, w.flight_category"""

ORACLE["flights_clean"] = with_("ontime_clean") + "SELECT * FROM ontime_clean"

ORACLE["flights_dedupe_keys"] = with_("ontime_clean") + f"""
SELECT {", ".join(ONTIME_KEY)}, count(*) AS n_rows
FROM ontime_clean
GROUP BY {", ".join(ONTIME_KEY)}"""

ORACLE["flights_dedupe_first"] = with_("ontime_silver") + "SELECT * FROM ontime_silver"

ORACLE["csv_roundtrip"] = ORACLE["flights_dedupe_first"]


# The three monthly folders: as expected, one column renamed, reordered with one missing.
_FOLDER = "'m' || (month(strptime(FlightDate, '%Y-%m-%d')) % 3)"


def _drift_sql() -> str:
    from .schemas import ONTIME_COLUMNS
    plain = [*ONTIME_COLUMNS, "Flights"]
    headers = {"m0": plain,
               "m1": ["SecurityDelayMinutes" if c == "SecurityDelay" else c for c in plain],
               "m2": ["Dest", "Origin"] + [c for c in plain if c not in ("Dest", "Origin", "Tail_Number")]}
    rows = []
    for folder, header in headers.items():
        rows += [f"('{folder}', '{c}', '{'ok' if c in ONTIME_COLUMNS else 'unexpected'}', {i + 1})"
                 for i, c in enumerate(header)]
        rows += [f"('{folder}', '{c}', 'missing', NULL)" for c in ONTIME_COLUMNS if c not in header]
    return (with_("ontime_raw") + f", counts AS (SELECT {_FOLDER} AS f, count(*) AS n_rows FROM ontime_raw GROUP BY 1)\n"
            "SELECT month_folder, column_name, status, CAST(position AS INTEGER) AS position, n_rows FROM (VALUES "
            + ", ".join(rows) + ") AS t(month_folder, column_name, status, position) JOIN counts ON f = month_folder")


ORACLE["schema_drift"] = _drift_sql()
ORACLE["csv_mixed_headers"] = (
    with_("ontime_raw") + f""", ontime_mixed AS (
  SELECT * REPLACE (CASE WHEN {_FOLDER} <> 'm1' THEN SecurityDelay END AS SecurityDelay,
                    CASE WHEN {_FOLDER} <> 'm2' THEN Tail_Number END AS Tail_Number) FROM ontime_raw),"""
    + FRAGMENTS["ontime_clean"].replace("FROM ontime_raw", "FROM ontime_mixed") + "," + FRAGMENTS["ontime_silver"]
    + "\nSELECT * FROM ontime_silver")
ORACLE["carrier_cancelled_by_tail"] = with_("ontime_clean") + f"""
SELECT OP_CARRIER, count(*) AS total_flights, CAST(sum(CAST(is_cancelled AS INTEGER)) AS BIGINT) AS total_cancelled
FROM (SELECT *, row_number() OVER (PARTITION BY {", ".join(ONTIME_KEY)}, TAIL_NUM
             ORDER BY {_order(_rest(ONTIME_SILVER, [*ONTIME_KEY, "TAIL_NUM"]), desc=True)}) AS rn FROM ontime_clean)
WHERE rn = 1 GROUP BY OP_CARRIER"""

ORACLE["live_flights_flat"] = with_("live_flat") + "SELECT * FROM live_flat"
ORACLE["live_flights_polled"] = with_("live_flat") + "SELECT * FROM live_flat WHERE flight_status = 'click'"
ORACLE["live_flights_dedupe"] = with_("live_silver") + "SELECT * FROM live_silver"
ORACLE["weather_flat"] = with_("weather_flat") + "SELECT * FROM weather_flat"
ORACLE["append_idempotent"] = ORACLE["live_flights_dedupe"]
ORACLE["stream_incremental"] = ORACLE["live_flights_dedupe"]
ORACLE["stream_repolled"] = ORACLE["live_flights_dedupe"]
ORACLE["merge_replay"] = ORACLE["live_flights_dedupe"]
ORACLE["append_replay"] = with_("live_flat") + f"""
SELECT {", ".join(LIVE_KEY)}, 1::BIGINT AS n_rows FROM live_flat GROUP BY {", ".join(LIVE_KEY)}"""
ORACLE["stream_weather"] = with_("weather_silver") + "SELECT * FROM weather_silver"
ORACLE["nightly_metar"] = ORACLE["stream_weather"]
ORACLE["weather_polled"] = with_("weather_flat") + """
SELECT * FROM weather_flat WHERE airport_icao IN (SELECT 'K' || n_name FROM nation WHERE n_regionkey <= 1)"""
ORACLE["landing_stamp"] = "SELECT count(*) AS n_rows, 1::BIGINT AS n_stamps, true AS day_is_folder FROM events JOIN nation ON user_id % 25 = n_nationkey"
ORACLE["bronze_rejects"] = with_("ev_nation") + """
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) FILTER (NOT cut) AS n_read, count(*) FILTER (cut) AS n_rejects
FROM (SELECT ts, regexp_matches(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '[05]$') AS cut FROM ev_o) GROUP BY 1"""

_HOUR = "TRY_CAST(substr(lpad(DEP_TIME, 4, '0'), 1, 2) AS INTEGER)"
_MONTH = "CAST(month(try_strptime(FL_DATE, '%Y-%m-%d')) AS INTEGER)"

ORACLE["report_hour_risk"] = with_("ontime_silver") + f"""
SELECT dep_hour, total_flights, avg_delay, delay_rate,
       CAST(row_number() OVER (ORDER BY delay_rate DESC NULLS LAST, dep_hour ASC NULLS LAST)
            AS INTEGER) AS risk_rank
FROM (SELECT {_HOUR} AS dep_hour, count(*) AS total_flights, avg(DEP_DELAY) AS avg_delay,
             {_rate("is_delayed")} AS delay_rate
      FROM ontime_silver GROUP BY 1) h"""

ORACLE["report_worst_routes"] = with_("ontime_silver") + f"""
SELECT OP_CARRIER, Origin, Dest, avg_dep_delay, total_flights, delay_rate
FROM (SELECT OP_CARRIER, Origin, Dest, avg(DEP_DELAY) AS avg_dep_delay,
             count(*) AS total_flights, {_rate("is_delayed")} AS delay_rate
      FROM ontime_silver GROUP BY OP_CARRIER, Origin, Dest HAVING count(*) >= 10) r
ORDER BY avg_dep_delay DESC NULLS LAST, OP_CARRIER, Origin, Dest
LIMIT 10"""

ORACLE["report_weather_category"] = with_("ontime_silver", "weather_latest") + f"""
SELECT w.flight_category, count(*) AS total_flights, avg(f.DEP_DELAY) AS avg_dep_delay,
       {_rate("f.is_delayed")} AS delay_rate
FROM ontime_silver f
LEFT JOIN weather_latest w ON 'K' || f.Origin = w.airport_icao
GROUP BY w.flight_category"""

ORACLE["report_carrier_ranking"] = with_("ontime_silver") + f"""
SELECT OP_CARRIER, avg_dep_delay, avg_arr_delay, total_flights, delay_rate, total_cancelled,
       delay_rank, delay_rank = 1 AS is_best
FROM (SELECT *, CAST(row_number() OVER (ORDER BY avg_dep_delay ASC NULLS LAST, OP_CARRIER)
                     AS INTEGER) AS delay_rank
      FROM (SELECT OP_CARRIER, avg(DEP_DELAY) AS avg_dep_delay, avg(ARR_DELAY) AS avg_arr_delay,
                   count(*) AS total_flights, {_rate("is_delayed")} AS delay_rate,
                   CAST(sum(CAST(is_cancelled AS INTEGER)) AS BIGINT) AS total_cancelled
            FROM ontime_silver GROUP BY OP_CARRIER) c) r"""

ORACLE["report_cause_share"] = with_("ontime_silver") + """,
s AS (SELECT sum(CARRIER_DELAY) AS c, sum(WEATHER_DELAY) AS w, sum(NAS_DELAY) AS n,
             sum(LATE_AIRCRAFT_DELAY) AS l FROM ontime_silver),
t AS (SELECT *, coalesce(c, 0) + coalesce(w, 0) + coalesce(n, 0) + coalesce(l, 0) AS total FROM s)
SELECT 'carrier' AS cause, c AS delay_minutes, CASE WHEN total > 0 THEN c / total END AS share FROM t
UNION ALL SELECT 'weather', w, CASE WHEN total > 0 THEN w / total END FROM t
UNION ALL SELECT 'nas', n, CASE WHEN total > 0 THEN n / total END FROM t
UNION ALL SELECT 'late_aircraft', l, CASE WHEN total > 0 THEN l / total END FROM t"""

ORACLE["report_live_monitor"] = with_("live_silver") + """
SELECT carrier, origin, dest, total_flights, delayed_flights,
       delayed_flights / total_flights AS delayed_share,
       avg_dep_delay, avg_arr_delay, aircraft_type
FROM (SELECT carrier, origin, dest, count(*) AS total_flights,
             avg(dep_delay) AS avg_dep_delay, avg(arr_delay) AS avg_arr_delay,
             CAST(sum(CASE WHEN dep_delay > 15 THEN 1 ELSE 0 END) AS BIGINT) AS delayed_flights,
             first(aircraft_type ORDER BY flight_date ASC NULLS FIRST, scheduled_dep ASC NULLS FIRST,
                   flight_iata ASC NULLS FIRST, aircraft_type ASC NULLS FIRST) AS aircraft_type
      FROM live_silver GROUP BY carrier, origin, dest HAVING count(*) >= 2) r"""


def _count(layer: str, name: str, body: str) -> str:
    return (f"SELECT '{layer}' AS layer, '{name}' AS table_name, 'ok' AS status, "
            f"count(*) AS rows_written, count(*) AS rows_read FROM ({body}) x")


ORACLE["gold_row_audit"] = with_("ontime_silver", "weather_latest", "live_silver") + \
    "\nUNION ALL\n".join([
        "SELECT 'bronze' AS layer, 'flights_rejects' AS table_name, 'ok' AS status, 0 AS rows_written, NULL AS rows_read",
        "SELECT 'bronze', 'weather_rejects', 'ok', 0, NULL",
        "SELECT 'shared', 'route_partials', 'ok', count(*), NULL FROM "
        "(SELECT 1 FROM ontime_silver GROUP BY OP_CARRIER, Origin, Dest) x",
        _count("silver", "aviationstack_flights", "SELECT 1 FROM live_silver"),
        _count("silver", "metar", "SELECT 1 FROM weather_silver"),
        _count("silver", "bts_flights", "SELECT 1 FROM ontime_silver"),
        _count("gold", "airport_hourly_delay",
               f"SELECT 1 FROM ontime_silver GROUP BY Origin, {_HOUR}, {_MONTH}"),
        _count("gold", "route_delay_summary",
               "SELECT 1 FROM ontime_silver GROUP BY OP_CARRIER, Origin, Dest HAVING count(*) >= 10"),
        _count("gold", "carrier_performance", "SELECT 1 FROM ontime_silver GROUP BY OP_CARRIER"),
        _count("gold", "delay_cause_breakdown",
               "SELECT 1 FROM ontime_silver WHERE is_delayed GROUP BY Origin, OP_CARRIER "
               "HAVING count(*) >= 5"),
        _count("gold", "flight_weather_joined",
               "SELECT 1 FROM ontime_silver f LEFT JOIN weather_latest w "
               "ON 'K' || f.Origin = w.airport_icao"),
        _count("gold", "aviationstack_summary",
               "SELECT 1 FROM live_silver GROUP BY carrier, origin, dest HAVING count(*) >= 2"),
    ])

# What the nightly job wrote, read back.
for _gold, _same in (("airport_hourly_delay", "airport_hourly_delay"), ("route_delay_summary", "route_delay_summary"),
                     ("carrier_performance", "carrier_performance"), ("delay_cause_breakdown", "delay_cause_breakdown"),
                     ("flight_weather_joined", "flight_weather_latest"), ("aviationstack_summary", "live_route_summary")):
    ORACLE[f"nightly_{_gold}"] = ORACLE[_same]

ORACLE["nightly_route_flights"] = with_("ontime_silver") + """
SELECT * FROM ontime_silver WHERE Origin = (SELECT min(Origin) FROM ontime_silver)"""

# Two nights of the weather feed: keys of the first half of the month, then the others.
ORACLE["nightly_history"] = with_("weather_silver") + f""",
c AS (SELECT (SELECT count(*) FROM weather_silver) AS whole,
             (SELECT count(*) FROM (SELECT DISTINCT {", ".join(WEATHER_KEY)} FROM weather_flat
                                    WHERE substr(_ingested_at, 9, 2) <= '15')) AS half),
nights AS (
  SELECT 'silver' AS layer, 'metar' AS table_name, 1 AS night, half AS rows_written, CAST(half AS DOUBLE) AS usual FROM c
  UNION ALL SELECT 'silver', 'metar', 2, whole - half, half FROM c
  UNION ALL SELECT 'bronze', 'weather_rejects', unnest([1, 2]), 0, 0)
SELECT layer, table_name, night, rows_written, 1::BIGINT AS n_past, usual, false AS unusual FROM nights"""

ORACLE["catalog_worst_routes"] = ORACLE["report_worst_routes"]
ORACLE["catalog_best_carrier"] = with_("ontime_silver") + """
SELECT OP_CARRIER, avg(DEP_DELAY) AS avg_dep_delay FROM ontime_silver
GROUP BY OP_CARRIER ORDER BY avg_dep_delay ASC NULLS LAST, OP_CARRIER LIMIT 1"""
ORACLE["catalog_weather_category"] = ORACLE["report_weather_category"]

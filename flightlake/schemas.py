"""Schemas and fixed values of the three feeds and the silver/gold tables.

Bronze schemas are explicit: inferring JSON breaks on real days (an all-null
struct infers ``string``, an empty array ``array<string>``, an error body has
no ``data`` at all), and inferring CSV costs a full pass over the input.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

# --- fixed values (must equal the source systems' names and rules) ----------

# On-time CSV header names kept for silver, in file order.
ONTIME_COLUMNS = [
    "FlightDate", "Reporting_Airline", "Tail_Number", "Origin", "Dest",
    "DepTime", "DepDelay", "ArrTime", "ArrDelay", "Cancelled",
    "CancellationCode", "CarrierDelay", "WeatherDelay", "NASDelay",
    "SecurityDelay", "LateAircraftDelay",
]
# Renames to the silver naming standard (Origin, Dest, Cancelled keep theirs).
ONTIME_RENAMES = {
    "FlightDate": "FL_DATE",
    "Reporting_Airline": "OP_CARRIER",
    "Tail_Number": "TAIL_NUM",
    "DepTime": "DEP_TIME",
    "DepDelay": "DEP_DELAY",
    "ArrTime": "ARR_TIME",
    "ArrDelay": "ARR_DELAY",
    "CancellationCode": "CANCELLATION_CODE",
    "CarrierDelay": "CARRIER_DELAY",
    "WeatherDelay": "WEATHER_DELAY",
    "NASDelay": "NAS_DELAY",
    "SecurityDelay": "SECURITY_DELAY",
    "LateAircraftDelay": "LATE_AIRCRAFT_DELAY",
}
# Delay columns that are cast from text to double.
ONTIME_DELAY_COLUMNS = [
    "DEP_DELAY", "ARR_DELAY", "CARRIER_DELAY", "WEATHER_DELAY",
    "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY",
]
# Natural keys of the silver tables.
ONTIME_KEY = ["FL_DATE", "OP_CARRIER", "Origin", "Dest", "DEP_TIME"]
LIVE_KEY = ["flight_date", "flight_iata", "origin", "dest"]
WEATHER_KEY = ["airport_icao", "obs_time"]
# A flight is delayed when it departs more than 15 minutes late.
DELAY_THRESHOLD_MIN = 15
# US stations: ICAO code = "K" + IATA code.
ICAO_PREFIX = "K"
# Support thresholds of the gold tables.
MIN_ROUTE_FLIGHTS = 10
MIN_DELAYED_FLIGHTS = 5
MIN_LIVE_FLIGHTS = 2
# Weather stations polled by the weather feed.
POLLED_STATIONS = [
    "KORD", "KJFK", "KLAX", "KSFO", "KATL",
    "KDEN", "KDFW", "KMIA", "KBOS", "KSEA",
    "KPHX", "KEWR", "KLGA", "KIAH", "KFLL",
    "KMCO", "KMDW", "KDTW", "KMSP", "KBWI",
]
# The four delay causes carried into gold (security delay stays in silver).
GOLD_CAUSES = ["CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "LATE_AIRCRAFT_DELAY"]
ALL_CAUSES = ["CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY",
              "LATE_AIRCRAFT_DELAY"]

# --- bronze ------------------------------------------------------------------

_code = T.StructType([T.StructField("iata", S)])
FLIGHT_RECORD = T.StructType([
    T.StructField("flight_date", S),
    T.StructField("flight_status", S),
    T.StructField("departure", T.StructType([
        T.StructField("iata", S), T.StructField("airport", S),
        T.StructField("delay", S), T.StructField("scheduled", S),
        T.StructField("actual", S)])),
    T.StructField("arrival", T.StructType([
        T.StructField("iata", S), T.StructField("airport", S),
        T.StructField("delay", S)])),
    T.StructField("airline", T.StructType([
        T.StructField("name", S), T.StructField("iata", S)])),
    T.StructField("flight", _code),
    T.StructField("aircraft", _code),
])
# One envelope = one poll: the whole API body plus the ingestion time.
FLIGHT_ENVELOPE = T.StructType([
    T.StructField("flights", T.StructType([
        T.StructField("data", T.ArrayType(FLIGHT_RECORD))])),
    T.StructField("_ingested_at", S),
])

WEATHER_RECORD = T.StructType([
    T.StructField("icaoId", S), T.StructField("obsTime", S),
    T.StructField("temp", S), T.StructField("wspd", S),
    T.StructField("visib", S), T.StructField("fltCat", S),
    T.StructField("rawOb", S),
])
WEATHER_ENVELOPE = T.StructType([
    T.StructField("records", T.ArrayType(WEATHER_RECORD)),
    T.StructField("_ingested_at", S),
])

# --- silver ------------------------------------------------------------------

D = T.DoubleType()
B = T.BooleanType()

ONTIME_SILVER = T.StructType(
    [T.StructField(c, D if c in ONTIME_DELAY_COLUMNS else S)
     for c in ["FL_DATE", "OP_CARRIER", "TAIL_NUM", "Origin", "Dest", "DEP_TIME",
               "DEP_DELAY", "ARR_TIME", "ARR_DELAY", "Cancelled",
               "CANCELLATION_CODE", "CARRIER_DELAY", "WEATHER_DELAY",
               "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY"]]
    + [T.StructField("is_delayed", B), T.StructField("is_cancelled", B)]
)

LIVE_SILVER = T.StructType([
    T.StructField("flight_date", S), T.StructField("flight_status", S),
    T.StructField("origin", S), T.StructField("origin_airport", S),
    T.StructField("dep_delay", D), T.StructField("scheduled_dep", S),
    T.StructField("actual_dep", S), T.StructField("dest", S),
    T.StructField("dest_airport", S), T.StructField("arr_delay", D),
    T.StructField("airline_name", S), T.StructField("carrier", S),
    T.StructField("flight_iata", S), T.StructField("aircraft_type", S),
    T.StructField("_ingested_at", S),
])

WEATHER_SILVER = T.StructType([
    T.StructField("airport_icao", S), T.StructField("obs_time", S),
    T.StructField("temp_c", D), T.StructField("wind_kt", D),
    T.StructField("visibility_sm", D), T.StructField("flight_category", S),
    T.StructField("raw_text", S), T.StructField("_ingested_at", S),
])

"""The two nightly jobs with fault isolation and an audit (JOB-1..3, CNT-1).

A failing source or table is recorded and the others continue; unlike the
source jobs (which print and exit green, T10) the run raises at the end when
anything failed, unless ``raise_on_failure=False``. Row counts come from an
``Observation`` on each write — one execution per table, no second count.

Layout of a lake root::

    bronze/flights/ingest_date=YYYY-MM-DD/*.json*
    bronze/weather/ingest_date=YYYY-MM-DD/*.json*
    bronze/ontime/*.csv*
    silver/{bts_flights, aviationstack_flights, metar}
    gold/{airport_hourly_delay, route_delay_summary, carrier_performance,
          delay_cause_breakdown, flight_weather_joined, aviationstack_summary}
    _partials/                 mergeable sums per month (:mod:`plans.partials`)

Replaced tables are versioned (:mod:`sources.versions`); read them with ``read_gold``
and ``read_silver``.
"""

from __future__ import annotations

import traceback
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import operators as op
from ..schemas import LIVE_SILVER, ONTIME_SILVER, WEATHER_SILVER
from ..sources import bronze
from ..sources.sinks import PART, read_parted, replace_table, with_part
from ..sources.versions import current, read_table
from ..streaming.incremental import ingest_stream
from .partials import read_partials, refresh_partials

AUDIT_SCHEMA = T.StructType([
    T.StructField("layer", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_written", T.LongType()),
    T.StructField("error", T.StringType()),
])


# The on-time table lies by month, inside it by airport and route.
ROUTE = ["Origin", "Dest"]


@dataclass
class Lake:
    root: str

    def bronze(self, feed: str) -> str:
        return f"{self.root}/bronze/{feed}"

    def silver(self, name: str) -> str:
        return f"{self.root}/silver/{name}"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    def partials(self) -> str:
        return f"{self.root}/_partials"

    def checkpoint(self, feed: str) -> str:
        return f"{self.root}/_checkpoints/{feed}"

    def rejects(self, feed: str) -> str:
        return f"{self.root}/rejects/{feed}"


class JobFailed(RuntimeError):
    def __init__(self, audit: list[tuple]):
        failed = [a for a in audit if a[2] != "ok"]
        super().__init__(f"{len(failed)} table(s) failed: " + ", ".join(a[1] for a in failed))
        self.audit = audit


def _run_one(layer: str, name: str, step: Callable[[], int]) -> tuple:
    try:
        return (layer, name, "ok", int(step()), None)
    except Exception as e:  # noqa: BLE001 - isolation is the point
        traceback.print_exc(limit=1)
        return (layer, name, "failed", None, f"{type(e).__name__}: {e}")


def run_steps(layer: str, steps: list[tuple[str, Callable[[], int]]],
              concurrency: int = 1) -> list[tuple]:
    """Run each step in isolation; return audit tuples in step order.

    With ``concurrency > 1`` independent steps are submitted as concurrent
    Spark jobs from a small thread pool, so a small table's job overlaps with
    a large one instead of leaving executors idle between jobs.
    """
    if concurrency <= 1:
        return [_run_one(layer, n, s) for n, s in steps]
    with ThreadPoolExecutor(max_workers=concurrency, thread_name_prefix=layer) as pool:
        futures = [pool.submit(_run_one, layer, n, s) for n, s in steps]
        return [f.result() for f in futures]


def read_silver(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    schema = {"bts_flights": ONTIME_SILVER, "aviationstack_flights": LIVE_SILVER,
              "metar": WEATHER_SILVER}[name]
    df = read_table(spark, lake.silver(name), schema)
    return df.select(*schema.fieldNames())


def read_gold(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    return read_table(spark, lake.gold(name))


def route_flights(spark: SparkSession, lake: Lake, origin: str, dest: str | None = None) -> DataFrame:
    """The on-time flights from one airport (to one other). The table is clustered by
    them, so the scan reads the row groups whose range holds the airport."""
    flights = read_silver(spark, lake, "bts_flights").where(F.col("Origin") == origin)
    return flights if dest is None else flights.where(F.col("Dest") == dest)


def wanted(only: Iterable[str] | None) -> Callable[[str], bool]:
    """Whether a table is to be built: all, or those of ``only``."""
    names = None if only is None else set(only)
    return lambda name: names is None or name in names


def build_silver(spark: SparkSession, lake: Lake,
                     stations: DataFrame | None = None, concurrency: int = 3,
                 only: Iterable[str] | None = None, replay: bool = False,
                 seen_for: str | None = None) -> list[tuple]:
    """JOB-1: on-time CSV → overwrite (by month); flight and weather JSON → merge.

    The JSON feeds catch up through the file stream (:func:`streaming.ingest_stream`):
    only snapshot files not seen before are read, and merged into silver by day,
    so the table equals one dedupe over everything landed so far, also when a
    later snapshot re-reports a flight, and a re-run rewrites no file. The audit's row
    count for these tables is the number of keys added. Lines that are no JSON of
    the feed are counted during the merge and stored under ``rejects/`` if any.
    ``only`` names the tables to build, ``replay`` and ``seen_for`` are those of the stream."""
    rejected: list[tuple] = []

    def ontime() -> int:
        raw = bronze.read_ontime_csv(spark, f"{lake.bronze('ontime')}/*.csv*")
        month = with_part(op.ontime_silver(raw).withColumn("_month", F.substring("FL_DATE", 1, 7)), "_month")
        return replace_table(month.drop("_month"), lake.silver("bts_flights"), [PART], name="bts_flights", cluster_by=ROUTE)

    def feed(kind: str, table: str) -> int:
        done = ingest_stream(spark, lake.bronze(kind), lake.silver(table), kind, lake.checkpoint(kind),
                             stations, rejects_path=lake.rejects(kind), replay=replay, seen_for=seen_for)
        rejected.append(("bronze", f"{kind}_rejects", "ok", done["rejects"], None))
        return done["rows"]

    def flights() -> int:
        return feed("flights", "aviationstack_flights")

    def weather() -> int:
        return feed("weather", "metar")

    steps = [("aviationstack_flights", flights), ("metar", weather), ("bts_flights", ontime)]
    audit = run_steps("silver", [x for x in steps if wanted(only)(x[0])], concurrency)
    return sorted(rejected) + audit


def build_gold(spark: SparkSession, lake: Lake, concurrency: int = 3,
               only: Iterable[str] | None = None) -> list[tuple]:
    """JOB-2: the six gold tables, each a full overwrite; ``only`` names some of them.

    The four on-time delay tables roll up from partials of which only changed months
    are computed again (:mod:`plans.partials`), an audited step of its own whose row
    count is that of the routes; without it the four fail."""
    def gold(name: str, build: Callable[[], DataFrame]) -> tuple[str, Callable[[], int]]:
        return name, lambda: replace_table(build(), lake.gold(name), name=name)

    def bts() -> DataFrame:
        return read_silver(spark, lake, "bts_flights")

    def refresh() -> int:
        silver = read_parted(spark, current(spark, lake.silver("bts_flights")), ONTIME_SILVER)
        return refresh_partials(spark, silver, lake.partials()).routes

    shared: list[tuple] = []

    def partials(name: str) -> DataFrame:
        if shared[0][2] != "ok":
            raise RuntimeError("route_partials failed")
        return read_partials(spark, lake.partials(), name)

    delay = [
        gold("airport_hourly_delay", lambda: op.airport_hourly_delay_from(partials("hours_by_month"))),
        gold("route_delay_summary", lambda: op.route_delay_summary_from(partials("routes"))),
        gold("carrier_performance", lambda: op.carrier_performance_from(partials("routes"))),
        gold("delay_cause_breakdown", lambda: op.delay_cause_breakdown_from(partials("routes"))),
    ]
    steps = delay + [
        gold("flight_weather_joined",
             lambda: op.flight_weather(bts(), read_silver(spark, lake, "metar"))),
        gold("aviationstack_summary",
             lambda: op.live_route_summary(read_silver(spark, lake, "aviationstack_flights"))),
    ]
    want = wanted(only)
    if any(want(name) for name, _ in delay):
        shared += run_steps("shared", [("route_partials", refresh)])
    return shared + run_steps("gold", [x for x in steps if want(x[0])], concurrency)


def audit_frame(spark: SparkSession, audit: list[tuple]) -> DataFrame:
    return spark.createDataFrame(audit, AUDIT_SCHEMA)


def run_nightly(spark: SparkSession, lake: Lake, stations: DataFrame | None = None,
                raise_on_failure: bool = True, concurrency: int = 3,
                only: Iterable[str] | None = None, replay: bool = False,
                seen_for: str | None = None) -> DataFrame:
    """JOB-1 then JOB-2; the audit as a DataFrame (raises after both if any failed).
    ``only`` limits both to some tables, whose inputs have to be there or among them."""
    only = None if only is None else set(only)
    audit = (build_silver(spark, lake, stations, concurrency, only, replay, seen_for)
             + build_gold(spark, lake, concurrency, only))
    if raise_on_failure and any(a[2] != "ok" for a in audit):
        raise JobFailed(audit)
    return audit_frame(spark, audit)


GOLD_TABLES = ["airport_hourly_delay", "route_delay_summary", "carrier_performance",
               "delay_cause_breakdown", "flight_weather_joined", "aviationstack_summary"]
SILVER_TABLES = ["bts_flights", "aviationstack_flights", "metar"]
# What each gold table is built from.
GOLD_INPUTS = {
    "airport_hourly_delay": ["bts_flights"],
    "route_delay_summary": ["bts_flights"],
    "carrier_performance": ["bts_flights"],
    "delay_cause_breakdown": ["bts_flights"],
    "flight_weather_joined": ["bts_flights", "metar"],
    "aviationstack_summary": ["aviationstack_flights"],
}

"""Command line for the lake jobs (what the nightly schedule runs).

    python -m flightlake land    --lake ROOT --feed flights|weather --payload GLOB
    python -m flightlake nightly --lake ROOT [--stations CSV | --all-stations] [--replay]
                                 [--only TABLE ...] [--catalog DATABASE]
    python -m flightlake stream  --lake ROOT --feed flights|weather [--max-files N]
                                 [--stations CSV | --all-stations] [--replay]
                                 [--mode merge|append]
    python -m flightlake report  --lake ROOT NAME [--k 10] [--out FOLDER]

``ROOT`` holds ``bronze/``, ``silver/`` and ``gold/`` (see ``plans.jobs``).
On a cluster, pass it through ``spark-submit`` with ``spark.checkpoint.dir``
set to a shared folder; the session's own settings are kept.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .plans import catalog, history, jobs, reports
from .schemas import FLIGHT_RECORD, POLLED_STATIONS, WEATHER_RECORD
from .session import SESSION_DEFAULTS
from .sources import bronze

REPORTS = {
    "hour_risk": lambda s, lake, k: reports.hour_risk(jobs.read_silver(s, lake, "bts_flights")),
    "worst_routes": lambda s, lake, k: reports.worst_routes(
        jobs.read_gold(s, lake, "route_delay_summary"), k),
    "weather_category": lambda s, lake, k: reports.weather_category(
        jobs.read_gold(s, lake, "flight_weather_joined")),
    "carrier_ranking": lambda s, lake, k: reports.carrier_ranking(
        jobs.read_gold(s, lake, "carrier_performance")),
    "cause_share": lambda s, lake, k: reports.cause_share(
        jobs.read_silver(s, lake, "bts_flights")),
    "live_monitor": lambda s, lake, k: reports.live_monitor(
        jobs.read_gold(s, lake, "aviationstack_summary")),
}


def _session() -> SparkSession:
    b = SparkSession.builder.appName("flightlake")
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    return b.getOrCreate()


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="flightlake")
    sub = p.add_subparsers(dest="cmd", required=True)
    n = sub.add_parser("nightly", help="bronze → silver → gold with audit")
    n.add_argument("--lake", required=True)
    n.add_argument("--only", nargs="+", choices=[*jobs.SILVER_TABLES, *jobs.GOLD_TABLES], help="build these tables only")
    n.add_argument("--catalog", help="register the tables in this database of the session's catalog")
    n.add_argument("--concurrency", type=int, default=3)
    ld = sub.add_parser("land", help="stamp API records (JSON lines) and land them as snapshots")
    ld.add_argument("--lake", required=True)
    ld.add_argument("--feed", choices=["flights", "weather"], required=True)
    ld.add_argument("--payload", required=True)
    st = sub.add_parser("stream", help="incremental ingestion of one JSON feed")
    st.add_argument("--lake", required=True)
    st.add_argument("--feed", choices=["flights", "weather"], required=True)
    st.add_argument("--max-files", type=int)
    st.add_argument("--mode", choices=["merge", "append"], default="merge",
                    help="merge: re-pick each touched day's rows (default); "
                         "append: write only unseen keys")
    for job in (n, st):  # one default for one table
        job.add_argument("--stations", help="CSV with an airport_icao column (allow-list; default: the polled stations)")
        job.add_argument("--all-stations", action="store_true", help="keep every station")
        job.add_argument("--replay", action="store_true", help="read all landed files again if the list of stations changed")
        job.add_argument("--seen-for", help="drop lines that came before within this time, e.g. '7 days' (one choice per lake)")
    r = sub.add_parser("report", help="one business report")
    r.add_argument("--lake", required=True)
    r.add_argument("name", choices=sorted([*REPORTS, *catalog.REPORT_SQL]))
    r.add_argument("--k", type=int, default=10, help="rows to print, and of the worst routes")
    r.add_argument("--out", help="write the whole report as CSV below this folder instead of printing k rows")
    a = p.parse_args(argv)

    spark = _session()
    lake = jobs.Lake(a.lake.rstrip("/"))
    stations = None
    if getattr(a, "stations", None):
        stations = (spark.read.option("header", True).csv(a.stations)
                    .select(F.col("airport_icao")))
    elif a.cmd in ("nightly", "stream") and not a.all_stations:
        stations = spark.createDataFrame([(c,) for c in POLLED_STATIONS], "airport_icao string")
    if a.cmd == "land":
        record = {"flights": FLIGHT_RECORD, "weather": WEATHER_RECORD}[a.feed]
        payload = spark.read.schema(record).json(a.payload).select(F.struct(*record.fieldNames()).alias("record"))
        bronze.land_snapshot(bronze.stamp_ingestion(payload), lake.bronze(a.feed), a.feed)
        return 0
    if a.cmd == "nightly":
        audit = jobs.run_nightly(spark, lake, stations, raise_on_failure=False,
                                 concurrency=a.concurrency, only=a.only, replay=a.replay, seen_for=a.seen_for)
        if a.catalog:
            catalog.create_tables(spark, lake, a.catalog, a.only)
        audit.show(audit.count(), truncate=False)
        history.record(lake, audit)
        marked = history.judged(history.read(spark, lake)).where("unusual")
        if not marked.isEmpty():
            print("Unusual row counts:")
            marked.show(truncate=False)
        return 1 if audit.filter(F.col("status") != "ok").count() else 0
    if a.cmd == "stream":
        from .streaming import ingest_stream
        silver = lake.silver({"flights": "aviationstack_flights", "weather": "metar"}[a.feed])
        done = ingest_stream(spark, lake.bronze(a.feed), silver, a.feed,
                             lake.checkpoint(a.feed), stations, a.max_files,
                             mode=a.mode, rejects_path=lake.rejects(a.feed), replay=a.replay,
                             seen_for=a.seen_for)
        print(done)
        return 0
    if a.name in REPORTS:
        report = REPORTS[a.name](spark, lake, a.k)
    else:
        catalog.register_lake(spark, lake)
        report = catalog.report_sql(spark, a.name, k=a.k)
    if a.out:
        report.write.option("header", True).csv(a.out)
    else:
        report.show(a.k, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())

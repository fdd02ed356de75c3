"""The registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each reads the driver's tables under ``sf_dir``, derives the bronze feeds
from them (``sources.surrogate``) and runs the pipeline stage the name
refers to over all rows. Queries that exercise files (CSV/JSON round trips,
sinks, streaming) write below a fresh folder under the session's checkpoint
root and return the frame read back from there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import operators as op
from .plans import catalog, history, jobs, reports
from .schemas import LIVE_KEY, LIVE_SILVER, ONTIME_KEY, WEATHER_SILVER
from .session import scratch_path
from .sources import bronze, surrogate
from .sources.sinks import append_new, materialize, merge_days, read_parted
from .sources.tables import Tables
from .streaming import ingest_stream


def _tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


# --- silver building blocks ---------------------------------------------------

def ontime_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.ontime_silver(surrogate.ontime_raw(_tables(spark, sf_dir)))


def live_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    return op.live_silver(bronze.wrap_envelope(surrogate.live_records(t), "flights"))


def weather_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    env = bronze.wrap_envelope(surrogate.weather_records(t), "weather")
    return op.weather_silver(env, op.station_registry(t.nation))


# --- gold ---------------------------------------------------------------------

def q_route_delay_summary(spark, sf_dir):
    return op.route_delay_summary(ontime_silver(spark, sf_dir))


def q_airport_hourly_delay(spark, sf_dir):
    return op.airport_hourly_delay(ontime_silver(spark, sf_dir))


def q_carrier_performance(spark, sf_dir):
    return op.carrier_performance(ontime_silver(spark, sf_dir))


def q_delay_cause_breakdown(spark, sf_dir):
    return op.delay_cause_breakdown(ontime_silver(spark, sf_dir))


def q_live_route_summary(spark, sf_dir):
    return op.live_route_summary(live_silver(spark, sf_dir))


def q_flight_weather_latest(spark, sf_dir):
    return op.flight_weather(ontime_silver(spark, sf_dir), weather_silver(spark, sf_dir))


def q_flight_weather_all(spark, sf_dir):
    return op.fanout_summary(ontime_silver(spark, sf_dir), weather_silver(spark, sf_dir))


# --- silver ---------------------------------------------------------------------

def q_flights_clean(spark, sf_dir):
    return op.clean_ontime(surrogate.ontime_raw(_tables(spark, sf_dir)))


def q_flights_dedupe_keys(spark, sf_dir):
    return op.distinct_keys(q_flights_clean(spark, sf_dir), ONTIME_KEY)


def q_flights_dedupe_first(spark, sf_dir):
    return ontime_silver(spark, sf_dir)


def q_csv_roundtrip(spark, sf_dir):
    """On-time rows written as headed CSV, read back by header (SRC-3, SNK-3)."""
    path = scratch_path(spark, "ontime-csv")
    bronze.write_ontime_csv(surrogate.ontime_raw(_tables(spark, sf_dir)), path)
    return op.ontime_silver(bronze.read_ontime_csv(spark, f"{path}/*.csv"))


def _drifting_months(spark, sf_dir):
    """The on-time rows as three folders of CSV files by month: one as expected,
    one with a renamed column, one reordered and without the tail number."""
    raw = surrogate.ontime_raw(_tables(spark, sf_dir))
    part = F.pmod(F.month(F.try_to_timestamp("FlightDate", F.lit("yyyy-MM-dd"))), F.lit(3))
    swapped = ["Dest", "Origin"] + [c for c in raw.columns if c not in ("Dest", "Origin", "Tail_Number")]
    months = [raw, raw.withColumnRenamed("SecurityDelay", "SecurityDelayMinutes"), raw.select(*swapped)]
    path = scratch_path(spark, "ontime-months")
    for i, month in enumerate(months):
        bronze.write_ontime_csv(month.where(part == i), f"{path}/m{i}")
    return f"{path}/*/*.csv"


def q_schema_drift(spark, sf_dir):
    """Header drift (SRC-8) of every monthly folder, with its data rows."""
    report = bronze.drift_report(spark, _drifting_months(spark, sf_dir))
    return (report.withColumn("month_folder", F.regexp_extract("file", r"/(m\d)/[^/]*$", 1))
            .groupBy("month_folder", "column_name", "status", "position")
            .agg(F.sum("n_rows").alias("n_rows")))


def q_csv_mixed_headers(spark, sf_dir):
    """Months with different headers read together, each by its own (SRC-3)."""
    return op.ontime_silver(bronze.read_ontime_csv(spark, _drifting_months(spark, sf_dir)))


def q_carrier_cancelled_by_tail(spark, sf_dir):
    """Carriers with the tail number in the key: no cancelled flight collapses."""
    silver = op.ontime_silver(surrogate.ontime_raw(_tables(spark, sf_dir)), extra_keys=["TAIL_NUM"])
    return op.carrier_stats(silver).select("OP_CARRIER", "total_flights", "total_cancelled")


def _landed(spark, sf_dir, feed):
    t = _tables(spark, sf_dir)
    records = surrogate.live_records(t, by_day=True) if feed == "flights" else surrogate.weather_records(t, by_day=True)
    return bronze.land_snapshot(records, scratch_path(spark, f"bronze-{feed}"), feed)


def q_live_flights_flat(spark, sf_dir):
    """Flight records landed as daily JSON envelopes, read back, flattened."""
    return op.flatten_live(_landed(spark, sf_dir, "flights"))


def q_live_flights_polled(spark, sf_dir):
    """Active flights (FLT-5), over every landed day."""
    t = _tables(spark, sf_dir)
    flat = op.flatten_live(bronze.wrap_envelope(surrogate.live_records(t), "flights"))
    return op.polled_flights(flat, [surrogate.ACTIVE_STATUS])


def q_live_flights_dedupe(spark, sf_dir):
    return live_silver(spark, sf_dir)


def q_weather_flat(spark, sf_dir):
    """Weather records landed as daily JSON envelopes, read back, flattened,
    limited to the polled stations."""
    env = _landed(spark, sf_dir, "weather")
    return op.flatten_weather(env, op.station_registry(_tables(spark, sf_dir).nation))


def q_append_idempotent(spark, sf_dir):
    """The live silver batch appended twice: the second run adds nothing."""
    path = scratch_path(spark, "silver-live")
    batch = live_silver(spark, sf_dir)
    append_new(batch, path, LIVE_KEY, partition_by=["flight_date"])
    append_new(batch, path, LIVE_KEY, partition_by=["flight_date"])
    return spark.read.schema(LIVE_SILVER).parquet(path).select(*LIVE_SILVER.fieldNames())


def _replays(spark, sf_dir):
    """Three overlapping batches of flight records, null and blank days included."""
    records = surrogate.live_records(_tables(spark, sf_dir))
    share = F.pmod(F.xxhash64("record"), F.lit(4))
    return [op.live_silver(bronze.wrap_envelope(records.where(share != i), "flights")) for i in range(3)]


def q_merge_replay(spark, sf_dir):
    """Overlapping batches merged one after the other equal one dedupe over all."""
    path = scratch_path(spark, "merge-replay")
    for batch in _replays(spark, sf_dir):
        merge_days(batch, path, LIVE_KEY, ["flight_date"], op.NEWEST_FIRST)
    return read_parted(spark, path, LIVE_SILVER).select(*LIVE_SILVER.fieldNames())


def q_append_replay(spark, sf_dir):
    """The same batches appended, the last twice: every key once."""
    path = scratch_path(spark, "append-replay")
    batches = _replays(spark, sf_dir)
    for batch in [*batches, batches[-1]]:
        append_new(batch, path, LIVE_KEY, partition_by=["flight_date"])
    return op.distinct_keys(read_parted(spark, path, LIVE_SILVER), LIVE_KEY)


def q_weather_polled(spark, sf_dir):
    """Observations of the stations on an allow-list held as a table (FLT-6)."""
    t = _tables(spark, sf_dir)
    stations = op.station_registry(t.nation.where("n_regionkey <= 1"))
    return op.flatten_weather(bronze.wrap_envelope(surrogate.weather_records(t), "weather"), stations)


def q_landing_stamp(spark, sf_dir):
    """Records stamped and landed by one run: one stamp, in its UTC day's folder (SC-19)."""
    payload = surrogate.weather_records(_tables(spark, sf_dir)).select("record")
    landed = bronze.land_snapshot(bronze.stamp_ingestion(payload), scratch_path(spark, "stamped"), "weather")
    day = bronze.snapshot_day(F.col("_ingested_at"))
    return landed.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("_ingested_at").alias("n_stamps"),
                      F.bool_and(day == F.col("_snapshot_date")).alias("day_is_folder"))


def q_bronze_rejects(spark, sf_dir):
    """A feed of which some lines are cut off: per snapshot day, the observations
    that are read and the lines that are rejected."""
    t = _tables(spark, sf_dir)
    records = surrogate.weather_records(t)
    root = scratch_path(spark, "bronze-cut")
    env = bronze.wrap_envelope(records, "weather").withColumn("ingest_date", bronze.snapshot_day(F.col("_ingested_at")))
    line = F.to_json(F.struct("records", "_ingested_at"))
    broken = F.col("records")[0]["obsTime"].rlike(r"[05]$")
    cut = F.when(broken, F.substring(line, 1, 40)).otherwise(line)
    env.select(cut.alias("value"), "ingest_date").write.partitionBy("ingest_date").text(root)
    glob = "*/*.txt"
    bad = materialize(bronze.rejects(spark, root, "weather", glob), "rejects").groupBy("_snapshot_date").agg(F.count(F.lit(1)).alias("n_rejects"))
    read = bronze.read_envelopes(spark, root, "weather", glob, rejects=True)
    good = read.select("_snapshot_date", F.explode("records")).groupBy("_snapshot_date").agg(F.count(F.lit(1)).alias("n_read"))
    return (good.join(bad, "_snapshot_date", "full").select(
        F.col("_snapshot_date").alias("day"), F.coalesce("n_read", F.lit(0)).alias("n_read"),
        F.coalesce("n_rejects", F.lit(0)).alias("n_rejects")))


# --- reports ----------------------------------------------------------------------

def q_report_hour_risk(spark, sf_dir):
    return reports.hour_risk(ontime_silver(spark, sf_dir))


def q_report_worst_routes(spark, sf_dir):
    return reports.worst_routes(q_route_delay_summary(spark, sf_dir))


def q_report_weather_category(spark, sf_dir):
    return reports.weather_category(q_flight_weather_latest(spark, sf_dir))


def q_report_carrier_ranking(spark, sf_dir):
    return reports.carrier_ranking(op.carrier_stats(ontime_silver(spark, sf_dir)))


def q_report_cause_share(spark, sf_dir):
    return reports.cause_share(ontime_silver(spark, sf_dir))


def q_report_live_monitor(spark, sf_dir):
    return reports.live_monitor(q_live_route_summary(spark, sf_dir))


# --- jobs and streaming --------------------------------------------------------------

def _land_lake(spark, sf_dir, lake, feeds=("ontime", "flights", "weather")):
    """Land the feeds (independent jobs, submitted concurrently)."""
    t = _tables(spark, sf_dir)

    def ontime():
        bronze.write_ontime_csv(surrogate.ontime_raw(t), lake.bronze("ontime"), bronze.COMPRESSION)
        return 0

    def feed(name, records):
        def land():
            bronze.land_snapshot(records, lake.bronze(name), name)
            return 0
        return land

    steps = [("ontime", ontime),
             ("flights", feed("flights", surrogate.live_records(t, by_day=True))),
             ("weather", feed("weather", surrogate.weather_records(t, by_day=True)))]
    audit = jobs.run_steps("bronze", [x for x in steps if x[0] in feeds], concurrency=3)
    if any(a[2] != "ok" for a in audit):
        raise jobs.JobFailed(audit)


def q_gold_row_audit(spark, sf_dir):
    """Both nightly jobs over a freshly landed lake; written rows (observed at
    write time) next to the rows read back through the registered views."""
    lake = jobs.Lake(scratch_path(spark, "lake"))
    _land_lake(spark, sf_dir, lake)
    audit = jobs.run_nightly(spark, lake, stations=op.station_registry(_tables(spark, sf_dir).nation))
    prefix = "lake_" + lake.root.rsplit("-", 1)[-1] + "_"
    views = catalog.register_lake(spark, lake, prefix)
    counts = catalog.row_counts(spark, views).withColumn(
        "table_name", F.expr(f"substr(table_name, {len(prefix) + 1})"))
    return audit.drop("error").join(counts, "table_name", "left")


_FEED_OF = {"bts_flights": "ontime", "aviationstack_flights": "flights", "metar": "weather"}


def _nightly(spark, sf_dir, silver, gold=()):
    """A lake of its own after a nightly run that builds these tables from their feeds."""
    lake = jobs.Lake(scratch_path(spark, "nightly"))
    _land_lake(spark, sf_dir, lake, [_FEED_OF[name] for name in silver])
    jobs.run_nightly(spark, lake, op.station_registry(_tables(spark, sf_dir).nation), only=[*silver, *gold])
    return lake


def _written_gold(name):
    def query(spark, sf_dir):
        return jobs.read_gold(spark, _nightly(spark, sf_dir, jobs.GOLD_INPUTS[name], [name]), name)
    query.__doc__ = f"The contents of the gold table {name} that the nightly job wrote."
    return query


def q_nightly_metar(spark, sf_dir):
    """The weather silver table that the nightly job merged."""
    return jobs.read_silver(spark, _nightly(spark, sf_dir, ["metar"]), "metar")


def q_nightly_route_flights(spark, sf_dir):
    """The flights from the first airport, read from the clustered silver table."""
    lake = _nightly(spark, sf_dir, ["bts_flights"])
    first = jobs.read_silver(spark, lake, "bts_flights").agg(F.min("Origin")).first()[0]
    return jobs.route_flights(spark, lake, first)


def _catalog_report(name, table):
    def query(spark, sf_dir):
        lake = _nightly(spark, sf_dir, jobs.GOLD_INPUTS[table], [table])
        prefix = "report_" + lake.root.rsplit("-", 1)[-1] + "_"
        catalog.register_lake(spark, lake, prefix, [table])
        return catalog.report_sql(spark, name, prefix)
    query.__doc__ = f"The SQL report {name} over the view of {table} (JOB-4)."
    return query


def q_nightly_history(spark, sf_dir):
    """The audits of two nights of the weather feed, first half of the month landed
    and then all of it, with what the last count is compared with (CNT-1)."""
    t = _tables(spark, sf_dir)
    lake = jobs.Lake(scratch_path(spark, "history"))
    records, stations = surrogate.weather_records(t, by_day=True), op.station_registry(t.nation)
    half = records.where(F.substring("_ingested_at", 9, 2) <= "15")
    for landed in (half, records):
        bronze.land_snapshot(landed, lake.bronze("weather"), "weather")
        history.record(lake, jobs.run_nightly(spark, lake, stations, only=["metar"]))
    nights = history.read(spark, lake).where("status = 'ok'")
    night = Window.partitionBy("layer", "table_name").orderBy("run_at")
    usual = history.judged(history.read(spark, lake)).select("layer", "table_name", "n_past", "usual", "unusual")
    return (nights.withColumn("night", F.row_number().over(night))
            .select("layer", "table_name", "night", "rows_written")
            .join(usual, ["layer", "table_name"]))


def q_stream_weather(spark, sf_dir):
    """Weather snapshots through the file stream in two steps."""
    t = _tables(spark, sf_dir)
    root = scratch_path(spark, "stream-weather")
    records = surrogate.weather_records(t, by_day=True)
    stations = op.station_registry(t.nation)
    first = records.where(F.pmod(F.xxhash64("_ingested_at"), F.lit(2)) == 0)
    for batch in (first, records):
        bronze.land_snapshot(batch, f"{root}/bronze", "weather")
        ingest_stream(spark, f"{root}/bronze", f"{root}/silver", "weather", f"{root}/_checkpoint", stations)
    return read_parted(spark, f"{root}/silver", WEATHER_SILVER).select(*WEATHER_SILVER.fieldNames())


def q_stream_incremental(spark, sf_dir):
    """Live snapshots arriving in two steps through the file stream: first
    half of the days, then all days again (re-landed plus new). The silver
    table ends equal to one batch run over everything."""
    t = _tables(spark, sf_dir)
    root = scratch_path(spark, "stream")
    landing, silver, ckpt = f"{root}/bronze", f"{root}/silver", f"{root}/_checkpoint"
    records = surrogate.live_records(t, by_day=True)
    day = F.col("record.flight_date")
    first = records.filter(F.pmod(F.xxhash64(day), F.lit(2)) == 0)
    bronze.land_snapshot(first, landing, "flights")
    ingest_stream(spark, landing, silver, "flights", ckpt)
    bronze.land_snapshot(records, landing, "flights")
    ingest_stream(spark, landing, silver, "flights", ckpt)
    return spark.read.schema(LIVE_SILVER).parquet(silver).select(*LIVE_SILVER.fieldNames())


def q_stream_repolled(spark, sf_dir):
    """Live snapshots polled three times, some days and then all days twice, through
    a stream that remembers the lines it has taken: lines landed again are
    dropped before the merge, and silver equals one batch run over everything."""
    t = _tables(spark, sf_dir)
    root = scratch_path(spark, "stream-repolled")
    records = surrogate.live_records(t, by_day=True)
    first = records.filter(F.pmod(F.xxhash64("record.flight_date"), F.lit(2)) == 0)
    for poll in (first, records, records):
        bronze.land_snapshot(poll, f"{root}/bronze", "flights")
        ingest_stream(spark, f"{root}/bronze", f"{root}/silver", "flights", f"{root}/_checkpoint", seen_for="7 days")
    return read_parted(spark, f"{root}/silver", LIVE_SILVER).select(*LIVE_SILVER.fieldNames())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # silver
    "flights_clean": q_flights_clean,
    "flights_dedupe_keys": q_flights_dedupe_keys,
    "flights_dedupe_first": q_flights_dedupe_first,
    "csv_roundtrip": q_csv_roundtrip,
    "schema_drift": q_schema_drift,
    "live_flights_flat": q_live_flights_flat,
    "live_flights_polled": q_live_flights_polled,
    "live_flights_dedupe": q_live_flights_dedupe,
    "weather_flat": q_weather_flat,
    "append_idempotent": q_append_idempotent,
    "csv_mixed_headers": q_csv_mixed_headers,
    "carrier_cancelled_by_tail": q_carrier_cancelled_by_tail,
    "merge_replay": q_merge_replay,
    "append_replay": q_append_replay,
    "weather_polled": q_weather_polled,
    "landing_stamp": q_landing_stamp,
    "bronze_rejects": q_bronze_rejects,
    # gold
    "airport_hourly_delay": q_airport_hourly_delay,
    "route_delay_summary": q_route_delay_summary,
    "carrier_performance": q_carrier_performance,
    "delay_cause_breakdown": q_delay_cause_breakdown,
    "flight_weather_latest": q_flight_weather_latest,
    "flight_weather_all": q_flight_weather_all,
    "live_route_summary": q_live_route_summary,
    # reports
    "report_hour_risk": q_report_hour_risk,
    "report_worst_routes": q_report_worst_routes,
    "report_weather_category": q_report_weather_category,
    "report_carrier_ranking": q_report_carrier_ranking,
    "report_cause_share": q_report_cause_share,
    "report_live_monitor": q_report_live_monitor,
    # jobs, sinks, streaming
    "gold_row_audit": q_gold_row_audit,
    "stream_incremental": q_stream_incremental,
    "stream_weather": q_stream_weather,
    "stream_repolled": q_stream_repolled,
    "nightly_metar": q_nightly_metar,
    "nightly_route_flights": q_nightly_route_flights,
    "nightly_history": q_nightly_history,
    "catalog_worst_routes": _catalog_report("worst_routes", "route_delay_summary"),
    "catalog_best_carrier": _catalog_report("best_carrier", "carrier_performance"),
    "catalog_weather_category": _catalog_report("weather_category", "flight_weather_joined"),
    **{f"nightly_{name}": _written_gold(name) for name in jobs.GOLD_TABLES},
}

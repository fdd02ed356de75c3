"""Sinks, nightly jobs, catalog views and incremental streaming."""

from collections import Counter
import pytest
from pyspark.sql import functions as F

from flightlake import operators as op
from flightlake.plans import catalog, jobs
from flightlake.schemas import LIVE_KEY, LIVE_SILVER
from flightlake.session import scratch_path
from flightlake.sources import bronze, surrogate
from flightlake.sources.sinks import append_new, replace_table
from flightlake.sources.tables import Tables
from flightlake.sources.versions import read_table
from flightlake.streaming import ingest_stream


def _live(spark, rows):
    return spark.createDataFrame(
        [tuple(r.get(c) for c in LIVE_SILVER.fieldNames()) for r in rows], LIVE_SILVER)


def test_append_new_is_idempotent_with_null_keys(spark):  # T4, T4b
    path = scratch_path(spark, "append")
    rows = [dict(flight_date="2025-02-01", flight_iata=None, origin="ORD", dest="JFK"),
            dict(flight_date="2025-02-01", flight_iata="AA1", origin="ORD", dest="JFK")]
    df = _live(spark, rows)
    assert append_new(df, path, LIVE_KEY, partition_by=["flight_date"]) == 2
    assert append_new(df, path, LIVE_KEY, partition_by=["flight_date"]) == 0
    more = _live(spark, rows + [dict(flight_date="2025-02-02", flight_iata="AA1", origin="ORD",
                                     dest="JFK")])
    assert append_new(more, path, LIVE_KEY, partition_by=["flight_date"]) == 1
    assert spark.read.schema(LIVE_SILVER).parquet(path).count() == 3


def test_replace_table_counts_with_one_execution(spark):  # CNT-1
    path = scratch_path(spark, "replace")
    assert replace_table(spark.range(7), path) == 7
    assert replace_table(spark.range(3), path) == 3
    assert read_table(spark, path).count() == 3


def test_nightly_jobs_audit_and_rerun(spark, sf_small):  # JOB-1..4
    lake = jobs.Lake(scratch_path(spark, "lake"))
    t = Tables(spark, sf_small)
    bronze.write_ontime_csv(surrogate.ontime_raw(t), lake.bronze("ontime"))
    bronze.land_snapshot(surrogate.live_records(t), lake.bronze("flights"), "flights")
    bronze.land_snapshot(surrogate.weather_records(t), lake.bronze("weather"), "weather")
    stations = op.station_registry(t.nation)
    first = {r.table_name: r.rows_written for r in jobs.run_nightly(spark, lake, stations).collect()}
    second = {r.table_name: r.rows_written for r in jobs.run_nightly(spark, lake, stations).collect()}
    assert len(first) == 12 and all(v > 0 for k, v in first.items() if not k.endswith("_rejects"))
    # merges add no keys on a rerun; overwrites rewrite the same rows
    assert second["aviationstack_flights"] == 0 and second["metar"] == 0
    assert {k: v for k, v in second.items() if k not in ("aviationstack_flights", "metar")} == \
        {k: v for k, v in first.items() if k not in ("aviationstack_flights", "metar")}
    views = catalog.register_lake(spark, lake, prefix="t_")
    counts = {r.table_name: r.rows_read for r in catalog.row_counts(spark, views).collect()}
    assert counts["t_aviationstack_flights"] == first["aviationstack_flights"]
    best = catalog.report_sql(spark, "best_carrier", prefix="t_").collect()
    assert len(best) == 1


def test_nightly_silver_equals_dedupe_of_all_landed(spark, sf_small):  # JOB-1, T4
    """A later snapshot re-reports flights with rows that sort first: the
    nightly merge replaces them, so silver equals one dedupe over all bronze."""
    lake = jobs.Lake(scratch_path(spark, "lake-again"))
    records = surrogate.live_records(Tables(spark, sf_small))
    again = (records.filter(F.col("record.flight_date") < "2024-01-05")
             .withColumn("record", F.col("record").withField("flight_status", F.lit("a")))
             .withColumn("_ingested_at", F.lit("2099-01-01T22:00:00")))
    bronze.land_snapshot(records, lake.bronze("flights"), "flights")
    first = dict((a[1], a[3]) for a in jobs.build_silver(spark, lake))
    bronze.land_snapshot(again, lake.bronze("flights"), "flights")
    second = dict((a[1], a[3]) for a in jobs.build_silver(spark, lake))
    assert first["aviationstack_flights"] > 0 and second["aviationstack_flights"] == 0
    got = jobs.read_silver(spark, lake, "aviationstack_flights")
    want = op.live_silver(bronze.wrap_envelope(records.unionByName(again), "flights"))
    assert got.filter(F.col("flight_status") == "a").count() > 0
    assert Counter(got.collect()) == Counter(want.collect())


def test_failed_table_is_isolated_then_raised(spark, sf_small):  # JOB-3, T10
    lake = jobs.Lake(scratch_path(spark, "lake-broken"))  # nothing landed
    with pytest.raises(jobs.JobFailed) as e:
        jobs.run_nightly(spark, lake)
    audit = e.value.audit
    assert len(audit) == 10 and all(a[2] == "failed" for a in audit)
    df = jobs.run_nightly(spark, lake, raise_on_failure=False)
    assert df.filter(F.col("status") == "failed").count() == 10


def test_stream_two_steps_equals_batch(spark, sf_small):  # STR-1
    t = Tables(spark, sf_small)
    root = scratch_path(spark, "stream-test")
    records = surrogate.live_records(t)
    early = records.filter(F.col("record.flight_date") < "2024-01-15")
    bronze.land_snapshot(early, f"{root}/bronze", "flights")
    r1 = ingest_stream(spark, f"{root}/bronze", f"{root}/silver", "flights", f"{root}/ckpt")
    r_again = ingest_stream(spark, f"{root}/bronze", f"{root}/silver", "flights", f"{root}/ckpt")
    assert r1["rows"] > 0 and r_again["rows"] == 0  # nothing new: no rows appended
    bronze.land_snapshot(records, f"{root}/bronze", "flights")
    ingest_stream(spark, f"{root}/bronze", f"{root}/silver", "flights", f"{root}/ckpt")
    got = spark.read.schema(LIVE_SILVER).parquet(f"{root}/silver").select(*LIVE_SILVER.fieldNames())
    want = op.live_silver(bronze.wrap_envelope(records, "flights"))
    assert Counter(got.collect()) == Counter(want.collect())


def test_stream_split_days_equals_batch(spark, sf_small):  # STR-1, T4
    """Small micro-batches may split one day's files; the merged table still
    equals one batch run over all files."""
    t = Tables(spark, sf_small)
    root = scratch_path(spark, "stream-split")
    records = surrogate.live_records(t)
    bronze.land_snapshot(records, f"{root}/bronze", "flights")
    r = ingest_stream(spark, f"{root}/bronze", f"{root}/silver", "flights", f"{root}/ckpt",
                      max_files_per_trigger=3)
    assert r["batches"] > 1
    got = spark.read.schema(LIVE_SILVER).parquet(f"{root}/silver")
    want = op.live_silver(bronze.wrap_envelope(records, "flights"))
    assert Counter(got.select(*LIVE_SILVER.fieldNames()).collect()) == Counter(want.collect())


def test_stream_later_snapshot_with_smaller_row_replaces(spark, sf_small):  # STR-1
    """A flight seen again in a later snapshot: the table keeps the row the
    dedupe rule picks over both snapshots, not the first arrival; append mode
    keeps the first arrival."""
    t = Tables(spark, sf_small)
    records = surrogate.live_records(t)
    again = (records.filter(F.col("record.flight_date") < "2024-01-05")
             .withColumn("record", F.col("record").withField("flight_status", F.lit("a")))
             .withColumn("_ingested_at", F.lit("2099-01-01T22:00:00")))
    want = op.live_silver(bronze.wrap_envelope(records.unionByName(again), "flights"))
    for mode in ("merge", "append"):
        root = scratch_path(spark, f"stream-again-{mode}")
        bronze.land_snapshot(records, f"{root}/bronze", "flights")
        ingest_stream(spark, f"{root}/bronze", f"{root}/silver", "flights", f"{root}/ckpt",
                      mode=mode)
        bronze.land_snapshot(again, f"{root}/bronze", "flights")
        r = ingest_stream(spark, f"{root}/bronze", f"{root}/silver", "flights",
                          f"{root}/ckpt", mode=mode)
        assert r["batches"] == 1 and r["rows"] == 0  # no new keys either way
        got = (spark.read.schema(LIVE_SILVER).parquet(f"{root}/silver")
               .select(*LIVE_SILVER.fieldNames()))
        replaced = got.filter(F.col("flight_status") == "a").count()
        if mode == "merge":
            assert replaced > 0
            assert Counter(got.collect()) == Counter(want.collect())
        else:
            assert replaced == 0


def test_stream_drops_lines_seen_before(spark, sf_small):  # STR-1
    """A day landed again reaches no sink; a new line of an old day does; a repeat after
    the expiry changes nothing; a checkpoint keeps its choice."""
    t = Tables(spark, sf_small)
    root = scratch_path(spark, "stream-seen")
    records = surrogate.live_records(t)
    old_day = records.where("record.flight_date < '2024-01-10'")
    late = (old_day.withColumn("record", F.col("record").withField("flight_status", F.lit("late")))
            .withColumn("_ingested_at", F.lit("2024-01-01T00:00:00.5")))
    total = Counter()

    def poll(rows, seen_for="7 days"):
        bronze.land_snapshot(rows, f"{root}/bronze", "flights")
        done = ingest_stream(spark, f"{root}/bronze", f"{root}/silver", "flights", f"{root}/ckpt", seen_for=seen_for)
        total.update(done)
        return done

    first = poll(records)
    assert first["batches"] == 1 and first["rows"] > 0
    assert poll(records) == {"batches": 0, "rows": 0, "rejects": 0}
    assert poll(late)["batches"] == 1  # however old, never too late
    assert poll(records, "1 microsecond")["batches"] <= 1
    got = spark.read.schema(LIVE_SILVER).parquet(f"{root}/silver").select(*LIVE_SILVER.fieldNames())
    want = op.live_silver(bronze.wrap_envelope(records.unionByName(late), "flights"))
    assert Counter(got.collect()) == Counter(want.collect())
    with pytest.raises(ValueError, match="made with seen_for"):
        poll(records, None)


def test_seen_lines_differ_in_any_field(spark):  # STR-1
    """Null and absent, blank and null, another ingestion time: other lines; equal
    lines of one batch once; rejects are counted once."""
    root = scratch_path(spark, "stream-lines")
    lines = ['{"flights":{"data":[{"flight_date":"2025-01-01","flight":{"iata":"A1"}}]},"_ingested_at":"2025-01-01T01:00:00"}',
             '{"flights":{"data":[{"flight_date":"2025-01-01","flight":{"iata":""}}]},"_ingested_at":"2025-01-01T01:00:00"}',
             '{"flights":{"data":[{"flight_date":"2025-01-01","flight":{"iata":"A1"}}]},"_ingested_at":"2025-01-01T02:00:00"}',
             '{"flights":{"data":null},"_ingested_at":"2025-01-01T01:00:00"}', '{"flights":{"da']
    frame = spark.createDataFrame([(x,) for x in lines + lines], "value string")
    args = (f"{root}/bronze", f"{root}/silver", "flights", f"{root}/ckpt")
    for i in range(2):
        frame.write.mode("append").text(f"{root}/bronze/ingest_date=2025-01-01")
        done = ingest_stream(spark, *args, seen_for="1 day", rejects_path=f"{root}/rejects")
        assert (done["batches"], done["rejects"]) == ((1, 1) if i == 0 else (0, 0))
    assert spark.read.parquet(f"{root}/rejects").count() == 1


def test_weather_stream_partitioned_by_obs_day(spark, sf_small):  # STR-1, SNK-2
    from flightlake.schemas import WEATHER_SILVER
    t = Tables(spark, sf_small)
    root = scratch_path(spark, "stream-wx")
    stations = op.station_registry(t.nation)
    bronze.land_snapshot(surrogate.weather_records(t), f"{root}/bronze", "weather")
    r1 = ingest_stream(spark, f"{root}/bronze", f"{root}/silver", "weather", f"{root}/ckpt",
                       stations=stations)
    bronze.land_snapshot(surrogate.weather_records(t), f"{root}/bronze", "weather")  # re-landed
    r2 = ingest_stream(spark, f"{root}/bronze", f"{root}/silver", "weather", f"{root}/ckpt",
                       stations=stations)
    assert r1["rows"] > 0 and r2["rows"] == 0
    got = spark.read.schema(WEATHER_SILVER).parquet(f"{root}/silver")
    days = {r[0] for r in spark.read.parquet(f"{root}/silver").select("obs_date").distinct().collect()}
    assert len(days) > 1 and None not in days
    want = op.weather_silver(bronze.wrap_envelope(surrogate.weather_records(t), "weather"), stations)
    assert Counter(got.select(*WEATHER_SILVER.fieldNames()).collect()) == Counter(want.collect())


def test_append_prunes_to_the_days_of_the_batch(spark):  # SNK-1
    path = scratch_path(spark, "append-many")
    days = ["2025-02-01", "2025-02-02", "", None]
    rows = [dict(flight_date=d, flight_iata="AA1", origin="ORD", dest="JFK") for d in days]
    assert append_new(_live(spark, rows), path, LIVE_KEY, partition_by=["flight_date"]) == 4
    assert append_new(_live(spark, rows), path, LIVE_KEY, partition_by=["flight_date"]) == 0
    more = rows + [dict(flight_date="2025-02-05", flight_iata="AA1", origin="ORD", dest="JFK")]
    assert append_new(_live(spark, more), path, LIVE_KEY, partition_by=["flight_date"]) == 1
    assert {r[0] for r in spark.read.schema(LIVE_SILVER).parquet(path).select("flight_date").collect()} == {*days, "2025-02-05"}


def test_merge_keeps_rows_of_null_and_blank_days(spark):  # SNK-1
    from flightlake.sources.sinks import merge_days, read_parted
    path = scratch_path(spark, "merge-blank")
    def row(day, flight):
        return dict(flight_date=day, flight_iata=flight, origin="ORD", dest="JFK")
    merge_days(_live(spark, [row(None, "F1"), row("2025-02-01", "F2")]), path, LIVE_KEY, ["flight_date"], op.NEWEST_FIRST)
    assert merge_days(_live(spark, [row("", "F3")]), path, LIVE_KEY, ["flight_date"], op.NEWEST_FIRST) == 1
    assert {r.flight_iata for r in read_parted(spark, path, LIVE_SILVER).collect()} == {"F1", "F2", "F3"}


def _files(root):
    import os

    from flightlake.session import local_path
    return {f"{d}/{f}" for d, _, names in os.walk(local_path(root)) for f in names if f.endswith(".parquet")}


def test_merge_without_change_rewrites_no_file(spark, sf_small):  # SNK-1, JOB-1
    import glob

    from flightlake.session import checkpoint_root, local_path
    lake = jobs.Lake(scratch_path(spark, "lake-still"))
    t = Tables(spark, sf_small)
    bronze.land_snapshot(surrogate.live_records(t), lake.bronze("flights"), "flights")
    jobs.build_silver(spark, lake)
    before, left = _files(lake.silver("aviationstack_flights")), set(glob.glob(local_path(checkpoint_root(spark)) + "/*"))
    jobs.build_silver(spark, lake)
    assert before and _files(lake.silver("aviationstack_flights")) == before
    assert set(glob.glob(local_path(checkpoint_root(spark)) + "/*")) == left


def test_failed_overwrite_leaves_the_old_table(spark):  # SNK-3, T10
    path = scratch_path(spark, "staged")
    replace_table(spark.range(5), path)
    with pytest.raises(Exception):
        replace_table(spark.range(9).withColumn("x", F.raise_error(F.lit("boom"))), path)
    assert read_table(spark, path).count() == 5


def test_written_tables_are_snappy(spark):  # SNK-10
    import pyarrow.parquet as pq
    path = scratch_path(spark, "codec")
    replace_table(spark.range(5), path)
    meta = pq.ParquetFile(next(iter(f for f in _files(path) if pq.ParquetFile(f).metadata.num_rows))).metadata
    assert meta.row_group(0).column(0).compression == "SNAPPY"


def test_carriers_come_in_ascending_delay_rate(spark, sf_small):  # SRT-1
    from flightlake.queries import QUERIES
    rates = [r.delay_rate for r in QUERIES["carrier_performance"](spark, sf_small).collect()]
    assert rates == sorted(rates) and len(rates) > 1


def test_nightly_counts_and_stores_rejects(spark):  # SRC-1, JOB-3
    import json
    lake = jobs.Lake(scratch_path(spark, "lake-cut"))
    good = json.dumps({"records": [{"icaoId": "KORD", "obsTime": "2025-02-01 10:00:00"}], "_ingested_at": "2025-02-01T22:00:00"})
    lines = [(good,), (good[:50],), (good[:30],)]
    spark.createDataFrame(lines, "value string").coalesce(1).write.text(f"{lake.bronze('weather')}/ingest_date=2025-02-01")
    for n in (2, 0):  # the second run sees no new file
        audit = {a[1]: a for a in jobs.build_silver(spark, lake)}
        assert audit["weather_rejects"][3] == n and audit["metar"][2:4] == ("ok", n // 2)
    assert {r._corrupt_record for r in spark.read.parquet(lake.rejects("weather")).collect()} == {good[:50], good[:30]}
    assert jobs.read_silver(spark, lake, "metar").count() == 1

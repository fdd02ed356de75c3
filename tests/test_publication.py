"""Atomic publication, change detection by digests, monthly partials, one-job headers."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from flightlake import operators as op
from flightlake.plans import catalog, jobs, partials
from flightlake.schemas import LIVE_KEY, LIVE_SILVER, ONTIME_COLUMNS, ONTIME_SILVER
from flightlake.session import local_path, scratch_path
from flightlake.sources import bronze, sinks, surrogate, versions
from flightlake.sources.tables import Tables


# --- publication

def test_a_run_that_dies_at_any_step_leaves_a_whole_table(spark, monkeypatch):  # SNK-3..9
    path = scratch_path(spark, "steps")
    sinks.replace_table(spark.range(5), path)

    def boom(*a, **k):
        raise OSError("lost the driver")

    def rows():
        return versions.read_table(spark, path).count()

    with pytest.raises(Exception):  # while the files are written
        sinks.replace_table(spark.range(9).withColumn("x", F.raise_error(F.lit("boom"))), path)
    assert rows() == 5
    with monkeypatch.context() as m:  # after the files, before the commit
        m.setattr(versions, "commit", boom)
        with pytest.raises(OSError):
            sinks.replace_table(spark.range(6), path)
    assert rows() == 5
    with monkeypatch.context() as m:  # after the commit, before the old files go
        m.setattr(versions, "vacuum", boom)
        with pytest.raises(OSError):
            sinks.replace_table(spark.range(7), path)
    assert rows() == 7
    before = versions.read_table(spark, path)  # a reader that resolved this version
    assert sinks.replace_table(spark.range(8), path) == 8
    assert rows() == 8 and before.count() == 7
    left = [n for n in os.listdir(local_path(path)) if n[:1].isdigit()]
    assert sorted(left) == versions.commits(spark, path) and len(left) == versions.KEEP


def test_tables_merged_in_place_are_read_as_they_are(spark):
    path = scratch_path(spark, "plain")
    spark.range(4).write.parquet(path)
    assert versions.current(spark, path + "/") == path and not versions.published(spark, path)
    assert versions.read_table(spark, path).count() == 4
    assert versions.commits(spark, scratch_path(spark, "nowhere")) == []


# --- digests and merges

def live(spark, rows):
    return spark.createDataFrame([tuple(r.get(f, None) for f in LIVE_SILVER.fieldNames()) for r in rows], LIVE_SILVER)


def test_digests_tell_rows_apart(spark):
    schema = "p string, a string, b string, n double"
    def part(rows):
        return spark.createDataFrame([("x", *r) for r in rows], schema)
    base = [("1", None, 1.0), (None, "1", 1.0), ("1", "1", None)]
    same = part(list(reversed(base)))
    assert sinks.changed_parts(part(base), same, "p", same.columns).count() == 0
    others = [base[:2], base + base[:1], [(None, "1", 1.0), (None, "1", 1.0), ("1", "1", None)], [("1", "", 1.0), *base[1:]], [("1", None, 2.0), *base[1:]], []]
    for rows in others:
        assert [r.p for r in sinks.changed_parts(part(base), part(rows), "p", same.columns).collect()] == ["x"]
        assert [r.p for r in sinks.changed_parts(part(rows), part(base), "p", same.columns).collect()] == ["x"]


def test_first_merge_holds_each_key_once(spark):  # SNK-1
    path = scratch_path(spark, "first-merge")
    key = dict(flight_date="2025-02-01", flight_iata="AA1", origin="ORD", dest="JFK")
    batch = live(spark, [dict(key, flight_status="a", _ingested_at="1"), dict(key, flight_status="b", _ingested_at="2")])
    assert sinks.merge_days(batch, path, LIVE_KEY, ["flight_date"], op.NEWEST_FIRST) == 1
    assert [r.flight_status for r in sinks.read_parted(spark, path, LIVE_SILVER).collect()] == ["b"]
    assert sinks.merge_days(batch, path, LIVE_KEY, ["flight_date"], op.NEWEST_FIRST) == 0


def test_only_changed_days_are_written_again(spark):
    path = scratch_path(spark, "days")
    rows = [dict(flight_date=f"2025-02-0{d}", flight_iata=f"AA{i}", origin="ORD", dest="JFK", _ingested_at="1") for d in (1, 2, 3) for i in range(5)]
    sinks.merge_days(live(spark, rows), path, LIVE_KEY, ["flight_date"], op.NEWEST_FIRST)

    def files():
        root = local_path(path)
        return {d: sorted(f for f in os.listdir(f"{root}/{d}") if f.endswith(".parquet")) for d in os.listdir(root) if d.startswith(sinks.PART)}
    before = files()
    again = [dict(r, flight_status="late", _ingested_at="2") if r["flight_date"].endswith("2") else r for r in rows]
    assert sinks.merge_days(live(spark, again), path, LIVE_KEY, ["flight_date"], op.NEWEST_FIRST) == 0
    after = files()
    assert {d for d in before if before[d] != after[d]} == {f"{sinks.PART}=2025-02-02"}


# --- incremental gold

def months(spark, rows):
    fields = ONTIME_SILVER.fieldNames()
    df = spark.createDataFrame([tuple(r.get(f) for f in fields) for r in rows], ONTIME_SILVER)
    return sinks.with_part(df.withColumn("_m", F.substring("FL_DATE", 1, 7)), "_m").drop("_m")


def test_second_night_reads_changed_months_only(spark, sf_small):  # JOB-2
    silver = op.ontime_silver(surrogate.ontime_raw(Tables(spark, sf_small)))
    some = sorted(r[0] for r in silver.select(F.substring("FL_DATE", 1, 7)).where("FL_DATE IS NOT NULL").distinct().collect())[:12]
    silver = silver.where(F.substring("FL_DATE", 1, 7).isin(some) | F.col("FL_DATE").isNull())
    parted = sinks.with_part(silver.withColumn("_m", F.substring("FL_DATE", 1, 7)), "_m").drop("_m")
    root = scratch_path(spark, "partials")
    tables = [f"{root}/silver-{i}" for i in range(3)]
    parted.write.partitionBy(sinks.PART).parquet(tables[0])
    day = sorted(r[0] for r in parted.select(sinks.PART).distinct().collect())[3]
    corrected = parted.withColumn("DEP_DELAY", F.when(F.col(sinks.PART) == day, F.col("DEP_DELAY") + 20).otherwise(F.col("DEP_DELAY")))
    corrected.write.partitionBy(sinks.PART).parquet(tables[1])
    corrected.where(F.col(sinks.PART) != day).write.partitionBy(sinks.PART).parquet(tables[2])
    read = [sinks.read_parted(spark, t, ONTIME_SILVER) for t in tables]
    path = f"{root}/partials"
    first = partials.refresh_partials(spark, read[0], path)
    assert first.rows_read == parted.count() and len(first.months) > 10
    again = partials.refresh_partials(spark, read[0], path)
    assert again.months == [] and again.rows_read == 0 and again.routes == first.routes

    def check(silver):
        routes, hours = (partials.read_partials(spark, path, n) for n in ("routes", "hours_by_month"))
        for got, want in ((op.airport_hourly_delay_from(hours), op.airport_hourly_delay(silver)), (op.route_delay_summary_from(routes), op.route_delay_summary(silver)),
                          (op.carrier_performance_from(routes), op.carrier_performance(silver)), (op.delay_cause_breakdown_from(routes), op.delay_cause_breakdown(silver))):
            assert Counter(got.select(*want.columns).collect()) == Counter(want.collect())
    check(read[0])
    second = partials.refresh_partials(spark, read[1], path)
    assert second.months == [day] and second.rows_read == read[1].where(F.col(sinks.PART) == day).count() > 0
    check(read[1])
    third = partials.refresh_partials(spark, read[2], path)  # a month that is gone
    assert third.months == [] and third.rows_read == 0
    check(read[2])


def test_partials_that_fail_leave_the_old_ones(spark, monkeypatch):
    path = scratch_path(spark, "partials-fail")
    rows = [dict(FL_DATE="2025-02-01", OP_CARRIER="AA", Origin="ORD", Dest="JFK", DEP_TIME=f"10{i:02d}", DEP_DELAY=float(i), is_delayed=i > 15) for i in range(30)]
    assert partials.refresh_partials(spark, months(spark, rows), path).routes == 1
    with monkeypatch.context() as m:
        m.setattr(partials.op, "routes_from", lambda df: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            partials.refresh_partials(spark, months(spark, rows + [dict(rows[0], Origin="BOS")]), path)
    assert partials.read_partials(spark, path, "routes").count() == 1
    assert partials.refresh_partials(spark, months(spark, rows + [dict(rows[0], Origin="BOS")]), path).routes == 2


# --- headers

def jobs_of(spark, run):
    group = scratch_path(spark, "group").rsplit("/", 1)[-1]
    spark.sparkContext.setJobGroup(group, group)
    out = run()
    spark.sparkContext.setJobGroup("tests", "tests")
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_headers_of_many_files_are_one_job(spark):  # SRC-8
    names = ONTIME_COLUMNS
    counts = []
    for n in (40, 80):  # both listed by a job of Spark's own, as any folder of more than 32 files
        root = local_path(scratch_path(spark, "many"))
        os.makedirs(root)
        for i in range(n):
            head = names if i % 2 else [*names[1:], names[0], "New, column", "", "origin"]
            quoted = ",".join(f'"{c}"' if "," in c or i % 3 == 0 else c for c in head)
            with open(f"{root}/m{i}.csv", "w") as f:
                f.write(quoted + "\n" + "".join(",".join(f"{c}{k}" for c in range(len(head))) + "\n" for k in range(i + 1)) + "\n")
        open(f"{root}/empty.csv", "w").close()
        report, jobs_run = jobs_of(spark, lambda: bronze.drift_report(spark, f"{root}/*.csv").collect())
        counts.append(jobs_run)
        per = Counter((r.file.rsplit("/", 1)[-1], r.n_rows) for r in report)
        assert {(f, k) for f, k in per} == {(f"m{i}.csv", i + 1) for i in range(n)}
        mixed = [(r.column_name, r.status, r.position) for r in report if r.file.endswith("/m0.csv")]
        # Origin meets origin: both get their place, as Spark's reader does it
        want = [(c if c != "Origin" else f"Origin{names.index('Origin') - 1}") for c in names[1:]] + [names[0], "New, column", f"_c{len(names) + 1}", f"origin{len(names) + 2}"]
        assert [c for c, _, p in sorted(mixed, key=lambda x: x[2] or 99) if p] == want
        assert [c for c, s, _ in mixed if s == "missing"] == ["Origin"]
        read = bronze.read_ontime_csv(spark, f"{root}/*.csv")
        assert read.count() == sum(i + 1 for i in range(n))
        assert read.where("FlightDate LIKE '%x%'").count() == 0 and {"New, column", "FlightDate"} <= set(read.columns)
        assert {r.FlightDate for r in read.where("`New, column` IS NULL").select("FlightDate").distinct().collect()} <= {f"0{k}" for k in range(n)}
    assert counts[0] == counts[1]


def test_headers_of_a_large_file_come_from_its_first_block(spark):
    path = scratch_path(spark, "large-csv")
    spark.range(40_000).select(F.col("id").alias("Origin"), F.lit("x" * 50).alias("Dest")).coalesce(1).write.option("header", True).csv(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        headers = bronze.csv_headers(spark, f"{path}/*.csv")
        assert spark.read.text(f"{path}/*.csv").rdd.getNumPartitions() > 5
        assert [(r.names, r.n_rows) for r in headers.collect()] == [(["Origin", "Dest"], 40_000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


# --- stations, catalog

def test_a_changed_list_of_stations_is_refused_or_replayed(spark):  # FLT-6
    import json

    from flightlake.streaming.incremental import StationsChanged, ingest_stream
    root = scratch_path(spark, "stations")

    def land(day, stations):
        rec = [{"icaoId": s, "obsTime": f"{day} 10:00:00"} for s in stations]
        line = json.dumps({"records": rec, "_ingested_at": f"{day}T22:00:00"})
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.text(f"{root}/bronze/ingest_date={day}")

    def run(names, **kw):
        allowed = None if names is None else spark.createDataFrame([(n,) for n in names], "airport_icao string")
        return ingest_stream(spark, f"{root}/bronze", f"{root}/silver", "weather", f"{root}/_c", allowed, **kw)["rows"]
    land("2025-02-01", ["KORD", "KJFK"])
    assert run(["KORD"]) == 1
    land("2025-02-02", ["KORD", "KJFK"])
    for other in (["KORD", "KJFK"], None):
        with pytest.raises(StationsChanged):
            run(other)
    assert run(["KORD"]) == 1
    assert run(["KJFK", "KORD"], replay=True) == 2  # the new station's history
    assert run(["KORD", "KJFK"]) == 0


def test_tables_outlive_the_session(spark, sf_small):  # JOB-4
    from flightlake.queries import _land_lake
    lake = jobs.Lake(scratch_path(spark, "lake-catalog"))
    _land_lake(spark, sf_small, lake, ["ontime"])
    names = ["bts_flights", "route_delay_summary", "carrier_performance"]
    jobs.run_nightly(spark, lake, only=names)
    database = "lake_" + lake.root.rsplit("-", 1)[-1]
    assert catalog.create_tables(spark, lake, database, names) == [f"{database}.{n}" for n in names]
    other = spark.newSession()
    assert {r.tableName for r in other.sql(f"SHOW TABLES IN {database}").collect()} == set(names)
    assert other.table(f"{database}.bts_flights").count() == jobs.read_silver(spark, lake, "bts_flights").count() > 0
    stats = other.sql(f"DESCRIBE TABLE EXTENDED {database}.carrier_performance").where("col_name = 'Statistics'").first().data_type
    assert f"{jobs.read_gold(spark, lake, 'carrier_performance').count()} rows" in stats
    assert catalog.report_sql(other, "best_carrier", prefix=f"{database}.").count() == 1
    assert catalog.create_tables(spark, lake, database, names[:1]) == [f"{database}.bts_flights"]  # again
    spark.sql(f"DROP DATABASE {database} CASCADE")
    assert jobs.read_gold(spark, lake, "carrier_performance").count() > 0

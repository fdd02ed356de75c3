"""Bronze → silver: explicit schemas, flattening, cleaning, deterministic dedupe."""

from collections import Counter
import json

from pyspark.sql import functions as F

from flightlake import operators as op
from flightlake.schemas import ONTIME_COLUMNS, ONTIME_KEY, ONTIME_SILVER
from flightlake.session import local_path, scratch_path
from flightlake.sources import bronze


def _flight(date="2025-02-01", fl="AA1", origin="ORD", dest="JFK", delay="20", aircraft="A321"):
    return {
        "flight_date": date, "flight_status": "active",
        "departure": {"iata": origin, "airport": "O'Hare", "delay": delay,
                      "scheduled": f"{date}T10:00:00", "actual": None},
        "arrival": {"iata": dest, "airport": "JFK", "delay": None},
        "airline": {"name": "American", "iata": "AA"},
        "flight": {"iata": fl},
        "aircraft": None if aircraft is None else {"iata": aircraft},
    }


def _write_json_docs(spark, docs):
    path = scratch_path(spark, "json-fixture")
    root = local_path(path)
    import os
    os.makedirs(f"{root}/2025/02/01", exist_ok=True)
    with open(f"{root}/2025/02/01/snapshot.json", "w") as fh:
        for d in docs:
            fh.write(json.dumps(d) + "\n")
    return path


def test_explicit_schema_survives_bad_days(spark):  # T1
    docs = [
        {"flights": {"data": [_flight(aircraft=None), _flight(fl="AA2", delay=None)]},
         "_ingested_at": "2025-02-01T22:00:00"},
        {"flights": {"data": []}, "_ingested_at": "2025-02-01T22:00:00"},
        {"flights": {"error": {"code": "usage_limit_reached"}}, "_ingested_at": "x"},
        {"flights": {"data": [_flight(origin=None)]}, "_ingested_at": "2025-02-01T22:00:00"},
    ]
    path = _write_json_docs(spark, docs)
    env = bronze.read_envelopes(spark, path, "flights", glob="*/*/*/snapshot.json")
    assert env.select("_snapshot_date").distinct().collect()[0][0] == "2025-02-01"
    flat = op.flatten_live(env)
    rows = {r.flight_iata: r for r in flat.collect()}
    assert set(rows) == {"AA1", "AA2"}  # empty data, error body and null origin give no rows
    assert rows["AA1"].aircraft_type is None
    assert rows["AA2"].dep_delay is None
    assert rows["AA1"].dep_delay == 20.0


def test_status_filter(spark):  # FLT-5
    recs = spark.createDataFrame(
        [(json.dumps({"flights": {"data": [_flight()]}, "_ingested_at": "t"}),)], "e string"
    ).select(F.from_json("e", bronze.FEEDS["flights"]).alias("e")).select("e.*")
    assert op.flatten_live(recs, statuses=["active"]).count() == 1
    assert op.flatten_live(recs, statuses=["landed"]).count() == 0


def _raw(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ONTIME_COLUMNS))


def _row(**kw):
    base = dict(FlightDate="2025-02-01", Reporting_Airline="AA", Tail_Number="N1",
                Origin="ORD", Dest="JFK", DepTime="830", DepDelay="20.00", ArrTime="1000",
                ArrDelay="5.00", Cancelled="0.00", CancellationCode=None,
                CarrierDelay="10.00", WeatherDelay="0.00", NASDelay="10.00",
                SecurityDelay="0.00", LateAircraftDelay="0.00")
    base.update(kw)
    return tuple(base[c] for c in ONTIME_COLUMNS)


def test_clean_ontime_types_and_filters(spark):  # PRJ-5..9, FLT-3
    df = op.clean_ontime(_raw(spark, [
        _row(), _row(Origin=None), _row(DepDelay="abc", Cancelled="1.00", DepTime=None)]))
    assert df.schema == ONTIME_SILVER
    rows = df.collect()
    assert len(rows) == 2
    assert rows[0].is_delayed is True and rows[0].is_cancelled is False
    assert rows[1].DEP_DELAY is None and rows[1].is_delayed is None and rows[1].is_cancelled


def test_dedupe_deterministic_and_null_keys_collapse(spark):  # T5, DST-2
    rows = [_row(Tail_Number="N2"), _row(Tail_Number="N1"), _row(Tail_Number="N3"),
            _row(DepTime=None, Cancelled="1.00", Tail_Number="N9"),
            _row(DepTime=None, Cancelled="1.00", Tail_Number="N8")]
    raw = _raw(spark, rows)
    for parts in (1, 3, 5):
        out = op.ontime_silver(raw.repartition(parts)).orderBy("DEP_TIME").collect()
        assert [r.TAIL_NUM for r in out] == ["N9", "N3"]


def test_dedupe_idempotent(spark):
    raw = _raw(spark, [_row(Tail_Number=f"N{i % 3}") for i in range(9)])
    once = op.ontime_silver(raw)
    twice = op.dedupe(once, ONTIME_KEY)
    assert Counter(once.collect()) == Counter(twice.collect())


def test_hot_key_dedupe_is_partial_aggregate(spark):
    """A key holding most rows is reduced map side: the plan aggregates before
    the exchange (partial max), so no task receives the hot key's rows."""
    raw = _raw(spark, [_row(Tail_Number=f"N{i}") for i in range(200)])
    df = op.ontime_silver(raw.repartition(4))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    assert df.count() == 1 and df.collect()[0].TAIL_NUM == "N99"


def test_weather_allow_list_and_visibility(spark):  # FLT-2, FLT-6, PRJ-4
    recs = [("KORD", "1", "3", "10", "10+", "VFR", "raw"), ("KXXX", "1", "3", "10", "3", "IFR", "r"),
            (None, "1", "3", "10", "3", "IFR", "r")]
    env = spark.createDataFrame(
        [([dict(zip(["icaoId", "obsTime", "temp", "wspd", "visib", "fltCat", "rawOb"], r))
           for r in recs], "2025-02-01T22:00:00")],
        bronze.FEEDS["weather"])
    stations = spark.createDataFrame([("KORD",)], "airport_icao string")
    out = op.flatten_weather(env, stations).collect()
    assert [(r.airport_icao, r.visibility_sm) for r in out] == [("KORD", 10.0)]
    assert op.flatten_weather(env).count() == 2


def test_land_snapshot_rerun_replaces_day(spark):  # SNK-11
    root = scratch_path(spark, "landing")
    rec = F.struct(F.lit("KORD").alias("icaoId"), F.lit("1").alias("obsTime"),
                   *[F.lit(None).cast("string").alias(c)
                     for c in ["temp", "wspd", "visib", "fltCat", "rawOb"]])
    day1 = spark.range(3).select(rec.alias("record"), F.lit("2025-02-01T22:00:00").alias("_ingested_at"))
    day2 = spark.range(2).select(rec.alias("record"), F.lit("2025-02-02T22:00:00").alias("_ingested_at"))
    bronze.land_snapshot(day1, root, "weather")
    bronze.land_snapshot(day2, root, "weather")
    again = bronze.land_snapshot(day2.limit(1), root, "weather")
    counts = {r[0]: r[1] for r in again.groupBy("_snapshot_date").count().collect()}
    assert counts == {"2025-02-01": 3, "2025-02-02": 1}


def test_schema_drift(spark):  # SRC-8
    cols = [c for c in ONTIME_COLUMNS if c != "Tail_Number"] + ["Extra"]
    out = {c: status for c, status, _ in bronze.schema_drift(cols)}
    assert out["Tail_Number"] == "missing" and out["Extra"] == "unexpected"
    assert out["Origin"] == "ok"


def test_csv_reader_missing_column_reads_null(spark):  # SRC-3
    path = scratch_path(spark, "csv")
    raw = _raw(spark, [_row()]).drop("Tail_Number").withColumn("Flights", F.lit("1.00"))
    bronze.write_ontime_csv(raw, path)
    back = bronze.read_ontime_csv(spark, f"{path}/*.csv")
    r = op.clean_ontime(back).collect()[0]
    assert r.TAIL_NUM is None and r.DEP_DELAY == 20.0


def test_stamp_ingestion_one_time_per_run(spark):  # SC-19
    payload = spark.range(5).select(F.struct(F.col("id").cast("string").alias("icaoId")).alias("record"))
    stamped = bronze.stamp_ingestion(payload)
    vals = {r._ingested_at for r in stamped.collect()}
    assert len(vals) == 1
    v = vals.pop()
    assert len(v) == 26 and v[10] == "T"


def test_csv_months_are_read_by_their_own_headers(spark):  # SRC-3, SRC-8
    import os

    from flightlake.session import local_path
    path = scratch_path(spark, "csv-months")
    root = local_path(path)
    os.makedirs(root)
    with open(f"{root}/2025-01.csv", "w") as fh:
        fh.write(",".join(ONTIME_COLUMNS) + "\n" + ",".join(v or "" for v in _row()) + "\n")
    swapped = ["Dest", "Origin"] + [c for c in ONTIME_COLUMNS if c not in ("Dest", "Origin", "SecurityDelay")] + ["New"]
    with open(f"{root}/2025-02.csv", "w") as fh:
        fh.write(",".join(swapped) + "\n" + ",".join(["LAX", "SFO"] + ["7"] * 13 + ["n"]) + "\n")
    rows = {r.Origin: r for r in bronze.read_ontime_csv(spark, f"{path}/*.csv").collect()}
    assert len(rows) == 2 and rows["SFO"].Dest == "LAX" and rows["SFO"].DepDelay == "7"
    assert rows["SFO"].SecurityDelay is None and rows["SFO"].New == "n"
    drift = {(r.file.rsplit("/", 1)[-1], r.column_name): (r.status, r.position, r.n_rows)
             for r in bronze.drift_report(spark, f"{path}/*.csv").collect()}
    assert drift["2025-02.csv", "SecurityDelay"] == ("missing", None, 1)
    assert drift["2025-02.csv", "New"] == ("unexpected", 16, 1)
    assert drift["2025-02.csv", "Dest"] == ("ok", 1, 1) and drift["2025-01.csv", "Dest"][0] == "ok"


def test_pretty_printed_snapshot(spark):  # T15
    import os

    from flightlake.session import local_path
    path = scratch_path(spark, "json-pretty")
    root = local_path(path)
    os.makedirs(f"{root}/2025/02/01")
    doc = {"flights": {"data": [_flight(), _flight(fl="AA9")]}, "_ingested_at": "2025-02-01T22:00:00"}
    with open(f"{root}/2025/02/01/snapshot.json", "w") as fh:
        json.dump(doc, fh, indent=2)
    env = bronze.read_envelopes(spark, path, "flights", glob="*/*/*/snapshot.json", multi_line=True)
    assert op.flatten_live(env).count() == 2


def test_polled_flights_are_all_active_ones(spark, sf_small):  # FLT-5
    from flightlake.sources import surrogate
    from flightlake.sources.tables import Tables
    flat = op.flatten_live(bronze.wrap_envelope(surrogate.live_records(Tables(spark, sf_small)), "flights"))
    want = flat.filter(F.col("flight_status") == "click").count()
    assert op.polled_flights(flat, ["click"]).count() == want > 100


def test_dedupe_keeps_the_newest_report_and_values_before_nulls(spark):  # DST-1, DST-2
    docs = [{"flights": {"data": [_flight(fl=" ")]}, "_ingested_at": f"2025-02-0{d}T22:00:00"} for d in (1, 3, 2)]
    path = scratch_path(spark, "newest")
    spark.createDataFrame([(json.dumps(d),) for d in docs], "value string").write.text(path)
    kept = op.live_silver(bronze.read_envelopes(spark, path, "flights", glob="*.txt")).collect()
    assert [(r.flight_iata, r._ingested_at) for r in kept] == [(None, "2025-02-03T22:00:00")]
    raw = _raw(spark, [_row(), _row()]).withColumn("ArrDelay", F.when(F.monotonically_increasing_id() % 2 == 0, F.col("ArrDelay")))
    assert all(r.ARR_DELAY is not None for r in op.ontime_silver(raw).collect())


def test_truncated_lines_are_rejected_and_the_rest_read(spark):  # SRC-1
    path = scratch_path(spark, "cut-lines")
    good = json.dumps({"flights": {"data": [_flight()]}, "_ingested_at": "2025-02-01T22:00:00"})
    spark.createDataFrame([(good,), (good[:60],)], "value string").write.text(f"{path}/2025/02/01")
    lines = bronze.rejects(spark, path, "flights", glob="*/*/*/*.txt").collect()
    assert [(r._corrupt_record, r._snapshot_date) for r in lines] == [(good[:60], "2025-02-01")]
    assert op.flatten_live(bronze.read_envelopes(spark, path, "flights", glob="*/*/*/*.txt", rejects=True)).count() == 1

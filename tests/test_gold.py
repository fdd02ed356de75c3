"""Gold aggregates: thresholds, null semantics, the weather join, reports."""

from collections import Counter
from pyspark.sql import functions as F

from flightlake import operators as op
from flightlake.plans import reports
from flightlake.schemas import ONTIME_SILVER

COLS = ONTIME_SILVER.fieldNames()


def flights(spark, rows):
    """rows: dicts with silver columns; missing columns are null."""
    return spark.createDataFrame([tuple(r.get(c) for c in COLS) for r in rows], ONTIME_SILVER)


def f(carrier="AA", origin="ORD", dest="JFK", delay=20.0, dep="830", date="2025-02-01", **kw):
    r = dict(FL_DATE=date, OP_CARRIER=carrier, Origin=origin, Dest=dest, DEP_TIME=dep,
             DEP_DELAY=delay, is_delayed=None if delay is None else delay > 15,
             is_cancelled=False)
    r.update(kw)
    return r


def test_route_threshold_boundary(spark):  # HAV-1: 10 kept, 9 dropped
    rows = [f(dest="JFK") for _ in range(10)] + [f(dest="LAX") for _ in range(9)]
    out = op.route_delay_summary(flights(spark, rows)).collect()
    assert [(r.Dest, r.total_flights) for r in out] == [("JFK", 10)]


def test_cause_threshold_boundary_and_null_flags(spark):  # HAV-2, FLT-4, T11
    rows = ([f(origin="ORD", CARRIER_DELAY=10.0) for _ in range(5)]
            + [f(origin="ATL") for _ in range(4)]
            + [f(origin="ORD", delay=None) for _ in range(3)]
            + [f(origin="ORD", delay=5.0) for _ in range(3)]
            + [f(origin="ORD", CARRIER_DELAY=None)])
    out = op.delay_cause_breakdown(flights(spark, rows)).collect()
    assert len(out) == 1
    assert out[0].Origin == "ORD" and out[0].total_delayed_flights == 6
    assert out[0].avg_carrier_delay == 10.0  # null cause skipped, row still counted


def test_rates_null_vs_zero(spark):  # AF-3, AF-4, T13
    rows = [f(delay=None, is_cancelled=None), f(delay=None, is_cancelled=None)]
    c = op.carrier_performance(flights(spark, rows)).collect()[0]
    assert c.delay_rate is None and c.total_cancelled is None and c.total_flights == 2


def test_live_summary_delayed_never_null_and_first(spark):  # AF-5, AF-6, HAV-3
    live = spark.createDataFrame(
        [("UA", "ORD", "JFK", None, "2025-02-02", "09:00", "UA2", "B738"),
         ("UA", "ORD", "JFK", None, "2025-02-01", "10:00", "UA1", None),
         ("UA", "ORD", "SFO", 30.0, "2025-02-01", "10:00", "UA3", "A320")],
        "carrier string, origin string, dest string, dep_delay double, flight_date string, "
        "scheduled_dep string, flight_iata string, aircraft_type string"
    ).withColumn("arr_delay", F.lit(None).cast("double"))
    out = op.live_route_summary(live).collect()
    assert len(out) == 1  # SFO has one flight
    assert out[0].delayed_flights == 0 and out[0].avg_dep_delay is None
    assert out[0].aircraft_type is None  # first flight's (null) type, like first()


def test_hourly_sum_equals_silver_count(spark, sf_small):  # property
    from flightlake.queries import ontime_silver
    silver = ontime_silver(spark, sf_small)
    gold = op.airport_hourly_delay(silver)
    assert gold.agg(F.sum("total_flights")).collect()[0][0] == silver.count()
    bad = gold.filter((F.col("delay_rate") < 0) | (F.col("delay_rate") > 1)).count()
    assert bad == 0


def _weather(spark, rows):
    return spark.createDataFrame(
        rows, "airport_icao string, obs_time string, temp_c double, wind_kt double, "
              "visibility_sm double, flight_category string, raw_text string, _ingested_at string")


def test_latest_join_preserves_flights(spark):  # T8b latest mode
    fl = flights(spark, [f(origin="ORD"), f(origin="ORD", dest="LAX"), f(origin="HNL")])
    wx = _weather(spark, [("KORD", "2025-02-01 10:00:00", 1.0, 5.0, 10.0, "VFR", "a", "x"),
                          ("KORD", "2025-02-01 11:00:00", 2.0, 6.0, 1.0, "IFR", "b", "x"),
                          ("KJFK", "2025-02-01 11:00:00", 3.0, 6.0, 1.0, "IFR", "c", "x")])
    out = op.flight_weather(fl, wx).collect()
    assert len(out) == 3
    cats = sorted((r.Origin, r.flight_category) for r in out)
    assert cats == [("HNL", None), ("ORD", "IFR"), ("ORD", "IFR")]


def test_station_map_overrides_prefix(spark):  # T8
    fl = flights(spark, [f(origin="HNL")])
    wx = _weather(spark, [("PHNL", "2025-02-01 10:00:00", 25.0, 5.0, 10.0, "VFR", "a", "x")])
    smap = spark.createDataFrame([("HNL", "PHNL")], "iata string, airport_icao string")
    out = op.flight_weather(fl, wx, station_map=smap).collect()
    assert out[0].flight_category == "VFR"


def test_fanout_summary_equals_materialised_join(spark):  # T8b all mode
    fl = flights(spark, [f(origin="ORD", delay=20.0), f(origin="ORD", delay=None),
                         f(origin="ORD", delay=5.0), f(origin="HNL", delay=30.0)])
    wx = _weather(spark, [("KORD", "t1", 1.0, 5.0, 10.0, "VFR", "a", "x"),
                          ("KORD", "t2", None, 6.0, 1.0, "VFR", "b", "x"),
                          ("KORD", "t3", 4.0, 6.0, 1.0, "IFR", "c", "x"),
                          ("KORD", "t4", 2.0, 6.0, 1.0, None, "d", "x")])
    brute = (fl.join(wx, F.concat(F.lit("K"), fl.Origin) == wx.airport_icao, "left")
             .groupBy("Origin", "flight_category")
             .agg(F.count(F.lit(1)).alias("joined_rows"),
                  F.avg("DEP_DELAY").alias("avg_dep_delay"),
                  F.sum(F.col("is_delayed").cast("int")).alias("delayed_rows"),
                  F.avg("temp_c").alias("avg_temp_c")))
    got = op.fanout_summary(fl, wx)
    assert Counter(got.collect()) == Counter(brute.select(*got.columns).collect())


def test_hour_risk_is_count_weighted(spark):  # T9
    rows = [f(origin="ORD", dep="0600", delay=0.0)] * 9 + [f(origin="ATL", dep="0610", delay=100.0)]
    out = reports.hour_risk(flights(spark, rows)).collect()
    assert len(out) == 1 and out[0].avg_delay == 10.0 and out[0].risk_rank == 1


def test_cause_share_sums_to_one(spark):  # RPT-5
    rows = [f(CARRIER_DELAY=30.0, WEATHER_DELAY=10.0, NAS_DELAY=0.0, LATE_AIRCRAFT_DELAY=60.0)]
    out = {r.cause: r.share for r in reports.cause_share(flights(spark, rows)).collect()}
    assert out == {"carrier": 0.3, "weather": 0.1, "nas": 0.0, "late_aircraft": 0.6}


def test_worst_routes_tie_break(spark):  # TOP-2
    rows = [f(dest=d, delay=50.0) for d in ("B", "A", "C") for _ in range(10)]
    routes = op.route_delay_summary(flights(spark, rows))
    assert [r.Dest for r in reports.worst_routes(routes, k=2).collect()] == ["A", "B"]


def test_month_merges_years_unless_year_key(spark):  # T7
    rows = [f(date="2025-02-01"), f(date="2026-02-01")]
    merged = op.airport_hourly_delay(flights(spark, rows)).collect()
    split = op.airport_hourly_delay(flights(spark, rows), with_year=True).collect()
    assert [(r.month, r.total_flights) for r in merged] == [(2, 2)]
    assert sorted((r.year, r.total_flights) for r in split) == [(2025, 1), (2026, 1)]


def test_station_map_duplicates_do_not_multiply_flights(spark):  # T8
    fl = flights(spark, [f(origin="HNL"), f(origin="ORD")])
    wx = _weather(spark, [("PHNL", "2025-02-01 10:00:00", 25.0, 5.0, 10.0, "VFR", "a", "x")])
    smap = spark.createDataFrame([("HNL", "PHNL"), ("HNL", "PHNX")], "iata string, airport_icao string")
    out = op.flight_weather(fl, wx, station_map=smap).collect()
    assert len(out) == 2
    assert {r.Origin: r.flight_category for r in out} == {"HNL": "VFR", "ORD": None}


def test_partials_roll_up_equals_direct(spark, sf_small):  # AGG-2, AGG-3 from one pass
    from flightlake.queries import ontime_silver
    silver = ontime_silver(spark, sf_small)
    p = op.route_partials(silver)
    assert Counter(op.route_delay_summary_from(p).collect()) == \
        Counter(op.route_delay_summary(silver).collect())
    assert op.carrier_performance_from(p).collect() == op.carrier_performance(silver).collect()
    assert Counter(op.delay_cause_breakdown_from(p).collect()) == \
        Counter(op.delay_cause_breakdown(silver).collect())
    for k in (1, 140):
        assert Counter(op.delay_cause_breakdown_from(p, k).collect()) == \
            Counter(op.delay_cause_breakdown(silver, k).collect())
    nulls = flights(spark, [f(delay=None, is_cancelled=None)] * 12)
    q = op.route_partials(nulls)
    assert Counter(op.route_delay_summary_from(q).collect()) == \
        Counter(op.route_delay_summary(nulls).collect())
    assert op.carrier_performance_from(q).collect() == op.carrier_performance(nulls).collect()
    assert op.delay_cause_breakdown_from(q).collect() == op.delay_cause_breakdown(nulls).collect() == []

"""Plan shape: pruning, pushdown, join strategy, one exchange per aggregate."""

import re

from pyspark.sql import functions as F

from flightlake import operators as op
from flightlake.session import scratch_path


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _silver_table(spark, sf_small):
    from flightlake.queries import ontime_silver
    path = scratch_path(spark, "silver-plan")
    ontime_silver(spark, sf_small).write.parquet(path)
    return spark.read.parquet(path)


def test_gold_reads_only_needed_columns(spark, sf_small):
    silver = _silver_table(spark, sf_small)
    plan = plan_of(op.route_delay_summary(silver))
    scanned = re.search(r"FileScan parquet \[([^\]]*)\]", plan).group(1)
    read = {c.split("#")[0] for c in scanned.split(",")}
    assert read == {"OP_CARRIER", "Origin", "Dest", "DEP_DELAY", "is_delayed", "CARRIER_DELAY",
                    "WEATHER_DELAY", "NAS_DELAY", "LATE_AIRCRAFT_DELAY"}
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_avg" in plan


def test_delayed_filter_pushed_to_scan(spark, sf_small):
    silver = _silver_table(spark, sf_small)
    plan = plan_of(op.delay_cause_breakdown(silver))
    assert "PushedFilters: [IsNotNull(is_delayed), EqualTo(is_delayed,true)]" in plan


def test_weather_join_broadcasts_checked_side(spark, sf_small):
    from flightlake.queries import q_flight_weather_latest
    plan = plan_of(q_flight_weather_latest(spark, sf_small))
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan


def test_weather_join_falls_back_when_side_too_large(spark):
    fl = spark.range(50).select((F.col("id") % 7).cast("string").alias("Origin"),
                                F.lit("d").alias("FL_DATE"),
                                F.lit("AA").alias("OP_CARRIER"), F.lit("JFK").alias("Dest"),
                                F.lit(1.0).alias("DEP_DELAY"), F.lit(False).alias("is_delayed"))
    wx = spark.range(30).select(F.concat(F.lit("K"), F.col("id").cast("string")).alias("airport_icao"),
                                F.lit("t").alias("obs_time"), F.lit(1.0).alias("temp_c"),
                                F.lit(1.0).alias("wind_kt"), F.lit(1.0).alias("visibility_sm"),
                                F.lit("VFR").alias("flight_category"), F.lit("r").alias("raw_text"),
                                F.lit("i").alias("_ingested_at"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = plan_of(op.flight_weather(fl, wx, max_broadcast_rows=100))
        large = plan_of(op.flight_weather(fl, wx, max_broadcast_rows=10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in small
    assert "BroadcastHashJoin" not in large and "SortMergeJoin" in large and "_salt" in large


def test_fact_join_is_not_broadcast(spark, sf_small):
    from flightlake.sources import surrogate
    from flightlake.sources.tables import Tables
    plan = plan_of(surrogate.ontime_raw(Tables(spark, sf_small)))
    assert "SortMergeJoin" in plan
    # lineitem is never a broadcast build side
    for m in re.finditer(r"BroadcastExchange", plan):
        assert "lineitem" not in plan[m.end(): m.end() + 400].split("BroadcastHashJoin")[0]


def test_fanout_summary_never_joins_rows(spark, sf_small):
    from flightlake.queries import q_flight_weather_all
    plan = plan_of(q_flight_weather_all(spark, sf_small))
    # the only join is between two aggregates
    join_at = plan.index("HashJoin")
    assert "HashAggregate" in plan[join_at:]


def test_hot_origin_is_salted_when_not_broadcast(spark):
    """A hub airport with a third of all flights: when the weather side is too
    large to broadcast, the salted join spreads the hub over many tasks and
    the result equals the broadcast join's."""
    from collections import Counter
    n = 3000
    fl = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HUB")).otherwise((F.col("id") % 97).cast("string"))
         .alias("Origin"),
        F.lit("d").alias("FL_DATE"), F.lit("AA").alias("OP_CARRIER"),
        F.col("id").cast("string").alias("Dest"),
        F.lit(1.0).alias("DEP_DELAY"), F.lit(False).alias("is_delayed"))
    wx = spark.range(200).select(
        F.concat(F.lit("K"), F.when(F.col("id") == 0, F.lit("HUB"))
                 .otherwise(F.col("id").cast("string"))).alias("airport_icao"),
        F.lit("t").alias("obs_time"), F.col("id").cast("double").alias("temp_c"),
        F.lit(1.0).alias("wind_kt"), F.lit(1.0).alias("visibility_sm"),
        F.lit("VFR").alias("flight_category"), F.lit("r").alias("raw_text"),
        F.lit("i").alias("_ingested_at"))
    salted = op.flight_weather(fl, wx, max_broadcast_rows=10, salts=8)
    tasks = (salted.filter(F.col("Origin") == "HUB")
             .withColumn("p", F.spark_partition_id()).groupBy("p").count().collect())
    assert len(tasks) > 1 and max(r["count"] for r in tasks) < n // 3
    broadcast = op.flight_weather(fl, wx)
    assert Counter(salted.collect()) == Counter(broadcast.collect())


def test_hot_order_key_is_split_in_fact_join(spark):
    """One order key holding a third of lineitem: the fact join's own shuffles
    let AQE split the hot partition (an explicit repartition would not)."""
    from types import SimpleNamespace

    from flightlake.sources import surrogate
    n = 6000
    t = SimpleNamespace(
        lineitem=spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("l_orderkey"),
            (F.col("id") % 50).alias("l_partkey"), (F.col("id") % 10 + 1).alias("l_suppkey"),
            F.lit(1).alias("l_linenumber"), F.lit(10.0).alias("l_quantity"),
            F.lit(0.05).alias("l_discount"), F.lit(0.02).alias("l_tax"),
            F.lit("N").alias("l_returnflag")),
        orders=spark.range(n).select(
            F.col("id").alias("o_orderkey"), (F.col("id") % 5).alias("o_custkey"),
            F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("o_orderdate"),
            F.lit("1-URGENT").alias("o_orderpriority")),
        customer=spark.range(5).select(F.col("id").alias("c_custkey"),
                                       (F.col("id") % 3).cast("int").alias("c_nationkey")),
        supplier=spark.range(1, 11).select(F.col("id").alias("s_suppkey"),
                                           (F.col("id") % 3).cast("int").alias("s_nationkey")),
        nation=spark.range(3).select(F.col("id").cast("int").alias("n_nationkey"),
                                     F.concat(F.lit("N"), F.col("id")).alias("n_name")))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = surrogate.ontime_raw(t)
        assert len(df.collect()) == n
        final = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert re.search(r"SortMergeJoin\(skew=true\) \[l_orderkey", final)


def test_poll_cap_limits_before_each_shuffle(spark):
    """One day holding nearly every row: each of the two limit stages runs a
    partial group limit before its exchange, so no task forwards more than n
    rows per group and the hot day's rows never meet in one task."""
    v = F.col("id") * 7919 % 20000
    hot = spark.range(20000).select(
        F.when(v < 19990, "2025-02-01").otherwise("2025-02-02").alias("day"), v.alias("v"))
    capped = op.first_n_per_group(hot, ["day"], 3, ["v"])
    plan = plan_of(capped)
    assert len(re.findall(r"WindowGroupLimit \[day.*Partial", plan)) == 2
    assert len(re.findall(r"WindowGroupLimit \[day.*Final", plan)) == 2
    assert sorted((r.day, r.v) for r in capped.collect()) == [
        ("2025-02-01", 0), ("2025-02-01", 1), ("2025-02-01", 2),
        ("2025-02-02", 19990), ("2025-02-02", 19991), ("2025-02-02", 19992)]

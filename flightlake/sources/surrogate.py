"""Bronze-shaped frames derived from the driver's tables.

The reference ships no data; its three feeds are rebuilt here from the
TPC-H-like tables so that every job reads real, scale-dependent input:

* ``ontime_raw``     — on-time CSV rows (all text), lineitem × orders ×
                       supplier × customer × nation.
* ``weather_records``— weather observations, events × nation.
* ``live_records``   — live flight records (nested), events × nation.

All derivations are joins and projections; nothing is sampled or capped.
The exact rules are listed in ``FIXTURES.md`` §B and mirrored by the DuckDB
oracle in :mod:`flightlake.oracle`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import Tables


def _txt(c: Column) -> Column:
    return c.cast("string")


def _minutes_text(c: Column) -> Column:
    """Integer minutes as the publisher writes them: '-3.00', '15.00'."""
    return F.concat(_txt(c.cast("int")), F.lit(".00"))


def ontime_raw(t: Tables) -> DataFrame:
    """On-time CSV shape: the 16 kept columns plus an unused ``Flights`` column.

    Join order for scale. Each dimension joins as its *base table*, so the
    planner decides broadcast vs. sort-merge on the measured file size (a
    joined dimension would be estimated as a product of its inputs and never
    broadcast). Orders meets customer before lineitem, so the wide fact table
    is shuffled once for that join, on ``l_orderkey`` (and again for supplier
    where that table is too large to broadcast); both sides of that join
    arrive hash-partitioned on the key and it runs as a sort-merge join, which
    spills safely at any size (the fact table is never a broadcast side).
    """
    # The nation side is joined unrenamed (renamed after the join), so both
    # of its joins broadcast the same plan and Spark reuses one exchange.
    nation = t.nation.select("n_nationkey", "n_name")
    orders = (t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
              .join(t.customer.select("c_custkey", "c_nationkey"),
                    F.col("o_custkey") == F.col("c_custkey"))
              .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
              .select("o_orderkey", "o_orderdate", "o_orderpriority",
                      F.col("n_name").alias("c_nation")))
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                           "l_quantity", "l_discount", "l_tax", "l_returnflag")
    # The join plans its own exchanges (ENSURE_REQUIREMENTS), which AQE may
    # split when one order key is hot; an explicit repartition would not be.
    j = (li.hint("merge").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(t.supplier.select("s_suppkey", "s_nationkey"),
               F.col("l_suppkey") == F.col("s_suppkey")))
    j = (j.join(nation, j["s_nationkey"] == nation["n_nationkey"])
         .withColumnRenamed("n_name", "s_nation"))

    pk, sk, ln, q = (F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber"),
                     F.col("l_quantity"))
    tax_pct = F.round(F.col("l_tax") * 100).cast("int")
    canc = (F.col("l_returnflag") == "R") & (tax_pct == 8)
    caused = ~canc & (q > 35)

    def unless_cancelled(c: Column) -> Column:
        return F.when(~canc, c)

    def cause(c: Column) -> Column:
        return F.when(caused, _minutes_text(c))

    return j.select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("FlightDate"),
        F.substring("o_orderpriority", 1, 1).alias("Reporting_Airline"),
        F.concat(F.lit("N"), _txt(pk)).alias("Tail_Number"),
        F.when(sk % 50 != 0, F.col("s_nation")).alias("Origin"),
        F.col("c_nation").alias("Dest"),
        unless_cancelled(_txt(((pk + ln) % 24) * 100 + sk % 60)).alias("DepTime"),
        unless_cancelled(_minutes_text(q - 20)).alias("DepDelay"),
        unless_cancelled(_txt(((pk + ln + 2) % 24) * 100)).alias("ArrTime"),
        F.when(canc, None).when(pk % 97 == 0, F.lit("n/a"))
         .otherwise(_minutes_text(q - 24 + ln)).alias("ArrDelay"),
        F.when(canc, F.lit("1.00")).otherwise(F.lit("0.00")).alias("Cancelled"),
        F.when(canc, F.expr("substr('ABCD', cast(1 + l_partkey % 4 as int), 1)"))
         .alias("CancellationCode"),
        cause(ln).alias("CarrierDelay"),
        cause(F.round(F.col("l_discount") * 100)).alias("WeatherDelay"),
        cause(tax_pct).alias("NASDelay"),
        cause(F.lit(0)).alias("SecurityDelay"),
        cause(q - 35).alias("LateAircraftDelay"),
        F.lit("1.00").alias("Flights"),
    )


def _event_nation(t: Tables, key: Column, prefix: str, by_day: bool = False) -> DataFrame:
    """events joined to the nation ``key`` maps to.

    ``by_day`` deals the narrow events out by day first (AQE splits large days and
    joins small ones). A record is many times its event: a landing of a few row
    groups would else keep a few tasks busy, each with a part of every day.

    No broadcast hint: the planner broadcasts the nation table by its file
    size statistic, i.e. only because its size is known to be small.
    """
    n = t.nation.select(F.col("n_nationkey").alias(f"{prefix}_key"),
                        F.col("n_name").alias(f"{prefix}_name"),
                        F.col("n_regionkey").alias(f"{prefix}_region"))
    ev = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    if by_day:
        ev = ev.withColumn("_day", F.to_date("ts")).hint("rebalance", F.col("_day")).drop("_day")
    return ev.join(n, key == F.col(f"{prefix}_key"))


def weather_records(t: Tables, by_day: bool = False) -> DataFrame:
    """Weather observations in the API's shape, one per events row.

    Stations in region 4 carry a non-"K" prefix, like stations outside the
    contiguous US: they are not in the polled list and never match a flight.
    """
    ev = _event_nation(t, F.col("user_id") % 25, "st", by_day)
    icao = F.concat(F.when(F.col("st_region") == 4, F.lit("P")).otherwise(F.lit("K")),
                    F.col("st_name"))
    cat = (F.when(F.col("event_type") == "click", "VFR")
           .when(F.col("event_type") == "view", "MVFR")
           .when(F.col("event_type") == "purchase", "IFR")
           .when(F.col("event_type") == "signup", "LIFR"))
    visib = (F.when(F.col("event_type") == "error", F.lit(""))
             .when(F.col("value") > 100, F.lit("10+"))
             .otherwise(_txt(F.floor(F.col("value") / 10))))
    rec = F.struct(
        icao.alias("icaoId"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("obsTime"),
        _txt(F.floor("value") % 45 - 10).alias("temp"),
        _txt(F.col("user_id") % 30).alias("wspd"),
        visib.alias("visib"),
        cat.alias("fltCat"),
        F.concat(icao, F.lit(" "), F.date_format("ts", "ddHHmm"), F.lit("Z")).alias("rawOb"),
    )
    return ev.select(
        rec.alias("record"),
        F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit("T22:00:00")).alias("_ingested_at"),
    )


# In the derived live feed the flight status is the event type; "click" plays
# the poller's "active" status.
ACTIVE_STATUS = "click"


def live_records(t: Tables, by_day: bool = False) -> DataFrame:
    """Live flight records in the API's nested shape, one per events row.

    Some records carry no flight day or a blank one, and every third arrives a
    day later, so a flight may be reported more than once by different polls.
    """
    ev = _event_nation(t, F.col("user_id") % 25, "o", by_day)
    n = t.nation.select(F.col("n_nationkey").alias("d_key"), F.col("n_name").alias("d_name"))
    ev = ev.join(n, F.col("event_id") % 25 == F.col("d_key"))
    dep_delay = F.when(F.col("event_id") % 11 != 0, _txt(F.floor("value")))
    scheduled = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    rec = F.struct(
        F.when(F.col("event_id") % 53 == 0, None).when(F.col("event_id") % 59 == 0, F.lit(""))
         .otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("flight_date"),
        F.col("event_type").alias("flight_status"),
        F.struct(
            F.when(F.col("event_id") % 40 != 0, F.col("o_name")).alias("iata"),
            F.concat(F.col("o_name"), F.lit(" Intl")).alias("airport"),
            dep_delay.alias("delay"),
            scheduled.alias("scheduled"),
            F.when(dep_delay.isNotNull(), scheduled).alias("actual"),
        ).alias("departure"),
        F.struct(
            F.col("d_name").alias("iata"),
            F.concat(F.col("d_name"), F.lit(" Intl")).alias("airport"),
            _txt(F.floor(F.col("value") / 2)).alias("delay"),
        ).alias("arrival"),
        F.struct(
            F.concat(F.upper("event_type"), F.lit(" AIR")).alias("name"),
            F.upper(F.substring("event_type", 1, 1)).alias("iata"),
        ).alias("airline"),
        F.struct(F.concat(F.lit("F"), _txt(F.col("user_id"))).alias("iata")).alias("flight"),
        F.struct(F.when(F.col("event_type") != "error",
                        F.concat(F.lit("A"), _txt(F.col("user_id") % 4))).alias("iata")
                 ).alias("aircraft"),
    )
    return ev.select(
        rec.alias("record"),
        F.concat(F.date_format(F.date_add(F.to_date("ts"), (F.col("event_id") % 3 == 0).cast("int")),
                               "yyyy-MM-dd"), F.lit("T22:00:00")).alias("_ingested_at"),
    )

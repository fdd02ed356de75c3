"""Business reports over silver and gold (RPT-1..6, TOP-1/2).

Reports that re-aggregate read silver, not gold averages: an average of
averages is wrong, and ``total_flights`` counts rows with a null delay, so
``avg × count`` is not the sum (T9). Windows appear only over already
aggregated rows (one per hour or carrier), never over flights.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as fx
from ..schemas import ALL_CAUSES, GOLD_CAUSES


def hour_risk(flights: DataFrame) -> DataFrame:
    """Delay by hour of day over all flights (RPT-1), ranked riskiest first.

    ``risk_rank`` orders by delay rate (then hour); the window runs over the
    ≤ 26 aggregated hour rows only.
    """
    by_hour = (flights.withColumn("dep_hour", fx.hhmm_hour("DEP_TIME"))
               .groupBy("dep_hour")
               .agg(fx.rows().alias("total_flights"),
                    F.avg("DEP_DELAY").alias("avg_delay"),
                    fx.rate("is_delayed").alias("delay_rate")))
    w = Window.orderBy(F.col("delay_rate").desc_nulls_last(), F.col("dep_hour").asc_nulls_last())
    return by_hour.withColumn("risk_rank", F.row_number().over(w))


def worst_routes(routes: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` routes with the highest average departure delay (RPT-2, TOP-2).

    Ties are broken by carrier and route so the cut is deterministic. Planned
    as a per-partition top-k plus a merge (TakeOrderedAndProject) — no sort
    of the whole table.
    """
    return (routes.select("OP_CARRIER", "Origin", "Dest", "avg_dep_delay",
                          "total_flights", "delay_rate")
            .orderBy(F.col("avg_dep_delay").desc_nulls_last(), "OP_CARRIER", "Origin", "Dest")
            .limit(k))


def weather_category(flight_weather: DataFrame) -> DataFrame:
    """Delay by weather flight category (RPT-3); null = no observation."""
    return (flight_weather.groupBy("flight_category")
            .agg(fx.rows().alias("total_flights"),
                 F.avg("DEP_DELAY").alias("avg_dep_delay"),
                 fx.rate("is_delayed").alias("delay_rate")))


def carrier_ranking(carriers: DataFrame) -> DataFrame:
    """Carriers ranked by average departure delay, best first (RPT-4, TOP-1).

    ``is_best`` marks the single rank-1 carrier; the window runs over the
    per-carrier gold rows only.
    """
    w = Window.orderBy(F.col("avg_dep_delay").asc_nulls_last(), F.col("OP_CARRIER"))
    return (carriers.select("OP_CARRIER", "avg_dep_delay", "avg_arr_delay", "total_flights",
                            "delay_rate", "total_cancelled")
            .withColumn("delay_rank", F.row_number().over(w))
            .withColumn("is_best", F.col("delay_rank") == 1))


def cause_share(flights: DataFrame, include_security: bool = False) -> DataFrame:
    """Share of attributed delay minutes per cause (RPT-5), long form.

    The denominator is the sum of the listed causes over all flights (the
    four gold causes by default; security delay optional). One global
    aggregate (partial sums per task), then the single row is unpivoted.
    """
    causes = ALL_CAUSES if include_security else GOLD_CAUSES
    sums = flights.agg(*[F.sum(c).alias(c) for c in causes])
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in causes[1:]),
                F.coalesce(F.col(causes[0]), F.lit(0.0)))
    long = (sums.withColumn("_total", total)
            .unpivot(["_total"], causes, "cause_column", "delay_minutes"))
    name = F.lower(F.regexp_replace(F.col("cause_column"), "_DELAY$", ""))
    return long.select(name.alias("cause"), "delay_minutes",
                       F.when(F.col("_total") > 0,
                              F.col("delay_minutes") / F.col("_total")).alias("share"))


def live_monitor(live_routes: DataFrame) -> DataFrame:
    """Current route monitor over the live summary (RPT-6): delayed share per route."""
    return live_routes.select(
        "carrier", "origin", "dest", "total_flights", "delayed_flights",
        (F.col("delayed_flights") / F.col("total_flights")).alias("delayed_share"),
        "avg_dep_delay", "avg_arr_delay", "aircraft_type")

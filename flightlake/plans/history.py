"""The audits of all nightly runs, and counts that differ from a table's usual ones.

``record`` appends a run's audit (one row per table and reject count) to
``<lake>/_audit``. ``judged`` compares each table's last good count with the
median of the runs before, in units of their median absolute deviation. A count
that is far off is marked; nothing is stopped, since a night may well be unusual.

A table's history has one row per run, so windows over it stay small.

Defined cases: failed runs are kept in the history but are no counts to compare
with; a table with fewer than ``MIN_RUNS`` earlier counts is never marked; of two
runs of one time the larger count is the later; no history gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .jobs import AUDIT_SCHEMA, Lake

HISTORY_SCHEMA = T.StructType([T.StructField("run_at", T.TimestampType()), *AUDIT_SCHEMA.fields])
RUNS = 14         # earlier runs that make up what is usual
MIN_RUNS = 3
WIDTH = 4.0       # median absolute deviations
TOLERANCE = 0.1   # of the median, whatever the deviation


def path_of(lake: Lake) -> str:
    return f"{lake.root}/_audit"


def record(lake: Lake, audit: DataFrame) -> None:
    """Append a run's audit with the time of this call, as one file."""
    audit.select(F.current_timestamp().alias("run_at"), *AUDIT_SCHEMA.fieldNames()).coalesce(1).write.mode("append").parquet(path_of(lake))


def read(spark: SparkSession, lake: Lake) -> DataFrame:
    return spark.read.schema(HISTORY_SCHEMA).parquet(path_of(lake))


def judged(history: DataFrame, runs: int = RUNS, width: float = WIDTH, tolerance: float = TOLERANCE) -> DataFrame:
    """Per table: its last good count, how many earlier ones (at most ``runs``) it is
    compared with, their median ``usual`` and deviation ``spread``, and ``unusual``."""
    table = ["layer", "table_name"]
    latest = Window.partitionBy(*table).orderBy(F.col("run_at").desc(), F.col("rows_written").desc())
    counts = (history.where("status = 'ok' AND rows_written IS NOT NULL")
              .withColumn("age", F.row_number().over(latest) - 1).where(F.col("age") <= runs))
    past = F.when(F.col("age") > 0, F.col("rows_written"))
    usual = F.percentile(past, F.lit(0.5)).over(Window.partitionBy(*table))
    off = counts.withColumn("usual", usual).withColumn("off", F.abs(past - F.col("usual")))
    out = off.groupBy(*table).agg(
        F.max(F.when(F.col("age") == 0, F.col("rows_written"))).alias("rows_written"),
        F.count("off").alias("n_past"), F.max("usual").alias("usual"), F.percentile("off", F.lit(0.5)).alias("spread"))
    far = F.abs(F.col("rows_written") - F.col("usual")) > F.greatest(width * F.col("spread"), tolerance * F.col("usual"))
    return out.withColumn("unusual", F.coalesce((F.col("n_past") >= MIN_RUNS) & far, F.lit(False)))

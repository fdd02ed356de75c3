"""Incremental gold (JOB-2): mergeable partials, refreshed for changed months only.

The delay tables are sums and counts, so they add up from partials kept per month:
one row per (month, carrier, origin, dest) and one per (month, origin, hour). Each
night every month of silver is digested (one narrow aggregate); months whose digest
is the stored one keep their partials, only the others are read and aggregated
again, and months that are gone are left out. Partials, digests and the rolled-up
routes are published together by one commit, so a run that dies between two of
them leaves the old set.

The table at ``path`` holds per version: ``digests``, ``routes_by_month``,
``hours_by_month`` and ``routes``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from ..schemas import ONTIME_SILVER
from ..sources.sinks import PART, digests, observed_write
from ..sources.versions import current, publish, published

DIGEST = ["n_rows", "hash_sum", "hash_xor"]


@dataclass
class Refresh:
    months: list[str]  # read again
    rows_read: int  # silver rows of those months
    routes: int  # rows of the rolled-up route partials


def changed_months(new: DataFrame, old: DataFrame | None) -> tuple[list[str], list[str]]:
    """(changed or new, unchanged) months by their digests. Months are names of
    folders, some per year of data, so the driver may hold them."""
    if old is None:
        return sorted(r[PART] for r in new.select(PART).collect()), []
    o = old.select(F.col(PART).alias("_month"), *[F.col(c).alias(f"_{c}") for c in DIGEST])
    same = F.coalesce(F.expr(" AND ".join(f"{c} = _{c}" for c in DIGEST)), F.lit(False))
    rows = new.join(o, new[PART] == o["_month"], "left").select(PART, same.alias("same")).collect()
    return sorted(r[PART] for r in rows if not r.same), sorted(r[PART] for r in rows if r.same)


def refresh_partials(spark: SparkSession, silver: DataFrame, path: str) -> Refresh:
    """Bring the partials at ``path`` up to date with ``silver`` (the on-time table
    with its partition column)."""
    before = current(spark, path) if published(spark, path) else None
    columns = ONTIME_SILVER.fieldNames()

    def write(folder: str) -> Refresh:
        digests(silver, [PART], columns).write.parquet(f"{folder}/digests")
        now = spark.read.parquet(f"{folder}/digests")
        stale, fresh = changed_months(now, spark.read.parquet(f"{before}/digests") if before else None)
        seen = Observation("silver_rows_read")
        part = silver.where(F.col(PART).isin(stale))  # prunes the folders of the scan
        counted = part.observe(seen, F.count(F.lit(1)).alias("n")) if stale else part
        for name, new in (("routes_by_month", op.monthly_route_partials(counted, PART)), ("hours_by_month", op.monthly_hour_partials(part, PART))):
            if before:
                kept = spark.read.parquet(f"{before}/{name}").where(F.col(PART).isin(fresh))
                new = new.unionByName(kept) if stale else kept
            new.write.parquet(f"{folder}/{name}")
        routes = op.routes_from(spark.read.parquet(f"{folder}/routes_by_month"))
        n = observed_write(routes, "route_partials", lambda d: d.write.parquet(f"{folder}/routes"))
        return Refresh(stale, int(seen.get.get("n") or 0) if stale else 0, n)

    return publish(spark, path, write)


def read_partials(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{current(spark, path)}/{name}")

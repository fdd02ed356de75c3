"""Physical layout of the on-time table: clustered files whose row groups prune."""

import glob
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from flightlake import operators as op
from flightlake.plans import jobs
from flightlake.session import local_path, scratch_path
from flightlake.sources import surrogate
from flightlake.sources.sinks import PART, replace_table, with_part
from flightlake.sources.tables import Tables
from flightlake.sources.versions import current


@pytest.fixture(scope="module")
def flights(spark, sf_small):
    return op.ontime_silver(surrogate.ontime_raw(Tables(spark, sf_small)))


def row_groups(folder, column):
    """(file, smallest, largest) of the column for each row group."""
    out = []
    for f in sorted(glob.glob(f"{local_path(folder)}/**/*.parquet", recursive=True)):
        meta = pq.ParquetFile(f).metadata
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        out += [(f, s.min, s.max) for s in (meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups))]
    return out


def test_one_airport_reads_few_row_groups(spark, flights):  # SRC-4, SNK-3
    lake = jobs.Lake(scratch_path(spark, "layout"))
    # By year here: a month of the small table has fewer rows than a row group holds at least.
    year = with_part(flights.withColumn("_m", F.substring("FL_DATE", 1, 4)), "_m").drop("_m")
    path = lake.silver("bts_flights")
    n = replace_table(year, path, [PART], cluster_by=jobs.ROUTE, row_group_bytes=4096)
    assert n == flights.count()
    groups = row_groups(current(spark, path), "Origin")
    origin = flights.agg(F.min("Origin")).first()[0]
    hit = [g for g in groups if g[1] <= origin <= g[2]]
    assert 0 < len(hit) < len(groups) / 3
    for (f, _, high), (g, low, _) in zip(groups, groups[1:]):  # ranges of a file ascend
        assert f != g or high <= low
    got = jobs.route_flights(spark, lake, origin)
    assert Counter(got.collect()) == Counter(flights.where(F.col("Origin") == origin).collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert f"EqualTo(Origin,{origin})" in plan
    dest = got.agg(F.max("Dest")).first()[0]
    assert jobs.route_flights(spark, lake, origin, dest).count() == flights.where((F.col("Origin") == origin) & (F.col("Dest") == dest)).count()


def test_clustered_write_of_nulls_and_nothing(spark):
    """Null values and an empty table are written as they are; no partition column is needed."""
    rows = [("ORD", None), (None, "JFK"), (None, None), ("ORD", "JFK"), ("ORD", "JFK")]
    for data in (rows, []):
        df = spark.createDataFrame(data, "Origin string, Dest string")
        path = scratch_path(spark, "layout-small")
        assert replace_table(df, path, cluster_by=jobs.ROUTE) == len(data)
        assert Counter(map(tuple, spark.read.schema(df.schema).parquet(current(spark, path)).collect())) == Counter(data)

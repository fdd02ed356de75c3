"""Steps that every nightly query shares: how they read, spread and write at size."""

import glob

import pytest
from pyspark.sql import functions as F

from flightlake import operators as op
from flightlake.session import local_path, scratch_path
from flightlake.sources import bronze, surrogate
from flightlake.sources.tables import Tables


def executed_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def equal(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_landed_files_are_compressed_and_bounded(spark, sf_small, monkeypatch):  # F2
    monkeypatch.setattr(bronze, "FEED_FILE_RECORDS", 7)
    records = surrogate.weather_records(Tables(spark, sf_small))
    root = scratch_path(spark, "landed")
    back = bronze.land_snapshot(records, root, "weather")
    files = glob.glob(f"{local_path(root)}/*/part-*")
    assert files and all(f.endswith(".json.snappy") for f in files)
    per_file = back.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert per_file == 7
    want = bronze.wrap_envelope(records, "weather")
    assert equal(back.select(*want.columns), want)


def test_landed_csv_is_compressed_and_bounded(spark, sf_small, monkeypatch):  # F2
    monkeypatch.setattr(bronze, "CSV_FILE_RECORDS", 500)
    raw = surrogate.ontime_raw(Tables(spark, sf_small))
    path = scratch_path(spark, "landed-csv")
    bronze.write_ontime_csv(raw, path, bronze.COMPRESSION)
    assert not glob.glob(f"{local_path(path)}/*.csv")
    headers = bronze.csv_headers(spark, f"{path}/*.csv*")
    assert headers.agg(F.max("n_rows")).first()[0] == 500
    assert equal(bronze.read_ontime_csv(spark, f"{path}/*.csv*").select(*raw.columns), raw)


@pytest.mark.parametrize("descending", [False, True])
def test_dedupe_by_hash_keeps_the_same_rows(spark, descending):  # F3
    rows = [(k, a, b) for k in ("x", None, "y", "") for a in (1.0, None, -0.5) for b in ("p", None, "")]
    df = spark.createDataFrame(rows * 2, "k string, a double, b string").repartition(5)
    got = op.dedupe(df, ["k"], ["a"], descending, hashed=True)
    assert got.columns == df.columns and equal(got, op.dedupe(df, ["k"], ["a"], descending))
    assert got.count() == 4


def test_ontime_rows_are_sorted_by_a_hash_of_the_key(spark, sf_small):  # F3
    plan = executed_plan(op.ontime_silver(surrogate.ontime_raw(Tables(spark, sf_small))))
    assert "partial_max" in plan and "hash(FL_DATE" in plan


def test_headers_are_found_without_sorting_all_lines(spark, sf_small):  # F5
    path = scratch_path(spark, "headers-plan")
    bronze.write_ontime_csv(surrogate.ontime_raw(Tables(spark, sf_small)), path)
    headers = bronze.csv_headers(spark, f"{path}/*.csv").select("file", "names")
    plan = executed_plan(headers)
    assert "ObjectHashAggregate" in plan and "SortAggregate" not in plan


@pytest.mark.parametrize("feed", ["live_records", "weather_records"])
def test_landed_records_are_dealt_out_by_day(spark, sf_small, feed):  # F4
    t = Tables(spark, sf_small)
    build = getattr(surrogate, feed)
    dealt = build(t, by_day=True)
    assert "REBALANCE_PARTITIONS_BY_COL" in executed_plan(dealt)
    assert equal(dealt, build(t))

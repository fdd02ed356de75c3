"""Text parsing under ANSI mode: bad text becomes null, never an error."""

from pyspark.sql import functions as F

from flightlake import functions as fx


def one_col(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def collect(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_ansi_is_on(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_minutes_bad_text_is_null(spark):  # T2
    df = one_col(spark, ["15", "15.01", "-3", "", "abc", "n/a", None, "-3.00"])
    assert collect(df, fx.minutes("v")) == [15.0, 15.01, -3.0, None, None, None, None, -3.0]


def test_is_delayed_strictly_above_15(spark):
    df = one_col(spark, ["15", "15.01", "-3", None])
    assert collect(df, fx.is_delayed(fx.minutes("v"))) == [False, True, False, None]


def test_flag_numeric_and_boolean_text(spark):  # T3
    df = one_col(spark, ["0.00", "1.00", "0", "1", "", "true", "false", "x", None])
    assert collect(df, fx.flag("v")) == [False, True, False, True, None, True, False, None, None]


def test_hhmm_hour(spark):  # T6
    df = one_col(spark, ["5", "830", "0830", "2400", "", "12345", None, "1530"])
    assert collect(df, fx.hhmm_hour("v")) == [0, 8, 8, 24, 0, 12, None, 15]


def test_month_of_rejects_unpadded(spark):  # T7
    df = one_col(spark, ["2025-02-01", "2026-02-01", "2/1/2025", "", None])
    assert collect(df, fx.month_of("v")) == [2, 2, None, None, None]


def test_visibility_plus_suffix(spark):  # T12
    df = one_col(spark, ["3", "10+", "", None, "1.5", "abc"])
    assert collect(df, fx.visibility("v")) == [3.0, 10.0, None, None, 1.5, None]


def test_station_code_null_stays_null(spark):  # SC-9
    df = one_col(spark, ["ORD", None])
    assert collect(df, fx.station_code("v")) == ["KORD", None]


def test_obs_timestamp_epoch_and_text(spark):
    df = one_col(spark, ["1706745600", "2024-02-01 00:00:00", "junk"])
    got = collect(df, F.date_format(fx.obs_timestamp("v"), "yyyy-MM-dd HH:mm"))
    assert got == ["2024-02-01 00:00", "2024-02-01 00:00", None]

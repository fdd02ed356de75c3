"""Property tests against brute force on small generated inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flightlake import functions as fx
from flightlake import operators as op
from flightlake.plans import reports

SETTINGS = settings(max_examples=25, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

small_text = st.one_of(st.none(), st.sampled_from(["a", "b", "c", ""]))
small_num = st.one_of(st.none(), st.integers(-3, 3).map(float))
rows = st.lists(st.tuples(st.sampled_from(["k1", "k2", None]), st.sampled_from(["x", "y"]),
                          small_text, small_num), min_size=0, max_size=30)


def _sort_key(v):
    # Spark's ascending order puts nulls first
    return (v is not None, v if v is not None else 0)


@SETTINGS
@given(data=rows, parts=st.integers(1, 4))
def test_dedupe_matches_brute_force(spark, data, parts):
    df = spark.createDataFrame(data, "k string, j string, s string, d double").repartition(parts)
    got = {(r.k, r.j): (r.s, r.d) for r in op.dedupe(df, ["k", "j"]).collect()}
    want: dict = {}
    for k, j, s, d in data:
        cur = want.get((k, j))
        cand = (s, d)
        if cur is None or tuple(map(_sort_key, cand)) < tuple(map(_sort_key, cur)):
            want[(k, j)] = cand
    assert got == want


def _hour(text):
    if text is None:
        return None
    padded = text.rjust(4, "0")[:4] if len(text) < 4 else text[:4]
    head = padded[:2]
    return int(head) if head.isdigit() else None


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), st.text(alphabet="0123456789", max_size=6),
                                 st.sampled_from(["ab", "9x", " 5"])), max_size=20))
def test_hhmm_hour_matches_brute_force(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(fx.hhmm_hour("v")).collect()]
    assert got == [_hour(v) for v in values]


@SETTINGS
@given(data=st.lists(st.tuples(st.sampled_from(["AA", "UA"]), st.sampled_from(["ORD", "JFK"]),
                               small_num, st.one_of(st.none(), st.booleans())), max_size=40))
def test_route_aggregate_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "OP_CARRIER string, Origin string, DEP_DELAY double, "
                                     "is_delayed boolean").withColumn("Dest", F.lit("X"))
    for c in ["CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "LATE_AIRCRAFT_DELAY"]:
        df = df.withColumn(c, F.lit(None).cast("double"))
    got = {(r.OP_CARRIER, r.Origin): (r.total_flights, r.delay_rate, r.avg_dep_delay)
           for r in op.route_delay_summary(df, min_flights=2).collect()}
    groups: dict = {}
    for c, o, d, flag in data:
        groups.setdefault((c, o), []).append((d, flag))
    want = {}
    for key, g in groups.items():
        if len(g) < 2:
            continue
        flags = [f for _, f in g if f is not None]
        delays = [d for d, _ in g if d is not None]
        rate = (sum(flags) / len(g)) if flags else None
        avg = (sum(delays) / len(delays)) if delays else None
        want[key] = (len(g), rate, avg)
    assert got == want


def test_cause_share_with_security(spark):
    from flightlake.schemas import ONTIME_SILVER
    row = {c: None for c in ONTIME_SILVER.fieldNames()}
    row.update(CARRIER_DELAY=10.0, WEATHER_DELAY=10.0, NAS_DELAY=10.0, SECURITY_DELAY=10.0,
               LATE_AIRCRAFT_DELAY=10.0)
    df = spark.createDataFrame([tuple(row[c] for c in ONTIME_SILVER.fieldNames())], ONTIME_SILVER)
    out = {r.cause: r.share for r in reports.cause_share(df, include_security=True).collect()}
    assert out == {"carrier": 0.2, "weather": 0.2, "nas": 0.2, "security": 0.2,
                   "late_aircraft": 0.2}


top_rows = st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "d2", None]),
                              small_text, small_num), min_size=0, max_size=40)


@SETTINGS
@given(data=top_rows, n=st.integers(1, 4), parts=st.integers(1, 4), buckets=st.integers(1, 5))
def test_first_n_per_group_matches_brute_force(spark, data, n, parts, buckets):
    """Per group, exactly the n smallest rows (order column, then the rest,
    nulls first), whatever the partitioning and the number of salt buckets."""
    df = spark.createDataFrame(data, "g string, s string, d double").repartition(parts)
    got = sorted(((r.g, r.s, r.d) for r in op.first_n_per_group(df, ["g"], n, ["d"], buckets)
                  .collect()), key=lambda t: tuple(map(_sort_key, t)))
    groups: dict = {}
    for g, s, d in data:
        groups.setdefault(g, []).append((g, s, d))
    want = []
    for rows_ in groups.values():
        rows_.sort(key=lambda t: (_sort_key(t[2]), _sort_key(t[1])))
        want += rows_[:n]
    want.sort(key=lambda t: tuple(map(_sort_key, t)))
    assert got == want


merge_rows = st.lists(st.tuples(st.sampled_from(["d1", "", None]), st.sampled_from(["a", "b"]),
                                small_text), min_size=1, max_size=12)


@settings(max_examples=6, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=merge_rows, cuts=st.lists(st.integers(0, 12), max_size=2))
def test_merge_in_any_batching_equals_one_dedupe(spark, data, cuts):
    """Rows merged batch by batch (any split, replays included) end equal to
    one dedupe over all of them."""
    from flightlake.session import scratch_path
    from flightlake.sources.sinks import merge_days, read_parted
    schema = "day string, k string, v string"
    bounds = sorted({0, len(data), *[min(c, len(data)) for c in cuts]})
    path = scratch_path(spark, "merge-prop")
    batches = [data[a:b] for a, b in zip(bounds, bounds[1:])] + [data[:1]]  # last: a replay
    for part in batches:
        batch = op.dedupe(spark.createDataFrame(part, schema), ["day", "k"], descending=True)
        merge_days(batch, path, ["day", "k"], ["day"], name="prop")
    got = read_parted(spark, path, batch.schema).select("day", "k", "v").collect()
    want = op.dedupe(spark.createDataFrame(data, schema), ["day", "k"], descending=True).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)

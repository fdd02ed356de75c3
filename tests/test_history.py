"""The history of audits: appended per run, far-off counts marked."""

import datetime as dt
import random
from statistics import median

from flightlake.plans import history, jobs
from flightlake.session import scratch_path


def row(day, table, n, status="ok"):
    return (dt.datetime(2024, 1, 1) + dt.timedelta(days=day), "gold", table, status, n, None)


def test_far_counts_are_marked_like_brute_force(spark):
    rng = random.Random(5)
    rows = [row(d, f"t{t}", rng.choice([90, 100, 100, 103, 110, 300, 0])) for t in range(20) for d in range(rng.randint(1, 25))]
    rows += [row(d, "steady", 100) for d in range(5)] + [row(5, "steady", 111), row(6, "steady", None, "failed")]
    rows += [row(d, "new", 10 ** d) for d in range(3)] + [row(0, "broken", None, "failed")]
    got = {r.table_name: r for r in history.judged(spark.createDataFrame(rows, history.HISTORY_SCHEMA)).collect()}
    assert set(got) == {r[2] for r in rows} - {"broken"}
    for name, r in got.items():
        counts = [x[4] for x in sorted(rows) if x[2] == name and x[3] == "ok"]
        last, past = counts[-1], counts[:-1][-history.RUNS:]
        assert (r.rows_written, r.n_past) == (last, len(past))
        if past:
            usual = median(past)
            spread = median(abs(x - usual) for x in past)
            assert (r.usual, r.spread) == (usual, spread)
            assert r.unusual == (len(past) >= 3 and abs(last - usual) > max(4 * spread, usual / 10))
    assert got["steady"].unusual and not got["new"].unusual


def test_runs_are_appended(spark):
    lake = jobs.Lake(scratch_path(spark, "history-lake"))
    audit = [("gold", "a", "ok", 7, None), ("gold", "b", "failed", None, "E: x")]
    for _ in range(2):
        history.record(lake, jobs.audit_frame(spark, audit))
    stored = history.read(spark, lake)
    assert stored.count() == 4 and stored.select("run_at").distinct().count() == 2
    assert [(r.table_name, r.rows_written, r.n_past, r.unusual) for r in history.judged(stored).collect()] == [("a", 7, 1, False)]
    assert history.judged(stored.where("false")).count() == 0

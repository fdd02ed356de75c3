"""The command line runs the nightly job and reports against a landed lake."""

from flightlake.__main__ import main
from flightlake.plans import jobs
from flightlake.queries import _land_lake
from flightlake.session import scratch_path


def test_cli_nightly_stream_report(spark, sf_small, capsys):
    lake = jobs.Lake(scratch_path(spark, "cli-lake"))
    _land_lake(spark, sf_small, lake)
    assert main(["nightly", "--lake", lake.root, "--all-stations"]) == 0
    assert main(["stream", "--lake", lake.root, "--feed", "flights"]) == 0
    assert main(["report", "--lake", lake.root, "worst_routes", "--k", "3"]) == 0
    assert main(["report", "--lake", lake.root, "best_carrier"]) == 0
    out = capsys.readouterr().out
    assert "route_delay_summary" in out and "'rows': 0" in out and "OP_CARRIER" in out


def test_cli_land_and_full_report(spark, sf_small, tmp_path, capsys):
    from flightlake.sources import bronze, surrogate
    from flightlake.sources.tables import Tables
    lake = jobs.Lake(scratch_path(spark, "cli-land"))
    records = surrogate.weather_records(Tables(spark, sf_small)).select("record.*")
    records.write.json(f"{lake.root}/payload")
    assert main(["land", "--lake", lake.root, "--feed", "weather", "--payload", f"{lake.root}/payload/*.json"]) == 0
    landed = bronze.read_envelopes(spark, lake.bronze("weather"), "weather")
    assert landed.count() == records.count() and landed.select("_ingested_at").distinct().count() == 1
    _land_lake(spark, sf_small, lake)
    main(["nightly", "--lake", lake.root, "--all-stations"])
    capsys.readouterr()
    assert main(["report", "--lake", lake.root, "worst_routes", "--k", "50"]) == 0
    table = [x for x in capsys.readouterr().out.splitlines() if x.startswith("|")]
    gold = jobs.read_gold(spark, lake, "route_delay_summary").count()
    assert len(table) == 1 + min(50, gold)
    assert main(["report", "--lake", lake.root, "live_monitor", "--out", f"{lake.root}/live"]) == 0
    assert spark.read.option("header", True).csv(f"{lake.root}/live").count() == \
        jobs.read_gold(spark, lake, "aviationstack_summary").count()

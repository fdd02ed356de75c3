"""Incremental bronze → silver for the JSON feeds (STR-1).

The source job re-reads every snapshot each night and appends all of it, so
day k ends up stored once per later run (T4). Here a file stream over the
landing folder processes each new file exactly once (the checkpoint records
which files were taken), and every micro-batch is merged through
:func:`sources.sinks.merge_days`: the days the batch touches are deduplicated
again together with their stored rows and rewritten, keeping per key the
row ingested last (:func:`operators.dedupe`). A replayed batch or a
re-landed day changes nothing, and the table ends equal to one batch run over
all files however they were split into micro-batches (a later report of a
flight replaces the stored one). ``mode="append"`` keeps the first
stored row instead (:func:`sources.sinks.append_new`), which writes only new
keys.

``trigger(availableNow=True)`` turns the stream into a bounded catch-up run:
it processes the backlog in batches and stops, which is what a nightly
schedule wants; with ``max_files_per_trigger`` the backlog is split into
bounded batches.

With ``seen_for`` the stream remembers the lines it has taken: a line that is
landed again unchanged (a re-polled record, a day landed anew into other files)
is dropped before the sink, so that a re-landed day costs its parsing and no
merge (:func:`first_seen`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import operators as op
from ..schemas import LIVE_KEY, WEATHER_KEY
from ..sources.bronze import FEEDS, REJECT
from ..session import exists, remove, scratch_path
from ..sources.sinks import append_new, merge_days, observed_write, replace_table
from ..sources.versions import published, read_table

_FEEDS = {
    # feed: (silver builder, key, partition columns)
    "flights": (lambda env, stations: op.live_silver(env), LIVE_KEY, ["flight_date"]),
    "weather": (lambda env, stations: op.with_obs_date(op.weather_silver(env, stations)),
                WEATHER_KEY + [op.WEATHER_PARTITION], [op.WEATHER_PARTITION]),
}


class StationsChanged(ValueError):
    """The allow-list is not the one under which the feed's files were read."""


def check_stations(spark: SparkSession, stations: DataFrame | None, checkpoint: str, replay: bool) -> None:
    """Compare the allow-list (FLT-6) with the one kept beside the checkpoint, so that
    what the table holds never depends on which job ran first. With ``replay`` a
    changed list starts the feed anew: every landed file is read again and merged,
    which gives a new station its history (and takes no row of an old one away)."""
    path = f"{checkpoint}-stations"
    want = (spark.createDataFrame([("*",)], "airport_icao string") if stations is None
            else stations.select(F.col("airport_icao").cast("string")).where("airport_icao IS NOT NULL").distinct())
    if published(spark, path):
        have = read_table(spark, path)
        if want.exceptAll(have).isEmpty() and have.exceptAll(want).isEmpty():
            return
        if not replay:
            raise StationsChanged("the list of stations is not that of the earlier runs; run again with replay")
        remove(spark, checkpoint)
    replace_table(want, path, name="stations")


def first_seen(lines: DataFrame, expiry: str) -> DataFrame:
    """The lines of a stream that did not come within ``expiry`` (e.g. ``"7 days"``)
    before, each once.

    The state is keyed by the SHA-256 of the whole line, ingestion time included,
    so it holds 32 bytes a line and only repeats in every field are dropped, which
    neither sink would store. It expires by the time of the batch that took the
    line, not by a time in the data: no line is ever too late, however old the
    day it belongs to, and a repeat that comes after the expiry goes on to the
    sink, which stores nothing for it either.
    """
    content = F.to_json(F.struct(*lines.columns), {"ignoreNullFields": "false"})
    keyed = (lines.withColumn("_line", F.unhex(F.sha2(content, 256)))
             .withColumn("_taken_at", F.current_timestamp()))
    return (keyed.withWatermark("_taken_at", expiry)
            .dropDuplicatesWithinWatermark(["_line"]).select(*lines.columns))


def check_seen_for(spark: SparkSession, seen_for: str | None, checkpoint: str) -> None:
    """A checkpoint is made with the state of seen lines or without it, and stays so
    (the expiry itself may change): Spark cannot add the state to a running stream."""
    path = f"{checkpoint}-seen"
    if published(spark, path):
        kept = read_table(spark, path).where("kept").count() > 0
    elif exists(spark, f"{checkpoint}/metadata"):
        kept = False
    else:
        replace_table(spark.range(1).select(F.lit(seen_for is not None).alias("kept")), path, name="seen")
        return
    if kept != (seen_for is not None):
        raise ValueError("the feed's checkpoint was made " + ("with" if kept else "without") + " seen_for")


def ingest_stream(spark: SparkSession, bronze_root: str, silver_path: str, feed: str,
                  checkpoint: str, stations: DataFrame | None = None,
                  max_files_per_trigger: int | None = None, mode: str = "merge",
                  rejects_path: str | None = None, replay: bool = False,
                  seen_for: str | None = None) -> dict:
    """Catch up on all new snapshot files of ``feed``; return progress totals.

    ``bronze_root`` holds ``ingest_date=…`` folders (see
    :func:`sources.bronze.land_snapshot`). The returned dict has the number of
    micro-batches, of keys added to ``silver_path``, and of lines that are no
    JSON of the feed; these are appended to ``rejects_path`` if it is given. A
    list of stations other than that of earlier runs is refused, or, with
    ``replay``, read for all files landed so far (:func:`check_stations`).
    ``seen_for`` drops lines that came before (:func:`first_seen`); a batch of
    nothing else does not reach the sink and is not counted. A checkpoint
    keeps its choice (:func:`check_seen_for`).
    """
    if mode not in ("merge", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    build, keys, partition_by = _FEEDS[feed]
    if feed == "weather":
        check_stations(spark, stations, checkpoint, replay)
    check_seen_for(spark, seen_for, checkpoint)
    schema = T.StructType([*FEEDS[feed].fields, T.StructField(REJECT, T.StringType())])
    reader = spark.readStream.schema(schema).option("columnNameOfCorruptRecord", REJECT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    stream = reader.json(bronze_root)
    if seen_for:
        stream = first_seen(stream, seen_for)
    appended = {"batches": 0, "rows": 0, "rejects": 0}

    def merge(batch: DataFrame, batch_id: int) -> None:
        seen = Observation(f"{feed}_rejects_{batch_id}")
        env = batch.select(*schema.fieldNames()).observe(seen, F.count(REJECT).alias("n"))
        into = dict(partition_by=partition_by, name=f"{feed}_batch_{batch_id}")
        silver = build(env, stations)
        rows = (merge_days(silver, silver_path, keys, order_by=op.NEWEST_FIRST, **into) if mode == "merge"
                else append_new(silver, silver_path, keys, **into))
        rejected = int(seen.get.get("n") or 0)
        if rejected and rejects_path:
            lines = batch.where(F.col(REJECT).isNotNull()).select("_ingested_at", REJECT)
            lines.write.mode("append").option("compression", "snappy").parquet(rejects_path)
        appended["rejects"] += rejected
        appended["batches"] += 1
        appended["rows"] += rows

    def merge_unseen(batch: DataFrame, batch_id: int) -> None:
        # The state is read and written once: by this write, which also counts.
        path = scratch_path(spark, f"{feed}-unseen")
        n = observed_write(batch, f"{feed}_unseen_{batch_id}", lambda d: d.write.parquet(path))
        if n:
            merge(spark.read.schema(schema).parquet(path), batch_id)
        remove(spark, path)

    q = (stream.writeStream
         .foreachBatch(merge_unseen if seen_for else merge)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return appended

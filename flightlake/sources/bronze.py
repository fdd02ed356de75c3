"""Bronze layer: JSON envelopes and the on-time CSV.

Landing (SNK-11) wraps each API record in the feed's envelope — the payload
plus the ingestion time — and writes JSON lines partitioned by ingestion day.
A re-run replaces that day only (dynamic partition overwrite). One record per
envelope line and a bounded number of lines per file: no day is ever gathered
into a single document or a single task.

Reading (SRC-1/2/3/7) always uses an explicit schema; the date folders are
matched by a glob, and the snapshot day is recovered from the file path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import FLIGHT_ENVELOPE, ONTIME_COLUMNS, WEATHER_ENVELOPE

REJECT = "_corrupt_record"
# Landed files are compressed. Such a file is one task to its readers, so no file
# holds more records than these.
COMPRESSION = "snappy"
FEED_FILE_RECORDS = 50_000
CSV_FILE_RECORDS = 100_000
FEEDS = {
    "flights": FLIGHT_ENVELOPE,
    "weather": WEATHER_ENVELOPE,
}

# Matches both "…/2025/02/01/…" (one document per day) and the
# "…/ingest_date=2025-02-01/…" folders written by ``land_snapshot``.
_DAY_IN_PATH = r"(\d{4})[/-](\d{2})[/-](\d{2})"


def wrap_envelope(records: DataFrame, feed: str) -> DataFrame:
    """(record, _ingested_at) rows → envelope rows of the feed's schema."""
    rec = F.array(F.col("record"))
    if feed == "flights":
        body = F.struct(rec.alias("data")).alias("flights")
    elif feed == "weather":
        body = rec.alias("records")
    else:
        raise ValueError(f"unknown feed {feed!r}")
    return records.select(body, F.col("_ingested_at"))


def stamp_ingestion(payload: DataFrame) -> DataFrame:
    """API records (one struct column ``record``) → (record, _ingested_at) with
    the current UTC time as zone-less ISO text, as the pollers write it (SC-19).
    The time is fixed once per query, so every row of a run gets the same
    stamp and a re-run lands into the same day folder."""
    return payload.select(
        F.col("record"),
        F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()),
                      "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("_ingested_at"))


def snapshot_day(ingested_at: Column) -> Column:
    """UTC day of an ISO ingestion time as 'yyyy-MM-dd' (SC-19)."""
    return F.substring(ingested_at, 1, 10)


def land_snapshot(records: DataFrame, root: str, feed: str) -> DataFrame:
    """Write the feed's envelopes under ``root/ingest_date=YYYY-MM-DD/`` (SNK-11).

    Files are compressed and hold ``FEED_FILE_RECORDS`` records at most. Returns the
    landed envelopes read back from ``root``.
    """
    env = wrap_envelope(records, feed).withColumn("ingest_date", snapshot_day(F.col("_ingested_at")))
    (env.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", COMPRESSION).option("maxRecordsPerFile", FEED_FILE_RECORDS)
        .partitionBy("ingest_date")
        .json(root))
    return read_envelopes(records.sparkSession, root, feed)


def read_envelopes(spark: SparkSession, root: str, feed: str,
                   glob: str = "*/*.json*", multi_line: bool = False,
                   rejects: bool = False) -> DataFrame:
    """Every snapshot below ``root`` (SRC-1/2, SRC-7).

    ``glob`` selects the date folders: ``*/*.json*`` for landed days,
    ``*/*/*/snapshot.json`` for a year/month/day layout. The snapshot day is
    recovered from the path as ``_snapshot_date``. ``multi_line`` reads
    pretty-printed documents (one file is then one task, so landed data
    stays one record per line, T15). ``rejects`` adds the text of lines that
    are no JSON of the feed as column ``_corrupt_record``.
    """
    schema = FEEDS[feed]
    fields = schema.fieldNames() + ([REJECT] if rejects else [])
    if rejects:
        schema = T.StructType([*schema.fields, T.StructField(REJECT, T.StringType())])
    df = (spark.read.schema(schema)
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECT)
          .option("multiLine", multi_line)
          .json(f"{root.rstrip('/')}/{glob}"))
    path = F.col("_metadata.file_path")
    day = F.concat_ws("-", *[F.regexp_extract(path, _DAY_IN_PATH, i) for i in (1, 2, 3)])
    return df.select(*fields, F.when(day != "--", day).alias("_snapshot_date"))


def rejects(spark: SparkSession, root: str, feed: str, glob: str = "*/*.json*") -> DataFrame:
    """The lines below ``root`` that are no JSON of the feed, with their day."""
    lines = read_envelopes(spark, root, feed, glob, rejects=True)
    return lines.where(F.col(REJECT).isNotNull()).select("_snapshot_date", "_ingested_at", REJECT)


def read_ontime_csv(spark: SparkSession, path: str) -> DataFrame:
    """All monthly CSV files under ``path`` (a glob), all text (SRC-3).

    Every file is read by its own header: files of equal headers are read
    together and the groups united by name, so a month with reordered, missing
    or new columns lines up with the others. Unknown extra columns are kept as
    text so :func:`drift_report` can show them; a column that a file lacks reads
    as null there. The driver gets one row per distinct header.
    """
    headers = csv_headers(spark, path).groupBy("names").agg(F.sort_array(F.collect_list("file")).alias("files"))
    out = None
    for names, files in sorted(headers.select("names", "files").collect()):
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
        part = spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(files)
        part = part.select(*[F.col(f"`{c}`") for c in names],
                           *[F.lit(None).cast("string").alias(c) for c in ONTIME_COLUMNS if c not in names])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:  # files without any line
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in ONTIME_COLUMNS]))
    return out


def header_names(line: Column) -> Column:
    """The column names of a CSV header line, as Spark's reader names them: quotes
    taken off, a blank name ``_c`` and its place, a repeated name with its place."""
    fields = F.split(line, ',(?=(?:[^"]*"[^"]*")*[^"]*$)')
    bare = F.transform(fields, lambda f: F.regexp_replace(F.regexp_replace(f, '^"|"$', ""), '""', '"'))

    def safe(names: Column) -> Column:
        return F.transform(names, lambda n, i: F.when(n == "", F.concat(F.lit("_c"), i.cast("string")))
                           .when(F.size(F.filter(names, lambda o: F.lower(o) == F.lower(n))) > 1, F.concat(n, i.cast("string")))
                           .otherwise(n))
    return safe(bare)


def csv_headers(spark: SparkSession, path: str) -> DataFrame:
    """(file, names, n_rows) of the CSV files at ``path``, in one job whatever their
    number: a file's first line is the first one of its first block, its data rows
    are the other lines that are not blank. Files without a line are left out."""
    # Split into lines by the text source; a line's number orders it within a block.
    lines = spark.read.text(path).where("trim(value) <> ''").select(
        F.col("_metadata.file_path").alias("file"), "value",
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")).alias("at"))
    first = F.when(F.col("at.block") == 0, F.col("value"))
    # The set of a file's blocks is small; with it the aggregate is an object hash
    # aggregate, while one of texts alone would sort all lines by file.
    per = lines.groupBy("file").agg(F.min_by(first, F.when(F.col("at.block") == 0, F.col("at.line"))).alias("header"),
                                    (F.count(F.lit(1)) - 1).alias("n_rows"), F.collect_set("at.block").alias("blocks"))
    per = per.where(F.size("blocks") > 0)
    mark = F.regexp_replace("header", "^\ufeff", "")  # a byte order mark is no part of a name
    return per.select("file", header_names(mark).alias("names"), "n_rows")


def schema_drift(columns: list[str], expected: list[str] = ONTIME_COLUMNS) -> list[tuple]:
    """(column_name, status, position) of one header against the expected names."""
    rows = [(c, "ok" if c in expected else "unexpected", i + 1) for i, c in enumerate(columns)]
    return rows + [(c, "missing", None) for c in expected if c not in columns]


def header_drift(headers: DataFrame, expected: list[str] = ONTIME_COLUMNS) -> DataFrame:
    """(file, n_rows, column_name, status, position): each header of
    :func:`csv_headers` against the expected names (SRC-8): ``ok``, ``unexpected``
    or ``missing`` (position null)."""
    known = F.array(*[F.lit(c) for c in expected])
    found = headers.select("file", "n_rows", F.posexplode("names").alias("at", "column_name")).select(
        "file", "n_rows", "column_name", F.when(F.array_contains(known, F.col("column_name")), "ok").otherwise("unexpected").alias("status"),
        (F.col("at") + 1).alias("position"))
    lacking = headers.select("file", "n_rows", F.explode(F.array_except(known, "names")).alias("column_name")).select(
        "file", "n_rows", "column_name", F.lit("missing").alias("status"), F.lit(None).cast("int").alias("position"))
    return found.unionByName(lacking)


def drift_report(spark: SparkSession, path: str, expected: list[str] = ONTIME_COLUMNS) -> DataFrame:
    """The header drift of every file at ``path``, with the file's data rows: one
    scan and one aggregate, nothing passes through the driver."""
    file = F.regexp_replace("file", "^file:/+", "file:/")  # a local path as Spark may or may not write it
    return header_drift(csv_headers(spark, path), expected).withColumn("file", file)


def write_ontime_csv(raw: DataFrame, path: str, compression: str | None = None) -> None:
    """Write on-time rows as headed CSV files (the publisher's monthly files). With
    ``compression`` a file holds ``CSV_FILE_RECORDS`` rows at most."""
    w = raw.write.mode("overwrite").option("header", True)
    if compression:
        w = w.option("compression", compression).option("maxRecordsPerFile", CSV_FILE_RECORDS)
    w.csv(path)

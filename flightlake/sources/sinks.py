"""Silver/gold table sinks.

* ``replace_table`` — full overwrite (SNK-3..10): the new table is written
  beside the old one and published by one commit (:mod:`sources.versions`).
* ``append_new`` — idempotent append (SNK-1/2): only rows whose natural key
  is not yet in the table are written, so a re-run, a replayed micro-batch or
  an overlapping snapshot never duplicates a key.
* ``merge_days`` — deterministic merge for day-partitioned tables: the days a
  batch touches are re-deduplicated together with the stored rows, and the days
  that change are rewritten, so the table equals one dedupe over all input, in
  any batching.

Tables by day are partitioned by a column of their own, ``day_part``: the day's
text, or ``none`` for null and blank days. The day itself stays a data column,
so a null day and a blank one are stored and compared as they are.

Row counts come from an ``Observation`` collected during the write itself —
one execution, not a second ``count()`` pass (CNT-1).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import exists, remove, scratch_path
from .versions import publish

PART = "day_part"
NO_DAY = "none"
# Row groups of a clustered table: small enough that one holds few values of its leading column.
ROW_GROUP_BYTES = 16 << 20


def observed_write(df: DataFrame, name: str, write) -> int:
    """Run ``write(observed_df)`` and return the number of rows it wrote."""
    obs = Observation(name)
    write(df.observe(obs, F.count(F.lit(1)).alias("rows")))
    return int(obs.get.get("rows", 0))


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  name: str = "table", cluster_by: list[str] | None = None,
                  row_group_bytes: int = ROW_GROUP_BYTES) -> int:
    """Overwrite the table at ``path`` (Snappy Parquet); return rows written.
    Readers resolve it with :func:`sources.versions.read_table`. ``cluster_by``
    lays the files out by these columns (:func:`clustered`)."""
    if cluster_by:
        df = clustered(df, partition_by or [], cluster_by)

    def write(folder: str) -> int:
        def save(d: DataFrame) -> None:
            w = d.write.option("compression", "snappy")
            if cluster_by:
                w = w.option("parquet.block.size", row_group_bytes)
            (w.partitionBy(*partition_by) if partition_by else w).parquet(folder)
        return observed_write(df, name, save)
    return publish(df.sparkSession, path, write)


def clustered(df: DataFrame, partition_by: list[str], cluster_by: list[str]) -> DataFrame:
    """``df`` laid out for a write by ``partition_by`` of which later reads ask for some
    values of ``cluster_by[0]``.

    A rebalance brings the rows of one partition and value together, so a month is a
    few files, not one per shuffle task; AQE splits partitions that a hub makes too
    large and joins small ones. The rows of a task are then sorted, so the row
    groups of a file hold separate ranges, whose statistics the reader prunes by.
    """
    together = df.hint("rebalance", *[F.col(c) for c in [*partition_by, cluster_by[0]]])
    return together.sortWithinPartitions(*partition_by, *cluster_by)


def with_part(df: DataFrame, day: str) -> DataFrame:
    """Add the partition column of the day column ``day``."""
    return df.withColumn(PART, F.coalesce(F.when(F.trim(F.col(day)) != "", F.col(day)), F.lit(NO_DAY)))


def read_parted(spark, path: str, schema: T.StructType) -> DataFrame:
    """A table written with ``day_part``; days are never read as dates or numbers."""
    fields = [f for f in schema.fields if f.name != PART] + [T.StructField(PART, T.StringType())]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def null_safe_key_match(left: DataFrame, right: DataFrame, keys: list[str]):
    """Join condition equating ``keys`` with null-safe equality (T4b)."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def within_days(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of ``existing`` in the ``day_part`` folders present in ``batch``: a
    semi join on the partition column, whose scan Spark prunes at run time."""
    days = batch.select(F.col(PART).alias("_part")).distinct()
    return existing.join(days, existing[PART] == days["_part"], "left_semi")


def unseen(batch: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``existing`` (null-safe anti join)."""
    ex = existing.select(*keys)
    return batch.join(ex, null_safe_key_match(batch, ex, keys), "left_anti")


def row_hashes(columns: list[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row. Spark's hash passes over nulls, so which
    columns are null is hashed with the values."""
    row = [F.array(*[F.col(c).isNull() for c in columns]), *[F.col(c) for c in columns]]
    return F.xxhash64(*row), F.xxhash64(F.lit(1), *row)


def digests(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """An order-free digest of the rows of each group: ``n_rows``, the sum of one
    row hash and the xor of another. One narrow aggregate, reduced map-side; two
    multisets of rows with equal digests are taken to be equal."""
    a, b = row_hashes(columns)
    return df.select(*by, a.cast("decimal(20,0)").alias("_a"), b.alias("_b")).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("_a").alias("hash_sum"), F.bit_xor("_b").alias("hash_xor"))


def changed_parts(new: DataFrame, old: DataFrame, part: str, columns: list[str]) -> DataFrame:
    """The values of ``part`` whose rows differ between two tables: one aggregate in
    which equal digests cancel out, without a join of the rows."""
    def signed(df: DataFrame, sign: int) -> DataFrame:
        d = digests(df, [part], columns)
        return d.select(part, *[(F.col(c) * sign).alias(c) for c in ("n_rows", "hash_sum")], "hash_xor")
    both = signed(new, 1).unionByName(signed(old, -1)).groupBy(part).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("hash_sum").alias("hash_sum"), F.bit_xor("hash_xor").alias("hash_xor"))
    return both.where("n_rows <> 0 OR hash_sum <> 0 OR hash_xor <> 0").select(part)


def append_new(df: DataFrame, path: str, keys: list[str],
               partition_by: list[str] | None = None, name: str = "table") -> int:
    """Append the rows of ``df`` whose key is not yet stored at ``path``.

    ``df`` must already hold each key once (see :func:`operators.dedupe`).
    ``partition_by`` names the day column, a function of the key, whose
    ``day_part`` partitions the table. Returns the number of rows appended.
    """
    spark = df.sparkSession
    scratch = None
    if partition_by:
        df = with_part(df, partition_by[0])
    if exists(spark, path):
        if partition_by:
            # The batch is used twice (its days, then its rows): compute it
            # once into the shared folder instead of re-parsing bronze.
            scratch = scratch_path(spark, f"{name}-batch")
            df.write.parquet(scratch)
            df = spark.read.schema(df.schema).parquet(scratch)
            current = within_days(read_parted(spark, path, df.schema), df)
        else:
            current = spark.read.schema(df.schema).parquet(path)
        df = unseen(df, current, keys)

    def write(d: DataFrame) -> None:
        w = d.write.mode("append").option("compression", "snappy")
        (w.partitionBy(PART) if partition_by else w).parquet(path)
    rows = observed_write(df, name, write)
    if scratch:
        remove(spark, scratch)
    return rows


def merge_days(df: DataFrame, path: str, keys: list[str], partition_by: list[str],
               order_by: list[str] | None = None, name: str = "table") -> int:
    """Merge ``df`` into the table at ``path`` keeping, per key, the largest row
    in ``order_by`` order (then all other columns, values before nulls) over
    stored and new rows together; return the number of keys added.

    The largest of a union is the largest of the largest, so the table ends the
    same however the input was split into batches or replayed. Only the days
    present in ``df`` are read and merged (one aggregate, partial map-side), and
    only days whose digest of all rows changed are rewritten, with dynamic partition
    overwrite; the first batch is merged with an empty table. The merged days are written to the shared folder first, so the
    table is never read and overwritten by the same job; both scratch copies are
    removed at the end.
    """
    from ..operators.dedupe import dedupe
    spark = df.sparkSession
    if partition_by[0] not in df.columns:
        raise ValueError("the day column has to be a column of the batch")
    if not exists(spark, path):
        return append_new(dedupe(df, keys, order_by, descending=True), path, keys, partition_by=partition_by, name=name)
    df = with_part(df, partition_by[0])
    batch_path, merged_path = scratch_path(spark, f"{name}-batch"), scratch_path(spark, f"{name}-merged")
    df.write.parquet(batch_path)
    batch = spark.read.schema(df.schema).parquet(batch_path)
    stored = within_days(read_parted(spark, path, df.schema), batch).select(*df.columns)
    seen = Observation(f"{name}-stored")
    union = stored.observe(seen, F.count(F.lit(1)).alias("rows")).unionByName(batch)
    merged_rows = observed_write(dedupe(union, keys, order_by, descending=True), f"{name}-merged",
                                 lambda d: d.write.parquet(merged_path))
    merged = spark.read.schema(df.schema).parquet(merged_path)
    days_path = scratch_path(spark, f"{name}-changed")
    changed_parts(merged, stored, PART, df.columns).withColumnRenamed(PART, "_part").write.parquet(days_path)
    days = spark.read.schema("_part string").parquet(days_path)
    if not days.isEmpty():
        out = merged.join(days, merged[PART] == days["_part"], "left_semi")
        (out.write.mode("overwrite").option("compression", "snappy").option("partitionOverwriteMode", "dynamic")
            .partitionBy(PART).parquet(path))
    for scratch in (batch_path, merged_path, days_path):
        remove(spark, scratch)
    return merged_rows - int(seen.get.get("rows", 0))


def materialize_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """:func:`materialize` with the number of rows it wrote."""
    path = scratch_path(df.sparkSession, name)
    rows = observed_write(df, name, lambda d: d.write.parquet(path))
    return df.sparkSession.read.schema(df.schema).parquet(path), rows


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back.

    For small derived frames that are used more than once (counted, then
    joined): the work runs once, the lineage is cut, and the re-read has an
    exact size. The folder is the cluster's ``spark.checkpoint.dir``, visible
    to every executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

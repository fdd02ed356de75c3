"""Exact dedup by deterministic block naming.

The normalised text (A-Z lower-cased, UTF-8) is cut into blocks of
``BLOCK_BYTES``. Equal blocks get one integer name and different blocks
different ones: blocks are grouped by their content itself, not by a hash, and
the name is the smallest place (row number and block number) that holds it. Then
adjacent names are paired, every distinct pair is named the same way, and so on
until each document has one name: after ``r`` rounds that is the identity of a
document of more than 2^(r-1) and up to 2^r blocks. Two documents share round and
name exactly when their normalised texts are equal; no hash decides anything.

Each naming is a partial aggregate (copies within a task meet before the
shuffle) and a join back on the content, whose hot keys Spark splits at run
time. Texts of one block - most of them - leave after the first round, so the
rounds shrink by half or more. Blocks travel as bytes; pair rounds move three
numbers a row. What each round finished is written to the shared folder.

Defined cases: a null text counts as empty and equals the empty text; of equal
texts the row with the largest document id stays, null ids counting as smallest,
and of rows that repeat the id too the first in scan order; very long texts
only take more rounds; an empty table gives an empty result; other columns
are not read, or kept as they are by ``drop_duplicates``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, map_batches, row_id, written

BLOCK_BYTES = 4096


def blocks_of(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """One row per block: row, id, number, count, content; the first also has the text's SHA-256."""
    src = docs.select(row_id(docs.sparkSession).alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # A few texts at a time: a text's blocks are as long as the text.
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                at, number, count, content, digest = [], [], [], [], []
                for i, text in enumerate(part.column(2).to_pylist()):
                    data = (text or "").encode().lower()  # bytes.lower changes A-Z only
                    n = max(1, -(-len(data) // block_bytes))
                    at += [i] * n
                    number += range(n)
                    count += [n] * n
                    content += [data[k * block_bytes:(k + 1) * block_bytes] for k in range(n)]
                    digest += [hashlib.sha256(data).hexdigest()] + [None] * (n - 1)
                at = pa.array(at, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at), pa.array(number, pa.int64()), pa.array(count, pa.int64()),
                     pa.array(content, pa.binary()), pa.array(digest, pa.string())],
                    names=["row", "id", "number", "count", "content", "text_sha256"])

    return map_batches(src, cut, f"row long, id {dict(src.dtypes)['id']}, number long, count long, content binary, text_sha256 string")


def named(rows: DataFrame, keys: list[str], keep: list[str]) -> DataFrame:
    """``keep`` columns with ``name``: the smallest place among rows of equal ``keys``."""
    place = F.col("row").cast("decimal(38,0)") * (1 << 40) + F.col("number")
    names = rows.groupBy(*keys).agg(F.min(place).alias("name")).select(*[F.col(k).alias(f"n_{k}") for k in keys], "name")
    same = F.lit(True)
    for k in keys:
        same = same & (rows[k] == names[f"n_{k}"])  # never null; plain equality reuses the grouping's shuffle
    return rows.join(names, same).select(*keep, "name")


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: row, id, text_sha256, and its identity (round, name)."""
    keep = ["row", "id", "number", "count", "text_sha256"]
    level = written(named(blocks_of(docs, id_col, text_col, block_bytes), ["content"], keep), "block-names")
    done, turn = [], 0
    while True:
        done.append(level.where("count = 1").select("row", "id", "text_sha256", F.lit(turn).alias("round"), "name"))
        more = level.where("count > 1")
        if more.isEmpty():
            break
        pair = (F.col("number") / 2).cast("long")
        first = F.max(F.when(F.col("number") % 2 == 0, F.col("name")))
        second = F.max(F.when(F.col("number") % 2 == 1, F.col("name")))
        pairs = more.groupBy("row", "id", "count", pair.alias("number")).agg(
            first.alias("a"), F.coalesce(second, F.lit(-1)).alias("b"), F.max("text_sha256").alias("text_sha256")).withColumn("count", F.ceil(F.col("count") / 2))
        level = written(named(pairs, ["a", "b"], keep), f"pair-names-{turn}")
        turn += 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def dedup_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: row, ``id_col``, keep_id, group_size, kept, text_sha256.

    The group's size and the row that stays are one aggregate (reduced
    map-side) joined back on the identity."""
    ids = identities(docs, id_col, text_col, block_bytes)
    best = F.max(F.struct(F.col("id"), (-F.col("row")).alias("minus_row")))
    groups = ids.groupBy("round", "name").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best")).select(
        F.col("round").alias("g_round"), F.col("name").alias("g_name"), "group_size", "best")
    j = ids.join(groups, (ids["round"] == groups["g_round"]) & (ids["name"] == groups["g_name"]))
    return j.select("row", F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), "group_size",
                    (F.col("row") == -F.col("best.minus_row")).alias("kept"), "text_sha256")


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows that stay, whole. ``docs`` has to be a stored table (its scan
    numbers rows alike each time), as pipeline stages read it."""
    dropped = written(dedup_groups(docs, id_col, text_col, block_bytes).where("NOT kept").select(F.col("row").alias("dropped_row")), "dropped-rows")
    name = fresh("row_number_", docs.columns)
    numbered = docs.withColumn(name, row_id(docs.sparkSession))
    return numbered.join(dropped, numbered[name] == dropped["dropped_row"], "left_anti").drop(name)

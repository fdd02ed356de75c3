"""Small helpers shared by the text operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# Word and symbol classes fixed by the query contracts.
WORD_RX = r"[^\x20\x09-\x0D]+"
SPACE_RX = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a fresh table in the shared scratch folder, read back.

    Cuts the lineage on storage every executor sees, so a lost executor costs
    a reread, not a recomputation, and several readers share one evaluation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application
    (a few kilobytes through Spark's own file distribution)."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def map_batches(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with the package at hand in the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    A lambda body is evaluated per element, and Catalyst may inline a column
    into it; bound as a lambda variable the value is fixed.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fresh(name: str, taken: Iterable[str]) -> str:
    """``name``, with underscores added until none of the columns ``taken`` has it."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def columns(names: Iterable[str]) -> list[Column]:
    """Columns by their exact names, dots and backticks included."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in names]


def words_of(text: Column) -> Column:
    """The words of a text, in order; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_RX), lambda w: w != "")


def row_id(spark: SparkSession) -> Column:
    """A number per row: unique within one evaluation, and the same in every
    evaluation of the same stored table, whose file splits are then fixed.

    Spark sizes the splits of a small table by the cores at hand, which change
    when an executor is lost or added between two scans; the count seen first is
    therefore kept for the session, unless the user has set one."""
    key = "spark.sql.files.minPartitionNum"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(spark.sparkContext.defaultParallelism))
    return F.monotonically_increasing_id()


def null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def term_bytes(digits: bool) -> bytes:
    """A table for ``bytes.translate``: A-Z in lower case; bytes of other ASCII
    characters than letters (and digits, if wanted) become blanks, so that
    ``split`` gives the terms; bytes beyond ASCII stay."""
    keep = set(range(0x61, 0x7B)) | set(range(0x80, 0x100)) | (set(range(0x30, 0x3A)) if digits else set())
    return bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in keep else 0x20 for b in range(256))

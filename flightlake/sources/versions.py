"""Atomic publication of replaced tables.

A replaced table is a folder of versions and a folder of commits::

    <table>/000007-5d1c…/        the files of one version
    <table>/_commits/000007-5d1c…  an empty file: this version is complete

``publish`` writes a new version beside the others and then creates its commit
file, whose *name* says all: creating an empty file is one step on every file
system, and no pointer can be half written. The current version is the one of the
largest commit, so a run that dies at any moment leaves the old table readable
before that step and the new one after it. Nothing is renamed (a copy on object
stores) and a reader that resolved the old version may finish it: the last
``KEEP`` versions stay until a later publication removes them.

One writer at a time publishes a table, as the nightly job does.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

COMMITS = "_commits"
KEEP = 2
R = TypeVar("R")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001 - no Python binding
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p  # noqa: SLF001


def _names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, ascending; none if it does not exist."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def commits(spark: SparkSession, path: str) -> list[str]:
    """The committed versions of the table at ``path``, oldest first."""
    return [n for n in _names(spark, f"{path}/{COMMITS}") if n[:1].isdigit()]


def commit(spark: SparkSession, path: str, version: str) -> None:
    """Make ``version`` the current one: the only step that readers notice."""
    fs, p = _fs(spark, f"{path}/{COMMITS}/{version}")
    fs.create(p, False).close()


def vacuum(spark: SparkSession, path: str, keep: int = KEEP) -> None:
    """Remove what no reader resolves any more: committed versions before the last
    ``keep``, and what runs that died before their commit left behind."""
    done = commits(spark, path)
    old, kept = done[:-keep], set(done[-keep:])
    for name in old:  # the commit first: a version without one is never read
        fs, p = _fs(spark, f"{path}/{COMMITS}/{name}")
        fs.delete(p, False)
    for name in _names(spark, path):
        if name[:1].isdigit() and name not in kept:
            fs, p = _fs(spark, f"{path}/{name}")
            fs.delete(p, True)


def publish(spark: SparkSession, path: str, write: Callable[[str], R]) -> R:
    """Run ``write(folder)`` on a new version folder of the table at ``path`` and
    commit it; return what ``write`` returned. If it fails the table is as before."""
    path = path.rstrip("/")
    last = commits(spark, path)[-1:]
    version = f"{int(last[0].split('-')[0]) + 1 if last else 1:06d}-{uuid.uuid4().hex[:12]}"
    out = write(f"{path}/{version}")
    commit(spark, path, version)
    vacuum(spark, path)
    return out


def current(spark: SparkSession, path: str) -> str:
    """The folder that holds the table at ``path`` now: its current version, or
    ``path`` itself for tables that are merged in place."""
    path = path.rstrip("/")
    done = commits(spark, path)
    return f"{path}/{done[-1]}" if done else path


def published(spark: SparkSession, path: str) -> bool:
    return bool(commits(spark, path.rstrip("/")))


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The current version of the table at ``path``."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(current(spark, path))

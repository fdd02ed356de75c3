"""Access to the driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """Lazy parquet relations under one folder (``<dir>/<name>.parquet``).

    Nothing is read until a plan runs, and each plan reads only the columns
    and row groups it needs (Catalyst prunes the scan).
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._cache[name]

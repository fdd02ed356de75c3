"""Catalog registration of the lake's tables (JOB-4) and SQL reports over them.

The source registers gold tables with a crawler so an external engine can
query them; here each table becomes a temporary view, and the reports can be
asked in Spark SQL. Views are lazy: registering reads only Parquet footers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.versions import current
from .jobs import GOLD_TABLES, SILVER_TABLES, Lake, read_gold, read_silver


def register_lake(spark: SparkSession, lake: Lake, prefix: str = "", names: list[str] | None = None) -> list[str]:
    """Create or replace one temp view per silver and gold table (``names``: of these); return the views' names."""
    made = []
    for read, tables in ((read_silver, SILVER_TABLES), (read_gold, GOLD_TABLES)):
        for name in tables:
            if names is None or name in names:
                read(spark, lake, name).createOrReplaceTempView(prefix + name)
                made.append(prefix + name)
    return made


def create_tables(spark: SparkSession, lake: Lake, database: str, names: list[str] | None = None) -> list[str]:
    """Register the lake's tables in the session's catalog, where other sessions of
    the same metastore find them; return their full names.

    Each is an external Parquet table at the folder its current version lies in,
    with its partitions discovered and its size and row count analysed, which the
    planner uses for joins. Run it after a nightly run: a table replaced since
    then keeps its old version until the next call (and until it is vacuumed).
    Dropping such a table drops no file."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    made = []
    for layer, tables in (("silver", SILVER_TABLES), ("gold", GOLD_TABLES)):
        for name in tables:
            if names is not None and name not in names:
                continue
            full = f"`{database}`.`{name}`"
            folder = current(spark, getattr(lake, layer)(name)).replace("'", "\\'")
            spark.sql(f"DROP TABLE IF EXISTS {full}")
            spark.sql(f"CREATE TABLE {full} USING parquet LOCATION '{folder}'")
            if spark.table(full).columns != spark.read.parquet(folder).columns:
                raise ValueError(f"{full} does not have the columns of {folder}")
            if spark.sql(f"DESCRIBE TABLE EXTENDED {full}").where("col_name = '# Partition Information'").count():
                spark.sql(f"ALTER TABLE {full} RECOVER PARTITIONS")
            spark.sql(f"ANALYZE TABLE {full} COMPUTE STATISTICS")
            made.append(f"{database}.{name}")
    return made


def row_counts(spark: SparkSession, views: list[str]) -> DataFrame:
    """``(table_name, rows_read)`` for each view, as one UNION ALL query."""
    sql = "\nUNION ALL\n".join(
        f"SELECT '{v}' AS table_name, count(*) AS rows_read FROM {v}" for v in views)
    return spark.sql(sql)


# Reports as SQL over the registered views.
REPORT_SQL = {
    "worst_routes": """
        SELECT OP_CARRIER, Origin, Dest, avg_dep_delay, total_flights, delay_rate
        FROM {p}route_delay_summary
        ORDER BY avg_dep_delay DESC NULLS LAST, OP_CARRIER, Origin, Dest
        LIMIT {k}""",
    "best_carrier": """
        SELECT OP_CARRIER, avg_dep_delay
        FROM {p}carrier_performance
        ORDER BY avg_dep_delay ASC NULLS LAST, OP_CARRIER
        LIMIT 1""",
    "weather_category": """
        SELECT flight_category, count(*) AS total_flights,
               avg(DEP_DELAY) AS avg_dep_delay,
               sum(CAST(is_delayed AS INT)) / count(*) AS delay_rate
        FROM {p}flight_weather_joined
        GROUP BY flight_category""",
}


def report_sql(spark: SparkSession, name: str, prefix: str = "", k: int = 10) -> DataFrame:
    return spark.sql(REPORT_SQL[name].format(p=prefix, k=k))

"""First ``n`` rows per group under a total order, where a caller asks for a top-n.

``row_number() <= n`` lets Spark insert a partial group limit before the
shuffle, so each task forwards at most ``n`` rows per group. Done once, the
task that finishes a day still receives ``n`` rows from every scan task (a
number that grows with the input). So the limit runs twice: first per
(group, hash bucket of the row; as many buckets as shuffle partitions), then per
group. The second stage's input is
at most ``buckets × n`` rows per group, spread over the shuffle partitions of
the first, and the final task per group receives at most ``n`` rows from each
of those. The order is made total with every column, so the result is the
same on every run and every partitioning; rows equal in every column are
interchangeable.

Spark inserts the partial limit for ``n`` up to
``spark.sql.optimizer.windowGroupLimitThreshold`` (1000 by default); above
that the first stage still spreads a group over ``buckets`` tasks, and the
second receives at most ``buckets × n`` rows per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_n_per_group(df: DataFrame, groups: list[str], n: int,
                      order_by: list[str] | None = None,
                      buckets: int | None = None) -> DataFrame:
    """At most ``n`` rows per ``groups``: the first in ``order_by`` order
    (ascending, nulls first), ties broken by the remaining columns."""
    if n < 1:
        raise ValueError("n must be at least 1")
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = list(order_by or [])
    order += [c for c in df.columns if c not in order and c not in groups]
    sort = [F.col(c).asc_nulls_first() for c in order]

    def limit(frame: DataFrame, part: list) -> DataFrame:
        w = Window.partitionBy(*part).orderBy(*sort)
        return (frame.withColumn("_rn", F.row_number().over(w))
                .filter(F.col("_rn") <= n).drop("_rn"))

    bucket = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(buckets))
    spread = limit(df.withColumn("_bucket", bucket), [*groups, "_bucket"]).drop("_bucket")
    return limit(spread, list(groups))

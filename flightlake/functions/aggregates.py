"""Aggregate expressions with the null semantics of the gold tables.

All of them are declarative aggregates, so Spark plans a partial aggregate on
the map side and only one row per group and task crosses the shuffle — a key
holding a third of all rows costs no more network than any other.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rows() -> Column:
    """count(*): every row, nulls and cancelled flights included (AF-2)."""
    return F.count(F.lit(1))


def rate(flag_col: str) -> Column:
    """sum(flag as int) / count(*) (AF-3).

    A null flag is in the denominator but not the numerator; a group whose
    flags are all null yields null, not 0.
    """
    return F.sum(F.col(flag_col).cast("int")) / F.count(F.lit(1))


def true_count(flag_col: str) -> Column:
    """sum(flag as int) — null for an all-null group (AF-4); not count_if."""
    return F.sum(F.col(flag_col).cast("int"))


def count_when(cond: Column) -> Column:
    """sum(case when cond then 1 else 0) — never null (AF-5)."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def first_by(value: str, *order: str) -> Column:
    """Deterministic ``first``: the value of the row smallest in ``order``.

    ``order`` should be total within a group; the value itself is appended
    as the final tie-break so equal orders still give one answer. A null value
    is kept (like ``first`` without ignoring nulls).
    """
    return F.min_by(F.col(value), F.struct(*[F.col(c) for c in (*order, value)]))

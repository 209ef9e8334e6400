"""Joins whose few hot keys are taken out beforehand."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

HOT_SHARE = 2000
SMALL_ROWS = 1_000_000


def join_hot(rows: DataFrame, keyed: DataFrame, key: str, size: str) -> DataFrame:
    """Inner join of ``rows`` with ``keyed``, which has one row per key and the key's row count.

    Keys that hold more than 1/2000 of all rows, of which there can be at most 2,000, are joined
    by broadcast and so stay spread as they are; all others meet in a shuffle.
    """
    total = keyed.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    hot = keyed.filter(F.col(size) * HOT_SHARE > F.lit(total))
    cold = keyed.filter(F.col(size) * HOT_SHARE <= F.lit(total))
    apart = rows.join(F.broadcast(hot), key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return apart.unionByName(rest)


def sized(ids: DataFrame) -> DataFrame:
    """``ids``, narrow rows read from a table, marked for broadcast if they are a million at most."""
    return F.broadcast(ids) if ids.count() <= SMALL_ROWS else ids

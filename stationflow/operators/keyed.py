"""Keyed row operators: first and latest row of a key, insert-if-absent, replace by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of each key in arrival order.

    `row_number() = 1` is planned with a group limit before the shuffle, so a hot key sends
    one row from each map task however often it repeats.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last row of each key: a compacted topic, or the current row of an append log."""
    return first_per_key(df, keys, [F.col(c).desc() for c in order])


def first_with_last_position(
    df: DataFrame, keys: list[str], order: list[str], position: list[str]
) -> DataFrame:
    """First row of each key, but with the `position` columns of its last row.

    Both come from one aggregate that combines before the shuffle.
    """
    kept = [c for c in df.columns if c not in position]
    arrival = F.struct(*order)
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*kept), arrival).alias("_first"),
        F.max_by(F.struct(*position), arrival).alias("_last"),
    )
    return picked.select("_first.*", "_last.*").select(*df.columns)


def absent_from(new: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `new` whose key the target does not hold (insert if absent, any lateness).

    The size of the load decides, measured by adaptive execution, whether the target is cut down to the load's keys by a
    broadcast or shuffled.
    """
    stored = target.select(*keys).join(new.select(*keys), keys, "left_semi")
    return new.join(stored, keys, "left_anti")


def replace_by_key(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Target with the rows of `new` put in place of the rows that share their key."""
    return target.join(new.select(*keys), keys, "left_anti").select(*new.columns).unionByName(new)

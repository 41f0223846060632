"""Operators on row order that never gather one key, or the whole table, in a single task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_previous(
    df: DataFrame, keys: list[str], bucket: Column, order: list[str], value: str, out: str = "previous"
) -> DataFrame:
    """`lag(value)` over `keys` in `order`, computed bucket by bucket.

    `bucket` must not decrease along `order` and must bound the rows it holds (a block of
    positions, a day of distinct seconds). Rows inside a bucket look back within it; the first
    row of a bucket looks back over the bucket edges alone, two rows for each. Both branches
    read the same shuffle.
    """
    inner = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    marked = (
        df.withColumn("_bucket", bucket)
        .withColumn(out, F.lag(value).over(inner))
        .withColumn("_first", F.row_number().over(inner) == 1)
        .withColumn("_last", F.lead(F.lit(1)).over(inner).isNull())
    )
    outer = Window.partitionBy(*keys).orderBy("_bucket", *order)
    inside = marked.filter(~F.col("_first"))
    heads = (
        marked.filter(F.col("_first") | F.col("_last"))
        .withColumn(out, F.lag(value).over(outer))
        .filter("_first")
    )
    return inside.unionByName(heads).drop("_bucket", "_first", "_last")


def numbered(df: DataFrame, blocks: list[str], order: list[str], out: str, start: Column | int = 0) -> DataFrame:
    """Number rows 1, 2, 3, ... above `start` in the order of (`blocks`, `order`).

    Only the block sizes, one row for each block, pass through an unpartitioned window; the
    rows themselves are numbered inside their block. A block must bound the rows it holds.
    """
    sizes = df.groupBy(*blocks).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy(*blocks).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*blocks, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(*blocks).orderBy(*order))
    base = start if isinstance(start, Column) else F.lit(start).cast("long")
    return (
        df.withColumn("_place", place)
        .join(starts, blocks)
        .withColumn(out, (base + F.col("_before") + F.col("_place")).cast("long"))
        .drop("_place", "_before")
    )


# More splits than this are refused: it bounds the table that `numbered_in_place` broadcasts, to some hundred megabytes.
MOST_SPLITS = 4_000_000


def numbered_in_place(df: DataFrame, splits: list[str], index: str, out: str, start: int = 0) -> DataFrame:
    """Number rows 1, 2, 3, ... above `start` in the order of (`splits`, `index`) where they are.

    `index` rises by one from row to row of a split, as `monotonically_increasing_id` does among the rows that a task reads
    from one. So the number of a row is what the splits before its own hold, and its distance from its split's first row. Only
    one row for each split, made from these columns alone, is shuffled; the rows keep their tasks, whatever else they carry.
    """
    sizes = df.groupBy(*splits).agg(F.count(F.lit(1)).alias("_size"), F.min(index).alias("_first"), F.max(index).alias("_final"))
    order = Window.orderBy(*splits)
    before = F.coalesce(F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    scattered = F.raise_error(F.lit("the rows of a split do not follow each other"))
    many = F.raise_error(F.lit(f"more than {MOST_SPLITS} splits"))
    checked = F.when(F.col("_final") - F.col("_first") + 1 != F.col("_size"), scattered.cast("long"))
    checked = checked.when(F.row_number().over(order) > MOST_SPLITS, many.cast("long")).otherwise(before)
    starts = sizes.select(*[F.col(c).alias(f"_{k}") for k, c in enumerate(splits)], "_first", checked.alias("_before"))
    same = [F.col(c).eqNullSafe(F.col(f"_{k}")) for k, c in enumerate(splits)]
    placed = df.join(F.broadcast(starts), reduce(Column.__and__, same))
    number = F.lit(start) + F.col("_before") + F.col(index) - F.col("_first") + 1
    return placed.withColumn(out, number.cast("long")).drop("_first", "_before", *[f"_{k}" for k in range(len(splits))])

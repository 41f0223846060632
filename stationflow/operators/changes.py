"""Change detection: keep a description only when it differs from the one before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.functions import documents as D
from stationflow.operators.ordered import with_previous

BLOCK_BITS = 16


def block_of(position: str) -> Column:
    """Blocks of 65 536 positions."""
    return F.shiftright(position, BLOCK_BITS)


def changed(rows: DataFrame, key: str, order: list[str], block: Column) -> DataFrame:
    """Rows whose document (`doc`, VARIANT) differs from the key's previous one; A, B, A gives three."""
    hashed = rows.withColumn("digest", D.digest(F.col("doc"))).drop("doc")
    compared = with_previous(hashed, [key], block, order, "digest", "_before")
    return compared.filter(~F.col("digest").eqNullSafe(F.col("_before"))).drop("_before")

"""Small helpers on one-row results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def side_by_side(*one_row_frames: DataFrame) -> DataFrame:
    """Columns of several one-row results as a single row, without a cross join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), one_row_frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])

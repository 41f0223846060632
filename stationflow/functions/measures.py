"""Availability measures shared by models, reports and the archive analysis."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A ratio is summed as a decimal so that the order of addition cannot change a rounded mean.
RATIO = "decimal(18,10)"


def fill_rate(bikes: Column, docks: Column) -> Column:
    """Bikes over usable places; null for a station without any."""
    total = bikes.cast("long") + docks.cast("long")
    return F.when(total > 0, bikes.cast("double") / total)


def is_empty(installed: Column, bikes: Column) -> Column:
    return installed & (bikes == 0)


def is_full(installed: Column, docks: Column) -> Column:
    return installed & (docks == 0)


def ratio_sum(ratio: Column) -> Column:
    return F.sum(ratio.cast(RATIO))


def flag_sum(flag: Column) -> Column:
    return F.count_if(flag)


def mean(total: Column, count: Column, precision: int, scale: int) -> Column:
    """total / count as decimal(precision, scale), rounded half away from zero; null without rows."""
    quotient = total.cast("decimal(28,10)") / F.nullif(count, F.lit(0)).cast("decimal(20,0)")
    return quotient.cast(f"decimal({precision},{scale})")

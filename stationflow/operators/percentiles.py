"""Exact interpolated percentiles of whole-number measures, for groups of any size.

The built-in `percentile_cont` keeps every distinct value of a group in one buffer, which a hot group at scale would not
survive. Here a first look at the source makes one mergeable quantile sketch for each group and measure, so its exchange carries
sketches only. The sketch's error is bounded, so it brackets the wanted ranks for certain. A second look counts the values
below the bracket, which combine to one row a group, and the single values inside, a few in a thousand.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_UNIT = 10_000  # percentiles are given with at most four decimals

# A sketch is off by at most one rank in so many. A bracket leaves four times that on either side; a group of fewer values
# than this, whose ranks lie closer than the error, is its own bracket.
ACCURACY = 1000
_SLACK = Decimal(4) / ACCURACY


def _scaled(p: str) -> int:
    rank = Decimal(p) * _UNIT
    if rank != int(rank) or not 0 <= rank <= _UNIT:
        raise ValueError(f"{p} is no percentile of at most four decimals")
    return int(rank)


class ValueCounts:
    """Counts, largest values and percentiles of some long-typed measures of each group.

    Null values are not counted. `limits` gives the values above which `count_above` counts. Measures with `few` distinct values,
    such as gaps of whole seconds, are counted value by value at once, and the source is read once for all.
    """

    def __init__(
        self, df: DataFrame, groups: list[str], measures: dict[str, Column], limits: dict[str, int] | None = None, few: bool = False
    ):
        self.groups = groups
        self.few = few
        self.limits = limits or {}
        self.names = {name: f"_v{i}" for i, name in enumerate(measures)}
        self.rows = df.select(*groups, *[values.cast("long").alias(self.names[name]) for name, values in measures.items()])
        if few:
            self.counted = self._counted(self.rows, {v: F.col(v).isNotNull() for v in self.names.values()})

    def _counted(self, rows: DataFrame, wanted: dict[str, Column]) -> DataFrame:
        """(groups, _m, _v, _n): how often each value of a measure occurs where the condition holds."""
        pairs = [F.when(held, F.struct(F.lit(v).alias("m"), F.col(v).alias("v"))) for v, held in wanted.items()]
        found = rows.select(*self.groups, F.explode(F.array_compact(F.array(*pairs))).alias("_p"))
        return found.groupBy(*self.groups, F.col("_p.m").alias("_m"), F.col("_p.v").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))

    def count(self, measure: str) -> Column:
        return self._total(measure, F.lit(True), F.sum, F.count)

    def count_above(self, measure: str) -> Column:
        """Number of values above the measure's limit."""
        v = F.col("_v" if self.few else self.names[measure])
        return self._total(measure, v > self.limits[measure], F.sum, F.count)

    def largest(self, measure: str) -> Column:
        v = self.names[measure]
        largest = F.max(F.when(F.col("_m") == v, F.col("_v"))) if self.few else F.max(v)
        return largest.cast("decimal(24,4)")

    def _total(self, measure: str, held: Column, added, counted) -> Column:
        v = self.names[measure]
        if self.few:
            return F.coalesce(added(F.when((F.col("_m") == v) & held, F.col("_n"))), F.lit(0))
        return counted(F.when(held, F.col(v)))

    def totals(self, *columns: Column) -> DataFrame:
        """One row per group of `count`, `count_above` and `largest` columns."""
        return (self.counted if self.few else self.rows).groupBy(*self.groups).agg(*columns)

    def percentiles(self, wanted: dict[str, tuple[str, str]]) -> DataFrame:
        """One row per group with values; column `name` is the percentile of a measure, as decimal(24,4).

        `wanted` maps an output name to (measure, p); p is text such as "0.95".
        """
        asked = [(name, self.names[measure], _scaled(p)) for name, (measure, p) in wanted.items()]
        if self.few:
            brackets = self._whole_brackets(asked)
            counted = self._beside(self.counted, brackets)
        else:
            brackets = self._brackets(asked)
            looked = self._beside(self.rows, brackets)
            inside = {v: self._held(asked, v, F.col(v)) for _, v, _ in asked}
            below = [F.count_if(F.col(v) < F.col(f"_low{j}")).alias(f"_below{j}") for j, (_, v, _) in enumerate(asked)]
            under = looked.groupBy(*self.groups).agg(*below)
            counted = self._beside(self._beside(self._counted(looked, inside), brackets), under)
        return self._read_off(counted, asked)

    @staticmethod
    def _held(asked: list[tuple[str, str, int]], measure: str, value: Column) -> Column:
        """Whether a value lies in a bracket of its measure."""
        mine = [value.between(F.col(f"_low{j}"), F.col(f"_high{j}")) for j, (_, v, _) in enumerate(asked) if v == measure]
        return reduce(Column.__or__, mine)

    def _ranks(self, asked: list[tuple[str, str, int]], n: dict[str, Column]) -> list[Column]:
        """The lower of the two neighbouring ranks of every percentile, from 0 on, and the way from it to the upper one; null without values."""
        found = []
        for j, (_, v, scaled) in enumerate(asked):
            exact = F.when(n[v] > 0, n[v] - 1) * F.lit(scaled).cast("long")
            low = F.call_function("div", exact, F.lit(_UNIT))
            found += [low.alias(f"_rank{j}"), (exact - low * _UNIT).alias(f"_part{j}")]
        return found

    def _brackets(self, asked: list[tuple[str, str, int]]) -> DataFrame:
        """One row per group: for every percentile its rank and the values that enclose it."""
        points: dict[str, list[float]] = {v: [] for _, v, _ in asked}
        for _, v, scaled in asked:
            p = Decimal(scaled) / _UNIT
            points[v] += [float(max(Decimal(0), p - _SLACK)), float(min(Decimal(1), p + _SLACK))]
        first = []
        for v, at in points.items():
            sketch = F.percentile_approx(v, F.array(*[F.lit(x) for x in at]), F.lit(ACCURACY))
            first += [F.count(v).alias(f"_n{v}"), F.min(v).alias(f"_min{v}"), F.max(v).alias(f"_max{v}"), sketch.alias(f"_s{v}")]
        seen = self.rows.groupBy(*self.groups).agg(*first)
        ends = []
        place = dict.fromkeys(points, 0)
        for j, (_, v, _) in enumerate(asked):
            small = F.col(f"_n{v}") < ACCURACY
            for end, whole in (("low", "min"), ("high", "max")):
                ends.append(F.when(small, F.col(f"_{whole}{v}")).otherwise(F.col(f"_s{v}")[place[v]]).alias(f"_{end}{j}"))
                place[v] += 1
        ranks = self._ranks(asked, {v: F.col(f"_n{v}") for v in points})
        return seen.select(*self.groups, *ranks, *ends)

    def _whole_brackets(self, asked: list[tuple[str, str, int]]) -> DataFrame:
        """The same where all values are counted: a bracket is all of them, with nothing below."""
        measures = {v for _, v, _ in asked}
        n = [F.sum(F.when(F.col("_m") == v, F.col("_n"))).alias(f"_n{v}") for v in measures]
        lows = [F.min(F.when(F.col("_m") == v, F.col("_v"))).alias(f"_low{j}") for j, (_, v, _) in enumerate(asked)]
        highs = [F.max(F.when(F.col("_m") == v, F.col("_v"))).alias(f"_high{j}") for j, (_, v, _) in enumerate(asked)]
        seen = self.counted.groupBy(*self.groups).agg(*n, *lows, *highs)
        kept = [f"_{end}{j}" for end in ("low", "high") for j in range(len(asked))]
        none = [F.lit(0).cast("long").alias(f"_below{j}") for j in range(len(asked))]
        return seen.select(*self.groups, *self._ranks(asked, {v: F.col(f"_n{v}") for v in measures}), *kept, *none)

    def _beside(self, rows: DataFrame, per_group: DataFrame) -> DataFrame:
        """Rows with the columns of their group's one row; adaptive execution broadcasts it while it is small.

        Without groups there is one row, a scalar subquery to the others.
        """
        keys = {g: f"_of{i}" for i, g in enumerate(self.groups)}
        if not keys:
            one = per_group.select(F.struct(*per_group.columns).alias("one")).scalar()
            beside = rows.withColumn("_one", one)
            return beside.select(*rows.columns, *[F.col("_one")[c].alias(c) for c in per_group.columns])
        other = per_group.withColumnsRenamed(keys)
        same = reduce(Column.__and__, [F.col(g).eqNullSafe(F.col(k)) for g, k in keys.items()])
        return rows.join(other, same).drop(*keys.values())

    def _read_off(self, counted: DataFrame, asked: list[tuple[str, str, int]]) -> DataFrame:
        """The percentiles from the counted values of the brackets."""
        upto = Window.partitionBy(*self.groups, "_m").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
        ends = {}
        for j, (_, v, _) in enumerate(asked):
            mine = (F.col("_m") == v) & F.col("_v").between(F.col(f"_low{j}"), F.col(f"_high{j}"))
            ends[f"_end{j}"] = F.when(mine, F.col(f"_below{j}") + F.sum(F.when(mine, F.col("_n"))).over(upto))
        placed = counted.withColumns(ends)
        found, columns = [], []
        for j, (name, _, _) in enumerate(asked):
            end, rank, part = F.col(f"_end{j}"), F.col(f"_rank{j}"), F.col(f"_part{j}")
            next_rank = F.when(part > 0, rank + 1).otherwise(rank)
            at = lambda r, end=end: F.max(F.when((r >= end - F.col("_n")) & (r < end), F.col("_v")))
            found += [at(rank).alias(f"_at{j}"), at(next_rank).alias(f"_next{j}"), F.max(part).alias(f"_part{j}"), F.max(rank).alias(f"_rank{j}")]
            low, high = F.col(f"_at{j}"), F.col(f"_next{j}")
            between = (high - low) * (F.col(f"_part{j}").cast("decimal(10,0)") / F.lit(Decimal(_UNIT)))
            missed = F.raise_error(F.lit(f"the bracket of {name} misses its rank")).cast("decimal(24,4)")
            # A measure without values has no rank.
            value = F.when(low.isNotNull() & high.isNotNull(), (low + between).cast("decimal(24,4)"))
            columns.append(value.when(F.col(f"_rank{j}").isNotNull(), missed).alias(name))
        return placed.groupBy(*self.groups).agg(*found).select(*self.groups, *columns)


def exact_percentiles(df: DataFrame, groups: list[str], wanted: dict[str, tuple[Column, str]]) -> DataFrame:
    """Percentiles alone: `wanted` maps an output name to (values, p)."""
    measures = {str(values): values for values, _ in wanted.values()}
    return ValueCounts(df, groups, measures).percentiles({n: (str(v), p) for n, (v, p) in wanted.items()})


def seconds(micros: Column, places: int) -> Column:
    """Microseconds as seconds with `places` decimals, rounded half away from zero."""
    return (micros / F.lit(Decimal(1_000_000))).cast(f"decimal(20,{places})")

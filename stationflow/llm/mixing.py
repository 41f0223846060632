"""Mixing of sources to target weights by Pareto order sampling, in DataFrame functions only.

A source's target is a multiple of its words. Every document is first taken as many whole times as that
multiple holds; what is left is an inclusion odds of one more copy, and documents are ranked by random odds over
inclusion odds. The ranking is cut where the words reach the target, so a source's words end within one document of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm.common import WORD, uniform, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = "mix"


def word_count(text: str | Column) -> Column:
    """Words of a text as a long; null counts as empty."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) of (source, size): the words each source is to give.

    Sources weigh `weights` in turn, by code point, null last. They share `share` times all words; a target stops at `most`
    times its source's words and the excess goes to the others by weight until none is above. Sources sorted by cap over weight
    fill up in that order, so one cumulative pass finds the level at which the rest is shared. One row per source here.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))
    everything = Window.partitionBy(F.lit(0))
    filled = Window.partitionBy(F.lit(0)).orderBy("fill").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rows = per_source.withColumns({"weight": weight, "cap": F.col("source_size") * F.lit(float(most))})
    rows = rows.withColumns({"fill": F.col("cap") / F.col("weight"), "total": F.sum("source_size").over(everything) * F.lit(float(share))})
    rows = rows.withColumns({"capped": F.sum("cap").over(filled), "rest": F.sum("weight").over(everything) - F.sum("weight").over(filled)})
    rows = rows.withColumn("full", F.col("capped") + F.col("fill") * F.col("rest") <= F.col("total"))
    used = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(everything)
    open_weight = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(everything)
    level = (F.col("total") - used) / F.when(open_weight > 0, open_weight)
    return rows.select("source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * level).alias("target"))


def mixed(
    docs: DataFrame,
    size: Column | str,
    id_col: str = "doc_id",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: str = SEED,
) -> DataFrame:
    """(id, source, size, source_size, target, copies) of every document.

    A source's multiple m = target / source_size, at most `most`: floor(m) whole copies of each document and, with odds
    p = m - floor(m), one more for the documents of lowest u (1 - p) / ((1 - u) p), u being a hash of seed and id. They
    are taken in that order up to the document at which the words come nearest to the target. Documents without words are in no
    copy beyond the whole ones. Rows that share an id get their turn by size. A null source is a source; an empty table gives no rows.

    The order within a source is found in two steps, so that no task sees more of a source than the square root of the
    table: words per slice of the random numbers, then the documents of the one slice in which the cut lies.
    """
    spark_size = F.col(size) if isinstance(size, str) else size
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), spark_size.cast("long").alias("size"))
    rows = written(rows.withColumn("u", uniform(F.lit(seed), "id")), "sizes")
    slices = int(rows.count() ** 0.5) + 1
    goals = targets(rows, weights, share, most)
    multiple = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goals = goals.withColumn("whole", F.floor(multiple).cast("long"))
    goals = goals.withColumns({"p": multiple - F.col("whole"), "open": F.col("target") - F.col("whole") * F.col("source_size")})
    goals = written(goals.withColumnRenamed("source", "of"), "goals")
    same = F.col("source").eqNullSafe(F.col("of"))
    odds = F.when(F.col("p") > 0, (F.col("u") * (1 - F.col("p"))) / ((1 - F.col("u")) * F.col("p")))
    # Within a source the rank rises with u: the same slices of u serve every source.
    rows = rows.join(goals, same).withColumns({"slice": F.floor(F.col("u") * slices).cast("long"), "rank": odds}).drop("of")
    rows = written(rows, "ranked")
    per_slice = rows.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_slice.withColumn("start", F.coalesce(F.sum("words").over(before), F.lit(0)))
    starts = written(starts.select(F.col("source").alias("of"), F.col("slice").alias("at"), "start", "words"), "starts")
    placed = rows.join(starts, same & (F.col("slice") == F.col("at")))
    cut = (F.col("start") < F.col("open")) & (F.col("start") + F.col("words") >= F.col("open"))
    outside = placed.where(~cut).withColumn("extra", F.col("start") + F.col("words") < F.col("open"))
    order = Window.partitionBy("source", "slice").orderBy("rank", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    inside = placed.where(cut).withColumn("ahead", F.col("start") + F.coalesce(F.sum("size").over(order), F.lit(0)))
    inside = inside.withColumn("extra", F.col("ahead") + F.col("size") / 2.0 <= F.col("open")).drop("ahead")
    both = outside.unionByName(inside)
    taken = F.col("extra") & (F.col("p") > 0) & (F.col("size") > 0)
    copies = F.col("whole") + F.when(taken, 1).otherwise(0)
    return both.select("id", "source", "size", "source_size", "target", copies.cast("long").alias("copies"))

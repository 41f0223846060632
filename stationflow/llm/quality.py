"""Quality by a sparse rule ensemble: paths of shallow trees over text statistics, weighted by a lasso logistic fit.

The rules and weights are compiled into one Spark column over the statistics.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.llm import bytesops
from stationflow.llm.common import written
from stationflow.llm.labels import probability

STATISTICS = [
    "length", "words", "word_length", "upper", "digit", "white", "mark", "sign", "bar", "foreign",
    "distinct_words", "top_word", "distinct_lines", "line_length", "signed_words", "long_words",
]
TREES = 24
DEPTH = 3
LASSO = 0.0005
SEED = 11
SLICE = bytesops.SLICE
# Names of the statistics beside a table's own columns.
PREFIX = "_statistic_"

# Classes of bytes: 0 lower case, 1 upper, 2 digit, 3 white, 4 punctuation, 5 other sign, 6 bar, 7 beyond ASCII.
KIND = np.full(256, 5, np.int64)
KIND[97:123], KIND[65:91], KIND[48:58], KIND[128:] = 0, 1, 2, 7
KIND[bytesops.WHITE] = 3
KIND[[ord(c) for c in ".,;:?'\"()-"]] = 4
KIND[ord("|")] = 6


def statistics_of(column: pa.Array) -> np.ndarray:
    """The STATISTICS of each text, one row per statistic."""
    out = np.zeros((len(STATISTICS), len(column)))
    for low, high, raw, offsets in bytesops.text_slices(column, SLICE):
        rows, size = high - low, np.diff(offsets)
        of_byte = np.repeat(np.arange(rows), size)
        share = np.bincount(of_byte * 8 + KIND[raw], minlength=rows * 8).reshape(rows, 8) / np.maximum(size, 1)[:, None]
        starts, ends, of_word = bytesops.words(raw, offsets)
        words = np.bincount(of_word, minlength=rows)
        some = np.maximum(words, 1)
        sums = bytesops.prefix_sums(raw)
        hashes = bytesops.span_hashes(sums, starts, ends)
        order = np.lexsort((hashes, of_word))
        new = np.r_[True, (hashes[order][1:] != hashes[order][:-1]) | (of_word[order][1:] != of_word[order][:-1])][: len(order)]
        first = np.flatnonzero(new)
        times = np.diff(np.r_[first, len(order)])
        top = np.zeros(rows)
        np.maximum.at(top, of_word[order][first], times)
        signed = np.isin(KIND[raw[ends - 1]], (5, 6)) if len(ends) else np.zeros(0, bool)
        line_starts, line_ends, of_line = bytesops.spans(raw != 10, offsets)
        lines = np.bincount(of_line, minlength=rows)
        one = np.unique(bytesops.mixed(bytesops.span_hashes(sums, line_starts, line_ends) + of_line.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
        out[:, low:high] = [
            np.log1p(size),
            np.log1p(words),
            np.bincount(of_word, ends - starts, rows) / some,
            *share[:, 1:8].T,
            np.bincount(of_word[order][first], minlength=rows) / some,
            top / some,
            np.bincount(of_line[one], minlength=rows) / np.maximum(lines, 1),
            np.log1p(words / np.maximum(lines, 1)),
            np.bincount(of_word, signed, rows) / some,
            np.bincount(of_word, ends - starts > 30, rows) / some,
        ]
    return out


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with their STATISTICS; a null text counts as empty, and an empty text has zeros."""
    at = docs.columns.index(text_col)
    names = [PREFIX + s for s in STATISTICS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = map(pa.array, statistics_of(batch.column(at)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], [*batch.schema.names, *names])

    return docs.mapInArrow(run, T.StructType([*docs.schema, *[T.StructField(n, T.DoubleType()) for n in names]]))


@dataclass(frozen=True, order=True)
class Rule:
    """Conditions (statistic, upper or lower bound, threshold) that hold together."""

    conditions: tuple[tuple[str, bool, float], ...]

    def column(self, prefix: str = "") -> Column:
        parts = [F.col(prefix + s) <= F.lit(t) if below else F.col(prefix + s) > F.lit(t) for s, below, t in self.conditions]
        return reduce(lambda a, b: a & b, parts).cast("double")

    @staticmethod
    def of(path: list[tuple[str, bool, float]]) -> Rule:
        """The path with one condition per statistic and side: the tightest."""
        tight: dict[tuple[str, bool], float] = {}
        for s, below, t in path:
            known = tight.get((s, below), t)
            tight[s, below] = min(known, t) if below else max(known, t)
        return Rule(tuple(sorted((s, below, t) for (s, below), t in tight.items())))


def rules_of(description: str) -> set[Rule]:
    """Every path from a root, to inner nodes and leaves, in the text description of trees."""
    found: set[Rule] = set()
    path: list[tuple[int, tuple[str, bool, float]]] = []
    for line in description.splitlines():
        depth = len(line) - len(line.lstrip())
        if m := re.match(r"\s*(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line):
            path = [x for x in path if x[0] < depth] + [(depth, (STATISTICS[int(m[1])], m[2] == "<=", float(m[3])))]
            found.add(Rule.of([c for _, c in path]))
    return found


@dataclass
class Model:
    start: float
    weights: list[tuple[Rule, float]]

    def column(self) -> Column:
        """The score as an expression over the statistics."""
        return probability(reduce(lambda a, rw: a + rw[0].column(PREFIX) * F.lit(rw[1]), self.weights, F.lit(self.start)))


def fitted(rows: DataFrame) -> Model:
    """A model of rows (label, STATISTICS). Without both labels it has no rules and gives the share of ones."""
    n, ones = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < ones < n:
        share = (ones + 0.5) / (n + 1)
        return Model(float(np.log(share / (1 - share))), [])
    assembled = VectorAssembler(inputCols=STATISTICS, outputCol="features").transform(rows)
    forest = RandomForestClassifier(labelCol="label", numTrees=TREES, maxDepth=DEPTH, maxBins=64, subsamplingRate=0.7, seed=SEED)
    rules = sorted(rules_of(forest.fit(assembled.select("label", "features")).toDebugString))
    if not rules:
        return Model(float(np.log(ones / (n - ones))), [])
    held = rows.select("label", array_to_vector(F.array(*[r.column() for r in rules])).alias("features"))
    held = written(held, "rules")
    lasso = LogisticRegression(labelCol="label", elasticNetParam=1.0, regParam=LASSO, maxIter=60, standardization=False)
    fit = lasso.fit(held)
    weights = [(r, float(w)) for r, w in zip(rules, fit.coefficients.toArray(), strict=True) if w]
    return Model(float(fit.intercept), weights)


def learnt(docs: DataFrame, sample: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model of the documents in `sample`, (doc_id, label) of at most labels.SAMPLE rows, which is broadcast for that bound."""
    sample = F.broadcast(sample.select(F.col("doc_id").alias("_of"), "label"))
    known = docs.join(sample, F.col(id_col) == F.col("_of")).select(F.col(text_col).alias("text"), "label")
    return fitted(written(with_statistics(known), "train").select("label", *[F.col(PREFIX + s).alias(s) for s in STATISTICS]))


def scored(docs: DataFrame, model: Model, text_col: str = "text", score: str = "score") -> DataFrame:
    """The rows with a column `score`: how likely the text is of quality, from 0 to 1.

    Null and empty texts are scored by their statistics, which are all 0. Other columns pass through.
    """
    rows = with_statistics(docs, text_col)
    return rows.select(*[F.col(c) for c in docs.columns], model.column().alias(score))

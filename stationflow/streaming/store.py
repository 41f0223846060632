"""Tables written batch by batch, with the ledger row as the commit marker, and their compaction.

Each batch of a stream writes its rows of each table below a folder of its own, stream_id=.../batch_id=..., and adds its ledger row
last. Readers open the folders that the ledger names and no others, so a batch that died half-way is invisible, and its retry, which
sees the same input, overwrites what it left.

A ledger row carries a sequence number, which orders batches over all streams, and notes which tables the batch holds, with the least
and greatest values of some columns. A reader that wants a range opens only the folders that can hold it. It also notes of which
partitions, days say, the batch holds all rows: those of earlier parts are out of date, and readers prune them.

Compaction keeps the folders few. Closed batches are level 0; as soon as a level has `fan` parts, all parts up to it are rewritten
as one part of the next level, under the reserved stream `compacted`. A log may be reduced on the way, to the latest row of each key,
say. The part is published by one ledger write, which also carries the ledger rows of what it covers: before that write the new
folders are invisible, after it the old ones are. So n batches make fewer than fan * log(n) parts, each row is rewritten log(n) times,
and a crash at any point loses nothing. What a compaction replaced is removed by the one after it, which gives readers that
opened the old parts the time in between.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow import files
from stationflow.schemas import require_same_schema

PAIR = ["stream_id", "batch_id"]
COMPACTED = "compacted"
FAN = 8

# The ends of a range, both included; None leaves an end open.
Range = tuple[object, object]
Pair = tuple[str, int]

# What a ledger row has besides the caller's columns. The row of a compacted part itself has `covers` and no level 0.
_PAIR_TYPE = T.StructType([T.StructField("stream_id", T.StringType()), T.StructField("batch_id", T.LongType())])
_HELD_TYPE = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("low", T.LongType()),
        T.StructField("high", T.LongType()),
    ]
)
_NOTES = T.StructType(
    [
        T.StructField("sequence", T.LongType()),
        T.StructField("of", _PAIR_TYPE),
        T.StructField("level", T.IntegerType()),
        T.StructField("held", T.ArrayType(_HELD_TYPE)),
        T.StructField("covers", T.MapType(T.StringType(), T.LongType())),
        T.StructField("replaced", T.ArrayType(_PAIR_TYPE)),
        T.StructField("whole", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
    ]
)


def as_number(value: object) -> int:
    """A bound as the ledger notes it: times in microseconds, text and times without a zone as UTC."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
        value = value if value.tzinfo else value.replace(tzinfo=UTC)
    if isinstance(value, datetime):
        # Spark gives times without a zone in the zone of this process.
        whole = value.astimezone(UTC) - datetime(1970, 1, 1, tzinfo=UTC)
        return (whole.days * 86_400 + whole.seconds) * 1_000_000 + whole.microseconds
    return int(value)


@dataclass(frozen=True)
class Part:
    """What one ledger row makes visible: a batch, or a compacted part."""

    pair: Pair
    sequence: int
    level: int = 0
    held: Mapping[str, Mapping[str, Range]] = field(default_factory=dict)
    covers: Mapping[str, int] = field(default_factory=dict)
    replaced: tuple[Pair, ...] = ()
    whole: Mapping[str, frozenset[str]] = field(default_factory=dict)

    def may_hold(self, table: str, within: Mapping[str, Range]) -> bool:
        if table not in self.held:
            return False
        for column, (low, high) in within.items():
            least, most = self.held[table].get(column, (None, None))
            if least is not None and ((high is not None and least > as_number(high)) or (low is not None and most < as_number(low))):
                return False
        return True


@dataclass(frozen=True)
class State:
    """The live parts, oldest first, the last committed batch of each stream, and the next sequence number."""

    parts: tuple[Part, ...] = ()
    marks: Mapping[str, int] = field(default_factory=dict)
    sequence: int = 0

    def with_part(self, part: Part) -> State:
        gone = set(part.replaced)
        left = tuple(p for p in self.parts if p.pair not in gone)
        marks = dict(self.marks)
        if part.level == 0:
            marks[part.pair[0]] = part.pair[1]
        return State((*left, part), marks, part.sequence + 1)


def to_merge(parts: tuple[Part, ...], fan: int) -> list[Part]:
    """The parts to rewrite as one: all up to the highest level that, with what comes up from below, has `fan` parts."""
    chosen, carried, level = [], 0, 0
    here: list[Part] = []
    while True:
        at = [p for p in parts if p.level == level]
        here += at
        if len(at) + carried < fan:
            return sorted(chosen, key=lambda p: p.sequence)
        chosen, carried, level = list(here), 1, level + 1


class BatchStore:
    """`by` gives partition columns, `zones` the columns whose range the ledger notes, `reduced` what a compaction makes of a table's
    rows, and `newest` the tables of which every batch writes the whole, so that only the last counts. One writer per store.
    """

    def __init__(
        self,
        root: str,
        ledger: str,
        schemas: dict[str, T.StructType],
        by: dict[str, list[str]] | None = None,
        zones: dict[str, list[str]] | None = None,
        reduced: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
        newest: tuple[str, ...] = (),
        fan: int = FAN,
    ):
        self.root = root.rstrip("/")
        self.ledger_name = ledger
        self.schemas = schemas
        self.by = by or {}
        self.zones = zones or {}
        self.reduced = reduced or {}
        self.newest = newest
        self.fan = fan
        self._written: dict[str, dict[str, Range]] = {}
        self._whole: dict[str, frozenset[str]] = {}

    def path(self, name: str, pair: Pair | None = None) -> str:
        if pair is None:
            return f"{self.root}/{name}"
        if not re.fullmatch(r"[\w.-]+", pair[0]):
            raise ValueError(f"{pair[0]!r} cannot name a stream")
        return f"{self.root}/{name}/stream_id={pair[0]}/batch_id={pair[1]}"

    def tables(self) -> list[str]:
        return [n for n in self.schemas if n != self.ledger_name]

    def _ledger_schema(self) -> T.StructType:
        own = [f for f in self.schemas[self.ledger_name].fields if f.name not in PAIR]
        return T.StructType([*own, *_NOTES.fields, *[f for f in self.schemas[self.ledger_name].fields if f.name in PAIR]])

    def _open(self, spark: SparkSession, name: str, schema: T.StructType, pairs: list[Pair]) -> DataFrame:
        if not pairs:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", self.path(name)).parquet(*[self.path(name, p) for p in pairs])

    # Reading

    def state(self, spark: SparkSession) -> State:
        """The live parts as the ledger has them now: a few rows for any number of batches."""
        if not files.exists(spark, self.path(self.ledger_name)):
            return State()
        rows = spark.read.schema(self._ledger_schema()).parquet(self.path(self.ledger_name))
        compacted = [_part(r) for r in rows.filter("level > 0").select(*_NOTES.names).collect()]
        gone = {p for c in compacted for p in c.replaced}
        live = [c for c in compacted if c.pair not in gone]
        covered: dict[str, int] = {}
        for c in live:
            for stream, last in c.covers.items():
                covered[stream] = max(covered.get(stream, -1), last)
        beyond = [(F.col("stream_id") == s) & (F.col("batch_id") <= last) for s, last in covered.items()]
        fresh = rows.filter((F.col("stream_id") != COMPACTED) & ~reduce(Column.__or__, beyond, F.lit(False)))
        live += [_part(r) for r in fresh.select(*_NOTES.names).collect()]
        marks = dict(covered)
        for p in live:
            if p.level == 0:
                marks[p.pair[0]] = max(marks.get(p.pair[0], -1), p.pair[1])
        live.sort(key=lambda p: p.sequence)
        return State(tuple(live), marks, live[-1].sequence + 1 if live else 0)

    def writer_state(self, spark: SparkSession) -> State:
        """The state to write on with; refuses a store whose tables have other columns than are to be written.

        The columns come from the files of each table's newest part, partitions apart.
        """
        state = self.state(spark)
        for name in self.tables():
            paths = [self.path(name, p.pair) for p in reversed(state.parts) if name in p.held]
            # A part that says that some days are empty has no files.
            path = next((p for p in paths if any(not c.startswith("_") for c in files.children(spark, p))), None)
            if path:
                by = self.by.get(name, [])
                stored = spark.read.parquet(path).drop(*by)
                own = [f for f in self.schemas[name].fields if f.name not in (*PAIR, *by)]
                require_same_schema(stored, T.StructType(own))
        self.begin()
        return state

    def ledger(self, spark: SparkSession, state: State | None = None) -> DataFrame:
        """One row for each committed batch, with its own stream and number."""
        state = state or self.state(spark)
        schema = self._ledger_schema()
        rows = self._open(spark, self.ledger_name, schema, [p.pair for p in state.parts]).filter("level = 0")
        own = {c: F.col(f"of.{c}") for c in PAIR}
        return rows.select(*[own.get(n, F.col(n)).alias(n) for n in self.schemas[self.ledger_name].fieldNames()])

    def read(
        self,
        spark: SparkSession,
        name: str,
        state: State | None = None,
        within: Mapping[str, Range] | None = None,
        streams: list[str] | None = None,
    ) -> DataFrame:
        """Committed rows, of some streams only if asked, and with columns in the given ranges.

        The ledger rules out parts that cannot hold a range; the filter on the rows goes on to the files. The stream and batch of
        a row name the part that holds it.
        """
        state = state or self.state(spark)
        held = [p for p in state.parts if name in p.held and _of(p, streams)]
        parts = [p for p in (held[-1:] if name in self.newest else held) if p.may_hold(name, within or {})]
        rows = self._open(spark, name, self.schemas[name], [p.pair for p in parts])
        later: set[str] = set()
        for p in reversed(held):
            if later and p in parts:
                mine = (F.col("stream_id") == p.pair[0]) & (F.col("batch_id") == p.pair[1])
                rows = rows.filter(~(mine & F.col(self.by[name][0]).cast("string").isin(*sorted(later))))
            later |= p.whole.get(name, frozenset())
        for column, (low, high) in (within or {}).items():
            if low is not None:
                rows = rows.filter(F.col(column) >= F.lit(low))
            if high is not None:
                rows = rows.filter(F.col(column) <= F.lit(high))
        return rows

    def written(self, spark: SparkSession, name: str, stream_id: str, batch_id: int) -> DataFrame:
        """The rows that a batch has just written, committed or not."""
        pairs = [(stream_id, batch_id)] if name in self._written else []
        return self._open(spark, name, self.schemas[name], pairs)

    # Writing

    def write(self, name: str, rows: DataFrame, stream_id: str, batch_id: int, whole: Iterable[object] = ()) -> int:
        """Write a batch's rows of one table, in place of what an attempt before left; returns how many.

        `whole` names the values of the first partition column of which these are all rows there are.

        The rebalance lets adaptive execution size the files: small partitions are merged and a
        hot day is split. Counts and ranges are observed by the write itself.
        """
        by = self.by.get(name, [])
        fields = [f for f in self.schemas[name].fields if f.name not in PAIR]
        out = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
        kinds = {f.name: f.dataType for f in fields}
        seen = {c: F.unix_micros(c) if kinds[c] == T.TimestampType() else F.col(c).cast("long") for c in self.zones.get(name, [])}
        measured = [f(v).alias(f"{end}_{c}") for c, v in seen.items() for end, f in (("low", F.min), ("high", F.max))]
        noted = Observation()
        out = out.hint("rebalance", *by) if by else out.hint("rebalance")
        out = out.observe(noted, F.count(F.lit(1)).alias("rows"), *measured)
        out.write.mode("overwrite").partitionBy(*by).parquet(self.path(name, (stream_id, batch_id)))
        found = noted.get
        whole = frozenset(map(str, whole))
        if whole:
            self._whole[name] = whole
        if found["rows"] or whole:
            self._written[name] = {c: (found[f"low_{c}"], found[f"high_{c}"]) for c in seen}
        return found["rows"]

    def commit(self, spark: SparkSession, state: State, stream_id: str, batch_id: int, values: dict) -> State:
        """Write the ledger row that makes the batch visible; returns the state with it."""
        if stream_id == COMPACTED:
            raise ValueError(f"{COMPACTED} is the stream of compacted parts")
        part = Part((stream_id, batch_id), state.sequence, **self._taken())
        self._publish(self._row(spark, part, values), part)
        return state.with_part(part)

    def _taken(self) -> dict:
        """What the batch has written, as notes of its part."""
        notes = {"held": self._written, "whole": self._whole}
        self._written, self._whole = {}, {}
        return notes

    def begin(self) -> None:
        """Forget what a failed attempt has written."""
        self._written, self._whole = {}, {}

    def _row(self, spark: SparkSession, part: Part, values: dict) -> DataFrame:
        held = [(t, c, *ends) for t, columns in part.held.items() for c, ends in [("", (None, None)), *columns.items()]]
        notes = (part.sequence, part.pair, part.level, held, dict(part.covers), list(part.replaced), {t: sorted(v) for t, v in part.whole.items()})
        schema = T.StructType([f for f in self._ledger_schema().fields if f.name not in PAIR])
        own = [values.get(n) for n in schema.fieldNames()[: -len(_NOTES)]]
        return spark.createDataFrame([(*own, *notes)], schema)

    def _publish(self, rows: DataFrame, part: Part) -> None:
        rows.coalesce(1).write.mode("overwrite").parquet(self.path(self.ledger_name, part.pair))

    # Compaction

    def compacted(self, spark: SparkSession, state: State, streams: list[str] | None = None) -> State:
        """Rewrite parts as one if a level is full, and remove what the compaction before replaced; returns the new state."""
        chosen = to_merge(tuple(p for p in state.parts if _of(p, streams)), self.fan)
        if not chosen:
            return state
        self.begin()
        pair = (COMPACTED, state.sequence)
        old = State(tuple(chosen))
        for name in self.tables():
            if any(name in p.held for p in chosen):
                rows = self.read(spark, name, old)
                # What the merged parts held wholly, the new one does.
                whole = frozenset().union(*[p.whole.get(name, frozenset()) for p in chosen])
                self.write(name, self.reduced.get(name, lambda r: r)(rows), *pair, whole=whole)
        covers: dict[str, int] = {}
        for p in chosen:
            for stream, last in (p.covers or {p.pair[0]: p.pair[1]}).items():
                covers[stream] = max(covers.get(stream, -1), last)
        level = 1 + max(p.level for p in chosen)
        part = Part(pair, state.sequence, level, covers=covers, replaced=tuple(p.pair for p in chosen), **self._taken())
        schema = T.StructType([f for f in self._ledger_schema().fields if f.name not in PAIR])
        batches = self._open(spark, self.ledger_name, self._ledger_schema(), [p.pair for p in chosen]).filter("level = 0")
        self._publish(batches.select(*schema.fieldNames()).unionByName(self._row(spark, part, {})), part)
        after = state.with_part(part)
        self.cleared(spark, after)
        return after

    def cleared(self, spark: SparkSession, state: State, streams: list[str] | None = None) -> None:
        """Remove the folders that no live part names, but those that the newest compaction replaced: a reader may have them open.

        Batches beyond the marks stay, since a writer may be at them. With `streams`, tables lose all other streams' batches too.
        """
        live = {p.pair for p in state.parts}
        newest = max((p for p in state.parts if p.level), key=lambda p: p.sequence, default=None)
        kept = live | set(newest.replaced if newest else ())
        for name in [*self.tables(), self.ledger_name]:
            for stream in files.children(spark, self.path(name)):
                if not stream.startswith("stream_id="):
                    continue
                for batch in files.children(spark, f"{self.path(name)}/{stream}"):
                    if not batch.startswith("batch_id="):
                        continue
                    pair = (stream.removeprefix("stream_id="), int(batch.removeprefix("batch_id=")))
                    last = state.sequence - 1 if pair[0] == COMPACTED else state.marks.get(pair[0], -1)
                    other = streams is not None and name != self.ledger_name and pair[0] not in (*streams, COMPACTED)
                    if pair[1] <= last and (pair not in kept or other):
                        files.remove(spark, self.path(name, pair))


def _of(part: Part, streams: list[str] | None) -> bool:
    """Whether all that the part holds is of the streams."""
    return streams is None or set(part.covers or [part.pair[0]]) <= set(streams)


def _part(row) -> Part:
    held: dict[str, dict[str, Range]] = {}
    for h in row["held"]:
        columns = held.setdefault(h["table"], {})
        if h["column"]:
            columns[h["column"]] = (h["low"], h["high"])
    replaced = tuple((r["stream_id"], r["batch_id"]) for r in row["replaced"])
    whole = {t: frozenset(values) for t, values in (row["whole"] or {}).items()}
    return Part(tuple(row["of"]), row["sequence"], row["level"], held, row["covers"] or {}, replaced, whole)

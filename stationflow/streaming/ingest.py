"""Micro-batch ingest: check, quarantine, deduplicate, insert if absent, and keep a ledger."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stationflow import schemas
from stationflow.operators.keyed import absent_from, first_per_key, first_with_last_position, latest_per_key
from stationflow.operators.ordered import numbered
from stationflow.plans import validate
from stationflow.session import configure
from stationflow.sources.messages import INFORMATION_TOPIC, STATUS_TOPIC
from stationflow.streaming.store import FAN, BatchStore, Range, State

READING_KEY = ["station_id", "last_reported"]
ARRIVAL = ["kafka_partition", "kafka_offset"]


def raw_store(root: str, fan: int = FAN) -> BatchStore:
    return BatchStore(
        root,
        "ingest_batches",
        {
            "station_status": schemas.STATION_STATUS,
            "station_information": schemas.STATION_INFORMATION_LOG,
            "rejected_messages": schemas.REJECTED_MESSAGES,
            "ingest_batches": schemas.INGEST_BATCHES,
        },
        by={"station_status": ["date"]},
        zones={"station_status": ["status_id", "last_reported", "ingested_at"], "rejected_messages": ["rejected_at"]},
        reduced={"station_information": kept_information},
        fan=fan,
    )


def current_information(log: DataFrame, order_by: str = "arrival") -> DataFrame:
    """Current description of each station from the append log.

    The last arrival wins, or with order_by="feed_last_updated" the newest snapshot.
    """
    arrival = ["sequence", *ARRIVAL]
    order = arrival if order_by == "arrival" else [order_by, *arrival]
    return latest_per_key(log, ["station_id"], order)


def kept_information(log: DataFrame) -> DataFrame:
    """The rows of the log that `current_information` can still give, in either order."""
    by_arrival, by_snapshot = (F.struct(*order) for order in (["sequence", *ARRIVAL], ["feed_last_updated", "sequence", *ARRIVAL]))
    row = F.struct(*log.columns)
    last = log.groupBy("station_id").agg(F.max_by(row, by_arrival).alias("one"), F.max_by(row, by_snapshot).alias("two"))
    rows = F.when(F.col("one").eqNullSafe(F.col("two")), F.array("one")).otherwise(F.array("one", "two"))
    return last.select(F.inline(rows))


def spread(messages: DataFrame) -> DataFrame:
    """The messages dealt evenly over the tasks: a file of one row group, or a topic of few partitions, would keep the checks in few."""
    return messages.repartition("partition", "offset")


class Ingest:
    """The body of the ingest query, for use with `foreachBatch`. One writer per store.

    `decode` turns the source's rows into messages; `block_bits` sets how many offsets are
    numbered together (2 ** block_bits of them hold the rows of one task). Closed batches are compacted as they add up.
    """

    def __init__(
        self,
        store: BatchStore,
        stream_id: str,
        status_topic: str = STATUS_TOPIC,
        information_topic: str = INFORMATION_TOPIC,
        position: str = "first",
        decode: Callable[[DataFrame], DataFrame] | None = None,
        block_bits: int = 16,
        clock: Callable[[], datetime] = lambda: datetime.now(UTC),
    ):
        if position not in ("first", "last"):
            raise ValueError("position must be first or last")
        self.store = store
        self.stream_id = stream_id
        self.check = validate.Checker(status_topic, information_topic)
        self.position = position
        self.decode = decode
        self.block = F.shiftright("kafka_offset", block_bits)
        self.clock = clock
        self.state: State | None = None
        self.last_status_id = 0
        self.last_rejected_id = 0

    def _load_state(self, spark: SparkSession) -> None:
        """Live parts and last numbers, read from the ledger once for each start."""
        if self.state is not None:
            return
        state = self.store.writer_state(spark)
        last = self.store.ledger(spark, state).agg(F.max("last_status_id"), F.max("last_rejected_id")).first()
        self.last_status_id, self.last_rejected_id = last[0] or 0, last[1] or 0
        self.state = state

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = configure(batch.sparkSession)
        self._load_state(spark)
        if batch_id <= self.state.marks.get(self.stream_id, -1):
            return  # committed before the checkpoint could note it
        self.store.begin()
        started = self.clock()
        messages = self.decode(batch) if self.decode else spread(batch)
        judged = self.check(messages).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._write(spark, judged, batch_id, started)
        finally:
            judged.unpersist()

    def _write(self, spark: SparkSession, judged: DataFrame, batch_id: int, started: datetime) -> None:
        seen = judged.agg(
            F.count(F.lit(1)).alias("received"),
            F.count("error").alias("invalid"),
            F.count("status").alias("status_valid"),
            F.count("information").alias("informations"),
            F.min("status.last_reported").alias("first_reported"),
            F.max("status.last_reported").alias("last_reported"),
        ).first()
        if seen["received"] == 0:
            return
        written_at = self.clock()
        now = F.lit(written_at)
        inserted = 0
        if seen["status_valid"]:
            inserted = self._write_statuses(spark, judged, batch_id, seen, now)
        if seen["informations"]:
            latest = latest_per_key(validate.valid_informations(judged), ["station_id"], ARRIVAL)
            latest = latest.withColumns({"updated_at": now, "sequence": F.lit(self.state.sequence)})
            self.store.write("station_information", latest, self.stream_id, batch_id)
        if seen["invalid"]:
            bad = self._numbered(validate.rejected(judged), [*ARRIVAL, "topic"], "rejected_id", self.last_rejected_id)
            bad = bad.withColumn("rejected_at", now)
            self.store.write("rejected_messages", bad, self.stream_id, batch_id)
        self.last_status_id += inserted
        self.last_rejected_id += seen["invalid"]
        state = self.store.commit(
            spark,
            self.state,
            self.stream_id,
            batch_id,
            {
                "started_at": started,
                "finished_at": self.clock(),
                "received": seen["received"],
                "invalid": seen["invalid"],
                "status_valid": seen["status_valid"],
                "status_inserted": inserted,
                "status_duplicates": seen["status_valid"] - inserted,
                "information_upserted": seen["informations"],
                "ingested_at": written_at if inserted else None,
                "last_status_id": self.last_status_id,
                "last_rejected_id": self.last_rejected_id,
            },
        )
        self.state = self.store.compacted(spark, state)

    def _numbered(self, rows: DataFrame, order: list[str], out: str, start: int) -> DataFrame:
        first, *rest = order
        return numbered(rows.withColumn("_block", self.block), [first, "_block"], rest, out, start)

    def _write_statuses(self, spark: SparkSession, judged: DataFrame, batch_id: int, seen, now: Column) -> int:
        valid = validate.valid_statuses(judged)
        if self.position == "first":
            unique = first_per_key(valid, READING_KEY, [F.col(c) for c in ARRIVAL])
        else:
            unique = first_with_last_position(valid, READING_KEY, ARRIVAL, ARRIVAL)
        unique = unique.withColumn("date", F.to_date("last_reported"))
        stored = self._stored(spark, valid, seen)
        fresh = absent_from(unique, stored, READING_KEY)
        fresh = fresh.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            inserted = fresh.count()
            if inserted:
                rows = self._numbered(fresh, ARRIVAL, "status_id", self.last_status_id)
                rows = rows.withColumn("ingested_at", now)
                self.store.write("station_status", rows, self.stream_id, batch_id)
        finally:
            fresh.unpersist()
        return inserted

    def _stored(self, spark: SparkSession, valid: DataFrame, seen) -> DataFrame:
        """Committed readings that can share a key with the batch's, which lie between its first and last time.

        The ledger names the parts that hold such times; nothing else is listed or opened, however many batches there have been.
        Within a part, the join on the date lets Spark prune the partitions to the days that occur, however far apart they are.
        """
        between = {"last_reported": (seen["first_reported"], seen["last_reported"])}
        stored = self.store.read(spark, "station_status", self.state, between)
        days = valid.select(F.to_date("last_reported").alias("date")).distinct()
        return stored.join(days, "date", "left_semi")


def stream_name(checkpoint: str) -> str:
    """A stream id that is fixed for each checkpoint, because batch numbers restart with a new one."""
    return hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def start_ingest(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    every: str | None = None,
    fan: int = FAN,
    **options,
) -> StreamingQuery:
    """Start the ingest query. Without `every` it takes what is there and stops; "5 seconds" keeps it running.

    Several sources go through one query, as a union: two writers could both insert one key.
    """
    ingest = Ingest(raw_store(root, fan), stream_name(checkpoint), **options)
    writer = stream.writeStream.foreachBatch(ingest).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def raw_tables(spark: SparkSession, root: str, order_by: str = "arrival", ingested: Range = (None, None)) -> dict[str, DataFrame]:
    """The committed raw tables; readings and rejected messages only of the given range of write times, both ends included.

    With a range, the ledger names the parts to open: a panel over one hour reads what that hour's batches wrote.
    """
    store = raw_store(root)
    state = store.state(spark)
    log = store.read(spark, "station_information", state)
    return {
        "station_status": store.read(spark, "station_status", state, {"ingested_at": ingested}),
        "station_information": current_information(log, order_by),
        "rejected_messages": store.read(spark, "rejected_messages", state, {"rejected_at": ingested}),
        "ingest_batches": store.ledger(spark, state),
    }

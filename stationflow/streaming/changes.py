"""Change detection on a stream of descriptions.

Beside the log of changes, the store keeps the last digest of each station, dealt to buckets by a hash of the station. Each
micro-batch is compared inside itself first, and the first row of each station with that state, of which only the
buckets of the batch's stations are read. A batch adds the digests it changed, and compaction reduces them to one a station, so
what a batch reads grows with the stations and not with the history. Unlike digests kept in a process, the state survives a restart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stationflow.functions import documents as D
from stationflow.operators.changes import block_of
from stationflow.operators.keyed import latest_per_key
from stationflow.operators.ordered import with_previous
from stationflow.session import configure
from stationflow.streaming.ingest import stream_name
from stationflow.streaming.store import FAN, BatchStore, State

_PAIR = [T.StructField("stream_id", T.StringType()), T.StructField("batch_id", T.LongType())]

ARRIVAL = ["sequence", "partition", "offset"]

CHANGES = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("digest", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("sequence", T.LongType()),
        *_PAIR,
    ]
)
LATEST = T.StructType([*[f for f in CHANGES.fields if f.name not in ("value", "stream_id", "batch_id")], T.StructField("bucket", T.IntegerType()), *_PAIR])
BATCHES = T.StructType([T.StructField("changes", T.LongType()), *_PAIR])

# Buckets of the state: a batch of few stations reads the files of their buckets only.
BUCKETS = 32


def change_store(root: str, fan: int = FAN) -> BatchStore:
    return BatchStore(
        root,
        "change_batches",
        {"changes": CHANGES, "latest": LATEST, "change_batches": BATCHES},
        by={"latest": ["bucket"]},
        reduced={"latest": last_digests},
        fan=fan,
    )


def bucket_of(key: str) -> Column:
    return F.pmod(F.hash(key), F.lit(BUCKETS)).cast("int")


def last_digests(rows: DataFrame) -> DataFrame:
    return latest_per_key(rows, ["bucket", "key"], ARRIVAL)


class Changes:
    """The body of the change query, for use with `foreachBatch`."""

    def __init__(self, store: BatchStore, stream_id: str):
        self.store = store
        self.stream_id = stream_id
        self.state: State | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = configure(batch.sparkSession)
        if self.state is None:
            self.state = self.store.writer_state(spark)
        if batch_id <= self.state.marks.get(self.stream_id, -1):
            return
        self.store.begin()
        text = F.col("value").cast("string")
        hashed = batch.select(
            "key", text.alias("value"), F.struct(D.digest(D.parse(text)).alias("d")).alias("state"), "partition", "offset"
        ).persist()
        try:
            if hashed.isEmpty():
                return
            found = self._changed(spark, hashed).withColumns({"digest": F.col("state.d"), "sequence": F.lit(self.state.sequence)}).persist()
            changes = self.store.write("changes", found, self.stream_id, batch_id)
            self.store.write("latest", last_digests(found.withColumn("bucket", bucket_of("key"))), self.stream_id, batch_id)
            found.unpersist()
        finally:
            hashed.unpersist()
        state = self.store.commit(spark, self.state, self.stream_id, batch_id, {"changes": changes})
        self.state = self.store.compacted(spark, state)

    def _changed(self, spark: SparkSession, hashed: DataFrame) -> DataFrame:
        """Rows that differ from the row before them; only a station's first row asks the state. A null key is a key."""
        here = hashed.select(bucket_of("key").alias("bucket"), F.col("key").alias("here")).distinct()
        last = self.store.read(spark, "latest", self.state).select("bucket", "key", "digest", *ARRIVAL)
        # The join on the bucket prunes partitions; the one on the key cuts rows before they are sorted.
        last = last.join(here.select("bucket").distinct(), "bucket", "left_semi")
        mine = last.join(here.select("here"), F.col("key").eqNullSafe(F.col("here")), "left_semi")
        known = last_digests(mine).select(F.col("key").alias("of"), F.struct(F.col("digest").alias("d")).alias("known"))
        compared = with_previous(hashed, ["key"], block_of("offset"), ["offset"], "state", "before")
        inside = compared.filter(F.col("before").isNotNull() & ~F.col("state").eqNullSafe(F.col("before")))
        first = compared.filter(F.col("before").isNull()).join(known, F.col("key").eqNullSafe(F.col("of")), "left")
        first = first.filter(~F.col("state").eqNullSafe(F.col("known"))).drop("known", "of")
        return inside.unionByName(first)


def start_changes(stream: DataFrame, root: str, checkpoint: str, every: str | None = None, fan: int = FAN) -> StreamingQuery:
    body = Changes(change_store(root, fan), stream_name(checkpoint))
    writer = stream.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()

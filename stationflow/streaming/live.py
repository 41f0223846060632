"""Live five-minute series of the message stream, with exact distinct stations.

The stream's state counts the messages of each window and station; every micro-batch writes the pairs that it changed. A window is
the sum of the latest state of its pairs, so stations are counted exactly and without a bound on lateness, for which
chained aggregations of a stream would need a watermark. Compaction reduces the pairs to one row each.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stationflow.operators.keyed import latest_per_key
from stationflow.session import configure
from stationflow.streaming.ingest import stream_name
from stationflow.streaming.store import FAN, BatchStore, Range, State

_PAIR = [T.StructField("stream_id", T.StringType()), T.StructField("batch_id", T.LongType())]
PAIRS = T.StructType(
    [
        T.StructField("time", T.TimestampType()),
        T.StructField("station", T.StringType()),
        T.StructField("messages", T.LongType()),
        T.StructField("sequence", T.LongType()),
        *_PAIR,
    ]
)
BATCHES = T.StructType([T.StructField("written_at", T.TimestampType()), *_PAIR])


def series_store(root: str, fan: int = FAN) -> BatchStore:
    schemas = {"pairs": PAIRS, "series_batches": BATCHES}
    return BatchStore(root, "series_batches", schemas, zones={"pairs": ["time"]}, reduced={"pairs": latest_pairs}, fan=fan)


def latest_pairs(rows: DataFrame) -> DataFrame:
    return latest_per_key(rows, ["time", "station"], ["sequence"])


def windowed(messages: DataFrame, minutes: int = 5, lateness: str | None = None) -> DataFrame:
    """Messages of each station in tumbling windows on the message time; a null key is a station of no number.

    Without `lateness` no message is ever too late and one small row is kept for each window and station;
    with it, windows older than the watermark leave the state.
    """
    rows = messages.withWatermark("timestamp", lateness) if lateness else messages
    counted = rows.groupBy(F.window("timestamp", f"{minutes} minutes").alias("w"), F.col("key").alias("station"))
    return counted.agg(F.count(F.lit(1)).alias("messages")).select(F.col("w.start").alias("time"), "station", "messages")


def start_series(stream: DataFrame, root: str, checkpoint: str, every: str | None = None, fan: int = FAN, **options) -> StreamingQuery:
    """Write every changed pair of a micro-batch; `series` adds up the newest state of each."""
    store, stream_id = series_store(root, fan), stream_name(checkpoint)
    held: list[State] = []

    def body(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = held.pop() if held else store.writer_state(spark)
        if batch_id > state.marks.get(stream_id, -1):
            store.begin()
            store.write("pairs", batch.withColumn("sequence", F.lit(state.sequence)), stream_id, batch_id)
            state = store.commit(spark, state, stream_id, batch_id, {"written_at": datetime.now(UTC)})
            state = store.compacted(spark, state)
        held.append(state)

    writer = windowed(stream, **options).writeStream.outputMode("update").foreachBatch(body)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def series(spark: SparkSession, root: str, between: Range = (None, None)) -> DataFrame:
    """Messages and distinct stations of each window; of a range of window starts, both ends included, if asked."""
    pairs = latest_pairs(series_store(root).read(configure(spark), "pairs", within={"time": between}))
    return pairs.groupBy("time").agg(F.sum("messages").alias("messages"), F.count("station").alias("stations"))

"""Message sources and sinks. Every source delivers the columns of `schemas.MESSAGE`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.schemas import MESSAGE

STATUS_TOPIC = "station_status"
INFORMATION_TOPIC = "station_information"


def message_files(
    spark: SparkSession, path: str, streaming: bool = False, files_per_batch: int | None = None
) -> DataFrame:
    """Landed message files (Parquet), as a batch or as a stream bounded by files per micro-batch."""
    reader = (spark.readStream if streaming else spark.read).schema(MESSAGE)
    if streaming and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topics: tuple[str, ...] = (STATUS_TOPIC, INFORMATION_TOPIC),
    offsets_per_batch: int | None = None,
    streaming: bool = True,
) -> DataFrame:
    """Subscribe to the topics from the earliest offset; needs the Kafka connector on the class path.

    A batch takes all there is, or at most `offsets_per_batch`. Offsets are kept in the query's checkpoint, and partition end marks never reach a query.
    """
    reader = (
        (spark.readStream if streaming else spark.read)
        .format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
    )
    if streaming and offsets_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", offsets_per_batch)
    rows = reader.load()
    return rows.select([F.col(f.name).cast(f.dataType) for f in MESSAGE.fields])


def as_messages(
    rows: DataFrame, topic: str, key: Column, body: Column, position: Column, at: Column, partition: Column | None = None
) -> DataFrame:
    """Rows in the message contract; `body` is a struct, map or VARIANT that becomes the JSON value."""
    part = F.lit(0) if partition is None else partition
    return rows.select(
        key.cast("string").alias("key"),
        F.to_json(body).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        part.cast("int").alias("partition"),
        position.cast("long").alias("offset"),
        at.cast("timestamp").alias("timestamp"),
    )


def publish_files(messages: DataFrame, path: str) -> None:
    """Append messages to a folder that `message_files` reads, one sub-folder for each topic."""
    messages.select(*MESSAGE.fieldNames()).write.mode("append").partitionBy("topic").parquet(path)


def publish_kafka(messages: DataFrame, servers: str) -> None:
    """Append messages to their topics, keyed so that a station keeps its partition."""
    (
        messages.select("topic", "key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("kafka.enable.idempotence", "true")
        .option("kafka.compression.type", "zstd")
        .option("kafka.linger.ms", "50")
        .save()
    )

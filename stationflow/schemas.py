"""Fixed schemas of the message contract and the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The columns of Spark's Kafka source; every other message source delivers the same.
MESSAGE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

STATUS_RECORD = T.StructType(
    [
        T.StructField("station_id", T.StringType()),
        T.StructField("last_reported", T.TimestampType()),
        T.StructField("num_bikes_available", T.IntegerType()),
        T.StructField("num_docks_available", T.IntegerType()),
        T.StructField("is_installed", T.BooleanType()),
        T.StructField("is_renting", T.BooleanType()),
        T.StructField("is_returning", T.BooleanType()),
        T.StructField("vehicle_types_available", T.VariantType()),
        T.StructField("feed_last_updated", T.TimestampType()),
        T.StructField("fetched_at", T.TimestampType()),
        T.StructField("is_replay", T.BooleanType()),
    ]
)

INFORMATION_RECORD = T.StructType(
    [
        T.StructField("station_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("capacity", T.IntegerType()),
        T.StructField("is_virtual_station", T.BooleanType()),
        T.StructField("feed_last_updated", T.TimestampType()),
    ]
)

_PAIR = [T.StructField("stream_id", T.StringType()), T.StructField("batch_id", T.LongType())]
_TRANSPORT = [T.StructField("kafka_partition", T.IntegerType()), T.StructField("kafka_offset", T.LongType())]

STATION_STATUS = T.StructType(
    [
        T.StructField("status_id", T.LongType()),
        *STATUS_RECORD.fields,
        *_TRANSPORT,
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("date", T.DateType()),
        *_PAIR,
    ]
)

STATION_INFORMATION_LOG = T.StructType(
    [*INFORMATION_RECORD.fields, *_TRANSPORT, T.StructField("updated_at", T.TimestampType()), T.StructField("sequence", T.LongType()), *_PAIR]
)

REJECTED_MESSAGES = T.StructType(
    [
        T.StructField("rejected_id", T.LongType()),
        T.StructField("topic", T.StringType()),
        *_TRANSPORT,
        T.StructField("payload", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("rejected_at", T.TimestampType()),
        *_PAIR,
    ]
)

INGEST_BATCHES = T.StructType(
    [
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("received", T.LongType()),
        T.StructField("invalid", T.LongType()),
        T.StructField("status_valid", T.LongType()),
        T.StructField("status_inserted", T.LongType()),
        T.StructField("status_duplicates", T.LongType()),
        T.StructField("information_upserted", T.LongType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("last_status_id", T.LongType()),
        T.StructField("last_rejected_id", T.LongType()),
        *_PAIR,
    ]
)


class SchemaDrift(ValueError):
    """A load whose columns differ from its target's."""


def require_same_schema(new: DataFrame, target: T.StructType) -> DataFrame:
    """Refuse a load when names, types or their order differ from the target (nullability may)."""
    have = [(f.name, f.dataType.simpleString()) for f in new.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in target.fields]
    if have != want:
        gone = [c for c in want if c not in have]
        added = [c for c in have if c not in want]
        raise SchemaDrift(f"columns differ from the target: missing {gone}, unexpected {added}")
    return new

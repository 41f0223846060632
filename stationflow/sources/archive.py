"""Archived feed snapshots: JSON Lines files, one snapshot for each line.

A line is {"fetched_at": ..., "status": envelope} in station_status_<day>.jsonl[.gz], or
{"fetched_at": ..., "information": envelope} in station_information_<day>.jsonl[.gz].
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.functions import documents as D
from stationflow.operators.ordered import numbered_in_place
from stationflow.sources.messages import INFORMATION_TOPIC, STATUS_TOPIC

STATUS = "status"
INFORMATION = "information"

# Arrival order of archive lines: file name, then split, then line within the split.
LINE_ORDER = ["file_name", "block", "line"]

_FILE = r"^station_(status|information)_.*\.jsonl(\.gz)?$"


def archive_lines(
    spark: SparkSession, folder: str, streaming: bool = False, files_per_batch: int | None = None
) -> DataFrame:
    """Scan the snapshot files of a folder; the name decides the kind of each line.

    A stream lacks `line`, which `positioned` adds inside the micro-batch.
    """
    reader = (spark.readStream if streaming else spark.read).option("pathGlobFilter", "station_*_*.jsonl*")
    if streaming and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.text(folder).select(
        F.regexp_extract("_metadata.file_name", _FILE, 1).alias("kind"),
        "value",
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    lines = lines.filter(F.col("kind") != "")
    return lines if streaming else positioned(lines)


def positioned(lines: DataFrame) -> DataFrame:
    """Add `line`, which rises by one from line to line of each split of a file."""
    return lines.withColumn("line", F.monotonically_increasing_id())


def snapshots(lines: DataFrame, needs_ttl: bool = True) -> DataFrame:
    """Decode envelopes to (last_updated, ttl, stations); a broken one keeps its first error instead.

    A replay needs the whole envelope; the analysis of an archive asks for no ttl.
    """
    doc = lines.withColumn("_doc", D.parse(F.col("value")))
    env = doc.withColumn(
        "_env", F.when(F.col("kind") == STATUS, D.get(F.col("_doc"), STATUS)).otherwise(D.get(F.col("_doc"), INFORMATION))
    )
    fields = {"last_updated": "last_updated", "ttl": "ttl", "stations": "data.stations"}
    for name, path in fields.items():
        env = env.withColumn(f"_{name}", D.get(F.col("_env"), path))
    kinds = env.withColumns({f"_k_{name}": D.kind(F.col(f"_{name}")) for name in fields})

    def missing(name: str):
        return F.col(f"_k_{name}") == D.ABSENT

    def not_whole(name: str):
        return F.col(f"_k_{name}") != "BIGINT"

    rules = [
        (F.col("_doc").isNull(), "line is not JSON"),
        (missing("last_updated"), "incomplete envelope: last_updated"),
        (not_whole("last_updated"), "last_updated: integer wanted"),
        (D.as_long(F.col("_last_updated")) < 1, "last_updated: must be >= 1"),
    ]
    if needs_ttl:
        rules += [
            (missing("ttl"), "incomplete envelope: ttl"),
            (not_whole("ttl"), "ttl: integer wanted"),
            (D.as_long(F.col("_ttl")) < 0, "ttl: must be >= 0"),
        ]
    rules += [
        (missing("stations"), "incomplete envelope: data.stations"),
        (F.col("_k_stations") != "ARRAY", "data.stations: list wanted"),
    ]
    error = F.coalesce(*[F.when(broken, F.lit(text)) for broken, text in rules])
    return kinds.select(
        *lines.columns,
        D.get(F.col("_doc"), "fetched_at").alias("fetched_at"),
        D.as_long(F.col("_last_updated")).alias("last_updated"),
        D.as_long(F.col("_ttl")).alias("ttl"),
        F.try_variant_get("_stations", "$", "array<variant>").alias("stations"),
        D.settled(error).alias("source_error"),
    )


def snapshot_messages(snaps: DataFrame, order: list[str], replay: bool = True) -> DataFrame:
    """One message for each station of a good snapshot, one rejected line for each broken one.

    Status messages carry the snapshot's `last_updated` and `fetched_at` (and the replay flag);
    descriptions carry `last_updated`. A station's own field of the same name is overwritten.
    """
    fine = F.col("source_error").isNull()
    # A broken line stays one row, so that every line is decoded once only.
    listed = F.when(fine, F.col("stations")).otherwise(F.array(F.lit(None).cast("variant")))
    rows = snaps.select(
        "kind", *order, "value", "source_error", "last_updated", "fetched_at", F.posexplode(listed).alias("pos", "_station")
    )
    added = {"feed_last_updated": F.col("last_updated").cast("variant")}
    timed = {**added, "fetched_at": F.col("fetched_at")}
    if replay:
        timed["replay"] = F.lit(True).cast("variant")

    def spread(extra: dict) -> Column:
        own = F.map_filter("_fields", lambda k, _: ~k.isin(*extra))
        pairs = [c for name, value in extra.items() for c in (F.lit(name), value)]
        return F.to_variant_object(F.map_concat(own, F.create_map(*pairs)))

    rows = rows.withColumn("_fields", F.try_variant_get("_station", "$", "map<string,variant>"))
    doc = (
        F.when(F.col("_fields").isNull(), F.col("_station"))
        .when(F.col("kind") == STATUS, spread(timed))
        .otherwise(spread(added))
    )
    rows = rows.select(
        "kind",
        *order,
        "pos",
        D.as_text(D.get(F.col("_station"), "station_id")).alias("key"),
        doc.alias("doc"),
        F.when(~fine, F.col("value")).alias("line_text"),
        "source_error",
    )
    topic = F.when(F.col("kind") == STATUS, STATUS_TOPIC).otherwise(INFORMATION_TOPIC)
    return rows.withColumn("topic", topic)


# An offset is a line number with room for the stations of the line; a block of offsets, as the
# ingest numbers them, is then 65 536 lines.
STATION_BITS = 20
BLOCK_BITS = STATION_BITS + 16


def archive_messages(lines: DataFrame, replay: bool = True) -> DataFrame:
    """Archive lines in the message contract: all descriptions first, then statuses, in file order.

    Lines are numbered where they are read, by the counts of the splits before theirs: counting reads text but
    parses nothing, and no text moves. `doc` carries the decoded message, so that it is not written out and parsed again.
    """
    ranked = lines.withColumn("_status", (F.col("kind") == STATUS).cast("int"))
    ranked = numbered_in_place(ranked, ["_status", "file_name", "block"], "line", "_number", start=-1)
    rows = snapshot_messages(snapshots(ranked), ["_number"], replay)
    crowded = F.raise_error(F.lit(f"a line holds more than {1 << STATION_BITS} stations"))
    offset = F.when(F.col("pos") >= 1 << STATION_BITS, crowded).otherwise(F.shiftleft("_number", STATION_BITS) + F.col("pos"))
    return rows.select(
        "key",
        F.coalesce(F.col("line_text"), F.to_json("doc")).cast("binary").alias("value"),
        "topic",
        F.lit(0).alias("partition"),
        offset.alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        "doc",
        "source_error",
    )

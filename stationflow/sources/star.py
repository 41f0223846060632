"""The feed's tables as projections of the star-schema test tables.

No test table holds station data, so `events` is read as the status feed and `nation` as the
station descriptions, by whole-number arithmetic that any SQL engine repeats exactly. 25 of the
52 stations are described, so orphans and late descriptions exist.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow import files
from stationflow.operators.keyed import first_per_key
from stationflow.plans import models
from stationflow.session import work_dir
from stationflow.sources.faults import KINDS, OTHER_TOPIC
from stationflow.sources.messages import INFORMATION_TOPIC, STATUS_TOPIC, as_messages

STATIONS = 52
PLACES = 12
BATCH_MESSAGES = 500
# The hour of the day whose readings are delivered again.
MENDED_HOUR = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def status_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a valid status reading, duplicates included."""
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    bikes = F.floor("value").cast("int") % (PLACES + 1)
    reported = F.date_trunc("minute", "ts")
    return events.select(
        F.col("event_id").alias("status_id"),
        F.lpad((F.col("user_id") % STATIONS).cast("string"), 3, "0").alias("station_id"),
        reported.alias("last_reported"),
        bikes.alias("num_bikes_available"),
        (F.lit(PLACES) - bikes).alias("num_docks_available"),
        (F.col("event_type") != "signup").alias("is_installed"),
        F.lit(True).alias("is_renting"),
        F.lit(True).alias("is_returning"),
        reported.alias("feed_last_updated"),
        F.col("ts").alias("fetched_at"),
        (F.col("ts") + F.expr("INTERVAL 3 SECONDS")).alias("ingested_at"),
        (F.col("event_type") == "error").alias("is_replay"),
    )


def station_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings: the first message of each station and report time."""
    return first_per_key(status_messages(spark, sf_dir), ["station_id", "last_reported"], [F.col("status_id")])


def station_information(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    described = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return nation.select(
        F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("station_id"),
        F.col("n_name").alias("name"),
        (F.lit(43.4) + F.col("n_nationkey") / F.lit(50.0)).alias("lat"),
        (F.lit(3.6) + F.col("n_regionkey") / F.lit(10.0)).alias("lon"),
        (F.lit(8) + F.col("n_regionkey")).alias("capacity"),
        F.lit(False).alias("is_virtual_station"),
        described.alias("feed_last_updated"),
        described.alias("updated_at"),
    )


def ingest_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of the messages written in batches of 500."""
    judged = status_messages(spark, sf_dir)
    batch = F.expr(f"status_id div {BATCH_MESSAGES}")
    per_key = judged.groupBy("station_id", "last_reported").agg(F.min("status_id").alias("status_id"))
    inserted = per_key.groupBy(batch.alias("batch_id")).agg(F.count(F.lit(1)).alias("status_inserted"))
    received = judged.groupBy(batch.alias("batch_id")).agg(
        F.count(F.lit(1)).alias("received"),
        F.min("ingested_at").alias("started_at"),
        F.max("ingested_at").alias("finished_at"),
    )
    inserted_or_none = F.coalesce(F.col("status_inserted"), F.lit(0))
    return received.join(inserted, "batch_id", "left").select(
        "batch_id",
        "started_at",
        "finished_at",
        "received",
        F.lit(0).cast("long").alias("invalid"),
        F.col("received").alias("status_valid"),
        inserted_or_none.cast("long").alias("status_inserted"),
        (F.col("received") - inserted_or_none).cast("long").alias("status_duplicates"),
        F.lit(0).cast("long").alias("information_upserted"),
    )


class Tables(Mapping):
    """Raw tables, staging, fact and marts over the projections; each is planned when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._plans = {
            "station_status": lambda: station_status(spark, sf_dir),
            "station_information": lambda: station_information(spark, sf_dir),
            "ingest_batches": lambda: ingest_batches(spark, sf_dir),
            "stg_station_status": lambda: models.staged_status(self["station_status"]),
            "stg_station_information": lambda: models.staged_information(self["station_information"]),
            "dim_station": lambda: models.station_dimension(self["stg_station_information"]),
            "fct_station_status": lambda: models.fact(self["stg_station_status"], self["dim_station"]),
            "hourly_sums": lambda: models.hourly_sums(self["fct_station_status"]),
            "agg_occupation_horaire": lambda: models.station_hours(self["hourly_sums"]),
            "agg_reseau_horaire": lambda: models.network_hours(self["hourly_sums"]),
            "stations_vides_pleines": lambda: models.station_ranking(self["hourly_sums"], self["dim_station"]),
        }
        self._planned: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._planned:
            self._planned[name] = self._plans[name]()
        return self._planned[name]

    def put(self, name: str, rows: DataFrame) -> None:
        """Use other rows for a table, before those that build on it are planned."""
        self._planned = {name: rows}

    def __iter__(self):
        return iter(self._plans)

    def __len__(self) -> int:
        return len(self._plans)


def status_body() -> Column:
    """The JSON body of a status message, as the poller would send it."""
    return F.struct(
        "station_id",
        "num_bikes_available",
        "num_docks_available",
        "is_installed",
        "is_renting",
        "is_returning",
        F.unix_seconds("last_reported").alias("last_reported"),
        F.unix_seconds("feed_last_updated").alias("feed_last_updated"),
        (F.unix_micros("fetched_at") / F.lit(1e6)).alias("fetched_at"),
        F.col("is_replay").alias("replay"),
    )


def feed_messages(spark: SparkSession, sf_dir: str, replayed: bool = False) -> DataFrame:
    """Every event as a valid status message in the transport contract, all of them replayed if asked."""
    rows = status_messages(spark, sf_dir)
    if replayed:
        rows = rows.withColumn("is_replay", F.lit(True))
    return as_messages(
        rows, STATUS_TOPIC, F.col("station_id"), status_body(), F.col("status_id"), F.col("ingested_at")
    )


def information_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stations as description messages."""
    rows = station_information(spark, sf_dir)
    body = F.struct("station_id", "name", "lat", "lon", "capacity", "is_virtual_station", F.unix_seconds("feed_last_updated").alias("feed_last_updated"))
    return as_messages(rows, INFORMATION_TOPIC, F.col("station_id"), body, F.col("station_id").cast("long"), F.col("updated_at"))


def description_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a description: the user as key, the properties as body."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("user_id").cast("string").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.lit(INFORMATION_TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def _with_kinds(right: dict[str, Column], topic: str) -> Column:
    """A JSON object of fields, each as its message's kind has it."""
    pairs = []
    for name, value in right.items():
        given = {k: kind.fields[name] for k, kind in enumerate(KINDS) if kind.topic == topic and name in kind.fields}
        shown = F.concat(F.lit(f'"{name}":'), value)
        for k, text in given.items():
            shown = F.when(F.col("kind") == k, F.lit(None if text is None else f'"{name}":{text}')).otherwise(shown)
        pairs.append(shown)
    return F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))


def mixed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a message of some kind, good or broken, over three topics."""
    rows = status_messages(spark, sf_dir)
    number = F.col("status_id")
    rows = rows.withColumn("kind", (number % len(KINDS)).cast("int"))
    text = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    seen = F.unix_seconds("feed_last_updated").cast("string")
    bikes, docks = (F.col(c).cast("string") for c in ("num_bikes_available", "num_docks_available"))
    status = {
        "station_id": text(F.col("station_id")),
        "num_bikes_available": bikes,
        "num_docks_available": docks,
        "is_installed": F.lit("true"),
        "is_renting": F.lit("true"),
        "is_returning": F.lit("true"),
        "last_reported": F.unix_seconds("last_reported").cast("string"),
        "vehicle_types_available": F.lit("[]"),
        "replay": F.lit("false"),
        "fetched_at": F.unix_seconds("fetched_at").cast("string"),
        "feed_last_updated": seen,
    }
    information = {
        "station_id": text(F.col("station_id")),
        "name": text(F.concat(F.lit(" Station "), F.col("station_id"), F.lit(" "))),
        "lat": F.lit("43.6"),
        "lon": F.lit("3.9"),
        "capacity": bikes,
        "is_virtual_station": F.lit("false"),
        "feed_last_updated": seen,
    }
    of_topic = {t: [k for k, kind in enumerate(KINDS) if kind.topic == t] for t in (INFORMATION_TOPIC, OTHER_TOPIC)}
    built = F.when(F.col("kind").isin(of_topic[INFORMATION_TOPIC]), _with_kinds(information, INFORMATION_TOPIC))
    value = built.otherwise(_with_kinds(status, STATUS_TOPIC)).cast("binary")
    for k, kind in enumerate(KINDS):
        if kind.raw != "as built":
            value = F.when(F.col("kind") == k, F.lit(kind.raw).cast("binary")).otherwise(value)
    topic = F.lit(STATUS_TOPIC)
    for name, of in of_topic.items():
        topic = F.when(F.col("kind").isin(of), F.lit(name)).otherwise(topic)
    return rows.select(
        F.col("station_id").alias("key"),
        value.alias("value"),
        topic.alias("topic"),
        F.lit(0).alias("partition"),
        number.alias("offset"),
        F.col("ingested_at").alias("timestamp"),
    )


TTL = 60
REPEATED_POLL = 7
# Every so many minutes, a line that broke off and a line without ttl follow in a damaged archive.
CUT_LINE, NO_TTL = 11, 13


def archive_text(spark: SparkSession, sf_dir: str, damaged: bool = False) -> DataFrame:
    """(file_name, at, value): the readings as archived snapshots, a line for each minute, and the stations as one description line.

    Every seventh minute is polled twice. A minute holds at most one reading of each station. Days with an odd number are compressed.
    """
    readings = station_status(spark, sf_dir)
    station = F.struct("station_id", "num_bikes_available", "num_docks_available", "is_installed", "is_renting",
                       "is_returning", F.unix_seconds("last_reported").alias("last_reported"))
    minute = F.unix_seconds("last_reported")
    shots = readings.groupBy("last_reported").agg(
        F.sort_array(F.collect_list(station)).alias("stations"), F.max("fetched_at").alias("seen")
    )
    first = (F.unix_micros("seen") / F.lit(1e6)).cast("double")
    repeated = F.expr(f"(unix_seconds(last_reported) div 60) % {REPEATED_POLL} = 0")
    polls = F.when(repeated, F.array(first, first + 10)).otherwise(F.array(first))
    whole = shots.select("last_reported", "stations", F.explode(polls).alias("fetched_at"))
    lines = whole.select("last_reported", "fetched_at", _line(minute, F.lit(TTL)).alias("value"))
    if damaged:
        number = F.expr("unix_seconds(last_reported) div 60")
        rows = shots.select("last_reported", "stations", first.alias("fetched_at"))
        line = _line(minute, F.lit(None).cast("int"))
        cut = rows.filter(number % CUT_LINE == 0).select("last_reported", F.lit(0.0).alias("fetched_at"), F.left(line, F.lit(40)).alias("value"))
        lines = lines.unionByName(cut).unionByName(rows.filter(number % NO_TTL == 0).select("last_reported", "fetched_at", line.alias("value")))
    suffix = F.when(F.dayofmonth("last_reported") % 2 == 1, ".jsonl.gz").otherwise(".jsonl")
    name = F.concat(F.lit("station_status_"), F.date_format("last_reported", "yyyy-MM-dd"), suffix)
    described = station_information(spark, sf_dir)
    station = F.struct("station_id", "name", "lat", "lon", "capacity", "is_virtual_station")
    one = described.agg(F.sort_array(F.collect_list(station)).alias("stations"), F.max("feed_last_updated").alias("at"))
    envelope = _envelope(F.unix_seconds("at"), F.lit(TTL))
    information = one.select(
        F.lit("station_information_2024-01-01.jsonl").alias("file_name"),
        F.lit(0.0).alias("at"),
        F.to_json(F.struct(F.lit(1.0).alias("fetched_at"), envelope.alias("information"))).alias("value"),
    )
    return lines.select(name.alias("file_name"), F.col("fetched_at").alias("at"), "value").unionByName(information)


def archive_folder(spark: SparkSession, sf_dir: str, damaged: bool = False) -> str:
    """A folder with the files of the archive, each written by one task, under the names that a poller gives them."""
    folder = work_dir(spark, "archive")
    text = archive_text(spark, sf_dir, damaged)
    for compression, chosen in (("none", ~F.col("file_name").endswith(".gz")), ("gzip", F.col("file_name").endswith(".gz"))):
        made = f"{folder}/made-{compression}"
        rows = text.filter(chosen).repartition("file_name").sortWithinPartitions("file_name", "at", "value")
        rows.select("value", "file_name").write.option("compression", compression).partitionBy("file_name").text(made)
        for name in files.children(spark, made):
            if name.startswith("file_name="):
                (part,) = [f for f in files.children(spark, f"{made}/{name}") if f.startswith("part-")]
                files.rename(spark, f"{made}/{name}/{part}", f"{folder}/lines/{name.removeprefix('file_name=')}")
    return f"{folder}/lines"


def _line(updated: Column, ttl: Column) -> Column:
    return F.to_json(F.struct("fetched_at", _envelope(updated, ttl).alias("status")))


def _envelope(updated: Column, ttl: Column) -> Column:
    """The snapshot of a poll; a null ttl is left out."""
    return F.struct(updated.alias("last_updated"), ttl.alias("ttl"), F.struct("stations").alias("data"))

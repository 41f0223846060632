"""Monitoring panels. Ranges and the current time are parameters, so a panel can be reproduced."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.functions import times as T
from stationflow.operators.percentiles import exact_percentiles, seconds
from stationflow.plans.reports import live, snapshot_shares

Instant = datetime | str


def _instant(at: Instant) -> Column:
    return F.lit(at).cast("timestamp")


def in_range(name: str, start: Instant, end: Instant) -> Column:
    """Closed time range."""
    return F.col(name).between(_instant(start), _instant(end))


def status_received(batches: DataFrame, start: Instant, end: Instant) -> DataFrame:
    rows = batches.filter(in_range("finished_at", start, end))
    return rows.agg(F.coalesce(F.sum("status_valid"), F.lit(0)).alias("messages"))


def duplicates_dropped(batches: DataFrame, start: Instant, end: Instant) -> DataFrame:
    rows = batches.filter(in_range("finished_at", start, end))
    return rows.agg(F.coalesce(F.sum("status_duplicates"), F.lit(0)).alias("doublons"))


def messages_rejected(rejected: DataFrame, start: Instant, end: Instant) -> DataFrame:
    return rejected.filter(in_range("rejected_at", start, end)).agg(F.count(F.lit(1)).alias("rejetes"))


def stations_followed(status: DataFrame, as_of: Instant, minutes: int = 10) -> DataFrame:
    """Distinct stations with a reading in the trailing minutes before `as_of`."""
    since = _instant(as_of) - F.make_dt_interval(mins=F.lit(minutes))
    return status.filter(F.col("ingested_at") > since).agg(F.countDistinct("station_id").alias("stations"))


def inserted_per_bucket(status: DataFrame, start: Instant, end: Instant, minutes: int = 5) -> DataFrame:
    rows = live(status).filter(in_range("ingested_at", start, end))
    return (
        rows.groupBy(T.bucket_start(F.col("ingested_at"), minutes).alias("time"))
        .agg(F.count(F.lit(1)).alias("releves_inseres"))
        .orderBy("time")
    )


def latency_per_bucket(status: DataFrame, start: Instant, end: Instant, minutes: int = 5) -> DataFrame:
    rows = live(status).filter(in_range("ingested_at", start, end))
    end_to_end = T.micros_between(F.col("ingested_at"), F.col("last_reported"))
    pipeline = T.micros_between(F.col("ingested_at"), F.col("fetched_at"))
    points = exact_percentiles(
        rows.withColumn("time", T.bucket_start(F.col("ingested_at"), minutes)),
        ["time"],
        {"p50": (end_to_end, "0.5"), "p95": (end_to_end, "0.95"), "p95_pipeline": (pipeline, "0.95")},
    )
    return points.select("time", *[seconds(F.col(c), 6).alias(c) for c in ("p50", "p95", "p95_pipeline")]).orderBy("time")


def shares_per_snapshot(status: DataFrame, start: Instant, end: Instant) -> DataFrame:
    rows = status.filter(in_range("last_reported", start, end))
    return (
        snapshot_shares(rows)
        .select(
            F.col("last_reported").alias("time"),
            (F.col("n_empty").cast("double") / F.col("n")).alias("vides"),
            (F.col("n_full").cast("double") / F.col("n")).alias("pleines"),
        )
        .orderBy("time")
    )


def fill_per_hour(network: DataFrame) -> DataFrame:
    return network.orderBy("heure_locale").select(
        F.date_format("heure_locale", "dd/MM HH'h'").alias("heure"),
        F.col("taux_remplissage_moyen").alias("remplissage"),
    )

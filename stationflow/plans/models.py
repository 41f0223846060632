"""Staging views, dimension, fact and hourly marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.functions import measures as M
from stationflow.functions import times as T

ZONE = "Europe/Paris"


def staged_status(raw: DataFrame) -> DataFrame:
    """Readings with both latencies; a replayed reading has none."""
    live = ~F.col("is_replay")

    def latency(since: str):
        return F.when(live, T.seconds_between(F.col("ingested_at"), F.col(since)).cast("decimal(14,3)"))

    return raw.select(
        "status_id",
        "station_id",
        "last_reported",
        "num_bikes_available",
        "num_docks_available",
        "is_installed",
        "is_renting",
        "is_returning",
        "feed_last_updated",
        "fetched_at",
        "ingested_at",
        "is_replay",
        latency("last_reported").alias("latence_bout_en_bout_s"),
        latency("fetched_at").alias("latence_pipeline_s"),
    )


def staged_information(raw: DataFrame) -> DataFrame:
    return raw.select(
        "station_id",
        F.col("name").alias("nom"),
        "lat",
        "lon",
        F.col("capacity").alias("capacite"),
        F.col("is_virtual_station").alias("station_virtuelle"),
        "feed_last_updated",
        "updated_at",
    )


def station_dimension(staged: DataFrame) -> DataFrame:
    return staged.select(
        "station_id",
        "nom",
        "lat",
        "lon",
        "capacite",
        "station_virtuelle",
        F.col("updated_at").alias("description_maj_le"),
    )


def fact(staged: DataFrame, dimension: DataFrame, zone: str = ZONE, above: int | None = None) -> DataFrame:
    """Reading fact. With `above`, only readings numbered after that mark (incremental load).

    The capacity is the one known when the row is loaded. The dimension is left unhinted:
    Catalyst broadcasts it while its files stay below the broadcast threshold.
    """
    new = staged if above is None else staged.filter(F.col("status_id") > above)
    bikes, docks = F.col("num_bikes_available"), F.col("num_docks_available")
    capacity = dimension.select("station_id", F.col("capacite").alias("capacity"))
    return new.join(capacity, "station_id", "left").select(
        "status_id",
        "station_id",
        "last_reported",
        T.wall_time(F.col("last_reported"), zone).alias("releve_heure_locale"),
        T.wall_hour(F.col("last_reported"), zone).alias("heure_locale"),
        "num_bikes_available",
        "num_docks_available",
        "capacity",
        "is_installed",
        "is_renting",
        "is_returning",
        M.fill_rate(bikes, docks).alias("taux_remplissage"),
        M.is_empty(F.col("is_installed"), bikes).alias("est_vide"),
        M.is_full(F.col("is_installed"), docks).alias("est_pleine"),
        "latence_bout_en_bout_s",
        "latence_pipeline_s",
        "is_replay",
        "ingested_at",
    )


def hourly_sums(readings: DataFrame, *beside: str) -> DataFrame:
    """Additive sums for each station and local hour, and columns beside: the one aggregate of the fact that all marts share."""
    return readings.groupBy("station_id", "heure_locale", *beside).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("taux_remplissage").alias("n_ratio"),
        M.ratio_sum(F.col("taux_remplissage")).alias("sum_ratio"),
        F.sum(F.col("num_bikes_available").cast("long")).alias("sum_bikes"),
        M.flag_sum(F.col("est_vide")).alias("n_empty"),
        M.flag_sum(F.col("est_pleine")).alias("n_full"),
        F.min("last_reported").alias("first_reported"),
        F.max("last_reported").alias("last_reported"),
    )


def regrouped(sums: DataFrame, keys: list[str]) -> DataFrame:
    """Hourly sums added up to other keys."""
    added = ["n", "n_ratio", "sum_ratio", "sum_bikes", "n_empty", "n_full"]
    return sums.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in added],
        F.count("station_id").alias("n_stations"),
        F.min("first_reported").alias("first_reported"),
        F.max("last_reported").alias("last_reported"),
    )


def _fill():
    return M.mean(F.col("sum_ratio"), F.col("n_ratio"), 6, 4)


def _share(flags: str):
    return M.mean(F.col(flags), F.col("n"), 6, 4)


def station_hours(sums: DataFrame) -> DataFrame:
    """Mart: station x local hour."""
    return sums.select(
        "station_id",
        "heure_locale",
        F.col("n").alias("nb_releves"),
        _fill().alias("taux_remplissage_moyen"),
        M.mean(F.col("sum_bikes"), F.col("n"), 8, 2).alias("velos_moyens"),
        _share("n_empty").alias("part_releves_vide"),
        _share("n_full").alias("part_releves_pleine"),
    )


def network_hours(sums: DataFrame) -> DataFrame:
    """Mart: all stations x local hour. Means are over readings, not over stations."""
    return regrouped(sums, ["heure_locale"]).select(
        "heure_locale",
        F.col("n_stations").alias("nb_stations"),
        F.col("n").alias("nb_releves"),
        _fill().alias("taux_remplissage_moyen"),
        M.mean(F.col("sum_bikes"), F.col("n"), 8, 2).alias("velos_moyens_par_station"),
        _share("n_empty").alias("part_releves_vide"),
        _share("n_full").alias("part_releves_pleine"),
    )


def station_ranking(sums: DataFrame, dimension: DataFrame) -> DataFrame:
    """Mart: described stations with readings. Joined after the aggregate, one row per station."""
    described = dimension.select("station_id", "nom", "capacite")
    return regrouped(sums, ["station_id"]).join(described, "station_id").select(
        "station_id",
        "nom",
        "capacite",
        F.col("n").alias("nb_releves"),
        F.col("first_reported").alias("premier_releve"),
        F.col("last_reported").alias("dernier_releve"),
        _share("n_empty").alias("part_temps_vide"),
        _share("n_full").alias("part_temps_pleine"),
        _fill().alias("taux_remplissage_moyen"),
    )

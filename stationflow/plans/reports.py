"""Named reports over the raw tables and marts."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.functions import measures as M
from stationflow.functions import times as T
from stationflow.operators.ordered import with_previous
from stationflow.operators.percentiles import ValueCounts, seconds
from stationflow.operators.rows import side_by_side

Tables = Mapping[str, DataFrame]

GAP_LIMIT_S = 90


def live(status: DataFrame) -> DataFrame:
    return status.filter(~F.col("is_replay"))


def _or_zero(name: str):
    return F.coalesce(F.sum(name), F.lit(0))


def overview(tables: Tables) -> DataFrame:
    """Collection overview: one aggregate for each of three tables, side by side."""
    described = tables["station_information"].agg(F.count(F.lit(1)).alias("stations_decrites"))
    span = T.seconds_between(F.max("ingested_at"), F.min("ingested_at"))
    observed = live(tables["station_status"]).agg(
        F.countDistinct("station_id").alias("stations_observees"),
        F.min("ingested_at").alias("debut_collecte"),
        F.max("ingested_at").alias("fin_collecte"),
        F.round(span / 3600, 2).alias("duree_collecte_h"),
        F.count(F.lit(1)).alias("lignes_station_status"),
        F.countDistinct("last_reported").alias("instantanes_distincts"),
    )
    written = tables["ingest_batches"].agg(
        _or_zero("received").alias("messages_recus"),
        _or_zero("status_valid").alias("messages_statut_valides"),
        _or_zero("status_inserted").alias("releves_inseres"),
        _or_zero("status_duplicates").alias("doublons_ecartes"),
        _or_zero("invalid").alias("messages_invalides"),
        F.count(F.lit(1)).alias("lots_ecrits"),
    )
    return side_by_side(described, observed, written).select(
        "stations_decrites",
        "stations_observees",
        "debut_collecte",
        "fin_collecte",
        "duree_collecte_h",
        "messages_recus",
        "messages_statut_valides",
        "releves_inseres",
        "doublons_ecartes",
        "messages_invalides",
        "lots_ecrits",
        "lignes_station_status",
        "instantanes_distincts",
    )


def _delays():
    ingested, reported, fetched = F.col("ingested_at"), F.col("last_reported"), F.col("fetched_at")
    return (
        T.micros_between(ingested, reported),
        T.micros_between(ingested, fetched),
        T.micros_between(fetched, reported),
    )


def latency(tables: Tables) -> DataFrame:
    """Latency percentiles of live readings."""
    end_to_end, pipeline, feed_age = _delays()
    delays = {"end_to_end": end_to_end, "pipeline": pipeline, "age": feed_age}
    values = ValueCounts(live(tables["station_status"]), [], delays)
    totals = values.totals(values.count("end_to_end").alias("n"), values.largest("end_to_end").alias("longest"))
    points = values.percentiles(
        {
            "e50": ("end_to_end", "0.50"),
            "e95": ("end_to_end", "0.95"),
            "p50": ("pipeline", "0.50"),
            "p95": ("pipeline", "0.95"),
            "a50": ("age", "0.50"),
        }
    )
    return side_by_side(totals, points).select(
        "n",
        seconds(F.col("e50"), 2).alias("bout_en_bout_p50_s"),
        seconds(F.col("e95"), 2).alias("bout_en_bout_p95_s"),
        seconds(F.col("longest"), 2).alias("bout_en_bout_max_s"),
        seconds(F.col("p50"), 3).alias("pipeline_p50_s"),
        seconds(F.col("p95"), 3).alias("pipeline_p95_s"),
        seconds(F.col("a50"), 2).alias("age_flux_a_la_lecture_p50_s"),
    )


def snapshot_gaps(snapshots: DataFrame, instant: str) -> DataFrame:
    """Microseconds between successive distinct snapshots, one row for each interval.

    Looked up day by day: a day holds at most 86 400 distinct seconds.
    """
    distinct = snapshots.select(instant).distinct()
    day = F.to_date(instant)
    followed = with_previous(distinct, [], day, [instant], instant)
    return followed.filter(F.col("previous").isNotNull()).select(
        T.micros_between(F.col(instant), F.col("previous")).alias("gap")
    )


def missed_snapshots(tables: Tables) -> DataFrame:
    """Gap statistics; a gap above 90 s means at least one update was not caught."""
    gaps = snapshot_gaps(live(tables["station_status"]), "feed_last_updated")
    values = ValueCounts(gaps, [], {"gap": F.col("gap")}, limits={"gap": GAP_LIMIT_S * T.MICROS}, few=True)
    totals = values.totals(
        values.count("gap").alias("intervalles"),
        values.count_above("gap").alias("intervalles_superieurs_90s"),
        values.largest("gap").alias("longest"),
    )
    middle = values.percentiles({"median": ("gap", "0.5")})
    return side_by_side(totals, middle).select(
        "intervalles",
        "intervalles_superieurs_90s",
        seconds(F.col("median"), 1).alias("ecart_median_s"),
        seconds(F.col("longest"), 1).alias("ecart_max_s"),
    )


def ingestion_series(tables: Tables) -> DataFrame:
    """Inserted readings and live latency for each five minutes of ingestion."""
    status = tables["station_status"].withColumn("bucket", T.bucket_start(F.col("ingested_at"), 5))
    end_to_end, pipeline, _ = _delays()
    is_live = ~F.col("is_replay")
    values = ValueCounts(
        status,
        ["bucket"],
        # The constant counts every reading in the same pass.
        {"any": F.lit(0), "end_to_end": F.when(is_live, end_to_end), "pipeline": F.when(is_live, pipeline)},
    )
    counts = values.totals(
        values.count("any").alias("releves_inseres"), values.count("end_to_end").alias("releves_temps_reel")
    )
    points = values.percentiles(
        {"e50": ("end_to_end", "0.50"), "e95": ("end_to_end", "0.95"), "p95": ("pipeline", "0.95")}
    )
    return (
        counts.join(points, "bucket", "left")
        .select(
            F.date_format("bucket", "yyyy-MM-dd HH:mm").alias("tranche_5min"),
            "releves_inseres",
            "releves_temps_reel",
            seconds(F.col("e50"), 2).alias("latence_bout_en_bout_p50_s"),
            seconds(F.col("e95"), 2).alias("latence_bout_en_bout_p95_s"),
            seconds(F.col("p95"), 3).alias("latence_pipeline_p95_s"),
        )
        .orderBy("tranche_5min")
    )


def snapshot_shares(status: DataFrame) -> DataFrame:
    """Per snapshot: readings, and how many of them are empty or full installed stations."""
    return status.groupBy("last_reported").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(M.is_empty(F.col("is_installed"), F.col("num_bikes_available"))).alias("n_empty"),
        F.count_if(M.is_full(F.col("is_installed"), F.col("num_docks_available"))).alias("n_full"),
    )


def availability_series(tables: Tables) -> DataFrame:
    """Share of empty and full stations for each second with a snapshot."""
    second = tables["station_status"].withColumn("last_reported", F.date_trunc("second", "last_reported"))
    return (
        snapshot_shares(second)
        .select(
            F.date_format("last_reported", "yyyy-MM-dd HH:mm:ss").alias("instantane_utc"),
            F.col("n").alias("stations"),
            M.mean(F.col("n_empty"), F.col("n"), 6, 4).alias("part_vides"),
            M.mean(F.col("n_full"), F.col("n"), 6, 4).alias("part_pleines"),
        )
        .orderBy("instantane_utc")
    )


def hourly_occupation(tables: Tables) -> DataFrame:
    return (
        tables["agg_reseau_horaire"]
        .orderBy("heure_locale")
        .select(
            F.date_format("heure_locale", "yyyy-MM-dd HH:'00'").alias("heure_locale"),
            "nb_stations",
            "nb_releves",
            "taux_remplissage_moyen",
            "velos_moyens_par_station",
            "part_releves_vide",
            "part_releves_pleine",
        )
    )


def hour_of_day(tables: Tables) -> DataFrame:
    """Hour of day: unweighted means of the (already rounded) hourly means."""

    def mean_of(name: str):
        return M.mean(F.sum(name), F.count(name), 6, 4).alias(name)

    return (
        tables["agg_reseau_horaire"]
        .groupBy(F.hour("heure_locale").alias("heure_du_jour"))
        .agg(
            F.count(F.lit(1)).alias("heures_observees"),
            mean_of("taux_remplissage_moyen"),
            mean_of("part_releves_vide"),
            mean_of("part_releves_pleine"),
        )
        .orderBy("heure_du_jour")
    )


def stations_by_emptiness(tables: Tables) -> DataFrame:
    """Ranking; ties are put in order of the station."""
    return (
        tables["stations_vides_pleines"]
        .select(
            "station_id",
            "nom",
            "capacite",
            "nb_releves",
            "part_temps_vide",
            "part_temps_pleine",
            "taux_remplissage_moyen",
        )
        .orderBy(F.desc("part_temps_vide"), F.desc("part_temps_pleine"), "station_id")
    )


def top_empty(ranking: DataFrame, stations: int = 12) -> DataFrame:
    """Labels and percentages of the stations most often empty."""
    label = F.coalesce(F.nullif(F.left("nom", F.lit(34)), F.lit("")), F.col("station_id"))
    return (
        ranking.orderBy(F.desc("part_temps_vide"), "station_id")
        .limit(stations)
        .select(label.alias("station"), (F.col("part_temps_vide") * 100).cast("decimal(8,2)").alias("part_vide_pct"))
    )


def global_shares(tables: Tables) -> DataFrame:
    readings = tables["fct_station_status"]
    n = F.count(F.lit(1))
    ratio = F.col("taux_remplissage")
    return readings.agg(
        M.mean(M.flag_sum(F.col("est_vide")), n, 6, 4).alias("part_releves_vide"),
        M.mean(M.flag_sum(F.col("est_pleine")), n, 6, 4).alias("part_releves_pleine"),
        M.mean(M.ratio_sum(ratio), F.count(ratio), 6, 4).alias("taux_remplissage_moyen"),
        F.count_if(F.col("num_bikes_available") > F.col("capacity")).alias("releves_velos_superieurs_capacite"),
    )


# Report names and the shape each is written in.
REPORTS: dict[str, tuple[str, Callable[[Tables], DataFrame]]] = {
    "synthese": ("json", overview),
    "latence": ("json", latency),
    "instantanes_manques": ("json", missed_snapshots),
    "serie_ingestion": ("csv", ingestion_series),
    "serie_vides_pleines": ("csv", availability_series),
    "occupation_par_heure": ("csv", hourly_occupation),
    "occupation_par_heure_du_jour": ("csv", hour_of_day),
    "stations_vides_pleines": ("csv", stations_by_emptiness),
    "vides_pleines_global": ("json", global_shares),
}

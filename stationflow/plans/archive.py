"""Analysis of archived snapshots without the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.functions import documents as D
from stationflow.functions import measures as M
from stationflow.functions import times as T
from stationflow.operators.keyed import latest_per_key
from stationflow.operators.percentiles import ValueCounts, exact_percentiles, seconds
from stationflow.operators.rows import side_by_side
from stationflow.plans.models import ZONE
from stationflow.plans.reports import GAP_LIMIT_S, snapshot_gaps
from stationflow.sinks import write_report
from stationflow.sources.archive import INFORMATION, LINE_ORDER, STATUS, snapshots

SOURCE = "archived feed snapshots, without the pipeline"
UNKNOWN_CAPACITY = 1_000_000  # stands in for the capacity of a station without description


def _field(station: Column, name: str) -> Column:
    return D.get(station, name)


def _present(station: Column) -> Column:
    """An absent flag counts as installed, a falsy one does not."""
    flag = _field(station, "is_installed")
    kind = D.kind(flag)
    return (kind == D.ABSENT) | ~D.is_falsy(flag, kind)


class Archive:
    """Lazily planned views over archive lines; `unreadable` counts the lines that none of them can use."""

    def __init__(self, lines: DataFrame, zone: str = ZONE):
        self.zone = zone
        self.lines = lines
        # Stations are reduced to what the analysis needs before anything is shuffled.
        def reduced(s: Column) -> Column:
            return F.struct(
                D.as_text(_field(s, "station_id")).alias("station_id"),
                D.as_long(_field(s, "num_bikes_available")).alias("bikes"),
                D.as_long(_field(s, "num_docks_available")).alias("docks"),
                _present(s).alias("installed"),
            )

        # Each kind is decoded on its own, so no line is parsed for the other.
        def decoded(kind: str) -> DataFrame:
            return snapshots(lines.filter(F.col("kind") == kind), needs_ttl=False).filter(F.col("source_error").isNull())

        polls = decoded(STATUS).select(
            *LINE_ORDER,
            F.timestamp_seconds("last_updated").alias("last_updated"),
            D.as_double(F.col("fetched_at")).alias("fetched_at"),
            F.transform("stations", reduced).alias("stations"),
        )
        described = decoded(INFORMATION).select(
            *LINE_ORDER, F.posexplode("stations").alias("pos", "s")
        )
        self.descriptions = latest_per_key(
            described.select(
                *LINE_ORDER,
                "pos",
                D.as_text(_field(F.col("s"), "station_id")).alias("station_id"),
                D.as_text(_field(F.col("s"), "name")).alias("name"),
                D.as_long(_field(F.col("s"), "capacity")).alias("capacity"),
            ),
            ["station_id"],
            [*LINE_ORDER, "pos"],
        ).select("station_id", "name", "capacity")

        # A poll that brought a snapshot already seen is redundant: the first fetch wins.
        self.snapshots = (
            polls.groupBy("last_updated")
            .agg(
                F.count(F.lit(1)).alias("polls"),
                F.min_by(F.struct("fetched_at", "stations"), F.struct("fetched_at", *LINE_ORDER)).alias("first"),
            )
            .select("last_updated", "polls", "first.*")
        )
        rows = self.snapshots.select("last_updated", "fetched_at", F.posexplode("stations").alias("pos", "s"))
        bikes, docks, installed = F.col("s.bikes"), F.col("s.docks"), F.col("s.installed")
        self.readings = rows.select(
            "last_updated",
            "fetched_at",
            "pos",
            F.col("s.station_id").alias("station_id"),
            bikes.alias("bikes"),
            docks.alias("docks"),
            M.fill_rate(bikes, docks).alias("fill"),
            M.is_empty(installed, bikes).alias("empty"),
            M.is_full(installed, docks).alias("full"),
        )

    def _sums(self) -> list[Column]:
        return [
            F.count(F.lit(1)).alias("n"),
            F.count("fill").alias("n_fill"),
            M.ratio_sum(F.col("fill")).alias("sum_fill"),
            F.count_if("empty").alias("n_empty"),
            F.count_if("full").alias("n_full"),
        ]

    @staticmethod
    def _fill() -> Column:
        return M.mean(F.col("sum_fill"), F.col("n_fill"), 6, 4).alias("taux_remplissage_moyen")

    @staticmethod
    def _share(flags: str, name: str) -> Column:
        return M.mean(F.col(flags), F.col("n"), 6, 4).alias(name)

    def hourly(self) -> DataFrame:
        hour = T.wall_hour(F.col("last_updated"), self.zone).alias("hour")
        per_station = self.readings.groupBy(hour, "station_id").agg(*self._sums())
        added = ["n", "n_fill", "sum_fill", "n_empty", "n_full"]
        per_hour = per_station.groupBy("hour").agg(
            F.count("station_id").alias("nb_stations"), *[F.sum(c).alias(c) for c in added]
        )
        return per_hour.orderBy("hour").select(
            F.date_format("hour", "yyyy-MM-dd HH:mm").alias("heure_locale"),
            "nb_stations",
            F.col("n").alias("nb_releves"),
            self._fill(),
            self._share("n_empty", "part_releves_vide"),
            self._share("n_full", "part_releves_pleine"),
        )

    def network_series(self) -> DataFrame:
        local = T.wall_time(F.col("last_updated"), self.zone)

        # Each snapshot is one row already, so its sums need no shuffle.
        def total(of):
            return F.aggregate("stations", F.lit(0).cast("long"), lambda a, s: a + of(s))

        empty = total(lambda s: M.is_empty(s["installed"], s["bikes"]).cast("long"))
        full = total(lambda s: M.is_full(s["installed"], s["docks"]).cast("long"))
        return self.snapshots.orderBy("fetched_at").select(
            F.date_format(local, "yyyy-MM-dd HH:mm:ss").alias("horodatage_local"),
            total(lambda s: s["bikes"]).alias("velos_disponibles"),
            total(lambda s: s["docks"]).alias("bornes_libres"),
            empty.alias("stations_vides"),
            full.alias("stations_pleines"),
        )

    def unreadable(self) -> DataFrame:
        """Lines left out of the analysis, by kind and by what is wrong with them."""
        broken = snapshots(self.lines, needs_ttl=False).filter(F.col("source_error").isNotNull())
        return broken.groupBy("kind", "source_error").agg(F.count(F.lit(1)).alias("lines"))

    def stations(self) -> DataFrame:
        seen = F.min(F.struct("fetched_at", "last_updated", "pos")).alias("seen")
        per_station = self.readings.groupBy("station_id").agg(*self._sums(), seen)
        return (
            per_station.join(self.descriptions, "station_id", "left")
            .orderBy(F.desc(F.col("n_empty") / F.col("n")), "seen")
            .select(
                "station_id",
                F.coalesce("name", F.lit("")).alias("nom"),
                F.col("capacity").alias("capacite"),
                F.col("n").alias("nb_releves"),
                self._share("n_empty", "part_temps_vide"),
                self._share("n_full", "part_temps_pleine"),
                self._fill(),
            )
        )

    def overview(self) -> DataFrame:
        described = self.descriptions.agg(
            F.count(F.lit(1)).alias("stations_decrites"),
            F.coalesce(F.sum(F.coalesce("capacity", F.lit(0))), F.lit(0)).alias("capacite_totale"),
        )
        age = F.round((F.col("fetched_at") - F.unix_seconds("last_updated")) * T.MICROS).cast("long")
        ages = self.snapshots.select("last_updated", "polls", age.alias("age"))
        span = T.seconds_between(F.max("last_updated"), F.min("last_updated"))
        shots = ages.agg(
            F.coalesce(F.sum("polls"), F.lit(0)).alias("interrogations"),
            F.count(F.lit(1)).alias("instantanes_distincts"),
            F.min("last_updated").alias("debut_utc"),
            F.max("last_updated").alias("fin_utc"),
            F.round(span / 3600, 2).alias("duree_h"),
            F.max("age").cast("decimal(24,4)").alias("age_max"),
        )
        age_median = exact_percentiles(ages, [], {"age_median": (F.col("age"), "0.5")})
        gaps = snapshot_gaps(self.snapshots, "last_updated")
        values = ValueCounts(gaps, [], {"gap": F.col("gap")}, limits={"gap": GAP_LIMIT_S * T.MICROS}, few=True)
        gap_counts = values.totals(
            values.largest("gap").alias("gap_max"),
            values.count_above("gap").alias("intervalles_superieurs_90s"),
        )
        gap_median = values.percentiles({"gap_median": ("gap", "0.5")})
        # Readings are counted by station first; the few rows left are joined to the descriptions.
        per_station = self.readings.groupBy("station_id", "bikes").agg(*self._sums())
        joined = per_station.join(self.descriptions, "station_id", "left")
        capacity = F.coalesce("capacity", F.lit(UNKNOWN_CAPACITY))
        sums = joined.agg(
            F.countDistinct("station_id").alias("stations_observees"),
            *[F.sum(c).alias(c) for c in ("n", "n_fill", "sum_fill", "n_empty", "n_full")],
            F.coalesce(F.sum(F.when(F.col("bikes") > capacity, F.col("n"))), F.lit(0)).alias(
                "releves_velos_superieurs_capacite"
            ),
        )
        return side_by_side(described, shots, age_median, gap_counts, gap_median, sums).select(
            F.lit(SOURCE).alias("source"),
            "stations_decrites",
            "stations_observees",
            "interrogations",
            "instantanes_distincts",
            (F.col("interrogations") - F.col("instantanes_distincts")).alias("interrogations_redondantes"),
            F.col("n").alias("releves_station"),
            "debut_utc",
            "fin_utc",
            "duree_h",
            seconds(F.col("gap_median"), 1).alias("ecart_median_entre_instantanes_s"),
            seconds(F.col("gap_max"), 1).alias("ecart_max_entre_instantanes_s"),
            "intervalles_superieurs_90s",
            seconds(F.col("age_median"), 2).alias("age_du_flux_a_la_lecture_median_s"),
            seconds(F.col("age_max"), 2).alias("age_du_flux_a_la_lecture_max_s"),
            self._share("n_empty", "part_releves_vide"),
            self._share("n_full", "part_releves_pleine"),
            self._fill(),
            "capacite_totale",
            "releves_velos_superieurs_capacite",
        )

    def reports(self) -> dict[str, tuple[str, Callable[[], DataFrame]]]:
        """Report name -> (shape, function that plans its rows)."""
        return {
            "archive_synthese": ("json", self.overview),
            "archive_occupation_par_heure": ("csv", self.hourly),
            "archive_serie_reseau": ("csv", self.network_series),
            "archive_stations": ("csv", self.stations),
        }

    def export(self, folder: str) -> list[str]:
        """Write every report of the archive."""
        for name, (shape, report) in self.reports().items():
            write_report(report(), f"{folder.rstrip('/')}/{name}", shape)
        return list(self.reports())

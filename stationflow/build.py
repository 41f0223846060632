"""Model build: incremental fact, hourly sums and marts, then the data tests.

A build adds only the readings above the mark of the build before it. The hourly sums of the new
readings are added beside the older ones, and the marts are derived from those sums; the tests count
failures in the new readings beside the older counts. So a build costs what its new readings
cost, not a scan of the whole fact. Readings delivered again replace themselves by rewriting their days.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.operators.keyed import replace_by_key
from stationflow.plans import models, quality
from stationflow.plans.reports import REPORTS
from stationflow.schemas import require_same_schema
from stationflow.session import configure
from stationflow.sinks import write_report
from stationflow.streaming.ingest import current_information, raw_store, raw_tables
from stationflow.streaming.store import FAN, BatchStore, Range, State

_PAIR = "stream_id string, batch_id bigint"

FACT = (
    "status_id bigint, station_id string, last_reported timestamp, releve_heure_locale timestamp_ntz, "
    "heure_locale timestamp_ntz, num_bikes_available int, num_docks_available int, capacity int, "
    "is_installed boolean, is_renting boolean, is_returning boolean, taux_remplissage double, "
    "est_vide boolean, est_pleine boolean, latence_bout_en_bout_s decimal(14,3), "
    "latence_pipeline_s decimal(14,3), is_replay boolean, ingested_at timestamp"
)
SUMS = (
    "station_id string, heure_locale timestamp_ntz, n bigint, n_ratio bigint, sum_ratio decimal(38,10), "
    "sum_bikes bigint, n_empty bigint, n_full bigint, first_reported timestamp, last_reported timestamp, date date"
)
# Failing rows of the tests on single rows and numbers by day: they add up over builds.
FAILURES = "test string, model string, column string, failures bigint, date date"
_MEANS = "taux_remplissage_moyen decimal(6,4), {bikes} decimal(8,2), part_releves_vide decimal(6,4), part_releves_pleine decimal(6,4)"
TABLES = {
    "dim_station": "station_id string, nom string, lat double, lon double, capacite int, "
    "station_virtuelle boolean, description_maj_le timestamp",
    "agg_occupation_horaire": "station_id string, heure_locale timestamp_ntz, nb_releves bigint, "
    + _MEANS.format(bikes="velos_moyens"),
    "agg_reseau_horaire": "heure_locale timestamp_ntz, nb_stations bigint, nb_releves bigint, "
    + _MEANS.format(bikes="velos_moyens_par_station"),
    "stations_vides_pleines": "station_id string, nom string, capacite int, nb_releves bigint, "
    "premier_releve timestamp, dernier_releve timestamp, part_temps_vide decimal(6,4), "
    "part_temps_pleine decimal(6,4), taux_remplissage_moyen decimal(6,4)",
}
BUILDS = "started_at timestamp, finished_at timestamp, generation bigint, last_status_id bigint"


def _schema(columns: str) -> T.StructType:
    return T.StructType.fromDDL(f"{columns}, {_PAIR}")


def mart_store(root: str, fan: int = FAN) -> BatchStore:
    daily = {"fct_station_status": f"{FACT}, date date", "hourly_sums": SUMS, "raw_failures": FAILURES, "fact_failures": FAILURES, "pair_failures": FAILURES}
    tables = {**TABLES, **daily, "builds": BUILDS}
    return BatchStore(
        root,
        "builds",
        {n: _schema(c) for n, c in tables.items()},
        by={name: ["date"] for name in daily},
        zones={"fct_station_status": ["status_id"]},
        reduced={"hourly_sums": added_up, "raw_failures": quality.added_failures, "fact_failures": quality.added_failures},
        newest=tuple(TABLES),
        fan=fan,
    )


def added_up(sums: DataFrame) -> DataFrame:
    """Hourly sums of several builds as one row for each station, hour and day."""
    return models.regrouped(sums, ["station_id", "heure_locale", "date"]).withColumn("sum_ratio", F.col("sum_ratio").cast("decimal(38,10)"))


def _last_build(spark: SparkSession, store: BatchStore, state: State):
    return store.ledger(spark, state).orderBy(F.desc("batch_id")).limit(1).collect()


def _generation(number: int) -> str:
    return f"generation-{number}"


class Build:
    """One run of the models over a raw store."""

    def __init__(self, spark: SparkSession, raw_root: str, mart_root: str, zone: str = models.ZONE, fan: int = FAN):
        self.spark = configure(spark)
        self.raw_root = raw_root
        self.store = mart_store(mart_root, fan)
        self.zone = zone

    def run(self, refresh_dim: bool = False) -> int:
        """Write the next build and return its number.

        `refresh_dim` loads the whole fact again, in a new generation, so that capacities
        described late reach readings loaded before.
        """
        spark, store = self.spark, self.store
        started = datetime.now(UTC)
        state = store.writer_state(spark)
        last = _last_build(spark, store, state)
        number = last[0]["batch_id"] + 1 if last else 0
        generation = last[0]["generation"] if last else 0
        mark = last[0]["last_status_id"] if last else 0
        if refresh_dim:
            # Named after the build that begins it: what a dead refresh left is in no later generation.
            generation, mark = number, 0
        stream = _generation(generation)

        raw = raw_store(self.raw_root)
        raw_state = raw.state(spark)
        top = raw.ledger(spark, raw_state).agg(F.max("last_status_id")).first()[0] or mark
        log = current_information(raw.read(spark, "station_information", raw_state))
        dimension = models.station_dimension(models.staged_information(log))
        store.write("dim_station", self._checked(dimension, TABLES["dim_station"]), stream, number)
        dimension = self._written("dim_station", stream, number)

        # The ledger tells which parts hold numbers above the mark: older ones are not opened.
        unread = raw.read(spark, "station_status", raw_state, {"status_id": (mark + 1, top)})
        staged = models.staged_status(unread)
        new = self._checked(models.fact(staged, dimension, self.zone, above=mark), FACT)
        store.write("fct_station_status", new.withColumn("date", F.to_date("last_reported")), stream, number)
        new = self._written("fct_station_status", stream, number)
        counted = {"station_status": unread, "stg_station_status": staged.withColumn("date", F.to_date("last_reported"))}
        store.write("raw_failures", quality.daily_failures(counted), stream, number)
        store.write("fact_failures", quality.daily_failures({"fct_station_status": new}), stream, number)
        store.write("hourly_sums", self._sums(new), stream, number)

        # Readings of one station and time can come in different builds: their days are looked at whole.
        days = [r["date"] for r in new.select("date").distinct().collect()]
        keys = store.read(spark, "fct_station_status", state, streams=[stream]).filter(F.col("date").isin(days))
        pairs = keys.select(*quality.PAIR_KEY, "date").unionByName(new.select(*quality.PAIR_KEY, "date"))
        store.write("pair_failures", quality.daily_pair_failures(pairs), stream, number, whole=days)
        sums = store.read(spark, "hourly_sums", state, streams=[stream]).unionByName(self.store.written(spark, "hourly_sums", stream, number))
        self._publish(state, stream, number, sums, dimension, started, generation, top)
        return number

    def redeliver(self, readings: DataFrame) -> int:
        """Put readings, with the fact's columns, in place of those of the same number, as a build of its own; returns its number.

        Only the days that old or new readings lie in are rewritten, with their sums and failures; other days keep their files.
        """
        spark, store = self.spark, self.store
        started = datetime.now(UTC)
        state = store.writer_state(spark)
        (last,) = _last_build(spark, store, state)
        number, stream = last["batch_id"] + 1, _generation(last["generation"])
        new = self._checked(readings, FACT).withColumn("date", F.to_date("last_reported"))
        ends = new.agg(F.min("status_id"), F.max("status_id")).first()
        numbered = store.read(spark, "fct_station_status", state, {"status_id": tuple(ends)}, [stream])
        old_days = numbered.join(new.select("status_id"), "status_id", "left_semi").select("date")
        days = [r["date"] for r in old_days.unionByName(new.select("date")).distinct().collect()]
        there = store.read(spark, "fct_station_status", state, streams=[stream]).filter(F.col("date").isin(days))
        rows = replace_by_key(there.drop("stream_id", "batch_id"), new, ["status_id"])
        store.write("fct_station_status", rows, stream, number, whole=days)
        rows = self._written("fct_station_status", stream, number)
        store.write("fact_failures", quality.daily_failures({"fct_station_status": rows}), stream, number, whole=days)
        store.write("pair_failures", quality.daily_pair_failures(rows), stream, number, whole=days)
        store.write("hourly_sums", self._sums(rows), stream, number, whole=days)
        sums = store.read(spark, "hourly_sums", state, streams=[stream]).filter(~F.col("date").isin(days))
        sums = sums.unionByName(store.written(spark, "hourly_sums", stream, number))
        dimension = store.read(spark, "dim_station", state, streams=[stream]).drop("stream_id", "batch_id")
        self._publish(state, stream, number, sums, dimension, started, last["generation"], last["last_status_id"])
        return number

    @staticmethod
    def _sums(readings: DataFrame) -> DataFrame:
        return models.hourly_sums(readings, "date").withColumn("sum_ratio", F.col("sum_ratio").cast("decimal(38,10)"))

    def _publish(self, state: State, stream: str, number: int, sums: DataFrame, dimension: DataFrame, started: datetime, generation: int, top: int) -> None:
        """Derive the marts from the hourly sums of all days, write them, and commit the build."""
        added = models.regrouped(sums, ["station_id", "heure_locale"])
        marts = {
            "agg_occupation_horaire": models.station_hours(added),
            "agg_reseau_horaire": models.network_hours(added),
            "stations_vides_pleines": models.station_ranking(added, dimension),
        }
        for name, rows in marts.items():
            self.store.write(name, self._checked(rows, TABLES[name]), stream, number)
        values = {"started_at": started, "finished_at": datetime.now(UTC), "generation": generation, "last_status_id": top}
        state = self.store.commit(self.spark, state, stream, number, values)
        self.store.compacted(self.spark, state, [stream])

    @staticmethod
    def _checked(rows: DataFrame, columns: str) -> DataFrame:
        return require_same_schema(rows, T.StructType.fromDDL(columns))

    def _written(self, name: str, stream: str, number: int) -> DataFrame:
        return self.store.written(self.spark, name, stream, number).drop("stream_id", "batch_id")

    def tables(self, ingested: Range = (None, None)) -> dict[str, DataFrame]:
        """Raw tables, staging views and the models of the last committed build; raw rows of a range of write times if asked."""
        raw = raw_tables(self.spark, self.raw_root, ingested=ingested)
        state = self.store.state(self.spark)
        last = _last_build(self.spark, self.store, state)
        if not last:
            raise ValueError("no build has been committed")
        stream = _generation(last[0]["generation"])
        built = {n: self.store.read(self.spark, n, state, streams=[stream]) for n in ("fct_station_status", *TABLES)}
        return {
            **raw,
            "stg_station_status": models.staged_status(raw["station_status"]),
            "stg_station_information": models.staged_information(raw["station_information"]),
            **{n: rows.drop("stream_id", "batch_id", "date") for n, rows in built.items()},
        }

    def tidy(self) -> None:
        """Remove what older builds and generations left: all but the live tables and what the newest compaction replaced."""
        state = self.store.state(self.spark)
        last = _last_build(self.spark, self.store, state)
        if last:
            stream = _generation(last[0]["generation"])
            self.store.cleared(self.spark, state, [stream])

    def views(self) -> None:
        """Publish the tables as temporary views, prefixed by layer."""
        layers = {
            "station_status": "raw",
            "station_information": "raw",
            "rejected_messages": "raw",
            "ingest_batches": "raw",
            "stg_station_status": "staging",
            "stg_station_information": "staging",
        }
        for name, rows in self.tables().items():
            rows.createOrReplaceTempView(f"{layers.get(name, 'marts')}_{name}")

    def verdicts(self, lat: tuple[float, float], lon: tuple[float, float]) -> DataFrame:
        """One row for each test, from the failures that builds counted in their new rows; only small models are read again.

        Equal to `quality.run_suite` over `tables`, which reads all readings.
        """
        state = self.store.state(self.spark)
        last = _last_build(self.spark, self.store, state)
        stream = _generation(last[0]["generation"]) if last else ""
        stored = [self.store.read(self.spark, n, state, streams=[stream]) for n in ("raw_failures", "fact_failures", "pair_failures")]
        sums = self.store.read(self.spark, "hourly_sums", state, streams=[stream])
        return quality.merged_verdicts(quality.default_suite(lat, lon), self.tables(), stored, sums)

    def freshness(self, as_of: datetime | str, **limits) -> DataFrame:
        """Freshness of the readings; the ledger knows it without a scan of the readings."""
        return quality.freshness(raw_store(self.raw_root).ledger(self.spark), "ingested_at", as_of, **limits)

    def export(self, folder: str) -> list[str]:
        """Write every named report."""
        tables = self.tables()
        for name, (shape, report) in REPORTS.items():
            write_report(report(tables), f"{folder.rstrip('/')}/{name}", shape)
        return list(REPORTS)

from datetime import datetime
from decimal import Decimal

import pytest
from feed import T0, information, messages, status
from pyspark.sql import functions as F

from stationflow.build import Build
from stationflow.plans import models, quality
from stationflow.plans.reports import REPORTS
from stationflow.schemas import SchemaDrift, require_same_schema
from stationflow.streaming import ingest as ing

INFO = "station_information"
LAT, LON = (43.4, 43.8), (3.6, 4.2)


def feed(start, n):
    rows = [status(station_id=f"{i % 3:03}", last_reported=T0 + 60 * (i // 3), num_bikes_available=i % 9,
                   num_docks_available=8 - i % 9, replay=True) for i in range(start, start + n)]
    return rows


def marts(build):
    tables = build.tables()
    return {n: sorted(map(repr, tables[n].collect())) for n in
            ("agg_occupation_horaire", "agg_reseau_horaire", "stations_vides_pleines")}


def test_two_builds_equal_one_and_late_capacity_needs_a_refresh(spark, tmp_path):
    raw = str(tmp_path / "raw")
    run = ing.Ingest(ing.raw_store(raw), "s")
    run(messages(spark, [(INFO, information(station_id="000", capacity=20))] + feed(0, 40)), 0)
    steps = Build(spark, raw, str(tmp_path / "steps"))
    steps.run()
    run(messages(spark, feed(30, 60) + [(INFO, information(station_id="001", capacity=3))], start=500), 1)
    steps.run()
    steps.run()  # nothing new
    at_once = Build(spark, raw, str(tmp_path / "once"))
    at_once.run()

    assert steps.tables()["fct_station_status"].count() == 90
    assert marts(steps) == marts(at_once)
    sums = {n: sum(r["nb_releves"] for r in steps.tables()[n].collect()) for n in ("agg_occupation_horaire", "agg_reseau_horaire")}
    assert set(sums.values()) == {90}

    def capacities(build):
        rows = build.tables()["fct_station_status"].groupBy("station_id", "capacity").count().collect()
        return {(r["station_id"], r["capacity"]): r["count"] for r in rows}

    # station 001 was described after its first readings had been loaded
    assert ("001", None) in capacities(steps) and ("001", 3) in capacities(steps)
    steps.run(refresh_dim=True)
    assert ("001", None) not in capacities(steps)
    assert steps.tables()["fct_station_status"].count() == 90

    verdicts = {(r["test"], r["model"], r["column"]): r["failures"] for r in steps.verdicts(LAT, LON).collect()}
    assert len(verdicts) == 35
    assert verdicts["described_stations", "stg_station_status", "station_id"] == 1
    assert verdicts["bikes_within_capacity", "fct_station_status", "num_bikes_available"] > 0
    assert verdicts["unique", "fct_station_status", "status_id"] == 0

    written = steps.export(str(tmp_path / "reports"))
    assert written == list(REPORTS)
    overview = spark.read.json(str(tmp_path / "reports" / "synthese")).first()
    assert (overview["releves_inseres"], overview["doublons_ecartes"], overview["lots_ecrits"]) == (90, 10, 2)
    series = spark.read.csv(str(tmp_path / "reports" / "serie_vides_pleines"), header=True)
    assert series.count() == 30 and series.columns[0] == "instantane_utc"

    steps.views()
    assert spark.sql("select count(*) as n from marts_fct_station_status").first()["n"] == 90
    assert steps.freshness(datetime(2000, 1, 1)).first()["status"] == "pass"


def test_unfinished_build_is_invisible(spark, tmp_path, monkeypatch):
    raw = str(tmp_path / "raw")
    ing.Ingest(ing.raw_store(raw), "s")(messages(spark, feed(0, 9)), 0)
    build = Build(spark, raw, str(tmp_path / "marts"))
    commit = build.store.commit
    monkeypatch.setattr(build.store, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        build.run()
    with pytest.raises(ValueError):
        build.tables()
    monkeypatch.setattr(build.store, "commit", commit)
    build.run()
    assert build.tables()["fct_station_status"].count() == 9


def test_dead_refresh_leaves_nothing_behind(spark, tmp_path, monkeypatch):
    raw = str(tmp_path / "raw")
    run = ing.Ingest(ing.raw_store(raw), "s")
    run(messages(spark, [(INFO, information(station_id="000"))] + feed(0, 9)), 0)
    build = Build(spark, raw, str(tmp_path / "marts"))
    build.run()
    commit = build.store.commit
    monkeypatch.setattr(build.store, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        build.run(refresh_dim=True)
    monkeypatch.setattr(build.store, "commit", commit)
    run(messages(spark, feed(9, 9), start=100), 1)
    for refresh in (False, True, False):
        build.run(refresh_dim=refresh)
        tables = build.tables()
        assert tables["fct_station_status"].count() == 18 and tables["dim_station"].count() == 1
        assert sum(r["nb_releves"] for r in tables["agg_reseau_horaire"].collect()) == 18


def test_schema_drift_is_refused(spark):
    target = spark.createDataFrame([], "a int, b string").schema
    same = spark.createDataFrame([], "a int, b string")
    assert require_same_schema(same, target) is same
    for other in ("a int", "a bigint, b string", "a int, b string, c int", "b string, a int"):
        with pytest.raises(SchemaDrift):
            require_same_schema(spark.createDataFrame([], other), target)


def reading(spark, instants, bikes=1, docks=1):
    rows = [(i, "000", datetime.fromisoformat(t)) for i, t in enumerate(instants)]
    df = spark.createDataFrame(rows, "status_id long, station_id string, last_reported timestamp")
    return df.select(
        "*", F.lit(bikes).alias("num_bikes_available"), F.lit(docks).alias("num_docks_available"),
        *[F.lit(True).alias(c) for c in ("is_installed", "is_renting", "is_returning")],
        F.col("last_reported").alias("feed_last_updated"), F.col("last_reported").alias("fetched_at"),
        (F.col("last_reported") + F.expr("INTERVAL 1.0005 SECONDS")).alias("ingested_at"), F.lit(False).alias("is_replay"),
    )


def no_stations(spark):
    return spark.createDataFrame([], "station_id string, nom string, capacite int")


def test_hours_on_both_clock_changes(spark):
    nights = ["2026-10-25T00:30:00+00:00", "2026-10-25T01:30:00+00:00", "2026-10-25T02:30:00+00:00",
              "2026-03-29T00:30:00+00:00", "2026-03-29T01:30:00+00:00"]
    readings = models.fact(models.staged_status(reading(spark, nights)), no_stations(spark))
    hours = models.station_hours(models.hourly_sums(readings)).orderBy("heure_locale").collect()
    got = [(r["heure_locale"].isoformat(), r["nb_releves"]) for r in hours]
    # the repeated hour merges two, the skipped hour does not exist
    assert got == [("2026-03-29T01:00:00", 1), ("2026-03-29T03:00:00", 1), ("2026-10-25T02:00:00", 2), ("2026-10-25T03:00:00", 1)]


def test_latency_and_ratio(spark):
    readings = models.fact(models.staged_status(reading(spark, ["2026-01-01T00:00:00+00:00"], 0, 0)), no_stations(spark))
    row = readings.first()
    assert row["latence_pipeline_s"] == Decimal("1.001")  # 1.0005 away from zero
    assert row["taux_remplissage"] is None and row["est_vide"] and row["est_pleine"] and row["capacity"] is None


def test_quality_rows(spark):
    df = spark.createDataFrame([(1, "a", -1.0), (1, None, 0.5), (2, "b", 2.0), (None, "c", None)], "id int, k string, v double")
    parent = spark.createDataFrame([("a",), ("c",)], "k string")
    assert quality.nulls(df, "k").count() == 1
    assert [tuple(r) for r in quality.not_unique(df, "id").collect()] == [(1, 2)]
    assert quality.out_of_range(df, "v", 0, 1).count() == 2
    assert quality.out_of_range(df, "v", low=0).count() == 1
    assert quality.out_of_range(df, "v", high=1).count() == 1
    assert quality.out_of_range(df, "v").count() == 0
    assert [r["k"] for r in quality.without_parent(df, "k", parent, "k").collect()] == ["b"]
    assert [r["n"] for r in quality.repeated(df.withColumn("x", F.lit(1)), ["id", "x"]).collect()] == [2]


@pytest.mark.parametrize("age, status", [(300, "pass"), (300.000001, "warn"), (900, "warn"), (900.000001, "error")])
def test_freshness_limits(spark, age, status):
    df = spark.sql("select timestamp'2026-01-01 00:00:00' as at")
    as_of = f"{datetime.utcfromtimestamp(1767225600 + int(age)):%Y-%m-%d %H:%M:%S}{'.000001' if age % 1 else ''}"
    assert quality.freshness(df, "at", as_of).first()["status"] == status


def test_freshness_without_rows(spark):
    df = spark.createDataFrame([], "at timestamp")
    assert quality.freshness(df, "at", "2026-01-01 00:00:00").first()["status"] == "error"

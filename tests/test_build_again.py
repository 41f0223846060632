"""Readings delivered again, verdicts that add up over builds, and stored tables of another shape."""

from datetime import timedelta

import pytest
from feed import OTHER, STATION, T0, information, messages, status
from pyspark.sql import functions as F

from stationflow.build import FACT, Build
from stationflow.plans import quality
from stationflow.schemas import SchemaDrift
from stationflow.streaming import ingest as ing

INFO = "station_information"
BOX = (43.4, 43.8), (3.6, 4.2)
DAY = 86400


def feed(k):
    rows = [status(station_id=s, last_reported=T0 + d * DAY + 60 * k, num_bikes_available=3 + 40 * (k == 1), replay=True) for s in (STATION, OTHER, "x") for d in range(2)]
    return [(INFO, information(station_id=STATION, capacity=30, lat=50.0 if k == 2 else 43.5)), *rows, *([(INFO, information(station_id=OTHER, capacity=9))] if k else [])]


@pytest.fixture(scope="module")
def roots(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("again")
    run = ing.Ingest(ing.raw_store(str(root / "raw")), "s")
    build = Build(spark, str(root / "raw"), str(root / "marts"), fan=2)
    for k in range(3):
        run(messages(spark, feed(k), start=100 * k), k)
        build.run()
    return root


def shown(rows):
    return sorted(map(str, rows.collect()))


def marts(build):
    tables = build.tables()
    return {n: shown(tables[n]) for n in ("agg_occupation_horaire", "agg_reseau_horaire", "stations_vides_pleines")}


def days_and_files(build):
    out = {}
    for f in build.tables()["fct_station_status"].inputFiles():
        out.setdefault(f.split("date=")[1].split("/")[0], set()).add(f)
    return out


def test_verdicts_add_up_to_the_full_suite(spark, roots):
    build = Build(spark, str(roots / "raw"), str(roots / "marts"), fan=2)
    full = quality.run_suite(quality.default_suite(*BOX), build.tables())
    got = build.verdicts(*BOX)
    assert shown(got.select("test", "model", "column", "failures", "status")) == shown(full)
    failed = {(r["test"], r["model"]): r["failures"] for r in got.collect() if r["failures"]}
    assert failed["bikes_within_capacity", "fct_station_status"] and failed["relationships", "fct_station_status"] == 6
    assert failed["accepted_range", "stg_station_information"] == 1 and quality.summary(got).first()["tests"] == 35
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "station_status/stream_id" not in plan


def test_redelivered_readings_replace_themselves(spark, roots):
    build = Build(spark, str(roots / "raw"), str(roots / "marts"), fan=100)
    fact = build.tables()["fct_station_status"]
    chosen = fact.filter((F.col("station_id") == OTHER) & (F.to_date("last_reported") == F.to_date(F.timestamp_seconds(F.lit(T0)))))
    names = [c.split()[0] for c in FACT.split(", ")]
    again = chosen.withColumns({"num_bikes_available": F.lit(0), "est_vide": F.lit(True), "capacity": F.lit(11), "taux_remplissage": F.lit(0.0)})
    again = spark.createDataFrame(again.select(*names).collect(), again.select(*names).schema)
    n, before = fact.count(), days_and_files(build)
    build.redeliver(again)
    after = days_and_files(build)
    (touched,) = [d for d in after if after[d] != before[d]]
    assert set(after) == set(before) and len(after) == 2
    now = build.tables()["fct_station_status"]
    assert now.count() == n and now.filter("capacity = 11 and est_vide").count() == again.count() == 3
    # The marts are those of the whole fact, and the verdicts those of the full suite.
    from stationflow.plans import models

    sums = models.hourly_sums(now)
    assert marts(build)["agg_occupation_horaire"] == shown(models.station_hours(sums))
    assert marts(build)["agg_reseau_horaire"] == shown(models.network_hours(sums))
    full = quality.run_suite(quality.default_suite(*BOX), build.tables())
    assert shown(build.verdicts(*BOX).select(*full.columns)) == shown(full)
    # Moved to another day, a reading leaves the old one; the compaction keeps all that.
    moved = again.limit(1).withColumn("last_reported", F.col("last_reported") + timedelta(days=5))
    moved = spark.createDataFrame(moved.collect(), moved.schema)
    Build(spark, str(roots / "raw"), str(roots / "marts"), fan=2).redeliver(moved)
    assert build.tables()["fct_station_status"].count() == n
    assert build.tables()["fct_station_status"].filter("capacity = 11").groupBy(F.to_date("last_reported")).count().count() == 2
    assert touched in days_and_files(build)
    assert marts(build)["agg_reseau_horaire"] == shown(models.network_hours(models.hourly_sums(build.tables()["fct_station_status"])))


def test_a_pair_in_two_builds_is_found(spark, roots, tmp_path):
    """Old and new rows of one station and time: the builds' days are looked at whole."""
    run = ing.Ingest(ing.raw_store(str(tmp_path / "raw")), "s")
    run(messages(spark, feed(0)), 0)
    build = Build(spark, str(tmp_path / "raw"), str(tmp_path / "marts"))
    build.run()
    raw = ing.raw_store(str(tmp_path / "raw"))
    state = raw.state(spark)
    copies = raw.read(spark, "station_status", state).filter(F.col("station_id") == STATION).withColumn("status_id", F.col("status_id") + 100)
    raw.write("station_status", copies, "s", 1)
    raw.commit(spark, state, "s", 1, {"last_status_id": 200})
    build.run()
    failed = {r["test"]: r["failures"] for r in build.verdicts(*BOX).collect() if r["failures"] and r["model"] == "fct_station_status"}
    assert failed["unique_combination"] == 2
    assert shown(quality.run_suite(quality.default_suite(*BOX), build.tables())) == shown(build.verdicts(*BOX))


@pytest.mark.parametrize("change", [lambda r: r.withColumn("n", F.lit(1)), lambda r: r.drop("is_renting"), lambda r: r.withColumn("num_bikes_available", F.col("num_bikes_available").cast("long"))])
def test_a_stored_table_of_another_shape_is_refused(spark, tmp_path, change):
    run = ing.Ingest(ing.raw_store(str(tmp_path)), "s")
    run(messages(spark, feed(0)), 0)
    store = ing.raw_store(str(tmp_path))
    path = store.path("station_status", ("s", 0))
    rows = spark.createDataFrame(spark.read.parquet(path).collect(), spark.read.parquet(path).schema)
    change(rows).write.mode("overwrite").partitionBy("date").parquet(path)
    with pytest.raises(SchemaDrift):
        ing.Ingest(ing.raw_store(str(tmp_path)), "s")(messages(spark, feed(1), start=100), 1)
    assert store.state(spark).marks == {"s": 0}

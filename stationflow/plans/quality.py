"""Data tests: each returns the failing rows (none = pass); `run_suite` gives one verdict for each."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Tables = Mapping[str, DataFrame]


def nulls(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def repeated(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key combinations that occur more than once, with their count."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def not_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; nulls are the business of `nulls`."""
    return repeated(df.filter(F.col(column).isNotNull()), [column])


def _outside(column: str, low: float | None, high: float | None) -> Column:
    below = F.lit(False) if low is None else F.col(column) < low
    above = F.lit(False) if high is None else F.col(column) > high
    return F.col(column).isNotNull() & (below | above)


def out_of_range(df: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """Rows below `low` or above `high`, either of which may be left open; nulls pass."""
    return df.filter(_outside(column, low, high))


def without_parent(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-null key the parent lacks."""
    known = parent.select(F.col(parent_column).alias(column))
    return child.filter(F.col(column).isNotNull()).join(known, column, "left_anti")


def undescribed_stations(status: DataFrame, dimension: DataFrame) -> DataFrame:
    """Stations with readings but no description, with the readings counted first."""
    seen = status.groupBy("station_id").agg(F.count(F.lit(1)).alias("n"))
    return seen.join(dimension.select("station_id"), "station_id", "left_anti")


def over_capacity(readings: DataFrame) -> DataFrame:
    return readings.filter(F.col("num_bikes_available") > F.col("capacity")).select(
        "status_id", "station_id", "num_bikes_available", "capacity"
    )


@dataclass(frozen=True)
class Test:
    kind: str
    model: str
    column: str = ""
    options: dict = field(default_factory=dict, hash=False)


def _not_null(model: str, *columns: str) -> list[Test]:
    return [Test("not_null", model, c) for c in columns]


def _unique(model: str, *columns: str) -> list[Test]:
    return [Test("unique", model, c) for c in columns]


def _range(model: str, column: str, low: float | None = None, high: float | None = None) -> Test:
    return Test("accepted_range", model, column, {"low": low, "high": high})


def default_suite(lat: tuple[float, float], lon: tuple[float, float]) -> list[Test]:
    """The tests of the feed's seven models and two sources; the bounding box belongs to the feed."""
    return [
        *_unique("station_status", "status_id"),
        *_not_null("station_status", "status_id"),
        *_unique("station_information", "station_id"),
        *_not_null("station_information", "station_id"),
        *_unique("stg_station_status", "status_id"),
        *_not_null(
            "stg_station_status",
            "status_id",
            "station_id",
            "last_reported",
            "num_bikes_available",
            "num_docks_available",
        ),
        _range("stg_station_status", "num_bikes_available", 0),
        _range("stg_station_status", "num_docks_available", 0),
        _range("stg_station_status", "latence_pipeline_s", 0),
        *_unique("stg_station_information", "station_id"),
        *_not_null("stg_station_information", "station_id", "capacite"),
        _range("stg_station_information", "capacite", 0, 200),
        _range("stg_station_information", "lat", *lat),
        _range("stg_station_information", "lon", *lon),
        *_unique("dim_station", "station_id"),
        *_not_null("dim_station", "station_id", "capacite"),
        Test("unique_combination", "fct_station_status", "station_id, last_reported"),
        *_unique("fct_station_status", "status_id"),
        *_not_null("fct_station_status", "status_id", "station_id"),
        Test("relationships", "fct_station_status", "station_id", {"to": "dim_station", "field": "station_id"}),
        _range("fct_station_status", "taux_remplissage", 0, 1),
        _range("agg_occupation_horaire", "part_releves_vide", 0, 1),
        *_unique("agg_reseau_horaire", "heure_locale"),
        *_not_null("agg_reseau_horaire", "heure_locale"),
        *_unique("stations_vides_pleines", "station_id"),
        *_not_null("stations_vides_pleines", "station_id"),
        Test("described_stations", "stg_station_status", "station_id"),
        Test("bikes_within_capacity", "fct_station_status", "num_bikes_available"),
    ]


def _failing_rows(test: Test, tables: Tables) -> DataFrame:
    model = tables[test.model]
    if test.kind == "unique":
        return not_unique(model, test.column)
    if test.kind == "unique_combination":
        return repeated(model, [c.strip() for c in test.column.split(",")])
    if test.kind == "relationships":
        return without_parent(model, test.column, tables[test.options["to"]], test.options["field"])
    if test.kind == "described_stations":
        return undescribed_stations(model, tables["dim_station"])
    raise ValueError(f"unknown test {test.kind}")


def _row_rule(test: Test) -> Column | None:
    """The failing-row condition of tests that look at one row only."""
    if test.kind == "not_null":
        return F.col(test.column).isNull()
    if test.kind == "accepted_range":
        return _outside(test.column, test.options["low"], test.options["high"])
    if test.kind == "bikes_within_capacity":
        return F.col("num_bikes_available") > F.col("capacity")
    return None


def run_suite(suite: list[Test], tables: Tables) -> DataFrame:
    """One row for each test: failures and verdict.

    All one-row tests of a model are counted in a single pass over it; tests on keys need a
    shuffle of that key alone.
    """
    by_model: dict[str, list[Test]] = {}
    parts: list[DataFrame] = []
    for test in suite:
        if _row_rule(test) is not None:
            by_model.setdefault(test.model, []).append(test)
        else:
            failing = _failing_rows(test, tables).agg(F.count(F.lit(1)).alias("failures"))
            parts.append(failing.select(*_labels(test), "failures"))
    for model, tests in by_model.items():
        counted = tables[model].agg(*[F.count_if(_row_rule(t)).alias(f"f{i}") for i, t in enumerate(tests)])
        rows = [F.struct(*_labels(t), F.col(f"f{i}").alias("failures")) for i, t in enumerate(tests)]
        parts.append(counted.select(F.inline(F.array(*rows))))
    verdict = F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status")
    return reduce(DataFrame.unionByName, parts).select("test", "model", "column", "failures", verdict)


# Models of which a build sees only the new rows, and the key of a reading besides its number.
GROWING = ("station_status", "stg_station_status", "fct_station_status")
PAIR_KEY = ["station_id", "last_reported"]


def _counted_by_row(suite: list[Test], model: str) -> list[Test]:
    return [t for t in suite if t.model == model and _row_rule(t) is not None]


def daily_failures(models: Tables) -> DataFrame:
    """(test, model, column, failures, date) of new rows of growing models: tests on one row, and numbers that occur more than once.

    A number is above all numbers of earlier builds, so that repeated ones meet among the new rows; the models hold the same
    numbers, which are counted once for all of them.
    """
    # The bounding box concerns the descriptions only.
    suite = default_suite((0, 0), (0, 0))
    parts = []
    for model, rows in models.items():
        tests = _counted_by_row(suite, model)
        counted = rows.groupBy("date").agg(*[F.count_if(_row_rule(t)).alias(f"f{i}") for i, t in enumerate(tests)])
        found = F.inline(F.array(*[F.struct(*_labels(t), F.col(f"f{i}").alias("failures")) for i, t in enumerate(tests)]))
        parts.append(counted.select("date", found))
    numbers = next(iter(models.values())).filter(F.col("status_id").isNotNull())
    again = numbers.groupBy("status_id").agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("date")).filter(F.col("n") > 1)
    unique = [F.struct(*_labels(t)) for t in suite if t.kind == "unique" and t.model in models]
    again = again.groupBy("date").agg(F.count(F.lit(1)).alias("failures"))
    parts.append(again.select("date", "failures", F.inline(F.array(*unique))))
    return added_failures(reduce(DataFrame.unionByName, parts))


def daily_pair_failures(rows: DataFrame) -> DataFrame:
    """The same for the test of stations and times, from all rows of some days; the key holds the day."""
    (test,) = [t for t in default_suite((0, 0), (0, 0)) if t.kind == "unique_combination"]
    again = repeated(rows, [*PAIR_KEY, "date"]).groupBy("date").agg(F.count(F.lit(1)).alias("failures"))
    return again.select(*_labels(test), "failures", "date")


def added_failures(rows: DataFrame) -> DataFrame:
    """Failures of several builds as one row for each test and day; none where nothing failed."""
    found = rows.groupBy("test", "model", "column", "date").agg(F.sum("failures").alias("failures"))
    return found.filter(F.col("failures") > 0).select("test", "model", "column", "failures", "date")


def merged_verdicts(suite: list[Test], tables: Tables, stored: list[DataFrame], sums: DataFrame) -> DataFrame:
    """The verdicts of `run_suite` from the failures that builds stored, and hourly sums of all readings for the tests of stations.

    Descriptions and marts are small, or written anew by each build, and are tested as they are.
    """
    small = [t for t in suite if t.model not in GROWING]
    grown = [t for t in suite if t.model in GROWING]
    by_station = sums.groupBy("station_id").agg(F.sum("n").alias("n"))
    strangers = by_station.join(tables["dim_station"].select("station_id"), "station_id", "left_anti")
    of_stations = {
        # A null station has no parent to lack, but is a station without a description.
        "relationships": F.coalesce(F.sum(F.when(F.col("station_id").isNotNull(), F.col("n"))), F.lit(0)),
        "described_stations": F.count(F.lit(1)),
    }
    (described,) = [t for t in grown if t.kind == "described_stations"]
    (related,) = [t for t in grown if t.kind == "relationships"]
    counted = strangers.agg(*[F.struct(*_labels(t), of_stations[t.kind].alias("failures")).alias(t.kind) for t in (described, related)])
    counted = counted.select(F.inline(F.array("described_stations", "relationships")))
    none = sums.sparkSession.createDataFrame([(t.kind, t.model, t.column, 0) for t in grown], "test string, model string, column string, failures long")
    rows = [r.select("test", "model", "column", "failures") for r in (none, counted, *stored)]
    failures = reduce(DataFrame.unionByName, rows).groupBy("test", "model", "column").agg(F.sum("failures").alias("failures"))
    verdict = F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status")
    return run_suite(small, tables).unionByName(failures.select("*", verdict))


def _labels(test: Test) -> list[Column]:
    return [F.lit(test.kind).alias("test"), F.lit(test.model).alias("model"), F.lit(test.column).alias("column")]


def summary(verdicts: DataFrame) -> DataFrame:
    return verdicts.agg(
        F.count(F.lit(1)).alias("tests"),
        F.count_if(F.col("status") == "pass").alias("passed"),
        F.count_if(F.col("status") == "fail").alias("failed"),
    )


def freshness(
    df: DataFrame, column: str, as_of: datetime | str, warn_minutes: int = 5, error_minutes: int = 15
) -> DataFrame:
    """Age of the newest row at `as_of`, judged pass, warn or error (error when there is no row)."""
    now = F.lit(as_of).cast("timestamp")
    age = F.unix_seconds(now) - F.unix_seconds("newest")
    exact = (F.unix_micros(now) - F.unix_micros("newest")).cast("long")
    status = (
        F.when(F.col("newest").isNull() | (exact > error_minutes * 60_000_000), "error")
        .when(exact > warn_minutes * 60_000_000, "warn")
        .otherwise("pass")
    )
    return df.agg(F.max(column).alias("newest")).select("newest", age.alias("age_s"), status.alias("status"))

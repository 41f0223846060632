"""Compaction, retention and what readers open."""

import os
import re
from datetime import UTC, datetime

import pytest
from feed import BIKES, OTHER, STATION, T0, information, messages, status
from pyspark.sql import functions as F

from stationflow.build import Build
from stationflow.streaming import changes as ch
from stationflow.streaming import ingest as ing
from stationflow.streaming.store import COMPACTED, BatchStore, Part, State, as_number, to_merge

INFO = "station_information"


def files_of(df):
    return {os.path.dirname(f).split("/station_status/")[-1] for f in df.inputFiles()}


def folders(root, table):
    return sorted(f"{s}/{b}" for s in os.listdir(f"{root}/{table}") if s.startswith("stream_id") for b in os.listdir(f"{root}/{table}/{s}") if b.startswith("batch_id"))


@pytest.mark.parametrize("fan", [2, 3, 8])
def test_parts_stay_few_and_rows_are_rewritten_seldom(fan):
    """A thousand batches: the parts that a batch has to open, and how often a batch's rows have been rewritten."""
    state, rewritten, most = State(), {}, 0
    content: dict = {}
    for batch in range(1000):
        part = Part(("s", batch), state.sequence, held={"t": {}})
        content[part.pair] = [batch]
        state = state.with_part(part)
        chosen = to_merge(state.parts, fan)
        if chosen:
            pair = (COMPACTED, state.sequence)
            content[pair] = [b for p in chosen for b in content[p.pair]]
            for b in content[pair]:
                rewritten[b] = rewritten.get(b, 0) + 1
            new = Part(pair, state.sequence, 1 + max(p.level for p in chosen), {"t": {}}, {"s": batch}, tuple(p.pair for p in chosen))
            state = state.with_part(new)
        most = max(most, len(state.parts))
        assert [b for p in state.parts for b in content[p.pair]] == list(range(batch + 1))
        assert state.marks == {"s": batch}
    levels = 1 + max(p.level for p in state.parts)
    assert most <= fan * levels and max(rewritten.values()) <= levels and fan ** (levels - 1) <= 1000 * fan


def body(batch):
    """A batch that repeats a reading of an earlier one, brings a new one and one of a distant day, and describes a station."""
    again = [status(last_reported=T0 + 60 * (batch - 1), num_bikes_available=0)] if batch else []
    return [*again, status(last_reported=T0 + 60 * batch), status(station_id=OTHER, last_reported=T0 - batch * 86400),
            (INFO, information(name=f"n{batch}", feed_last_updated=T0 - batch)), (INFO, information(station_id=OTHER, name=f"o{batch}")), None]


def run(spark, root, batches, fan, stream="s"):
    body_of = ing.Ingest(ing.raw_store(str(root), fan), stream)
    for b in batches:
        body_of(messages(spark, body(b), start=100 * b), b)
    return body_of


def shown(spark, root, order="arrival"):
    tables = ing.raw_tables(spark, str(root), order)
    keep = {
        "station_status": ["status_id", "station_id", "last_reported", "num_bikes_available", "kafka_offset"],
        "station_information": ["station_id", "name", "kafka_offset"],
        "rejected_messages": ["rejected_id", "kafka_offset", "error"],
        "ingest_batches": ["stream_id", "batch_id", "received", "invalid", "status_inserted", "last_status_id", "last_rejected_id"],
    }
    return {t: sorted(map(tuple, tables[t].select(*c).collect())) for t, c in keep.items()}


def test_compacted_tables_equal_uncompacted_ones(spark, tmp_path):
    run(spark, tmp_path / "a", range(5), fan=2)
    run(spark, tmp_path / "b", range(5), fan=100)
    for order in ("arrival", "feed_last_updated"):
        assert shown(spark, tmp_path / "a", order) == shown(spark, tmp_path / "b", order)
    store = ing.raw_store(str(tmp_path / "a"), 2)
    state = store.state(spark)
    assert [p.level for p in state.parts] == [2, 0] and state.parts[0].pair[0] == COMPACTED
    # The log is reduced: a station has at most one row in either order.
    log = store.read(spark, "station_information", State(state.parts[:1]))
    assert 2 <= log.count() <= 4
    # Compacted, restarted, and fed everything again: nothing changes but the ledger.
    before = shown(spark, tmp_path / "a")
    run(spark, tmp_path / "a", range(2), fan=2, stream="again")
    after = shown(spark, tmp_path / "a")
    assert after["station_status"] == before["station_status"] and len(after["ingest_batches"]) == 7


def test_a_batch_opens_what_the_ledger_names(spark, tmp_path):
    body_of = run(spark, tmp_path, range(5), fan=3)
    store = body_of.store
    state = store.state(spark)
    assert state == body_of.state and [p.level for p in state.parts] == [1, 0, 0]
    live = {f"stream_id={s}/batch_id={b}" for s, b in (p.pair for p in state.parts)}
    whole = store.read(spark, "station_status", state)
    assert {"/".join(f.split("/")[:2]) for f in files_of(whole)} == live
    newest = {"last_reported": (datetime.fromtimestamp(T0 + 60 * 3 + 30, UTC), None)}
    opened = {f.split("/")[1] for f in files_of(store.read(spark, "station_status", state, newest))}
    assert opened == {"batch_id=4"}


@pytest.mark.parametrize("table", ["station_information", "ingest_batches", "cleared"])
def test_a_crash_of_the_compaction_loses_nothing(spark, tmp_path, table, monkeypatch):
    run(spark, tmp_path / "whole", range(4), fan=100)
    run(spark, tmp_path / "a", range(2), fan=100)
    broken = ing.Ingest(ing.raw_store(str(tmp_path / "a"), 3), "s")
    write, publish = broken.store.write, broken.store._publish

    def dies(name, rows, stream, batch, **more):
        found = write(name, rows, stream, batch, **more)
        if stream == COMPACTED and name == table:
            raise RuntimeError("lost")
        return found

    def publication_dies(rows, part):
        if part.level and table == "ingest_batches":
            raise RuntimeError("lost")
        publish(rows, part)

    def clearing_dies(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(broken.store, "write", dies)
    monkeypatch.setattr(broken.store, "_publish", publication_dies)
    if table == "cleared":
        monkeypatch.setattr(broken.store, "cleared", clearing_dies)
    with pytest.raises(RuntimeError):
        broken(messages(spark, body(2), start=200), 2)  # the third part fills a level
    run(spark, tmp_path / "a", [2, 3], fan=3)  # batch 2 was committed, and is passed over
    assert shown(spark, tmp_path / "a") == shown(spark, tmp_path / "whole")
    state = ing.raw_store(str(tmp_path / "a"), 3).state(spark)
    assert any(p.level for p in state.parts)


def test_a_reader_keeps_what_one_compaction_replaced(spark, tmp_path):
    body_of = run(spark, tmp_path, range(2), fan=3)
    store, old = body_of.store, body_of.store.state(spark)
    rows = store.read(spark, "station_status", old)
    n = rows.count()
    body_of(messages(spark, body(2), start=200), 2)  # compacts
    assert body_of.state.parts[-1].level and rows.count() == n
    for b in range(3, 6):
        body_of(messages(spark, body(b), start=100 * b), b)
    assert "stream_id=s/batch_id=0" not in folders(tmp_path, "station_status")
    assert "stream_id=s/batch_id=0" not in folders(tmp_path, "ingest_batches")


def test_a_retry_leaves_nothing_of_the_attempt_before(spark, tmp_path):
    store = BatchStore(str(tmp_path), "led", {"t": _rows(spark).schema, "led": _rows(spark).select("stream_id", "batch_id").schema}, by={"t": ["day"]}, zones={"t": ["v"]})
    store.write("t", _rows(spark, 1, 2, 3), "s", 0)  # dies
    store.begin()
    store.write("t", _rows(spark, 2), "s", 0)
    assert store.read(spark, "t").count() == 0
    store.commit(spark, store.state(spark), "s", 0, {})
    assert [r["v"] for r in store.read(spark, "t").collect()] == [2]
    assert store.state(spark).parts[0].held == {"t": {"v": (2, 2)}}
    with pytest.raises(ValueError):
        store.commit(spark, store.state(spark), COMPACTED, 0, {})
    with pytest.raises(ValueError):
        store.write("t", _rows(spark, 2), "a/b", 0)


def _rows(spark, *values):
    frame = spark.createDataFrame([(v, v) for v in values], "v long, day long")
    return frame.withColumns({"stream_id": F.lit("s"), "batch_id": F.lit(0).cast("long")})


def test_a_batch_without_rows_holds_no_table(spark, tmp_path):
    store = BatchStore(str(tmp_path), "led", {"t": _rows(spark).schema, "led": _rows(spark).select("stream_id", "batch_id").schema}, zones={"t": ["v"]}, fan=2)
    state = store.state(spark)
    for b in range(4):
        store.write("t", _rows(spark, *([b] if b == 1 else [])), "s", b)
        state = store.compacted(spark, store.commit(spark, state, "s", b, {}))
    assert [r["v"] for r in store.read(spark, "t").collect()] == [1]
    assert store.read(spark, "t", within={"v": (5, None)}).count() == 0
    assert store.ledger(spark).count() == 4 and store.state(spark) == state


def test_bounds_are_compared_as_times():
    assert as_number("2024-01-01 00:00:00.000001") == as_number(datetime(2024, 1, 1, 0, 0, 0, 1, tzinfo=UTC)) == 1704067200000001
    assert as_number("2024-01-01 01:00:00+01:00") == 1704067200000000 and as_number(7) == 7
    part = Part(("s", 0), 0, held={"t": {"c": (10, 20)}})
    for within, held in [((None, 9), False), ((None, 10), True), ((20, None), True), ((21, None), False), ((11, 12), True), ((None, None), True)]:
        assert part.may_hold("t", {"c": within}) == held
    assert part.may_hold("t", {"other": (1, 2)}) and not part.may_hold("u", {})


def test_change_state_grows_with_the_stations_only(spark, tmp_path):
    store = ch.change_store(str(tmp_path), 3)
    body_of = ch.Changes(store, "s")
    for b in range(7):
        rows = [(INFO, {"name": f"{b}"})] * 2
        body_of(messages(spark, rows, start=10 * b).withColumn("key", F.concat(F.lit("k"), F.col("offset") % 2)), b)
    state = store.state(spark)
    assert store.read(spark, "changes", state).count() == 14
    assert store.read(spark, "latest", state).count() == 2 * len(state.parts) and len(state.parts) == 3
    plan = body_of._changed(spark, _hashed(spark))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"FileScan parquet.*PartitionFilters: \[[^\]]*bucket", plan)


def _hashed(spark):
    rows = spark.createDataFrame([("k1", "{}", 0, 500)], "key string, value string, partition int, offset long")
    return rows.withColumn("state", F.struct(F.lit("x").alias("d")))


def test_builds_over_compacted_tables(spark, tmp_path):
    """Builds between compactions of both stores equal one build over all; older builds are removed."""
    def build(name, fan):
        return Build(spark, str(tmp_path / f"raw-{name}"), str(tmp_path / f"marts-{name}"), fan=fan)

    body_of = ing.Ingest(ing.raw_store(str(tmp_path / "raw-many"), 2), "s")
    for b in range(3):
        body_of(messages(spark, body(b), start=100 * b), b)
        build("many", 2).run()
    run(spark, tmp_path / "raw-one", range(3), fan=100)
    build("one", 100).run()
    many, one = build("many", 2).tables(), build("one", 100).tables()
    for name in ("agg_occupation_horaire", "agg_reseau_horaire", "stations_vides_pleines"):
        assert sorted(map(str, many[name].collect())) == sorted(map(str, one[name].collect())), name
    assert many["fct_station_status"].count() == one["fct_station_status"].count() == 6
    assert many["station_status"].agg(F.max("num_bikes_available")).first()[0] == BIKES and STATION
    store = build("many", 2).store
    state = store.state(spark)
    assert store.read(spark, "hourly_sums", State(state.parts[:1])).groupBy("station_id", "heure_locale").count().where("count > 1").isEmpty()
    build("many", 2).run(refresh_dim=True)
    build("many", 2).tidy()
    left = folders(tmp_path / "marts-many", "fct_station_status")
    assert all("generation-0" not in f for f in left)
    assert build("many", 2).tables()["fct_station_status"].count() == 6
    assert store.ledger(spark).count() == 4


def test_a_panel_over_one_hour_reads_that_hours_batches(spark, tmp_path):
    hours = iter(range(100))
    for b in range(3):
        hour = next(hours)
        ing.Ingest(ing.raw_store(str(tmp_path)), "s", clock=lambda: datetime(2024, 2, 1, hour, tzinfo=UTC))(messages(spark, body(b), start=100 * b), b)
    raw = ing.raw_tables(spark, str(tmp_path), ingested=("2024-02-01 00:30:00", "2024-02-01 01:30:00"))
    assert {f.split("/")[1] for f in files_of(raw["station_status"])} == {"batch_id=1"}
    assert raw["station_status"].count() == 2 and raw["rejected_messages"].count() == 1
    assert ing.raw_tables(spark, str(tmp_path))["station_status"].count() == 6

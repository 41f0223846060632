from datetime import UTC, datetime, timedelta

import pytest
from feed import BIKES, OTHER, STATION, T0, information, messages, status

from stationflow.sources.messages import message_files, publish_files
from stationflow.streaming import ingest as ing

INFO = "station_information"


class Clock:
    def __init__(self):
        self.now = datetime(2026, 9, 22, 12, 0, tzinfo=UTC)

    def __call__(self):
        self.now += timedelta(seconds=1)
        return self.now


def runner(root, stream="s", **options):
    return ing.Ingest(ing.raw_store(str(root)), stream, clock=Clock(), **options)


def readings(spark, root):
    rows = ing.raw_tables(spark, str(root))["station_status"].orderBy("status_id").collect()
    return [(r["status_id"], r["station_id"], int(r["last_reported"].timestamp()) - T0, r["num_bikes_available"]) for r in rows]


def ledger(spark, root):
    rows = ing.raw_tables(spark, str(root))["ingest_batches"].orderBy("stream_id", "batch_id").collect()
    names = ["received", "invalid", "status_valid", "status_inserted", "status_duplicates", "information_upserted"]
    return [tuple(r[n] for n in names) for r in rows]


# A reading twice, the second time with other counts, and again ten minutes on; two messages to reject; two descriptions.
BATCH_0 = [status(), status(num_bikes_available=BIKES + 2), status(last_reported=T0 + 600), status(station_id="\n"), None,
           (INFO, information()), (INFO, information(name="Later")), ("elsewhere", b"[1]")]
BATCH_1 = [status(num_bikes_available=BIKES - 3), status(station_id=OTHER), status(last_reported=T0 - 7 * 86400),
           (INFO, information(station_id=OTHER, name="Other"))]


def test_dedup_quarantine_upsert_and_ledger(spark, tmp_path):
    run = runner(tmp_path)
    run(messages(spark, BATCH_0), 0)
    run(messages(spark, BATCH_1, start=100), 1)
    # the first reading of a key wins for ever; a reading a week late is kept
    assert readings(spark, tmp_path) == [
        (1, STATION, 0, BIKES), (2, STATION, 600, BIKES), (3, OTHER, 0, BIKES), (4, STATION, -7 * 86400, BIKES)]
    assert ledger(spark, tmp_path) == [(8, 2, 3, 2, 1, 2), (4, 0, 3, 2, 1, 1)]
    tables = ing.raw_tables(spark, str(tmp_path))
    assert {r["station_id"]: r["name"] for r in tables["station_information"].collect()} == {STATION: "Later", OTHER: "Other"}
    rejected = tables["rejected_messages"].orderBy("rejected_id").collect()
    assert [(r["rejected_id"], r["kafka_offset"]) for r in rejected] == [(1, 3), (2, 4)]
    assert rejected[1]["payload"] == ""


def test_replay_inserts_nothing(spark, tmp_path):
    runner(tmp_path, "a")(messages(spark, BATCH_0), 0)
    before = readings(spark, tmp_path)
    runner(tmp_path, "b")(messages(spark, BATCH_0), 0)
    assert readings(spark, tmp_path) == before
    assert ledger(spark, tmp_path)[1] == (8, 2, 3, 0, 3, 2)


def test_committed_batch_is_not_written_again(spark, tmp_path):
    run = runner(tmp_path)
    run(messages(spark, BATCH_0), 0)
    runner(tmp_path)(messages(spark, BATCH_1), 0)
    assert len(ledger(spark, tmp_path)) == 1


@pytest.mark.parametrize("table", ["station_status", "station_information", "rejected_messages"])
def test_failure_between_writes(spark, tmp_path, table, monkeypatch):
    run = runner(tmp_path)
    run(messages(spark, BATCH_1[:1]), 0)
    broken = runner(tmp_path)
    real = broken.store.write

    def fail_after(name, *args):
        real(name, *args)
        if name == table:
            raise RuntimeError("lost")

    monkeypatch.setattr(broken.store, "write", fail_after)
    with pytest.raises(RuntimeError):
        broken(messages(spark, BATCH_0), 1)
    assert readings(spark, tmp_path) == [(1, STATION, 0, BIKES - 3)]  # half a batch is invisible
    runner(tmp_path)(messages(spark, BATCH_0), 1)
    assert readings(spark, tmp_path) == [(1, STATION, 0, BIKES - 3), (2, STATION, 600, BIKES)]
    assert ledger(spark, tmp_path)[1] == (8, 2, 3, 1, 2, 2)


def test_empty_batch_leaves_no_ledger_row(spark, tmp_path):
    run = runner(tmp_path)
    run(messages(spark, []), 0)
    run(messages(spark, BATCH_1), 1)
    assert len(ledger(spark, tmp_path)) == 1


def test_position_of_last_message(spark, tmp_path):
    runner(tmp_path, position="last")(messages(spark, BATCH_0), 0)
    rows = ing.raw_tables(spark, str(tmp_path))["station_status"].orderBy("status_id").collect()
    assert [(r["num_bikes_available"], r["kafka_offset"]) for r in rows] == [(BIKES, 1), (BIKES, 2)]


def test_description_order(spark, tmp_path):
    run = runner(tmp_path)
    run(messages(spark, [(INFO, information(name="new", feed_last_updated=T0 + 9))]), 0)
    run(messages(spark, [(INFO, information(name="old"))]), 1)
    arrival = ing.raw_tables(spark, str(tmp_path))["station_information"].first()["name"]
    newest = ing.raw_tables(spark, str(tmp_path), "feed_last_updated")["station_information"].first()["name"]
    assert (arrival, newest) == ("old", "new")


def test_last_arrival_wins_when_the_clock_goes_back(spark, tmp_path):
    early = Clock()
    ing.Ingest(ing.raw_store(str(tmp_path)), "a", clock=Clock())(messages(spark, [(INFO, information(name="first"))]), 5)
    early.now -= timedelta(hours=4)
    ing.Ingest(ing.raw_store(str(tmp_path)), "b", clock=early)(messages(spark, [(INFO, information(name="second"))]), 0)
    assert ing.raw_tables(spark, str(tmp_path))["station_information"].first()["name"] == "second"


def test_batch_of_distant_days(spark, tmp_path):
    run = runner(tmp_path)
    days = [status(last_reported=T0 + d * 86400) for d in range(4)]
    run(messages(spark, days), 0)
    run(messages(spark, days + [status(last_reported=T0 + 9 * 86400)]), 1)
    assert [r[1] for r in ledger(spark, tmp_path)] == [0, 0]
    assert [r[3] for r in ledger(spark, tmp_path)] == [4, 1]


def test_stream_with_restart_and_second_source(spark, tmp_path):
    live, replay, root, checkpoint = (str(tmp_path / n) for n in ("live", "replay", "raw", "checkpoint"))
    publish_files(messages(spark, BATCH_0), live)
    publish_files(messages(spark, BATCH_1, start=100), replay)

    def run():
        both = message_files(spark, live, streaming=True).unionByName(message_files(spark, replay, streaming=True))
        ing.start_ingest(both, root, checkpoint, clock=Clock()).awaitTermination()

    run()
    assert len(readings(spark, root)) == 4
    run()  # nothing new
    publish_files(messages(spark, [status(last_reported=T0 + 120)], start=200), live)
    run()
    rows = readings(spark, root)
    assert len(rows) == 5 and [r[0] for r in rows] == [1, 2, 3, 4, 5]
    total = [sum(c) for c in zip(*ledger(spark, root))]
    assert total[0] == total[1] + total[2] + total[5] + 1  # one message of another topic
    assert total[2] == total[3] + total[4]

import gzip
import json
import statistics
from datetime import UTC, datetime
from zoneinfo import ZoneInfo

import pytest
from feed import OTHER, STATION, T0, THIRD, envelope, information, status, without

from stationflow.plans import validate
from stationflow.plans.archive import Archive
from stationflow.sources import archive
from stationflow.streaming import ingest as ing

STATIONS = [STATION, OTHER, THIRD]


def station(sid, bikes, docks, at, **more):
    return without(status(station_id=sid, num_bikes_available=bikes, num_docks_available=docks, last_reported=at, **more),
                   "feed_last_updated", "fetched_at")


def write_lines(path, lines):
    text = "".join(line if isinstance(line, str) else json.dumps(line) + "\n" for line in lines)
    if path.suffix == ".gz":
        with gzip.open(path, "wt", encoding="utf-8") as out:
            out.write(text)
    else:
        path.write_text(text, encoding="utf-8")


def polls():
    """(fetched_at, last_updated, stations): six polls, the third of them redundant, one long gap."""
    out = []
    for i, (at, delay) in enumerate([(0, 5), (60, 9.25), (60, 30), (121, 4), (300, 59), (360, 1)]):
        t = T0 + at
        rows = [station(STATION, i % 3, 8 - i % 3, t), station(OTHER, 0, 9, t), station(THIRD, 9, 0, t, is_installed=i % 2 == 0)]
        out.append((t + delay, t, rows))
    return out


@pytest.fixture
def folder(tmp_path):
    where = tmp_path / "archive"
    where.mkdir()
    described = [without(information(station_id=s, name=f"N{s}", capacity=8), "feed_last_updated") for s in STATIONS[:2]]
    renamed = [without(information(station_id=STATION, name="Newer", capacity=1), "feed_last_updated")]
    write_lines(where / "station_information_2025-03-08.jsonl", [{"fetched_at": 1.0, "information": envelope(described)}])
    write_lines(where / "station_information_2025-03-09.jsonl", [{"fetched_at": 2.0, "information": envelope(renamed)}])
    lines = [{"fetched_at": f, "status": envelope(s, at)} for f, at, s in polls()]
    write_lines(where / "station_status_2025-03-09.jsonl.gz", lines[:4])
    write_lines(where / "station_status_2025-03-10.jsonl", lines[4:])
    write_lines(where / "notes.jsonl", ["ignored\n"])
    return where


def test_replay_order_and_flag(spark, folder):
    rows = archive.archive_messages(archive.archive_lines(spark, str(folder))).orderBy("offset").collect()
    assert [r["topic"] for r in rows] == ["station_information"] * 3 + ["station_status"] * 18
    assert [r["offset"] & 0xFFFFF for r in rows] == [0, 1, 0] + [0, 1, 2] * 6
    assert [r["offset"] >> 20 for r in rows] == [0, 0, 1] + [i for i in range(2, 8) for _ in range(3)]
    assert [r["key"] for r in rows[:3]] == [STATION, OTHER, STATION]
    judged = validate.checked(archive.archive_messages(archive.archive_lines(spark, str(folder))))
    statuses = validate.valid_statuses(judged).collect()
    assert len(statuses) == 18 and all(r["is_replay"] for r in statuses)
    assert statuses[0]["feed_last_updated"] is not None


def test_landed_snapshots_are_not_replays(spark, folder):
    judged = validate.checked(archive.archive_messages(archive.archive_lines(spark, str(folder)), replay=False))
    assert not any(r["is_replay"] for r in validate.valid_statuses(judged).collect())


def test_snapshot_fields_replace_the_stations_own(spark, tmp_path):
    line = {"fetched_at": 5.0, "status": envelope([status(feed_last_updated=3, fetched_at="x")], 77)}
    write_lines(tmp_path / "station_status_a.jsonl", [line])
    rows = validate.checked(archive.archive_messages(archive.archive_lines(spark, str(tmp_path)))).collect()
    assert int(rows[0]["status"]["feed_last_updated"].timestamp()) == 77
    assert rows[0]["status"]["fetched_at"].timestamp() == 5.0


BROKEN = [
    ("{\n", "not JSON"),
    ({"fetched_at": 1}, "last_updated"),
    ({"fetched_at": 1, "status": {"ttl": 60, "data": {"stations": []}}}, "last_updated"),
    ({"fetched_at": 1, "status": {"last_updated": True, "ttl": 60, "data": {"stations": []}}}, "integer wanted"),
    ({"fetched_at": 1, "status": {"last_updated": 0, "ttl": 60, "data": {"stations": []}}}, ">= 1"),
    ({"fetched_at": 1, "status": {"last_updated": 1, "data": {"stations": []}}}, "ttl"),
    ({"fetched_at": 1, "status": {"last_updated": 1, "ttl": -1, "data": {"stations": []}}}, ">= 0"),
    ({"fetched_at": 1, "status": {"last_updated": 1, "ttl": 60, "data": {}}}, "data.stations"),
    ({"fetched_at": 1, "status": {"last_updated": 1, "ttl": 60, "data": {"stations": {}}}}, "list wanted"),
    ({"fetched_at": 1, "status": envelope([5])}, "object wanted"),
]


def test_broken_snapshots_are_quarantined(spark, tmp_path):
    write_lines(tmp_path / "station_status_a.jsonl", [b for b, _ in BROKEN])
    judged = validate.checked(archive.archive_messages(archive.archive_lines(spark, str(tmp_path))))
    rows = judged.orderBy("kafka_offset").collect()
    assert len(rows) == len(BROKEN)
    for row, (_, wanted) in zip(rows, BROKEN):
        assert wanted in row["error"], row["error"]


def test_archive_stream_feeds_the_ingest(spark, folder, tmp_path):
    def decode(batch):
        return archive.archive_messages(archive.positioned(batch))

    def run():
        lines = archive.archive_lines(spark, str(folder), streaming=True, files_per_batch=1)
        ing.start_ingest(lines, str(tmp_path / "raw"), str(tmp_path / "cp"), decode=decode,
                         block_bits=archive.BLOCK_BITS).awaitTermination()

    run()
    run()
    tables = ing.raw_tables(spark, str(tmp_path / "raw"))
    assert tables["station_status"].count() == 15  # 18 messages, 3 of a redundant poll
    assert tables["station_status"].filter("is_replay").count() == 15
    assert tables["station_information"].count() == 2


def expected():
    seen, shots = set(), []
    for fetched, at, rows in sorted(polls(), key=lambda p: p[0]):
        if at not in seen:
            seen.add(at)
            shots.append((fetched, at, rows))
    return shots


def test_offline_overview_equals_brute_force(spark, folder):
    shots = expected()
    row = Archive(archive.archive_lines(spark, str(folder))).overview().first()
    times = sorted(at for _, at, _ in shots)
    gaps = [b - a for a, b in zip(times, times[1:])]
    ages = [f - at for f, at, _ in shots]
    flat = [s for _, _, rows in shots for s in rows]
    fills = [s["num_bikes_available"] / (s["num_bikes_available"] + s["num_docks_available"]) for s in flat]
    empty = sum(s["is_installed"] and s["num_bikes_available"] == 0 for s in flat)
    full = sum(s["is_installed"] and s["num_docks_available"] == 0 for s in flat)
    assert (row["interrogations"], row["instantanes_distincts"], row["interrogations_redondantes"]) == (6, 5, 1)
    assert (row["stations_decrites"], row["stations_observees"], row["releves_station"]) == (2, 3, 15)
    assert row["debut_utc"].replace(tzinfo=UTC) == datetime.fromtimestamp(times[0], UTC)
    assert float(row["ecart_median_entre_instantanes_s"]) == statistics.median(gaps)
    assert float(row["ecart_max_entre_instantanes_s"]) == max(gaps) and row["intervalles_superieurs_90s"] == 1
    assert float(row["age_du_flux_a_la_lecture_median_s"]) == round(statistics.median(ages), 2)
    assert float(row["age_du_flux_a_la_lecture_max_s"]) == max(ages)
    assert float(row["part_releves_vide"]) == round(empty / 15, 4)
    assert float(row["part_releves_pleine"]) == round(full / 15, 4)
    assert float(row["taux_remplissage_moyen"]) == round(statistics.fmean(fills), 4)
    assert row["capacite_totale"] == 9
    assert row["releves_velos_superieurs_capacite"] == sum(s["station_id"] == STATION and s["num_bikes_available"] > 1 for s in flat)


def test_offline_series_and_stations(spark, folder, tmp_path):
    whole = Archive(archive.archive_lines(spark, str(folder)))
    shots = expected()
    series = whole.network_series().collect()
    assert [r["velos_disponibles"] for r in series] == [sum(s["num_bikes_available"] for s in rows) for _, _, rows in shots]
    assert [r["stations_pleines"] for r in series] == [
        sum(s["is_installed"] and s["num_docks_available"] == 0 for s in rows) for _, _, rows in shots
    ]
    local = datetime.fromtimestamp(T0, ZoneInfo("Europe/Paris"))
    assert series[0]["horodatage_local"] == f"{local:%Y-%m-%d %H:%M:%S}"
    stations = whole.stations().collect()
    assert [r["station_id"] for r in stations] == [OTHER, STATION, THIRD]
    assert (stations[1]["nom"], stations[1]["capacite"]) == ("Newer", 1)
    assert (stations[2]["nom"], stations[2]["capacite"]) == ("", None)
    assert len(whole.export(str(tmp_path / "out"))) == 4
    written = spark.read.csv(str(tmp_path / "out" / "archive_stations"), header=True).collect()
    assert [r["station_id"] for r in written] == [OTHER, STATION, THIRD]


def test_offline_analysis_agrees_with_the_pipeline(spark, folder, tmp_path):
    from stationflow.plans import models

    whole = Archive(archive.archive_lines(spark, str(folder)))
    judged = validate.checked(archive.archive_messages(archive.archive_lines(spark, str(folder))))
    ingest = ing.Ingest(ing.raw_store(str(tmp_path / "raw")), "s", block_bits=archive.BLOCK_BITS)
    ingest(archive.archive_messages(archive.archive_lines(spark, str(folder))), 0)
    raw = ing.raw_tables(spark, str(tmp_path / "raw"))
    assert judged.count() == 21
    dimension = models.station_dimension(models.staged_information(raw["station_information"]))
    hours = models.network_hours(models.hourly_sums(models.fact(models.staged_status(raw["station_status"]), dimension)))
    names = ["nb_stations", "nb_releves", "taux_remplissage_moyen", "part_releves_vide", "part_releves_pleine"]
    assert [tuple(r[n] for n in names) for r in hours.orderBy("heure_locale").collect()] == [
        tuple(r[n] for n in names) for r in whole.hourly().collect()
    ]


def test_analysis_counts_lines_without_ttl_and_reports_the_unreadable(spark, tmp_path):
    good = {"fetched_at": T0 + 1.0, "status": envelope([station(STATION, 1, 2, T0)])}
    bare = {"fetched_at": T0 + 61.0, "status": without(envelope([station(STATION, 2, 1, T0 + 60)], T0 + 60), "ttl")}
    write_lines(tmp_path / "station_status_2025-03-09.jsonl", [good, bare, "{broken\n"])
    analysis = Archive(archive.archive_lines(spark, str(tmp_path)))
    assert [r["polls"] for r in analysis.snapshots.collect()] == [1, 1]
    assert [tuple(r) for r in analysis.unreadable().collect()] == [("status", "line is not JSON", 1)]

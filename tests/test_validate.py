import pytest
from feed import BIKES, DELAY, DOCKS, STATION, STATUS, T0, information, messages, status, without

from stationflow.plans import validate
from stationflow.schemas import INFORMATION_RECORD, STATUS_RECORD

INFO = "station_information"

COUNTS = [n for n in STATUS if n.startswith("num_")]
FLAGS = [n for n in STATUS if n.startswith("is_")]
TIMES = [n for n in STATUS if n.startswith(("last_", "feed_"))]


def broken_fields():
    """For each field of a status, values that break each rule of its kind, and what the error says."""
    for name in COUNTS:
        for value in (str(BIKES), float(BIKES), False, [BIKES], -(10**24) - BIKES):
            yield name, value, "integer wanted"
        yield name, -BIKES, ">= 0"
        yield name, 2**31 + BIKES, "32-bit"
    for name in FLAGS:
        for value in ("on", BIKES, [True]):
            yield name, value, "boolean wanted"
    for name in TIMES:
        yield name, -T0, ">= 1"
        yield name, T0 * 10**6, "timestamp"
    for value in ("\n", BIKES, [STATION]):
        yield "station_id", value, "station_id"
    for value in (False, [T0]):
        yield "fetched_at", value, "fetched_at"
    yield "vehicle_types_available", STATION, "list wanted"
    yield "replay", "never", "replay"


BAD = [
    *[(status(**{name: value}), wanted) for name, value, wanted in broken_fields()],
    *[(without(status(), name), name) for name in STATUS if name != "vehicle_types_available"],
    (without(status(), "num_docks_available", "is_renting"), "num_docks_available, is_renting"),
    # the first broken rule gives the error
    (status(station_id="\t", num_docks_available=-DOCKS), "station_id"),
    (status(fetched_at=[], station_id="\t"), "fetched_at"),
    (None, "not JSON"),
    (b"", "not JSON"),
    (b'{"station_id":', "not JSON"),
    (b'{"a": 1, "a": 2}', "not JSON"),
    (b'{"x": "\xff"}', "not JSON"),
    (b"[1]", "object wanted"),
    (b"5", "object wanted"),
    ((INFO, information(lat=95)), "out of bounds"),
    ((INFO, information(lon=-181)), "out of bounds"),
    ((INFO, information(lat="north")), "lat"),
    ((INFO, information(lat="95d")), "lat"),
    ((INFO, without(information(), "lon")), "lon"),
    ((INFO, information(name=None)), "name"),
    ((INFO, information(name="  ")), "name"),
    ((INFO, information(capacity=None)), "capacity"),
    ((INFO, information(capacity=2**40)), "32-bit"),
    ((INFO, information(is_virtual_station=2)), "is_virtual_station"),
    ((INFO, information(feed_last_updated=0)), ">= 1"),
    ((INFO, information(station_id=None)), "station_id"),
    (("elsewhere", b"{"), "not JSON"),
]

GOOD = [
    status(),
    status(replay=True),
    status(is_installed=1, is_renting=0, is_returning=0.0),
    status(vehicle_types_available=None),
    status(vehicle_types_available=0),
    status(fetched_at=T0),
    without(status(), "vehicle_types_available"),
    status(unknown={"a": 1}),
    (INFO, information()),
    (INFO, information(lat="43.5", lon=" 3.8 ")),
    (INFO, information(name=12)),
    (INFO, information(is_virtual_station=1)),
]


@pytest.fixture(scope="module")
def judged(spark):
    rows = validate.checked(messages(spark, [b for b, _ in BAD] + GOOD)).orderBy("kafka_offset")
    return rows.collect()


@pytest.mark.parametrize("i", range(len(BAD)))
def test_bad_message_is_rejected_with_the_right_error(judged, i):
    row, (_, wanted) = judged[i], BAD[i]
    assert row["outcome"] == "rejected" and wanted in row["error"], row["error"]
    assert row["status"] is None and row["information"] is None and row["payload"] is not None


@pytest.mark.parametrize("i", range(len(GOOD)))
def test_good_message_is_accepted(judged, i):
    row = judged[len(BAD) + i]
    assert row["error"] is None and row["payload"] is None
    assert (row["status"] is None) != (row["information"] is None)


def test_values(judged):
    rows = judged[len(BAD):]
    assert rows[0]["status"]["last_reported"].timestamp() == T0
    assert rows[0]["status"]["fetched_at"].timestamp() == T0 + DELAY
    assert [r["status"]["is_replay"] for r in rows[:2]] == [False, True]
    assert (rows[2]["status"]["is_installed"], rows[2]["status"]["is_renting"]) == (True, False)
    assert rows[9]["information"]["lat"] == 43.5 and rows[9]["information"]["lon"] == 3.8
    assert rows[10]["information"]["name"] == "12"
    assert rows[11]["information"]["is_virtual_station"] is True


def test_record_schemas(spark):
    out = validate.checked(messages(spark, [status()]))
    assert out.schema["status"].dataType.simpleString() == STATUS_RECORD.simpleString()
    assert out.schema["information"].dataType.simpleString() == INFORMATION_RECORD.simpleString()


def test_bad_bytes_are_replaced_in_the_payload(judged):
    i = [b for b, _ in BAD].index(b'{"x": "\xff"}')
    assert judged[i]["payload"] == '{"x": "�"}'


def test_other_topics_pass_without_record(spark):
    row = validate.checked(messages(spark, [("elsewhere", b"[1]")])).first()
    assert row["outcome"] is None and row["error"] is None and row["status"] is None

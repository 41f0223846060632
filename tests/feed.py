"""Generated feed inputs for the tests."""

from __future__ import annotations

import json
import random

from pyspark.sql import types as T

from stationflow.schemas import INFORMATION_RECORD, MESSAGE, STATUS_RECORD

_seed = random.Random("feed inputs of the tests")

# A time at least ten minutes away from a full hour, and stations in their order.
T0 = 3600 * _seed.randrange(494_000, 496_000) + _seed.randrange(600, 2400)
STATION, OTHER, THIRD = sorted(str(n) for n in _seed.sample(range(200, 1000), 3))
DELAY = _seed.randrange(9, 79, 2) / 4
BIKES, DOCKS = _seed.randrange(10, 20), _seed.randrange(20, 40)

# Optional fields, and the one that only replayed messages carry.
OPTIONAL = {"is_replay", "is_virtual_station"}


def _value(field: T.StructField):
    """A value for a field of a record, by its name where that says more than its type."""
    known = {
        "station_id": STATION,
        "num_bikes_available": BIKES,
        "num_docks_available": DOCKS,
        "fetched_at": T0 + DELAY,
        "lat": 43 + _seed.randrange(450, 750) / 1000,
        "lon": 3 + _seed.randrange(700, 990) / 1000,
        "vehicle_types_available": [{"vehicle_type_id": str(_seed.randrange(30, 90)), "count": BIKES}],
    }
    if field.name in known:
        return known[field.name]
    by_type = {T.TimestampType(): T0, T.BooleanType(): True, T.IntegerType(): BIKES + DOCKS, T.StringType(): "Place " + STATION}
    return by_type[field.dataType]


STATUS, INFORMATION = ({f.name: _value(f) for f in r.fields if f.name not in OPTIONAL} for r in (STATUS_RECORD, INFORMATION_RECORD))


def status(**changes) -> dict:
    return {**STATUS, **changes}


def information(**changes) -> dict:
    return {**INFORMATION, **changes}


def without(message: dict, *names: str) -> dict:
    return {k: v for k, v in message.items() if k not in names}


def messages(spark, bodies, topic="station_status", start=0):
    """Bodies (dict, bytes, or None) as a batch of messages in their order."""
    rows = []
    for i, body in enumerate(bodies):
        where, body = body if isinstance(body, tuple) else (topic, body)
        value = body if body is None or isinstance(body, bytes) else json.dumps(body).encode()
        rows.append(("k", value, where, 0, start + i, None))
    return spark.createDataFrame(rows, MESSAGE)


def envelope(stations: list[dict], at: int = T0) -> dict:
    return {"last_updated": at, "ttl": 60, "data": {"stations": stations}}

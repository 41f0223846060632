"""Kinds of messages, good and broken, made from the rules of the checks: each rule is broken by a value from a seed."""

from __future__ import annotations

import json
import random
from collections.abc import Iterator
from dataclasses import dataclass, field

from stationflow.plans.validate import COORDINATES, LARGEST_INT, LAST_SECOND, STATUS_COUNTS, STATUS_FLAGS, STATUS_REQUIRED, VEHICLES
from stationflow.sources.messages import INFORMATION_TOPIC, STATUS_TOPIC

OTHER_TOPIC = "elsewhere"


@dataclass(frozen=True)
class Kind:
    """A message of a topic with some fields as the given JSON text (None: left out), and the error it must give.

    `raw` replaces the whole payload: bytes, or None for a message without one.
    """

    topic: str = STATUS_TOPIC
    fields: dict[str, str | None] = field(default_factory=dict)
    error: str | None = None
    raw: bytes | None | str = "as built"


def _wrong_types(rng: random.Random, text: bool = True) -> Iterator[str]:
    """Values of no number, flag or list, over and over."""
    while True:
        yield json.dumps({f"k{rng.randrange(9)}": rng.randrange(9)}, separators=(",", ":"))
        if text:
            yield json.dumps(f"w{rng.randrange(100)}")


def _of_type(topic: str, name: str, wanted: str, value: str) -> Kind:
    return Kind(topic, {name: value}, f"{name}: {wanted}, got {value}")


def _too_large(topic: str, name: str, value: int, what: str) -> Kind:
    return Kind(topic, {name: str(value)}, f"{name}: out of range for a {what}, got {value}")


def broken(rng: random.Random) -> list[Kind]:
    """One kind for each way to break a rule of either topic."""
    wrong, no_text = _wrong_types(rng), _wrong_types(rng, text=False)
    found = []
    for topic, counts, times, flags, numbers in (
        (STATUS_TOPIC, STATUS_COUNTS, ("last_reported", "feed_last_updated"), (*STATUS_FLAGS, "replay"), ("fetched_at",)),
        (INFORMATION_TOPIC, ("capacity",), ("feed_last_updated",), ("is_virtual_station",), COORDINATES),
    ):
        for name in counts:
            found.append(_too_large(topic, name, LARGEST_INT + rng.randrange(1, 1000), "32-bit integer"))
        for name in times:
            found.append(_too_large(topic, name, LAST_SECOND + rng.randrange(1, 1000), "timestamp"))
        for name, least in [*[(n, 0) for n in counts], *[(n, 1) for n in times]]:
            found.append(_of_type(topic, name, f"must be >= {least}", str(-rng.randrange(2, 90))))
            found.append(_of_type(topic, name, "integer wanted", next(wrong)))
        found += [_of_type(topic, name, "boolean wanted", rng.choice([next(wrong), str(rng.randrange(2, 9))])) for name in flags]
        found += [_of_type(topic, name, "number wanted", next(no_text)) for name in numbers]
        found.append(_of_type(topic, "station_id", "non-blank text wanted", str(rng.randrange(1000))))
        found.append(_of_type(topic, "station_id", "non-blank text wanted", json.dumps(" " * rng.randrange(2, 5))))
    found.append(_of_type(STATUS_TOPIC, VEHICLES, "list wanted", next(no_text)))
    found += [Kind(STATUS_TOPIC, {name: None}, f"missing fields: {name}") for name in STATUS_REQUIRED]
    found.append(Kind(INFORMATION_TOPIC, {"name": None}, "name: text wanted, got nothing"))
    found.append(Kind(INFORMATION_TOPIC, {"name": json.dumps(" " * rng.randrange(2, 5))}, "name: empty"))
    for name, limit in zip(COORDINATES, (90, 180), strict=True):
        beyond = {n: str(rng.choice([-1, 1]) * (limit + rng.randrange(10, 80))) if n == name else str(rng.randrange(9)) for n in COORDINATES}
        found.append(Kind(INFORMATION_TOPIC, beyond, "coordinates out of bounds: " + ", ".join(beyond[n] for n in COORDINATES)))
    for payload in (bytes([rng.randrange(0x80, 0xC0), rng.randrange(0xF8, 0x100)]), json.dumps({"n": rng.randrange(9)})[:-1].encode(), None):
        found.append(Kind(error="not JSON", raw=payload))
    return found


def kinds() -> list[Kind]:
    """The kinds of a mixed feed, shuffled: as many good messages as broken ones, some with flags as digits, and another topic."""
    rng = random.Random("kinds of messages")
    found = broken(rng)
    digits = {name: str(int(name != "is_renting")) for name in STATUS_FLAGS}
    found += [Kind()] * (len(found) // 2) + [Kind(fields=digits)] * (len(found) // 8)
    found += [Kind(INFORMATION_TOPIC)] * (len(found) // 4) + [Kind(OTHER_TOPIC, raw=b"[1]")] * 2
    rng.shuffle(found)
    return found


KINDS = kinds()

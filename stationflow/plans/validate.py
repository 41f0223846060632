"""Message checks as column expressions: one pass, the first broken rule gives the error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.functions import documents as D
from stationflow.sources.messages import INFORMATION_TOPIC, STATUS_TOPIC

# The fields of the feed, in the order in which they are checked.
STATUS_COUNTS = ("num_bikes_available", "num_docks_available")
STATUS_FLAGS = ("is_installed", "is_renting", "is_returning")
STATUS_REQUIRED = ("station_id", *STATUS_COUNTS, "last_reported", *STATUS_FLAGS)
WHOLE = (*STATUS_COUNTS, "last_reported", "feed_last_updated", "capacity")
FLAGS = (*STATUS_FLAGS, "replay", "is_virtual_station")
COORDINATES = ("lat", "lon")
VEHICLES = "vehicle_types_available"
FIELDS = ("station_id", *WHOLE, *FLAGS, *COORDINATES, "name", "fetched_at", VEHICLES)

LARGEST_INT = 2_147_483_647
LAST_SECOND = 253_402_300_799  # end of the year 9999

# Outcomes of the checks; a good message of another topic has none.
REJECTED, STATUS, INFORMATION = "rejected", "status", "information"

Rule = tuple[Column, Column]


def _value(name: str) -> Column:
    return F.col(f"v_{name}")


def _kind(name: str) -> Column:
    return F.col(f"k_{name}")


def _typed(name: str) -> Column:
    """The field in its target type; null when it has another."""
    return F.col(f"t_{name}")


def _typed_columns() -> list[Column]:
    name = D.as_text(_value("name"))
    name = F.when(_kind("name") == "BOOLEAN", F.initcap(name)).when(
        _kind("name").isin("OBJECT", "ARRAY"), F.to_json(_value("name"))
    ).otherwise(name)
    station = F.when(_kind("station_id") == "STRING", D.stripped(D.as_text(_value("station_id"))))
    fetched = F.when(D.is_number(_kind("fetched_at")), D.as_double(_value("fetched_at")))
    vehicles = F.when(D.is_falsy(_value(VEHICLES), _kind(VEHICLES)), F.parse_json(F.lit("[]"))).when(
        _kind(VEHICLES) == "ARRAY", _value(VEHICLES)
    )
    typed = {
        "station_id": station,
        "name": D.stripped(name),
        "fetched_at": fetched,
        VEHICLES: vehicles,
        **{n: D.whole(_value(n), _kind(n)) for n in WHOLE},
        **{n: D.as_flag(_value(n), _kind(n)) for n in FLAGS},
        **{n: D.lenient_double(_value(n), _kind(n)) for n in COORDINATES},
    }
    return [column.alias(f"t_{name}") for name, column in typed.items()]


def _seen(name: str) -> Column:
    return F.coalesce(F.to_json(_value(name)), F.lit("nothing"))


def _said(name: str, wanted: str) -> Column:
    return F.concat(F.lit(f"{name}: {wanted}, got "), _seen(name))


def _whole(name: str, minimum: int) -> list[Rule]:
    return [
        (_typed(name).isNull(), _said(name, "integer wanted")),
        (_typed(name) < minimum, _said(name, f"must be >= {minimum}")),
    ]


def _flag(name: str) -> Rule:
    return _typed(name).isNull(), _said(name, "boolean wanted")


def _optional_flag(name: str) -> Rule:
    return (_kind(name) != D.ABSENT) & _typed(name).isNull(), _said(name, "boolean wanted")


def _station_id() -> Rule:
    return F.coalesce(_typed("station_id"), F.lit("")) == "", _said("station_id", "non-blank text wanted")


def _fits_int(name: str) -> Rule:
    return _typed(name) > LARGEST_INT, _said(name, "out of range for a 32-bit integer")


def _fits_time(name: str) -> Rule:
    return F.abs(_typed(name)) > LAST_SECOND, _said(name, "out of range for a timestamp")


def status_rules() -> list[Rule]:
    missing = F.concat_ws(", ", *[F.when(_kind(n) == D.ABSENT, F.lit(n)) for n in STATUS_REQUIRED])
    return [
        (missing != "", F.concat(F.lit("missing fields: "), missing)),
        (_typed(VEHICLES).isNull(), _said(VEHICLES, "list wanted")),
        (_typed("fetched_at").isNull(), _said("fetched_at", "number wanted")),
        _station_id(),
        *[rule for name in STATUS_COUNTS for rule in _whole(name, 0)],
        *[_flag(name) for name in STATUS_FLAGS],
        *_whole("last_reported", 1),
        *_whole("feed_last_updated", 1),
        _optional_flag("replay"),
        # Storage rules: what the tables could not hold is rejected here.
        *[_fits_int(name) for name in STATUS_COUNTS],
        *[_fits_time(name) for name in ("last_reported", "feed_last_updated", "fetched_at")],
    ]


def information_rules() -> list[Rule]:
    lat, lon = _typed("lat"), _typed("lon")
    outside = ~lat.between(-90, 90) | ~lon.between(-180, 180) | F.isnan(lat) | F.isnan(lon)
    return [
        (lat.isNull(), _said("lat", "number wanted")),
        (lon.isNull(), _said("lon", "number wanted")),
        (_kind("name").isin(D.ABSENT, D.NULL), _said("name", "text wanted")),
        (outside, F.concat(F.lit("coordinates out of bounds: "), _seen("lat"), F.lit(", "), _seen("lon"))),
        (_typed("name") == "", F.lit("name: empty")),
        _station_id(),
        *_whole("capacity", 0),
        _optional_flag("is_virtual_station"),
        *_whole("feed_last_updated", 1),
        _fits_int("capacity"),
        _fits_time("feed_last_updated"),
    ]


def _first_broken(rules: list[Rule]) -> Column:
    return F.coalesce(*[F.when(broken, text) for broken, text in rules])


def _instant(name: str) -> Column:
    return F.timestamp_seconds(_typed(name)).alias(name)


def _status_record() -> Column:
    return F.struct(
        _typed("station_id").alias("station_id"),
        _instant("last_reported"),
        *[_typed(n).cast("int").alias(n) for n in STATUS_COUNTS],
        *[_typed(n).alias(n) for n in STATUS_FLAGS],
        _typed(VEHICLES).alias(VEHICLES),
        _instant("feed_last_updated"),
        _instant("fetched_at"),
        F.coalesce(_typed("replay"), F.lit(False)).alias("is_replay"),
    )


def _information_record() -> Column:
    return F.struct(
        _typed("station_id").alias("station_id"),
        _typed("name").alias("name"),
        *[_typed(n).alias(n) for n in COORDINATES],
        _typed("capacity").cast("int").alias("capacity"),
        F.coalesce(_typed("is_virtual_station"), F.lit(False)).alias("is_virtual_station"),
        _instant("feed_last_updated"),
    )


class Checker:
    """The checks as a few projections, built once and applied to every batch."""

    def __init__(self, status_topic: str = STATUS_TOPIC, information_topic: str = INFORMATION_TOPIC):
        is_status = F.col("topic") == status_topic
        is_information = F.col("topic") == information_topic
        known = is_status | is_information
        fine = F.col("error").isNull()
        carried = [F.col(c) for c in ("topic", "partition", "offset", "key", "value", "source_error")]
        no_json, no_object = F.col("no_json"), F.col("no_object")

        text = F.col("value").cast("string")
        self.doc = F.when(F.is_valid_utf8(text), D.parse(text))
        members = ", ".join(f"{n}: variant" for n in FIELDS)
        self.members = [*carried, F.col("doc").isNull().alias("no_json"), F.try_variant_get("doc", "$", f"struct<{members}>").alias("members")]
        # Only an object has members; the type of a whole document would be spelled out with all its fields.
        carried = [*carried, no_json, F.col("members").isNull().alias("no_object")]
        self.fields = [*carried, *[F.col(f"members.{n}").alias(f"v_{n}") for n in FIELDS]]
        carried = [*carried[:-1], no_object]
        self.typed = [
            *carried,
            *[_value(n) for n in FIELDS],
            *[D.kind(_value(n)).alias(f"k_{n}") for n in FIELDS],
        ]
        self.converted = ["*", *_typed_columns()]
        self.error = D.settled(F.coalesce(
            F.col("source_error"),
            F.when(no_json, F.lit("not JSON")),
            F.when(known & no_object, F.lit("JSON object wanted")),
            F.when(is_status, _first_broken(status_rules())).when(
                is_information, _first_broken(information_rules())
            ),
        )).alias("error")
        self.result = [
            F.col("topic"),
            F.col("partition").alias("kafka_partition"),
            F.col("offset").alias("kafka_offset"),
            F.col("key"),
            F.when(~fine, REJECTED).when(is_status, STATUS).when(is_information, INFORMATION).alias("outcome"),
            F.col("error"),
            F.when(~fine, F.coalesce(F.make_valid_utf8(text), F.lit(""))).alias("payload"),
            F.when(fine & is_status, _status_record()).alias("status"),
            F.when(fine & is_information, _information_record()).alias("information"),
        ]

    def __call__(self, messages: DataFrame) -> DataFrame:
        """Messages with `error`, and `status` or `information` where there is none.

        Messages of other topics must be JSON too but are otherwise let through without a record.
        `payload` keeps the text of a rejected message, bad UTF-8 replaced.
        """
        if "source_error" not in messages.columns:
            messages = messages.withColumn("source_error", F.lit(None).cast("string"))
        if "doc" not in messages.columns:
            messages = messages.withColumn("doc", self.doc)
        fields = messages.select(*self.members).select(*self.fields)
        judged = fields.select(*self.typed).select(*self.converted).select("*", self.error)
        return judged.select(*self.result)


def checked(
    messages: DataFrame, status_topic: str = STATUS_TOPIC, information_topic: str = INFORMATION_TOPIC
) -> DataFrame:
    """One-off form of `Checker`."""
    return Checker(status_topic, information_topic)(messages)


def valid_statuses(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("outcome") == STATUS).select("status.*", "kafka_partition", "kafka_offset")


def valid_informations(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("outcome") == INFORMATION).select(
        "information.*", "kafka_partition", "kafka_offset"
    )


def rejected(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("outcome") == REJECTED).select(
        "topic", "kafka_partition", "kafka_offset", "payload", "error"
    )

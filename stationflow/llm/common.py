"""Small Spark helpers that the operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.session import work_dir

# The word pattern of the contracts: everything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
# Bytes after which a batch for Python ends in the sessions of `small_batches`.
BATCH = 1 << 22


def session_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def written(df: DataFrame, label: str, reader: SparkSession | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """Write the rows as a table in the shared folder and read them back, in the session `reader` if there is one.

    Cuts the lineage: what follows survives the loss of executors, and joins on the table start from
    plain exchanges, so that adaptive execution can split a hot key on either side.
    """
    path = f"{work_dir(df.sparkSession, label)}.parquet"
    df.write.options(**(options or {})).parquet(path)
    return (reader or df.sparkSession).read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> SparkSession:
    """A session with the same settings, whose batches for Python end after `BATCH` bytes and not only after many rows.

    A task holds several copies of such a batch outside the heap. The setting holds when a plan runs, so the caller's session
    can't lend it to some plans only. `written` brings rows back to the caller's session.
    """
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if (own.conf.isModifiable(name) or not name.startswith("spark.")) and own.conf.get(name, None) != value:
            own.conf.set(name, value)
    own.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))
    return own


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(name: str) -> str:
    """A column name that no input has."""
    return f"_{name}_{uuid.uuid4().hex[:8]}"


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) with 52 bits from the MD5 of the parts, joined by colons."""
    columns = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts]
    digest = F.md5(F.concat_ws(":", *columns))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def shards(spark: SparkSession) -> int:
    """How many partitions a shuffle of this session makes."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

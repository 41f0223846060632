"""Report output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _iso(ts: Column, zoned: bool) -> Column:
    """ISO 8601 text; the fraction only where there is one, the offset only for instants."""
    end = "XXX" if zoned else ""
    whole = F.date_trunc("second", ts).cast("timestamp" if zoned else "timestamp_ntz") == ts
    text = F.when(whole, F.date_format(ts, f"yyyy-MM-dd'T'HH:mm:ss{end}")).otherwise(
        F.date_format(ts, f"yyyy-MM-dd'T'HH:mm:ss.SSSSSS{end}")
    )
    return F.regexp_replace(text, "Z$", "+00:00") if zoned else text


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, instants and dates as ISO 8601 text."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = _iso(c, isinstance(f.dataType, T.TimestampType))
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def write_report(df: DataFrame, path: str, shape: str) -> None:
    """Write a report folder: JSON objects, or CSV with a header in the report's order.

    Small reports end up in one file by themselves; a long series stays in ordered parts
    instead of passing through one task.
    """
    writer = plain(df).write.mode("overwrite")
    if shape == "json":
        writer.option("ignoreNullFields", "false").json(path)
    elif shape == "csv":
        writer.option("header", "true").option("emptyValue", "").csv(path)
    else:
        raise ValueError(f"unknown report shape {shape}")


def read_report(spark, path: str, schema: T.StructType) -> DataFrame:
    """Read a CSV report back."""
    return spark.read.csv(path, header=True, schema=schema)

"""Checks of a batch run in many tasks, whatever the files it comes in."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stationflow.plans.validate import checked
from stationflow.schemas import MESSAGE
from stationflow.streaming.ingest import spread

ROWS = 4000


def messages(spark, value="{}"):
    columns = {"key": F.lit("a"), "value": F.lit(value).cast("binary"), "topic": F.lit("station_status"), "partition": F.lit(0), "offset": F.col("id"), "timestamp": F.lit("2024-01-01").cast("timestamp")}
    rows = spark.range(0, ROWS, 1, 1).select(*[c.alias(n) for n, c in columns.items()])
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in MESSAGE.fields])


def test_one_split_is_dealt_over_all_tasks(spark):
    counts = spread(messages(spark)).groupBy(F.spark_partition_id()).count().collect()
    plan = spread(messages(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert sum(r["count"] for r in counts) == ROWS
    assert "RepartitionByExpression" in plan


@pytest.mark.parametrize(("value", "error"), [("[1]", "JSON object wanted"), ("null", "JSON object wanted"), ("3", "JSON object wanted"), ("{", "not JSON")])
def test_no_object(spark, value, error):
    assert [r["error"] for r in checked(messages(spark, value)).select("error").distinct().collect()] == [error]

"""What the plans must look like for the data to grow."""

import re

import pytest

import __spark_entry__ as entry
from stationflow import registry
from stationflow.sources import star

SF = "/root/testdata/sf0.001"
STREAMED = {
    "description_changes_stream", "ingest_stream", "ingest_stream_information", "ingest_stream_ledger",
    "ingest_stream_rejected", "ingest_stream_resent", "live_series_5min", "model_build", "panel_rejected", "dq_suite",
    "ingest_stream_compacted", "ingest_stream_many_batches", "panel_inserted_hour", "model_redelivered", "dq_suite_built",
}
BATCH = sorted(set(registry.queries()) - STREAMED)


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan(entry.queries()[name](spark, SF)) for name in BATCH}


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(plans, name):
    assert not re.search(r"CartesianProduct|NestedLoopJoin|PythonUDF|InPandas|InArrow|RDDScan", plans[name])


@pytest.mark.parametrize("name", ["dedup_first", "latest_description"])
def test_hot_keys_are_cut_before_the_shuffle(plans, name):
    before = plans[name].split("Exchange hashpartitioning")[-1]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_dedup_shuffles_once(plans):
    assert plans["dedup_first"].count("Exchange") == 1


def test_dimension_is_broadcast_by_its_size(plans):
    assert "BroadcastHashJoin" in plans["fact_readings"] and "SortMergeJoin" not in plans["fact_readings"]


def test_scan_reads_needed_columns_only(plans):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plans["panel_messages"])
    assert schemas and all("props" not in s and "value" not in s and "user_id" not in s for s in schemas)


def test_change_detection_spreads_a_key(plans):
    assert re.search(r"Exchange hashpartitioning\(key#\d+L, _bucket#\d+L", plans["description_changes"])


def test_percentiles_send_sketches_and_bracketed_values(spark):
    from pyspark.sql import functions as F
    from stationflow.operators.percentiles import ValueCounts

    values = ValueCounts(spark.range(1000).withColumn("g", F.col("id") % 3), ["g"], {"v": F.col("id")})
    text = plan(values.percentiles({"p": ("v", "0.5"), "q": ("v", "0.95")}))
    lines = text.splitlines()
    exchanges = [k for k, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    # What goes through an exchange was aggregated or read off before it: sketches, counted values, or one row a group.
    assert "partial_percentile_approx" in text
    for k in exchanges:
        below = "".join(lines[k + 1 : k + 4])
        assert re.search(r"HashAggregate|Window|Join", below), lines[k]


def test_replay_moves_no_text(plans):
    """What is numbered and decoded stays in the task that read it: no exchange below the decoding."""
    text = plans["archive_replay"]
    between = re.search(r"BroadcastHashJoin((?!BroadcastHashJoin).)*?FileScan text \[value", text, re.DOTALL)
    assert between and "Exchange" not in between[0]
    assert len(re.findall(r"FileScan text \[value", text)) == 1 and len(re.findall(r"FileScan text \[file_name", text)) == 1


def test_filters_reach_the_files(spark, tmp_path):
    path = str(tmp_path / "status")
    star.station_status(spark, SF).write.parquet(path)
    stored = spark.read.parquet(path)
    from stationflow.plans import models, monitoring

    dimension = models.station_dimension(models.staged_information(star.station_information(spark, SF)))
    loaded = plan(models.fact(models.staged_status(stored), dimension, above=500))
    assert "GreaterThan(status_id,500)" in loaded
    panel = plan(monitoring.inserted_per_bucket(stored, "2024-01-01 00:00:00", "2024-01-02 00:00:00"))
    assert "GreaterThanOrEqual(ingested_at" in panel and "LessThanOrEqual(ingested_at" in panel


def test_committed_batches_are_opened_by_name(spark, tmp_path):
    from feed import messages, status
    from stationflow.streaming import ingest as ing

    run = ing.Ingest(ing.raw_store(str(tmp_path)), "s")
    for batch in range(2):
        run(messages(spark, [status(last_reported=1767225600 + batch)]), batch)
    run.store.write("station_status", ing.raw_tables(spark, str(tmp_path))["station_status"], "s", 2)  # never committed
    opened = ing.raw_tables(spark, str(tmp_path))["station_status"].inputFiles()
    assert sorted(re.search(r"batch_id=\d+", f)[0] for f in opened) == ["batch_id=0", "batch_id=1"]

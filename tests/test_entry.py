import pytest
from compare import compare, connect

import __spark_entry__ as entry
from stationflow import oracle, registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_its_sql():
    assert set(registry.queries()) == set(oracle.sql()) <= set(entry.oracle_sql())


# The other streamed queries run the same streams, which have tests of their own; `compare.py` runs all.
REPEATS = {"ingest_stream", "ingest_stream_information", "ingest_stream_rejected", "panel_rejected"}


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - REPEATS))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, SF, name)[0] == "ok"

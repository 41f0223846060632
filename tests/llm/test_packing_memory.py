"""The packing query passes a few megabytes at a time to Python and through Parquet, however many blocks a task has."""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.parquet as pq

from stationflow.llm import packing, queries


def batches_of(df):
    """(rows, bytes) of each batch that Python gets."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64()), pa.array([batch.nbytes], pa.int64())], ["rows", "size"])

    return [tuple(r) for r in df.mapInArrow(run, "rows long, size long").collect()]


def documents(spark, path):
    """3000 rows of 10 000 letters, one in seven without an id and one in eleven without a text, in one file."""
    spark.range(3000, numPartitions=1).selectExpr(
        "nullif(id % 7, 0) as doc_id", "if(id % 11 = 3, null, repeat(sha2(string(id), 512), 78)) as text"
    ).write.parquet(path)


def test_query_holds_a_few_megabytes_at_a_time(spark, monkeypatch, tmp_path):
    documents(spark, str(tmp_path / "documents.parquet"))
    seen = {}
    packed, segments = packing.packed, packing.segments

    def packed_seen(docs, *args):
        seen["docs"] = batches_of(docs.select("doc_id", "text"))
        return packed(docs, *args)

    def segments_seen(blocks):
        seen["blocks"], seen["files"] = batches_of(blocks), blocks.inputFiles()
        return segments(blocks)

    encode = lambda texts: [list(t.encode()) for t in texts]
    monkeypatch.setattr(packing, "byte_level", lambda path, pattern: encode)
    monkeypatch.setattr(packing, "packed", packed_seen)
    monkeypatch.setattr(packing, "segments", segments_seen)
    settings = spark.conf.getAll
    found = queries.op3_packing(spark, str(tmp_path))
    # 27 MB of text make 12 full blocks of 8 MB each and a rest.
    assert sum(n for n, _ in seen["docs"]) == 3000 and max(size for _, size in seen["docs"]) < 6 << 20
    assert [n for n, _ in seen["blocks"]] == [1] * 13
    groups = [m.row_group(g).num_rows for f in seen["files"] for m in [pq.ParquetFile(f.removeprefix("file:")).metadata] for g in range(m.num_row_groups)]
    assert groups == [1] * 13
    assert found.union(found.limit(0)).sparkSession is spark and spark.conf.getAll == settings


def test_query_gives_the_segments_of_its_documents(spark, monkeypatch, tmp_path):
    documents(spark, str(tmp_path / "documents.parquet"))
    encode = lambda texts: [list(t.encode()) for t in texts]
    monkeypatch.setattr(packing, "byte_level", lambda path, pattern: encode)
    found = queries.op3_packing(spark, str(tmp_path))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    assert found.columns == ["doc_id", "piece", "part", "number", "row", "start", "length", "ids_sha256"]
    want = [(*r[:7], hashlib.sha256(r.ids).hexdigest()) for r in packing.segments(packing.packed(docs, encode)).collect()]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    assert sum(r[6] for r in want) == sum(len(r.text or "") for r in docs.collect())

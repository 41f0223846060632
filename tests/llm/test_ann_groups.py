"""Groups of queries of op8, cut small."""

import numpy as np
from pyspark.sql import functions as F

from stationflow.llm import ann


def clustered(rng, centres, each, dims, spread):
    points = np.repeat(rng.normal(size=(centres, dims)), each, axis=0)
    return [[float(np.float32(x)) for x in v] for v in points + spread * rng.normal(size=points.shape)]


def test_blocks_travel_to_groups_that_ask(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 32)
    monkeypatch.setattr(ann, "LEAF_SAMPLE", 24)
    monkeypatch.setattr(ann, "QUERY_BYTES", 3 * 8 * 8)
    tables = {}
    keep = ann.written
    monkeypatch.setattr(ann, "written", lambda df, label: tables.setdefault(label, keep(df, label)))
    rng = np.random.default_rng(9)
    vectors = clustered(rng, 12, 40, 8, 0.3)
    index = ann.Index(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>"))
    found = index.search(F.col("id") % 5 == 0, 10, recall=0.97).collect()
    asked = {r.of: r.groups for r in tables["asked"].collect()}
    assert 1 < max(asked.values()) and len(asked) <= index.tree.leaves
    x = np.array([np.float32(v) for v in vectors], np.float64)
    got = {(r["query"], r["rank"]): (r.id, r.score) for r in found}
    assert len(got) == len(found) == 96 * 10
    hits = 0
    for q in range(0, 480, 5):
        score = (x * x[q]).sum(axis=1)
        best = [k for k in np.lexsort((np.arange(480), -score)) if k != q][:10]
        hits += len(set(best) & {got[q, r][0] for r in range(1, 11)})
        assert all(got[q, r][1] == score[got[q, r][0]] for r in range(1, 11))
    assert hits >= 0.9 * 960

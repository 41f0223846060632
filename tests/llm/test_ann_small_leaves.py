"""Queries whose nearest leaves hold fewer rows than are asked for."""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from stationflow.llm import ann


def test_leaves_of_one_outlier_still_give_k(spark, monkeypatch):
    monkeypatch.setattr(ann, "LEAF_SAMPLE", 24)
    monkeypatch.setattr(ann.Index, "calibrated", lambda *_: 1)
    rng = np.random.default_rng(3)
    near = np.r_[1.0, np.zeros(15)] + rng.normal(0, 0.01, (400, 16))
    far = 50 * np.linalg.qr(rng.normal(0, 1, (16, 16)))[0]
    rows = [(k, [float(np.float32(x)) for x in v]) for k, v in enumerate(np.r_[near, far])]
    index = ann.Index(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert min(r.held for r in index.parts.collect()) == 1
    got = Counter(r["query"] for r in index.search(F.col("id") >= 0, 20).collect())
    assert len(got) == len(rows) and set(got.values()) == {20}

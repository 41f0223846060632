"""Bands of blocks of op10, cut small."""

import numpy as np
import pytest

from stationflow.llm import embed_dedup


def plain(vectors):
    """Links and smallest member reachable of each vector, all pairs compared; other lengths apart."""
    n = len(vectors)
    unit = [np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) for v in vectors]
    near = np.array([[len(x) == len(y) and x @ y >= 0.9 for y in unit] for x in unit])
    label = np.arange(n)
    for _ in range(n):
        label, last = np.array([label[near[k]].min() for k in range(n)]), label
        if (label == last).all():
            break
    return {k: (int(near[k].sum()) - 1, int(label[k])) for k in range(n)}


def clustered(rng, centres, each, dims, spread):
    points = np.repeat(rng.normal(size=(centres, dims)), each, axis=0)
    return [[float(np.float32(x)) for x in v] for v in points + spread * rng.normal(size=points.shape)]


@pytest.mark.parametrize(("block", "band"), [(4, 2), (8, 1), (16, 8)])
def test_bands_lose_no_link(spark, monkeypatch, block, band):
    monkeypatch.setattr(embed_dedup, "BLOCK", block)
    monkeypatch.setattr(embed_dedup, "BAND", band)
    rng = np.random.default_rng(band)
    # Two lengths with many rows, and one of a single row that no pivot has.
    vectors = clustered(rng, 6, 25, 12, 0.15) + clustered(rng, 3, 20, 5, 0.2) + [[1.0, 2.0]]
    vectors += vectors[:40]
    order = rng.permutation(len(vectors))
    vectors = [vectors[k] for k in order]
    frame = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>").repartition(5)
    got = {r.id: (r.n_links, r.component) for r in embed_dedup.near_duplicates(frame).collect()}
    assert got == plain(vectors)


def test_far_bands_make_no_tile(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK", 8)
    monkeypatch.setattr(embed_dedup, "BAND", 2)
    tables = {}
    keep = embed_dedup.written
    monkeypatch.setattr(embed_dedup, "written", lambda df, label: tables.setdefault(label, keep(df, label)))
    rng = np.random.default_rng(5)
    axes = np.repeat(np.eye(10), 30, axis=0) + 0.01 * rng.normal(size=(300, 10))
    rows = [(k, [float(x) for x in v], 1) for k, v in enumerate(axes)]
    counts, _ = embed_dedup.linked(spark.createDataFrame(rows, "id long, vector array<double>, copies long").select("id", "copies", "vector"))
    assert {r.n for r in counts.collect()} == {29}
    bands = tables["bands"].count()
    assert bands > 10 and tables["pairs"].count() < bands * (bands + 1) / 4

"""A short line that many texts hold in different surroundings, and passages around it that repeat."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from test_corpus_operators import plain_cut

from stationflow.llm import substrings


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abcdefghij é") for _ in range(n))
    line = text(60)
    passage = text(80) + line + text(90)
    rows = [(k, text(rng.randint(0, 150)) + line + text(rng.randint(0, 150))) for k in range(150)]
    rows += [(200 + k, text(50) + passage + text(70)) for k in range(6)]
    rows += [(300, passage + passage), (None, passage), (7, rows[3][1]), (301, None), (302, line), (303, (line + "x") * 5)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def cut(docs):
    known = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    got = defaultdict(list)
    for r in substrings.deduplicated(docs).collect():
        got[r.doc_id].append((r._n_bytes, r._n_removed, r._n_spans, bytes(r._kept)))
    return {k: sorted(v) for k, v in got.items()}, {k: sorted(v) for k, v in plain_cut(known, 100).items()}


def test_windows_of_hot_anchors_meet_and_their_suffixes_stay(docs, monkeypatch, tmp_path):
    """No shard merges more than a few suffixes of the line's anchors, and the cut is the plain one."""
    monkeypatch.setattr(substrings, "BATCH", 1 << 12)
    monkeypatch.setattr(substrings, "HOT", 20, raising=False)
    log, whole = str(tmp_path / "rows"), substrings.repeats

    def repeats(rows, *rest):
        found = whole(rows, *rest)
        _, times = np.unique(rows[:, : substrings.KEY], axis=0, return_counts=True)
        with open(log, "a") as out:
            out.write(f"{times.max()}\n")
        return found

    # The tasks take the function along, so that it notes the most rows of one anchor in a shard.
    monkeypatch.setattr(substrings, "repeats", repeats)
    got, want = cut(docs)
    assert got == want
    with open(log) as lines:
        assert 2 <= max(map(int, lines)) <= 20
    assert sum(r[1] for rows in want.values() for r in rows) > 2000


@pytest.mark.parametrize("hot", [0, 5])
def test_cut_is_the_same_however_many_anchors_are_hot(docs, monkeypatch, hot):
    monkeypatch.setattr(substrings, "BATCH", 1 << 11)
    monkeypatch.setattr(substrings, "HOT", hot)
    got, want = cut(docs)
    assert got == want

"""The pipeline's stages against plain versions, and the registered queries against their SQL."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_corpus_operators import groups, plain_cut, plain_print
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from stationflow.llm import mixing, quality, queries
from stationflow.llm.labels import remainder, training

SMALL = "/root/testdata/sf0.001"
CLASHES = ("_score", "_copy", "_copies", "_of", "_kept", "label", "ids", "fp", "class", "c1")


@pytest.fixture(scope="module")
def docs(spark):
    """The small documents with clashing columns, null and repeated ids, exact repeats, and empty, null and long texts."""
    rows = spark.read.parquet(f"{SMALL}/documents.parquet")
    some = rows.where("doc_id in (3, 9)")
    odd = some.withColumn("doc_id", F.lit(None).cast("long")).unionByName(some).unionByName(rows.where("doc_id = 11").withColumn("doc_id", F.lit(12).cast("long")))
    empty = rows.where("doc_id < 3").withColumn("text", F.when(F.col("doc_id") > 0, "")).withColumn("doc_id", F.col("doc_id") + 5000)
    long = rows.where("doc_id = 20").withColumns({"doc_id": F.lit(6000).cast("long"), "text": F.repeat("text", 40)})
    whole = rows.unionByName(odd).unionByName(empty).unionByName(long)
    return whole.withColumns({c: F.lit("clash") for c in CLASHES})


@pytest.fixture(scope="module")
def kept(spark, docs):
    stages = [docs.toPandas()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SMALL), name)
        stages.append(docs.toPandas().convert_dtypes())
    return stages


def keys(frame):
    ids = [None if pd.isna(i) else int(i) for i in frame["doc_id"]]
    return Counter(zip(ids, [None if pd.isna(t) else t for t in frame["text"]], strict=True))


def ordered(pairs):
    return sorted(pairs, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def test_quality_stage_rejects_what_the_plain_rules_reject(spark, docs, kept):
    """The rules are read back from the model and evaluated row by row over plain statistics."""
    sample = training(spark.read.parquet(f"{SMALL}/labels.parquet"), "quality", remainder("doc_id", 5) == 0)
    model = quality.learnt(docs.select("doc_id", "text"), sample)
    rows = quality.with_statistics(docs.select("doc_id", "text")).collect()
    want = Counter()
    for r in rows:
        value = model.start + sum(w for rule, w in model.weights if all((r[quality.PREFIX + s] <= t) == below for s, below, t in rule.conditions))
        if value >= -0.8472978603872037:  # the logit of 0.3
            want[r.doc_id, r.text] += 1
    assert keys(kept[1]) == want and 0 < sum(want.values()) < len(rows)


def test_simhash_stage_keeps_one_of_each_group(kept):
    before, after = keys(kept[1]), keys(kept[2])
    rows = ordered(before.elements())
    prints = [plain_print(t, 4) for _, t in rows]
    near = [(a, b) for a in range(len(rows)) for b in range(a) if bin(prints[a] ^ prints[b]).count("1") <= 4]
    of = groups(near, range(len(rows)))
    assert sum(after.values()) == len(set(of.values())) < len(rows)
    first = {c: min(((rows[k][0] is None, rows[k][0] or 0) for k in of if of[k] == c)) for c in set(of.values())}
    assert Counter((i is None, i or 0) for i, _ in after.elements()) == Counter(first.values())
    assert all(after[k] <= before[k] for k in after)


def test_substring_stage_cuts_as_the_plain_version(kept):
    rows = ordered(keys(kept[2]).elements())
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = Counter((k, cut.decode("utf-8", "ignore")) for k, cuts in plain_cut(rows, 100).items() for *_, cut in cuts)
    assert keys(kept[3]) == want
    assert all(r.n_chars == len(r.text) for r in kept[3].itertuples())


def test_mixing_stage_repeats_as_the_mix_says(spark, kept):
    cut = spark.createDataFrame([(i, t, s) for (i, t), s in zip(*_with_source(kept[3]), strict=True)], "doc_id long, text string, source string")
    times: dict = defaultdict(int)
    for r in mixing.mixed(cut, mixing.word_count("text")).collect():
        times[r.id] = max(times[r.id], r.copies)
    want = Counter()
    for (i, t), n in keys(kept[3]).items():
        want[i, t] += n * times[i]
    assert keys(kept[4]) == +want


def _with_source(frame):
    rows = [(None if pd.isna(r.doc_id) else int(r.doc_id), r.text) for r in frame.itertuples()]
    return rows, [None if pd.isna(s) else s for s in frame["source"]]


def test_bpe_stage_encodes_every_row_as_the_library(kept):
    plain = Tokenizer.from_file(queries.tokenizer_path())
    want = Counter()
    for (i, t), n in keys(kept[4]).items():
        ids = plain.encode(t, add_special_tokens=False).ids
        want[i, tuple(ids), hashlib.sha256(plain.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += n
    got = Counter((None if pd.isna(r.doc_id) else int(r.doc_id), tuple(r.ids), r.decoded_sha256) for r in kept[5].itertuples())
    assert got == want


def test_columns_pass_through(kept):
    first = list(kept[0].columns)
    assert all(list(s.columns) == first for s in kept[:-1])
    assert all((s[c] == "clash").all() for s in kept[:-1] for c in CLASHES)


def test_stages_of_nothing(spark, docs):
    rows = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, rows, SMALL).count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    result = entry.queries()[name](spark, SMALL)
    got = result.select(sorted(result.columns)).collect()
    names = sorted(result.columns)
    want = con.execute(f"SELECT {', '.join(names)} FROM ({entry.oracle_sql()[name]})").fetchall()
    show = lambda rows: sorted(re.sub(r"(\.\d{6})\d+", r"\1", str(tuple(r))) for r in rows)
    assert show(got) == show(want)


def test_registered():
    found = entry.queries()
    assert "pipeline" in found and all(any(re.match(f"op{n}_", q) for q in found) for n in range(1, 14))

"""A cleaning pipeline over documents: each stage is one operator and works on all its predecessor kept.

Extra columns pass through all stages but the last, whatever their names. Rows that share a doc_id share the fate of being repeated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.llm import bpe, mixing, quality, simhash, substrings
from stationflow.llm.common import fresh, read_table, written
from stationflow.llm.labels import remainder, training
from stationflow.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Below this score a document is rejected.
QUALITY = 0.3
# Shingle length and greatest distance of the SimHash operator.
SHINGLE = 4
RADIUS = 4


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble does not reject."""
    sample = training(read_table(spark, sf_dir, "labels"), "quality", remainder("doc_id", 5) == 0)
    score = fresh("score")
    model = quality.learnt(docs.select("doc_id", "text"), sample)
    return quality.scored(docs, model, score=score).where(F.col(score) >= QUALITY).drop(score)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies: the one with the smallest doc_id, null last.

    Near copies are those the SimHash operator groups. Rows are told apart by a key of their own, so that rows with a null or a
    repeated doc_id count like any other: of repeated rows of one group one stays.
    """
    fp, row, least = fresh("fp"), fresh("row"), fresh("least")
    marked = simhash.fingerprinted(docs, fp, SHINGLE).withColumn(row, F.monotonically_increasing_id())
    marked = written(marked, "marked")
    classes = written(simhash.near_classes(marked.select(F.col(fp).alias("fp")), RADIUS), "classes")
    of_row = marked.select(F.col("doc_id").isNull().alias("none"), "doc_id", F.col(row).alias("row"), F.col(fp).alias("fp"))
    kept = of_row.join(classes, "fp").groupBy("class").agg(F.min(F.struct("none", "doc_id", "row"))["row"].alias(least))
    return marked.join(kept, F.col(row) == F.col(least), "left_semi").select(*docs.columns)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier document or place has too."""
    passed = {c: f"c{k}" for k, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    found = substrings.deduplicated(docs.withColumnsRenamed(passed), as_text=True)
    back = {c: F.col(name) for c, name in passed.items()} | {"doc_id": F.col("doc_id"), "text": F.col("_kept")}
    if "n_chars" in passed:
        back["n_chars"] = F.length("_kept").cast(docs.schema["n_chars"].dataType)
    return found.select(*[back[c].alias(c) for c in docs.columns])


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    of, copies, copy = fresh("of"), fresh("copies"), fresh("copy")
    mix = mixing.mixed(docs, mixing.word_count("text"))
    times = mix.groupBy(F.col("id").alias(of)).agg(F.max("copies").alias(copies)).where(F.col(copies) > 0)
    joined = docs.join(written(times, "copies"), F.col("doc_id").eqNullSafe(F.col(of)))
    repeated = joined.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
    return repeated.select(*docs.columns)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digest of the text they stand for."""
    path = tokenizer_path()
    found = bpe.encoded(docs, path, keep=["doc_id", "lang", "source"], decoded_col="decoded")
    digest = F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    return found.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", digest)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("simhash", simhash_stage),
    ("substrings", substring_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

# No stage but the mixing can be written in SQL; tests/llm/test_pipeline.py holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs

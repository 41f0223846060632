"""The registered queries of the corpus operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.llm import ann, bpe, chat, embed_dedup, mixing, oracle, packing, quality, simhash, spelling, substrings, toxicity, trie, warc
from stationflow.llm.common import read_table, small_batches, written
from stationflow.llm.labels import remainder, training
from stationflow.session import work_dir

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()
    found = bpe.encoded(read_table(spark, sf_dir, "documents"), path, decoded_col="decoded")
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "archives")
    warc.write_archives(warc.records(read_table(spark, sf_dir, "pages"), least_bytes=0), path)
    columns = ["record_type", "record_id", "refers_to", "payload_digest", "payload_bytes"]
    responses = warc.read_archives(spark, path, *columns, "payload").where(F.col("record_type") == "response")
    revisits = warc.read_archives(spark, path, *columns).where(F.col("record_type") == "revisit")
    return responses.drop("payload").unionByName(revisits).select(
        warc.page_of("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_of("refers_to").alias("refers_to"),
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    encode = packing.byte_level(tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    docs = read_table(small_batches(spark), sf_dir, "documents")
    blocks = packing.write_packed(packing.packed(docs, encode))
    found = packing.segments(blocks).withColumn("ids_sha256", F.sha2("ids", 256)).drop("ids")
    return written(found, "segments", spark)


def _labelled(scored: DataFrame, held_out: F.Column) -> DataFrame:
    predicted = F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = training(read_table(spark, sf_dir, "labels"), "toxic", remainder("doc_id", 4) == 2)
    scored = toxicity.scored(read_table(spark, sf_dir, "documents"), sample).withColumnRenamed("id", "doc_id")
    return _labelled(scored, remainder("doc_id", 4) == 2)


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = substrings.deduplicated(docs, span=100)
    counts = [F.col(f"_{c}").alias(c) for c in ("n_bytes", "n_removed", "n_spans")]
    return found.select("doc_id", *counts, F.sha2("_kept", 256).alias("kept_sha256"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = training(read_table(spark, sf_dir, "labels"), "quality", remainder("doc_id", 5) == 0)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return _labelled(quality.scored(docs, quality.learnt(docs, sample)), remainder("doc_id", 5) == 0)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mixed(read_table(spark, sf_dir, "documents"), mixing.word_count("text"))
    return mix.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = ann.Index(read_table(spark, sf_dir, "embeddings"))
    found = index.search(F.col("id") % 20 == 0, k=20)
    return found.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = simhash.fingerprints(read_table(spark, sf_dir, "documents"), width=4)
    found = simhash.near_components(prints, radius=4)
    return found.select(F.col("id").alias("doc_id"), simhash.fingerprint_text().alias("fingerprint"), F.col("component").alias("component_id"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embed_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"), threshold=0.9)
    kept = F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept")
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), kept)


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    found = chat.TEMPLATE.parsed(chat.formatted(rows), "formatted", "turns")
    found = chat.learnt_text(found, "learnt")
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return found.select(
        F.col("id").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2(F.col("learnt").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _misspelt(doc_id: F.Column, run: F.Column) -> F.Column:
    """The run without one letter where the hash of id and run says so."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % 31 == 0, F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))).otherwise(run)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(read_table(spark, sf_dir, "documents"), least_length=7, least_count=2, change=_misspelt)
    return spelling.variants(words, times=10).select("word", "form", "root", "n", "n_near", "form_n")


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = trie.ordered_turns(read_table(spark, sf_dir, "conversations"))
    taken = F.crc32(F.col("id").cast("string").cast("binary")) % 4
    rebuilt = trie.spliced(turns, donor=F.col("id") - F.col("id") % 20, taken=taken, most=3)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return trie.peeled(written(trie.paths(rebuilt), "paths")).select(*columns)


def queries() -> dict[str, Query]:
    return {
        "op1_bpe": op1_bpe,
        "op2_warc": op2_warc,
        "op3_packing": op3_packing,
        "op4_toxicity": op4_toxicity,
        "op5_substrings": op5_substrings,
        "op6_quality": op6_quality,
        "op7_mixing": op7_mixing,
        "op8_ann": op8_ann,
        "op9_simhash": op9_simhash,
        "op10_embedding_dedup": op10_embedding_dedup,
        "op11_chat": op11_chat,
        "op12_spelling": op12_spelling,
        "op13_trie": op13_trie,
    }


def oracle_sql() -> dict[str, str]:
    return oracle.sql()

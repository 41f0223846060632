import json

from feed import messages
from pyspark.sql import functions as F

from stationflow.operators import changes
from stationflow.sources.messages import message_files, publish_files
from stationflow.streaming.changes import Changes, change_store, start_changes


def described(spark, letters, start=0):
    rows = [("station_information", {"name": c, "x": {"b": 1, "a": 2}}) for c in letters]
    return messages(spark, rows, start=start)


def test_batch_keeps_changes_only(spark):
    docs = ["A", "A", "B", "A"]
    rows = [("k", i, json.dumps({"n": d, "i": 1} if i % 2 else {"i": 1, "n": d})) for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "key string, position long, text string")
    df = df.withColumn("doc", F.try_parse_json("text"))
    out = changes.changed(df, "key", ["position"], changes.block_of("position"))
    assert sorted(r["position"] for r in out.collect()) == [0, 2, 3]


def test_stream_remembers_across_batches_and_restarts(spark, tmp_path):
    landed, root, checkpoint = (str(tmp_path / n) for n in ("landed", "log", "checkpoint"))
    for start, letters in ((0, "AAB"), (10, "BBA"), (20, "A"), (30, "C")):
        publish_files(described(spark, letters, start), landed)
        start_changes(message_files(spark, landed, streaming=True), root, checkpoint).awaitTermination()
    log = change_store(root).read(spark, "changes").orderBy("offset").collect()
    assert [json.loads(r["value"])["name"] for r in log] == ["A", "B", "A", "C"]


def test_second_checkpoint_goes_on_where_the_first_ended(spark, tmp_path):
    root = str(tmp_path / "log")
    for name, letters in (("one", "ABA"), ("two", "BBA")):
        landed = str(tmp_path / name)
        for k, letter in enumerate(letters):
            publish_files(described(spark, letter, 100 * (name == "two") + 10 * k), landed)
            start_changes(message_files(spark, landed, streaming=True), root, str(tmp_path / f"{name}-checkpoint")).awaitTermination()
    log = change_store(root).read(spark, "changes").orderBy("sequence").collect()
    assert [json.loads(r["value"])["name"] for r in log] == ["A", "B", "A", "B", "A"]


def test_null_key_is_remembered(spark, tmp_path):
    body = Changes(change_store(str(tmp_path)), "s")
    for k in range(2):
        body(described(spark, "A", k).withColumn("key", F.lit(None).cast("string")), k)
    assert change_store(str(tmp_path)).read(spark, "changes").count() == 1

import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stationflow.operators import keyed
from stationflow.operators.ordered import numbered, numbered_in_place, with_previous
from stationflow.operators.percentiles import ValueCounts, exact_percentiles
from stationflow.operators.rows import side_by_side

RELAXED = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def interpolated(values, p):
    values = sorted(values)
    at = Decimal(p) * (len(values) - 1)
    low = int(at)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (at - low)


@RELAXED
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-(2**40), 2**40)), min_size=1, max_size=60))
def test_percentiles_equal_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "g int, v long")
    out = exact_percentiles(df, ["g"], {"a": (F.col("v"), "0.5"), "b": (F.col("v"), "0.95"), "c": (F.col("v"), "1")})
    got = {r["g"]: (r["a"], r["b"], r["c"]) for r in out.collect()}
    for g in {g for g, _ in rows}:
        values = [v for k, v in rows if k == g]
        assert got[g] == tuple(interpolated(values, p) for p in ("0.5", "0.95", "1"))


def test_percentiles_of_one_hot_value_and_nulls(spark):
    values = [7] * 5000 + [1, 2, 3, 10**12, 10**12 + 1] + [None] * 50
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(7)
    out = exact_percentiles(df, [], {"p50": (F.col("v"), "0.5"), "p99": (F.col("v"), "0.9999")}).first()
    known = [v for v in values if v is not None]
    assert out["p50"] == 7
    assert out["p99"] == interpolated(known, "0.9999")


@pytest.mark.parametrize("few", [False, True])
def test_percentiles_of_groups_beyond_the_sketch(spark, few):
    """Groups of many values, ties and skew, whose brackets come from sketches; two percentiles of a measure share its counts."""
    rng = random.Random(5)
    rows = [("big", rng.randrange(10**9), k % 3) for k in range(30_000)] + [("tied", rng.choice([1, 2, 2, 2, 9]), None) for _ in range(9000)]
    rows += [("small", v, None) for v in (5, 1, 4)] + [(None, 7, 7), ("empty", None, None)]
    df = spark.createDataFrame(rows, "g string, v long, w long").repartition(5)
    values = ValueCounts(df, ["g"], {"v": F.col("v"), "w": F.col("w")}, few=few)
    ps = {"a": "0.01", "b": "0.5", "c": "0.95", "d": "0.9999", "e": "0", "f": "1"}
    got = {r["g"]: r for r in values.percentiles({n: ("v", p) for n, p in ps.items()} | {"w": ("w", "0.5")}).collect()}
    for g in {g for g, _, _ in rows} - {"empty"}:
        known = [v for k, v, _ in rows if k == g]
        assert [got[g][n] for n in ps] == [interpolated(known, p).quantize(Decimal("0.0001")) if isinstance(interpolated(known, p), Decimal) else interpolated(known, p) for p in ps.values()]
    assert got["big"]["w"] == 1 and got["tied"]["w"] is None and ("empty" not in got or got["empty"]["b"] is None)


def test_numbering_in_place_moves_no_row(spark):
    df = spark.range(0, 90, 1, 3).withColumns({"file": F.when(F.col("id") < 45, "b").otherwise("a"), "block": F.floor(F.col("id") / 15) % 3, "line": F.monotonically_increasing_id(), "text": F.repeat(F.lit("x"), 50)})
    placed = numbered_in_place(df, ["file", "block"], "line", "n", start=-1)
    got = [r["id"] for r in placed.orderBy("n").collect()]
    assert got == [*range(45, 90), *range(45)] and [r["n"] for r in placed.orderBy("n").collect()] == list(range(90))
    text = placed._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in text and "text" not in text[text.index("BroadcastExchange"):].split("Exchange hashpartitioning")[0]
    with pytest.raises(Exception, match="do not follow each other"):
        numbered_in_place(df.withColumn("block", F.col("id") % 3), ["file", "block"], "line", "n").collect()


def test_totals_and_percentiles_either_way(spark):
    rows = [("a", 3), ("a", 3), ("a", 10), ("a", None), ("b", 2**30)]
    df = spark.createDataFrame(rows, "g string, v long")
    for few in (True, False):
        values = ValueCounts(df, ["g"], {"v": F.col("v")}, limits={"v": 5}, few=few)
        totals = values.totals(values.count("v").alias("n"), values.count_above("v").alias("above"), values.largest("v").alias("most"))
        assert {tuple(r) for r in totals.collect()} == {("a", 3, 1, 10), ("b", 1, 1, 2**30)}
        middle = values.percentiles({"p": ("v", "0.75")})
        assert {tuple(r) for r in middle.collect()} == {("a", Decimal("6.5")), ("b", 2**30)}


def test_percentiles_of_nothing(spark):
    df = spark.createDataFrame([], "v long")
    assert exact_percentiles(df, [], {"p": (F.col("v"), "0.5")}).first()["p"] is None


@RELAXED
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 3)), min_size=1, max_size=40))
def test_previous_value_across_blocks(spark, rows):
    data = [(k, i, v) for i, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, i long, v int")
    out = with_previous(df, ["k"], F.shiftright("i", 2), ["i"], "v")
    got = {r["i"]: r["previous"] for r in out.collect()}
    last, want = {}, {}
    for k, i, v in data:
        want[i] = last.get(k)
        last[k] = v
    assert got == want


def test_numbering_is_dense_and_follows_arrival(spark):
    rows = [(p, o) for p in range(3) for o in random.Random(p).sample(range(10**6), 50)]
    df = spark.createDataFrame(rows, "p int, o long").withColumn("b", F.shiftright("o", 16))
    out = numbered(df, ["p", "b"], ["o"], "n", start=100).collect()
    ordered = sorted(out, key=lambda r: (r["p"], r["o"]))
    assert [r["n"] for r in ordered] == list(range(101, 251))


def test_first_and_latest(spark):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 5, "z"), ("a", 3, "w")], "k string, o int, v string")
    first = {r["k"]: r["v"] for r in keyed.first_per_key(df, ["k"], [F.col("o")]).collect()}
    last = {r["k"]: r["v"] for r in keyed.latest_per_key(df, ["k"], ["o"]).collect()}
    mixed = keyed.first_with_last_position(df, ["k"], ["o"], ["o"]).collect()
    assert first == {"a": "x", "b": "z"} and last == {"a": "w", "b": "z"}
    assert {(r["k"], r["o"], r["v"]) for r in mixed} == {("a", 3, "x"), ("b", 5, "z")}


def test_absent_rows(spark):
    new = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "k int, t int")
    target = spark.createDataFrame([(1, 2), (9, 9)], "k int, t int")
    out = keyed.absent_from(new, target, ["k", "t"])
    assert {tuple(r) for r in out.collect()} == {(1, 1), (2, 1)}


def test_replace_by_key(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "id int, v string")
    assert {tuple(r) for r in keyed.replace_by_key(target, new, ["id"]).collect()} == {(1, "a"), (2, "c"), (3, "d")}


def test_side_by_side(spark):
    a, b = spark.sql("select 1 as x, true as y"), spark.sql("select 'z' as z, cast(null as int) as n")
    assert side_by_side(a, b).first().asDict() == {"x": 1, "y": True, "z": "z", "n": None}


def test_percentile_beyond_four_decimals_is_refused(spark):
    for p in ("0.99999", "1.5", "-0.1"):
        with pytest.raises(ValueError, match="four decimals"):
            exact_percentiles(spark.range(3), [], {"p": (F.col("id"), p)})

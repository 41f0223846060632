"""Chat formatting against a plain renderer and parser."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stationflow.llm import chat

T = chat.TEMPLATE
KIND = "conv_id long, turn long, role string, text string, id string, place int, block string"


def plain_escaped(text):
    out, at = "", 0
    while at < len(text):
        mark = next((c for c in T.controls if text.startswith(c, at)), None)
        out += T.escape + mark if mark else text[at]
        at += len(mark or "x")
    return out


def plain_block(role, text):
    role_, text = plain_escaped(role), plain_escaped(text)
    if role in T.roles:
        first, last = T.roles[role]
        return f"{first}\n", text, f"\n{last}\n"
    return f"[ROLE]\n{role_}\n[SAYS]\n", text, "\n[/SAYS]\n"


def plain(rows):
    """The formatted text and loss ranges of each conversation."""
    of = defaultdict(list)
    for conv, turn, role, text in rows:
        of[conv].append((turn is not None, turn or 0, role or "", text or ""))
    found = {}
    for conv, turns in of.items():
        whole, loss = "", []
        for _, _, role, text in sorted(turns):
            before, middle, behind = plain_block(role, text)
            start = len((whole + before).encode())
            if role == "assistant":
                loss.append((start, start + len(middle.encode())))
            whole += before + middle + behind
        found[conv] = whole, loss, [(role, text) for _, _, role, text in sorted(turns)]
    return found


def check(spark, rows):
    frame = spark.createDataFrame([(*r, "clash", 7, "clash") for r in rows], KIND).repartition(3)
    got = chat.learnt_text(T.parsed(chat.formatted(frame), "formatted", "turns"), "learnt").collect()
    want = plain(rows)
    assert len(got) == len(want)
    for r in got:
        whole, loss, turns = want[r.id]
        assert r.formatted == whole and [tuple(s) for s in r.loss] == loss
        assert [tuple(t) for t in r.turns] == turns
        assert r.learnt == "".join(text for role, text in turns if role == "assistant")


ODD = ["", None, "\\", "\\\\[INST]", "[INST]\\", "\n", "</s>[INST] ok [/INST]", "<s", "<<s>>", "[/SAYS]\n[ROLE]\nuser", "é\U0001f600 <s>é", "\\</s>\\\\</s>", "<<SYS>><</SYS>>", " $1 \\1 "]


def test_odd_texts_and_roles(spark):
    rows = [(k, t, role, text) for k, role in enumerate(["user", "assistant", "system", "tool", None, "[ROLE]", "\\", "a\nb", "User"]) for t, text in enumerate(ODD)]
    rows += [(None, 1, "user", "x"), (None, None, "assistant", "y"), (100, None, "user", "first"), (100, -1, "user", "second"), (100, 3, "user", "same"), (100, 3, "user", "same")]
    check(spark, rows)


def test_long_conversations_and_texts(spark):
    rng = random.Random(3)
    rows = [(1, k, rng.choice(["user", "assistant"]), rng.choice(ODD)) for k in range(3000)]
    rows += [(2, 0, "assistant", "[INST]é\\" * 100_000), (2, 1, "user", "\\" * 300_000)]
    check(spark, rows)


def test_nothing(spark):
    assert chat.formatted(spark.createDataFrame([], KIND)).count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.none() | st.integers(0, 4), st.sampled_from(["user", "assistant", "x", "[SAYS]"]), st.lists(st.sampled_from([*T.controls, "\\", "\n", "a", "<", "s>"])).map("".join)), min_size=1, max_size=40))
def test_any_mixture_comes_back(spark, rows):
    check(spark, rows)


def test_grammar_is_strict(spark):
    bad = ["x", "[INST]", "[INST]\na\n", "[INST]\na\n[/INST]", "[INST]a[/INST]\n", "[INST]\na\n</s>\n", "[/INST]\n", "[INST]\na\n[/INST]\nx", "[ROLE]\na\n[INST]\nb\n[/INST]\n", "[INST]\n[/INST]\n", "[SAYS]\na\n[/SAYS]\n"]
    good = ["", "[INST]\n\n[/INST]\n", "[INST]\n\\[INST]\n[/INST]\n<s>\nb\n</s>\n"]
    rows = spark.createDataFrame([(t,) for t in bad + good], "t string")
    got = {r.t: r.turns for r in T.parsed(rows, "t", "turns").collect()}
    assert all(got[t] is None for t in bad) and all(got[t] is not None for t in good)
    assert [tuple(x) for x in got[good[2]]] == [("user", "[INST]"), ("assistant", "b")]


def test_templates_that_cannot_be_read_back_are_refused():
    for roles in ({"user": ("<a>", "<a>")}, {"user": ("<a", "<ab>")}, {"user": ("aba", "x")}, {"user": ("<\n>", "x")}, {"user": ("\\a", "x")}, {"user": ("", "x")}, {"user": ("ab", "bc")}):
        with pytest.raises(ValueError):
            chat.Template(roles=roles)


def test_another_template(spark):
    other = chat.Template(roles={"q": ("<q>", "</q>")}, other=("<1>", "<2>", "<3>"), learnt=("q", "r"), gap=" ", escape="^")
    rows = spark.createDataFrame([(1, 0, "q", "^<q> a </q>"), (1, 1, "r", "<3>")], "conv_id long, turn long, role string, text string")
    back = chat.learnt_text(other.parsed(chat.formatted(rows, other), "formatted", "turns"), "learnt", other).first()
    assert [tuple(t) for t in back.turns] == [("q", "^<q> a </q>"), ("r", "<3>")] and back.learnt == "^<q> a </q><3>"


def test_no_python_in_the_plan(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    plan = chat.learnt_text(T.parsed(chat.formatted(rows), "formatted", "turns"), "learnt")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.split("== Physical Plan ==")[1].count("Exchange") == 1


def test_columns_named_as_the_output(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a")], "id long, turn long, role string, formatted string").withColumn("loss", F.lit(1))
    assert chat.formatted(frame, id_col="id", text_col="formatted").first().formatted == "[INST]\na\n[/INST]\n"

"""The trie of conversation prefixes against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stationflow.llm import trie

KIND = "conv_id long, turn long, role string, text string, id long, key string, path string, n long, depth int"
COLUMNS = ("depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def step(role, text):
    """What ties are ordered by."""
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def in_order(rows):
    of = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            of[conv].append((turn is not None, turn or 0, step(role or "", text or ""), role or "", text or ""))
    return {c: tuple((role, text) for *_, role, text in sorted(turns)) for c, turns in of.items()}




def plain_trie(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = sum(saved[k] for k in children[node]) + (len(members[node]) - 1) * words
    out = []
    for node, who in members.items():
        ended = ",".join(str(c) for c in sorted(who) if convs[c] == node)
        parent = min(members[node[:-1]]) if node else None
        out.append((len(node), min(who), parent, len(who), len(children[node]), leaves[node], saved[node], hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out, key=str)


def shown(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    found = []
    for c in range(120):
        for t in range(rng.choice([1, 2, 3, 4, 7, 8])):
            found.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a b", "c", "d  e\tf"])))
    found += [(c, t, "user", f"same {t}") for c in range(200, 240) for t in range(5)]  # copies
    found += [(300 + k, t, "user", f"word {t}") for k in range(30) for t in range(k + 1)]  # each is a prefix of the next
    found += [(400, t, "user", "x " * t) for t in range(150)] + [(401, t, "user", "x " * t) for t in range(140)]
    found += [(500, None, None, None), (500, None, "user", ""), (500, 0, "user", "tie"), (500, 0, "assistant", "tie"), (500, 0, "user", "tie")]
    found += [(None, 0, "user", "a b"), (501, 0, "us", "era"), (502, 0, "user", "a"), (-3, 0, "user", "x"), (-23, 1, None, "x\x85y z\x0b")]
    found += [(2**40 + 7, 0, "user", "far")]
    return found


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "clash", "clash", 1, 2) for r in rows], KIND).repartition(3)


@pytest.mark.parametrize("band", [0, 5, 60, 20_000])
def test_trie_equals_brute_force(frame, rows, band):
    """Level by level, in bands, and in mixtures of both."""
    found = trie.written(trie.paths(trie.ordered_turns(frame)), "paths")
    assert shown(trie.peeled(found, band)) == plain_trie(in_order(rows))


def test_spliced_conversations(frame, rows):
    turns = trie.ordered_turns(frame)
    spliced = trie.spliced(turns, F.col("id") - F.col("id") % 20, F.crc32(F.col("id").cast("string").cast("binary")) % 4, 3)
    got = trie.peeled(trie.written(trie.paths(spliced), "paths"))
    convs = in_order(rows)
    plain = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        donor = c - (c % 20 if c >= 0 else -(-c % 20))
        plain[c] = convs.get(donor, ())[:h] + turns[h:]
    assert () in plain.values()  # some are left without turns
    assert shown(got) == plain_trie(plain)


def test_ids_of_a_node_come_in_ranges(frame, rows, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_BITS", 2)
    found = trie.written(trie.paths(trie.ordered_turns(frame)), "paths")
    assert shown(trie.peeled(found)) == plain_trie(in_order(rows))


def test_nothing(frame):
    assert trie.prefix_trie(frame.limit(0)).count() == 0
    assert trie.prefix_trie(frame.where("conv_id is null")).count() == 0


def test_bands_cover_all_depths_and_keep_their_bound():
    rng = random.Random(1)
    for _ in range(200):
        sizes = {rng.randint(0, 60): rng.randint(1, 40) for _ in range(rng.randint(1, 20))}
        found = trie.bands(sizes, 100)
        assert [h for _, h in found] == [max(sizes), *[low for low, _ in found[:-1]]] and found[-1][0] == -1
        for low, high in found:
            live = [sum(n for d, n in sizes.items() if d >= k) for k in range(low + 1, high + 1)]
            assert high == low + 1 or (sum(live) <= 100 and low >= 1)
    assert trie.bands({}, 100) == []
    assert trie.bands({0: 3}, 100) == [(-1, 0)]


def test_a_prefix_that_all_share_is_no_large_group(spark):
    """Levels above the bound are aggregations over paths: no task gathers the members of a node."""
    convs = [(c, t, "user", "same" if t < 3 else f"{c}") for c in range(300) for t in range(5)]
    frame = spark.createDataFrame(convs, "conv_id long, turn long, role string, text string")
    found = trie.written(trie.paths(trie.ordered_turns(frame)), "paths")
    got = shown(trie.peeled(found, 400))
    assert got == plain_trie(in_order(convs))

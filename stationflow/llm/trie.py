"""A trie of conversation prefixes by truncation peeling.

A conversation is a path of steps, one for each turn: 16 bytes that stand for its role and text, then 4 bytes with its words.
Equal conversations are one path, so a group of copies of any size is a single row from the start. Peeling goes down from the greatest
depth: at a depth the paths that end there are merged with the nodes that survive from below, one row for each
path, which is a node with all its sums; then every node loses its last turn and goes up as a child of what is left.

A depth with more than BAND live rows is one distributed aggregation over the paths, combined before its shuffle, so a
prefix that very many conversations share is no large group anywhere. Depths that hold BAND rows at most between them
(the thin tail of long conversations) are peeled in one round: tasks take the paths by their prefix above the band
and peel all its depths. The band bounds what any task can get, whatever the skew.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm.common import WORD, written

STEP = 20  # bytes of a turn in a path
BAND = 20_000
# Ids of one node that are gathered together before the digest; 2 ** CHUNK_BITS ids in a row at most.
CHUNK_BITS = 14

NODE = "depth long, key string, parent string, conv_id long, n long, children long, leaves long, saved long, path binary"


def ordered_turns(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(id, place, step) of the turns of every conversation with an id, from place 0 on.

    By turn number, null first; ties by what role and text stand for. A null role or text is empty.
    Texts are reduced to steps before they are sent anywhere.
    """
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    said = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    words = F.lpad(F.hex(F.regexp_count(text, F.lit(WORD)).cast("long")), 8, "0")
    step = F.unhex(F.concat(said, words)).alias("step")
    turns = rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(turn_col).alias("turn"), step)
    order = Window.partitionBy("id").orderBy(F.col("turn").asc_nulls_first(), "step")
    return turns.select("id", (F.row_number().over(order) - 1).alias("place"), "step")


def paths(turns: DataFrame) -> DataFrame:
    """(id, path) of turns (id, place, step); a row with a null step stands for a conversation that may have no turns."""
    steps = F.array_sort(F.collect_list(F.when(F.col("step").isNotNull(), F.struct("place", F.hex("step").alias("step")))))
    whole = turns.groupBy("id").agg(steps.alias("steps"))
    return whole.select("id", F.unhex(F.array_join(F.transform("steps", lambda s: s["step"]), "")).alias("path"))


def spliced(turns: DataFrame, donor: Column, taken: Column, most: int) -> DataFrame:
    """Turns (id, place, step) of conversations whose first `taken` turns come from the conversation `donor`.

    Both columns are made from `id`; `taken` is `most` at most, which bounds the turns that a donor gives. A row with a null step
    for each conversation keeps those that are left without turns. A donor gives each taker a few rows, and is read once for all.
    """
    turns = written(turns, "turns")
    ids = turns.groupBy("id").agg(F.lit(1).alias("one")).select("id", donor.alias("donor"), taken.alias("taken"))
    given = turns.where(F.col("place") < most).select(F.col("id").alias("donor"), "place", "step")
    given = ids.join(given, "donor").where("place < taken").select("id", F.col("place").cast("long").alias("place"), "step")
    # The conversation's own turns follow whatever the donor gave.
    own = turns.where(F.col("place") >= taken).select("id", (F.col("place") + most).cast("long").alias("place"), "step")
    marks = ids.select("id", F.lit(None).cast("long").alias("place"), F.lit(None).cast("binary").alias("step"))
    return given.unionByName(own).unionByName(marks)


def ended(found: DataFrame) -> DataFrame:
    """(path, conv_id, n, ends_sha256) of (id, path): every distinct path, its smallest id, how many have it, the digest of their ids.

    The ids of a path are gathered in ranges of bounded size; a task reads the ranges of a path in order and hashes them as it goes.
    """
    chunk = F.shiftright("id", CHUNK_BITS).alias("chunk")
    parts = found.groupBy("path", chunk).agg(F.array_sort(F.collect_list("id")).alias("ids"))
    listed = F.array_join(F.col("ids").cast("array<string>"), ",").alias("listed")
    parts = parts.select("path", "chunk", F.element_at("ids", 1).alias("first"), F.size("ids").cast("long").alias("n"), listed)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, first, n, sha = None, 0, 0, None
        for batch in batches:
            out = []
            for here, low, size, text in zip(*[batch.column(c).to_pylist() for c in ("path", "first", "n", "listed")], strict=True):
                if here != path:
                    if path is not None:
                        out.append((path, first, n, sha.hexdigest()))
                    path, first, n, sha = here, low, 0, hashlib.sha256()
                sha.update((("," if n else "") + text).encode())
                n += size
            yield _ended(out)
        if path is not None:
            yield _ended([(path, first, n, sha.hexdigest())])

    # Each path in one partition, its ranges in order.
    dealt = parts.repartition("path").sortWithinPartitions("path", "chunk")
    return dealt.mapInArrow(digest, "path binary, conv_id long, n long, ends_sha256 string")


def _ended(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [("path", pa.binary()), ("conv_id", pa.int64()), ("n", pa.int64()), ("ends_sha256", pa.string())]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(kinds)], [c for c, _ in kinds])


def bands(sizes: dict[int, int], most: int) -> list[tuple[int, int]]:
    """(low, high) from the greatest depth down to 0: the depths above low up to high are peeled in one round.

    `sizes` has the distinct paths that end at each depth; those that end at a depth or below it bound its live rows.
    Depths 1 and 0 are rounds of their own, so that a band is dealt by a prefix of one turn at least.
    """
    found, high = [], max(sizes, default=-1)
    live = 0
    while high >= 0:
        low, live = high - 1, live + sizes.get(high, 0)
        held, deeper = live, live + sizes.get(low, 0)
        while low >= 2 and held + deeper <= most:
            held, live, low = held + deeper, deeper, low - 1
            deeper = live + sizes.get(low, 0)
        found.append((low, high))
        high = low
    return found


def _prefix(depth: int) -> Column:
    return F.substring("path", 1, STEP * depth)


def _level(live: DataFrame, depth: int) -> DataFrame:
    """The nodes of one depth: all live rows of a path merged."""
    sums = [F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")]
    merged = live.groupBy("path").agg(F.min("conv_id").alias("conv_id"), *sums)
    words = F.conv(F.hex(F.substring("path", STEP * depth - 3, 4)), 16, 10).cast("long") if depth else F.lit(0)
    return merged.select(
        F.lit(depth).cast("long").alias("depth"),
        F.md5("path").alias("key"),
        (F.md5(_prefix(depth - 1)) if depth else F.lit(None).cast("string")).alias("parent"),
        "conv_id",
        "n",
        "children",
        F.when(F.col("children") == 0, 1).otherwise(F.col("leaves")).cast("long").alias("leaves"),
        (F.col("saved") + (F.col("n") - 1) * words).alias("saved"),
        "path",
    )


def _band(live: DataFrame, low: int, high: int) -> DataFrame:
    """The nodes of the depths above `low` up to `high`, peeled in tasks that hold all paths of a prefix of `low` turns."""

    def peel(table):
        # Live rows by depth: path -> [conv_id, n, children, leaves, saved, keys of the prefixes from low on].
        at: list[dict[bytes, list]] = [{} for _ in range(high - low + 1)]
        columns = [table[c].to_pylist() for c in ("path", "conv_id", "n", "children", "leaves", "saved")]

        def add(depth: int, key: str, conv: int, n: int, children: int, leaves: int, saved: int, path: bytes, keys: list[str]) -> None:
            node = at[depth - low].get(key)
            if node is None:
                at[depth - low][key] = [conv, n, children, leaves, saved, path, keys]
            else:
                node[0] = min(node[0], conv)
                for k, x in enumerate((n, children, leaves, saved), 1):
                    node[k] += x

        for path, *values in zip(*columns, strict=True):
            digest, keys = hashlib.md5(path[: STEP * low]), []
            for depth in range(low, len(path) // STEP + 1):
                if depth > low:
                    digest.update(path[STEP * (depth - 1) : STEP * depth])
                keys.append(digest.hexdigest())
            add(len(path) // STEP, keys[-1], *values, path, keys)
        out = []
        for depth in range(high, low, -1):
            for key, (conv, n, children, leaves, saved, path, keys) in at[depth - low].items():
                leaves = leaves if children else 1
                saved += (n - 1) * int.from_bytes(path[STEP * depth - 4 : STEP * depth], "big")
                above = keys[depth - 1 - low]
                # Only the band's uppermost nodes go on, and need their paths.
                out.append((depth, key, above, conv, n, children, leaves, saved, path[: STEP * depth] if depth == low + 1 else None))
                if depth - 1 > low:
                    add(depth - 1, above, conv, n, 1, leaves, saved, path, keys)
        names = ["depth", "key", "parent", "conv_id", "n", "children", "leaves", "saved", "path"]
        kinds = [pa.int64(), pa.string(), pa.string(), *[pa.int64()] * 5, pa.binary()]
        return pa.table([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names)

    return live.withColumn("_root", _prefix(low)).groupBy("_root").applyInArrow(peel, NODE)


def peeled(found: DataFrame, band: int = BAND) -> DataFrame:
    """One row for each node of the trie of the paths in (id, path), the root included.

    depth; conv_id, the smallest id of its members; parent_conv_id, that of its parent (root: null); n_convs, its members; n_children;
    n_leaves, the childless nodes of its subtree; saved_tokens, over its subtree the words of each node's last turn times its members less one;
    ends_sha256, of the ids that end at it in ascending order, joined by commas. Ids are distinct; an empty table gives no rows.
    """
    ends = ended(found).withColumn("depth", (F.octet_length("path") / STEP).cast("long"))
    # By depth, so that a round reads the files of its depths.
    ends = written(ends.repartitionByRange("depth", "path"), "ends")
    sizes = {r["depth"]: r["count"] for r in ends.groupBy("depth").count().collect()}
    zero = F.lit(0).cast("long")
    rounds: list[DataFrame] = []
    for low, high in bands(sizes, band):
        new = ends.where((F.col("depth") > low) & (F.col("depth") <= high))
        live = new.select("path", "conv_id", "n", zero.alias("children"), zero.alias("leaves"), zero.alias("saved"))
        if rounds:
            below = rounds[-1].where(F.col("depth") == high + 1)
            below = below.select(_prefix(high).alias("path"), "conv_id", "n", F.lit(1).cast("long").alias("children"), "leaves", "saved")
            live = live.unionByName(below)
        rounds.append(written(_level(live, high) if high == low + 1 else _band(live, low, high), "nodes"))
    if not rounds:
        return found.sparkSession.createDataFrame([], "depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    nodes = rounds[0].drop("path")
    for more in rounds[1:]:
        nodes = nodes.unionByName(more.drop("path"))
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    digests = ends.select(F.md5("path").alias("key"), "ends_sha256")
    none = hashlib.sha256(b"").hexdigest()
    return nodes.join(parents, "parent", "left").join(digests, "key", "left").select(
        "depth",
        "conv_id",
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )


def prefix_trie(rows: DataFrame, **columns: str) -> DataFrame:
    """The trie of conversations as they are; see `ordered_turns` for their order and `peeled` for the columns."""
    return peeled(written(paths(ordered_turns(rows, **columns)), "paths"))

"""Approximate nearest neighbours by a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample; every row is filed under a leaf, and a crowded leaf is cut into blocks. A
query walks the tree with a priority queue: the node whose centre has the largest product with it is opened next, and leaves are
visited in the order they come up. How many leaves that takes is calibrated: for some of the queries the true neighbours are
found by a full scan, and the visits are widened until the wanted share of these lies in visited leaves.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm.bytesops import matrices, mixed
from stationflow.llm.common import written
from stationflow.llm.embed_dedup import usable

# At most about so many vectors fit the tree, and so many queries calibrate the visits.
SAMPLE = 20_000
CALIBRATION = 128
BRANCHES = 8
LEAF_SAMPLE = 160
RECALL = 0.96
BLOCK = 2048
# Bytes of query vectors, in double precision, that meet a block at once.
QUERY_BYTES = 16 << 20
MERGED = 64
STRIP = 64


class Tree:
    """Nodes in one list: centres of the children and their numbers, or the number of a leaf."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.children: list[tuple[np.ndarray, list[int]] | None] = []
        self.leaf_of: list[int] = []
        self.leaves = 0
        self._grow(vectors)

    def _grow(self, vectors: np.ndarray) -> int:
        node = len(self.children)
        self.children.append(None)
        self.leaf_of.append(-1)
        split = self._split(vectors) if len(vectors) > LEAF_SAMPLE else None
        if split is None:
            self.leaf_of[node] = self.leaves
            self.leaves += 1
        else:
            centres, near = split
            self.children[node] = (centres, [self._grow(vectors[near == k]) for k in range(len(centres))])
        return node

    @staticmethod
    def nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
        return np.argmax(vectors @ centres.T - (centres * centres).sum(axis=1) / 2, axis=1)

    def _split(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Lloyd's rounds from evenly spaced rows; None if the rows cannot be told apart."""
        centres = np.unique(vectors[np.linspace(0, len(vectors) - 1, BRANCHES).astype(int)], axis=0)
        for _ in range(12):
            near = self.nearest(vectors, centres)
            used = np.unique(near)
            centres = np.stack([vectors[near == k].mean(axis=0) for k in used])
        near = self.nearest(vectors, centres)
        used, near = np.unique(near, return_inverse=True)
        return (centres[used], near) if len(used) > 1 else None

    def file(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: down the nearest centres."""
        out = np.zeros(len(vectors), np.int64)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if self.children[node] is None:
                out[rows] = self.leaf_of[node]
            elif len(rows):
                centres, below = self.children[node]
                near = self.nearest(vectors[rows], centres)
                todo += [(child, rows[near == k]) for k, child in enumerate(below)]
        return out

    def visits(self, query: np.ndarray, some: int, held: np.ndarray | None = None, rows: int = 0) -> list[int]:
        """The first `some` leaves, best bin first; more of them until they hold `rows` rows, held being those of each leaf."""
        queue, found, seen = [(0.0, 0)], [], 0
        while queue and (len(found) < some or seen < rows):
            _, node = heapq.heappop(queue)
            if self.children[node] is None:
                found.append(self.leaf_of[node])
                seen += int(held[found[-1]]) if held is not None else 0
            else:
                centres, below = self.children[node]
                for closeness, child in zip((centres @ query).tolist(), below, strict=True):
                    heapq.heappush(queue, (-closeness, child))
        return found


def nearest_in(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, product) of each query's k nearest other rows; ties to the smaller id.

    A matrix product finds who may be among them; their products are summed anew in one fixed order, so equal vectors tie.
    """
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for low in range(0, len(queries), STRIP):
        q, own = queries[low : low + STRIP], query_ids[low : low + STRIP]
        product = q @ vectors.T
        product[own[:, None] == ids[None, :]] = -np.inf
        if len(ids) > k:
            floor = np.partition(product, len(ids) - k, axis=1)[:, len(ids) - k]
            room = 1e-9 * (1 + np.sqrt((q * q).sum(axis=1)) * np.sqrt((vectors * vectors).sum(axis=1).max()))
            row, col = np.nonzero((product >= (floor - room)[:, None]) & (product > -np.inf))
        else:
            row, col = np.nonzero(product > -np.inf)
        score = (q[row] * vectors[col]).sum(axis=1)
        row, col, score = best(row, ids[col], score, k)
        out.append((own[row], col, score))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (query_ids[:0], ids[:0], np.zeros(0))


def best(group: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k first of each group by falling score, then id; in that order."""
    order = np.lexsort((ids, -score, group))
    group, ids, score = group[order], ids[order], score[order]
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])[: len(group)]
    rank = np.arange(len(group)) - np.repeat(first, np.diff(np.r_[first, len(group)]))
    return group[rank < k], ids[rank < k], score[rank < k]


def _unpacked(ids: bytes, vectors: bytes, dims: int, kind: type) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(vectors, kind).reshape(-1, dims).astype(np.float64)


def _each(n: str) -> Column:
    """One row for each number from 0 to below the column's."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))


class Index:
    """Rows (id, vector) filed under the leaves of a tree, as a table of packed blocks.

    Takes the rows whose vector is usable and of the most frequent length (the smaller one on a tie); a null id takes
    no part, and of rows that share an id the smallest vector counts.
    """

    def __init__(self, rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> None:
        rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).where("id is not null")
        rows = written(rows.where(usable("vector")).groupBy("id").agg(F.min("vector").alias("vector")), "vectors")
        lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
        self.dims = lengths.n if lengths else 0
        self.rows = rows.where(F.size("vector") == self.dims)
        self.count = lengths["count"] if lengths else 0
        exact = rows.schema["vector"].dataType.elementType.simpleString() == "float"
        self.kind = np.float32 if exact else np.float64
        chosen = F.pmod(F.xxhash64("id"), F.lit(1 << 40)) < int((1 << 40) * min(1.0, SAMPLE / max(1, self.count)))
        sample = self.rows.where(chosen).toPandas().sort_values("id")["vector"]
        self.tree = Tree(np.array(sample.tolist(), np.float64).reshape(len(sample), self.dims))
        self.blocks = self._filed()

    def _filed(self) -> DataFrame:
        tree, kind = self.rows.sparkSession.sparkContext.broadcast(self.tree), self.kind

        def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                leaf = np.zeros(batch.num_rows, np.int64)
                for at, vectors in matrices(batch.column(1)):
                    leaf[at] = tree.value.file(vectors.astype(np.float64))
                yield batch.append_column("leaf", pa.array(leaf))

        def pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values("id")
            ids, vectors = frame["id"].to_numpy(np.int64), np.array(frame["vector"].tolist(), kind)
            return pd.DataFrame([[int(key[0]), int(key[1]), ids.tobytes(), vectors.tobytes()]], columns=["leaf", "part", "ids", "vectors"])

        vector = self.rows.schema["vector"].dataType.simpleString()
        filed = written(self.rows.mapInArrow(file, f"id long, vector {vector}, leaf long"), "filed")
        parts = filed.groupBy(F.col("leaf").alias("of")).agg(F.ceil(F.count("*") / BLOCK).alias("parts"), F.count("*").alias("held"))
        self.parts = written(parts, "parts")
        placed = filed.join(self.parts, F.col("leaf") == F.col("of")).withColumn("part", F.pmod(F.xxhash64("id"), "parts"))
        packed = placed.select("leaf", "part", "id", "vector").groupBy("leaf", "part")
        return written(packed.applyInPandas(pack, "leaf long, part long, ids binary, vectors binary"), "blocks")

    def calibrated(self, queries: DataFrame, k: int, recall: float = RECALL) -> int:
        """Leaf visits at which `recall` of the true neighbours of some of the queries is reached."""
        n = queries.count()
        chosen = F.pmod(F.xxhash64(F.lit("calibration"), "id"), F.lit(1 << 40)) < int((1 << 40) * min(1.0, CALIBRATION / max(1, n)))
        some = queries.where(chosen).toPandas().sort_values("id")
        if not len(some) or self.tree.leaves < 2:
            return self.tree.leaves
        ids, vectors = some["id"].to_numpy(np.int64), np.array(some["vector"].tolist(), np.float64)
        dims, kind = self.dims, self.kind

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    there, there_vectors = _unpacked(row["ids"], row["vectors"], dims, kind)
                    q, i, s = nearest_in(vectors, ids, there_vectors, there, k)
                    yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(i), pa.array(s), pa.array(np.full(len(q), row["leaf"]))], ["q", "id", "score", "leaf"])

        found = self.blocks.mapInArrow(scan, "q long, id long, score double, leaf long")
        order = Window.partitionBy("q").orderBy(F.desc("score"), "id")
        true = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("q", "leaf").toPandas()
        place = {}
        for q, vector in zip(ids.tolist(), vectors, strict=True):
            place.update({(q, leaf): at for at, leaf in enumerate(self.tree.visits(vector, self.tree.leaves))})
        needed = np.sort([place[q, leaf] + 1 for q, leaf in zip(true["q"], true["leaf"], strict=True)])
        return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) if len(needed) else self.tree.leaves

    def search(self, wanted: Column, k: int, recall: float = RECALL) -> DataFrame:
        """(query, rank, id, score): the k rows of largest inner product found for each row with `wanted`, itself left out.

        Fewer than k only if the table has no more: leaves are visited until they hold k rows besides the query.
        """
        queries = self.rows.where(wanted)
        visits = self.calibrated(queries, k, recall)
        room = max(1, QUERY_BYTES // (8 * max(1, self.dims)))
        groups = max(1, -(-queries.count() // room))
        held = np.zeros(self.tree.leaves, np.int64)
        for leaf in self.parts.collect():
            held[leaf["of"]] = leaf["held"]
        tree, kind, dims = self.rows.sparkSession.sparkContext.broadcast(self.tree), self.kind, self.dims

        def sent(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, dict[int, list[int]]]]:
            """Slices of the vectors, and which of their rows go to which leaf."""
            for _, vectors in matrices(batch.column(1)):
                to: dict[int, list[int]] = {}
                for row, vector in enumerate(vectors.astype(np.float64)):
                    for leaf in tree.value.visits(vector, visits, held, k + 1):
                        to.setdefault(leaf, []).append(row)
                yield vectors, to

        def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(held), np.int64)
            for batch in batches:
                for _, to in sent(batch):
                    for leaf, rows in to.items():
                        total[leaf] += len(rows)
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["of", "n"])

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).to_numpy(zero_copy_only=False)
                for vectors, to in sent(batch):
                    columns = [list(to), [ids[r].tobytes() for r in to.values()], [vectors[r].astype(kind).tobytes() for r in to.values()]]
                    kinds = [pa.int64(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["leaf", "ids", "vectors"])

        def meet(key: tuple, there: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            q, i, s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
            if len(there) and len(asked):
                ids, vectors = _unpacked(there["ids"].iloc[0], there["vectors"].iloc[0], dims, kind)
                query_ids, queries = _unpacked(b"".join(asked["ids"]), b"".join(asked["vectors"]), dims, kind)
                q, i, s = nearest_in(queries, query_ids, vectors, ids, k)
            bundle = (mixed(q.astype(np.uint64)) % np.uint64(MERGED * groups)).astype(np.int64)
            order = np.argsort(bundle, kind="stable")
            kept, first = np.unique(bundle[order], return_index=True)
            cut = [np.split(x[order], first[1:]) if len(kept) else [] for x in (q, i, s)]
            return pd.DataFrame({"bundle": kept, **{n: [x.tobytes() for x in c] for n, c in zip(("q", "i", "s"), cut, strict=True)}})

        def merge(frame: pd.DataFrame) -> pd.DataFrame:
            q, i = (np.frombuffer(b"".join(frame[c]), np.int64) for c in ("q", "i"))
            q, i, s = best(q, i, np.frombuffer(b"".join(frame["s"]), np.float64), k)
            first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])[: len(q)]
            rank = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)])) + 1
            return pd.DataFrame({"query": q, "rank": rank.astype(np.int32), "id": i, "score": s})

        # A leaf's queries are counted first and cut into groups, as many as ask for it; its blocks travel once to each of them.
        asking = queries.select("id", "vector")
        leaves = asking.mapInArrow(tally, "of long, n long").groupBy("of").agg(F.ceil(F.sum("n") / room).alias("groups"))
        leaves = written(leaves.join(self.parts.select("of", "parts"), "of"), "asked")
        routed = asking.mapInArrow(route, "leaf long, ids binary, vectors binary")
        asked = routed.join(leaves, F.col("leaf") == F.col("of")).withColumn("group", F.pmod(F.xxhash64("ids"), "groups"))
        asked = asked.select("leaf", _each("parts").alias("part"), "group", "ids", "vectors")
        copies = self.blocks.join(leaves, F.col("leaf") == F.col("of")).select("leaf", "part", _each("groups").alias("group"), "ids", "vectors")
        keys = ["leaf", "part", "group"]
        met = copies.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(meet, "bundle long, q binary, i binary, s binary")
        return met.groupBy("bundle").applyInPandas(merge, "query long, rank int, id long, score double")

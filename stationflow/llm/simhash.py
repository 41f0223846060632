"""SimHash fingerprints of word shingles, and covering locality-sensitive hashing over them.

The covering tables take a nonzero vector m(i) of radius + 1 bits for every bit i of a fingerprint and,
for every nonzero vector v of that length, keep the bits with <m(i), v> = 1. The at most `radius` bits in
which two near fingerprints differ span less than the whole space, so some v is orthogonal to all
of their vectors: that table keeps none of these bits and the two meet in it. No pair is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.llm import bytesops
from stationflow.llm.common import shards, written
from stationflow.llm.graph import components

BITS = 64
SEED = 42
RADIUS = 4
# Bytes of table entries that one task sorts at most, on average.
SHARD_BYTES = 32 << 20


def masks(radius: int) -> np.ndarray:
    """The bits each covering table keeps."""
    vectors = np.arange(1, 1 << (radius + 1))
    of_bit = vectors[np.arange(BITS) % len(vectors)]
    kept = np.array([[bin(int(m & v)).count("1") & 1 for m in of_bit] for v in vectors], np.uint8)
    return np.packbits(kept, axis=1, bitorder="little").view(np.uint64).ravel()


def _joined(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words joined by one space, and where each begins and ends in that."""
    lengths = ends - starts
    at = np.cumsum(lengths + 1) - (lengths + 1)
    out = np.full(int((lengths + 1).sum()), 0x20, np.uint8)
    shift = np.repeat(at - starts, lengths)
    source = np.arange(int(lengths.sum())) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    out[source + shift] = raw[source]
    return out.tobytes(), at, at + lengths


def _bit_sums(hashes: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How often each bit is set among each row's hashes (a run from `first` of at least one)."""
    lanes = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").view(np.uint64)
    parts = -(-counts // 255)  # a byte holds up to 255 ones
    row_of = np.repeat(np.arange(len(counts)), parts)
    k = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    sums = np.add.reduceat(lanes, first[row_of] + 255 * k, axis=0).view(np.uint8).astype(np.int64)
    return np.add.reduceat(sums, np.cumsum(parts) - parts, axis=0)


def fingerprints_of(column: pa.Array, width: int) -> np.ndarray:
    """64-bit fingerprints of a column of texts."""
    out = np.zeros(len(column), np.uint64)
    for low, high, raw, offsets in bytesops.text_slices(column):
        raw = bytesops.LOWER[raw]
        starts, ends, rows = bytesops.words(raw, offsets)
        if not len(rows):
            continue
        text, at, to = _joined(raw, starts, ends)
        present, first, n = np.unique(rows, return_index=True, return_counts=True)
        counts = np.maximum(n - width + 1, 1)
        row = np.repeat(np.arange(len(present)), counts)
        head = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        last = np.minimum(head + width, (first + n)[row]) - 1
        digest = xxhash.xxh64_intdigest
        pairs = zip(at[head].tolist(), to[last].tolist(), strict=True)
        hashes = np.fromiter((digest(text[a:b], SEED) for a, b in pairs), np.uint64, len(head))
        sums = _bit_sums(hashes, np.cumsum(counts) - counts, counts)
        bits = (2 * sums > counts[:, None]).astype(np.uint8)
        out[low + present] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, width: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) of every row: the SimHash of its lower-cased `width`-word shingles as a signed 64-bit number.

    Null and empty texts and texts of white space have fingerprint 0; fewer words than `width` make one shingle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = fingerprints_of(batch.column(1), width).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(fp)], ["id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, fp long")


def fingerprinted(docs: DataFrame, out: str, width: int = 4, text_col: str = "text") -> DataFrame:
    """The rows with the fingerprint of their text as column `out`, a name that the rows do not have; see `fingerprints`."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = fingerprints_of(batch.column(at), width).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fp)], [*batch.schema.names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema, T.StructField(out, T.LongType())]))


def near_classes(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, class) of every distinct fingerprint in (fp): class is the smallest one reachable over links of `radius` or fewer differing bits."""
    nodes = written(prints.select("fp").distinct().select("fp", F.col("fp").alias("id")), "nodes")
    found = written(components(near_links(nodes, radius)), "found")
    return nodes.join(found, nodes["id"] == found["node"], "left").select("fp", F.coalesce("component", "fp").alias("class"))


def _near(codes: np.ndarray, ids: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links among the fingerprints of one bucket: each new one is compared with those not yet reached."""
    left = np.arange(len(codes))
    while len(left) > 1:
        root, queue, left = left[0], [left[0]], left[1:]
        while queue and len(left):
            here = queue.pop()
            close = np.bitwise_count(codes[left] ^ codes[here]) <= radius
            for other in left[close]:
                yield int(ids[root]), int(ids[other])
            queue.extend(left[close])
            left = left[~close]


def near_links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v): links that connect the same fingerprints as all pairs at `radius` or fewer differing bits do.

    nodes has (id, fp), every fingerprint once. Each task packs its table entries by shard into sorted arrays; a shard
    sorts what it gets by table key. Within a bucket only links of a spanning forest are made.
    """
    spark = nodes.sparkSession
    tables = masks(radius)
    parts = max(shards(spark), int(nodes.count()) * len(tables) * 24 // SHARD_BYTES + 1)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            codes = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            entry = np.empty((len(tables), len(ids)), [("key", "<u8"), ("fp", "<u8"), ("id", "<i8")])
            for k, mask in enumerate(tables):
                entry["key"][k] = bytesops.mixed((codes & mask) + np.uint64(k))
            entry["fp"], entry["id"] = codes, ids
            entry = entry.ravel()
            shard = (entry["key"] % np.uint64(parts)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            entry, shard = entry[order], shard[order]
            found, first = np.unique(shard, return_index=True)
            blobs = [x.tobytes() for x in np.split(entry, first[1:])] if len(found) else []
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(blobs, pa.binary())], ["shard", "entries"])

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        entry = np.frombuffer(b"".join(frame["entries"]), [("key", "<u8"), ("fp", "<u8"), ("id", "<i8")])
        entry = entry[np.argsort(entry["key"], kind="stable")]
        new = np.flatnonzero(np.r_[True, entry["key"][1:] != entry["key"][:-1]])
        size = np.diff(np.r_[new, len(entry)])
        links: set[tuple[int, int]] = set()
        for first, n in zip(new[size > 1].tolist(), size[size > 1].tolist(), strict=True):
            links.update(_near(entry["fp"][first : first + n], entry["id"][first : first + n], radius))
        return pd.DataFrame(sorted(links), columns=["u", "v"]).astype("int64")

    dealt = nodes.select("id", "fp").mapInArrow(deal, "shard long, entries binary")
    return dealt.groupBy("shard").applyInPandas(meet, "u long, v long")


def near_components(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(id, fp, component) of rows (id, fp): component is the smallest id reachable over links of `radius` or fewer differing bits.

    Equal fingerprints are one node, so a group of copies of any size is a single row before the tables are made.
    Rows with a null id have no links and a null component.
    """
    prints = written(prints, "prints")
    nodes = written(prints.where("id is not null").groupBy("fp").agg(F.min("id").alias("id")), "nodes")
    found = written(components(near_links(nodes, radius)), "found")
    of_node = found.withColumnRenamed("node", "id")
    classes = nodes.join(of_node, "id", "left").select(F.col("fp").alias("of_fp"), F.coalesce("component", "id").alias("component"))
    classes = written(classes, "classes")
    joined = prints.join(classes, prints["fp"] == classes["of_fp"], "left")
    return joined.select("id", "fp", F.when(F.col("id").isNotNull(), F.col("component")).alias("component"))


def fingerprint_text(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))

"""Packing of token sequences into rows of fixed length, and their binary form.

Pieces are placed longest first, each into the row with the least room that still holds it. A segment tree over the
possible capacities counts the open rows of each, so the best fit is found in the logarithm of the row length.

Each task packs what it reads, a bounded number of tokens at a time: nothing is shuffled, and at most one row a group stays
ill filled. A block is a row of a table: the matrix of ids, the segments' cumulative lengths and positions that
begin anew at each segment, in little-endian bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm import bytesops
from stationflow.llm.common import written

LENGTH = 2048
# Tokens that are packed together.
GROUP = 1 << 21
PADDING = 0
# A full block makes a row group of its own, however well it compresses: readers take up a row group at a time. By default
# Parquet looks at its buffers after 100 rows, which here are hundreds of megabytes.
TABLE = {"parquet.block.size": str(1 << 16), "parquet.page.size.row.check.min": "1", "parquet.enable.dictionary": "false"}
BLOCK = "part int, number long, length int, rows int, ids binary, positions binary, segment_ends binary, row_segments binary, docs binary, pieces binary, starts binary"


class Capacities:
    """Open rows by the room they have left."""

    def __init__(self, most: int) -> None:
        self.size = 1
        while self.size <= most:
            self.size *= 2
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def _add(self, room: int, by: int) -> None:
        node = room + self.size
        while node:
            self.count[node] += by
            node //= 2

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """(room, row) of a row with the smallest room of at least `least`, removed."""
        node = least + self.size
        if not self.count[node]:
            # Up until a subtree to the right holds a row, then down its left edge.
            while node & 1 or not self.count[node + 1]:
                node //= 2
                if node <= 1:
                    return None
            node += 1
            while node < self.size:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.size
        self._add(room, -1)
        return room, self.rows[room].pop()


def best_fit(lengths: list[int], most: int) -> list[tuple[int, int]]:
    """(row, offset) of each piece, none longer than `most`."""
    open_rows, rows, placed = Capacities(most), 0, [(0, 0)] * len(lengths)
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        found = open_rows.take(lengths[k])
        if found is None:
            found, rows = (most, rows), rows + 1
        room, row = found
        placed[k] = (row, most - room)
        open_rows.put(room - lengths[k], row)
    return placed


def block_of(pieces: list[tuple[int, int, np.ndarray]], length: int, kind: type) -> dict:
    """A packed block of (document, piece number, ids)."""
    placed = best_fit([len(p[2]) for p in pieces], length)
    rows = max(r for r, _ in placed) + 1
    ids, positions = np.full((rows, length), PADDING, kind), np.zeros((rows, length), kind if length > 1 << 16 else np.uint16)
    order = sorted(range(len(pieces)), key=lambda k: placed[k])
    for k in order:
        (row, at), tokens = placed[k], pieces[k][2]
        ids[row, at : at + len(tokens)] = tokens
        positions[row, at : at + len(tokens)] = np.arange(len(tokens))
    ends = np.array([placed[k][1] + len(pieces[k][2]) for k in order], np.int32)
    per_row = np.bincount([placed[k][0] for k in order], minlength=rows).astype(np.int32)
    columns = {"ids": ids, "positions": positions, "segment_ends": ends, "row_segments": per_row}
    columns["docs"] = np.array([pieces[k][0] for k in order], np.int64)
    columns["pieces"] = np.array([pieces[k][1] for k in order], np.int32)
    columns["starts"] = np.array([placed[k][1] for k in order], np.int32)
    return {"length": length, "rows": rows} | {n: c.tobytes() for n, c in columns.items()}


def packed(docs: DataFrame, encode: Callable[[list[str]], list], length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", kind: type = np.uint16) -> DataFrame:
    """Blocks of the rows' token ids, `encode` giving the ids of a list of texts as numbers of `kind`.

    A document longer than `length` is split into pieces of that length and a rest, numbered from 0, so no id is lost. A
    null or empty text has no ids and no piece. Ids are long; a null id is stored as the smallest one. Rows that share an id
    are packed apart. Padding has id 0 and lies behind the row's last segment end.
    """
    names = [x.split()[0] for x in BLOCK.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        waiting: list[tuple[int, int, np.ndarray]] = []
        tokens = 0

        def flushed() -> pa.RecordBatch:
            row = {"part": part, "number": number} | block_of(waiting, length, kind)
            kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 7]
            return pa.RecordBatch.from_arrays([pa.array([row[n]], t) for n, t in zip(names, kinds, strict=True)], names)

        for batch in batches:
            ids = batch.column(0).fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
            for low, high, _, _ in bytesops.text_slices(batch.column(1), 1 << 21):
                texts = [t or "" for t in batch.column(1).slice(low, high - low).to_pylist()]
                for doc, found in zip(ids[low:high].tolist(), encode(texts), strict=True):
                    found = np.asarray(found, kind)
                    for k in range(0, len(found), length):
                        piece = found[k : k + length]
                        waiting.append((doc, k // length, piece))
                        tokens += len(piece)
                        if tokens >= GROUP:
                            yield flushed()
                            waiting, tokens, number = [], 0, number + 1
        if waiting:
            yield flushed()

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, BLOCK)


def segments(blocks: DataFrame, kind: type = np.uint16) -> DataFrame:
    """(doc_id, piece, part, number, row, start, length, ids binary) of every segment, read from the matrices by the
    cumulative lengths; a segment whose positions do not count up from 0 is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                length, rows = block["length"], block["rows"]
                ids = np.frombuffer(block["ids"], kind).reshape(rows, length)
                positions = np.frombuffer(block["positions"], kind if length > 1 << 16 else np.uint16).reshape(rows, length)
                ends, per_row = (np.frombuffer(block[c], np.int32) for c in ("segment_ends", "row_segments"))
                row = np.repeat(np.arange(rows), per_row)
                new = np.r_[True, row[1:] != row[:-1]][: len(row)]
                starts = np.where(new, 0, np.r_[0, ends[:-1]][: len(ends)])
                found = []
                for r, a, b in zip(row.tolist(), starts.tolist(), ends.tolist(), strict=True):
                    if not (positions[r, a:b] == np.arange(b - a)).all():
                        raise ValueError(f"positions of block {block['part']}.{block['number']}, row {r}, do not begin at {a}")
                    found.append(ids[r, a:b].tobytes())
                n = len(found)
                docs, pieces = np.frombuffer(block["docs"], np.int64), np.frombuffer(block["pieces"], np.int32)
                place = [pa.array([block["part"]] * n, pa.int32()), pa.array([block["number"]] * n, pa.int64())]
                columns = [pa.array(docs, mask=docs == -(1 << 63)), pa.array(pieces), *place, pa.array(row.astype(np.int32)), pa.array(starts.astype(np.int32)), pa.array((ends - starts).astype(np.int32)), pa.array(found, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "part", "number", "row", "start", "length", "ids"])

    return blocks.mapInArrow(run, "doc_id long, piece int, part int, number long, row int, start int, length int, ids binary")


def write_packed(blocks: DataFrame, label: str = "packed") -> DataFrame:
    """The blocks as a table in the shared folder, read back."""
    return written(blocks, label, options=TABLE)


def byte_level(path: str, pattern: str) -> Callable[[list[str]], list]:
    """An encoder by a file of byte-level ranks; opened once per worker."""

    def encode(texts: list[str]) -> list:
        return _ranked(path, pattern).encode_ordinary_batch(texts, num_threads=1)

    return encode


_encodings: dict[str, object] = {}


def _ranked(path: str, pattern: str):
    if path not in _encodings:
        import base64

        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[path] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]

"""BPE encoding with content-defined chunk reuse, and decoding, for tokenizers that split words at white space.

A text is cut where a rolling hash of the bytes before a white space says so. Equal passages therefore fall into equal
chunks wherever they stand, and a chunk that many documents share is encoded once while a worker's bounded table holds
it. A chunk not in the table is put together from its words, looked up in a second bounded table; words in neither go to the
tokenizer in one batch. Each joint of two chunks is then encoded anew from the words on both sides. Where that disagrees
with the chunks' own ids, the window widens until its outer words agree, and its ids replace theirs.

Chunk texts stay in the task that reads them: to send them to a common place and the ids back would move
several times the corpus through a shuffle, while encoding a chunk once per worker costs next to nothing.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.llm import bytesops

# A chunk ends at a white space if the hash of so many bytes before it is 0 modulo CUT.
WINDOW = 16
CUT = 64
CHUNKS = 10_000
WORDS = 180_000
JOINTS = 50_000
IDS = T.StructField("ids", T.ArrayType(T.IntegerType()))


class Recent:
    """A table of the latest entries: between `most` and twice as many."""

    def __init__(self, most: int) -> None:
        self.most, self.new, self.old = most, {}, {}

    def get(self, key):
        value = self.new.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.new) >= self.most:
            self.old, self.new = self.new, {}
        self.new[key] = value

    def known(self, keys: set) -> dict:
        """The entries of many keys at once; those of the older half become recent."""
        found = {k: self.new[k] for k in keys & self.new.keys()}
        again = {k: self.old[k] for k in (keys - found.keys()) & self.old.keys()}
        self.add(again)
        return found | again

    def add(self, entries: dict) -> None:
        if len(self.new) + len(entries) > self.most and len(self.new) > len(entries):
            self.old, self.new = self.new, {}
        self.new.update(entries)

    def shrink(self) -> None:
        """Leave the older half."""
        self.old = {}


def _packed(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


class Encoder:
    """A tokenizer with its tables; one per worker and file, kept from task to task."""

    _known: dict[str, Encoder] = {}

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        ids = range(self.tokenizer.get_vocab_size(with_added_tokens=True))
        self.tokens = pa.array([self.tokenizer.id_to_token(k) or "" for k in ids], pa.string())
        self.chunks, self.words, self.joints = Recent(CHUNKS), Recent(WORDS), Recent(JOINTS)
        if self.plain([b"a b  c\n\td"]) != [b"".join(self.plain([b"a", b"b", b"c", b"d"]))]:
            raise ValueError(f"{path} keeps white space: chunks cannot be put together from words")

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._known:
            cls._known[path] = cls(path)
        return cls._known[path]

    def shrink(self) -> None:
        """What a worker need not hold while other stages use it."""
        for table in (self.chunks, self.words, self.joints):
            table.shrink()
        pa.default_memory_pool().release_unused()

    def decode(self, column: pa.Array) -> pa.Array:
        """The texts of a list column of ids."""
        if self.tokenizer.decoder is not None:
            lists = (value.values.to_pylist() if value.is_valid else None for value in column)
            return pa.array([None if ids is None else self.tokenizer.decode(ids, skip_special_tokens=False) for ids in lists], pa.string())
        # Without a decoder of its own, a tokenizer joins the tokens by spaces.
        first, last = (column.offsets[0].as_py(), column.offsets[-1].as_py()) if len(column) else (0, 0)
        tokens = self.tokens.take(column.values.slice(first, last - first))
        starts = pc.subtract(column.offsets, pa.scalar(first, pa.int32()))
        return pc.binary_join(pa.ListArray.from_arrays(starts, tokens, mask=column.is_null()), " ")

    def plain(self, texts: list[bytes]) -> list[bytes]:
        batch = [x.decode("utf-8") for x in texts]
        return [_packed(e.ids) for e in self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)]

    def _words(self, found: set[bytes]) -> dict[bytes, bytes]:
        """Ids of the words."""
        known = self.words.known(found)
        new = list(found - known.keys())
        made = dict(zip(new, self.plain(new), strict=True))
        self.words.add(made)
        return known | made

    def _repaired(self, left: list[bytes], right: list[bytes], gap: bytes) -> tuple[int, int, bytes]:
        """How many words left and right of the joint to encode together, and their ids."""
        k = 1
        while True:
            a, b = left[-k:], right[:k]
            whole = self.plain([b" ".join(a) + gap + b" ".join(b)])[0]
            first, last = self.plain([a[0], b[-1]])
            edges = whole.startswith(first) and whole.endswith(last)
            agreed = whole == first + last if k == 1 else edges
            if agreed or k >= max(len(left), len(right)):
                return len(a), len(b), whole
            k *= 2

    def encode(self, texts: list[list[bytes]]) -> list[bytes]:
        """Packed ids of texts given as their chunks."""
        ids_of: dict[bytes, bytes] = {}
        words_of: dict[bytes, list[bytes]] = {}
        for chunk in {c for text in texts for c in text}:
            ids = self.chunks.get(chunk)
            if ids is None:
                words_of[chunk] = chunk.split()
            else:
                ids_of[chunk] = ids
        known = self._words({w for words in words_of.values() for w in words})
        for chunk, words in words_of.items():
            ids_of[chunk] = b"".join([known[w] for w in words])
            self.chunks.put(chunk, ids_of[chunk])
        joints = {}
        for text in texts:
            for a, b in zip(text, text[1:], strict=False):
                left, right = a.rsplit(None, 1)[-1:], b.split(None, 1)[:1]
                if left and right:
                    joints[a, b] = left[0] + b[:1] + right[0]
        new = [j for j in set(joints.values()) if self.joints.get(j) is None]
        sides = [j.split() for j in new]
        ends = self._words({w for pair in sides for w in pair})
        for joint, pair, whole in zip(new, sides, self.plain(new), strict=True):
            self.joints.put(joint, whole == b"".join([ends[w] for w in pair]))
        apart = {pair for pair, joint in joints.items() if self.joints.get(joint) is not True}
        if not apart:
            return [b"".join([ids_of[c] for c in text]) for text in texts]
        return [self._joined(text, ids_of, apart) for text in texts]

    def _joined(self, text: list[bytes], ids_of: dict[bytes, bytes], apart: set[tuple[bytes, bytes]]) -> bytes:
        """Ids of a text with joints that need repair: each is encoded over the window on which both sides agree."""
        if not any(pair in apart for pair in zip(text, text[1:], strict=False)):
            return b"".join([ids_of[c] for c in text])
        done, words = b"", text[0].split()
        for a, b in zip(text, text[1:], strict=False):
            right = b.split()
            if (a, b) in apart and words and right:
                x, y, whole = self._repaired(words, right, b[:1])
                if x == len(words) and y == len(right):
                    # The window holds both sides whole: they go on as one chunk.
                    words = words + right
                    continue
                known = self._words(set(words[:-x]))
                done += b"".join([known[w] for w in words[:-x]]) + whole
                words = right[y:]
            else:
                known = self._words(set(words))
                done += b"".join([known[w] for w in words])
                words = right
        return done + (self.plain([b" ".join(words)])[0] if words else b"")


def chunked(raw: np.ndarray, offsets: np.ndarray) -> list[list[bytes]]:
    """The texts as chunks; together the chunks of a text are the text."""
    white = np.flatnonzero(bytesops.WHITE[raw])
    row = np.searchsorted(offsets, white, "right") - 1
    begin = offsets[row]
    far = white - begin >= WINDOW
    white, row = white[far], row[far]
    hashes = bytesops.span_hashes(bytesops.prefix_sums(raw), white - WINDOW, white)
    at = white[hashes % np.uint64(CUT) == 0]
    data = raw.tobytes()
    cuts = np.searchsorted(at, offsets)
    texts = []
    for k in range(len(offsets) - 1):
        ends = [int(offsets[k]), *at[cuts[k] : cuts[k + 1]].tolist(), int(offsets[k + 1])]
        texts.append([data[a:b] for a, b in zip(ends, ends[1:], strict=False) if a < b])
    return texts


def encoded(
    docs: DataFrame, path: str, keep: Sequence[str] = ("doc_id",), text_col: str = "text", decoded_col: str | None = None
) -> DataFrame:
    """The columns to keep and ids, array<int>, of every row: the ids of its whole text, without special tokens added.

    With `decoded_col`, also the text of the ids, decoded in the same pass. Equal to encoding each text whole. A null text counts as empty and has no ids; ids may be null or
    repeat. A tokenizer that keeps white space is refused. The kept columns must not be called ids. The tokenizer file must be at `path` on every executor.
    """

    chosen = docs.select(*keep, F.col(text_col).alias("_text"))
    out = T.StructType([*chosen.schema.fields[:-1], IDS])
    if decoded_col:
        out.add(decoded_col, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path)
        for batch in batches:
            for low, high, raw, offsets in bytesops.text_slices(batch.column(batch.num_columns - 1), 1 << 21):
                found = encoder.encode(chunked(raw, offsets))
                ends = np.cumsum([0, *[len(x) // 4 for x in found]]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(found), np.int32))
                ids = pa.ListArray.from_arrays(pa.array(ends), values)
                columns = [*[c.slice(low, high - low) for c in batch.columns[:-1]], ids]
                if decoded_col:
                    columns.append(encoder.decode(ids))
                yield pa.RecordBatch.from_arrays(columns, out.names)
        encoder.shrink()

    return chosen.mapInArrow(run, out)


def decoded(rows: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """The rows with the text of their ids, special tokens included; null ids have a null text."""
    at = rows.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path)
        for batch in batches:
            texts = encoder.decode(batch.column(at))
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, text_col])

    return rows.mapInArrow(run, T.StructType([*rows.schema, T.StructField(text_col, T.StringType())]))

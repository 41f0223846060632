"""Grouping of spelling variants by Bloom-guided neighbourhoods.

1.  Words are counted over the corpus, combined before the shuffle.
2.  A blocked Bloom filter holds the vocabulary, sharded by word length and, within a length, by hash into parts of bounded size. Each
    part is made by one task. Parts are broadcast in rounds of at most ROUND_BYTES together, so a broadcast never grows with
    the vocabulary: a larger one takes more rounds.
3.  Every word probes its edits in the shards of their lengths: each distinct deletion, and each replacement of a letter by a later one
    of the alphabet. What a word's insertions or its other replacements would find, the word they lead to finds by its own edits. The
    hash of an edit follows from sums over the word, so only edits that the filter lets through become strings.
4.  Those, and nothing else, are shuffled to an exact join with the vocabulary, which removes the false positives.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.llm import bytesops
from stationflow.llm.common import written

# Letters of Latin-1 from À on; every letter of a word is one byte there.
LETTERS = r"A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABET = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint8)

BITS_PER_WORD = 20
PART_WORDS = 1 << 15
ROUND_BYTES = 32 << 20
# Letters of words that are probed together, and edits let through that leave a task together.
SLICE = 1 << 15
EMIT = 1 << 14

ROUNDS = 10

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_VALUES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)


def word_counts(
    docs: DataFrame, least_length: int, least_count: int, change: Callable[[Column, Column], Column] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(word, n): runs of Latin letters of whole texts with A to Z in lower case, and how often they occur.

    `change` makes another word of an id and a run; it may shorten runs but not lengthen them. Null texts have no words.
    """
    # A shorter run cannot become a word: the pattern passes over it at once.
    runs = F.regexp_extract_all(F.col(text_col), F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))
    words = docs.select(F.col(id_col).alias("id"), F.explode(runs).alias("run"))
    words = words.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    word = change(F.col("id"), F.col("run")) if change else F.col("run")
    counted = words.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.col("n") >= least_count) & (F.length("word") >= least_length))


def letters(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix of letters) of a column of words, one pair for each length, a bounded number of letters at a time."""
    words = [w.encode("latin-1") for w in column.to_pylist()]
    lengths = np.array([len(w) for w in words], np.int64)
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        step = max(1, SLICE // max(length, 1))
        for k in range(0, len(rows), step):
            some = rows[k : k + step]
            yield some, np.frombuffer(b"".join([words[r] for r in some]), np.uint8).reshape(len(some), length)


def _powers(n: int) -> np.ndarray:
    found = np.full(n + 1, _BASE)
    found[0] = 1
    return np.cumprod(found)


def _sums(matrix: np.ndarray) -> np.ndarray:
    """Sums of the letters' values by place, before each place and behind the last."""
    out = np.zeros((len(matrix), matrix.shape[1] + 1), np.uint64)
    np.cumsum(_VALUES[matrix] * _powers(matrix.shape[1])[:-1], axis=1, out=out[:, 1:])
    return out


def _probe(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where to look in a part (the upper half chooses the block) and which five bits of the block must be set."""
    bits = np.zeros(hashes.shape, np.uint64)
    for k in range(5):
        bits |= np.uint64(1) << ((hashes >> np.uint64(6 * k)) & np.uint64(63))
    return hashes >> np.uint64(32), bits


class Filters:
    """Parts of the filter of some lengths: blocks of 64 bits, end to end, and where each part begins.

    `shape` has the number of parts and the blocks of a part for every length that has words.
    """

    def __init__(self, shape: dict[int, tuple[int, int]], parts: dict[tuple[int, int], bytes]) -> None:
        self.shape = shape
        self.starts: dict[int, np.ndarray] = {}
        blocks, at = [np.zeros(1, np.uint64)], 1
        for length in {k for k, _ in parts}:
            # Parts of other rounds have no place here: their block is the empty one in front.
            self.starts[length] = np.zeros(shape[length][0], np.int64)
        for (length, part), blob in sorted(parts.items()):
            self.starts[length][part] = at
            blocks.append(np.frombuffer(blob, np.uint64))
            at += len(blocks[-1])
        self.blocks = np.concatenate(blocks)

    def may_hold(self, length: int, hashes: np.ndarray) -> np.ndarray:
        if length not in self.starts:
            return np.zeros(hashes.shape, bool)
        parts, size = self.shape[length]
        hashes = bytesops.mixed(hashes)
        high, bits = _probe(hashes)
        start = self.starts[length]
        start = start[0] if parts == 1 else start[(bytesops.mixed(hashes) % np.uint64(parts)).astype(np.int64)]
        place = ((high * np.uint64(size)) >> np.uint64(32)).astype(np.int64) + start
        if parts > 1:
            place = np.where(start > 0, place, 0)
        elif start == 0:
            return np.zeros(hashes.shape, bool)
        return (self.blocks[place] & bits) == bits


def word_hashes(matrix: np.ndarray) -> np.ndarray:
    return _sums(matrix)[:, -1]


def filter_parts(words: DataFrame, shape: dict[int, tuple[int, int]]) -> DataFrame:
    """(length, part, blocks): the filter of the words, each part made by the task that holds its words."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, matrix in letters(batch.column(0)):
                hashes, length = bytesops.mixed(word_hashes(matrix)), matrix.shape[1]
                part = bytesops.mixed(hashes) % np.uint64(shape[length][0])
                columns = [pa.array(np.full(len(rows), length)), pa.array(part.astype(np.int64)), pa.array(hashes.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["length", "part", "hash"])

    def fill(key, table):
        size = shape[key[0].as_py()][1]
        high, bits = _probe(table["hash"].to_numpy().view(np.uint64))
        blocks = np.zeros(size, np.uint64)
        np.bitwise_or.at(blocks, ((high * np.uint64(size)) >> np.uint64(32)).astype(np.int64), bits)
        return pa.table({"length": [key[0].as_py()], "part": [key[1].as_py()], "blocks": [blocks.tobytes()]})

    dealt = words.select("word").mapInArrow(deal, "length long, part long, hash long")
    return dealt.groupBy("length", "part").applyInArrow(fill, "length long, part long, blocks binary")


def _edits(matrix: np.ndarray, alphabet: np.ndarray, filters: Filters) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(rows, places, letter) of the edits that the filter lets through; letter -1 deletes, any other replaces."""
    length = matrix.shape[1]
    sums, power = _sums(matrix), _powers(length)
    whole = sums[:, -1:]
    # Without the letter at a place, those behind it move up by one: their values lose one factor.
    without = sums[:, :-1] + (whole - sums[:, 1:]) * _BASE_INVERSE
    found = filters.may_hold(length - 1, without)
    # Of a run of one letter any deletion is the same.
    found[:, 1:] &= matrix[:, 1:] != matrix[:, :-1]
    yield *np.nonzero(found), -1
    if length not in filters.starts:
        return
    for letter in alphabet.tolist():
        rows, places = np.nonzero(matrix < letter)
        if len(rows):
            old = _VALUES[matrix[rows, places]]
            kept = filters.may_hold(length, whole[rows, 0] + (_VALUES[letter] - old) * power[places])
            yield rows[kept], places[kept], letter


def candidates(words: DataFrame, parts: dict[tuple[int, int], bytes], shape: dict[int, tuple[int, int]], alphabet: bytes) -> DataFrame:
    """(word, n, near) of the edits of the words that the given parts of the filter let through."""
    shared = words.sparkSession.sparkContext.broadcast((shape, parts))
    out = pa.schema([("word", pa.string()), ("n", pa.int64()), ("near", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, order = Filters(*shared.value), np.frombuffer(alphabet, np.uint8)
        for batch in batches:
            n = batch.column(1).to_numpy()
            kept: list[tuple[str, int, str]] = []
            for rows, matrix in letters(batch.column(0)):
                for some, places, letter in _edits(matrix, order, filters):
                    for r, p in zip(some.tolist(), places.tolist(), strict=True):
                        word = matrix[r].tobytes()
                        edit = word[:p] + (b"" if letter < 0 else bytes([letter])) + word[p + 1 :]
                        kept.append((word.decode("latin-1"), int(n[rows[r]]), edit.decode("latin-1")))
                        if len(kept) >= EMIT:
                            yield pa.RecordBatch.from_pylist([dict(zip(out.names, k, strict=True)) for k in kept], out)
                            kept = []
            yield pa.RecordBatch.from_pylist([dict(zip(out.names, k, strict=True)) for k in kept], out)

    return words.select("word", "n").mapInArrow(run, "word string, n long, near string")


def _rounds(shape: dict[int, tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """The parts, in rounds of at most ROUND_BYTES together."""
    found, used = [[]], 0
    for length, (parts, blocks) in sorted(shape.items()):
        for part in range(parts):
            if found[-1] and used + 8 * blocks > ROUND_BYTES:
                found.append([])
                used = 0
            found[-1].append((length, part))
            used += 8 * blocks
    return found


def neighbours(words: DataFrame) -> DataFrame:
    """(word, near, near_n) of the words (word, n): all pairs that differ by one inserted, deleted or replaced letter, both ways.

    Words are distinct and made of Latin letters without A to Z; every pair is found once, by the longer word or the one with
    the earlier letter.
    """
    spark = words.sparkSession
    sizes = {r["length"]: r["count"] for r in words.groupBy(F.length("word").alias("length")).count().collect()}
    shape = {}
    for length, count in sizes.items():
        parts = -(-count // PART_WORDS)
        shape[length] = (parts, -(-(-(-count // parts)) * BITS_PER_WORD // 64))
    used = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).distinct().collect()
    alphabet = bytes(sorted(ord(r["letter"]) for r in used if r["letter"]))
    made = written(filter_parts(words, shape), "filter")
    passed = None
    for some in _rounds(shape):
        wanted = spark.createDataFrame(some, "length long, part long") if some else None
        rows = made.join(F.broadcast(wanted), ["length", "part"]).collect() if wanted is not None else []
        parts = {(r["length"], r["part"]): bytes(r["blocks"]) for r in rows}
        new = candidates(words, parts, shape, alphabet)
        passed = new if passed is None else passed.unionByName(new)
    passed = written(passed, "candidates")
    known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = written(passed.join(known, "near"), "pairs")
    back = pairs.select(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return pairs.select("word", "near", "near_n").unionByName(back)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of links (word, form): root is where following the links ends. Links must not lead in a circle.

    Each round doubles the way that has been followed.
    """
    state = written(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(ROUNDS):
        further = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = state.join(further, "root", "left")
        state = written(moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if state.where("moved").isEmpty():
            return state.select("word", "root")
        state = state.select("word", "root")
    raise RuntimeError("the links lead in a circle")


def variants(words: DataFrame, times: int = 10) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of the words (word, n).

    n_near counts the words that differ by one inserted, deleted or replaced letter. form is the one of them that occurs most, ties
    to the first in code-point order, if it occurs at least `times` as often as the word, and else null; root follows the forms to
    the last. With `times` above 1 forms never lead in a circle. An empty table gives no rows.
    """
    words = written(words, "vocabulary")
    near = neighbours(words)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    near = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    near = near.select(F.col("word").alias("of"), "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))
    joined = words.join(near, F.col("word") == F.col("of"), "left")
    formed = F.col("near_n") >= F.col("n") * times
    found = joined.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("near")).alias("form"),
        F.when(formed, F.col("near_n")).alias("form_n"),
    )
    found = written(found, "forms")
    last = roots(found.where("form is not null")).select(F.col("word").alias("of"), "root")
    joined = found.join(last, F.col("word") == F.col("of"), "left").drop("of")
    return joined.withColumn("root", F.coalesce("root", "word"))

"""Exact removal of repeated byte strings by a distributed merge sort of suffixes that knows common prefixes.

A byte goes if a string of SPAN bytes that covers it also starts earlier. Sorting every suffix of a corpus is not needed for
that: among the places where a SPAN-byte window may hold a KEY-byte string, the one of smallest hash is a function of the
window's bytes. Equal windows have equal such anchors at equal distances, so it suffices to compare anchors, about one byte in 35.

1.  Documents are dealt to batches of about BATCH bytes. Each batch sends the hashes of its anchors, once each, to shards;
    a shard answers which of them several batches have.
2.  For anchors so shared, or repeated in the batch, a batch takes the suffix (SPAN bytes from the anchor on, then the bytes
    before it backwards, as far as windows reach), sorts them, sends each distinct one once, front-coded: the length
    of the prefix it shares with the one before, and the rest. All but the first of equal ones are repeats already.
3.  A shard merges its sorted runs with a loser tree. Front coding gives each suffix's common prefix with the run's last one, so
    two candidates are compared only behind the prefix that both are known to share with the last winner; the merge yields
    the common prefixes of the whole order. Suffixes with a common prefix of KEY bytes are one anchor; per distance
    of window and anchor, those that agree before and behind it are the same window, and all but the earliest are repeats.
4.  Each batch gets back the byte ranges of its repeats and cuts them out.

An anchor that many texts hold in different surroundings (a short common line) would bring all of them to one shard. Anchors with more
than HOT surroundings, counted over the batches, are therefore not sent as suffixes: of each window that has such an anchor a batch sends
the hash to the shard that the hash names, once, so equal windows still meet there and different ones spread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm import bytesops
from stationflow.llm.common import shards, written

SPAN = 100
KEY = 32
BATCH = 8 << 20
HOT = 1 << 12
OUTSIDE = 0xFF  # in no UTF-8 text
POSITION = 40  # bits of a byte position in a document
# Bytes under other names: sums over them make a second hash.
TWIN = np.random.default_rng(43).permutation(256).astype(np.uint8)
NO_HASHES = np.zeros(0, np.uint64)


class Corpus:
    """The documents of a batch in their order: by id, null first, then text."""

    def __init__(self, table: pa.Table) -> None:
        ids = np.array([(-(1 << 63)) if x is None else x for x in table["_id"].to_pylist()], np.int64)
        order = np.argsort(ids, kind="stable")
        if len(np.unique(ids)) < len(ids):
            texts = table["_text"].to_pylist()
            order = np.array(sorted(range(len(ids)), key=lambda k: (ids[k], texts[k] or "")), np.int64)
        self.table = table.combine_chunks().take(pa.array(order))
        self.ids = ids[order]
        self.raw, self.offsets = bytesops.text_buffer(pa.concat_arrays(self.table["_text"].chunks))

    def anchors(self, span: int, hot: np.ndarray = NO_HASHES) -> Iterator[tuple[np.ndarray, ...]]:
        """Some documents at a time: (positions, rows, hashes of the KEY bytes, hashes of the surroundings) of the anchors, but
        of those with a hash in `hot` (positions, rows, two hashes) of the windows that have them, at the end of the tuple.
        """
        for low, high in bytesops.slices(self.offsets):
            begin, end = self.offsets[low], self.offsets[high]
            n = int(end - begin)
            windows = n - span + 1
            if windows <= 0:
                continue
            sums = bytesops.prefix_sums(self.raw[begin:end])
            at = np.arange(n - KEY + 1)
            hashes = bytesops.span_hashes(sums, at, at + KEY)
            # By hash, then place: both in one number, or, for a document beyond 16 MB, as places in a ranking.
            packed = n <= 1 << 24
            if packed:
                least = (hashes & ~np.uint64((1 << 24) - 1)) | at.astype(np.uint64)
            else:
                place = np.lexsort((at, hashes))
                least = np.empty(len(at), np.int64)
                least[place] = at
            width, reach = span - KEY + 1, 1
            while 2 * reach <= width:
                least = np.minimum(least[: len(least) - reach], least[reach:])
                reach *= 2
            least = np.minimum(least[:windows], least[width - reach : width - reach + windows])
            found = (least & np.uint64((1 << 24) - 1)).astype(np.int64) if packed else place[least]
            whole = np.zeros(windows, bool)
            for a, b in zip(self.offsets[low:high] - begin, self.offsets[low + 1 : high + 1] - begin, strict=True):
                whole[a : max(a, b - span + 1)] = True
            marked = np.zeros(n, bool)
            marked[found[whole]] = True
            positions = np.flatnonzero(marked)
            rows = np.searchsorted(self.offsets, positions + begin, "right") - 1
            low_end, high_end = self.offsets[rows] - begin, self.offsets[rows + 1] - begin
            around = bytesops.span_hashes(sums, positions, np.minimum(positions + span, high_end))
            around = bytesops.mixed(around + bytesops.span_hashes(sums, np.maximum(positions - (span - KEY), low_end), positions))
            cold, windows_of_hot = np.ones(len(positions), bool), np.zeros(0, np.int64)
            twice = NO_HASHES
            if len(hot):
                cold = ~np.isin(hashes[positions], hot)
                marked[positions[cold]] = False
                windows_of_hot = np.flatnonzero(whole)[marked[found[whole]]]
                twins = bytesops.prefix_sums(TWIN[self.raw[begin:end]])
                twice = bytesops.span_hashes(twins, windows_of_hot, windows_of_hot + span)
            once = bytesops.span_hashes(sums, windows_of_hot, windows_of_hot + span)
            row_of = np.searchsorted(self.offsets, windows_of_hot + begin, "right") - 1
            positions, rows, around = positions[cold], rows[cold], around[cold]
            yield positions + begin, rows, hashes[positions], around, windows_of_hot + begin, row_of, once, twice

    def suffixes(self, positions: np.ndarray, rows: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per anchor: SPAN bytes from it on and those before it backwards, OUTSIDE beyond the document; how many of each there are."""
        before, behind = positions - self.offsets[rows], self.offsets[rows + 1] - positions
        steps = np.r_[np.arange(span), -np.arange(1, span - KEY + 1)]
        at = positions[:, None] + steps
        out = self.raw[np.clip(at, 0, len(self.raw) - 1)]
        out[:, :span][np.arange(span) >= behind[:, None]] = OUTSIDE
        out[:, span:][np.arange(1, span - KEY + 1) > before[:, None]] = OUTSIDE
        return out, np.minimum(before, span - KEY), np.minimum(behind, span)


def as_strings(rows: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel()


def common_prefixes(rows: np.ndarray) -> np.ndarray:
    """The length of the prefix each row shares with the one before; 0 for the first."""
    differ = rows[1:] != rows[:-1]
    found = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return np.r_[0, found].astype(np.int64)[: len(rows)]


def front_coded(rows: np.ndarray) -> bytes:
    """Sorted rows as prefix lengths and, end to end and compressed, what follows the prefix."""
    shared = common_prefixes(rows)
    rest = rows[np.arange(rows.shape[1]) >= shared[:, None]].tobytes()
    return shared.astype("<u2").tobytes() + pa.compress(rest, codec="zstd", asbytes=True)


def decoded(blob: bytes, n: int, width: int) -> Iterator[tuple[bytes, int]]:
    """(row, prefix shared with the row before) of a front-coded run."""
    shared = np.frombuffer(blob, "<u2", n).tolist()
    rest = pa.decompress(blob[2 * n :], n * width - sum(shared), codec="zstd", asbytes=True)
    at, row = 0, b""
    for prefix in shared:
        end = at + width - prefix
        row = row[:prefix] + rest[at:end]
        at = end
        yield row, prefix


def merged(runs: list[Iterator[tuple[bytes, int]]]) -> Iterator[tuple[bytes, int, int]]:
    """(row, prefix shared with the last row given, number of the run) over all runs in order.

    A tree of losers: each node keeps the candidate that lost there and the prefix it shares with the winner that passed. When the next
    row of the winner's run climbs up, both it and a loser know their common prefix with the last row given. The one with
    the longer prefix is the smaller; only on equal prefixes are bytes compared, from there on.
    """
    size = 1
    while size < len(runs):
        size *= 2
    heads: list[bytes | None] = [None] * size
    prefix = [0] * size
    loser = [-1] * size

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's prefix becomes that with the winner."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        p, q = prefix[a], prefix[b]
        if p != q:
            return (a, b) if p > q else (b, a)
        x, y = x[p:], y[p:]
        if x == y:
            first, last, same = (a, b, len(x)) if a < b else (b, a, len(x))
        else:
            u, v = int.from_bytes(x, "big"), int.from_bytes(y, "big")
            same = len(x) - ((u ^ v).bit_length() + 7) // 8
            first, last = (a, b) if u < v else (b, a)
        prefix[last] = p + same
        return first, last

    for k, run in enumerate(runs):
        heads[k] = next(run, (None, 0))[0]
    top = list(range(size))
    node = size // 2
    while len(top) > 1:
        up = []
        for k in range(0, len(top), 2):
            winner, loser[node + k // 2] = play(top[k], top[k + 1])
            up.append(winner)
        top, node = up, node // 2
    winner = top[0]
    while heads[winner] is not None:
        yield heads[winner], prefix[winner], winner
        heads[winner], prefix[winner] = next(runs[winner], (None, 0))
        node = (winner + size) // 2
        while node:
            winner, loser[node] = play(winner, loser[node])
            node //= 2


def repeats(rows: np.ndarray, shared: np.ndarray, keys: np.ndarray, before: np.ndarray, behind: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index, first byte, end), relative to the anchor, of the windows that an earlier row has too.

    Rows are sorted suffixes with the prefixes they share; keys (two columns) say which is earlier.
    """
    width = rows.shape[1]
    rank = np.empty(len(rows), np.int64)
    rank[np.lexsort((keys[:, 1], keys[:, 0]))] = np.arange(len(rows))
    # Equal rows: the earliest stands for all, the others are repeats as a whole.
    of = np.cumsum(shared < width) - 1
    least = np.full(of[-1] + 1 if len(of) else 0, len(rows), np.int64)
    np.minimum.at(least, of, rank)
    first = rank == least[of]
    found = [whole_windows(np.flatnonzero(~first), before, behind, span)]
    # Distinct rows of one anchor: the prefix shared with the last distinct row is the least one since.
    one = np.flatnonzero(first)
    heads = np.flatnonzero(shared < width)
    shared = shared[heads]
    group = np.cumsum(shared < KEY)
    crowded = np.bincount(group)[group] > 1 if len(group) else np.zeros(0, bool)
    one, shared, rank = one[crowded], shared[crowded], rank[one[crowded]]
    if len(one):
        left = rows[one, span:]
        hashes = np.zeros(len(one), np.uint64)
        repeated = np.zeros((len(one), span - KEY + 1), bool)
        for d in range(span - KEY + 1):
            if d:
                hashes = bytesops.mixed(hashes + left[:, d - 1].astype(np.uint64) + np.uint64(1))
            fits = np.flatnonzero((before[one] >= d) & (behind[one] >= span - d))
            if len(fits) > 1:
                same = np.cumsum(shared < span - d)[fits].astype(np.uint64)
                window = bytesops.mixed(hashes[fits] ^ (same * np.uint64(0x9E3779B97F4A7C15)))
                order = np.lexsort((rank[fits], window))
                later = np.r_[False, window[order][1:] == window[order][:-1]]
                repeated[fits[order[later]], d] = True
        edge = np.diff(np.pad(repeated, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, low = np.nonzero(edge == 1)
        high = np.nonzero(edge == -1)[1] - 1
        found.append((one[row], -high, span - low))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def whole_windows(index: np.ndarray, before: np.ndarray, behind: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all windows around the anchors."""
    low, high = np.maximum(0, span - behind[index]), before[index]
    some = low <= high
    return index[some], -high[some], span - low[some]


def joined_windows(rows: np.ndarray, places: np.ndarray, span: int) -> np.ndarray:
    """(row, first byte, end) of windows in rising order, overlapping ones joined."""
    if not len(rows):
        return np.zeros((0, 3), np.int64)
    new = np.r_[True, (rows[1:] != rows[:-1]) | (places[1:] > places[:-1] + span)]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(rows) - 1]
    return np.stack([rows[new], places[new], places[last] + span], axis=1).astype(np.int64)


def packed_windows(once: np.ndarray, twice: np.ndarray, ids: np.ndarray, at: np.ndarray) -> bytes:
    """Windows as two hashes and, compressed, the id and place of each."""
    return once.tobytes() + twice.tobytes() + pa.compress(ids.tobytes() + at.tobytes(), codec="zstd", asbytes=True)


def unpacked_windows(blob: bytes, n: int) -> tuple[np.ndarray, ...]:
    places = pa.decompress(blob[16 * n :], 16 * n, codec="zstd", asbytes=True)
    return np.frombuffer(blob, np.uint64, n), np.frombuffer(blob, np.uint64, n, 8 * n), np.frombuffer(places, np.int64, n), np.frombuffer(places, np.int64, n, 8 * n)


def _blobs(of: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """(group, rows of that group in each column)."""
    order = np.argsort(of, kind="stable")
    found, first = np.unique(of[order], return_index=True)
    for k, g in enumerate(found.tolist()):
        rows = order[first[k] : first[k + 1] if k + 1 < len(first) else len(order)]
        yield (g, *[c[rows] for c in columns])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table({f.name: pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)}, schema=schema)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, as_text: bool = False) -> DataFrame:
    """The rows with _n_bytes, _n_removed, _n_spans and _kept, the bytes that stay, in place of the text.

    With `as_text`, _kept is a string without the parts of characters that a cut left over.

    A byte of a text goes if a string of `span` bytes that covers it also starts earlier, in a row of smaller id or at an
    earlier place of the same row. Strings are judged on the input and never cross rows. Null texts are empty and texts below
    `span` bytes stay whole. Null ids come first; rows that share an id come in the order of their texts. Other columns pass through.
    """
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    batches = max(1, -(-int(size) // BATCH))
    parts = max(shards(spark), batches)
    batch = F.pmod(F.xxhash64(F.col(id_col)), F.lit(batches)).alias("_batch")
    id_and_text = [F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")]
    keyed = docs.select(batch, *id_and_text)

    hash_rows = pa.schema([("shard", pa.int64()), ("batch", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())])

    def send_hashes(key, table):
        """The anchors of a batch, and how many different surroundings each has there."""
        found = [np.unique(np.stack([a[2], a[3]], axis=1), axis=0) for a in Corpus(table).anchors(span)]
        pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.uint64)
        hashes, counts = np.unique(pairs[:, 0], return_counts=True)
        sent = _blobs((hashes % np.uint64(parts)).astype(np.int64), hashes, counts.astype("<u4"))
        return _table([(shard, key[0].as_py(), h.tobytes(), pa.compress(n.tobytes(), codec="zstd", asbytes=True)) for shard, h, n in sent], hash_rows)

    def answer(key, table):
        """Which anchors several batches have; counts are 1 for the hot ones among them and else 0."""
        blobs = table["hashes"].to_pylist()
        hashes = np.concatenate([np.frombuffer(b, np.uint64) for b in blobs])
        counted = zip(table["counts"].to_pylist(), blobs, strict=True)
        counts = np.concatenate([np.frombuffer(pa.decompress(c, len(b) // 2, codec="zstd", asbytes=True), "<u4") for c, b in counted])
        of = np.repeat(np.array(table["batch"].to_pylist(), np.int64), [len(b) // 8 for b in blobs])
        order = np.argsort(hashes, kind="stable")
        hashes, of, counts = hashes[order], of[order], counts[order].astype(np.int64)
        same = hashes[1:] == hashes[:-1]
        shared = np.r_[False, same] | np.r_[same, False]
        group = np.cumsum(np.r_[True, ~same]) - 1
        hot = (np.bincount(group, counts)[group] > HOT).astype(np.uint8)
        return _table([(key[0].as_py(), b, h.tobytes(), w.tobytes()) for b, h, w in _blobs(of[shared], hashes[shared], hot[shared])], hash_rows)

    as_spark = "shard long, batch long, hashes binary, counts binary"
    asked = keyed.groupBy("_batch").applyInArrow(send_hashes, as_spark)
    shared_hashes = written(asked.groupBy("shard").applyInArrow(answer, as_spark), "shared")

    run_rows = pa.schema([("shard", pa.int64()), ("batch", pa.int64()), ("n", pa.int64()), ("rows", pa.binary()), ("anchors", pa.binary()), ("ranges", pa.binary()), ("windows", pa.binary())])
    run_type = "shard long, batch long, n long, rows binary, anchors binary, ranges binary, windows binary"

    def send_runs(key, table, known):
        """A sorted run per shard, the windows of hot anchors, and a row with the ranges of what is repeated within the batch."""
        if not table.num_rows:
            return _table([], run_rows)
        number = key[0].as_py()
        corpus = Corpus(table)
        shared = np.frombuffer(b"".join(known["hashes"].to_pylist()), np.uint64)
        hot = np.sort(shared[np.frombuffer(b"".join(known["counts"].to_pylist()), np.uint8) > 0])
        shared = np.sort(shared)
        anchors = list(corpus.anchors(span, hot))
        if not anchors:
            return _table([], run_rows)
        positions, rows, hashes, _, *windows = (np.concatenate(x) for x in zip(*anchors, strict=True))
        out = []
        if len(windows[0]):
            begin, of, once, twice = windows
            order = np.lexsort((begin, twice, once))
            new = np.r_[True, (once[order][1:] != once[order][:-1]) | (twice[order][1:] != twice[order][:-1])]
            again, first = np.sort(order[~new]), np.sort(order[new])
            out.append((number % parts, number, 0, None, None, joined_windows(of[again], (begin - corpus.offsets[of])[again], span).tobytes(), None))
            at = (of << POSITION) | (begin - corpus.offsets[of])
            sent = _blobs((once[first] % np.uint64(parts)).astype(np.int64), once[first], twice[first], corpus.ids[of[first]], at[first])
            out += [(s, number, len(w[0]), None, None, None, packed_windows(*w)) for s, *w in sent]
        ordered = np.sort(hashes)
        here = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        kept = np.isin(hashes, shared) | np.isin(hashes, here)
        positions, rows, hashes = positions[kept], rows[kept], hashes[kept]
        texts, firsts, ranges = [], [], []

        def distinct(index: np.ndarray, text: np.ndarray, before: np.ndarray, behind: np.ndarray) -> tuple:
            """The first of each distinct suffix, sorted; the others' ranges are noted."""
            order = np.argsort(as_strings(text), kind="stable")
            new = common_prefixes(text[order]) < text.shape[1]
            again = order[~new]
            at, low, high = whole_windows(again, before, behind, span)
            place = positions[index[at]]
            ranges.append(np.stack([rows[index[at]], place + low - corpus.offsets[rows[index[at]]], place + high - corpus.offsets[rows[index[at]]]], axis=1))
            return order[new]

        step = 1 << 15
        for low in range(0, len(positions), step):
            index = np.arange(low, min(low + step, len(positions)))
            text, before, behind = corpus.suffixes(positions[index], rows[index], span)
            some = np.sort(distinct(index, text, before, behind))
            texts.append(text[some])
            firsts.append(np.stack([index[some], before[some], behind[some]]))
        if texts:
            text = np.concatenate(texts)
            index, before, behind = np.concatenate(firsts, axis=1)
            some = distinct(index, text, before, behind)
            text, index, before, behind = text[some], index[some], before[some], behind[some]
            at = (rows[index] << POSITION) | (positions[index] - corpus.offsets[rows[index]])
            meta = np.stack([corpus.ids[rows[index]], at, before, behind], axis=1)
            shard = (hashes[index] % np.uint64(parts)).astype(np.int64)
            out += [(s, number, len(t), front_coded(t), m.tobytes(), None, None) for s, t, m in _blobs(shard, text, meta)]
            out.append((number % parts, number, 0, None, None, np.concatenate(ranges).astype(np.int64).tobytes(), None))
        return _table(out, run_rows)

    runs = keyed.groupBy("_batch").cogroup(shared_hashes.groupBy("batch")).applyInArrow(send_runs, run_type)

    range_rows = pa.schema([("batch", pa.int64()), ("ranges", pa.binary())])

    def merge(table):
        width = 2 * span - KEY
        sent = sorted(table.to_pylist(), key=lambda r: r["batch"])
        near = [(r["batch"], r["ranges"]) for r in sent if r["ranges"] is not None]
        hot = [r for r in sent if r["windows"] is not None]
        if hot:
            once, twice, ids, at = (np.concatenate(x) for x in zip(*[unpacked_windows(r["windows"], r["n"]) for r in hot], strict=True))
            of = np.repeat(np.array([r["batch"] for r in hot], np.int64), [r["n"] for r in hot])
            order = np.lexsort((at, ids, twice, once))
            later = np.r_[False, (once[order][1:] == once[order][:-1]) & (twice[order][1:] == twice[order][:-1])]
            again = order[later]
            again = again[np.lexsort((at[again], of[again]))]
            row, place = at >> POSITION, at & ((1 << POSITION) - 1)
            near += [(b, joined_windows(r, p, span).tobytes()) for b, r, p in _blobs(of[again], row[again], place[again])]
        sent = [r for r in sent if r["rows"] is not None]
        if not sent:
            return _table(near, range_rows)
        order = list(merged([decoded(r["rows"], r["n"], width) for r in sent]))
        rows = np.frombuffer(b"".join([r for r, _, _ in order]), np.uint8).reshape(-1, width)
        shared, run = np.array([p for _, p, _ in order]), np.array([k for _, _, k in order])
        # Rows of a run come in its order: the k-th row of run r has that run's k-th anchor.
        meta = np.concatenate([np.frombuffer(r["anchors"], np.int64).reshape(-1, 4) for r in sent])
        by_run = np.argsort(run, kind="stable")
        anchors = np.empty_like(meta)
        anchors[by_run] = meta
        batch_of = np.array([r["batch"] for r in sent])[run]
        index, low, high = repeats(rows, shared, anchors[:, :2], anchors[:, 2], anchors[:, 3], span)
        row, place = anchors[index, 1] >> POSITION, anchors[index, 1] & ((1 << POSITION) - 1)
        found = np.stack([row, place + low, place + high], axis=1)
        return _table([*near, *[(b, r.tobytes()) for b, r in _blobs(batch_of[index], found)]], range_rows)

    ranges = written(runs.groupBy("shard").applyInArrow(merge, "batch long, ranges binary"), "ranges")

    extra = [c for c in docs.columns]
    passed = docs.select(batch, *id_and_text, *[F.col(c).alias(f"_c{k}") for k, c in enumerate(extra) if c != text_col])
    passed_type = [f"_c{k} {docs.schema[c].dataType.simpleString()}" for k, c in enumerate(extra) if c != text_col]
    out_type = ", ".join([*passed_type, "_n_bytes long", "_n_removed long", "_n_spans long", f"_kept {'string' if as_text else 'binary'}"])

    def cut(key, table, found):
        corpus = Corpus(table)
        marks = np.zeros(len(corpus.raw) + 1, np.int32)
        spans = np.concatenate([np.frombuffer(b, np.int64).reshape(-1, 3) for b in [*found["ranges"].to_pylist(), b""]])
        begin = corpus.offsets[spans[:, 0]]
        np.add.at(marks, begin + spans[:, 1], 1)
        np.add.at(marks, begin + spans[:, 2], -1)
        gone = np.cumsum(marks[:-1]) > 0
        n = corpus.table.num_rows
        size = np.diff(corpus.offsets)
        removed = np.diff(np.r_[0, np.cumsum(gone)][corpus.offsets])
        stays = np.r_[0, np.cumsum(size - removed)].astype(np.int64)
        kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(stays.tobytes()), pa.py_buffer(corpus.raw[~gone].tobytes())])
        runs_of = np.bincount(bytesops.spans(gone, corpus.offsets)[2], minlength=n)
        columns = {name: corpus.table[name] for name in table.column_names if name.startswith("_c")}
        counts = {"_n_bytes": pa.array(size), "_n_removed": pa.array(removed), "_n_spans": pa.array(runs_of)}
        if as_text:
            kept = pa.array([x.decode("utf-8", "ignore") for x in kept.to_pylist()], pa.string())
        return pa.table(columns | counts | {"_kept": kept if as_text else kept.cast(pa.binary())})

    done = passed.groupBy("_batch").cogroup(ranges.groupBy("batch")).applyInArrow(cut, out_type)
    names = [F.col(f"_c{k}").alias(c) for k, c in enumerate(extra) if c != text_col]
    return done.select(*names, "_n_bytes", "_n_removed", "_n_spans", "_kept")

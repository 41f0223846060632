"""The corpus operators against brute force on small fixtures with nulls, empties, ties and repeats."""

from __future__ import annotations

import base64
import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stationflow.llm import ann, bpe, embed_dedup, mixing, packing, quality, queries, simhash, substrings, toxicity, warc
from stationflow.llm.graph import components
from stationflow.session import work_dir

DOCS = "doc_id long, text string, source string, id long, fp string"


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(["an", "ti", "qué", "Or", "st", "en"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def texts() -> list[str | None]:
    rng = random.Random(5)
    base = [sentence(rng, rng.randint(1, 80)) for _ in range(30)]
    shared = sentence(rng, 30)
    many = [None, "", "   \n\t", "a", "a b c", base[0], base[0], base[1] + " x", base[1] + " y", "spam " * 400, "z" * 700, "z" * 350]
    many += [f"{a} {shared} {b}" for a, b in zip(base[2:8], base[8:14], strict=True)] + base[14:] + ["n\x00ul\x1cs a<|endoftext|>b", "É́ 'S don't  x y"]
    return many


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(k, t, [None, "a", "b", "c"][k % 4], 7, "clash") for k, t in enumerate(texts)]
    rows += [(None, texts[5], "a", 1, None), (3, "again", "b", 2, None), (3, "again", "b", 2, None)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def groups(links, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    links = [(k, k + 1) for k in range(100, 140)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(200, k) for k in range(201, 230)]
    want = groups(links, {n for link in links for n in link})
    frame = spark.createDataFrame([*links, (None, 4), (9, 9)], "u long, v long")
    got = {r.node: r.component for r in components(frame).collect()}
    assert got == {n: c for n, c in want.items() if n in got} and {n for n in want if want[n] != n} <= set(got)


def plain_print(text: str | None, width: int) -> int:
    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    if not words:
        return 0
    runs = [b" ".join(words[k : k + width]) for k in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs, nothing):
    rows = simhash.near_components(simhash.fingerprints(docs, 4), 4).collect()
    known = [(r.doc_id, r.text) for r in docs.collect()]
    prints = [(i, plain_print(t, 4)) for i, t in known]
    assert sorted((str(r.id), r.fp & (2**64 - 1)) for r in rows) == sorted((str(i), p) for i, p in prints)
    linked = [(a, b) for a, p in prints for b, q in prints if a is not None and b is not None and bin(p ^ q).count("1") <= 4]
    want = groups(linked, {i for i, _ in prints if i is not None})
    assert all(r.component == (want[r.id] if r.id is not None else None) for r in rows)
    assert simhash.near_components(simhash.fingerprints(nothing)).count() == 0


def test_covering_masks_meet():
    tables = simhash.masks(4)
    rng = random.Random(3)
    for _ in range(2000):
        flips = np.uint64(sum(1 << b for b in rng.sample(range(64), 4)))
        assert ((flips & tables) == 0).any()


def plain_cut(rows, span):
    seen, out = set(), {}
    for key, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - span + 1):
            piece = raw[p : p + span]
            gone[p : p + span] |= piece in seen
            seen.add(piece)
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.setdefault(key, []).append((len(raw), int(gone.sum()), runs, bytes(np.frombuffer(raw, np.uint8)[~gone])))
    return out


@pytest.mark.parametrize("batch", [1 << 9, 1 << 23])
def test_substrings(docs, nothing, monkeypatch, batch):
    monkeypatch.setattr(substrings, "BATCH", batch)
    known = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    got = defaultdict(list)
    result = substrings.deduplicated(docs)
    for r in result.collect():
        got[r.doc_id].append((r._n_bytes, r._n_removed, r._n_spans, bytes(r._kept)))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in plain_cut(known, 100).items()}
    assert result.columns[:4] == ["doc_id", "source", "id", "fp"]
    assert substrings.deduplicated(nothing).count() == 0


def test_loser_tree_gives_order_and_prefixes():
    rng = random.Random(2)
    runs = [sorted(bytes(rng.choice(b"ab") for _ in range(12)) for _ in range(n)) for n in (0, 1, 7, 30, 30)]

    def coded(rows):
        blob = substrings.front_coded(np.frombuffer(b"".join(rows), np.uint8).reshape(-1, 12))
        return substrings.decoded(blob, len(rows), 12)

    got = list(substrings.merged([coded(r) if r else iter(()) for r in runs]))
    assert [r for r, _, _ in got] == sorted(x for r in runs for x in r)
    for (a, _, _), (b, shared, _) in zip(got, got[1:], strict=False):
        assert shared == next((k for k in range(12) if a[k] != b[k]), 12)


def test_bpe(docs, nothing):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    plain = Tokenizer.from_file(path)
    got = sorted((str(r.doc_id), r.ids, r.decoded) for r in bpe.encoded(docs, path, decoded_col="decoded").collect())
    want = []
    for r in docs.collect():
        ids = plain.encode(r.text or "", add_special_tokens=False).ids
        want.append((str(r.doc_id), ids, plain.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want)
    assert bpe.decoded(bpe.encoded(docs, path), path).count() == docs.count()
    assert bpe.encoded(nothing, path).count() == 0


def test_bpe_joint_is_repaired():
    encoder = bpe.Encoder.of(queries.tokenizer_path())
    chunks = [b"one two three", b" four five", b" six"]
    whole = encoder.plain([b"".join(chunks)])[0]
    assert encoder.encode([chunks]) == [whole]
    ids_of = {c: b"wrong" for c in chunks}
    assert encoder._joined(chunks, ids_of, set(zip(chunks, chunks[1:], strict=False))) == whole


def test_warc(spark):
    page = "page_id long, url string, html string"
    rows = [(1, "http://a/\r\nx", "same"), (2, None, "same"), (5, "u", "same"), (3, "u", None), (4, "u", ""), (None, "u", "same"), (9, "u", "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\né")]
    for packed in (None, "gzip"):
        path = work_dir(spark, "warc")
        warc.write_archives(warc.records(spark.createDataFrame(rows, page).repartition(2)), path, packed)
        back = warc.read_archives(spark, path, "record_type", "record_id", "refers_to", "payload_digest", "payload_bytes", "payload", "headers")
        got = {r.record_id: r for r in back.collect()}
        assert len(got) == len(rows)
        for number, url, html in rows:
            r, raw = got[f"<urn:page:{'null' if number is None else number}>"], (html or "").encode()
            assert r.payload_bytes == len(raw) and r.payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
            first = {"same": 5, "": 4}.get(html or "", number)
            assert r.record_type == ("response" if number == first else "revisit")
            assert r.refers_to == (None if number == first else f"<urn:page:{first}>")
            assert (r.payload is None) == (number != first) and (r.headers.get("WARC-Target-URI") is None) == (url is None)
        only = warc.read_archives(spark, path, "record_type", "record_id").where("record_type = 'revisit'")
        assert only.count() == 4
    empty = work_dir(spark, "warc")
    warc.write_archives(warc.records(spark.createDataFrame([], page)), empty)
    assert warc.read_archives(spark, empty).count() == 0


def test_warc_reader_passes_over_rejected_payloads(spark, tmp_path):
    row = {"record_id": "<urn:page:1>", "target_uri": "u", "refers_to": None, "payload_bytes": 3, "payload_digest": "WRONG"}
    bad = warc.record_bytes(row | {"record_type": "response", "payload": b"abc"})
    good = warc.record_bytes(row | {"record_type": "revisit", "payload": None, "refers_to": "<urn:page:2>"})
    (tmp_path / "a.warc").write_bytes(bad + good)
    columns = ["record_type", "payload", "payload_bytes"]
    revisits = warc.read_archives(spark, str(tmp_path), *columns).where("record_type = 'revisit'")
    assert [r.payload_bytes for r in revisits.collect()] == [3]
    with pytest.raises(Exception, match="differs from its digest"):
        warc.read_archives(spark, str(tmp_path), *columns).collect()


def test_two_writes_to_one_folder_are_both_read(spark):
    path = work_dir(spark, "warc")
    for first in (0, 10):
        pages = spark.createDataFrame([(first + k, "u", f"text {first + k}") for k in range(4)], "page_id long, url string, html string")
        warc.write_archives(warc.records(pages), path)
    assert sorted(r.payload.decode() for r in warc.read_archives(spark, path, "payload").collect()) == sorted(f"text {k}" for k in (0, 1, 2, 3, 10, 11, 12, 13))


def test_payload_bytes_do_not_depend_on_the_columns(spark, tmp_path):
    """Foreign records: another HTTP length than the block's, a long HTTP header, none at all, and no HTTP."""
    blocks = [b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\n0123456789", b"HTTP/1.1 200 OK\r\nX: " + b"y" * 9000 + b"\r\n\r\n0123456789", b"HTTP/1.1 200 OK", b""]
    records = [b"WARC/1.1\r\nWARC-Type: response\r\nContent-Type: application/http\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(b), b) for b in blocks]
    records.append(b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Type: text/plain\r\nContent-Length: 7\r\n\r\nab\r\n\r\nc\r\n\r\n")
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    want = [0, 0, 7, 10, 10]
    assert sorted(r.payload_bytes for r in warc.read_archives(spark, str(tmp_path), "payload_bytes", "payload").collect()) == want
    assert sorted(r.payload_bytes for r in warc.read_archives(spark, str(tmp_path), "payload_bytes").collect()) == want


def test_a_tokenizer_that_keeps_white_space_is_refused():
    with pytest.raises(ValueError, match="keeps white space"):
        bpe.Encoder(queries.tokenizer_path("byte_bpe_50k.json"))


def vectors(spark, seed=4, n=240, dims=16):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dims))
    base[100:160] = base[100] + 0.12 * rng.normal(size=(60, dims))
    base[160:200] = base[160]
    base[200:205] *= 1e-20
    rows = [(k, [float(np.float32(x)) for x in v], k % 3) for k, v in enumerate(base)]
    nan = float("nan")
    odd = [(900, None, 0), (901, [0.0] * dims, 0), (902, [nan] + [1.0] * (dims - 1), 0), (903, [None] + [1.0] * (dims - 1), 0), (904, [], 0), (905, [1.0, 2.0], 0), (None, rows[0][1], 0)]
    return rows, odd, spark.createDataFrame([*rows, *odd], "vec_id long, embedding array<float>, label int").repartition(3)


@pytest.mark.parametrize("block", [32, 2048])
def test_embedding_dedup(spark, monkeypatch, block):
    monkeypatch.setattr(embed_dedup, "BLOCK", block)
    rows, odd, frame = vectors(spark)
    x = embed_dedup.unit(np.array([np.float32(v) for _, v, _ in rows], np.float64))
    near = x @ x.T >= 0.9
    want = groups(list(zip(*np.nonzero(near), strict=True)), range(len(rows)))
    got = {r.id: (r.n_links, r.component) for r in embed_dedup.near_duplicates(frame).collect()}
    assert all(got[k] == (near[k].sum() - 1, want[k]) for k in range(len(rows)))
    assert all(got[k] == (0, k) for k, _, _ in odd)
    assert embed_dedup.near_duplicates(frame.limit(0)).count() == 0


def test_ann_recall(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 64)
    monkeypatch.setattr(ann, "LEAF_SAMPLE", 24)
    rows, _, frame = vectors(spark, n=600)
    index = ann.Index(frame)
    assert index.tree.leaves > 4
    got = defaultdict(list)
    for r in index.search(F.col("id") % 20 == 0, 20).orderBy("query", "rank").collect():
        got[r.query].append((r.id, r.score))
    x = np.array([np.float32(v) for _, v, _ in rows], np.float64)
    hits = 0
    for q in range(0, 600, 20):
        score = (x * x[q]).sum(axis=1)
        best = [k for k in np.lexsort((np.arange(600), -score)) if k != q][:20]
        hits += len(set(best) & {i for i, _ in got[q]})
        assert len(got[q]) == 20 and got[q] == sorted(got[q], key=lambda r: (-r[1], r[0])) and all(s == score[i] for i, s in got[q])
    assert hits >= 0.9 * 20 * 30
    assert ann.Index(frame.limit(0)).search(F.col("id") % 20 == 0, 20).count() == 0
    few = ann.Index(frame.where("vec_id < 5")).search(F.col("id") % 20 == 0, 20).collect()
    assert sorted(r.id for r in few) == [1, 2, 3, 4]


def test_mixing(docs, nothing):
    rows = mixing.mixed(docs, mixing.word_count("text")).collect()
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in docs.collect()]
    assert sorted(r.size for r in rows) == sorted(sizes)
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
        assert 0 <= r.copies <= 2
    assert sum(r[0].target for r in by.values()) == pytest.approx(1.5 * sum(sizes))
    for source in by.values():
        taken = sum(r.copies * r.size for r in source)
        assert source[0].target <= 2 * source[0].source_size and abs(taken - source[0].target) <= max(r.size for r in source)
    again = mixing.mixed(docs.repartition(2), mixing.word_count("text")).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert mixing.mixed(nothing, mixing.word_count("text")).count() == 0


def labelled(spark, toxic):
    rng = random.Random(8)
    rows = []
    for k in range(400):
        bad = k % 3 == 0
        text = sentence(rng, 60)
        if toxic:
            text += " wretched vermin scoundrel" * bad
        else:
            text = text.upper().replace(" ", "!! ") if bad else text
        rows.append((k, text, int(bad)))
    rows += [(900, None, None), (901, "", None), (None, "x", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, label int")
    return frame, frame.where("label is not null and doc_id % 4 <> 2").select("doc_id", "label")


def test_toxicity(spark):
    frame, sample = labelled(spark, True)
    rows = toxicity.scored(frame.drop("label"), sample).collect()
    assert len(rows) == 403 and all(0 <= r.score <= 1 for r in rows)
    right = [(r.score >= 0.3) == (r.id % 3 == 0) for r in rows if r.id is not None and r.id < 400 and r.id % 4 == 2]
    assert np.mean(right) > 0.97
    one = toxicity.scored(frame.drop("label"), sample.where("label = 0"))
    assert one.select(F.max("score")).first()[0] < 0.1
    assert toxicity.scored(frame.limit(0).drop("label"), sample).count() == 0


def test_expressions_equal_brute_force(spark):
    rng = random.Random(3)
    rows = [(k, " ".join("".join(rng.choices("abc", k=rng.randint(1, 9))) for _ in range(30)), k % 3) for k in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(3)
    sample = frame.where("label < 2").select("doc_id", "label")
    found = toxicity.expressions(frame.drop("label"), sample).collect()
    want = []
    for order in toxicity.ORDERS:
        ends, counts = {}, {}
        for _, text, label in rows:
            for word in set(text.split()):
                for end in range(1, len(word) + 1):
                    g = word[max(0, end - order) : end]
                    ends.setdefault(g, set()).add(word[max(0, end - order - 1) : end])
                    both = counts.setdefault(g, [0, 0])
                    if label < 2:
                        both[label] += 1
        want += [(order, len(ends[g]), *counts[g]) for g in ends]
    assert sorted((r.n, r.ends, r.ordinary, r.toxic) for r in found) == sorted(want)


def test_quality(spark):
    frame, sample = labelled(spark, False)
    frame, sample = frame.withColumn("words", F.lit("clash")), sample.withColumn("label", 1 - F.col("label"))
    model = quality.learnt(frame.drop("label"), sample)
    assert 0 < len(model.weights) < 200
    rows = quality.scored(frame.drop("label"), model).collect()
    assert len(rows) == 403 and all(0 <= r.score <= 1 and r.words == "clash" for r in rows)
    right = [(r.score >= 0.3) == (r.doc_id % 3 != 0) for r in rows if r.doc_id is not None and r.doc_id < 400 and r.doc_id % 4 == 2]
    assert np.mean(right) > 0.95
    assert quality.learnt(frame.drop("label"), sample.where("label = 1")).weights == []


def test_best_fit_matches_a_plain_search():
    rng = random.Random(6)
    lengths = [rng.randint(1, 50) for _ in range(300)]
    room: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in room if r >= n]
        if fits:
            room.remove(min(fits))
        room.append((min(fits) if fits else 50) - n)
    placed = packing.best_fit(lengths, 50)
    used = defaultdict(list)
    for (row, at), n in zip(placed, lengths, strict=True):
        used[row].append((at, at + n))
    assert len(used) == len(room) and sorted(50 - max(b for _, b in s) for s in used.values()) == sorted(room)
    for s in used.values():
        assert sorted(s)[0][0] == 0 and all(a[1] == b[0] for a, b in zip(sorted(s), sorted(s)[1:], strict=False))


def test_packing(docs, nothing, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 500)
    encode = lambda texts: [list(t.encode()) for t in texts]
    blocks = packing.packed(docs, encode, length=64)
    got = defaultdict(list)
    for r in packing.segments(blocks).collect():
        got[r.doc_id].append((r.piece, np.frombuffer(r.ids, np.uint16).astype(np.uint8).tobytes()))
    want = defaultdict(list)
    for r in docs.collect():
        raw = (r.text or "").encode()
        want[r.doc_id] += [(k // 64, raw[k : k + 64]) for k in range(0, len(raw), 64)]
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items() if v}
    assert packing.packed(nothing, encode).count() == 0

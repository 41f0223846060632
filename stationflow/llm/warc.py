"""WARC archives: a Spark data source that reads and writes them, and their writing with revisit records."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from stationflow.llm.common import written

VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "content_type": "Content-Type",
}
READ_SCHEMA = ", ".join(f"{name} string" for name in HEADERS) + ", payload_bytes long, headers map<string,string>, payload binary"
WRITE_SCHEMA = "record_type string, record_id string, target_uri string, refers_to string, payload binary, payload_bytes long, payload_digest string"
# A reading task gets files of about so many bytes; a writing task begins another file beyond that.
PART_BYTES = 128 << 20
BATCH_BYTES = 8 << 20
# Each commit names its files in a manifest of its own; readers take the union.
MANIFEST = "_manifest-{}.json"


def file_system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if re.match(r"[a-zA-Z][\w+.-]*:", path):
        return pyarrow.fs.FileSystem.from_uri(path if not path.startswith("file:") else "file://" + re.sub(r"^file:/*", "/", path))
    return pyarrow.fs.LocalFileSystem(), path


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str) -> str:
    """A header value on one line."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record_bytes(row: dict) -> bytes:
    """One record: the block is an HTTP message, of a revisit its head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    block = head + (row["payload"] or b"") if row["record_type"] == "response" else head
    lines = [VERSION, f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {row['record_id']}", f"WARC-Date: {DATE}"]
    if row["target_uri"] is not None:
        lines.append(f"WARC-Target-URI: {_clean(row['target_uri'])}")
    if row["record_type"] == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {row['refers_to']}"]
    lines += [f"WARC-Payload-Digest: sha1:{row['payload_digest']}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def head_of(stream: io.BufferedIOBase) -> dict[str, str] | None:
    """The headers of the next record; None at the end."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:40]!r}")
    headers, name = {}, None
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[:1] in " \t" and name:
            headers[name] += " " + text.strip()
        else:
            name, _, value = text.partition(":")
            name = name.strip()
            headers[name] = value.strip()
    return headers


def split_block(headers: dict[str, str], block: bytes) -> tuple[dict[str, str], bytes]:
    """HTTP headers, by lower-case name, and payload of a record's block."""
    if not headers.get("Content-Type", "").startswith("application/http"):
        return {}, block
    head, _, payload = block.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, payload


def measured_block(headers: dict[str, str], stream: io.BufferedIOBase, length: int) -> tuple[dict[str, str], int]:
    """HTTP headers and bytes of payload of a block of `length` bytes, of which no more is decoded than the headers; passes over all of it."""
    if not headers.get("Content-Type", "").startswith("application/http"):
        stream.seek(length, io.SEEK_CUR)
        return {}, length
    head, end = bytearray(), -1
    while end < 0 and len(head) < length and (more := stream.read(min(4096, length - len(head)))):
        start = max(0, len(head) - 3)
        head += more
        end = head.find(b"\r\n\r\n", start)
    stream.seek(length - len(head), io.SEEK_CUR)
    http, _ = split_block(headers, bytes(head))
    return http, length - end - 4 if end >= 0 else 0


def payload_bytes(record_type: str | None, http: dict[str, str], found: int) -> int:
    """Bytes of a record's payload as its block has them; a revisit has none and tells those of the page by its HTTP header."""
    told = http.get("content-length", "")
    return int(told) if record_type == "revisit" and not found and told.isdigit() else found


class Files(InputPartition):
    def __init__(self, paths: list[str]) -> None:
        super().__init__(paths)


class WarcReader(DataSourceReader):
    """Reads headers first; a record that a predicate rejects, or whose payload no column asks for, is passed over unread."""

    def __init__(self, schema: StructType, options: dict[str, str]) -> None:
        self.names, self.path = schema.fieldNames(), options["path"]
        self.types = {f.name: f.dataType.simpleString() for f in schema.fields}
        self.wanted: dict[str, set[str]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            values = (f.value,) if isinstance(f, EqualTo) else f.value if isinstance(f, In) else None
            if values is not None and len(f.attribute) == 1 and f.attribute[0] in HEADERS:
                allowed = {str(v) for v in values if v is not None}
                known = self.wanted.get(f.attribute[0])
                self.wanted[f.attribute[0]] = allowed if known is None else known & allowed
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        system, path = file_system(self.path)
        info = system.get_file_info(path)
        if info.is_file:
            return [Files([path])]
        listed = system.get_file_info(pyarrow.fs.FileSelector(path, recursive=True))
        manifests = [x.path for x in listed if x.is_file and re.fullmatch(MANIFEST.format(r"\w+"), x.base_name)]
        found = []
        for name in manifests:
            with system.open_input_stream(name) as f:
                found += [(x["bytes"], f"{path}/{x['file']}") for x in json.loads(f.read())]
        if not manifests:
            found = [(x.size, x.path) for x in listed if x.is_file and re.search(r"\.warc(\.gz)?$", x.path)]
        packs: list[list[str]] = []
        room = 0
        for size, name in sorted(found, key=lambda x: x[1]):
            if not packs or size > room:
                packs.append([])
                room = PART_BYTES
            packs[-1].append(name)
            room -= size
        return [Files(p) for p in packs] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary(), "map<string,string>": pa.map_(pa.string(), pa.string())}
        schema = pa.schema([(n, kinds[self.types[n]]) for n in self.names])
        rows: list[dict] = []
        size = 0
        for row in self._rows(partition.value):
            rows.append(row)
            size += len(row.get("payload") or b"") + 500
            if size >= BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    def _rows(self, paths: list[str]) -> Iterator[dict]:
        system, _ = file_system(self.path)
        for path in paths:
            with system.open_input_file(path) as raw:
                packed = path.endswith(".gz")
                stream = gzip.GzipFile(fileobj=raw) if packed else io.BufferedReader(raw, 1 << 20)
                while (headers := head_of(stream)) is not None:
                    length = int(headers.get("Content-Length", 0))
                    row = {name: headers.get(h) for name, h in HEADERS.items()}
                    if row["payload_digest"]:
                        row["payload_digest"] = row["payload_digest"].removeprefix("sha1:")
                    if any(row[name] not in allowed for name, allowed in self.wanted.items()):
                        stream.seek(length, io.SEEK_CUR)
                        continue
                    if "payload" in self.names:
                        http, payload = split_block(headers, stream.read(length))
                        if row["record_type"] == "response" and row["payload_digest"] not in (None, digest_of(payload)):
                            raise ValueError(f"payload of {row['record_id']} in {path} differs from its digest")
                        row["payload"] = payload if row["record_type"] != "revisit" else None
                        row["payload_bytes"] = payload_bytes(row["record_type"], http, len(payload))
                    elif "payload_bytes" in self.names:
                        row["payload_bytes"] = payload_bytes(row["record_type"], *measured_block(headers, stream, length))
                    else:
                        stream.seek(length, io.SEEK_CUR)
                    if "headers" in self.names:
                        row["headers"] = list(headers.items())
                    yield {n: row.get(n) for n in self.names}


class Written(WriterCommitMessage):
    def __init__(self, files: list[dict]) -> None:
        self.files = files


class WarcWriter(DataSourceArrowWriter):
    """Each task attempt writes files under names of its own; the driver's commit names those that count."""

    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.packed = options["path"], options.get("compression") == "gzip"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, path = file_system(self.path)
        system.create_dir(path, recursive=True)
        files: list[dict] = []
        out, size = None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or size >= PART_BYTES:
                    if out is not None:
                        out.close()
                        files[-1]["bytes"] = size
                    files.append({"file": f"part-{uuid.uuid4().hex}.warc" + ".gz" * self.packed, "bytes": 0})
                    out, size = system.open_output_stream(f"{path}/{files[-1]['file']}", compression=None), 0
                data = record_bytes(row)
                data = gzip.compress(data, 6, mtime=0) if self.packed else data
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
            files[-1]["bytes"] = size
        return Written(files)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, path = file_system(self.path)
        system.create_dir(path, recursive=True)
        with system.open_output_stream(f"{path}/{MANIFEST.format(uuid.uuid4().hex)}") as f:
            f.write(json.dumps([x for m in messages if m is not None for x in m.files]).encode())


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read_archives(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Records of an archive or a folder of them; only the named columns of READ_SCHEMA, all if none is named.

    A predicate pushed down stays with the DataFrame it was pushed to: read anew for another predicate.
    """
    register(spark)
    kinds = dict(x.split(" ") for x in READ_SCHEMA.split(", "))
    schema = ", ".join(f"{c} {kinds[c]}" for c in columns or kinds)
    return spark.read.format("warc").schema(schema).option("path", path).load()


def record_id(page_id) -> F.Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def page_of(record: str) -> F.Column:
    """The page a record id names; null where it names none."""
    return F.try_to_number(F.regexp_extract(record, r"^<urn:page:(-?\d+)>$", 1), F.lit("S" + "9" * 19)).cast("long")


def records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """WARC records of (page_id, url, html) rows, in WRITE_SCHEMA.

    Of pages with equal payloads of at least `least_bytes`, the one with the largest page_id is a response and the others
    revisit it; smaller payloads are all responses. A null html is an empty payload and a null url leaves its header out. Rows
    with a null page_id come below all others. Rows equal in page_id and payload are records of the same kind.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"hash": F.sha1("payload"), "payload_bytes": F.length("payload").cast("long")})
    large = rows.where(F.col("payload_bytes") >= least_bytes).groupBy(F.col("hash").alias("of"))
    # Only payloads that occur more than once, as a table: a hot payload's rows can be split in the join.
    first = written(large.agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("of", "first"), "first")
    joined = rows.join(first, (F.col("hash") == F.col("of")) & (F.col("payload_bytes") >= least_bytes), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        record_id(F.col("page_id")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.when(revisit, record_id(F.col("first"))).alias("refers_to"),
        F.when(~revisit, F.col("payload")).alias("payload"),
        "payload_bytes",
        base32("hash").alias("payload_digest"),
    )


def base32(hex_col: str) -> F.Column:
    """Upper-case base 32 of a digest of 20 bytes given in hexadecimal: 5 bytes make 8 digits."""
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    digits = []
    for group in range(4):
        number = F.conv(F.substring(hex_col, 10 * group + 1, 10), 16, 10).cast("long")
        for k in range(8):
            place = F.shiftright(number, 35 - 5 * k).bitwiseAND(F.lit(31)).cast("int") + 1
            digits.append(F.substring(alphabet, place, F.lit(1)))
    return F.concat(*digits)


def write_archives(rows: DataFrame, path: str, compression: str | None = None) -> None:
    """Write records as archives below `path`, in files of about PART_BYTES."""
    register(rows.sparkSession)
    rows.write.format("warc").mode("append").option("path", path).option("compression", compression or "none").save()

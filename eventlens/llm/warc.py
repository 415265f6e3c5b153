"""WARC archives as a PySpark data source, and revisit records for repeated payloads.

``spark.read.format("warc").load(folder)`` plans one partition per archive (small ones are
read together), takes filters on the record type and on header fields into the reader,
parses a record's headers first, and neither inflates nor decodes the payload of a record
that a filter drops or that the ``payload`` option doesn't ask for. Archives written here
are gzip members, one per record, with the standard ``sl`` extra field (skip lengths), so an
unwanted record is passed by a seek; other archives, plain or gzip, are read too.

``df.write.format("warc").save(folder)`` writes one archive per task and ``file_bytes``. A
manifest names the archives of tasks that committed, so what a lost executor left behind is
never read; a folder without manifest is read whole.

Folders are reached through ``pyarrow.fs`` (local, HDFS, S3, GCS), never by local paths alone.

Defined results
    null payload: empty; null url: no target header; control characters in a header value
    are percent-encoded
    equal payloads: the record with the largest id is the response, rows that share that id
    and payload are all responses, the others revisit it; a null id is below all others
    payloads below ``least`` bytes: all responses
    no rows: a folder with an empty manifest, read as no rows
    other columns: ignored by the writer
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import datasource as D

from eventlens.session import scratch_path
from eventlens.llm.common import table, whole

SCHEMA = ("record_type string, record_id string, target_uri string, date string, payload_digest string, "
          "refers_to string, content_type string, payload_length long, payload binary")
# Header names of WARC 1.1 for the columns.
HEADERS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI",
           "date": "WARC-Date", "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
COLUMNS = (*HEADERS, "content_type", "payload_length", "payload")
ARROW = pa.schema([(c, pa.int64() if c == "payload_length" else pa.binary() if c == "payload" else pa.string())
                   for c in COLUMNS])
BLOCK = 1 << 20


def filesystem(uri: str):
    """(file system, path) of a folder given as URI or absolute path."""
    from pyarrow import fs
    if uri.startswith("file:"):
        uri = "file://" + re.sub("^file:/*", "/", uri)
    return fs.FileSystem.from_uri(uri)


# --- records to bytes -------------------------------------------------------------------

def clean(value: str) -> str:
    return re.sub(r"[\x00-\x1f\x7f]", lambda c: f"%{ord(c[0]):02X}", value)


def record_bytes(row: dict) -> bytes:
    """One uncompressed record; the block is an HTTP response, without body for a revisit."""
    payload = row["payload"] or b""
    length = row["payload_length"] if row["payload_length"] is not None else len(payload)
    body = b"" if row["record_type"] == "revisit" else payload
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: {clean(row['content_type'] or 'text/html; charset=utf-8')}\r\n"
             f"Content-Length: {length}\r\n\r\n").encode() + body
    head = ["WARC/1.1"]
    for column, name in HEADERS.items():
        if row.get(column) is not None:
            value = clean(row[column])
            head.append(f"{name}: {'sha1:' + value if column == 'payload_digest' else value}")
    if row["record_type"] == "revisit":
        head.append(f"WARC-Profile: {REVISIT_PROFILE}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    """A gzip member whose ``sl`` field holds its own and its inflated length."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    size = 10 + 2 + 12 + len(body) + 8
    if max(size, len(data)) >= 1 << 32:     # lengths don't fit: readers inflate to find the end
        return b"\x1f\x8b\x08\x00\0\0\0\0\0\xff" + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    extra = b"sl" + struct.pack("<HII", 8, size, len(data))
    return (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body
            + struct.pack("<II", zlib.crc32(data), len(data)))


# --- bytes to records -------------------------------------------------------------------

class Window:
    """A file read in blocks; a jump past the block costs a seek, not a read."""

    def __init__(self, file, size: int):
        self.file, self.size, self.start, self.data = file, size, 0, b""

    def get(self, at: int, n: int) -> bytes:
        n = max(0, min(n, self.size - at))
        if not (self.start <= at and at + n <= self.start + len(self.data)):
            self.file.seek(at)
            self.start, self.data = at, self.file.read(max(n, BLOCK))
        return self.data[at - self.start:at - self.start + n]


class Member:
    """The inflated bytes of one record from the front, as far as they are asked for."""

    def __init__(self, window: Window, at: int):
        self.window, self.at, self.end, self.out = window, at, None, b""
        head = window.get(at, 10)
        self.zipped = head[:2] == b"\x1f\x8b"
        self.next = at
        if self.zipped:
            self.next += 10
            flags = head[3]
            if flags & 4:
                n = struct.unpack("<H", window.get(self.next, 2))[0]
                extra = window.get(self.next + 2, n)
                self.next += 2 + n
                while len(extra) >= 4:
                    size = struct.unpack("<H", extra[2:4])[0]
                    if extra[:2] == b"sl" and size >= 4:
                        self.end = at + struct.unpack("<I", extra[4:8])[0]
                    extra = extra[4 + size:]
            for flag in (8, 16):        # name, comment
                while flags & flag:
                    part = window.get(self.next, 256)
                    self.next += part.find(b"\0") + 1 if b"\0" in part else len(part)
                    if b"\0" in part or not part:
                        break
            self.next += 2 * bool(flags & 2)
            self.inflate = zlib.decompressobj(-15)

    def more(self, n: int = 8192) -> bool:
        """Take up to about ``n`` more bytes; False at the end."""
        if self.zipped:
            if self.inflate.eof:
                return False
            data = self.inflate.unconsumed_tail or self.window.get(self.next, 65536)
            if not self.inflate.unconsumed_tail:
                self.next += len(data)
            out = self.inflate.decompress(data, n)
            self.out += out
            return bool(out or data) and not (self.inflate.eof and not out)
        data = self.window.get(self.next, n)
        self.next += len(data)
        self.out += data
        return bool(data)

    def until(self, end: bytes, start: int) -> int:
        """The place after ``end`` in the inflated bytes, or -1."""
        while (found := self.out.find(end, start)) < 0:
            if not self.more():
                return -1
        return found + len(end)

    def upto(self, n: int) -> bytes:
        while len(self.out) < n and self.more(max(8192, n - len(self.out))):
            pass
        return self.out

    def skip(self) -> int:
        """The offset of the record after this gzip member."""
        if self.end is None:
            while not self.inflate.eof:
                data = self.inflate.unconsumed_tail or self.window.get(self.next, 65536)
                if not data:
                    break
                if not self.inflate.unconsumed_tail:
                    self.next += len(data)
                self.inflate.decompress(data, 1 << 20)
            self.end = self.next - len(self.inflate.unused_data) - len(self.inflate.unconsumed_tail) + 8
        return self.end


def fields(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, colon, v in (x.partition(":") for x in lines) if colon}


def records(window: Window, tests: list, payload: bool) -> Iterator[tuple]:
    """Rows of COLUMNS of the records that pass ``tests``, which see the headers only."""
    at = 0
    while at < window.size:
        if window.get(at, 2) == b"\r\n":     # between plain records
            at += 2
            continue
        one = Member(window, at)
        end = one.until(b"\r\n\r\n", 0)
        if end < 0:
            raise ValueError(f"no WARC record at byte {at}")
        head = fields(one.out[:end])
        row = {c: head.get(n.lower()) for c, n in HEADERS.items()}
        if row["payload_digest"]:
            row["payload_digest"] = row["payload_digest"].removeprefix("sha1:")
        size, kind = int(head["content-length"]), head.get("content-type", "")
        start, length, row["content_type"] = end, size, kind
        if kind.startswith("application/http"):
            start = one.until(b"\r\n\r\n", end)
            http = fields(one.out[end:start]) if start >= 0 else {}
            start = start if start >= 0 else end
            length = int(http.get("content-length", end + size - start))
            row["content_type"] = http.get("content-type")
        row["payload_length"] = length
        if all(test(row) for test in tests):
            row["payload"] = None
            if payload and row["record_type"] != "revisit":
                row["payload"] = one.upto(end + size)[start:end + size]
            yield tuple(row[c] for c in COLUMNS)
        at = one.skip() if one.zipped else at + end + size


# --- the data source --------------------------------------------------------------------

def test_of(f) -> object | None:
    """A pushed filter as a function of a row's headers; None if it isn't one on headers."""
    column = f.attribute[0] if len(f.attribute) == 1 else None
    if column not in COLUMNS or column == "payload":
        return None
    value = getattr(f, "value", None)
    match f:
        case D.EqualTo():
            return lambda r: r[column] is not None and r[column] == value
        case D.In():
            return lambda r: r[column] is not None and r[column] in value
        case D.IsNotNull():
            return lambda r: r[column] is not None
        case D.IsNull():
            return lambda r: r[column] is None
        case D.StringStartsWith():
            return lambda r: r[column] is not None and r[column].startswith(value)
        case D.GreaterThan():
            return lambda r: r[column] is not None and r[column] > value
        case D.GreaterThanOrEqual():
            return lambda r: r[column] is not None and r[column] >= value
        case D.LessThan():
            return lambda r: r[column] is not None and r[column] < value
        case D.LessThanOrEqual():
            return lambda r: r[column] is not None and r[column] <= value
    return None


@dataclass
class Archives(D.InputPartition):
    files: list

    def __init__(self, files):
        super().__init__(None)
        self.files = files


class WarcReader(D.DataSourceReader):
    def __init__(self, options):
        self.folder = options["path"]
        self.payload = options.get("payload", "bytes").lower() != "none"
        self.split = int(options.get("split_bytes", 64 << 20))
        self.filters = []

    def pushFilters(self, filters):
        for f in filters:
            if test_of(f) is None:
                yield f
            else:
                self.filters.append(f)

    def partitions(self):
        from pyarrow import fs
        store, top = filesystem(self.folder)
        found = {i.path: i.size for i in store.get_file_info(fs.FileSelector(top, recursive=True)) if i.is_file}
        kept = [p for p in found if re.search(r"/_manifest-[^/]*\.json$", p)]
        if kept:
            names = [n for p in sorted(kept) for n in json.loads(store.open_input_file(p).read())["files"]]
            found = {f"{top}/{n}": found[f"{top}/{n}"] for n in names}
        else:
            found = {p: n for p, n in found.items() if re.search(r"\.warc(\.gz)?$", p)}
        parts, held = [], 0
        for path in sorted(found):
            if not parts or held + found[path] > self.split:
                parts.append([])
                held = 0
            parts[-1].append((path, found[path]))
            held += found[path]
        return [Archives(p) for p in parts]

    def read(self, partition):
        if partition is None or not getattr(partition, "files", None):
            return
        store, _ = filesystem(self.folder)
        tests = [test_of(f) for f in self.filters]
        for path, size in partition.files:
            rows, held = [], 0
            with store.open_input_file(path) as file:
                for row in records(Window(file, size), tests, self.payload):
                    rows.append(row)
                    held += len(row[-1] or b"") + 256
                    if held > 8 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
            if rows:
                yield batch_of(rows)


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), ARROW)], schema=ARROW)


@dataclass
class Written(D.WriterCommitMessage):
    files: list
    rows: int


class WarcWriter(D.DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.folder, self.overwrite = options["path"], overwrite
        self.file_bytes = int(options.get("file_bytes", 64 << 20))
        self.level = int(options.get("level", 1))

    def write(self, iterator):
        store, top = filesystem(self.folder)
        store.create_dir(top, recursive=True)
        names, rows, out = [], 0, None
        for batch in iterator:
            columns = [c for c in COLUMNS if c in batch.schema.names]
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256).select(columns).to_pylist()
                for row in part:
                    if out is None or out.tell() >= self.file_bytes:
                        if out is not None:
                            out.close()
                        names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        out = store.open_output_stream(f"{top}/{names[-1]}", compression=None)
                    out.write(member(record_bytes({c: row.get(c) for c in COLUMNS}), self.level))
                rows += len(part)
        if out is not None:
            out.close()
        return Written(names, rows)

    def commit(self, messages):
        from pyarrow import fs
        store, top = filesystem(self.folder)
        store.create_dir(top, recursive=True)
        old = [i.path for i in store.get_file_info(fs.FileSelector(top)) if "/_manifest-" in i.path]
        done = [m for m in messages if m is not None]
        with store.open_output_stream(f"{top}/_manifest-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps({"files": [n for m in done for n in m.files],
                                  "rows": sum(m.rows for m in done)}).encode())
        for path in old if self.overwrite else ():
            store.delete_file(path)

    def abort(self, messages):
        store, top = filesystem(self.folder)
        for name in [n for m in messages if m is not None for n in m.files]:
            store.delete_file(f"{top}/{name}")


class Warc(D.DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> SparkSession:
    """Make ``format("warc")`` known and let filters reach its reader."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Warc)
    return spark


# --- revisits ---------------------------------------------------------------------------

def base32(hexed: Column) -> Column:
    """Upper-case base32 of a SHA-1 given in hexadecimal: 5 hexadecimal digits are 4 of base 32."""
    quads = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*quads), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_revisits(pages: DataFrame, page_id: str, payload: Column, least: int = 0) -> DataFrame:
    """``pages`` plus payload (binary), payload_length, payload_digest, record_type, refers_to.

    Only digests that occur more than once are joined back, and the pages' side of that join
    can be split where a third of all pages share one payload.
    """
    raw = F.encode(whole(payload), "utf-8")
    rows = pages.withColumn("payload", raw).withColumn("payload_length", F.length("payload").cast("long"))
    rows = rows.withColumn("__sha1", F.sha1("payload"))
    again = (pages.select(F.col(page_id).alias("__i"), raw.alias("__p"))
             .select("__i", F.length("__p").cast("long").alias("__n"), F.sha1("__p").alias("__d"))
             .where(F.col("__n") >= least)
             .groupBy("__d", "__n").agg(F.max("__i").alias("__top"), F.count(F.lit(1)).alias("__rows"))
             .where("__rows > 1").drop("__rows"))
    joined = rows.join(again, (F.col("__sha1") == F.col("__d")) & (F.col("payload_length") == F.col("__n")), "left")
    older = F.coalesce(F.col("__top") != F.coalesce(F.col(page_id), F.col("__top") - 1), F.lit(False))
    return joined.select(*pages.columns, "payload", "payload_length", base32(F.col("__sha1")).alias("payload_digest"),
                         F.when(older, "revisit").otherwise("response").alias("record_type"),
                         F.when(older, F.col("__top")).alias("refers_to"))


def page_urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def page_of(urn: Column) -> Column:
    return F.regexp_extract(urn, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def write_pages(pages: DataFrame, path: str, least: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """A record for each row of (page_id, url, html)."""
    register(pages.sparkSession)
    rows = with_revisits(pages.select("page_id", "url", "html"), "page_id", F.col("html"), least)
    rows.select("record_type", page_urn(F.col("page_id")).alias("record_id"), F.col("url").alias("target_uri"),
                F.lit(date).alias("date"), "payload_digest",
                F.when(F.col("refers_to").isNotNull(), page_urn(F.col("refers_to"))).alias("refers_to"),
                F.lit("text/html; charset=utf-8").alias("content_type"), "payload_length",
                F.when(F.col("record_type") == "response", F.col("payload")).alias("payload")
                ).write.format("warc").mode("append").save(path)


def op3_warc(spark, sf_dir):
    path = scratch_path(spark, "warc")
    write_pages(table(spark, sf_dir, "pages", "page_id", "url", "html"), path)
    read = register(spark).read.format("warc").load(path)
    # what a response holds is counted and hashed again; a revisit has only its headers
    return read.select(page_of(F.col("record_id")).alias("page_id"),
                       F.coalesce(F.length("payload").cast("long"), "payload_length").alias("payload_bytes"),
                       F.coalesce(base32(F.sha1("payload")), "payload_digest").alias("payload_digest"),
                       "record_type", page_of(F.col("refers_to")).alias("refers_to"), "target_uri")


ORACLE = """
WITH hashed AS (
  SELECT page_id, url, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
digests AS (
  SELECT *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(h, (5 * (i // 4) + 1)::INT, 5))::BIGINT) >> (15 - 5 * (i % 4))::INT) & 31)::INT + 1, 1)), '') AS payload_digest,
    max(page_id) OVER (PARTITION BY h) AS top
  FROM hashed)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to, url AS target_uri
FROM digests
"""

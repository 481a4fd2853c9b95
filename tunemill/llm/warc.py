"""WARC archives as a Python data source (operator 11).

``register(spark)`` adds the format ``warc`` for reading and writing.

Reading. The planner deals files to tasks, and pieces of files where a manifest of
this writer says at which records a file may be cut; nothing else is read on the driver.
Predicates on the record type and on the columns made from headers are pushed
into the source. A task parses a record's headers first, evaluates the
predicates on them, and only for records that pass reads and decodes the
payload: in plain files it seeks behind the block, in gzip files it jumps to
the next member where the member states its length (the ``sl`` field of the WARC
standard's gzip annex, which the writer sets), else it inflates the block piece by
piece without keeping it. With the option ``payload`` = false there is no
payload column and no block is read at all.

Writing. Each task writes files of about ``file_bytes`` under names that no other
attempt uses, each beginning with a warcinfo record; the driver lists the files of the
tasks that succeeded in the manifest, and only those are read. Lost
executors and repeated tasks therefore leave no record twice.

Options: ``compression`` gzip (one member a record) or none, ``file_bytes``, ``split_bytes``
(length of a task's piece), ``payload``, ``mode`` failfast, or permissive (a place
that cannot be read becomes one row of record type ``unreadable`` and the rest of
that piece is left). Files are reached through pyarrow's file systems (local, hdfs, s3, gs, abfs).

Memory: one record, and one Arrow batch of at most ``BATCH`` payload bytes or one record.

Defined results (``write_pages``, ``read_pages``)
* null or empty html: an empty payload; null url: no target header, read back as null.
* of rows with equal payloads of at least 100 bytes those with the smallest page id are
  responses (repeated rows each), the others revisits; null ids never are the smallest, and
  where all ids are null all are responses. Ids come back as 64-bit integers.
* no rows: an archive without records. Other columns, whatever their names, play no part.
"""

from __future__ import annotations

import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter,
                                    GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan,
                                    LessThanOrEqual, StringContains, StringEndsWith, StringStartsWith,
                                    WriterCommitMessage)

from ..session import shared_path

MANIFEST = "_manifest.json"
FILE_BYTES = 1 << 30
SPLIT_BYTES = 64 << 20
BATCH = 16 << 20
CHUNK = 1 << 18

# ---------------------------------------------------------------------------
# FIXED VALUES of the WARC standard and of HTTP.
# ---------------------------------------------------------------------------
VERSION = b"WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http"
NAMES = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI",
         "date": "WARC-Date", "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest"}
# ---------------------------------------------------------------------------

HEADERS = "file string, offset bigint, " + ", ".join(f"{c} string" for c in NAMES) + \
    ", block_length bigint, headers map<string,string>"
PUSHED = {*NAMES, "block_length"}


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of ``path`` and the path in it."""
    if re.match(r"file:/", path):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))
    return pafs.LocalFileSystem(), path


class Unreadable(ValueError):
    """A place in an archive that is no record."""


class Plain:
    """Reads records of an uncompressed file."""

    def __init__(self, raw, start: int):
        self.file = io.BufferedReader(raw, CHUNK)
        self.file.seek(start)

    def place(self) -> int:
        return self.file.tell()

    def line(self) -> bytes:
        return self.file.readline()

    def take(self, n: int) -> bytes:
        got = self.file.read(n)
        if len(got) < n:
            raise Unreadable("the file ends within a record")
        return got

    def skip(self, n: int) -> None:
        self.file.seek(n, io.SEEK_CUR)


class Gzip:
    """Reads records of a file of gzip members."""

    def __init__(self, raw, start: int):
        self.raw = raw
        self.raw.seek(start)
        self.held, self.at = b"", 0  # inflated and not yet taken
        self.rest, self.next_read = b"", start  # raw bytes not yet inflated, and the file's place behind them
        self.inflater = None
        self.member, self.packed, self.plain, self.out = start, 0, 0, 0

    def _raw(self) -> bytes:
        got = self.raw.read(CHUNK)
        self.next_read += len(got)
        return got

    def _open(self) -> bool:
        """Begins the next member; false at the end of the file."""
        if not self.rest:
            self.rest = self._raw()
        while 0 < len(self.rest) < 24:
            more = self._raw()
            if not more:
                break
            self.rest += more
        if not self.rest:
            return False
        if self.rest[:2] != b"\x1f\x8b":
            raise Unreadable("no gzip member begins here")
        self.member = self.next_read - len(self.rest)
        self.packed = self.plain = 0
        if self.rest[3] & 4 and self.rest[12:14] == b"sl" and len(self.rest) >= 24:
            self.packed = int.from_bytes(self.rest[16:20], "little")
            self.plain = int.from_bytes(self.rest[20:24], "little")
        self.inflater, self.out = zlib.decompressobj(31), 0
        return True

    def _fill(self) -> bool:
        """Inflates a piece more; false at the end of the file."""
        while True:
            if self.inflater is None and not self._open():
                return False
            data = self.inflater.unconsumed_tail or self.rest or self._raw()
            self.rest = b""
            if not data:
                raise Unreadable("the file ends within a gzip member")
            try:
                got = self.inflater.decompress(data, CHUNK)
            except zlib.error as e:
                raise Unreadable(str(e)) from e
            if self.inflater.eof:
                self.rest, self.inflater = self.inflater.unused_data, None
            self.out += len(got)
            if got:
                self.held, self.at = self.held[self.at:] + got, 0
                return True

    def place(self) -> int:
        if self.at == len(self.held):
            if self.inflater is None and not self.rest:
                self.rest = self._raw()
            if self.inflater is None:
                return self.next_read - len(self.rest)
        return self.member

    def line(self) -> bytes:
        while (end := self.held.find(b"\n", self.at)) < 0 and self._fill():
            pass
        end = len(self.held) if end < 0 else end + 1
        got, self.at = self.held[self.at:end], end
        return got

    def take(self, n: int) -> bytes:
        parts, need = [], n
        while need:
            if self.at == len(self.held) and not self._fill():
                raise Unreadable("the file ends within a record")
            got = self.held[self.at:self.at + need]
            self.at += len(got)
            need -= len(got)
            parts.append(got)
        return b"".join(parts)

    def skip(self, n: int) -> None:
        left = len(self.held) - self.at
        if self.inflater is not None and self.packed and self.out - left + n == self.plain:
            self.next_read = self.member + self.packed  # the record ends with its member
            self.raw.seek(self.next_read)
            self.held, self.at, self.rest, self.inflater = b"", 0, b"", None
            return
        while n:
            if self.at == len(self.held) and not self._fill():
                raise Unreadable("the file ends within a record")
            step = min(n, len(self.held) - self.at)
            self.at += step
            n -= step


def read_headers(source: Plain | Gzip) -> dict[str, str] | None:
    """The next record's headers, folded lines joined and repeated ones separated by commas; None at the end."""
    first = source.line()
    while first and not first.strip():
        first = source.line()
    if not first:
        return None
    if not first.startswith(b"WARC/"):
        raise Unreadable("no record begins here")
    out: dict[str, str] = {}
    last = None
    while line := source.line():
        if not line.strip():
            return out
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if line[:1] in b" \t" and last:
            out[last] += " " + text.strip()
            continue
        name, _, value = text.partition(":")
        last = next((k for k in out if k.lower() == name.strip().lower()), name.strip())
        out[last] = out[last] + ", " + value.strip() if last in out else value.strip()
    raise Unreadable("the file ends within headers")


def columns(headers: dict[str, str]) -> dict:
    """The values of the pushed columns."""
    known = {k.lower(): v for k, v in headers.items()}
    out = {c: known.get(h.lower()) for c, h in NAMES.items()}
    for c in ("record_id", "refers_to"):
        out[c] = out[c] and out[c].strip("<>")
    try:
        out["block_length"] = int(known["content-length"])
    except (KeyError, ValueError) as e:
        raise Unreadable("a record states no length") from e
    return out


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """A block without its HTTP headers, if it has any."""
    kind = next((v for k, v in headers.items() if k.lower() == "content-type"), "")
    return block.partition(b"\r\n\r\n")[2] if kind.startswith(HTTP) else block


def passes(f: Filter, row: dict) -> bool:
    """A pushed predicate on a record's columns; comparisons with null do not pass."""
    v = row[f.attribute[0]]
    if isinstance(f, IsNull):
        return v is None
    if isinstance(f, EqualNullSafe):
        return v == f.value
    if v is None:
        return False
    match f:
        case IsNotNull():
            return True
        case EqualTo():
            return v == f.value
        case In():
            return v in f.value
        case GreaterThan():
            return v > f.value
        case GreaterThanOrEqual():
            return v >= f.value
        case LessThan():
            return v < f.value
        case LessThanOrEqual():
            return v <= f.value
        case StringStartsWith():
            return v.startswith(f.value)
        case StringEndsWith():
            return v.endswith(f.value)
        case StringContains():
            return f.value in v
    raise TypeError(type(f))


KINDS = (IsNull, EqualNullSafe, IsNotNull, EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan,
         LessThanOrEqual, StringStartsWith, StringEndsWith, StringContains)


@dataclass
class Pieces(InputPartition):
    """Pieces (file, first byte, byte behind the last, or None) that one task reads."""

    pieces: list[tuple[str, int, int | None]]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.split = int(options.get("split_bytes", SPLIT_BYTES))
        self.payload = options.get("payload", "true").lower() != "false"
        self.permissive = options.get("mode", "failfast").lower() == "permissive"
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, KINDS) and len(f.attribute) == 1 and f.attribute[0] in PUSHED:
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[Pieces]:
        fs, root = file_system(self.path)
        files: list[tuple[str, int, list[int]]] = []
        if fs.get_file_info(root).type == pafs.FileType.File:
            files.append((root, fs.get_file_info(root).size, []))
        elif fs.get_file_info(f"{root}/{MANIFEST}").type == pafs.FileType.File:
            files += [(f"{root}/{f['name']}", f["bytes"], f["cuts"]) for f in read_manifest(fs, root)]
        else:
            files += [(i.path, i.size, []) for i in fs.get_file_info(pafs.FileSelector(root, recursive=True))
                      if re.search(r"\.warc(\.gz)?$", i.path)]
        out, held, size = [], [], 0
        for name, end, cuts in sorted(files):
            edges = [0, *cuts, None]
            for a, b in zip(edges, edges[1:]):
                n = (end if b is None else b) - a
                if held and size + n > self.split:
                    out.append(Pieces(held))
                    held, size = [], 0
                held.append((name, a, b))
                size += n
        return [*out, *([Pieces(held)] if held else [])] or [Pieces([])]

    def read(self, partition: Pieces) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(self.path)
        rows, size = [], 0
        for name, start, end in partition.pieces:
            for row in self.records(fs, name, start, end):
                rows.append(row)
                size += len(row.get("payload") or b"") + 1000
                if size >= BATCH:
                    yield self.batch(rows)
                    rows, size = [], 0
        if rows:
            yield self.batch(rows)

    def records(self, fs: pafs.FileSystem, name: str, start: int, end: int | None) -> Iterator[dict]:
        with fs.open_input_file(name) as raw:
            source = (Gzip if name.endswith(".gz") else Plain)(raw, start)
            at = start
            try:
                while end is None or (at := source.place()) < end:
                    at = source.place()
                    headers = read_headers(source)
                    if headers is None:
                        break
                    row = columns(headers)
                    n = row["block_length"]
                    if not all(passes(f, row) for f in self.filters):
                        source.skip(n + 4)
                        continue
                    row |= {"file": name, "offset": at, "headers": list(headers.items())}
                    if self.payload:
                        row["payload"] = payload_of(headers, source.take(n))
                        n = 0
                    source.skip(n + 4)
                    yield row
            except Unreadable as e:
                if not self.permissive:
                    raise ValueError(f"{name}, byte {at}: {e}") from e
                if all(passes(f, dict.fromkeys(PUSHED) | {"record_type": "unreadable"}) for f in self.filters):
                    yield {"file": name, "offset": at, "record_type": "unreadable", "headers": [("error", str(e))]}

    def batch(self, rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, schema=arrow_schema(self.payload))


def arrow_schema(payload: bool) -> pa.Schema:
    text, number = pa.string(), pa.int64()
    fields = [("file", text), ("offset", number), *((c, text) for c in NAMES), ("block_length", number),
              ("headers", pa.map_(text, text))]
    return pa.schema(fields + [("payload", pa.binary())] * payload)


@dataclass
class Written(WriterCommitMessage):
    files: list[dict]


def gzip_member(record: bytes) -> bytes:
    """One gzip member that states its packed and plain length, where 32 bits hold them."""
    squeeze = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = squeeze.compress(record) + squeeze.flush()
    sizes = (len(body) + 32, len(record))
    if max(sizes) >= 1 << 32:
        sizes = (0, 0)
    extra = b"sl\x08\x00" + sizes[0].to_bytes(4, "little") + sizes[1].to_bytes(4, "little")
    return (b"\x1f\x8b\x08\x04" + b"\x00" * 4 + b"\x00\xff" + len(extra).to_bytes(2, "little") + extra + body
            + zlib.crc32(record).to_bytes(4, "little") + (len(record) & 0xFFFFFFFF).to_bytes(4, "little"))


def clean(value: str) -> str:
    """A header's value with control characters percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(row: dict) -> bytes:
    """One record. Responses and revisits carry HTTP headers; a revisit has no payload."""
    kind = row["record_type"]
    payload = b"" if kind == "revisit" else row.get("payload") or b""
    http = kind in ("response", "revisit")
    block = payload
    if http:
        block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                 + (b"" if kind == "revisit" else b"Content-Length: %d\r\n" % len(payload)) + b"\r\n" + payload)
    lines = [(NAMES[c], row.get(c)) for c in NAMES]
    lines = [(k, f"<{v}>" if v and k in ("WARC-Record-ID", "WARC-Refers-To") else v) for k, v in lines]
    lines += [("WARC-Profile", SAME_PAYLOAD if kind == "revisit" else None),
              ("Content-Type", HTTP + ";msgtype=response" if http else row.get("content_type") or "application/octet-stream"),
              ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {clean(v)}\r\n" for k, v in lines if v is not None)
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def read_manifest(fs: pafs.FileSystem, root: str) -> list[dict]:
    with fs.open_input_stream(f"{root}/{MANIFEST}") as f:
        return json.loads(f.read())["files"]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.gzip = options.get("compression", "gzip").lower() != "none"
        self.limit = int(options.get("file_bytes", FILE_BYTES))
        self.split = int(options.get("split_bytes", SPLIT_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        files: list[dict] = []
        out, size, piece = None, 0, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    name = f"part-{uuid.uuid4().hex}.warc" + ".gz" * self.gzip
                    out, size, piece = fs.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                    files.append({"name": name, "cuts": []})
                    info = {"record_type": "warcinfo", "record_id": f"urn:uuid:{uuid.uuid4()}", "date": row.get("date"),
                            "content_type": "application/warc-fields", "payload": b"format: WARC File Format 1.1\r\n"}
                    size += out.write(self.packed(info))
                if size - piece >= self.split:
                    files[-1]["cuts"].append(size)
                    piece = size
                size += out.write(self.packed(row))
                if size >= self.limit:
                    out.close()
                    files[-1]["bytes"], out = size, None
        if out is not None:
            out.close()
            files[-1]["bytes"] = size
        return Written(files)

    def packed(self, row: dict) -> bytes:
        return gzip_member(record(row)) if self.gzip else record(row)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        there = fs.get_file_info(f"{root}/{MANIFEST}").type == pafs.FileType.File
        old = read_manifest(fs, root) if there else []
        files = [f for m in messages if m for f in m.files] + ([] if self.overwrite else old)
        with fs.open_output_stream(f"{root}/{MANIFEST}.new") as f:
            f.write(json.dumps({"files": files}).encode())
        fs.move(f"{root}/{MANIFEST}.new", f"{root}/{MANIFEST}")
        for f in old if self.overwrite else []:
            fs.delete_file(f"{root}/{f['name']}")

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = file_system(self.path)
        for f in (f for m in messages if m for f in m.files):
            fs.delete_file(f"{root}/{f['name']}")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return HEADERS + (", payload binary" if self.options.get("payload", "true").lower() != "false" else "")

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        need = {"record_type", "record_id"} - set(schema.names)
        if need:
            raise ValueError(f"columns missing: {sorted(need)}")
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Adds the format ``warc`` and lets Spark push predicates into Python data sources, which it
    does only if ``spark.sql.python.filterPushdown.enabled`` is set."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_warc(spark: SparkSession, path: str, payload: bool = True, **options) -> DataFrame:
    """The records under ``path`` (see the module's text); predicates are set with ``where``."""
    register(spark)
    return spark.read.format("warc").options(payload=str(payload).lower(), **options).load(path)


def write_warc(df: DataFrame, path: str, mode: str = "append", **options) -> None:
    """Writes a record per row: record_type, record_id and, where there, target_uri, date, refers_to,
    payload_digest, content_type and payload (binary)."""
    register(df.sparkSession)
    df.write.format("warc").options(**options).mode(mode).save(path)


def write_pages(pages: DataFrame, path: str, min_bytes: int = 100, date: str = "1970-01-01T00:00:00Z", **options) -> None:
    """Archives ``pages`` (page_id, url, html). Equal payloads are found by their SHA-256; the
    digests that occur again are few beside the pages and are joined to them, a hot one split by Spark."""
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    rows = (pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
            .withColumn("digest", F.sha2("payload", 256)))
    firsts = (rows.where(F.octet_length("payload") >= min_bytes).groupBy(F.col("digest").alias("same"))
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null")
              .drop("n"))
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    urn = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")))
    write_warc(rows.join(firsts, F.col("digest") == F.col("same"), "left").select(
        F.when(again, "revisit").otherwise("response").alias("record_type"), urn("page_id").alias("record_id"),
        F.col("url").alias("target_uri"), F.lit(date).alias("date"), F.when(again, urn("first")).alias("refers_to"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        F.when(~again, F.col("payload")).alias("payload")), path, **options)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload_bytes, payload_digest) per page of an archive of
    ``write_pages``. Responses give their payload's length and digest; revisits are read by their headers alone
    and have the length from the response that they refer to."""
    number = lambda c: F.regexp_extract(c, "^urn:page:(-?[0-9]+)$", 1).try_cast("long")
    full = read_warc(spark, path).where(F.col("record_type") == "response").select(
        "record_id", F.col("target_uri").alias("url"), "record_type", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"))
    short = read_warc(spark, path, payload=False).where(F.col("record_type") == "revisit").select(
        "record_id", F.col("target_uri").alias("url"), "record_type", "refers_to",
        F.regexp_extract("payload_digest", "^sha256:([0-9a-f]{64})$", 1).alias("payload_digest"))
    known = full.select(F.col("record_id").alias("k"), F.col("payload_digest").alias("kd"), "payload_bytes").distinct()
    resolved = short.join(known, (F.col("refers_to") == F.col("k")) & (F.col("payload_digest") == F.col("kd")), "left")
    cols = [number("record_id").alias("page_id"), "url", "record_type", number("refers_to").alias("refers_to"),
            "payload_bytes", "payload_digest"]
    return full.withColumn("refers_to", F.lit(None).cast("string")).select(cols).unionByName(resolved.select(cols))


def op11(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """The digest row per page of the dealt query."""
    path = shared_path(spark, "warc")
    write_pages(pages, path)
    return read_pages(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
firsts AS (SELECT h, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY h)
SELECT page_id, n::BIGINT AS payload_bytes, sha256(h) AS payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN firsts USING (h)
"""

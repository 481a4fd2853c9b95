"""JSON files of any size in as many tasks as byte ranges.

Whether a comma of a JSON array parts two records depends on everything before it:
is it inside a string, and how deep? Both are known from a small summary of the bytes
before, and summaries compose. A range's summary says, for each of the four states
it may begin in (inside a string or not, the next byte escaped or not), the state it
ends in and by how much the depth changes. So

1. every range is summed up by a task of its own (only files longer than one range),
2. the summaries of a file, one row per range, are composed in order, which gives
   each range the state and depth it begins with,
3. every range is cut into records by a task of its own, at the commas and brackets
   of depth one. A record belongs to the range that holds the mark before it; that task
   reads on behind its range for a record that ends there.

A line break ends a string (JSON allows none inside), so a missing quote costs the
records of its line and not the rest of the file. Nothing is dropped: text that is
no record (outside the array, or two objects without a comma) comes out as a row. A record
of more than ``MAX_RECORD`` bytes (a file whose brackets never close, say) is an error that
names its place. Compressed files are one range. A task holds ``CHUNK`` bytes and one record.

Files of one record a line go through the same source: a line belongs to the range it begins in.
The form of every file is found from its first visible character.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..session import shared_path
from .files import file_system

RANGE_BYTES = 64 << 20
LEAST_RANGE = 64 << 10
CHUNK = 4 << 20
MAX_RECORD = 256 << 20
BATCH = 8 << 20
PACKED = (".gz", ".bz2", ".zst", ".lz4")
BOM = b"\xef\xbb\xbf"

# A state is inside + 2 * escaped: inside a string, and the next byte is escaped.
QUOTE, ESCAPE, BREAK, COMMA = 34, 92, 10, 44
DEEPER, HIGHER = np.frombuffer(b"[{", np.uint8), np.frombuffer(b"]}", np.uint8)

SUMMARY = "file string, start bigint, stop bigint, state array<int>, depth array<bigint>"
STARTS = "file string, form string, start bigint, stop bigint, state int, depth bigint"
RECORDS = "file string, start bigint, whole boolean, value string"


def walk(data: np.ndarray, state: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Of the bytes read from ``state``: which stand outside strings, the change of depth at each, and
    the state behind them."""
    n = len(data)
    slash = data == ESCAPE
    if state & 2:
        slash[0] = False
    at = np.arange(n)
    plain = np.maximum.accumulate(np.where(slash, -1, at))  # the last byte that is no backslash
    escaped = np.empty(n, bool)
    escaped[0] = bool(state & 2)
    escaped[1:] = ((at - plain)[:-1] & 1).astype(bool)
    quotes = np.cumsum((data == QUOTE) & ~escaped) + (state & 1)
    before_line = np.maximum.accumulate(np.where(data == BREAK, quotes, 0))
    inside = ((quotes - before_line) & 1).astype(bool)
    step = (np.isin(data, DEEPER).astype(np.int64) - np.isin(data, HIGHER)) * ~inside
    open_escape = (n - 1 - plain[-1]) & 1 and data[-1] == ESCAPE
    return ~inside, step, int(inside[-1]) + 2 * int(open_escape)


def sum_up(data: np.ndarray, states: list[int], depths: list[int]) -> tuple[list[int], list[int]]:
    """The summary (end state and depth per start state) carried on over ``data``."""
    seen = {}
    for s in set(states):
        _, step, end = walk(data, s)
        seen[s] = (end, int(step.sum()))
    return [seen[s][0] for s in states], [d + seen[s][1] for s, d in zip(states, depths)]


def chunks(path: str, start: int, stop: int | None) -> Iterator[bytes]:
    """The bytes from ``start`` to ``stop`` (None: the end), unpacked if the file is compressed."""
    fs, name = file_system(path)
    if name.endswith(PACKED):
        with fs.open_input_stream(name, compression="detect") as f:
            while data := f.read(CHUNK):
                yield data
        return
    with fs.open_input_file(name) as f:
        f.seek(start)
        while stop is None or start < stop:
            data = f.read(CHUNK if stop is None else min(CHUNK, stop - start))
            if not data:
                return
            start += len(data)
            yield data


def one_object(text: bytes, closed: int) -> bool:
    """Whether a text is one object, by its ends and the objects and arrays that end in it."""
    return closed == 1 and text[:1] == b"{" and text[-1:] == b"}"


def cut_array(path: str, start: int, stop: int | None, state: int, depth: int) -> Iterator[tuple[int, bool, bytes]]:
    """(place, whether it is one object of an array, text) of the records whose mark lies in the range. Marks are
    the commas and brackets of depth one; the beginning of the file counts as one."""
    held = b"" if start == 0 else None  # the piece that is open; None: it belongs to the range before
    begin, inside, opened, closed = 0, False, False, 0
    at = start
    for data in chunks(path, start, None):
        if held is None and stop is not None and at >= stop:
            return
        raw = np.frombuffer(data, np.uint8)
        outside, step, state = walk(raw, state)
        level = depth + np.cumsum(step)
        depth = int(level[-1])
        marks = (step == 1) & (level == 1) | (step == -1) & (level == 0) | (raw == COMMA) & outside & (level == 1)
        closers = np.cumsum((step == -1) & (level == 1))
        last = done = 0
        for p in np.flatnonzero(marks).tolist():
            if held is not None:
                text = (held + data[last:p]).removeprefix(BOM if begin == 0 else b"").strip()
                if text or inside and not (opened and step[p] == -1):
                    yield begin, inside and one_object(text, closed + int(closers[p]) - done), text
            if stop is not None and at + p >= stop:
                return
            held, begin, last = b"", at + p + 1, p + 1
            inside, opened, closed, done = bool(step[p] != -1), bool(step[p] == 1), 0, int(closers[p])
        if held is not None:
            held += data[last:]
            closed += int(closers[-1]) - done
            if len(held) > MAX_RECORD:
                raise ValueError(f"{path}, byte {begin}: no record ends within {MAX_RECORD} bytes")
        at += len(data)
    text = (held or b"").removeprefix(BOM if begin == 0 else b"").strip()
    if text:
        yield begin, inside and one_object(text, closed), text


def cut_lines(path: str, start: int, stop: int | None) -> Iterator[tuple[int, bool, bytes]]:
    """(place, whether it is one object, text) of the lines that begin in the range; blank ones are none."""
    skip = start > 0  # up to the first line break from the byte before the range on
    begin, held = max(start - 1, 0), b""

    def lines(block: bytes) -> Iterator[tuple[int, bool, bytes]]:
        raw = np.frombuffer(block, np.uint8)
        _, step, _ = walk(raw, 0)
        level = np.r_[0, np.cumsum(step)]
        ends = np.flatnonzero(raw == BREAK)
        starts = np.r_[0, ends + 1][:len(ends)] if block.endswith(b"\n") else np.r_[0, ends + 1]
        base = np.repeat(level[starts], np.diff(np.r_[starts, len(raw)]))
        closed = np.add.reduceat(((step == -1) & (level[1:] == base)).astype(np.int64), starts)
        for a, b, n in zip(starts.tolist(), np.r_[starts[1:], len(raw)].tolist(), closed.tolist()):
            text = block[a:b].removeprefix(BOM if begin + a == 0 else b"").strip()
            yield begin + a, one_object(text, n), text

    def owned(block: bytes) -> Iterator[tuple[int, bool, bytes]]:
        nonlocal skip
        for place, whole, text in lines(block):
            if skip:
                skip = False
            elif stop is None or place < stop:
                if text:
                    yield place, whole, text

    for data in chunks(path, begin, None):
        held += data
        end = held.rfind(b"\n") + 1
        if end:
            yield from owned(held[:end])
            begin, held = begin + end, held[end:]
            if stop is not None and begin >= stop:
                return
        if len(held) > MAX_RECORD:
            raise ValueError(f"{path}, byte {begin}: no line ends within {MAX_RECORD} bytes")
    if held:
        yield from owned(held)


def first_character(path: str) -> str:
    """The form of a file: 'array' if its first visible character opens one, else 'lines'."""
    for data in chunks(path, 0, None):
        text = data.removeprefix(BOM).lstrip()
        if text:
            return "array" if text.startswith(b"[") else "lines"
    return "lines"


@dataclass
class Ranges(InputPartition):
    """Ranges (file, form, start, stop, state, depth) of one task."""

    ranges: list[tuple[str, str, int, int, int, int]]


class RangeReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.table = options["ranges"]
        self.scan = options.get("scan", "false") == "true"
        self.size = int(options["range_bytes"])

    def partitions(self) -> list[Ranges]:
        """A range of full length has a task of its own; short files share one."""
        fs, path = file_system(self.table)
        names = ["file", "form", "start", "stop", "state", "depth"]
        rows = sorted(tuple(r[n] for n in names) for r in pq.read_table(path, filesystem=fs, columns=names).to_pylist())
        out, held, size = [], [], 0
        for r in rows:
            if held and size + r[3] - r[2] > self.size:
                out.append(Ranges(held))
                held, size = [], 0
            held.append(r)
            size += r[3] - r[2]
        return [*out, *([Ranges(held)] if held else [])] or [Ranges([])]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        return self.summaries(partition) if self.scan else self.records(partition)

    def summaries(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        for path, _, start, stop, _, _ in partition.ranges:
            states, depths = [0, 1, 2, 3], [0] * 4
            for data in chunks(path, start, stop):
                states, depths = sum_up(np.frombuffer(data, np.uint8), states, depths)
            yield pa.RecordBatch.from_pylist(
                [{"file": path, "start": start, "stop": stop, "state": states, "depth": depths}],
                schema=pa.schema([("file", pa.string()), ("start", pa.int64()), ("stop", pa.int64()),
                                  ("state", pa.list_(pa.int32())), ("depth", pa.list_(pa.int64()))]))

    def records(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        names = ["file", "start", "whole", "value"]
        rows: list[tuple] = []
        size = 0
        for path, form, start, stop, state, depth in partition.ranges:
            stop = None if path.endswith(PACKED) else stop
            found = cut_array(path, start, stop, state, depth) if form == "array" else cut_lines(path, start, stop)
            for begin, whole, text in found:
                rows.append((path, begin, whole, text.decode("utf-8", "replace")))
                size += len(text)
                if size > BATCH:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows))), names=names)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows))), names=names)


class RangeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "json_ranges"

    def schema(self) -> str:
        return SUMMARY if self.options.get("scan", "false") == "true" else RECORDS

    def reader(self, schema: T.StructType) -> RangeReader:
        return RangeReader(dict(self.options))


def _compose(pdf: pd.DataFrame) -> pd.DataFrame:
    """The state and depth that each range of a file begins with."""
    state, depth, out = 0, 0, []
    for r in pdf.sort_values("start").itertuples():
        out.append((r.file, "array", r.start, r.stop, state, depth))
        state, depth = int(r.state[state]), depth + int(r.depth[state])
    return pd.DataFrame(out, columns=["file", "form", "start", "stop", "state", "depth"])


def files_under(spark: SparkSession, path: str, form: str = "auto") -> list[tuple[str, int, str]]:
    """(file, length, form) of the files under ``path``, which Spark lists; the first bytes of each are read by tasks."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    if form != "auto":
        return [(r.path, r.length, form) for r in files.collect()]

    def look(batches):
        for pdf in batches:
            yield pdf.assign(form=[first_character(p) for p in pdf["path"]])
    return [tuple(r) for r in files.mapInPandas(look, "path string, length bigint, form string").collect()]


def read_records(spark: SparkSession, files: list[tuple[str, int, str]], range_bytes: int | None = None) -> DataFrame:
    """The records of JSON files (file, length, form): ``file``, ``start`` (the text's place), ``whole`` (one object; else
    the text is no record) and ``value``. Ranges are ``RANGE_BYTES`` long, shorter if all cores are to have one."""
    spark.dataSource.register(RangeSource)
    if range_bytes is None:
        total = sum(n for _, n, _ in files)
        range_bytes = min(RANGE_BYTES, max(LEAST_RANGE, total // spark.sparkContext.defaultParallelism + 1))
    packed = F.col("file").rlike("(" + "|".join(p.replace(".", r"\.") for p in PACKED) + ")$")
    step = F.when(packed, F.greatest("length", F.lit(1))).otherwise(F.lit(range_bytes))
    first = F.lit(0).cast("long")
    ranges = spark.createDataFrame(files, "file string, length bigint, form string").select(
        "*", F.explode(F.sequence(first, F.greatest(F.col("length") - 1, first), step)).alias("start"))
    table, scanned = shared_path(spark, "json-ranges"), shared_path(spark, "json-scanned")
    (ranges.select("file", "form", "start", F.least(F.col("start") + step, "length").alias("stop"), F.lit(0).alias("state"),
                   first.alias("depth"), ((F.col("form") == "array") & (F.col("length") > step)).alias("long"))
     .write.partitionBy("long").parquet(table))
    starts = spark.read.parquet(table).where("not long").drop("long")
    if any(form == "array" and n > range_bytes and not f.endswith(PACKED) for f, n, form in files):
        sums = (spark.read.format("json_ranges").options(ranges=f"{table}/long=true", scan="true", range_bytes=1).load())
        starts = starts.unionByName(sums.groupBy("file").applyInPandas(lambda pdf: _compose(pdf), STARTS))
    starts.write.parquet(scanned)
    return spark.read.format("json_ranges").options(ranges=scanned, range_bytes=range_bytes).load()

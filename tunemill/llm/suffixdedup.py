"""Removal of repeated byte strings (operator 8) by column-wise construction of a
collection's suffix order, Burrows-Wheeler transform and common prefixes.

A byte goes if a string of ``LENGTH`` bytes covers it that also starts in a
document with a smaller id. The column-wise construction inserts one symbol of
every member of a collection per round: the suffixes that begin at column c are
those of column c + 1 in stable order of the symbol put before them (the
transform's next column), and a common prefix is one more than the least of
those between two neighbours. A round reads the next column from a sequential
file and keeps one order and one prefix array. Rounds would be as many as the
longest text has bytes, so the members are not whole texts but segments:

* Every window of ``LENGTH`` bytes has an anchor, its leftmost ``K``-byte piece of
  least hash. A run of windows with one anchor is a segment (at most ``COLUMNS``
  bytes). Equal windows have equal anchors at equal offsets, so segments with
  one anchor hash meet in one task and are aligned by their anchors: equal
  windows begin in the same column, and ``COLUMNS`` rounds find all of them.

1. Filter: tasks send the distinct anchor hashes of their documents (48 bits, as
   packed arrays, dealt out by value); hashes of one document only are done.
2. Segments: documents with shared hashes send the segments under them. What a
   task sees in several of its documents is settled there for all but the
   smallest id, and only that one is sent, so a passage that a third of all
   documents hold is no hot group. An anchor of ``WIDE`` documents or more may
   stand in as many contexts, each a segment of its own; its segments are dealt
   out window by window, by 128 bits of the window's bytes, so that the contexts
   of one anchor spread over all tasks. At most ``WIDE_MOST`` anchors, the widest,
   are told to the tasks; any other has fewer documents than each of those.
3. Columns: per task, distinct segments (with their smallest id) go through the
   rounds, at most about ``CHUNK`` at a time. Windows whose common prefix reaches
   LENGTH are equal; the smallest id among them owns the string. One anchor with
   more than ``CHUNK`` distinct segments in a task is settled column by column by
   the windows' digests instead, in memory linear in its segments.
4. The spans found meet their documents again; overlaps are merged and cut out.

Texts travel compressed. Packed arrays are deterministic, and each step ends in
a table in the shared folder; the column files are a task's own scratch space,
gone when the chunk is done, and made anew if the task runs again.

Defined results: ids that are no integers are refused with an error; null text is
empty; texts under LENGTH bytes keep all; rows without an id keep all and remove nothing; rows with one id are one document,
whose strings do not remove each other; repeated rows get equal results; other
columns are passed through.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, fresh

LENGTH = 50
K = 16  # bytes of an anchor
OFFSETS = LENGTH - K + 1  # windows that an anchor can belong to
COLUMNS = LENGTH + OFFSETS - 1
BLOCK = 1 << 20  # bytes of a text that are hashed at once
FLUSH_HASHES = 1 << 21
FLUSH_SEGMENTS = 1 << 18
CHUNK = 1 << 17
WIDE = 1 << 16  # documents from which an anchor is dealt out by window
WIDE_MOST = 1 << 18  # anchors told to the tasks
WINDOWS = 1 << 21  # windows packed at a time
U = np.uint64
NO_OWNER = np.iinfo(np.int64).max


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(29))


def piece_hashes(b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the K bytes from every position that has as many."""
    n = len(b) - K + 1
    eight = np.lib.stride_tricks.sliding_window_view(b, 8)
    q = np.ascontiguousarray(eight).view(np.uint64).ravel()
    h = mix((q[:n] ^ U(0x9E3779B97F4A7C15)) * U(0xC2B2AE3D27D4EB4F))
    return mix(h + q[8:8 + n] * U(0x165667B19E3779F9))


def least(h: np.ndarray) -> np.ndarray:
    """The least hash in every window."""
    a, s = h, 1
    while 2 * s <= OFFSETS:
        a = np.minimum(a[:-s], a[s:])
        s *= 2
    return np.minimum(a[:len(a) - (OFFSETS - s)], a[OFFSETS - s:]) if s < OFFSETS else a


def anchors(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least hash in every window and its leftmost position."""
    def lower(x, y):
        c = y[0] < x[0]
        return np.where(c, y[0], x[0]), np.where(c, y[1], x[1])

    a, s = (h, np.arange(len(h), dtype=np.int32)), 1
    while 2 * s <= OFFSETS:
        a = lower((a[0][:-s], a[1][:-s]), (a[0][s:], a[1][s:]))
        s *= 2
    if s < OFFSETS:
        r = OFFSETS - s
        a = lower((a[0][:-r], a[1][:-r]), (a[0][r:], a[1][r:]))
    return a


def blocks(text: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """The text in pieces that together hold every window once."""
    b = np.frombuffer(text, np.uint8)
    for a in range(0, len(b) - LENGTH + 1, BLOCK):
        yield a, b[a:a + BLOCK + LENGTH - 1]


def anchor_hashes(text: bytes) -> np.ndarray:
    """Sorted distinct 48-bit anchor hashes."""
    found = [np.unique(least(piece_hashes(b)) >> U(16)) for _, b in blocks(text)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def pack48(v: np.ndarray) -> bytes:
    return np.ascontiguousarray(v.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpack48(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel().astype(np.uint64)


def squeeze(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


def expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _runs(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(x)), bool), x[1:] != x[:-1]]))


SENT = "bucket int, kind int, head binary, body binary"
SENT_TYPES = (pa.int32(), pa.int32(), pa.binary(), pa.binary())


def _batch(rows: list[tuple], names, types) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(names), types)], list(names))


def _sent(rows) -> pa.RecordBatch:
    return _batch(rows, ("bucket", "kind", "head", "body"), SENT_TYPES)


def compressed(docs: DataFrame, id_col: str, text_col: str, names: dict[str, str]) -> DataFrame:
    """``docs`` without the text but with it compressed, and 32 bits of its hash."""
    at = docs.columns.index(text_col)
    rest = [i for i in range(len(docs.columns)) if i != at]

    def run(batches):
        for batch in batches:
            z, th = [], []
            for x in batch.column(at):
                raw = (x.as_py() or "").encode()
                z.append(zstandard.ZstdCompressor(level=1).compress(raw))
                th.append(xxhash.xxh32_intdigest(raw))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in rest), pa.array(z, pa.binary()), pa.array(th, pa.int64())],
                [*(batch.schema.names[i] for i in rest), names["z"], names["th"]])

    return docs.mapInArrow(run, T.StructType([
        *(docs.schema.fields[i] for i in rest), T.StructField(names["z"], T.BinaryType()),
        T.StructField(names["th"], T.LongType())]))


def _dealt(doc, th, items: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Items (rows of bytes) of documents, packed into one row per bucket of ids."""
    bucket = doc % buckets
    order = np.lexsort((th, doc, bucket))
    doc, th, items, bucket = doc[order], th[order], items[order], bucket[order]
    edge = np.searchsorted(bucket, np.arange(buckets + 1))
    rows = []
    for b in range(buckets):
        o = slice(edge[b], edge[b + 1])
        if edge[b] < edge[b + 1]:
            begin = _document_runs(doc[o], th[o])
            count = np.diff(np.append(begin, edge[b + 1] - edge[b]))
            rows.append((b, 0, squeeze(doc[o][begin], th[o][begin], count), items[o].tobytes()))
    return _sent(rows)


def _document_runs(doc: np.ndarray, th: np.ndarray) -> np.ndarray:
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (th[1:] != th[:-1])
    return np.flatnonzero(new)


def per_document(dealt: DataFrame, buckets: int, width: int, name: str) -> DataFrame:
    """(``d``, ``th``, ``name``): all items of a document in one row, from ``_dealt`` rows.
    Rows of kind 1 hold items with a count and come out one by one, without ``d`` and with
    the count as ``th``."""
    names, types = ("d", "th", name), (pa.int64(), pa.int64(), pa.binary())

    def run(batches):
        docs, ths, items = [], [], []
        for batch in batches:
            for kind, head, body in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                if kind:
                    n = np.frombuffer(expand(head), np.int64).tolist()
                    yield _batch([(None, x, body[i * width:(i + 1) * width]) for i, x in enumerate(n)], names, types)
                    continue
                h = np.frombuffer(expand(head), np.int64).reshape(3, -1)
                docs.append(np.repeat(h[0], h[2]))
                ths.append(np.repeat(h[1], h[2]))
                items.append(np.frombuffer(body, np.uint8).reshape(-1, width))
        if not docs:
            return
        doc, th, item = np.concatenate(docs), np.concatenate(ths), np.concatenate(items)
        order = np.lexsort((th, doc))
        doc, th, item = doc[order], th[order], item[order]
        begin = _document_runs(doc, th)
        edge = np.append(begin, len(doc)).tolist()
        for part in np.array_split(np.arange(len(begin)), max(1, len(begin) // 1024)):
            yield _batch([(int(doc[edge[i]]), int(th[edge[i]]), item[edge[i]:edge[i + 1]].tobytes())
                          for i in part.tolist()], names, types)

    return dealt.repartition(buckets, "bucket").mapInArrow(run, f"d long, th long, {name} binary")


def _grouped(ids: np.ndarray, values: np.ndarray):
    """Sorted by id: (ids, counts, values in order of the ids)."""
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    begin = _runs(ids)
    return ids[begin], np.diff(np.append(begin, len(ids))), values[order]


def shared_hashes(docs: DataFrame, id_col: str, text_col: str, wide: int = WIDE) -> DataFrame:
    """(``d``, ``th``, ``vals``): anchor hashes of a document that another one also has. Rows
    without ``d`` hold one hash of ``wide`` documents or more, ``th`` of them to within a half."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("d"),
                                                       F.col(text_col).alias("text"))

    def flush(ids, found):
        v = np.concatenate(found)
        doc = np.repeat(np.array(ids, np.int64), [len(x) for x in found])
        order = np.lexsort((doc, v))
        v, doc = v[order], doc[order]
        new = np.ones(len(v), bool)
        new[1:] = (v[1:] != v[:-1]) | (doc[1:] != doc[:-1])
        v, doc = v[new], doc[new]
        begin = _runs(v)
        count = np.diff(np.append(begin, len(v)))
        wide = np.repeat(count > 1, count)
        rows = []
        settled = _grouped(doc[wide], v[wide])
        for part in np.array_split(np.arange(len(settled[0])), max(1, len(settled[0]) // 256)):
            if len(part):
                a, b = settled[1][:part[0]].sum(), settled[1][:part[-1] + 1].sum()
                rows.append((int(settled[0][part[0]] % buckets), 1,
                             squeeze(settled[0][part], settled[1][part]), pack48(settled[2][a:b])))
        power = -np.floor(np.log2(count)).astype(np.int64)  # of several documents only the number's size is sent
        v, doc = v[begin], np.where(count > 1, power, doc[begin])
        tag = np.where(count > 1, power, np.searchsorted(np.unique(doc), doc))  # keeps equal ids together
        order = np.lexsort((tag, v % U(buckets)))
        v, doc, tag = v[order], doc[order], tag[order]
        edge = np.searchsorted((v % U(buckets)).astype(np.int64), np.arange(buckets + 1))
        for b in range(buckets):
            lo, hi = edge[b], edge[b + 1]
            if lo < hi:
                begin = _runs(tag[lo:hi])
                rows.append((b, 0, squeeze(doc[lo:hi][begin], tag[lo:hi][begin], np.diff(np.append(begin, hi - lo))),
                             pack48(v[lo:hi])))
        return _sent(rows)

    def send(batches):
        ids, found, held, size = [], [], 0, 0
        for batch in batches:
            for d, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = (text.as_py() or "").encode()
                x = anchor_hashes(raw)
                if len(x):
                    ids.append(d)
                    found.append(x)
                    held += len(x)
                if held >= FLUSH_HASHES:
                    yield flush(ids, found)
                    ids, found, held = [], [], 0
        if ids:
            yield flush(ids, found)

    def answer(batches):
        docs_, tags, vals, found = [], [], [], []
        for batch in batches:
            for kind, head, body in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                h = np.frombuffer(expand(head), np.int64).reshape(2 if kind else 3, -1)
                if kind:
                    found.append((np.repeat(h[0], h[1]), unpack48(body)))
                else:
                    docs_.append(np.repeat(h[0], h[2]))
                    tags.append(np.repeat(h[1], h[2]))
                    vals.append(unpack48(body))
        if docs_:
            doc, tag, v = np.concatenate(docs_), np.concatenate(tags), np.concatenate(vals)
            order = np.argsort(v, kind="stable")
            doc, tag, v = doc[order], tag[order], v[order]
            begin = _runs(v)
            count = np.diff(np.append(begin, len(v)))
            # several entries of one document (its id repeats) do no harm: this is a filter
            some = np.repeat(count > 1, count) & (tag >= 0)
            found.append((doc[some], v[some]))
            have = np.add.reduceat(1 << -np.minimum(tag, 0), begin)
            over = np.flatnonzero(have >= wide)
            for part in np.array_split(over, max(1, len(over) // 1024)):
                if len(part):
                    yield _sent([(int(v[begin[part[0]]] % U(buckets)), 1, squeeze(have[part]), pack48(v[begin[part]]))])
        if found:
            doc, v = (np.concatenate(x) for x in zip(*found))
            yield _dealt(doc, np.zeros_like(doc), np.frombuffer(pack48(v), np.uint8).reshape(-1, 6), buckets)

    sent = own.mapInArrow(send, SENT).repartition(buckets, "bucket")
    return per_document(sent.mapInArrow(answer, SENT), buckets, 6, "vals")


def widest(shared: DataFrame) -> np.ndarray:
    """Sorted hashes of the (at most ``WIDE_MOST``) anchors that most documents have."""
    rows = shared.where(F.col("d").isNull()).orderBy(F.desc("th"), "vals").limit(WIDE_MOST).select("vals").collect()
    return np.sort(unpack48(b"".join(bytes(r[0]) for r in rows)))


def segments_of(text: bytes, shared: np.ndarray):
    """Aligned bytes, first and last column, and first window of every segment whose
    anchor hash is among ``shared`` (sorted)."""
    for a, b in blocks(text):
        value, place = anchors(piece_hashes(b))
        first = _runs(place)
        last = np.append(first[1:], len(place)) - 1
        v = value[first] >> U(16)
        hit = np.searchsorted(shared, v)
        ok = shared[np.minimum(hit, len(shared) - 1)] == v
        first, last = first[ok], last[ok]
        if not len(first):
            continue
        p = place[first].astype(np.int64)
        pad = np.concatenate([np.zeros(OFFSETS - 1, np.uint8), b, np.zeros(COLUMNS, np.uint8)])
        rows = np.lib.stride_tricks.sliding_window_view(pad, COLUMNS)[p]
        lo = first - p + OFFSETS - 1
        hi = last + LENGTH - p + OFFSETS - 1
        column = np.arange(COLUMNS)
        rows = np.where((column >= lo[:, None]) & (column < hi[:, None]), rows, 0).astype(np.uint8)
        yield rows, lo.astype(np.uint8), hi.astype(np.uint8), first + a


def digests(rows: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits per segment, in two halves."""
    wide = np.zeros((len(rows), -(-COLUMNS // 8) * 8 + 8), np.uint8)
    wide[:, :COLUMNS], wide[:, -2], wide[:, -1] = rows, lo, hi
    return _halves(wide.view(np.uint64))


def window_digests(rows: np.ndarray, c: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits per window that begins at column ``c``, in two halves."""
    wide = np.zeros((len(rows), -(-LENGTH // 8) * 8), np.uint8)
    wide[:, :LENGTH] = rows[:, c:c + LENGTH]
    return _halves(wide.view(np.uint64))


def _halves(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    one, two = np.zeros(len(q), np.uint64), np.zeros(len(q), np.uint64)
    for i in range(q.shape[1]):
        one = mix(one + q[:, i] * U(0x9E3779B97F4A7C15))
        two = mix((two ^ q[:, i]) * U(0xC2B2AE3D27D4EB4F) + U(i))
    return one, two


def _anchor_key(rows: np.ndarray) -> np.ndarray:
    return piece_keys(np.ascontiguousarray(rows[:, OFFSETS - 1:OFFSETS - 1 + K]))


def piece_keys(pieces: np.ndarray) -> np.ndarray:
    q = pieces.view(np.uint64)
    h = mix((q[:, 0] ^ U(0x9E3779B97F4A7C15)) * U(0xC2B2AE3D27D4EB4F))
    return mix(h + q[:, 1] * U(0x165667B19E3779F9))


def _distinct(rows, lo, hi, doc):
    """Order by segment and document, where distinct segments begin, and each row's number."""
    return _classes(*digests(rows, lo, hi), doc)


def _classes(one, two, doc):
    order = np.lexsort((doc, two, one))
    one, two = one[order], two[order]
    new = np.ones(len(order), bool)
    new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    begin = np.flatnonzero(new)
    return order, begin, np.cumsum(new) - 1


def _least_id(one, two, doc) -> np.ndarray:
    """For every item the smallest id among those with its digest."""
    order, begin, number = _classes(one, two, doc)
    owner = np.empty(len(doc), np.int64)
    owner[order] = doc[order][begin][number]
    return owner


def _span_blobs(doc, th, start, stop, buckets) -> list[tuple]:
    """Spans packed by document, for any bucket."""
    order = np.lexsort((start, th, doc))
    doc, th, start, stop = doc[order], th[order], start[order], stop[order]
    begin = np.flatnonzero(np.concatenate([np.ones(min(1, len(doc)), bool), (doc[1:] != doc[:-1]) | (th[1:] != th[:-1])]))
    out = []
    for part in np.array_split(np.arange(len(begin)), max(1, len(begin) // 256)):
        if len(part):
            a = begin[part[0]]
            z = begin[part[-1] + 1] if part[-1] + 1 < len(begin) else len(doc)
            count = np.diff(np.append(begin[part], z))
            out.append((int(doc[a] % buckets), 1, squeeze(doc[begin[part]], th[begin[part]], count),
                        np.stack([start[a:z], stop[a:z]], 1).astype("<u4").tobytes()))
    return out


def window_owners(rows: np.ndarray, lo: np.ndarray, hi: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Rounds over aligned segments, last column first. For every column at which
    windows can begin: the smallest id that holds each segment's window there
    (NO_OWNER where the segment has none)."""
    n = len(rows)
    with tempfile.TemporaryFile() as columns:
        np.ascontiguousarray(rows.T[::-1]).tofile(columns)  # in the order in which they are read
        columns.seek(0)
        order, common = np.arange(n), np.zeros(n, np.uint8)
        for c in range(COLUMNS - 1, -1, -1):
            put = np.fromfile(columns, np.uint8, n)[order]  # the transform's column: what precedes each suffix
            to = np.argsort(put, kind="stable")
            symbol = put[to]
            after = np.zeros(n, np.uint8)
            same = np.flatnonzero(symbol[1:] == symbol[:-1]) + 1
            if len(same):
                # least common prefix between two neighbours' old places
                ends = np.stack([to[same - 1] + 1, to[same] + 1], 1).ravel()
                padded = np.append(common, np.uint8(255))
                after[same] = np.minimum.reduceat(padded, ends)[::2] + 1
            order, common = order[to], after
            if c < OFFSETS:
                yield c, _owners(order, common, c, lo, hi, doc)


def _owners(order, common, c, lo, hi, doc) -> np.ndarray:
    owner = np.full(len(order), NO_OWNER)
    at = np.flatnonzero((lo[order] <= c) & (c + LENGTH <= hi[order]))
    if len(at):
        # from one segment with a window here to the next: the least prefix in between
        ends = np.concatenate([[0], at + 1])
        prefix = np.minimum.reduceat(np.append(common, np.uint8(0)), ends)[:-1]
        begin = np.flatnonzero(np.concatenate([[True], prefix[1:] < LENGTH]))
        mine = order[at]
        low = np.minimum.reduceat(doc[mine], begin)
        owner[mine] = np.repeat(low, np.diff(np.append(begin, len(mine))))
    return owner


def hashed_owners(rows: np.ndarray, lo: np.ndarray, hi: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """What ``window_owners`` gives, from digests of the windows of one column after the other."""
    for c in range(OFFSETS - 1, -1, -1):
        at = np.flatnonzero((lo <= c) & (c + LENGTH <= hi))
        owner = np.full(len(rows), NO_OWNER)
        if len(at):
            owner[at] = _least_id(*window_digests(rows[at], c), doc[at])
        yield c, owner


def dealt_windows(rows, lo, hi, pos, doc, th, buckets: int) -> list[tuple]:
    """Windows of wide anchors, packed by digest; those with a smaller id in this task as spans."""
    first = np.full(len(doc), 255, np.int16)
    last = np.full(len(doc), -1, np.int16)
    out, held, n = [], [], 0

    def pack():
        one, two, d, t, at = (np.concatenate(x) for x in zip(*held))
        bucket = (one % U(buckets)).astype(np.int64)
        order = np.lexsort((at, t, d, two, one, bucket))
        one, two, d, t, at, bucket = (x[order] for x in (one, two, d, t, at, bucket))
        begin = _runs(bucket)
        for a, z in zip(begin, np.append(begin[1:], len(bucket))):
            o = slice(a, z)
            out.append((int(bucket[a]), 2, squeeze(d[o], t[o], at[o]), squeeze(one[o], two[o])))

    for c in range(OFFSETS - 1, -1, -1):
        at = np.flatnonzero((lo <= c) & (c + LENGTH <= hi))
        if not len(at):
            continue
        one, two = window_digests(rows[at], c)
        later = _least_id(one, two, doc[at]) < doc[at]
        gone, to = at[later], at[~later]
        first[gone] = c  # columns come in falling order
        last[gone] = np.maximum(last[gone], c)
        held.append((one[~later], two[~later], doc[to], th[to], pos[to] + c - lo[to]))
        n += len(to)
        if n >= WINDOWS:
            pack()
            held, n = [], 0
    if n:
        pack()
    hit = last >= 0
    base = pos[hit] - lo[hit]
    return out + _span_blobs(doc[hit], th[hit], base + first[hit], base + last[hit] + LENGTH, buckets)


def settle(rows, lo, hi, pos, doc, th):
    """Spans (document, hash, start, stop) to remove among segments that meet here."""
    order, begin, number = _distinct(rows, lo, hi, doc)
    rows, lo, hi, pos, doc, th = (x[order] for x in (rows, lo, hi, pos, doc, th))
    s_rows, s_lo, s_hi, s_doc = rows[begin], lo[begin], hi[begin], doc[begin]  # the smallest id comes first
    key = _anchor_key(s_rows)
    by_key = np.argsort(key, kind="stable")
    group = _runs(key[by_key])
    size = np.diff(np.append(group, len(by_key)))
    low = np.full(len(begin), 255, np.int16)  # columns of the first and last window to remove
    high = np.full(len(begin), -1, np.int16)
    first = np.full(len(doc), 255, np.int16)
    last = np.full(len(doc), -1, np.int16)
    alone = np.zeros(len(begin), bool)
    alone[by_key[group[size == 1]]] = True
    low[alone], high[alone] = s_lo[alone], s_hi[alone].astype(np.int16) - LENGTH
    single = alone[number] & (doc > s_doc[number])
    first[single], last[single] = low[number[single]], high[number[single]]

    several = np.flatnonzero(size > 1)
    edge = np.cumsum(size[several])
    a = 0
    while a < len(several):
        done = edge[a - 1] if a else 0
        z = max(a + 1, int(np.searchsorted(edge, done + CHUNK, side="right")))
        members = by_key[np.repeat(group[several[a:z]], size[several[a:z]])
                         + _steps(size[several[a:z]])]
        place = np.full(len(begin), -1)
        place[members] = np.arange(len(members))
        occ = np.flatnonzero(place[number] >= 0)
        of, occ_doc = place[number[occ]], doc[occ]
        owners = window_owners if len(members) <= CHUNK else hashed_owners
        for c, owner in owners(s_rows[members], s_lo[members], s_hi[members], s_doc[members]):
            gone = occ[owner[of] < occ_doc]
            first[gone] = c  # columns come in falling order
            last[gone] = np.maximum(last[gone], c)
        a = z
    hit = last >= 0
    base = pos[hit] - lo[hit]
    return doc[hit], th[hit], base + first[hit], base + last[hit] + LENGTH


def _steps(sizes: np.ndarray) -> np.ndarray:
    """0, 1, .. within each group."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def repeated_spans(texts: DataFrame, buckets: int, wide: np.ndarray) -> DataFrame:
    """(``d``, ``th``, ``spans``) from (``d``, ``th``, ``z``, ``vals``): spans to remove.
    ``wide``: sorted hashes of anchors whose windows are dealt out one by one."""
    def flush(held):
        rows, lo, hi, pos, doc, th = (np.concatenate(x) for x in held)
        order, begin, number = _distinct(rows, lo, hi, doc)
        rows, lo, hi, pos, doc, th = (x[order] for x in (rows, lo, hi, pos, doc, th))
        more = doc > doc[begin][number]  # a smaller id of this task has the whole segment
        out = _span_blobs(doc[more], th[more], pos[more],
                          pos[more] + hi[more].astype(np.int64) - lo[more], buckets)
        rows, lo, hi, pos, doc, th = (x[~more] for x in (rows, lo, hi, pos, doc, th))
        key = _anchor_key(rows) >> U(16)
        if len(wide):
            over = wide[np.minimum(np.searchsorted(wide, key), len(wide) - 1)] == key
            out += dealt_windows(*(x[over] for x in (rows, lo, hi, pos, doc, th)), buckets)
            rows, lo, hi, pos, doc, th, key = (x[~over] for x in (rows, lo, hi, pos, doc, th, key))
        bucket = (key % U(buckets)).astype(np.int64)
        order = np.lexsort((pos, th, doc, bucket))
        rows, lo, hi, pos, doc, th, bucket = (x[order] for x in (rows, lo, hi, pos, doc, th, bucket))
        edge = np.searchsorted(bucket, np.arange(buckets + 1))
        for b in range(buckets):
            if edge[b] < edge[b + 1]:
                o = slice(edge[b], edge[b + 1])
                out.append((b, 0, squeeze(doc[o], th[o].astype("<u4"), pos[o].astype("<u4"), lo[o], hi[o]),
                            squeeze(rows[o])))
        return _sent(out)

    def send(batches):
        held, n = [[] for _ in range(6)], 0
        for batch in batches:
            for d, th, z, vals in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                      batch.column(2), batch.column(3)):
                shared = np.unique(unpack48(vals.as_py()))
                if not len(shared):
                    continue
                for rows, lo, hi, first in segments_of(expand(z.as_py()), shared):
                    for x, y in zip(held, (rows, lo, hi, first, np.full(len(lo), d), np.full(len(lo), th))):
                        x.append(y)
                    n += len(lo)
                    if n >= FLUSH_SEGMENTS:
                        yield flush(held)
                        held, n = [[] for _ in range(6)], 0
        if n:
            yield flush(held)

    def work(batches):
        parts, windows, found = [[] for _ in range(6)], [], []
        for batch in batches:
            for kind, head, body in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                if kind == 2:
                    windows.append((*np.frombuffer(expand(body), np.uint64).reshape(2, -1),
                                    *np.frombuffer(expand(head), np.int64).reshape(3, -1)))
                    continue
                if kind:
                    h = np.frombuffer(expand(head), np.int64).reshape(3, -1)
                    found.append((np.repeat(h[0], h[2]), np.repeat(h[1], h[2]),
                                  np.frombuffer(body, np.uint8).reshape(-1, 8)))
                    continue
                rows = np.frombuffer(expand(body), np.uint8).reshape(-1, COLUMNS)
                h, n = expand(head), len(rows)
                for x, y in zip(parts, (
                        rows, np.frombuffer(h, np.uint8, n, 16 * n), np.frombuffer(h, np.uint8, n, 17 * n),
                        np.frombuffer(h, "<u4", n, 12 * n).astype(np.int64), np.frombuffer(h, np.int64, n),
                        np.frombuffer(h, "<u4", n, 8 * n).astype(np.int64))):
                    x.append(y)
        if parts[0]:
            doc, th, start, stop = settle(*(np.concatenate(x) for x in parts))
            found.append((doc, th, np.stack([start, stop], 1).astype("<u4").view(np.uint8).reshape(-1, 8)))
        if windows:
            one, two, doc, th, at = (np.concatenate(x) for x in zip(*windows))
            later = _least_id(one, two, doc) < doc
            at = at[later]
            found.append((doc[later], th[later], np.stack([at, at + LENGTH], 1).astype("<u4").view(np.uint8).reshape(-1, 8)))
        if found:
            yield _dealt(*(np.concatenate(x) for x in zip(*found)), buckets)

    sent = texts.mapInArrow(send, SENT).repartition(buckets, "bucket")
    return per_document(sent.mapInArrow(work, SENT), buckets, 8, "spans")


def cut_out(text: bytes, spans: bytes) -> tuple[int, int, bytes]:
    """Bytes removed, maximal removed runs, and the rest."""
    s = np.frombuffer(spans, "<u4").astype(np.int64).reshape(-1, 2)
    if not len(s):
        return 0, 0, text
    change = np.zeros(len(text) + 1, np.int64)
    np.add.at(change, s[:, 0], 1)
    np.add.at(change, s[:, 1], -1)
    gone = np.cumsum(change)[:-1] > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return int(gone.sum()), runs, np.frombuffer(text, np.uint8)[~gone].tobytes()


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", wide: int = WIDE) -> DataFrame:
    """``docs`` without the text, with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``
    (the remaining bytes), named anew if taken. Anchors of ``wide`` documents or more are
    dealt out by window; the result does not depend on it."""
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col} must be an integer column, not {docs.schema[id_col].dataType.simpleString()}")
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = {c: fresh(docs, c) for c in ("z", "th")}
    small = compressed(docs.select(id_col, text_col), id_col, text_col, names)
    shared = cut(shared_hashes(docs, id_col, text_col, wide), "anchors")
    lists = shared.where(F.col("d").isNotNull()).select(F.col("d").alias("_d"), "vals")
    texts = small.join(lists, F.col(id_col).cast("long") == F.col("_d")).select(
        F.col("_d").alias("d"), F.col(names["th"]).alias("th"), F.col(names["z"]).alias("z"), "vals")
    spans = cut(repeated_spans(texts, buckets, widest(shared)), "spans")
    per = spans.toDF("_d", "_th", "_spans")
    whole = compressed(docs, id_col, text_col, names)
    rest = [c for c in docs.columns if c != text_col]
    met = whole.join(per, (F.col(id_col).cast("long") == F.col("_d")) & (F.col(names["th"]) == F.col("_th")), "left")
    met = met.select(*[F.col(f"`{c}`") for c in rest], names["z"], "_spans")
    out = [fresh(docs, c) for c in ("n_bytes", "n_removed", "n_spans", "kept")]

    def run(batches):
        for batch in batches:
            rows = []
            for z, s in zip(batch.column(len(rest)), batch.column(len(rest) + 1)):
                text = expand(z.as_py())
                rows.append((len(text), *cut_out(text, s.as_py() or b"")))
            made = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4,
                                                   (pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(rest))), *made], [*rest, *out])

    return met.mapInArrow(run, T.StructType([
        *(docs.schema[c] for c in rest), *(T.StructField(c, T.LongType()) for c in out[:3]),
        T.StructField(out[3], T.BinaryType())]))


def op8(docs: DataFrame) -> DataFrame:
    """The digest row per document of the dealt query."""
    out = remove_repeats(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

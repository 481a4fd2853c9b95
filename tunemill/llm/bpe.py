"""Byte-level BPE encoding and decoding (operator 10).

Pre-tokenisation is vectorised and uses no regular expression. Each character
becomes a symbol (its class, with what follows it where the pattern looks
ahead), a symbol is a transition function on the states of one small automaton,
and function composition is associative: every block of a text is folded to one
composed function (an index into the table of all reachable functions), the
folded blocks are chained, and from the blocks' start states all blocks step at
once. Where a state and a symbol begin a match, a slice begins. Slices go
through a bounded cache of merged pieces; token ids leave as little-endian
unsigned 32-bit integers together with each token's byte offset, which decoding
uses to place all tokens' bytes in one gather.

Texts are read in place, there is no shuffle, and a task holds one group of
rows of about ``GROUP_BYTES`` (one row at least). The vocabulary (a given file,
refused above ``MAX_RANKS`` entries) and the class table (one byte per code
point, compressed) are all that is sent to the tasks.

Defined results: null and empty texts give no ids and decode to no bytes;
special-token strings are ordinary text; repeated rows are encoded each; other
columns are passed through, and the new columns are named anew if taken.
"""

from __future__ import annotations

import base64
import heapq
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh

MAX_RANKS = 1_000_000
GROUP_BYTES = 1 << 20
CACHE_PIECES = 200_000  # per generation; two generations are kept
CACHED_LENGTH = 64
LONG_PIECE = 128  # bytes from which merging uses a heap

# Character classes.
LETTER, NUMBER, OTHER, SPACE, WHITE = range(5)
# States: what the match that is under way may still take.
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, IN_WHITE, SUFFIX_1, SUFFIX_2 = range(8)
# Symbols: classes, apostrophes that begin a one- or two-letter suffix, and white
# space with what follows (a visible character, or white space or the end).
(S_LETTER, S_NUMBER, S_OTHER, S_APO_1, S_APO_2,
 S_SPACE_LAST, S_SPACE, S_WHITE_LAST, S_WHITE) = range(9)
N_STATES, N_SYMBOLS = 8, 9
# FIXED VALUES: the pattern's suffixes after an apostrophe.
SUFFIXES_1 = "stmd"
SUFFIXES_2 = ("re", "ve", "ll")


def step(state: int, symbol: int) -> tuple[int, bool]:
    """Next state, and whether a match begins at this symbol."""
    if state == SUFFIX_2:
        return SUFFIX_1, False
    if state == SUFFIX_1:
        return START, False
    if symbol == S_LETTER:
        return IN_LETTERS, state not in (IN_LETTERS, AFTER_SPACE)
    if symbol == S_NUMBER:
        return IN_NUMBERS, state not in (IN_NUMBERS, AFTER_SPACE)
    if symbol in (S_OTHER, S_APO_1, S_APO_2):
        if state in (IN_OTHERS, AFTER_SPACE):
            return IN_OTHERS, False
        return {S_OTHER: IN_OTHERS, S_APO_1: SUFFIX_1, S_APO_2: SUFFIX_2}[symbol], True
    if symbol == S_SPACE_LAST:
        return AFTER_SPACE, True
    if symbol == S_WHITE_LAST:
        return START, True
    return IN_WHITE, state != IN_WHITE


@lru_cache(1)
def automaton():
    """(next state, begins) by state and symbol, the function of each symbol, and
    the composition table of all reachable functions. A symbol plus N_SYMBOLS is
    the same symbol at the start of a text, whatever the state before."""
    steps = [[step(START if y >= N_SYMBOLS else s, y % N_SYMBOLS) for y in range(2 * N_SYMBOLS)]
             for s in range(N_STATES)]
    after = np.array([[x[0] for x in row] for row in steps], np.uint8)
    begins = np.array([[x[1] or y >= N_SYMBOLS for y, x in enumerate(row)] for row in steps])
    gens = [tuple(int(x) for x in after[:, y]) for y in range(2 * N_SYMBOLS)]
    index = {tuple(range(N_STATES)): 0}
    queue = list(index)
    for f in queue:
        for g in gens:
            h = tuple(g[x] for x in f)
            if h not in index:
                index[h] = len(index)
                queue.append(h)
    funcs = np.array(queue, np.uint8)
    compose = np.array([[index[tuple(int(g[x]) for x in f)] for g in queue] for f in queue],
                       np.int32)
    return after, begins, np.array([index[g] for g in gens], np.int32), compose, funcs


def match_starts(symbols: np.ndarray, block: int = 1024) -> np.ndarray:
    """Whether a match begins at each symbol, by a blocked scan of composed functions."""
    after, begins, gen, compose, funcs = automaton()
    n = len(symbols)
    if n == 0:
        return np.zeros(0, bool)
    rows = -(-n // block)
    grid = np.zeros(rows * block, np.uint8)
    grid[:n] = symbols
    grid = np.ascontiguousarray(grid.reshape(rows, block).T)  # one column of all blocks a step
    m = len(funcs)
    flat, folded = compose.ravel(), np.zeros(rows, np.int32)
    for line in grid:
        folded = flat[folded * m + gen[line]]
    state = np.zeros(rows, np.uint8)
    s = START
    for r, f in enumerate(folded.tolist()):
        state[r] = s
        s = funcs[f, s]
    width = 2 * N_SYMBOLS
    nxt, beg = after.ravel(), begins.ravel()
    out = np.empty(grid.shape, bool)
    cell = state.astype(np.int32)
    for k, line in enumerate(grid):
        at = cell * width + line
        out[k] = beg[at]
        cell = nxt[at].astype(np.int32)
    return out.T.ravel()[:n]


def class_table() -> bytes:
    """One class per code point, compressed. Taken from the tokenizer library's own
    classes, since Unicode versions differ between libraries."""
    import tiktoken

    points = np.array([c for c in range(0x110000) if not 0xD800 <= c < 0xE000], np.uint32)
    every = points.tobytes().decode("utf-32-le")
    single = {bytes([i]): i for i in range(256)}
    table = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", WHITE)):
        found = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single,
                                  special_tokens={}).encode_ordinary(every)
        table[np.frombuffer(bytes(found).decode().encode("utf-32-le"), np.uint32)] = kind
    table[0x20] = SPACE
    return zlib.compress(table.tobytes())


@lru_cache(2)
def _classes(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), np.uint8)


def slice_starts(buf: bytes, first_bytes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Byte positions where matches begin in concatenated texts; ``first_bytes``
    are the byte positions at which the (non-empty) texts begin."""
    raw = np.frombuffer(buf, np.uint8)
    char_at = np.flatnonzero((raw & 0xC0) != 0x80)
    points = np.frombuffer(buf.decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(points)
    first = np.zeros(n + 1, bool)
    first[np.searchsorted(char_at, first_bytes)] = True
    first[n] = True
    kind = classes[points]
    white = kind >= SPACE
    follows = np.ones(n, bool)  # white space or the text's end follows
    follows[:-1] = white[1:] | first[1:n]
    symbols = kind.copy()  # LETTER, NUMBER, OTHER are their own symbols
    symbols[kind == SPACE] = S_SPACE_LAST
    symbols[kind == WHITE] = S_WHITE_LAST
    symbols[white & follows] += 1
    apo = np.flatnonzero(points == ord("'"))
    if len(apo):
        pad = np.concatenate([points, np.zeros(2, np.uint32)])
        gap = np.concatenate([first, np.ones(2, bool)])  # a text begins here or beyond the end
        one, two = pad[apo + 1], pad[apo + 2]
        in_1, in_2 = ~gap[apo + 1], ~gap[apo + 1] & ~gap[apo + 2]
        is_1 = in_1 & np.isin(one, [ord(c) for c in SUFFIXES_1])
        is_2 = np.zeros(len(apo), bool)
        for a, b in SUFFIXES_2:
            is_2 |= in_2 & (one == ord(a)) & (two == ord(b))
        symbols[apo[is_1]] = S_APO_1
        symbols[apo[is_2]] = S_APO_2
    symbols[first[:n]] += N_SYMBOLS
    return char_at[match_starts(symbols)]


NO_PAIR = 1 << 40


def pair_ranks(ranks: dict[bytes, int]) -> dict[int, int]:
    """Rank of two adjacent tokens' concatenation, by ``left * 2**20 + right``."""
    get, pairs = ranks.get, {}
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            a, b = get(token[:i]), get(token[i:])
            if a is not None and b is not None:
                pairs[a << 20 | b] = rank
    return pairs


def merge(piece: bytes, ranks: dict[bytes, int], pairs: dict[int, int]) -> list[int]:
    """Token ids of one slice: the lowest-ranked adjacent pair merges first, the
    leftmost among equals."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    ids = [ranks[piece[i:i + 1]] for i in range(len(piece))]
    if len(piece) >= LONG_PIECE:
        return merge_long(ids, pairs)
    get = pairs.get
    near = [get(a << 20 | b, NO_PAIR) for a, b in zip(ids, ids[1:])]
    while near:
        low = min(near)
        if low == NO_PAIR:
            break
        i = near.index(low)
        ids[i] = low
        del ids[i + 1], near[i]
        if i < len(near):
            near[i] = get(low << 20 | ids[i + 1], NO_PAIR)
        if i:
            near[i - 1] = get(ids[i - 1] << 20 | low, NO_PAIR)
    return ids


def merge_long(ids: list[int], pairs: dict[int, int]) -> list[int]:
    """The same by a heap over a linked list, n log n for very long slices."""
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(pairs[k], i, k) for i in range(n - 1) if (k := ids[i] << 20 | ids[i + 1]) in pairs]
    heapq.heapify(heap)
    while heap:
        rank, i, k = heapq.heappop(heap)
        j = after[i]
        if ids[i] < 0 or j >= n or ids[i] << 20 | ids[j] != k:
            continue  # one of the two has merged meanwhile
        ids[i], ids[j] = rank, -1
        after[i] = nxt = after[j]
        if nxt < n:
            before[nxt] = i
            if (k := rank << 20 | ids[nxt]) in pairs:
                heapq.heappush(heap, (pairs[k], i, k))
        if (p := before[i]) >= 0 and (k := ids[p] << 20 | rank) in pairs:
            heapq.heappush(heap, (pairs[k], p, k))
    return [x for x in ids if x >= 0]


class PieceCache(dict):
    """Slice -> its ids as bytes. Two bounded generations: a full one becomes the
    older, from which slices still in use come back."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.pairs, self.older = ranks, pair_ranks(ranks), {}

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = array("I", merge(piece, self.ranks, self.pairs))
            if sys.byteorder == "big":
                ids.byteswap()
            ids = ids.tobytes()
        if len(piece) <= CACHED_LENGTH:
            if len(self) >= CACHE_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


@lru_cache(2)
def _vocabulary(ranks_file: bytes):
    ranks = {base64.b64decode(a): int(b)
             for a, b in (line.split() for line in zlib.decompress(ranks_file).splitlines() if line)}
    by_id = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        by_id[i] = token
    size = np.array([len(t) for t in by_id], np.int64)
    at = np.concatenate([[0], np.cumsum(size)[:-1]])
    return PieceCache(ranks), np.frombuffer(b"".join(by_id), np.uint8), at, size


def read_ranks(path: str) -> bytes:
    """The vocabulary file (lines of base64 token and rank), checked and compressed."""
    with open(path, "rb") as f:
        raw = f.read()
    n = raw.count(b"\n") + 1
    if n > MAX_RANKS:
        raise ValueError(f"{n} ranks; at most {MAX_RANKS} are sent to the tasks")
    return zlib.compress(raw, 1)


def encode_texts(texts: list[bytes], ranks_file: bytes, packed: bytes):
    """Per text: ids and byte offsets of the tokens, both little-endian unsigned 32-bit."""
    cache, _, _, size = _vocabulary(ranks_file)
    lengths = np.array([len(t) for t in texts], np.int64)
    begin = np.concatenate([[0], np.cumsum(lengths)])
    buf = b"".join(texts)
    if not buf:
        return [b""] * len(texts), [b""] * len(texts)
    starts = slice_starts(buf, begin[:-1][lengths > 0], _classes(packed))
    cuts = starts.tolist()
    parts = list(map(cache.__getitem__, [buf[a:b] for a, b in zip(cuts, [*cuts[1:], len(buf)])]))
    edge = np.searchsorted(starts, begin).tolist()
    ids = [b"".join(parts[a:b]) for a, b in zip(edge, edge[1:])]
    offsets = []
    for x in ids:
        own = size[np.frombuffer(x, "<u4")]
        offsets.append((np.cumsum(own) - own).astype("<u4").tobytes())
    return ids, offsets


def decode_ids(ids: bytes, offsets: bytes, ranks_file: bytes) -> bytes:
    """All tokens' bytes, placed by their retained offsets in one gather."""
    _, flat, at, size = _vocabulary(ranks_file)
    t = np.frombuffer(ids, "<u4")
    if not len(t):
        return b""
    own = size[t]
    to = np.frombuffer(offsets, "<u4").astype(np.int64)
    source = np.arange(int(to[-1] + own[-1])) + np.repeat(at[t] - to, own)
    return flat[source].tobytes()


def _groups(lengths: list[int]) -> Iterator[tuple[int, int]]:
    """Row ranges of about GROUP_BYTES."""
    a = total = 0
    for i, n in enumerate(lengths):
        if i > a and total + n > GROUP_BYTES:
            yield a, i
            a, total = i, 0
        total += n
    if a < len(lengths):
        yield a, len(lengths)


def _add_columns(batch: pa.RecordBatch, names: list[str], columns: list[pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *names])


def _per_group(df: DataFrame, columns: list[str], new: list[str], work) -> DataFrame:
    """``df`` with binary columns ``new`` that ``work`` makes of the values of ``columns``,
    for one group of rows at a time."""
    at = [df.columns.index(c) for c in columns]

    def run(batches):
        for batch in batches:
            lengths = [x or 0 for x in pa.compute.binary_length(batch.column(at[0])).to_pylist()]
            for a, b in _groups(lengths):
                own = batch.slice(a, b - a)
                values = [[x or b"" for x in own.column(i).cast(pa.binary()).to_pylist()] for i in at]
                yield _add_columns(own, new, [pa.array(x, pa.binary()) for x in work(*values)])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *(T.StructField(n, T.BinaryType()) for n in new)]))


def encode(df: DataFrame, ranks_path: str, text_col: str = "text") -> DataFrame:
    """``df`` with ``ids`` and ``offsets`` (binary, unsigned 32-bit little-endian)."""
    ranks_file, packed = read_ranks(ranks_path), class_table()
    return _per_group(df, [text_col], [fresh(df, "ids"), fresh(df, "offsets")],
                      lambda texts: encode_texts(texts, ranks_file, packed))


def decode(df: DataFrame, ranks_path: str, ids_col: str = "ids",
           offsets_col: str = "offsets") -> DataFrame:
    """``df`` with ``decoded``, the bytes of the ids."""
    ranks_file = read_ranks(ranks_path)
    return _per_group(df, [ids_col, offsets_col], [fresh(df, "decoded")],
                      lambda ids, offsets: [[decode_ids(x, y, ranks_file) for x, y in zip(ids, offsets)]])


def round_trip(df: DataFrame, ranks_path: str, text_col: str = "text") -> DataFrame:
    """Encoding followed by decoding, in one pass: ``ids``, ``offsets``, ``decoded``."""
    ranks_file, packed = read_ranks(ranks_path), class_table()

    def work(texts):
        ids, offsets = encode_texts(texts, ranks_file, packed)
        return ids, offsets, [decode_ids(x, y, ranks_file) for x, y in zip(ids, offsets)]

    return _per_group(df, [text_col], [fresh(df, c) for c in ("ids", "offsets", "decoded")], work)


def op10(spark: SparkSession, docs: DataFrame, ranks_path: str) -> DataFrame:
    """The digest row per document of the dealt query."""
    out = round_trip(docs.select("doc_id", "text"), ranks_path)
    return out.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))

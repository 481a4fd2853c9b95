"""Vocabulary, encoding, truncation, padding, masking and decoding.

Design for scale:
* Tokenizing is ``regexp_extract_all`` in the JVM (whole-stage codegen).
* Encoding maps a row's token array to its id array in one Arrow-vectorised
  step, and decoding the reverse: no row is exploded, shuffled or regrouped, so
  no key is needed and repeated rows stay apart.
* The vocabulary is a table of at most ``MAX_VOCAB`` rows; a larger one is refused
  with an error. It travels with the tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import (LABEL_IGNORE, SPECIAL_TOKENS, UNK_TOKEN_ID, SftConfig)
from ..functions.text import tokenize

MAX_VOCAB = 1_000_000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --------------------------------------------------------------------- T2
def build_vocab(texts: DataFrame, text_cols, vocab_size: int) -> DataFrame:
    """Vocabulary ``(token, id, n)``: reserved tokens first with fixed ids,
    then the most frequent tokens (count desc, token asc) up to ``vocab_size``.

    One pass: the token counts (partial aggregation, hash-partitioned by
    token) meet the reserved tokens in a full outer join, so reserved tokens
    are present even when never seen; one bounded top-``vocab_size`` selection
    puts them first and numbers everything.
    """
    if isinstance(text_cols, str):
        text_cols = [text_cols]
    if vocab_size < len(SPECIAL_TOKENS):
        raise ValueError(f"vocab_size must be at least {len(SPECIAL_TOKENS)}")
    toks = texts.select(F.explode(F.concat(*[tokenize(c) for c in text_cols])).alias("token"))
    counts = toks.groupBy("token").agg(F.count(F.lit(1)).alias("n"))  # partial agg map-side
    specials = texts.sparkSession.createDataFrame(
        [(t, i) for i, t in enumerate(SPECIAL_TOKENS)], "token string, sid int")
    order = [F.col("sid").asc_nulls_last(), F.desc("n"), F.asc("token")]
    top = (counts.join(specials, "token", "full_outer")
           .select("token", "sid", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
           .orderBy(*order).limit(vocab_size))  # TakeOrderedAndProject: bounded
    # row_number over at most vocab_size rows (after the limit); reserved
    # tokens come first in sid order, so their ids are their fixed ids
    return top.select("token", (F.row_number().over(Window.orderBy(*order)) - 1)
                      .cast("int").alias("id"), "n")


# --------------------------------------------------------------------- T1
def read_vocab(vocab: DataFrame) -> tuple[pa.Array, np.ndarray]:
    """Tokens and their ids, checked against ``MAX_VOCAB``."""
    rows = vocab.select("token", "id").limit(MAX_VOCAB + 1).collect()
    if len(rows) > MAX_VOCAB:
        raise ValueError(f"the vocabulary has more than {MAX_VOCAB} tokens")
    return pa.array([r["token"] for r in rows], pa.string()), np.array([r["id"] for r in rows], np.int64)


def _map_arrays(df: DataFrame, col: str, out_col: str, of: T.DataType, look_up) -> DataFrame:
    """``df`` with ``col`` replaced by ``out_col``: ``look_up`` of all elements of an
    Arrow batch at once, cut into rows as before (a null array becomes empty)."""
    at = df.columns.index(col)
    rest = [i for i in range(len(df.columns)) if i != at]
    schema = T.StructType([*(df.schema.fields[i] for i in rest), T.StructField(out_col, T.ArrayType(of))])

    def run(batches):
        for batch in batches:
            lists = batch.column(at)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            made = pa.ListArray.from_arrays(pa.array(ends), look_up(lists.flatten()))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in rest), made],
                                             [*(batch.schema.names[i] for i in rest), out_col])

    return df.mapInArrow(run, schema)


def encode_tokens(df: DataFrame, tokens_col: str, vocab: DataFrame, out_col: str = "ids",
                  unk_id: int = UNK_TOKEN_ID) -> DataFrame:
    """The token array ``tokens_col`` of every row as vocabulary ids; other columns stay."""
    tokens, ids = read_vocab(vocab)
    known = dict(zip(tokens.to_pylist(), ids.tolist()))

    def look_up(flat):  # each distinct token of a batch once
        coded = flat.dictionary_encode()
        found = np.array([known.get(t, unk_id) for t in coded.dictionary.to_pylist()], np.int64)
        at = coded.indices.to_numpy(zero_copy_only=False)
        return pa.array(found[at] if len(found) else np.zeros(0, np.int64), pa.int64())

    return _map_arrays(df, tokens_col, out_col, T.LongType(), look_up)


def tokenize_pair(df: DataFrame, max_len: int | None) -> DataFrame:
    """Token arrays of prompt and answer, encoded once each.

    ``tokens(prompt + answer) = tokens(prompt) ++ tokens(answer)`` holds for the
    built-in tokenizer at every template boundary (the prompt ends in a space or
    a marker), so the prompt is not encoded twice. Only the first ``max_len``
    tokens are carried further; the full counts are kept as columns.
    """
    pt = tokenize("prompt")
    at = tokenize("answer")
    out = (df.withColumn("_pt", pt).withColumn("_at", at)
           .withColumn("prompt_tokens", F.size("_pt"))
           .withColumn("n_tokens", F.size("_pt") + F.size("_at")))
    full = F.concat("_pt", "_at")
    if max_len is not None:
        full = F.slice(full, 1, max_len)  # T3 before any per-token work
    return out.withColumn("_tok", full).drop("_pt", "_at")


# --------------------------------------------------------------- T3-T9, T16
def pad_right(ids: Column, n: int, pad_id) -> Column:
    """T4: pad to ``n`` on the right (T3 truncation first)."""
    t = F.slice(ids, 1, n)
    return F.concat(t, F.array_repeat(F.lit(pad_id).cast("long"), F.lit(n) - F.size(t)))


def attention_mask(k: Column, n) -> Column:
    """``k`` ones then zeros up to ``n``."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.concat(F.array_repeat(F.lit(1).cast("long"), k),
                    F.array_repeat(F.lit(0).cast("long"), n - k))


def mask_labels(ids: Column, prompt_len: Column, real_len: Column | None) -> Column:
    """The first ``prompt_len`` labels are -100; with ``real_len`` given,
    positions at or after it (padding) are -100 as well."""
    def f(x, i):
        cond = i < prompt_len
        if real_len is not None:
            cond = cond | (i >= real_len)
        return F.when(cond, F.lit(LABEL_IGNORE).cast("long")).otherwise(x)
    return F.transform(ids, f)


def encode_ids(df: DataFrame, vocab: DataFrame, cfg: SftConfig) -> DataFrame:
    """``prompt`` and ``answer`` replaced by ``ids`` (truncated, unpadded), ``length``,
    ``prompt_len`` (T8b: prompt tokens, capped at max_len), ``prompt_tokens`` (T8c:
    uncapped) and ``n_tokens`` (untruncated). Other columns stay; no key is needed."""
    base = tokenize_pair(df, cfg.max_len).drop("prompt", "answer")
    enc = encode_tokens(base, "_tok", vocab, "ids", cfg.unk_id)
    return (enc.withColumn("length", F.size("ids"))
            .withColumn("prompt_len", F.least(F.col("prompt_tokens"), F.lit(cfg.max_len))))


def pad_and_mask(enc: DataFrame, cfg: SftConfig, pad: bool = True) -> DataFrame:
    """``ids`` replaced by ``input_ids``, ``attention_mask`` and ``labels`` (array<bigint>),
    padded to ``max_len``, or ragged (T5)."""
    n = cfg.max_len
    if pad:
        input_ids = pad_right(F.col("ids"), n, cfg.effective_pad_id)
        mask = attention_mask(F.col("length"), n)
        labels = mask_labels(input_ids, F.col("prompt_len"), F.col("length") if cfg.mask_padding else None)
    else:
        input_ids = F.col("ids")
        mask = F.array_repeat(F.lit(1).cast("long"), F.col("length"))
        labels = mask_labels(input_ids, F.least(F.col("prompt_len"), F.col("length")), None)
    rest = [c for c in enc.columns if c != "ids"]
    return enc.select(*rest, input_ids.alias("input_ids"), mask.alias("attention_mask"), labels.alias("labels"))


def encode_examples(df: DataFrame, vocab: DataFrame, cfg: SftConfig, key: str | None = "example_id",
                    pad: bool = True, carry=()) -> DataFrame:
    """Encoded, masked training rows from rendered ``prompt``/``answer``: key (or
    ``key=None``: none is needed), carried columns, ``input_ids``, ``attention_mask``,
    ``labels``, ``prompt_len``, ``prompt_tokens``, ``n_tokens`` and ``length``.
    ``pad=False`` gives ragged rows (T5)."""
    kept = [*([key] if key else []), *carry]
    enc = pad_and_mask(encode_ids(df.select(*kept, "prompt", "answer"), vocab, cfg), cfg, pad)
    return enc.select(*kept, "input_ids", "attention_mask", "labels", "prompt_len", "prompt_tokens",
                      "n_tokens", "length")


def prompt_len_padded(prompt_ids_padded: Column, pad_id: int) -> Column:
    """T8a with F3: count of ids that differ from the pad id."""
    return F.size(F.filter(prompt_ids_padded, lambda x: x != F.lit(pad_id)))


# --------------------------------------------------------------------- T11
def decode_parts(df: DataFrame, ids_col: str, vocab: DataFrame) -> DataFrame:
    """ids -> ``_dec``: array of (pos, id, token) in position order; ids outside the
    vocabulary decode to ``<unk>``. Texts are cut from it with ``join_tokens``."""
    tokens, ids = read_vocab(vocab)
    value_set = pa.array(ids, pa.int64())
    unk = SPECIAL_TOKENS[UNK_TOKEN_ID]

    def look_up(flat):
        return pc.fill_null(tokens.take(pc.index_in(flat.cast(pa.int64()), value_set=value_set)), unk)

    others = [c for c in df.columns if c != ids_col]
    d = _map_arrays(df.withColumn("_copy", F.col(ids_col)), "_copy", "_tokens", T.StringType(), look_up)
    return d.select(*others, F.transform(F.arrays_zip(F.col(ids_col).alias("id"), F.col("_tokens").alias("token")),
                                         lambda x, i: F.struct(i.alias("pos"), x["id"].alias("id"),
                                                               x["token"].alias("token"))).alias("_dec"))


def join_tokens(dec="_dec", skip_special: bool = True, lo=None, hi=None) -> Column:
    """Text of the decoded tokens with ``lo <= pos < hi``, joined by one space;
    reserved tokens dropped when ``skip_special``."""
    def keep(x):
        c = F.lit(True)
        if skip_special:
            c = c & (x["id"] >= len(SPECIAL_TOKENS))
        if lo is not None:
            c = c & (x["pos"] >= lo)
        if hi is not None:
            c = c & (x["pos"] < hi)
        return c
    return F.array_join(F.transform(F.filter(_c(dec), keep), lambda x: x["token"]), " ")


def decode_ids(df: DataFrame, ids_col: str, vocab: DataFrame,
               out_col: str = "text", skip_special: bool = True) -> DataFrame:
    """Ids -> text (tokens joined by one space)."""
    d = decode_parts(df, ids_col, vocab)
    return d.withColumn(out_col, join_tokens("_dec", skip_special)).drop("_dec")


def ids_text(col) -> Column:
    """Arrays leave queries as space-joined strings (stable value hashes)."""
    return F.array_join(_c(col), " ")

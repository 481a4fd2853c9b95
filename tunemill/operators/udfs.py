"""User functions over rows (X1), external tokenizers (X2), batch generation.

All three run over Arrow batches (``mapInPandas``, ``mapInArrow``), one Python worker per task,
state (tokenizer, model) loaded once per worker. Prompt building and prompt
stripping stay in Spark; only the user's code runs in Python. X1 and X2 hand a batch on in
pieces, so what a worker holds beside the batch does not grow with the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import SPECIAL_TOKENS, TOKEN_PATTERN, UNK_TOKEN_ID

PIECE_ROWS = 512  # rows handed to a user's function at once
PIECE_BYTES = 1 << 20  # text handed to a tokenizer at once; a longer row is a piece of its own


def map_rows(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema) -> DataFrame:
    """``fn`` maps a pandas batch to a pandas batch with ``schema``'s columns
    (the reference's ``ds.map(fn, remove_columns=...)``), ``PIECE_ROWS`` rows at a time."""
    names = schema.fieldNames() if isinstance(schema, T.StructType) else None

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for at in range(0, max(1, len(pdf)), PIECE_ROWS):
                out = fn(pdf.iloc[at:at + PIECE_ROWS].reset_index(drop=True))
                yield out[names] if names else out
    return df.mapInPandas(run, schema)


# ------------------------------------------------------------------- X2
def _pieces(batch: pa.RecordBatch, cols) -> Iterator[pa.RecordBatch]:
    """``batch`` cut into runs of at most ``PIECE_ROWS`` rows and ``PIECE_BYTES`` of text in ``cols``."""
    sizes = sum(pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                for c in cols)
    ends, at = np.cumsum(sizes), 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        end = min(max(at + 1, int(np.searchsorted(ends, before + PIECE_BYTES, "right"))), at + PIECE_ROWS, batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def _encoded(tok, texts: pa.Array) -> list[np.ndarray]:
    """The ids of every text (null: of an empty one), without the tokenizer's other findings."""
    made = tok.encode_batch(pc.fill_null(texts, "").to_pylist(), add_special_tokens=False)
    return [np.array(e.ids, np.int64) for e in made]


_TOKENIZERS: dict[str, object] = {}


def word_level_tokenizer_from_vocab(vocab_path: str):
    """A word-level tokenizer (``tokenizers`` library) over a vocabulary table
    written as parquet in the shared folder; built once per Python worker."""
    tok = _TOKENIZERS.get(vocab_path)
    if tok is None:
        import pyarrow.parquet as pq
        from tokenizers import Regex, Tokenizer, pre_tokenizers
        from tokenizers.models import WordLevel
        t = pq.read_table(vocab_path, columns=["token", "id"])
        vocab = dict(zip(t.column("token").to_pylist(), t.column("id").to_pylist()))
        tok = Tokenizer(WordLevel(vocab=vocab, unk_token=SPECIAL_TOKENS[UNK_TOKEN_ID]))
        tok.pre_tokenizer = pre_tokenizers.Split(Regex(TOKEN_PATTERN), behavior="removed",
                                                 invert=True)
        _TOKENIZERS[vocab_path] = tok
    return tok


def tokenizer_from_file(path: str):
    """Any serialized ``tokenizers`` tokenizer (tokenizer.json) in shared storage."""
    tok = _TOKENIZERS.get(path)
    if tok is None:
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        _TOKENIZERS[path] = tok
    return tok


def encode_external(df: DataFrame, key: str, text_col: str, loader: Callable[[], object],
                    out_col: str = "ids", prompt_col: str | None = None) -> DataFrame:
    """Ids from an external tokenizer, batch-encoded per piece of an Arrow batch.

    ``loader`` returns the tokenizer inside the worker (e.g. a partial of
    ``tokenizer_from_file``); no tokenizer object crosses the driver. With
    ``prompt_col`` the prompt is encoded too, giving ``prompt_len`` and
    ``prefix_ok``: whether the prompt's ids are a prefix of the full text's,
    the assumption behind masking by prompt length, which a subword tokenizer
    can break at the prompt boundary (checked on every row).
    """
    fields = [df.schema[key], T.StructField(out_col, T.ArrayType(T.LongType()), True)]
    if prompt_col:
        fields += [T.StructField("prompt_len", T.LongType(), True),
                   T.StructField("prefix_ok", T.BooleanType(), True)]
    cols = [key, text_col] + ([prompt_col] if prompt_col else [])
    names = [f.name for f in fields]

    def run(batches):
        tok = loader()
        for batch in batches:
            for part in _pieces(batch, range(1, len(cols))):
                full = _encoded(tok, part.column(1))
                out = [part.column(0), pa.array(full, pa.list_(pa.int64()))]
                if prompt_col:
                    prompts = _encoded(tok, part.column(2))
                    out += [pa.array([len(p) for p in prompts], pa.int64()),
                            pa.array([np.array_equal(f[:len(p)], p) for f, p in zip(full, prompts)], pa.bool_())]
                yield pa.RecordBatch.from_arrays(out, names)
    return df.select(*cols).mapInArrow(run, T.StructType(fields))


# ------------------------------------------------------------------- X3
def echo_model(prompts: list[str]) -> list[str]:
    """Fixed stand-in model for tests: returns the prompt and a reply that
    depends only on it (the reference's decoded output contains the prompt)."""
    return [p + f"Noted {len(p)} characters." for p in prompts]


def generate(df: DataFrame, prompt_col: str, model_fn: Callable[[list[str]], list[str]],
             out_col: str = "generated") -> DataFrame:
    """Run a user-supplied model over prompts, one Arrow batch at a time."""
    schema = T.StructType(list(df.schema.fields) + [T.StructField(out_col, T.StringType(), True)])

    def run(it):
        for pdf in it:
            outs = model_fn(pdf[prompt_col].fillna("").tolist()) if len(pdf) else []
            yield pdf.assign(**{out_col: outs})
    return df.mapInPandas(run, schema)

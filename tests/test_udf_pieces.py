"""User functions and tokenizers get a batch in pieces: what a worker holds is bounded, the rows are the same."""

import pandas as pd
import pytest

from tunemill.operators import udfs as udf


def careful():
    """A tokenizer of words (their lengths are the ids) that refuses more than it may be handed at once."""
    rows, size = udf.PIECE_ROWS, udf.PIECE_BYTES

    class Careful:
        def encode_batch(self, texts, add_special_tokens):
            long = sum(len(t.encode()) for t in texts)
            if len(texts) > rows or len(texts) > 1 and long > size:
                raise ValueError(f"{len(texts)} texts of {long} bytes at once")
            return [type("E", (), {"ids": [len(w) for w in t.split()]}) for t in texts]
    return Careful


def test_external_tokenizer_gets_bounded_pieces(spark):
    texts = [None, "", "a bb ccc"] + [f"w{i} é " * (i % 5) for i in range(1500)] + ["x " * 700_000] * 3 + ["y " * 400_000] * 4
    rows = [(i if i % 9 else None, t, None if t is None else t[:5]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "k long, text string, prompt string").coalesce(1)
    got = udf.encode_external(df, "k", "text", careful(), prompt_col="prompt").collect()
    ids = [[len(w) for w in (t or "").split()] for t in texts]
    short = [[len(w) for w in (t or "")[:5].split()] for t in texts]
    assert [tuple(r) for r in got] == [(k, i, len(p), i[:len(p)] == p) for (k, _, _), i, p in zip(rows, ids, short)]
    assert [r.ids for r in udf.encode_external(df, "k", "text", careful()).collect()] == ids


@pytest.mark.parametrize("n", [0, 1, 513, 1500])
def test_map_rows_hands_on_bounded_pieces(spark, n):
    def fn(pdf):
        assert len(pdf) <= 512 and list(pdf.index) == list(range(len(pdf)))
        return pd.DataFrame({"id": pdf["id"] + 1, "n": len(pdf)})
    got = udf.map_rows(spark.range(n).coalesce(1), fn, "id long, n long").collect()
    assert [r.id for r in got] == list(range(1, n + 1))

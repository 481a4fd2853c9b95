"""The user function of map_rows_copied on plain cases."""

import pandas as pd

from tunemill.plans.catalog import _copied_run


def test_longest_copied_run():
    rows = [("a", "one two three four", "so two  three\nsix four"), ("b", None, "x y"), ("c", "x", None),
            ("d", "p q p q r", "p q p q q r"), ("e", "w w w", "w w"), ("f", "A", "a"), ("a", "one", "one")]
    out = _copied_run(pd.DataFrame(rows, columns=["example_id", "input", "output"]))
    got = [tuple(None if pd.isna(x) else x for x in r) for r in out.itertuples(index=False)]
    assert got == [("a", 5, 2, 1), ("b", 2, 0, None), ("c", 0, 0, None), ("d", 6, 4, 0), ("e", 2, 2, 0),
                   ("f", 1, 0, None), ("a", 1, 1, 0)]
    assert list(_copied_run(pd.DataFrame([], columns=["example_id", "input", "output"])).columns) == list(out.columns)

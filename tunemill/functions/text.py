"""String functions with Python's semantics, expressed as Spark columns."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import (BOS, EOS, INST_CLOSE, INST_OPEN, MARKER_PATTERN, PREVIEW_CHARS,
                      PREVIEW_ELLIPSIS, TOKEN_PATTERN, WS_CHARS, WS_CLASS)

MARKERS = (BOS, EOS, INST_OPEN, INST_CLOSE)
MARKER_ENDS = frozenset(m[-1] for m in MARKERS)
MARKER_TAILS = ("s>", "INST]")  # every marker ends in one of them

CONTROL_CHARS = r"[\x{0}-\x{8}\x{B}\x{C}\x{E}-\x{1F}\x{7F}]"
# a run of blanks that is not a single plain space
BLANK_RUN = r"[\t\x{A0}\x{3000}][\t \x{A0}\x{3000}]*| [\t \x{A0}\x{3000}]+"
# a line break with a space on either side
SPACED_BREAK = r" \n ?|\n "


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def py_strip(col) -> Column:
    """``str.strip()``: removes every Python whitespace code point at both ends.

    ``F.trim`` removes spaces only, so the whitespace set is spelled out and
    trimmed as a character set: only the trimmed ends are touched, no regex
    scan over the whole text.
    """
    return F.btrim(_c(col), F.lit(WS_CHARS))


def tokenize(col) -> Column:
    """Built-in tokenizer: markers, letter/digit runs, single other symbols."""
    return F.regexp_extract_all(_c(col), F.lit(TOKEN_PATTERN), 0)


def clean_text(col) -> Column:
    """Formatting clean-up: control characters out, runs of blanks folded,
    spaces around line breaks and runs of blank lines removed, then strip."""
    # Every pattern matches only where the text changes (a lone space or a
    # bare line break is left alone), so clean text is scanned, not rebuilt. Where a plain
    # text that every match holds is not there, the pattern is not tried.
    x = _c(col)
    x = _replace(x, r"\r\n?", "\n", "\r")
    x = F.regexp_replace(x, CONTROL_CHARS, "")
    x = _replace(x, BLANK_RUN, " ", "\t", "\u00a0", "\u3000", "  ")
    x = _replace(x, SPACED_BREAK, "\n", " \n", "\n ")
    x = _replace(x, r"\n{3,}", "\n\n", "\n\n\n")
    return py_strip(x)


def _holds(x: Column, some) -> Column:
    found = x.contains(some[0])
    for s in some[1:]:
        found = found | x.contains(s)
    return found


def _replace(x: Column, pattern: str, by: str, *some: str) -> Column:
    """``regexp_replace`` where ``x`` holds one of ``some``, of which every match holds one. ``x`` is bound as the
    element of an array, so that it is made once."""
    return F.transform(F.array(x), lambda v: F.when(_holds(v, some), F.regexp_replace(v, pattern, by)).otherwise(v))[0]


def has_marker(col) -> Column:
    """True when the text holds a sequence or role marker."""
    return _c(col).rlike(MARKER_PATTERN)


def cancel_markers(text: str) -> str:
    """``text`` without markers, also those that form when one inside is removed: a stack of characters, from which a
    marker goes as it closes. No two markers overlap, so the order of removal does not matter."""
    out: list[str] = []
    for c in text:
        out.append(c)
        if c in MARKER_ENDS:
            for m in MARKERS:
                if len(out) >= len(m) and "".join(out[-len(m):]) == m:
                    del out[-len(m):]
                    break
    return "".join(out)


@F.pandas_udf(T.StringType())
def _cancel(texts: pd.Series) -> pd.Series:
    return texts.map(cancel_markers, na_action="ignore")


def remove_markers(col) -> Column:
    """No marker is left, however deep they are nested, and other brackets stay. One pass of a
    pattern removes the plain ones; only a text that then holds a marker anew goes through ``cancel_markers``, in
    one pass over its characters."""
    x = _c(col)
    once = F.when(_holds(x, MARKER_TAILS), F.regexp_replace(x, MARKER_PATTERN, "")).otherwise(x)
    again = F.when(_holds(x, MARKER_TAILS) & once.rlike(MARKER_PATTERN), once)
    return F.coalesce(_cancel(again), once)


def preview(col, n: int = PREVIEW_CHARS) -> Column:
    """``x[:n]`` followed by a space and an ellipsis."""
    return F.concat_ws(" ", F.substring(_c(col), 1, n), F.lit(PREVIEW_ELLIPSIS))


def is_blank(col) -> Column:
    return F.length(py_strip(col)) == 0


__all__ = ["WS_CLASS", "clean_text", "has_marker", "is_blank", "preview",
           "py_strip", "remove_markers", "tokenize"]

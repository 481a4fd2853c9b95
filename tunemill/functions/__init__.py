"""Column-level helpers (built-in Spark functions only, codegen friendly)."""

from .text import (clean_text, has_marker, preview, py_strip, remove_markers,
                   tokenize)

__all__ = ["clean_text", "has_marker", "preview", "py_strip", "remove_markers",
           "tokenize"]

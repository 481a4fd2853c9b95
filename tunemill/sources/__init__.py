"""Readers, writers and the derivation of instruction sources from tables."""

from .examples import dialogue_pairs, docs_examples, mcq_examples, role_prompts
from .io import (read_instruction_json, read_turn_stream, split_records,
                 write_instruction_json, write_table)
from .tables import load

__all__ = ["dialogue_pairs", "docs_examples", "mcq_examples", "role_prompts",
           "read_instruction_json", "read_turn_stream", "split_records", "write_instruction_json",
           "write_table", "load"]

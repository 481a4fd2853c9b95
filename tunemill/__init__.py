"""tunemill: instruction-data preparation and scoring as Spark jobs.

Typical use::

    from tunemill import SftConfig, build_training_set, load, dialogue_pairs
    cfg = SftConfig(max_len=1024, train_pct=100, vocab_size=32000)
    ts = build_training_set(spark, [dialogue_pairs(load(spark, d, "conversations"))], cfg)
"""

from .config import SftConfig
from .operators.batches import batch_plan, pad_to_batch
from .operators.evaluate import (accuracy_rollup, compare_outputs, exact_match,
                                 rubric_pivot, strip_prompt_replace, token_f1,
                                 win_tie_loss)
from .operators.history import chat_cut, history_budget
from .operators.profile import field_profile, plan_totals, token_profile
from .operators.retrieval import retrieve_topk
from .operators.sampling import (global_index, mix_lenient, mix_strict,
                                 shuffle_index, subset_pct)
from .operators.templates import mcq_items, mcq_text, render
from .operators.tokens import build_vocab, decode_ids, encode_examples
from .operators.udfs import encode_external, generate, map_rows
from .operators.validate import filter_rows, marker_guard, required_fields
from .plans.training_set import build_training_set
from .session import get_session, materialize, shared_path
from .sources import (dialogue_pairs, docs_examples, load, mcq_examples,
                      read_instruction_json, role_prompts, write_table)
from .streaming.history_stream import history_stream, run_history_stream

__all__ = [
    "SftConfig", "accuracy_rollup", "batch_plan", "build_training_set", "build_vocab",
    "chat_cut", "compare_outputs", "decode_ids", "dialogue_pairs", "docs_examples",
    "encode_examples", "encode_external", "exact_match", "field_profile", "filter_rows",
    "generate", "get_session", "global_index", "history_budget", "history_stream", "load",
    "map_rows", "marker_guard", "materialize", "mcq_examples", "mcq_items", "mcq_text",
    "mix_lenient", "mix_strict", "pad_to_batch", "plan_totals", "read_instruction_json",
    "render", "required_fields", "retrieve_topk", "role_prompts", "rubric_pivot",
    "run_history_stream", "shared_path", "shuffle_index", "strip_prompt_replace",
    "subset_pct", "token_f1", "token_profile", "win_tie_loss", "write_table",
]

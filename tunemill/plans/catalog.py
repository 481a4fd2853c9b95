"""Named queries over the driver's tables: ``QUERIES[name](spark, data_dir)``.

Every query reads whole tables (or data Spark derives from them); arrays leave
as space-joined strings and doubles are rounded so value hashes are stable.
"""

from __future__ import annotations

from collections.abc import Callable

from functools import partial, wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as fn
from ..config import SftConfig
from ..operators import batches as bat
from ..operators import cells
from ..operators import evaluate as ev
from ..operators import history as hist
from ..operators import profile as prof
from ..operators import retrieval as rt
from ..operators import sampling as smp
from ..operators import sketches as sk
from ..operators import templates as tpl
from ..operators import tokens as tk
from ..operators import udfs as udf
from ..operators import validate as val
from ..schemas import SOURCED_EXAMPLE
from ..session import materialize, shared_path
from ..sources.examples import dialogue_pairs, docs_examples, mcq_examples, turn_id
from ..sources.examples import role_prompts as src_role_prompts
from ..sources.io import (read_instruction_json, split_records, write_instruction_json,
                          write_one_array, write_table)
from ..sources.raw_records import RecordShape, read_raw_records
from ..sources.tables import load

# Parameters of the registered queries (small enough that truncation,
# all-masked rows and history eviction all happen on the test data).
CFG = SftConfig(max_len=256, vocab_size=500, history_budget=128,
                batch_size=4, grad_accum=2, epochs=2, world_size=2)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _long_ints(df: DataFrame) -> DataFrame:
    """Integer outputs leave as 64-bit, one integer width for every query."""
    return df.select(*[F.col(f.name).cast("long").alias(f.name)
                       if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType))
                       else F.col(f.name) for f in df.schema.fields])


def query(fn):
    @wraps(fn)
    def run(spark, d):
        return _long_ints(fn(spark, d))
    QUERIES[fn.__name__] = run
    return fn


# ----------------------------------------------------------------- helpers
def pairs(spark, d, keep_turn_cols=False) -> DataFrame:
    return dialogue_pairs(load(spark, d, "conversations"), keep_turn_cols)


def rendered_pairs(spark, d) -> DataFrame:
    return tpl.render(pairs(spark, d), "inst")


def dialogue_vocab(spark, d, cfg: SftConfig = CFG) -> DataFrame:
    return tk.build_vocab(rendered_pairs(spark, d), ["prompt", "answer"], cfg.vocab_size)


def written_vocab(spark, d) -> DataFrame:
    """The vocabulary for a query that needs it more than once."""
    return materialize(dialogue_vocab(spark, d), "vocab")


# ------------------------------------------------------------ step 1 slice
@query
def sft_pairs(spark, d):
    """Instruction examples from the chat-turn table."""
    return pairs(spark, d, keep_turn_cols=True)


@query
def render_inst(spark, d):
    """Prompt and answer of the inst template."""
    return rendered_pairs(spark, d).select("example_id", "prompt", "answer")


@query
def vocab(spark, d):
    """Vocabulary built as a job over the rendered examples."""
    return dialogue_vocab(spark, d)


@query
def encode_masked(spark, d):
    """Padded, masked training rows."""
    ex = rendered_pairs(spark, d)
    enc = tk.encode_examples(ex, dialogue_vocab(spark, d), CFG)
    return enc.select("example_id", tk.ids_text("input_ids").alias("input_ids"),
                      tk.ids_text("attention_mask").alias("attention_mask"),
                      tk.ids_text("labels").alias("labels"), "prompt_len", "n_tokens")


@query
def encode_duplicates(spark, d):
    """T1 without a key: all documents as prompts, ids and other columns left out,
    so that every copy of a text has to come out whole."""
    ex = load(spark, d, "documents").select(F.coalesce("text", F.lit("")).alias("prompt"),
                                            F.lit("").alias("answer"))
    enc = tk.encode_examples(ex, dialogue_vocab(spark, d), CFG, key=None, pad=False)
    return enc.select(tk.ids_text("input_ids").alias("input_ids"), "n_tokens", "length")


@query
def sft_pairs_gaps(spark, d):
    """P8 on turn numbers with gaps: the whole turn table renumbered to turn * 3."""
    t = load(spark, d, "conversations").withColumn("turn", F.col("turn") * 3)
    return dialogue_pairs(t, keep_turn_cols=True)


@query
def prompt_len_eos_pad(spark, d):
    """T8a against T8b where the pad id is the end-of-text id (no pad token of its own):
    the count of non-pad ids loses the prompt's own end-of-text ids."""
    cfg = CFG.with_(pad_id=None)
    t = rendered_pairs(spark, d).select("example_id", fn.tokenize(F.concat("prompt", "answer")).alias("_tok"))
    enc = tk.encode_tokens(t.select("example_id", F.slice("_tok", 1, cfg.max_len).alias("_tok")),
                           "_tok", dialogue_vocab(spark, d), "ids")
    padded = tk.pad_right(F.col("ids"), cfg.max_len, cfg.effective_pad_id)
    return enc.select("example_id", tk.prompt_len_padded(padded, cfg.effective_pad_id).alias("len_non_pad"),
                      F.size("ids").alias("len_true"), tk.ids_text(padded).alias("padded"))


@query
def encode_loss_on_padding(spark, d):
    """T7, T9 with ``mask_padding=False``: pad = end-of-text, loss on padded positions."""
    cfg = CFG.with_(pad_id=None, mask_padding=False)
    enc = tk.encode_examples(rendered_pairs(spark, d), dialogue_vocab(spark, d), cfg)
    return enc.select("example_id", tk.ids_text("input_ids").alias("input_ids"),
                      tk.ids_text("labels").alias("labels"))


@query
def encode_ragged(spark, d):
    """Truncated, unpadded rows; labels masked up to the prompt."""
    ex = rendered_pairs(spark, d)
    enc = tk.encode_examples(ex, dialogue_vocab(spark, d), CFG, pad=False)
    return enc.select("example_id", tk.ids_text("input_ids").alias("input_ids"),
                      tk.ids_text("labels").alias("labels"), "prompt_tokens", "length")


# ----------------------------------------------------------- more helpers
def mcq(spark, d) -> DataFrame:
    return mcq_examples(load(spark, d, "benchmark"))


def docs(spark, d) -> DataFrame:
    return docs_examples(load(spark, d, "documents"))


def all_examples(spark, d) -> DataFrame:
    return smp.mix_strict(pairs(spark, d), mcq(spark, d), docs(spark, d))


def chat_examples(spark, d) -> DataFrame:
    """The reference's two training sources: dialogues and MCQs."""
    return smp.mix_strict(pairs(spark, d), mcq(spark, d))


def token_counts(spark, d) -> DataFrame:
    ex = tpl.render(chat_examples(spark, d), "inst")
    return tk.tokenize_pair(ex, CFG.max_len).drop("_tok")


def generated_pairs(spark, d) -> DataFrame:
    """Stand-in model output from the turn table: the decoded text holds the
    prompt followed by the answer; every third answer (by turn number) is
    altered by dropping its sentence punctuation."""
    ex = pairs(spark, d, keep_turn_cols=True)
    gen_answer = F.when(F.col("turn") % 3 == 0,
                        F.regexp_replace("output", r"[.!?]", "")).otherwise(F.col("output"))
    return ex.select("example_id", tpl.inst_prompt().alias("prompt"),
                     F.col("output").alias("expected"),
                     F.concat(tpl.inst_prompt(), gen_answer).alias("full_text"))


def eval_predictions(spark, d) -> DataFrame:
    """Two fixed rules on n_chars stand in for models A and B (B leaves some items
    unanswered); benchmark = lang."""
    docs_t = load(spark, d, "documents").select("doc_id", "lang", "n_chars")
    rules = {"model_a": F.when(F.col("n_chars") >= 1000, 1).otherwise(0),
             "model_b": F.when(F.col("n_chars") % 3 != 0, 1).otherwise(0)}
    return docs_t.select(F.col("lang").alias("benchmark"), F.col("doc_id").alias("item_id"), "n_chars",
                         F.explode(F.array(*[F.struct(F.lit(m).alias("model"),
                                                      r.alias("predicted"))
                                             for m, r in rules.items()])).alias("p")
                         ).where("p.model = 'model_a' or n_chars % 11 <> 0"
                                 ).select("p.model", "benchmark", "item_id", "p.predicted")


def eval_gold(spark, d) -> DataFrame:
    lab = load(spark, d, "labels").select(F.col("doc_id").alias("item_id"),
                                          F.col("quality").alias("gold"))
    docs_t = load(spark, d, "documents").select(F.col("doc_id").alias("item_id"),
                                                F.col("lang").alias("benchmark"))
    return lab.join(docs_t, "item_id", "inner")


def rubric_scores(spark, d) -> DataFrame:
    """Long score table (model, benchmark, prompt_id, criterion, score) by fixed rules."""
    t = load(spark, d, "documents").select("doc_id", "lang", "n_chars")
    n, i = F.col("n_chars"), F.col("doc_id")
    rules = [("model_a", "coherence", 1 + n % 5), ("model_a", "empathy", 1 + i % 5),
             ("model_a", "factuality", 1 + (n % 7) % 5),
             ("model_b", "coherence", 1 + (n + 2) % 5), ("model_b", "empathy", 1 + (i + 1) % 5),
             ("model_b", "factuality", 1 + (n % 11) % 5)]
    return t.select(F.col("lang").alias("benchmark"), F.col("doc_id").alias("prompt_id"),
                    F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.lit(c).alias("criterion"),
                                                 s.cast("double").alias("score"))
                                        for m, c, s in rules])).alias("r")
                    ).select("r.model", "benchmark", "prompt_id", "r.criterion", "r.score")


# ------------------------------------------------------- sources and text
@query
def json_roundtrip(spark, d):
    """Both training sources written as JSON files (an array, and lines), read
    back as one by the default call."""
    a = write_instruction_json(pairs(spark, d), shared_path(spark, "conv-json"), form="array")
    b = write_instruction_json(mcq(spark, d), shared_path(spark, "mcq-json"))
    back, _ = split_records(read_instruction_json(spark, [a, b], schema=SOURCED_EXAMPLE))
    return back.select("source", "example_id", "instruction", "input", "output")


@query
def json_large_array(spark, d):
    """The pairs as one array file, read in byte ranges by as many tasks."""
    lines = write_instruction_json(pairs(spark, d), shared_path(spark, "conv-lines"))
    one = write_one_array(lines, shared_path(spark, "conv-array") + ".json", spark)
    back, _ = split_records(read_instruction_json(spark, one, schema=SOURCED_EXAMPLE))
    return back.select("source", "example_id", "instruction", "input", "output")


# two shapes of other programs: a list of messages, and a nested question with its solution
MESSAGES = RecordShape(example_id=("$.ref",), instruction=("$.context.system",), input=("$.messages[0].value",),
                       output=("$.messages[1].value",))
NESTED = RecordShape(example_id=("$.data['item no']",), instruction=("$.task",), input=("$.data.question",),
                     output=("$.data.answer", "$.data.solution.text"))


@query
def raw_records(spark, d):
    """The pairs and the MCQs as raw JSON in two foreign nested shapes, mapped to instruction examples by
    paths; fields that no path uses are kept."""
    said = lambda who, c: F.struct(F.lit(who).alias("from"), F.col(c).alias("value"))
    a = write_instruction_json(pairs(spark, d).select(
        F.col("example_id").alias("ref"), F.struct(F.col("instruction").alias("system")).alias("context"),
        F.array(said("patient", "input"), said("doctor", "output")).alias("messages"),
        F.struct("source").alias("origin")), shared_path(spark, "raw-messages"), form="array")
    b = write_instruction_json(mcq(spark, d).select(
        F.col("instruction").alias("task"), F.lit(4).alias("options"),
        F.struct(F.col("example_id").cast("long").alias("item no"), F.col("input").alias("question"),
                 F.struct(F.col("output").alias("text")).alias("solution")).alias("data")), shared_path(spark, "raw-nested"))
    rows = read_raw_records(spark, a, MESSAGES).withColumn("source", F.lit("dialogue")).unionByName(
        read_raw_records(spark, b, NESTED).withColumn("source", F.lit("mcq")))
    return rows.select("source", "example_id", "instruction", "input", "output", "extra", "reason")


@query
def role_prompts(spark, d):
    """Prompt table with the fixed doctor role."""
    p = src_role_prompts(load(spark, d, "conversations"))
    return p.select("prompt_id", tpl.role_prompt("user_text").alias("prompt"))


@query
def render_alpaca(spark, d):
    """Alpaca prompt (input block only when non-empty)."""
    ex = tpl.render(chat_examples(spark, d), "alpaca")
    return ex.select("source", "example_id", "prompt", "answer")


@query
def render_single_turn(spark, d):
    """P5: single-turn alpaca prompt for every user message."""
    t = load(spark, d, "conversations").where(F.col("role") == "user")
    return t.select(turn_id().alias("prompt_id"),
                    tpl.single_turn_prompt("text").alias("prompt"))


@query
def render_mcq(spark, d):
    """MCQ text with four options and the gold letter."""
    items = tpl.mcq_items(load(spark, d, "benchmark"))
    return items.select("item_id", tpl.mcq_text().alias("prompt"), "gold")


@query
def field_profile(spark, d):
    """A1, A2: per source and field: rows, nulls, blanks, lengths, distinct."""
    return prof.field_profile(all_examples(spark, d))


def _merged_profile(spark, df, fields):
    """Sketches per part of the rows, merged from a written table; bounds checked against all rows."""
    part = F.pmod(F.xxhash64("example_id"), F.lit(8))  # in use: the day or file a row comes from
    parts = sk.write_parts(sk.part_profile(df, part, fields), shared_path(spark, "profile"))
    out = sk.profile_errors(df, sk.read_profile(sk.merge_parts(parts)), fields)
    return out.select("source", "field", "n_rows", "n_null", "n_blank", "min_len", "avg_len", "max_len",
                      F.col("exact_distinct").alias("n_distinct"),
                      (F.col("distinct_error") <= sk.DISTINCT_BOUND).alias("distinct_within"),
                      (F.col("p50_error") <= sk.RANK_BOUND).alias("p50_within"),
                      (F.col("p90_error") <= sk.RANK_BOUND).alias("p90_within"))


@query
def merged_field_profile(spark, d):
    """A2: the field profile from merged sketches, with whether its estimates are within their bounds."""
    return _merged_profile(spark, all_examples(spark, d), ("instruction", "input", "output"))


@query
def merged_token_profile(spark, d):
    """A3: token counts of texts and prompts from merged sketches, estimates against their bounds."""
    return _merged_profile(spark, token_counts(spark, d), ("n_tokens", "prompt_tokens"))


@query
def required_fields(spark, d):
    """every row checked, with the reason of a rejection."""
    return val.required_fields(all_examples(spark, d)).select("source", "example_id", "valid",
                                                              "reason")


@query
def preview_text(spark, d):
    """First 200 characters and an ellipsis."""
    return all_examples(spark, d).select("source", "example_id",
                                         fn.preview("input").alias("input_preview"),
                                         fn.preview("output").alias("output_preview"))


@query
def clean_text(spark, d):
    """formatting clean-up of the document texts."""
    t = load(spark, d, "documents")
    c = t.select("doc_id", fn.clean_text("text").alias("cleaned"),
                 F.length("text").alias("chars_before"))
    return c.select("doc_id", "cleaned", "chars_before", F.length("cleaned").alias("chars_after"))


@query
def strip_text(spark, d):
    """Python-style strip of the document texts."""
    t = load(spark, d, "documents").select("doc_id", "text", fn.py_strip("text").alias("stripped"))
    return t.select("doc_id", "stripped", (F.length("text") - F.length("stripped")).alias("removed"))


@query
def special_token_guard(spark, d):
    """markers found in user text are reported and removed."""
    g = val.marker_guard(docs(spark, d), mode="strip")
    return g.select("example_id", "had_marker", "input", "output")


@query
def filter_rows(spark, d):
    """quality / toxicity / length / ratio filter over the docs source; every row
    with the reasons against it."""
    f = val.filter_rows(docs(spark, d), load(spark, d, "labels"), min_output_chars=1,
                        max_output_chars=20000, max_ratio=50.0)
    return f.select("example_id", "quality", "toxic", F.length("input").alias("n_in"),
                    F.length("output").alias("n_out"), "reason")


# ----------------------------------------------------- sampling and mixing
SUBSET_PCT = 33.3
MIX_PCT = 50.0
TRAIN_PCT = 50.0
RUN = 50  # positions per shard file of shard_roundtrip


@query
def subset_pct(spark, d):
    """Exact seeded percentage of every source."""
    s = smp.subset_pct(all_examples(spark, d), SUBSET_PCT, CFG.seed,
                       prefix_hex=CFG.index_prefix_hex)
    return s.select("source", "example_id", "idx")


@query
def subset_exact(spark, d):
    """The same rows by radix selection and one filter, without their numbers."""
    return smp.subset_exact(all_examples(spark, d), SUBSET_PCT, CFG.seed,
                            digits=CFG.index_prefix_hex).select("source", "example_id")


@query
def mix_sources_all(spark, d):
    """U1 and W2 over all rows of both sources (W1 at 100 %)."""
    a, b = (smp.subset_pct(x, 100.0, CFG.seed) for x in (pairs(spark, d), mcq(spark, d)))
    m = smp.shuffle_index(smp.mix_strict(a, b), CFG.seed, prefix_hex=CFG.index_prefix_hex)
    return m.select("pos", "source", "example_id")


@query
def mix_sources(spark, d):
    """W1 per source, U1, then the seeded shuffle of the mix."""
    a = smp.subset_exact(pairs(spark, d), MIX_PCT, CFG.seed)
    b = smp.subset_exact(mcq(spark, d), MIX_PCT, CFG.seed)
    m = smp.shuffle_index(smp.mix_strict(a, b), CFG.seed, prefix_hex=CFG.index_prefix_hex)
    return m.select("pos", "source", "example_id")


@query
def mix_lenient(spark, d):
    """Sources with and without ``input`` mixed; source order kept."""
    m = smp.mix_lenient(pairs(spark, d), mcq(spark, d).drop("input"))
    return m.select("source_rank", "source", "example_id", "instruction", "input", "output")


@query
def shuffle_index(spark, d):
    """Global position of every example in the seeded shuffle."""
    m = smp.shuffle_index(all_examples(spark, d), CFG.seed, prefix_hex=CFG.index_prefix_hex)
    return m.select("pos", "source", "example_id")


# ----------------------------------------------------------------- tokens
@query
def prompt_len_variants(spark, d):
    """T8a (padded prompt, non-pad count, F3), T8b (truncated), T8c (full)."""
    ex = rendered_pairs(spark, d).select("example_id", "prompt")
    t = ex.select("example_id", fn.tokenize("prompt").alias("_pt"))
    t = t.select("example_id", F.size("_pt").alias("prompt_len_full"),
                 F.slice("_pt", 1, CFG.max_len).alias("_tok"))
    enc = tk.encode_tokens(t, "_tok", dialogue_vocab(spark, d), "ids")
    padded = tk.pad_right(F.col("ids"), CFG.max_len, CFG.effective_pad_id)
    return enc.select("example_id",
                      tk.prompt_len_padded(padded, CFG.effective_pad_id).alias("prompt_len_padded"),
                      F.least("prompt_len_full", F.lit(CFG.max_len)).alias("prompt_len_trunc"),
                      "prompt_len_full")


@query
def token_profile(spark, d):
    """A3: token-length profile per source."""
    return prof.token_profile(token_counts(spark, d), CFG.max_len)


@query
def token_view(spark, d):
    """First 50 ids, mask and labels, the decoded prompt part and the
    next 20 tokens decoded, for every row."""
    vocab_t = written_vocab(spark, d)
    enc = tk.encode_examples(rendered_pairs(spark, d), vocab_t, CFG)
    v = enc.select("example_id", "input_ids", "prompt_len",
                   tk.ids_text(F.slice("input_ids", 1, 50)).alias("ids_50"),
                   tk.ids_text(F.slice("attention_mask", 1, 50)).alias("mask_50"),
                   tk.ids_text(F.slice("labels", 1, 50)).alias("labels_50"))
    dec = tk.decode_parts(v, "input_ids", vocab_t)
    return dec.select("example_id", "prompt_len", "ids_50", "mask_50", "labels_50",
                      tk.join_tokens("_dec", True, hi=F.col("prompt_len")).alias("prompt_text"),
                      tk.join_tokens("_dec", True, lo=F.col("prompt_len"),
                                     hi=F.col("prompt_len") + 20).alias("next_text"))


@query
def decode_tokens(spark, d):
    """Ids back to text, with and without the reserved tokens."""
    vocab_t = written_vocab(spark, d)
    enc = tk.encode_examples(rendered_pairs(spark, d), vocab_t, CFG, pad=False)
    dec = tk.decode_parts(enc.select("example_id", "input_ids"), "input_ids", vocab_t)
    return dec.select("example_id", tk.join_tokens("_dec", True).alias("text"),
                      tk.join_tokens("_dec", False).alias("text_all"))


# ---------------------------------------------------------------- batches
@query
def batch_plan(spark, d):
    """Epoch, position, optimizer step, accumulation step, micro-batch."""
    p = bat.batch_plan(chat_examples(spark, d).select("source", "example_id"), CFG.epochs,
                       CFG.batch_size, CFG.grad_accum, 1, CFG.seed)
    return p.select("epoch", "source", "example_id", "pos", "step", "micro_step", "batch_id")


@query
def batch_plan_ranks(spark, d):
    """The same over ``world_size`` devices (positions dealt round-robin)."""
    p = bat.batch_plan(chat_examples(spark, d).select("source", "example_id"), CFG.epochs,
                       CFG.batch_size, CFG.grad_accum, CFG.world_size, CFG.seed)
    return p.select("epoch", "source", "example_id", "pos", "rank", "step", "micro_step",
                    "batch_id")


@query
def batch_padding(spark, d):
    """Ragged rows padded to the longest row of their batch."""
    # the plan goes with the unpadded ids: no join, so repeated and null ids stay rows of their own
    ex = rendered_pairs(spark, d).select(F.lit("dialogue").alias("source"), "example_id", "prompt", "answer")
    plan = bat.batch_plan(tk.encode_ids(ex, dialogue_vocab(spark, d), CFG), 1, CFG.batch_size, CFG.grad_accum, 1, CFG.seed)
    padded = bat.pad_to_batch(tk.pad_and_mask(plan, CFG, pad=False), CFG.effective_pad_id)
    return padded.select("batch_id", "example_id", "batch_len",
                         tk.ids_text("input_ids").alias("input_ids"),
                         tk.ids_text("attention_mask").alias("attention_mask"),
                         tk.ids_text("labels").alias("labels"))


@query
def plan_totals(spark, d):
    """Effective batch, steps per epoch and in total, token totals."""
    c = token_counts(spark, d).withColumn("length", F.least("n_tokens", F.lit(CFG.max_len)))
    return prof.plan_totals(c, CFG.batch_size, CFG.grad_accum, CFG.world_size, CFG.epochs,
                            CFG.max_len)


@query
def vocab_roundtrip(spark, d):
    """The vocabulary saved as a table and read back."""
    path = write_table(dialogue_vocab(spark, d), shared_path(spark, "vocab"))
    return spark.read.parquet(path).select("token", "id", "n")


@query
def shard_roundtrip(spark, d):
    """Encoded rows written in batch order as per-rank shards, read back, with each
    row's place in its file."""
    ex = rendered_pairs(spark, d).select(F.lit("dialogue").alias("source"), "example_id", "prompt", "answer")
    plan = bat.batch_plan(tk.encode_ids(ex, dialogue_vocab(spark, d), CFG), 1, CFG.batch_size, CFG.grad_accum,
                          CFG.world_size, CFG.seed)
    rows = plan.withColumn("run", F.floor(F.col("pos") / RUN))
    rows = rows.repartition("rank", "run").sortWithinPartitions("rank", "run", "pos")
    out = tk.pad_and_mask(rows, CFG).select("rank", "run", "step", "batch_id", "pos", "example_id",
                                            "input_ids", "labels")
    path = write_table(out, shared_path(spark, "shards"), partition_by=["rank", "run"])
    back = spark.read.parquet(path)
    # the place in the file is what the reader meets: the row's number in its only file
    place = Window.partitionBy("rank", "run", "file").orderBy("at")
    back = (back.withColumn("file", F.input_file_name()).withColumn("at", F.monotonically_increasing_id())
            .withColumn("place", F.row_number().over(place) - 1))
    files = F.size(F.collect_set("file").over(Window.partitionBy("rank", "run")))
    return back.select("rank", "run", "place", files.alias("n_files"), "step", "batch_id", "example_id",
                       tk.ids_text("input_ids").alias("input_ids"),
                       tk.ids_text("labels").alias("labels"))


# ------------------------------------------------------ python-side steps
def _render_in_pandas(pdf):
    """X1 user function: the inst prompt and its length, computed in pandas."""
    import pandas as pd

    from ..config import INST_PROMPT_HEAD, INST_PROMPT_TAIL
    prompt = (INST_PROMPT_HEAD + pdf["instruction"] + " " + pdf["input"].fillna("")
              + INST_PROMPT_TAIL)
    return pd.DataFrame({"example_id": pdf["example_id"], "prompt": prompt,
                         "n_chars": prompt.str.len().astype("int64")})


@query
def map_rows(spark, d):
    """A user function over rows, in Arrow batches."""
    return udf.map_rows(pairs(spark, d), _render_in_pandas,
                        "example_id string, prompt string, n_chars long")


def _copied_run(pdf):
    """X1 user function: the longest run of words of the answer that stands in the input."""
    import re

    import pandas as pd

    words = re.compile(r"[^\x20\x09-\x0D]+").findall

    def longest(asked, answer):
        places, before, best = {}, {}, (0, None)
        for j, w in enumerate(asked):
            places.setdefault(w, []).append(j)
        for i, w in enumerate(answer):
            before = {j: before.get(j - 1, 0) + 1 for j in places.get(w, ())}
            n = max(before.values(), default=0)
            if n > best[0]:
                best = (n, i + 1 - n)
        return best

    rows = []
    for key, q, a in zip(pdf["example_id"], pdf["input"].fillna(""), pdf["output"].fillna("")):
        a = words(a)  # of one row at a time
        rows.append((key, len(a), *longest(words(q), a)))
    out = pd.DataFrame(rows, columns=["example_id", "n_words", "copied_words", "copied_at"])
    return out.astype({"n_words": "int64", "copied_words": "int64", "copied_at": "Int64"})


@query
def map_rows_copied(spark, d):
    """A user function that no column function gives: the longest run of words copied from the input."""
    return udf.map_rows(pairs(spark, d).select("example_id", "input", "output"), _copied_run,
                        "example_id string, n_words long, copied_words long, copied_at long")


@query
def tokenize_external(spark, d):
    """Ids from an external (``tokenizers``) word-level tokenizer over the
    vocabulary table, loaded once per worker from the shared folder."""
    path = write_table(dialogue_vocab(spark, d), shared_path(spark, "tok-vocab"))
    ex = rendered_pairs(spark, d).select("example_id", "prompt",
                                         F.concat("prompt", "answer").alias("text"))
    out = udf.encode_external(ex, "example_id", "text",
                              partial(udf.word_level_tokenizer_from_vocab, path),
                              prompt_col="prompt")
    return out.select("example_id", tk.ids_text("ids").alias("ids"), "prompt_len", "prefix_ok")


@query
def generate_batch(spark, d):
    """A user-supplied model over the prompt table; prompt removed by T12."""
    p = src_role_prompts(load(spark, d, "conversations")).select(
        "prompt_id", tpl.role_prompt("user_text").alias("prompt"))
    g = udf.generate(p, "prompt", udf.echo_model)
    return g.select("prompt_id", "generated",
                    ev.strip_prompt_replace(F.col("generated"), F.col("prompt")).alias("answer"))


# ---------------------------------------------------------------- history
@query
def chat_cut(spark, d):
    """turns before the first blank user message."""
    return hist.chat_cut(load(spark, d, "conversations")).select("conv_id", "turn", "role")


@query
def history_budget(spark, d):
    """Kept history of every user turn within the token budget."""
    h = hist.history_budget(load(spark, d, "conversations"), CFG.history_budget,
                            with_prompt=False)
    return h.select("conv_id", "turn", "start_turn", "n_messages", "n_tokens")


@query
def history_prompt(spark, d):
    """The rendered prompt of the kept history."""
    h = hist.history_budget(load(spark, d, "conversations"), CFG.history_budget)
    return h.select("conv_id", "turn", "prompt")


@query
def history_stream(spark, d):
    """The same history, computed by a stateful stream over the turn table, dealt
    out over eight files (one a trigger) so that turns arrive in no order; conversations
    that the stream could not take in order are rebuilt at its end."""
    from ..streaming.history_stream import run_history_stream, whole_history
    path = shared_path(spark, "turns")
    load(spark, d, "conversations").repartition(8, F.xxhash64("conv_id", "turn")).write.parquet(path)
    sink = shared_path(spark, "history-stream")
    run_history_stream(spark, path, CFG.history_budget, sink=sink)
    return whole_history(spark, path, sink, CFG.history_budget)


@query
def history_seeded(spark, d):
    """X5 from a backlog: the first half of every conversation through the batch form, whose state the stream begins
    with; the second half through the stream; second halves that it could not take in order are rebuilt at its end."""
    from ..streaming.history_stream import history_state, run_history_stream, whole_history
    turns = load(spark, d, "conversations")
    half = turns.groupBy("conv_id").agg(F.max("turn").alias("last"))
    parted = materialize(turns.join(half, "conv_id").withColumn("late", F.col("turn") * 2 > F.col("last")), "turns-parted")
    early = parted.where("not late").select(*turns.columns)
    path = shared_path(spark, "turns")
    parted.where("late").select(*turns.columns).repartition(4, F.xxhash64("conv_id", "turn")).write.parquet(path)
    sink = shared_path(spark, "history-stream")
    run_history_stream(spark, path, CFG.history_budget, sink=sink, state=history_state(early, CFG.history_budget))
    return whole_history(spark, path, sink, CFG.history_budget, backlog=early)


# ------------------------------------------------------------- evaluation
@query
def strip_prompt_replace(spark, d):
    """Prompt removed from the decoded text by replace, then strip."""
    g = generated_pairs(spark, d)
    return g.select("example_id",
                    ev.strip_prompt_replace(F.col("full_text"), F.col("prompt")).alias("answer"))


@query
def strip_prompt_slice(spark, d):
    """Ids after the prompt length decoded, then strip."""
    g = generated_pairs(spark, d)
    t = g.select("example_id", fn.tokenize("prompt").alias("_pt"),
                 fn.tokenize("full_text").alias("_ft"))
    t = t.select("example_id", F.size("_pt").alias("prompt_len"), "_ft")
    vocab_t = written_vocab(spark, d)
    enc = tk.encode_tokens(t, "_ft", vocab_t, "ids")
    tail = enc.select("example_id", F.slice("ids", F.col("prompt_len") + 1,
                                            F.greatest(F.size("ids"), F.lit(1))).alias("tail"))
    dec = tk.decode_ids(tail, "tail", vocab_t, "answer")
    return dec.select("example_id", fn.py_strip("answer").alias("answer"))


def _comparison(spark, d, ordered: bool = False) -> DataFrame:
    g = generated_pairs(spark, d)
    gen = g.select("example_id", ev.strip_prompt_replace(F.col("full_text"), F.col("prompt"))
                   .alias("generated"))
    return ev.compare_outputs(g.select("example_id", "prompt", "expected"), gen, ordered=ordered)


@query
def compare_outputs(spark, d):
    """Expected beside generated, in example order, written as a
    report table and read back."""
    report = _comparison(spark, d, ordered=True).select("example_id", "prompt", "expected",
                                                        "generated")
    path = write_table(report, shared_path(spark, "comparison-report"))
    return spark.read.parquet(path)


@query
def exact_match(spark, d):
    """Exact-match rate after strip."""
    return ev.exact_match(_comparison(spark, d))


@query
def token_f1(spark, d):
    """Token F1 of generated against expected, per example."""
    return ev.token_f1(_comparison(spark, d))


@query
def accuracy_rollup(spark, d):
    """Accuracy per model and benchmark, per model, overall."""
    return ev.accuracy_rollup(eval_predictions(spark, d), eval_gold(spark, d))


@query
def rubric_pivot(spark, d):
    """Mean rubric score per model and criterion."""
    return ev.rubric_pivot(rubric_scores(spark, d))


@query
def win_tie_loss(spark, d):
    """Side-by-side wins, ties and losses of model A against B."""
    return ev.win_tie_loss(rubric_scores(spark, d), "model_a", "model_b")


@query
def retrieve_topk(spark, d):
    """Five most similar passages for the mean vector of every label."""
    e = load(spark, d, "embeddings")
    r = rt.retrieve_topk(rt.mean_vectors(e, "label"), e, k=5)
    return r.select("query_id", "vec_id", "sim", "rank")


@query
def retrieve_cells(spark, d):
    """As ``retrieve_topk``, from cells that the triangle inequality leaves over."""
    e = load(spark, d, "embeddings")
    r = cells.search_cells(rt.mean_vectors(e, "label"), cells.build_cells(e), k=5)
    return r.select("query_id", "vec_id", "sim", "rank")


def _training_rows(spark, sources, cfg, **kw):
    from .training_set import build_training_set
    ts = build_training_set(spark, sources, cfg, **kw)
    return _shard_rows(spark.read.parquet(ts.shards_path))


def _shard_rows(back):
    return back.select("epoch", "rank", "step", "micro_step", "batch_id", "pos", "source",
                       "example_id", tk.ids_text("input_ids").alias("input_ids"),
                       tk.ids_text("labels").alias("labels"), "prompt_len", "length", "template")


@query
def training_set(spark, d):
    """The whole flow: clean, guard, validate, exact 50 % of each source, mix, render,
    vocabulary (saved), encode, batch plan, pad and mask, per-rank shards."""
    return _training_rows(spark, [pairs(spark, d), mcq(spark, d)], CFG.with_(train_pct=TRAIN_PCT))


@query
def training_set_all(spark, d):
    """The whole flow over all rows (100 %)."""
    return _training_rows(spark, [pairs(spark, d), mcq(spark, d)], CFG)


@query
def shards_from_step(spark, d):
    """The shards written and entered into the manifest some runs at a time, read from the middle step on; runs that end
    before it are not opened."""
    from .training_set import build_training_set, read_shards
    runs = max(1, load(spark, d, "benchmark").count())  # positions per run
    ts = build_training_set(spark, [pairs(spark, d), mcq(spark, d)], CFG, rows_per_file=runs,
                            runs_per_commit=max(2, load(spark, d, "conversations").count() // runs // 4))
    last = spark.read.parquet(ts.manifest_path).agg(F.max("last_step")).first()[0]
    return _shard_rows(read_shards(spark, ts, (last + 1) // 2))


@query
def training_set_duplicates(spark, d):
    """The whole flow over all documents without ids of their own: the language is the id, so it repeats, and
    documents from src0 have none. Every copy is in the shards."""
    ids = F.when(F.coalesce(F.col("source"), F.lit("")) != "src0", F.col("lang"))
    ex = docs_examples(load(spark, d, "documents").withColumn("doc_id", ids)).withColumn(
        "output", F.concat_ws("\n", "input", "output"))
    return _training_rows(spark, [ex], CFG).groupBy("epoch", "source", "example_id", "input_ids", "labels", "length").agg(
        F.count(F.lit(1)).alias("copies"))


@query
def json_training_set(spark, d):
    """S1, S2 to shards: the pairs as a JSON array file and the MCQs as lines, three
    fields each, read by the default call, given ids, unshuffled, all rows."""
    from .training_set import examples_from_json
    a = write_instruction_json(pairs(spark, d).select("instruction", "input", "output"),
                               shared_path(spark, "conv-json"), form="array")
    b = write_instruction_json(mcq(spark, d).select("instruction", "input", "output"), shared_path(spark, "mcq-json"))
    tables, bad = examples_from_json(spark, {"dialogue": a, "mcq": b})
    return _training_rows(spark, tables, CFG.with_(shuffle=False), also_rejected=bad)

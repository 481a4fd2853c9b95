"""Oracle statements, one per registered query (same names as the catalog)."""

from __future__ import annotations

from .catalog import CFG
from .oracle import (PAIRS, RENDERED, encoded_cte, inst_answer, inst_prompt, vocab_cte,
                     with_)

ORACLE: dict[str, str] = {}

_V = vocab_cte(CFG.vocab_size)
_E = encoded_cte(CFG.max_len)
_N = CFG.max_len

ORACLE["sft_pairs"] = with_(PAIRS) + """
SELECT source, example_id, instruction, input, output, conv_id, turn FROM pairs"""

ORACLE["render_inst"] = with_(PAIRS, RENDERED) + """
SELECT example_id, prompt, answer FROM rendered"""

ORACLE["vocab"] = with_(PAIRS, RENDERED, _V) + """
SELECT token, id, n FROM vocab"""

ORACLE["encode_masked"] = with_(PAIRS, RENDERED, _V, _E) + f"""
, padded AS (
  SELECT example_id, n_tokens, len(ids) AS k, least(prompt_tokens, {_N}) AS prompt_len,
         list_resize(ids, {_N}, 0) AS input_ids FROM enc)
SELECT example_id, array_to_string(input_ids, ' ') AS input_ids,
       array_to_string(list_transform(range({_N}), lambda i: CASE WHEN i < k THEN 1 ELSE 0 END), ' ')
         AS attention_mask,
       array_to_string(list_transform(input_ids, lambda x, i:
         CASE WHEN i - 1 < prompt_len OR i - 1 >= k THEN -100 ELSE x END), ' ') AS labels,
       prompt_len, n_tokens
FROM padded"""

ORACLE["encode_ragged"] = with_(PAIRS, RENDERED, _V, _E) + f"""
SELECT example_id, array_to_string(ids, ' ') AS input_ids,
       array_to_string(list_transform(ids, lambda x, i:
         CASE WHEN i - 1 < least(prompt_tokens, {_N}) THEN -100 ELSE x END), ' ') AS labels,
       prompt_tokens, len(ids) AS length
FROM enc"""

# ------------------------------------------------------------------ shared
from ..config import (PREVIEW_CHARS, PREVIEW_ELLIPSIS, SPECIAL_TOKENS)  # noqa: E402
from .catalog import MIX_PCT, RUN, SUBSET_PCT  # noqa: E402
from .oracle import (DOCS, MCQ, MARKER_PATTERN, MCQ_NO_OPTION, alpaca_answer,  # noqa: E402
                     alpaca_prompt, history_part, lit, role_prompt, single_turn,
                     strip, toks)

_S = CFG.seed
ALL = "all_ex AS (SELECT * FROM pairs_x UNION ALL SELECT * FROM mcq UNION ALL SELECT * FROM docs)"
PAIRS_X = ("pairs_x AS (SELECT source, example_id, instruction, input, output FROM pairs)")
CHAT = "chat_ex AS (SELECT * FROM pairs_x UNION ALL SELECT * FROM mcq)"


def md5key(*parts: str) -> str:
    inner = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"md5('{_S}:' || {inner})"


ORACLE["json_roundtrip"] = with_(PAIRS, MCQ, PAIRS_X, CHAT) + """
SELECT source, example_id, instruction, input, output FROM chat_ex"""

ORACLE["json_large_array"] = with_(PAIRS) + """
SELECT source, example_id, instruction, input, output FROM pairs"""

ORACLE["raw_records"] = with_(PAIRS, MCQ, PAIRS_X, CHAT) + """
SELECT source, example_id, instruction, input, output,
       CASE source WHEN 'dialogue' THEN '{"origin":{"source":"dialogue"}}' ELSE '{"options":4}' END AS extra, '' AS reason
FROM chat_ex"""

ORACLE["role_prompts"] = f"""
SELECT conv_id || ':' || turn AS prompt_id, {role_prompt('text')} AS prompt
FROM conversations WHERE role = 'user'"""

ORACLE["render_alpaca"] = with_(PAIRS, MCQ, PAIRS_X, CHAT) + f"""
SELECT source, example_id, {alpaca_prompt('instruction', 'input')} AS prompt,
       {alpaca_answer('output')} AS answer FROM chat_ex"""

ORACLE["render_single_turn"] = f"""
SELECT conv_id || ':' || turn AS prompt_id, {single_turn('text')} AS prompt
FROM conversations WHERE role = 'user'"""

_SLOT = "CASE WHEN g = {i} THEN answer WHEN g > {i} THEN d{j} ELSE d{k} END"
ORACLE["render_mcq"] = f"""
WITH items AS (
  SELECT item_id,
         CASE WHEN strpos(text, '.') > 0 THEN substr(text, 1, strpos(text, '.')) ELSE text END AS question,
         CASE WHEN strpos(text, '.') > 0 THEN {strip("substr(text, strpos(text, '.') + 1)")}
              ELSE '' END AS answer
  FROM benchmark),
opt AS (
  SELECT i.item_id, i.question, i.answer,
         ascii(substr(md5(CAST(i.item_id AS VARCHAR)), 1, 1)) % 4 AS g,
         coalesce(o1.answer, {lit(MCQ_NO_OPTION)}) AS d1,
         coalesce(o2.answer, {lit(MCQ_NO_OPTION)}) AS d2,
         coalesce(o3.answer, {lit(MCQ_NO_OPTION)}) AS d3
  FROM items i
  LEFT JOIN items o1 ON o1.item_id = i.item_id + 1
  LEFT JOIN items o2 ON o2.item_id = i.item_id + 2
  LEFT JOIN items o3 ON o3.item_id = i.item_id + 3)
SELECT item_id,
       'Question: ' || question || chr(10) || 'Options: A) ' || ({_SLOT.format(i=0, j=1, k=0)})
       || ' B) ' || ({_SLOT.format(i=1, j=2, k=1)}) || ' C) ' || ({_SLOT.format(i=2, j=3, k=2)})
       || ' D) ' || ({_SLOT.format(i=3, j=4, k=3)}) || chr(10) || 'Answer:' AS prompt,
       ['A', 'B', 'C', 'D'][g + 1] AS gold
FROM (SELECT *, NULL AS d0, NULL AS d4 FROM opt)"""

_FIELDS = " UNION ALL ".join(
    f"SELECT source, '{f}' AS field, {f} AS value FROM all_ex" for f in ("instruction", "input", "output"))
ORACLE["field_profile"] = with_(PAIRS, MCQ, DOCS, PAIRS_X, ALL) + f"""
, long AS ({_FIELDS})
SELECT source, field, count(*) AS n_rows,
       CAST(sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null,
       CAST(sum(CASE WHEN value IS NOT NULL AND length({strip('value')}) = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_blank,
       min(length(value)) AS min_len, round(avg(length(value)), 4) AS avg_len,
       max(length(value)) AS max_len, count(DISTINCT value) AS n_distinct
FROM long GROUP BY source, field"""

_WITHIN = "true AS distinct_within, true AS p50_within, true AS p90_within"
ORACLE["merged_field_profile"] = f"SELECT *, {_WITHIN} FROM ({ORACLE['field_profile']})"


def _reason(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL THEN '{c}: missing' END, "
            f"CASE WHEN {c} IS NOT NULL AND length({strip(c)}) = 0 THEN '{c}: blank' END")


ORACLE["required_fields"] = with_(PAIRS, MCQ, DOCS, PAIRS_X, ALL) + f"""
SELECT source, example_id, r = '' AS valid, r AS reason FROM (
  SELECT source, example_id, concat_ws('; ', {_reason('instruction')}, {_reason('output')}) AS r
  FROM all_ex)"""

ORACLE["preview_text"] = with_(PAIRS, MCQ, DOCS, PAIRS_X, ALL) + f"""
SELECT source, example_id,
       concat_ws(' ', substr(input, 1, {PREVIEW_CHARS}), {lit(PREVIEW_ELLIPSIS)}) AS input_preview,
       concat_ws(' ', substr(output, 1, {PREVIEW_CHARS}), {lit(PREVIEW_ELLIPSIS)}) AS output_preview
FROM all_ex"""


def _clean(x: str) -> str:
    from ..functions.text import BLANK_RUN, CONTROL_CHARS, SPACED_BREAK
    x = f"regexp_replace({x}, '\\r\\n?', chr(10), 'g')"
    x = f"regexp_replace({x}, {lit(CONTROL_CHARS)}, '', 'g')"
    x = f"regexp_replace({x}, {lit(BLANK_RUN)}, ' ', 'g')"
    x = f"regexp_replace({x}, {lit(SPACED_BREAK)}, chr(10), 'g')"
    x = f"regexp_replace({x}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return strip(x)


ORACLE["clean_text"] = f"""
SELECT doc_id, {_clean('text')} AS cleaned, length(text) AS chars_before,
       length({_clean('text')}) AS chars_after FROM documents"""

ORACLE["strip_text"] = f"""
SELECT doc_id, {strip('text')} AS stripped, length(text) - length({strip('text')}) AS removed
FROM documents"""

_MK = lit(MARKER_PATTERN)


def _unmarked(x: str) -> str:
    """Markers removed again and again, far beyond the nesting of any given text."""
    return (f"list_reduce(list_concat([{x}], list_transform(range(20), lambda i: '')), "
            f"lambda s, i: regexp_replace(s, {_MK}, '', 'g'))")


ORACLE["special_token_guard"] = with_(DOCS) + f"""
SELECT example_id,
       coalesce(regexp_matches(instruction, {_MK}), false) OR coalesce(regexp_matches(input, {_MK}), false)
         OR coalesce(regexp_matches(output, {_MK}), false) AS had_marker,
       {_unmarked('input')} AS input, {_unmarked('output')} AS output
FROM docs"""

ORACLE["filter_rows"] = with_(DOCS) + """
SELECT d.example_id, CAST(l.quality AS BIGINT) AS quality, CAST(l.toxic AS BIGINT) AS toxic, length(d.input) AS n_in, length(d.output) AS n_out,
       concat_ws('; ', CASE WHEN l.quality <> 1 THEN 'quality' END, CASE WHEN l.toxic <> 0 THEN 'toxic' END,
                 CASE WHEN l.doc_id IS NULL THEN 'unlabelled' END,
                 CASE WHEN length(d.output) < 1 THEN 'output too short' END,
                 CASE WHEN length(d.output) > 20000 THEN 'output too long' END,
                 CASE WHEN length(d.output) > 50.0 * greatest(length(d.input), 1)
                      THEN 'output too long for its input' END) AS reason
FROM docs d LEFT JOIN labels l ON l.doc_id::VARCHAR = d.example_id"""


def _subset(src: str, pct: float) -> str:
    return f"""(SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY {md5key('example_id')}, example_id) - 1 AS idx,
         count(*) OVER (PARTITION BY source) AS group_n FROM {src})
  WHERE {'true' if pct >= 100 else f'idx < floor(group_n * CAST({pct} AS DOUBLE) / 100.0)'})"""


ORACLE["subset_pct"] = with_(PAIRS, MCQ, DOCS, PAIRS_X, ALL) + f"""
SELECT source, example_id, idx FROM {_subset('all_ex', SUBSET_PCT)}"""

ORACLE["subset_exact"] = with_(PAIRS, MCQ, DOCS, PAIRS_X, ALL) + f"""
SELECT source, example_id FROM {_subset('all_ex', SUBSET_PCT)}"""

ORACLE["mix_sources"] = with_(PAIRS, MCQ, PAIRS_X) + f"""
, mixed AS (SELECT source, example_id FROM {_subset('pairs_x', MIX_PCT)}
            UNION ALL SELECT source, example_id FROM {_subset('mcq', MIX_PCT)})
SELECT row_number() OVER (ORDER BY {md5key('source', 'example_id')}, example_id) - 1 AS pos,
       source, example_id FROM mixed"""

ORACLE["mix_lenient"] = with_(PAIRS, MCQ, PAIRS_X) + """
SELECT CAST(0 AS BIGINT) AS source_rank, source, example_id, instruction, coalesce(input, '') AS input, output FROM pairs_x
UNION ALL
SELECT CAST(1 AS BIGINT), source, example_id, instruction, '', output FROM mcq"""

ORACLE["shuffle_index"] = with_(PAIRS, MCQ, DOCS, PAIRS_X, ALL) + f"""
SELECT row_number() OVER (ORDER BY {md5key('source', 'example_id')}, example_id) - 1 AS pos,
       source, example_id FROM all_ex"""

ORACLE["mix_sources_all"] = with_(PAIRS, MCQ, PAIRS_X, CHAT) + f"""
SELECT row_number() OVER (ORDER BY {md5key('source', 'example_id')}, example_id) - 1 AS pos,
       source, example_id FROM chat_ex"""

ORACLE["sft_pairs_gaps"] = with_(PAIRS.replace("FROM conversations\n        WINDOW", "FROM spaced\n        WINDOW")
                                 .replace("FROM conversations\n", "FROM spaced\n")
                                 .replace("\npairs AS (", "\nspaced AS (SELECT * REPLACE (turn * 3 AS turn) FROM conversations),"
                                          "\npairs AS (")) + """
SELECT source, example_id, instruction, input, output, conv_id, turn FROM pairs"""

# every copy of a text is a row of its own: numbered here, keyless in the engine
ORACLE["encode_duplicates"] = with_(PAIRS, RENDERED, _V) + f"""
, src AS (SELECT row_number() OVER () AS rn, coalesce(text, '') AS t FROM documents),
arr AS (SELECT rn, {toks('t')} AS tk FROM src),
x AS (SELECT rn, unnest(tk[1:{_N}]) AS token, generate_subscripts(tk[1:{_N}], 1) AS pos FROM arr),
i AS (SELECT rn, string_agg(CAST(coalesce(v.id, 1) AS VARCHAR), ' ' ORDER BY pos) AS ids
      FROM x LEFT JOIN vocab v USING (token) GROUP BY rn)
SELECT coalesce(i.ids, '') AS input_ids, len(tk) AS n_tokens, least(len(tk), {_N}) AS length
FROM arr LEFT JOIN i USING (rn)"""

# pad = end-of-text (3): the count of other ids is what a pad-based length sees
ORACLE["prompt_len_eos_pad"] = with_(PAIRS, RENDERED, _V, _E) + f"""
SELECT example_id, len(list_filter(ids, lambda x: x <> 3)) AS len_non_pad, len(ids) AS len_true,
       array_to_string(list_concat(ids, list_transform(range({_N} - len(ids)), lambda i: 3)), ' ') AS padded
FROM enc"""

# loss everywhere after the prompt, padded positions (end-of-text, 3) included
ORACLE["encode_loss_on_padding"] = with_(PAIRS, RENDERED, _V, _E) + f"""
, p AS (SELECT example_id, prompt_tokens,
               list_concat(ids, list_transform(range({_N} - len(ids)), lambda i: 3)) AS input_ids FROM enc)
SELECT example_id, array_to_string(input_ids, ' ') AS input_ids,
       array_to_string(list_concat(list_transform(range(least(prompt_tokens, {_N})), lambda i: -100),
                                   input_ids[least(prompt_tokens, {_N}) + 1:]), ' ') AS labels
FROM p"""

ORACLE["prompt_len_variants"] = with_(PAIRS, RENDERED, _V) + f"""
, p AS (SELECT example_id, {toks('prompt')} AS pt FROM rendered)
SELECT example_id, least(len(pt), {_N}) AS prompt_len_padded, least(len(pt), {_N}) AS prompt_len_trunc,
       len(pt) AS prompt_len_full FROM p"""

ORACLE["token_profile"] = with_(PAIRS, MCQ, PAIRS_X, CHAT) + f"""
, r AS (SELECT source, {inst_prompt('instruction', 'input')} AS prompt, {inst_answer('output')} AS answer
        FROM chat_ex),
c AS (SELECT source, len({toks('prompt')}) AS prompt_tokens,
             len({toks('prompt')}) + len({toks('answer')}) AS n_tokens FROM r)
SELECT source, count(*) AS n_rows, quantile_cont(n_tokens, 0.5) AS p50_tokens,
       quantile_cont(n_tokens, 0.9) AS p90_tokens, max(n_tokens) AS max_tokens,
       round(avg(CASE WHEN n_tokens > {_N} THEN 1.0 ELSE 0.0 END), 6) AS share_truncated,
       round(avg(CASE WHEN prompt_tokens >= {_N} THEN 1.0 ELSE 0.0 END), 6) AS share_all_masked,
       CAST(sum(greatest(least(n_tokens, {_N}) - least(prompt_tokens, {_N}), 0)) AS BIGINT) AS loss_tokens
FROM c GROUP BY source"""

ORACLE["merged_token_profile"] = with_(PAIRS, MCQ, PAIRS_X, CHAT) + f"""
, r AS (SELECT source, {inst_prompt('instruction', 'input')} AS prompt, {inst_answer('output')} AS answer
        FROM chat_ex),
c AS (SELECT source, len({toks('prompt')}) AS prompt_tokens,
             len({toks('prompt')}) + len({toks('answer')}) AS n_tokens FROM r),
long AS (SELECT source, 'n_tokens' AS field, n_tokens AS n FROM c
         UNION ALL SELECT source, 'prompt_tokens', prompt_tokens FROM c)
SELECT source, field, count(*) AS n_rows, CAST(count_if(n IS NULL) AS BIGINT) AS n_null, 0::BIGINT AS n_blank,
       min(n) AS min_len, round(avg(n), 4) AS avg_len, max(n) AS max_len, count(DISTINCT n) AS n_distinct, {_WITHIN}
FROM long GROUP BY source, field"""

_NSP = len(SPECIAL_TOKENS)
ORACLE["token_view"] = with_(PAIRS, RENDERED, _V, _E) + f"""
, padded AS (
  SELECT example_id, len(ids) AS k, least(prompt_tokens, {_N}) AS prompt_len,
         list_resize(ids, {_N}, 0) AS input_ids FROM enc),
lab AS (
  SELECT example_id, k, prompt_len, input_ids,
         list_transform(range({_N}), lambda i: CASE WHEN i < k THEN 1 ELSE 0 END) AS mask,
         list_transform(input_ids, lambda x, i: CASE WHEN i - 1 < prompt_len OR i - 1 >= k
                        THEN -100 ELSE x END) AS labels FROM padded),
x AS (SELECT e.example_id, unnest(e.ids) AS id, generate_subscripts(e.ids, 1) - 1 AS pos FROM enc e),
dec AS (
  SELECT x.example_id, x.pos, x.id, coalesce(v.token, '<unk>') AS token
  FROM x LEFT JOIN vocab v ON CAST(v.id AS BIGINT) = x.id),
txt AS (
  SELECT l.example_id,
         coalesce(string_agg(d.token, ' ' ORDER BY d.pos) FILTER (WHERE d.id >= {_NSP} AND d.pos < l.prompt_len), '') AS prompt_text,
         coalesce(string_agg(d.token, ' ' ORDER BY d.pos) FILTER (WHERE d.id >= {_NSP} AND d.pos >= l.prompt_len
                  AND d.pos < l.prompt_len + 20), '') AS next_text
  FROM lab l LEFT JOIN dec d USING (example_id) GROUP BY l.example_id)
SELECT l.example_id, l.prompt_len, array_to_string(l.input_ids[1:50], ' ') AS ids_50,
       array_to_string(l.mask[1:50], ' ') AS mask_50, array_to_string(l.labels[1:50], ' ') AS labels_50,
       t.prompt_text, t.next_text
FROM lab l JOIN txt t USING (example_id)"""

ORACLE["decode_tokens"] = with_(PAIRS, RENDERED, _V, _E) + f"""
, x AS (SELECT e.example_id, unnest(e.ids) AS id, generate_subscripts(e.ids, 1) AS pos FROM enc e),
dec AS (SELECT x.example_id, x.pos, x.id, coalesce(v.token, '<unk>') AS token
        FROM x LEFT JOIN vocab v ON CAST(v.id AS BIGINT) = x.id)
SELECT e.example_id,
       coalesce(string_agg(d.token, ' ' ORDER BY d.pos) FILTER (WHERE d.id >= {_NSP}), '') AS text,
       coalesce(string_agg(d.token, ' ' ORDER BY d.pos), '') AS text_all
FROM enc e LEFT JOIN dec d USING (example_id) GROUP BY e.example_id"""


def _plan(src: str, epochs: int, bsz: int, accum: int, world: int) -> str:
    return f"""(SELECT *, pos % {world} AS rank,
        (pos // {world}) // {bsz} // {accum} AS step,
        ((pos // {world}) // {bsz}) % {accum} AS micro_step,
        ((pos // {world}) // {bsz}) * {world} + pos % {world} AS batch_id
  FROM (SELECT s.*, e.epoch,
          row_number() OVER (PARTITION BY e.epoch ORDER BY {md5key('e.epoch', 's.source', 's.example_id')},
                             s.example_id) - 1 AS pos
        FROM {src} s, range({epochs}) e(epoch)))"""


ORACLE["batch_plan"] = with_(PAIRS, MCQ, PAIRS_X, CHAT) + f"""
SELECT CAST(epoch AS BIGINT) AS epoch, source, example_id, pos, step, micro_step, batch_id
FROM {_plan('chat_ex', CFG.epochs, CFG.batch_size, CFG.grad_accum, 1)}"""

ORACLE["batch_plan_ranks"] = with_(PAIRS, MCQ, PAIRS_X, CHAT) + f"""
SELECT CAST(epoch AS BIGINT) AS epoch, source, example_id, pos, rank, step, micro_step, batch_id
FROM {_plan('chat_ex', CFG.epochs, CFG.batch_size, CFG.grad_accum, CFG.world_size)}"""

ORACLE["batch_padding"] = with_(PAIRS, RENDERED, _V, _E) + f"""
, src AS (SELECT 'dialogue' AS source, example_id, ids, prompt_tokens FROM enc),
pl AS {_plan('src', 1, CFG.batch_size, CFG.grad_accum, 1)},
b AS (SELECT *, max(len(ids)) OVER (PARTITION BY epoch, batch_id) AS batch_len FROM pl)
SELECT batch_id, example_id, batch_len,
       array_to_string(list_resize(ids, batch_len, 0), ' ') AS input_ids,
       array_to_string(list_transform(range(batch_len), lambda i: CASE WHEN i < len(ids) THEN 1 ELSE 0 END), ' ')
         AS attention_mask,
       array_to_string(list_transform(range(batch_len), lambda i:
         CASE WHEN i >= len(ids) OR i < least(prompt_tokens, {_N}) THEN -100 ELSE ids[i + 1] END), ' ') AS labels
FROM b"""

_EFF = CFG.batch_size * CFG.grad_accum * CFG.world_size
ORACLE["plan_totals"] = with_(PAIRS, MCQ, PAIRS_X, CHAT) + f"""
, r AS (SELECT source, {inst_prompt('instruction', 'input')} AS prompt, {inst_answer('output')} AS answer
        FROM chat_ex),
c AS (SELECT source, least(len({toks('prompt')}) + len({toks('answer')}), {_N}) AS length FROM r),
t AS (SELECT source, count(*) AS n_rows, CAST(sum(length) AS BIGINT) AS real_tokens FROM c GROUP BY source
      UNION ALL SELECT 'all', count(*), CAST(sum(length) AS BIGINT) FROM c)
SELECT source, n_rows, CAST({_EFF} AS BIGINT) AS effective_batch,
       CAST(ceil(n_rows / {_EFF}) AS BIGINT) AS steps_per_epoch,
       CAST(ceil(n_rows / {_EFF}) AS BIGINT) * {CFG.epochs} AS total_steps,
       real_tokens * {CFG.epochs} AS real_tokens, n_rows * {_N} * {CFG.epochs} AS padded_tokens
FROM t"""

ORACLE["vocab_roundtrip"] = ORACLE["vocab"]

ORACLE["shard_roundtrip"] = with_(PAIRS, RENDERED, _V, _E) + f"""
, src AS (SELECT 'dialogue' AS source, example_id, ids, prompt_tokens FROM enc),
pl AS {_plan('src', 1, CFG.batch_size, CFG.grad_accum, CFG.world_size)}
SELECT CAST(rank AS BIGINT) AS rank, pos // {RUN} AS run,
       row_number() OVER (PARTITION BY rank, pos // {RUN} ORDER BY pos) - 1 AS place,
       CAST(1 AS BIGINT) AS n_files, step, batch_id, example_id,
       array_to_string(list_resize(ids, {_N}, 0), ' ') AS input_ids,
       array_to_string(list_transform(list_resize(ids, {_N}, 0), lambda x, i:
         CASE WHEN i - 1 < least(prompt_tokens, {_N}) OR i - 1 >= len(ids) THEN -100 ELSE x END), ' ') AS labels
FROM pl"""

ORACLE["map_rows"] = with_(PAIRS) + f"""
SELECT example_id, {inst_prompt('instruction', 'input')} AS prompt,
       length({inst_prompt('instruction', 'input')}) AS n_chars FROM pairs"""

_WORDS = r"regexp_extract_all(coalesce({c}, ''), '[^\x20\x09-\x0D]+')"
ORACLE["map_rows_copied"] = with_(PAIRS) + f"""
, w AS (SELECT example_id, {_WORDS.format(c='input')} AS asked, {_WORDS.format(c='output')} AS answer FROM pairs),
a AS (SELECT example_id, unnest(answer) AS word, generate_subscripts(answer, 1) AS i FROM w),
q AS (SELECT example_id, unnest(asked) AS word, generate_subscripts(asked, 1) AS j FROM w),
met AS (SELECT example_id, i, i - j AS shift, i - row_number() OVER (PARTITION BY example_id, i - j ORDER BY i) AS island
        FROM a JOIN q USING (example_id, word)),
runs AS (SELECT example_id, count(*) AS n, min(i) - 1 AS start FROM met GROUP BY example_id, shift, island),
best AS (SELECT example_id, n, start FROM runs
         QUALIFY row_number() OVER (PARTITION BY example_id ORDER BY n DESC, start) = 1)
SELECT w.example_id, len(w.answer) AS n_words, coalesce(n, 0) AS copied_words, start AS copied_at
FROM w LEFT JOIN best USING (example_id)"""

ORACLE["tokenize_external"] = with_(PAIRS, RENDERED, _V, encoded_cte(10 ** 9)) + """
SELECT example_id, array_to_string(ids, ' ') AS ids, prompt_tokens AS prompt_len,
       true AS prefix_ok FROM enc"""

ORACLE["generate_batch"] = f"""
WITH p AS (SELECT conv_id || ':' || turn AS prompt_id, {role_prompt('text')} AS prompt
           FROM conversations WHERE role = 'user'),
g AS (SELECT prompt_id, prompt, prompt || 'Noted ' || length(prompt) || ' characters.' AS generated FROM p)
SELECT prompt_id, generated, {strip("replace(generated, prompt, '')")} AS answer FROM g"""

_CUT = f"""
cut AS (SELECT conv_id, min(turn) AS c FROM conversations
        WHERE role = 'user' AND length({strip('text')}) = 0 GROUP BY conv_id),
kept AS (SELECT t.* FROM conversations t LEFT JOIN cut USING (conv_id) WHERE cut.c IS NULL OR t.turn < cut.c)"""

ORACLE["chat_cut"] = with_(_CUT) + """
SELECT conv_id, turn, role FROM kept"""

_B = CFG.history_budget
_HIST = f"""
m AS (SELECT conv_id, turn, role, {history_part('role', 'text')} AS part FROM kept),
mn AS (SELECT *, CAST(len({toks('part')}) AS BIGINT) AS n FROM m),
mc AS (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn) AS c FROM mn),
pairs_h AS (
  SELECT u.conv_id, u.turn AS u, h.turn AS h, h.n, h.part
  FROM mc u JOIN mc h ON h.conv_id = u.conv_id AND h.turn <= u.turn
  WHERE u.role = 'user' AND (u.c - (h.c - h.n) <= {_B} OR h.turn = u.turn))"""

ORACLE["history_budget"] = with_(_CUT, _HIST) + """
SELECT conv_id, u AS turn, min(h) AS start_turn, count(*) AS n_messages, CAST(sum(n) AS BIGINT) AS n_tokens
FROM pairs_h GROUP BY conv_id, u"""

ORACLE["history_prompt"] = with_(_CUT, _HIST) + """
SELECT conv_id, u AS turn, string_agg(part, '' ORDER BY h) AS prompt
FROM pairs_h GROUP BY conv_id, u"""

_GEN = f"""
gen AS (
  SELECT example_id, {inst_prompt('instruction', 'input')} AS prompt, output AS expected,
         {inst_prompt('instruction', 'input')} || CASE WHEN turn % 3 = 0
           THEN regexp_replace(output, '[.!?]', '', 'g') ELSE output END AS full_text
  FROM pairs)"""

ORACLE["strip_prompt_replace"] = with_(PAIRS, _GEN) + f"""
SELECT example_id, {strip("replace(full_text, prompt, '')")} AS answer FROM gen"""

ORACLE["strip_prompt_slice"] = with_(PAIRS, RENDERED, _V, _GEN) + f"""
, t AS (SELECT example_id, len({toks('prompt')}) AS pl, {toks('full_text')} AS ft FROM gen),
x AS (SELECT example_id, pl, unnest(ft) AS token, generate_subscripts(ft, 1) AS pos FROM t),
d AS (SELECT x.example_id, x.pos, x.pl, coalesce(v.id, 1) AS id, coalesce(v.token, '<unk>') AS tok
      FROM x LEFT JOIN vocab v USING (token))
SELECT t.example_id,
       {strip("coalesce(string_agg(d.tok, ' ' ORDER BY d.pos) FILTER (WHERE d.pos > d.pl AND d.id >= " + str(_NSP) + "), '')")} AS answer
FROM t LEFT JOIN d USING (example_id) GROUP BY t.example_id"""

_CMP = f"""
cmp AS (SELECT example_id, prompt, expected, {strip("replace(full_text, prompt, '')")} AS generated FROM gen)"""

ORACLE["compare_outputs"] = with_(PAIRS, _GEN, _CMP) + """
SELECT example_id, prompt, expected, generated FROM cmp"""

ORACLE["exact_match"] = with_(PAIRS, _GEN, _CMP) + f"""
SELECT count(*) AS n_rows,
       CAST(sum(CASE WHEN {strip('generated')} = {strip('expected')} THEN 1 ELSE 0 END) AS BIGINT) AS n_exact,
       round(avg(CASE WHEN {strip('generated')} = {strip('expected')} THEN 1.0 ELSE 0.0 END), 6) AS exact_rate
FROM cmp"""

ORACLE["token_f1"] = with_(PAIRS, _GEN, _CMP) + f"""
, tk AS (SELECT example_id, {toks("coalesce(generated, '')")} AS p, {toks("coalesce(expected, '')")} AS g FROM cmp),
cp AS (SELECT example_id, t, count(*) AS c FROM (SELECT example_id, unnest(p) AS t FROM tk) GROUP BY ALL),
cg AS (SELECT example_id, t, count(*) AS c FROM (SELECT example_id, unnest(g) AS t FROM tk) GROUP BY ALL),
ov AS (SELECT cp.example_id, sum(least(cp.c, cg.c)) AS overlap FROM cp JOIN cg USING (example_id, t) GROUP BY ALL),
s AS (SELECT tk.example_id, len(p) AS np, len(g) AS ng, CAST(coalesce(ov.overlap, 0) AS BIGINT) AS overlap
      FROM tk LEFT JOIN ov USING (example_id))
SELECT example_id, np, ng, overlap,
       round(CASE WHEN np = 0 AND ng = 0 THEN 1.0 WHEN np = 0 OR ng = 0 OR overlap = 0 THEN 0.0
             ELSE 2.0 * (overlap / np) * (overlap / ng) / ((overlap / np) + (overlap / ng)) END, 6) AS f1
FROM s"""

_PRED = """
preds AS (
  SELECT 'model_a' AS model, lang AS benchmark, doc_id AS item_id,
         CASE WHEN n_chars >= 1000 THEN 1 ELSE 0 END AS predicted FROM documents
  UNION ALL
  SELECT 'model_b', lang, doc_id, CASE WHEN n_chars % 3 <> 0 THEN 1 ELSE 0 END FROM documents
  WHERE n_chars % 11 <> 0),
gold AS (SELECT l.doc_id AS item_id, d.lang AS benchmark, l.quality AS gold
         FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"""

ORACLE["accuracy_rollup"] = with_(_PRED) + """
SELECT model, benchmark, GROUPING(model, benchmark)::BIGINT AS grouping_id, count(*) AS n_items,
       CAST(sum(CASE WHEN predicted = gold THEN 1 ELSE 0 END) AS BIGINT) AS n_correct,
       count(*) FILTER (WHERE predicted IS NULL) AS n_unanswered,
       round(avg(CASE WHEN predicted = gold THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM (SELECT DISTINCT model FROM preds) m CROSS JOIN gold LEFT JOIN preds USING (model, benchmark, item_id)
GROUP BY ROLLUP (model, benchmark)"""

_SCORES = """
scores AS (
  SELECT 'model_a' AS model, lang AS benchmark, doc_id AS prompt_id, 'coherence' AS criterion,
         CAST(1 + n_chars % 5 AS DOUBLE) AS score FROM documents
  UNION ALL SELECT 'model_a', lang, doc_id, 'empathy', 1 + doc_id % 5 FROM documents
  UNION ALL SELECT 'model_a', lang, doc_id, 'factuality', 1 + (n_chars % 7) % 5 FROM documents
  UNION ALL SELECT 'model_b', lang, doc_id, 'coherence', 1 + (n_chars + 2) % 5 FROM documents
  UNION ALL SELECT 'model_b', lang, doc_id, 'empathy', 1 + (doc_id + 1) % 5 FROM documents
  UNION ALL SELECT 'model_b', lang, doc_id, 'factuality', 1 + (n_chars % 11) % 5 FROM documents)"""

ORACLE["rubric_pivot"] = with_(_SCORES) + """
SELECT model,
       round(avg(score) FILTER (WHERE criterion = 'coherence'), 6) AS coherence,
       round(avg(score) FILTER (WHERE criterion = 'empathy'), 6) AS empathy,
       round(avg(score) FILTER (WHERE criterion = 'factuality'), 6) AS factuality
FROM scores GROUP BY model"""

ORACLE["win_tie_loss"] = with_(_SCORES) + """
, per AS (SELECT benchmark, prompt_id,
                 sum(score) FILTER (WHERE model = 'model_a') AS sa,
                 sum(score) FILTER (WHERE model = 'model_b') AS sb
          FROM scores GROUP BY benchmark, prompt_id)
SELECT benchmark, CAST(sum(CASE WHEN sa > sb THEN 1 ELSE 0 END) AS BIGINT) AS wins,
       CAST(sum(CASE WHEN sa = sb THEN 1 ELSE 0 END) AS BIGINT) AS ties,
       CAST(sum(CASE WHEN sa < sb THEN 1 ELSE 0 END) AS BIGINT) AS losses
FROM per WHERE sa IS NOT NULL AND sb IS NOT NULL GROUP BY benchmark"""

ORACLE["retrieve_topk"] = """
WITH x AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS p FROM embeddings),
m AS (SELECT label, p, avg(x) AS m FROM x GROUP BY label, p),
q AS (SELECT label::BIGINT AS query_id, list(m ORDER BY p) AS qv FROM m GROUP BY label),
c AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (SELECT q.query_id, c.vec_id,
             round(list_dot_product(q.qv, c.v) / (sqrt(list_dot_product(q.qv, q.qv)) * sqrt(list_dot_product(c.v, c.v))), 6) AS sim
      FROM q, c)
SELECT query_id, vec_id, sim, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, vec_id) AS rank FROM s)
WHERE rank <= 5"""

ORACLE["retrieve_cells"] = ORACLE["retrieve_topk"]

from .catalog import TRAIN_PCT  # noqa: E402

def _training(chat: str, pct: float, order: str | None = None) -> str:
    """Clean, guard, validate, subset, render, vocabulary, encode, plan, pad, mask.
    ``order``: expressions that order an epoch; default the seeded key."""
    made = {c: _unmarked(_clean(c)) for c in ("instruction", "input", "output")}
    ready = f"""
ready AS (SELECT source, example_id, {', '.join(f'{x} AS {c}' for c, x in made.items())} FROM {chat}),
valid AS (SELECT * FROM ready
          WHERE instruction IS NOT NULL AND length({strip('instruction')}) > 0
            AND output IS NOT NULL AND length({strip('output')}) > 0),
sub AS {_subset('valid', pct)},
rtrain AS (SELECT source, example_id, source || ':' || example_id AS uid,
                  {inst_prompt('instruction', 'input')} AS prompt, {inst_answer('output')} AS answer
           FROM sub)"""
    plan = _plan('src', CFG.epochs, CFG.batch_size, CFG.grad_accum, CFG.world_size)
    if order:
        plan = plan.replace(f"ORDER BY {md5key('e.epoch', 's.source', 's.example_id')}", f"ORDER BY {order}")
    return ", ".join(x.strip("\n") for x in (ready, vocab_cte(CFG.vocab_size, texts="rtrain"),
                                             encoded_cte(CFG.max_len, src="rtrain", key="uid"))) + f"""
, src AS (SELECT r.source, r.example_id, e.ids, e.prompt_tokens FROM enc e JOIN rtrain r USING (uid)),
pl AS {plan}
SELECT CAST(epoch AS BIGINT) AS epoch, CAST(rank AS BIGINT) AS rank, step,
       CAST(micro_step AS BIGINT) AS micro_step, batch_id, pos, source, example_id,
       array_to_string(list_resize(ids, {_N}, 0), ' ') AS input_ids,
       array_to_string(list_transform(list_resize(ids, {_N}, 0), lambda x, i:
         CASE WHEN i - 1 < least(prompt_tokens, {_N}) OR i - 1 >= len(ids) THEN -100 ELSE x END), ' ') AS labels,
       least(prompt_tokens, {_N}) AS prompt_len, len(ids) AS length, 'inst' AS template
FROM pl"""


ORACLE["training_set"] = with_(PAIRS, MCQ, PAIRS_X, CHAT) + ", " + _training("chat_ex", TRAIN_PCT)
ORACLE["training_set_all"] = with_(PAIRS, MCQ, PAIRS_X, CHAT) + ", " + _training("chat_ex", 100.0)
ORACLE["shards_from_step"] = f"""
SELECT * FROM ({ORACLE["training_set_all"]}) t
WHERE step >= (SELECT (max(step) + 1) // 2 FROM ({ORACLE["training_set_all"]}) u)"""
ORACLE["json_training_set"] = with_(PAIRS, MCQ, PAIRS_X, CHAT) + f"""
, rec AS (SELECT source, instruction, input, output,
                 md5(coalesce(instruction, '') || chr(31) || coalesce(input, '') || chr(31) || coalesce(output, '')) AS h
          FROM chat_ex),
numbered AS (SELECT source, h || '-' || row_number() OVER (PARTITION BY source, h) AS example_id,
                    instruction, input, output FROM rec), """ + _training(
    "numbered", 100.0, "s.source, md5(s.example_id)")

_DUP = {c: _unmarked(_clean(c)) for c in ("instruction", "input", "output")}
ORACLE["training_set_duplicates"] = with_(DOCS) + f"""
, dup AS (SELECT docs.source, CASE WHEN coalesce(d.source, '') <> 'src0' THEN d.lang END AS example_id, instruction, input,
                 concat_ws(chr(10), input, output) AS output
          FROM docs JOIN documents d ON docs.example_id = d.doc_id::VARCHAR),
ready AS (SELECT source, example_id, {', '.join(f'{x} AS {c}' for c, x in _DUP.items())} FROM dup),
rtrain AS (SELECT source, example_id, row_number() OVER () AS uid, {inst_prompt('instruction', 'input')} AS prompt,
                  {inst_answer('output')} AS answer
           FROM ready WHERE length({strip('instruction')}) > 0 AND length({strip('output')}) > 0), """ + ", ".join(
    x.strip("\n") for x in (vocab_cte(CFG.vocab_size, texts="rtrain"), encoded_cte(CFG.max_len, src="rtrain", key="uid"))) + f"""
SELECT epoch, source, example_id, array_to_string(list_resize(ids, {_N}, 0), ' ') AS input_ids,
       array_to_string(list_transform(list_resize(ids, {_N}, 0), lambda x, i:
         CASE WHEN i - 1 < least(prompt_tokens, {_N}) OR i - 1 >= len(ids) THEN -100 ELSE x END), ' ') AS labels,
       len(ids) AS length, count(*) AS copies
FROM enc JOIN rtrain USING (uid), (SELECT unnest(range({CFG.epochs})) AS epoch) GROUP BY ALL"""

ORACLE["history_stream"] = with_(_CUT, _HIST) + """
SELECT conv_id, u AS turn, min(h) AS start_turn, count(*) AS n_messages, CAST(sum(n) AS BIGINT) AS n_tokens,
       string_agg(part, '' ORDER BY h) AS prompt
FROM pairs_h GROUP BY conv_id, u"""

ORACLE["history_seeded"] = ORACLE["history_stream"]

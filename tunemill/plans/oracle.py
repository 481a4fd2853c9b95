"""DuckDB statements of the registered queries (the correctness oracle).

Each statement restates the query's semantics from the tables alone; shared
pieces (token pattern, strip class, templates) come from ``config`` so both
sides use the same fixed values.
"""

from __future__ import annotations

from ..config import (ALPACA_CLOSE, ALPACA_HEAD, ALPACA_INPUT, ALPACA_RESPONSE,
                      DOCS_INSTRUCTION, DOCTOR_INSTRUCTION, HISTORY_OTHER_TAIL,
                      HISTORY_USER_HEAD, HISTORY_USER_TAIL, INST_ANSWER_TAIL,
                      INST_PROMPT_HEAD, INST_PROMPT_TAIL, MARKER_PATTERN,
                      MCQ_INSTRUCTION, MCQ_NO_OPTION, ROLE_PROMPT_HEAD,
                      SINGLE_TURN_TAIL, SPECIAL_TOKENS, STRIP_PATTERN,
                      TOKEN_PATTERN)


def lit(s: str) -> str:
    """SQL string literal; newlines become chr(10) concatenations."""
    parts = s.split("\n")
    quoted = ["'" + p.replace("'", "''") + "'" for p in parts]
    return "(" + " || chr(10) || ".join(quoted) + ")" if len(parts) > 1 else quoted[0]


def strip(x: str) -> str:
    return f"regexp_replace({x}, {lit(STRIP_PATTERN)}, '', 'g')"


def toks(x: str) -> str:
    return f"regexp_extract_all({x}, {lit(TOKEN_PATTERN)}, 0)"


def inst_prompt(i: str, x: str) -> str:
    return f"({lit(INST_PROMPT_HEAD)} || {i} || ' ' || coalesce({x}, '') || {lit(INST_PROMPT_TAIL)})"


def inst_answer(o: str) -> str:
    return f"({o} || {lit(INST_ANSWER_TAIL)})"


def alpaca_prompt(i: str, x: str) -> str:
    inp = strip(f"coalesce({x}, '')")
    return (f"({lit(ALPACA_HEAD)} || {strip(i)} || CASE WHEN length({inp}) > 0 "
            f"THEN {lit(ALPACA_INPUT)} || {inp} ELSE '' END || {lit(ALPACA_CLOSE)})")


def alpaca_answer(o: str) -> str:
    return f"({lit(ALPACA_RESPONSE)} || {strip(o)} || {lit(INST_ANSWER_TAIL)})"


def role_prompt(u: str) -> str:
    return f"({lit(ROLE_PROMPT_HEAD)} || {u} || {lit(INST_PROMPT_TAIL)})"


def single_turn(m: str) -> str:
    return f"({lit(ALPACA_HEAD)} || {strip(m)} || {lit(SINGLE_TURN_TAIL)})"


def history_part(role: str, text: str) -> str:
    return (f"CASE WHEN {role} = 'user' THEN {lit(HISTORY_USER_HEAD)} || {strip(text)} || "
            f"{lit(HISTORY_USER_TAIL)} ELSE {strip(text)} || {lit(HISTORY_OTHER_TAIL)} END")


# ----------------------------------------------------------------- sources
PAIRS = f"""
pairs AS (
  SELECT 'dialogue' AS source, u.conv_id || ':' || u.turn AS example_id,
         coalesce(s.system_text, {lit(DOCTOR_INSTRUCTION)}) AS instruction,
         u.text AS input, u.next_text AS output, u.conv_id, u.turn
  FROM (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text FROM conversations
        WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) u
  LEFT JOIN (SELECT conv_id, arg_min(text, turn) AS system_text FROM conversations
             WHERE role = 'system' GROUP BY conv_id) s ON s.conv_id = u.conv_id
  WHERE u.role = 'user' AND u.next_role = 'assistant')"""

MCQ = f"""
mcq AS (
  SELECT 'mcq' AS source, item_id::VARCHAR AS example_id, {lit(MCQ_INSTRUCTION)} AS instruction,
         CASE WHEN strpos(text, '.') > 0 THEN substr(text, 1, strpos(text, '.')) ELSE text END AS input,
         CASE WHEN strpos(text, '.') > 0 THEN {strip("substr(text, strpos(text, '.') + 1)")}
              ELSE '' END AS output
  FROM benchmark)"""

DOCS = f"""
docs AS (
  SELECT 'docs' AS source, doc_id::VARCHAR AS example_id, {lit(DOCS_INSTRUCTION)} AS instruction,
         CASE WHEN strpos(text, chr(10)) > 0 THEN split_part(text, chr(10), 1) ELSE text END AS input,
         CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1)
              ELSE '' END AS output
  FROM documents)"""

RENDERED = f"""
rendered AS (
  SELECT example_id, conv_id, turn, {inst_prompt('instruction', 'input')} AS prompt,
         {inst_answer('output')} AS answer FROM pairs)"""


def vocab_cte(vocab_size: int, texts: str = "rendered", cols=("prompt", "answer")) -> str:
    specials = ", ".join(f"({lit(t)}, {i})" for i, t in enumerate(SPECIAL_TOKENS))
    arr = " || ".join(toks(c) for c in cols)
    n_sp = len(SPECIAL_TOKENS)
    return f"""
specials(token, id) AS (VALUES {specials}),
tok_counts AS (
  SELECT token, count(*) AS n FROM (SELECT unnest({arr}) AS token FROM {texts}) GROUP BY token),
learned AS (
  SELECT token, n, CAST(row_number() OVER (ORDER BY n DESC, token) + {n_sp - 1} AS BIGINT) AS id
  FROM tok_counts WHERE token NOT IN (SELECT token FROM specials)
  QUALIFY id < {vocab_size}),
vocab AS (
  SELECT s.token, CAST(s.id AS BIGINT) AS id, CAST(coalesce(c.n, 0) AS BIGINT) AS n
  FROM specials s LEFT JOIN tok_counts c USING (token)
  UNION ALL SELECT token, id, n FROM learned)"""


def encoded_cte(max_len: int, src: str = "rendered", key: str = "example_id") -> str:
    """ids per example (truncated to max_len), prompt token count, total count."""
    return f"""
tok_arr AS (
  SELECT {key}, {toks('prompt')} AS pt, {toks('answer')} AS atk FROM {src}),
tok_rows AS (
  SELECT {key}, len(pt) AS prompt_tokens, len(pt) + len(atk) AS n_tokens,
         (pt || atk)[1:{max_len}] AS tk FROM tok_arr),
tok_x AS (
  SELECT {key}, unnest(tk) AS token, generate_subscripts(tk, 1) AS pos FROM tok_rows),
tok_ids AS (
  SELECT x.{key}, list(CAST(coalesce(v.id, 1) AS BIGINT) ORDER BY x.pos) AS ids
  FROM tok_x x LEFT JOIN vocab v USING (token) GROUP BY x.{key}),
enc AS (
  SELECT r.{key}, r.prompt_tokens, r.n_tokens, coalesce(i.ids, []::BIGINT[]) AS ids
  FROM tok_rows r LEFT JOIN tok_ids i USING ({key}))"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes)


__all__ = ["lit", "strip", "toks", "with_", "PAIRS", "MCQ", "DOCS", "RENDERED",
           "vocab_cte", "encoded_cte", "MARKER_PATTERN", "MCQ_NO_OPTION",
           "inst_prompt", "inst_answer", "alpaca_prompt", "alpaca_answer",
           "role_prompt", "single_turn", "history_part"]

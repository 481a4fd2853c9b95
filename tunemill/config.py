"""Job configuration and the fixed values every job shares.

Everything that must be byte-identical to the reference's behaviour (prompt
texts, marker strings, the label sentinel, default seeds and lengths) lives
in the block marked FIXED VALUES below, stated once in natural order.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference's strings and defaults)
# ---------------------------------------------------------------------------
BOS = "<s>"
EOS = "</s>"
INST_OPEN = "[INST]"
INST_CLOSE = "[/INST]"

# inst template: prompt "<s>[INST] {instruction} {input} [/INST] ", answer "{output} </s>"
INST_PROMPT_HEAD = "<s>[INST] "
INST_PROMPT_TAIL = " [/INST] "
INST_ANSWER_TAIL = " </s>"

# alpaca template (fields stripped, input section only when non-empty)
ALPACA_HEAD = (
    "<s>[INST] Below is an instruction that describes a task. "
    "Write a response that appropriately completes the request.\n\n"
    "### Instruction:\n"
)
ALPACA_INPUT = "\n\n### Input:\n"
ALPACA_CLOSE = " [/INST]"
ALPACA_RESPONSE = "\n\n### Response:\n"

# single-turn alpaca prompt: ALPACA_HEAD + "{msg}" + SINGLE_TURN_TAIL
SINGLE_TURN_TAIL = "\n[/INST] "

# fixed-role inference prompt: ROLE_PROMPT_HEAD + "{user}" + " [/INST] "
DOCTOR_INSTRUCTION = (
    "You are a medical doctor expert. Here is a conversation with a "
    "patient—give them a solution or an answer:"
)
ROLE_PROMPT_HEAD = "<s>[INST] " + DOCTOR_INSTRUCTION + " "

# chat history rendering: user -> "<s>[INST] {msg} [/INST] ", any other role -> "{msg} </s>"
HISTORY_USER_HEAD = "<s>[INST] "
HISTORY_USER_TAIL = " [/INST] "
HISTORY_OTHER_TAIL = " </s>"

# MCQ text: "Question: {q}\nOptions: A) .. B) .. C) .. D) ..\nAnswer:"
MCQ_LETTERS = ("A", "B", "C", "D")

LABEL_IGNORE = -100
DEFAULT_SEED = 42
DEFAULT_MAX_LEN = 1024
DEFAULT_HISTORY_BUDGET = 896
PREVIEW_CHARS = 200
PREVIEW_ELLIPSIS = "…"
# ---------------------------------------------------------------------------

# Our own choices (not from the reference).
MCQ_INSTRUCTION = "Answer the following medical question."
DOCS_INSTRUCTION = "Continue the medical text."
MCQ_NO_OPTION = "None of the above"

# Python's str.strip() whitespace set, spelled out so that the JVM regex
# engine and RE2 (used by the SQL oracle) agree code point for code point.
_WS_RANGES = ((0x9, 0xD), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
              (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F),
              (0x3000, 0x3000))
WS_CLASS = "".join(rf"\x{{{lo:X}}}" + (rf"-\x{{{hi:X}}}" if hi > lo else "") for lo, hi in _WS_RANGES)
STRIP_PATTERN = rf"^[{WS_CLASS}]+|[{WS_CLASS}]+$"
# The same set as characters, for the JVM's set-based trim (no regex scan).
WS_CHARS = "".join(chr(c) for lo, hi in _WS_RANGES for c in range(lo, hi + 1))

# Token pattern of the built-in tokenizer: markers, letter/digit runs, and
# every other non-space character on its own.
TOKEN_PATTERN = rf"</?s>|\[/?INST\]|[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}{WS_CLASS}]"
MARKER_PATTERN = r"</?s>|\[/?INST\]"

# Reserved vocabulary ids; learned tokens follow them.
SPECIAL_TOKENS = ("<pad>", "<unk>", BOS, EOS, INST_OPEN, INST_CLOSE)
PAD_TOKEN_ID = 0
UNK_TOKEN_ID = 1
BOS_TOKEN_ID = 2
EOS_TOKEN_ID = 3


@dataclass(frozen=True)
class SftConfig:
    """Parameters of one data-preparation job (replaces command-line flags)."""

    template: str = "inst"  # "inst" | "alpaca"
    max_len: int = DEFAULT_MAX_LEN
    seed: int = DEFAULT_SEED
    train_pct: float = 100.0
    shuffle: bool = True  # False: sources one after the other, each in the order of its keys' md5
    clean: bool = True  # formatting clean-up of all fields
    guard: bool = True  # remove sequence and role markers from all fields
    drop_all_masked: bool = False  # leave out rows whose prompt fills max_len
    vocab_size: int = 32000
    pad_id: int | None = PAD_TOKEN_ID  # None -> falls back to the end-of-text id
    eos_id: int = EOS_TOKEN_ID
    unk_id: int = UNK_TOKEN_ID
    mask_padding: bool = True  # False reproduces loss on padded positions
    batch_size: int = 2
    grad_accum: int = 4
    epochs: int = 1
    world_size: int = 1
    history_budget: int = DEFAULT_HISTORY_BUDGET
    align_to_user: bool = False
    # order-preserving index: hex digits of the md5 key used as range buckets
    index_prefix_hex: int = 4

    @property
    def effective_pad_id(self) -> int:
        return self.eos_id if self.pad_id is None else self.pad_id

    def with_(self, **kw) -> "SftConfig":
        return replace(self, **kw)

"""Chat history on a stream (X5): ``transformWithStateInPandas`` over groups of conversations.

Turns may arrive in any order. Conversations are dealt out to ``GROUPS`` groups by the hash of their id, and the state of
a group is typed, kept in RocksDB, and has entries per conversation: the last turn processed, whether
the chat has ended (first blank user message, F2) and which turns wait (``chat``), the kept messages (``history``), and
the turns that wait for earlier ones, by conversation and turn number (``waiting``). A trigger reads and writes only
the entries of the conversations it has turns of, and the messages only when a turn is processed; what Spark spends on
a group (a frame in, a frame out) is shared by its conversations. A turn is processed when its predecessor number has been;
behind a gap turns wait until more than ``hold`` of them do, then the smallest goes on without the missing
ones. A turn that arrives after it was skipped, or twice, is not lost: it comes out
as a row with a ``reason`` (the side table), and so does a row without a conversation or a turn
number, which meets no state. Rendering and token counts are computed
in the JVM before the stateful step.

State stays small: the history is cut back to the budget after every message, so it
holds one budget of tokens and at most ``hold`` waiting turns, however long the conversation.

A backlog need not go through the stream: ``history_state`` makes the state that a conversation
has after its turns in a batch table, and the stream starts from it.

A finite input has an end: ``whole_history`` then gives what the batch form gives,
with the conversations in which turns were skipped or still wait rebuilt by it, from
their turns in the backlog on if the stream began with one.
"""

from __future__ import annotations

import time

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..functions.text import is_blank, tokenize
from ..operators.history import BLOCK, SALTS, history_budget, history_messages
from ..operators.templates import history_part
from ..schemas import TURNS
from ..session import materialize, shared_path
from ..sources.io import read_turn_stream

OUTPUT_SCHEMA = ("conv_id long, turn long, start_turn long, n_messages long, "
                 "n_tokens long, prompt string, reason string")
COLUMNS = [c.split()[0] for c in OUTPUT_SCHEMA.split(", ")]
MESSAGE = "turn long, role string, part string, n long"
HOLD = 64
GROUPS = 1024  # groups of conversations
LONE = 256  # groups of rows without a conversation or turn number
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Chat:
    """One conversation while a trigger has turns of it: its entries in the state of its group."""

    def __init__(self, conv: int, state: History):
        self.conv, self.state = conv, state
        self.ended, self.last_turn, self.held, _ = state.chat.getValue((conv,)) or (False, -1, [], None)
        self.held = dict.fromkeys(self.held)  # messages are read when they are processed
        self.new: set[int] = set()
        self.gone: set[int] = set()
        self.kept = None

    def add(self, turn: int, message: tuple) -> None:
        if turn <= self.last_turn or turn in self.held:
            twice = turn in self.held or turn == self.last_turn
            self.state.out.append((self.conv, turn, None, None, None, None, "repeated" if twice else "late"))
        else:
            self.held[turn] = message
            self.new.add(turn)
            self.catch_up(self.state.hold)

    def catch_up(self, wait: int) -> None:
        while self.held and ((turn := min(self.held)) == self.last_turn + 1 or len(self.held) > wait):
            message = self.held.pop(turn)
            if turn in self.new:
                self.new.remove(turn)
            else:
                self.gone.add(turn)
                message = message or self.state.waiting.getValue((self.conv, turn))
            role, part, n, blank = message
            self.last_turn = turn
            self.ended = self.ended or (role == "user" and blank)
            if self.ended:
                continue
            if self.kept is None:
                self.kept = [tuple(m) for m in (self.state.history.getValue((self.conv,)) or ([],))[0]]
                self.tokens = sum(m[3] for m in self.kept)
            # what does not fit now fits no later turn either
            self.kept.append((turn, role, part, n))
            self.tokens += n
            while self.tokens > self.state.budget and len(self.kept) > 1:
                self.tokens -= self.kept.pop(0)[3]
            if role == "user":
                kept = self.kept
                if self.state.align:
                    kept = kept[next(i for i, m in enumerate(kept) if m[1] == "user"):]
                self.state.out.append((self.conv, turn, kept[0][0], len(kept), sum(m[3] for m in kept), "".join(m[2] for m in kept), ""))

    def store(self, until: int | None) -> None:
        self.state.chat.updateValue((self.conv,), (self.ended, self.last_turn, sorted(self.held), until))
        if self.kept is not None:
            self.state.history.updateValue((self.conv,), (self.kept,))
        for t in self.gone:
            self.state.waiting.removeKey((self.conv, t))
        for t in self.new:
            self.state.waiting.updateValue((self.conv, t), self.held[t])

    def forget(self) -> None:
        """Nothing more is waited for, its state goes."""
        self.catch_up(0)
        for t in self.gone:
            self.state.waiting.removeKey((self.conv, t))
        for state in (self.state.chat, self.state.history):
            state.removeKey((self.conv,))


class History(StatefulProcessor):
    """The kept histories of a group of conversations."""

    def __init__(self, budget: int, align_to_user: bool, idle_timeout_ms: int | None, hold: int):
        self.budget, self.align, self.idle, self.hold = budget, align_to_user, idle_timeout_ms, hold

    def init(self, handle) -> None:
        self.handle = handle
        self.chat = handle.getMapState("chat", "conv_id long", "ended boolean, last_turn long, held array<long>, until long")
        self.history = handle.getMapState("history", "conv_id long", f"kept array<struct<{MESSAGE.replace(' ', ':').replace(',:', ',')}>>")
        self.waiting = handle.getMapState("waiting", "conv_id long, turn long", "role string, part string, n long, blank boolean")

    def handleInitialState(self, key, state, timer) -> None:
        for r in state.itertuples():
            self.chat.updateValue((int(r.conv_id),), (bool(r.ended), int(r.last_turn), [], None))
            if len(r.kept):
                self.history.updateValue((int(r.conv_id),), ([(int(m["turn"]), m["role"], m["part"], int(m["n"])) for m in r.kept],))

    def handleInputRows(self, key, rows, timer):
        for pdf in rows:
            if key[0] < 0:  # rows without a conversation or a turn number
                none = pd.array([None] * len(pdf), "Int64")
                yield pd.DataFrame({"conv_id": pdf["conv_id"].astype("Int64"), "turn": pdf["turn"].astype("Int64"), "start_turn": none,
                                    "n_messages": none, "n_tokens": none, "prompt": [None] * len(pdf), "reason": pdf["missing"]})
                continue
            self.out: list[tuple] = []
            until = int(time.time() * 1000) + self.idle if self.idle else None
            chats: dict[int, Chat] = {}
            for conv, turn, role, part, n, blank in zip(*(pdf[c].tolist() for c in ("conv", "at", "role", "part", "n", "blank"))):
                if conv not in chats:
                    chats[conv] = Chat(conv, self)
                chats[conv].add(turn, (role, part, n, blank))
            for chat in chats.values():
                chat.store(until)
            if self.idle and next(iter(self.handle.listTimers()), None) is None:  # one timer a group
                self.handle.registerTimer(until)
            yield self.rows()

    def handleExpiredTimer(self, key, timer, expired):
        """Conversations of the group that are idle go; the timer is set for the next one."""
        self.out = []
        now, left = int(time.time() * 1000), []
        for (conv,), (_, _, _, until) in list(self.chat.iterator()):
            if until is not None and until <= now:
                Chat(conv, self).forget()
            elif until is not None:
                left.append(until)
        if left:
            self.handle.registerTimer(max(min(left), now + self.idle // 16))
        yield self.rows()

    def rows(self) -> pd.DataFrame:
        return pd.DataFrame(self.out, columns=COLUMNS).astype({c: "Int64" for c in COLUMNS[:5]})


def _group(conv) -> Column:
    return F.pmod(F.xxhash64(F.col(conv).cast("long")), F.lit(GROUPS)).cast("int")


def _keyed(turns: DataFrame) -> DataFrame:
    """Turns rendered and counted, with their group: rows without a conversation or a turn number are
    dealt out by content (groups below 0), not all to one."""
    text = F.coalesce("text", F.lit(""))
    t = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), history_part(F.coalesce("role", F.lit("")), text).alias("part"),
                     F.coalesce((F.col("role") == "user") & is_blank(text), F.lit(False)).alias("blank"))
    missing = F.concat_ws("; ", F.when(F.col("conv_id").isNull(), "no conversation"), F.when(F.col("turn").isNull(), "no turn number"))
    t = t.withColumn("n", F.size(tokenize("part")).cast("long")).withColumn("missing", missing)
    lone = F.when(F.col("missing") != "", -1 - F.pmod(F.xxhash64("part", "turn"), F.lit(LONE)))
    return (t.withColumn("grp", F.coalesce(lone.cast("int"), _group("conv_id")))
            .withColumn("conv", F.coalesce("conv_id", F.lit(0)).cast("long")).withColumn("at", F.coalesce("turn", F.lit(0)).cast("long")))


def history_state(turns: DataFrame, budget: int) -> DataFrame:
    """The state of every conversation after ``turns`` (a batch table): ``conv_id``, ``ended``, ``last_turn`` and ``kept``, the
    messages of the longest end of the chat that fits the budget (a budget's worth at most). A chat has ended if its last
    message is not that of its last turn (of several rows with one turn number, only the one that counts ends a chat)."""
    known = turns.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    ends = known.groupBy("conv_id").agg(F.max("turn").alias("last_turn"))
    m = history_messages(turns)
    last = m.groupBy("conv_id").agg(F.max("turn").alias("at"), F.max(F.col("cb") + F.col("n")).alias("total")).select(
        F.col("conv_id").alias("c"), "at", "total", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    j = m.join(last, (F.col("conv_id") == F.col("c")) & (F.pmod(F.floor(F.col("turn") / BLOCK), F.lit(SALTS)) == F.col("salt")))
    kept = (j.where((F.col("cb") >= F.col("total") - budget) | (F.col("turn") == F.col("at"))).groupBy("conv_id")
            .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "part", "n"))).alias("kept")))
    none = F.array().cast("array<struct<turn:bigint,role:string,part:string,n:bigint>>")
    ended = ~F.element_at("kept", -1)["turn"].eqNullSafe(F.col("last_turn"))
    return ends.join(kept, "conv_id", "left").select("conv_id", ended.alias("ended"), "last_turn", F.coalesce("kept", none).alias("kept"))


def history_stream(turns: DataFrame, budget: int, align_to_user: bool = False,
                   idle_timeout_ms: int | None = None, hold: int = HOLD, state: DataFrame | None = None) -> DataFrame:
    """Streaming turns -> one row per user turn with its kept history
    (``reason`` ''), and one per late or repeated turn. ``hold=0`` waits for nothing:
    for input that is in order but for gaps. ``state`` (``history_state``) is what conversations begin with.

    The session needs RocksDB state (``STORE``), as ``run_history_stream`` sets it in a session of its own.
    ``idle_timeout_ms`` (off by default, as in the reference, which never
    expires history) drops the state of a conversation idle for that long by a timer,
    bounding state on an endless stream. It is for continuous queries
    (processing-time triggers).
    """
    begin = None
    if state is not None:
        begin = state.select(_group("conv_id").alias("grp"), "conv_id", "ended", "last_turn", "kept").groupBy("grp")
    return _keyed(turns).groupBy("grp").transformWithStateInPandas(
        History(budget, align_to_user, idle_timeout_ms, hold), OUTPUT_SCHEMA, "Append",
        "ProcessingTime" if idle_timeout_ms else "None", initialState=begin)


def run_history_stream(spark: SparkSession, path: str, budget: int,
                       files_per_trigger: int = 1, align_to_user: bool = False,
                       state_partitions: int | None = None, sink: str | None = None,
                       hold: int = HOLD, state: DataFrame | None = None) -> DataFrame:
    """Runs the stream over every file available under ``path`` (availableNow)
    into a parquet sink in the shared folder and returns the sink as a table.
    With ``sink`` (a folder of the caller's) a restarted query resumes where it
    stopped; without it every call makes a new folder and starts anew. Turns that
    were skipped or still wait are not in the table: see ``whole_history``.

    ``state_partitions`` (default: the cluster's cores) is the number of state
    store partitions. Spark fixes it from ``spark.sql.shuffle.partitions`` when
    the query first starts, and a value sized for batch shuffles of a huge
    table is a poor state layout, so the query has a session of its own. ``state``
    (``history_state``) is read when the query first starts.
    """
    own = spark.newSession()  # its settings are its own: no other job sees them
    own.conf.set("spark.sql.shuffle.partitions", str(state_partitions or spark.sparkContext.defaultParallelism))
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    if state is not None:  # a written table, read by the stream's session
        begin = shared_path(spark, "history-state")
        state.write.parquet(begin)
        state = own.read.parquet(begin)
    out = history_stream(read_turn_stream(own, path, files_per_trigger), budget, align_to_user, hold=hold, state=state)
    sink = sink or shared_path(spark, "history-stream")
    q = (out.writeStream.format("parquet").outputMode("append")
         .option("path", f"{sink}/data")
         .option("checkpointLocation", f"{sink}/checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return read_history(spark, sink)


def read_history(spark: SparkSession, sink: str) -> DataFrame:
    """The histories written so far."""
    return spark.read.schema(OUTPUT_SCHEMA).parquet(f"{sink}/data").where("reason = ''").drop("reason")


def read_late(spark: SparkSession, sink: str) -> DataFrame:
    """The side table: turns that came too late or twice, with the reason."""
    return (spark.read.schema(OUTPUT_SCHEMA).parquet(f"{sink}/data").where("reason <> ''")
            .select("conv_id", "turn", "reason"))


def whole_history(spark: SparkSession, path: str, sink: str, budget: int,
                  align_to_user: bool = False, backlog: DataFrame | None = None) -> DataFrame:
    """After a run over all files under ``path`` into ``sink``: exactly ``history_budget``
    of all turns. A conversation whose turns are 0, 1, 2, ... and of which the side
    table has none went through the stream in order; all others are computed anew.
    ``backlog``: the turns with whose ``history_state`` the stream began. The result has their histories too; the
    turns of a conversation go on from its last one there, and those computed anew are computed with it."""
    turns = spark.read.schema(TURNS).parquet(path)
    per = turns.groupBy("conv_id").agg(F.min("turn").alias("a"), F.max("turn").alias("b"), F.count(F.lit(1)).alias("n"))
    first = F.lit(0)
    if backlog is not None:
        done = backlog.groupBy("conv_id").agg(F.max("turn").alias("done"))
        per, first = per.join(done, "conv_id", "left"), F.coalesce(F.col("done") + 1, F.lit(0))
    waiting = per.where((F.col("a") != first) | (F.col("b") - F.col("a") != F.col("n") - 1)).select("conv_id")
    waiting = waiting.where("conv_id is not null")
    late = read_late(spark, sink).where("conv_id is not null and turn is not null").select("conv_id")
    anew = materialize(late.union(waiting).distinct(), "history-anew")
    again = turns.join(anew, "conv_id", "left_semi")
    if backlog is not None:
        again = backlog.select(*again.columns).unionByName(again)
    rebuilt = history_budget(again, budget, align_to_user)
    return read_history(spark, sink).join(anew, "conv_id", "left_anti").unionByName(rebuilt)

"""Repair of conversations by depth-first branch-and-bound over edits.

The messages of a conversation, by turn, are kept, given another role, deleted, or
joined by inserted empty messages, until the initials of their roles read
``(s?(ua)+)?``: perhaps a system message, then user and assistant in turns, or
nothing.  The edits of least cost are sought and, of several, those whose letters
(D, I, K, R in order: the *audit*) come first in ASCII order.

The search (``cheapest_edits``).  A node is the number of messages dealt with and
what the pattern expects next.  An explicit stack holds the branches still to try; they
are taken in ASCII order of their letters, so of two prefixes that reach one node
the earlier has the smaller audit, and a later one only matters if it costs less:
the *dominance table* keeps the least cost met at each node.  A branch is also cut
where its cost and the *suffix lower bound* reach the *incumbent*, the best complete audit so
far.  The bound is the least cost of the messages left if they might end anywhere in the
pattern.  When the stack is empty the incumbent is proved best.

Spark.  A first shuffle by conversation carries no text, only the role's initial, what
is wrong with the text, and a digest of both; sorted, it streams through Python, which
keeps some bytes a message of one conversation at a time, solves it and gives
a *plan* (faults, cost, audit).  A second one brings the texts, sorted behind their
plan, and streams them past its letters.  So no task holds the texts of a conversation
however long it is; a task does take all messages of each of its conversations, one after the other,
as an audit and a digest of the whole conversation ask for.  Conversations of one form (initials
and faults) are solved once a worker.

Defined results: a null role or text counts as one space; null turns come first; messages
of one turn are ordered by role, then by a digest of role and text; rows with a null conversation id are one
conversation; a conversation needs a row to be in the result; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
WHITE = " \t\n\x0b\x0c\r"
#: What the pattern expects: its start, a user message after the system's, an assistant message, or a user message or the end.
START, FIRST_USER, ASSISTANT, USER = range(4)
ENDS = (START, USER)
#: State after a message whose role has this initial; other pairs break the pattern.
AFTER = {(START, "s"): FIRST_USER, (START, "u"): ASSISTANT, (FIRST_USER, "u"): ASSISTANT, (ASSISTANT, "a"): USER, (USER, "u"): ASSISTANT}
#: The user or assistant message that may follow in each state.
NEXT_ROLE = "uuau"
ROLES = {"u": "user", "a": "assistant"}
LEGAL_PAIRS = {"su", "ua", "au"}
REMEMBERED, REMEMBERED_LENGTH = 100_000, 64


def suffix_bounds(messages: list[tuple[str, bool, bool]]) -> list[list[int]]:
    """For each state and each number of messages done, a lower bound of the cost of the rest.

    The rest may end in any state here, so the bound is never above the true cost.
    """
    n = len(messages)
    start, user, assistant = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        initial, must_go, cut = messages[i]
        u, a, s = user[i + 1] + DELETE, assistant[i + 1] + DELETE, start[i + 1] + DELETE
        if not must_go:
            extra = TRUNCATED if cut else 0
            as_user = extra + (0 if initial == "u" else REROLE) + assistant[i + 1]
            as_assistant = extra + (0 if initial == "a" else REROLE) + user[i + 1]
            u, a, s = min(u, as_user), min(a, as_assistant), min(s, as_user)
            if initial == "s":
                s = min(s, extra + user[i + 1])
        user[i], assistant[i], start[i] = min(u, a + INSERT), min(a, u + INSERT), min(s, a + INSERT)
    return [start, user, assistant, user]


def _branches(messages: list[tuple[str, bool, bool]], i: int, state: int, cost: int) -> list[tuple[int, int, int, str]]:
    """What may come next, as (messages done, state, cost, letter) in falling order of letters."""
    role = NEXT_ROLE[state]
    follow, out = AFTER[state, role], []
    if i < len(messages):
        initial, must_go, cut = messages[i]
        if not must_go:
            extra = cost + (TRUNCATED if cut else 0)
            if initial != role:  # to the role it has, it would only cost more than keeping it
                out.append((i + 1, follow, extra + REROLE, "R"))
            kept = AFTER.get((state, initial))
            if kept is not None:
                out.append((i + 1, kept, extra, "K"))
    out.append((i, follow, cost + INSERT, "I"))
    if i < len(messages):
        out.append((i + 1, state, cost + DELETE, "D"))
    return out


def _first_dive(messages: list[tuple[str, bool, bool]], bounds: list[list[int]]) -> int:
    """The cost of the complete edits that follow the least bound from each node on."""
    i, state, cost = 0, START, 0
    while i < len(messages) or state not in ENDS:
        i, state, cost, _ = min(_branches(messages, i, state, cost), key=lambda b: b[2] + bounds[b[1]][b[0]])
    return cost


def cheapest_edits(messages: list[tuple[str, bool, bool]]) -> tuple[int, str]:
    """``(cost, audit)`` for messages given as (role's initial, must be deleted, truncated).

    A first dive along the bounds gives the cost that the search need not pass.
    """
    n = len(messages)
    bounds = suffix_bounds(messages)
    table: list[int | None] = [None] * (4 * (n + 1))
    best, audit = _first_dive(messages, bounds) + 1, ""
    path = bytearray()
    stack = [(0, START, 0, 0, "")]
    while stack:
        i, state, cost, depth, letter = stack.pop()
        met = table[4 * i + state]
        if met is not None and met <= cost or cost + bounds[state][i] >= best:
            continue
        table[4 * i + state] = cost
        if letter:
            del path[depth - 1:]
            path += letter.encode()
        if i == n and state in ENDS:
            best, audit = cost, path.decode()
            continue  # anything after this place costs more
        stack += [(*to, depth + 1, letter) for *to, letter in _branches(messages, i, state, cost)]
    return best, audit


PLAN = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


class _Solver:
    """Messages of one conversation after the other, in order; ``result`` closes one."""

    def __init__(self) -> None:
        self.known: dict[tuple, tuple[int, str]] = {}
        self.begin()

    def begin(self) -> None:
        self.messages: list[tuple[str, bool, bool]] = []
        self.seen: set[bytes] = set()
        self.turns = 0
        self.low = self.high = None
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)

    def add(self, turn: int | None, initial: str, blank: bool, cut: bool, digest: bytes) -> None:
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        duplicate = not blank and digest in self.seen
        self.seen.add(digest)
        cut = cut and not blank and not duplicate
        for name, fault in (("blank", blank), ("duplicate", duplicate), ("truncated", cut)):
            self.faults[name] += fault
        if self.messages and self.messages[-1][0] + initial not in LEGAL_PAIRS:
            self.faults["illegal"] += 1
        self.messages.append((initial, blank or duplicate, cut))

    def result(self) -> tuple:
        form = tuple(self.messages)
        found = self.known.get(form)
        if found is None:
            found = cheapest_edits(self.messages)
            if len(form) <= REMEMBERED_LENGTH and len(self.known) < REMEMBERED:
                self.known[form] = found
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (gaps, *self.faults.values(), *found)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, list]]:
    """``(new conversation, row)`` for the rows of sorted batches; the first column is the conversation."""
    last: tuple = ()
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            yield (row[0],) != last, row
            last = (row[0],)


def _solve(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    solver, out, conversation, any_row = _Solver(), [], None, False
    for new, row in _runs(batches):
        if new and any_row:
            out.append((conversation, *solver.result()))
            solver.begin()
            if len(out) >= 2_000:
                yield _batch(out, schema)
                out = []
        conversation, any_row = row[0], True
        solver.add(row[1], *row[2:])
    if any_row:
        out.append((conversation, *solver.result()))
    yield _batch(out, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _messages(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    space = F.lit(" ")
    rows = turns.select(F.col(f"`{conv_id}`").alias("conversation"), F.col(f"`{turn}`").cast("long").alias("turn"),
                        F.coalesce(F.col(f"`{role}`").cast("string"), space).alias("role"), F.coalesce(F.col(f"`{text}`").cast("string"), space).alias("text"))
    # The role's length keeps role and text apart.
    return rows.withColumn("digest", F.unhex(F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text"))))


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    by = ["conversation", *first, F.asc_nulls_first("turn"), "role", "digest"]
    return rows.repartition("conversation").sortWithinPartitions(*by)


def _conversation_type(turns: DataFrame, conv_id: str) -> str:
    return turns.select(f"`{conv_id}`").schema[0].dataType.simpleString()


def _arrow(fields: list[tuple[str, pa.DataType]], turns: DataFrame, conv_id: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_type
    return pa.schema([("conversation", to_arrow_type(turns.select(f"`{conv_id}`").schema[0].dataType)), *fields])


def plans(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each conversation: ``conversation, gaps, blank, duplicate, truncated, illegal, cost, audit``."""
    rows = _messages(turns, conv_id, turn, role, text)
    end = F.rtrim("text", F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    codes = rows.select("conversation", "turn", "role", "digest", F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
                        (F.length(end) == 0).alias("blank"), (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("cut"))
    codes = _in_order(codes).select("conversation", "turn", "initial", "blank", "cut", "digest")
    kind = _conversation_type(turns, conv_id)
    schema = _arrow([*((c, pa.int64()) for c in PLAN), ("audit", pa.string())], turns, conv_id)
    return codes.mapInArrow(lambda it: _solve(it, schema), f"conversation {kind}, " + ", ".join(f"{c} long" for c in PLAN) + ", audit string")


class _Editor:
    """Applies an audit to the messages that pass by; ``take`` and ``rest`` give ``(edit, turn, role, text)`` of what stays."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _put(self, letter: str, turn: int | None, role: str, text: str) -> tuple:
        if letter == "K":
            initial = role[:1]
        else:
            initial = NEXT_ROLE[self.state]
            role = ROLES[initial]
        self.state = AFTER[self.state, initial]
        return letter, turn, role, text

    def take(self, turn: int | None, role: str, text: str) -> Iterator[tuple]:
        while self.audit[self.at] == "I":
            self.at += 1
            yield self._put("I", None, "", "")
        letter = self.audit[self.at]
        self.at += 1
        if letter != "D":
            yield self._put(letter, turn, role, text)

    def rest(self) -> Iterator[tuple]:
        for _ in self.audit[self.at:]:
            yield self._put("I", None, "", "")


def _edited(batches: Iterator[pa.RecordBatch], begin: Callable, message: Callable, end: Callable, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Streams sorted plans and messages; the three functions get the conversation's state and give rows."""
    editor = state = None
    out: list[tuple] = []
    size = 0

    def close() -> list[tuple]:
        return [r for kept in editor.rest() for r in message(state, kept)] + end(state)

    for new, row in _runs(batches):
        conversation, turn, role, text, *plan = row
        if new:
            if editor:
                out += close()
            editor, state = _Editor(plan[-1]), begin(conversation, plan)
        else:
            for kept in editor.take(turn, role, text):
                out += message(state, kept)
            size += len(text)
        if len(out) >= 2_000 or size > 4 << 20:
            yield _batch(out, schema)
            out, size = [], 0
    if editor:
        out += close()
    yield _batch(out, schema)


def _with_plans(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Every conversation's plan and behind it its messages in order."""
    plan = plans(turns, conv_id, turn, role, text).withColumn("kind", F.lit(0))
    rows = _messages(turns, conv_id, turn, role, text).withColumn("kind", F.lit(1))
    both = _in_order(rows.unionByName(plan, allowMissingColumns=True), "kind")
    return both.select("conversation", "turn", "role", "text", *PLAN, "audit")


def repaired_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The messages of the repaired conversations: ``conversation, place`` (from 0), ``edit`` (K, R or I), ``turn`` (null if inserted), ``role, text``."""
    kind = _conversation_type(turns, conv_id)
    schema = _arrow([("place", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())], turns, conv_id)

    def begin(conversation, plan) -> dict:
        return {"conversation": conversation, "place": 0}

    def message(state: dict, kept: tuple) -> list[tuple]:
        state["place"] += 1
        return [(state["conversation"], state["place"] - 1, *kept)]

    rows = _with_plans(turns, conv_id, turn, role, text)
    return rows.mapInArrow(lambda it: _edited(it, begin, message, lambda state: [], schema),
                           f"conversation {kind}, place long, edit string, turn long, role string, text string")


def repair_report(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The columns of ``plans`` and ``repaired_sha256``, of the repaired ``role:text`` messages joined by line feeds."""
    kind = _conversation_type(turns, conv_id)
    schema = _arrow([*((c, pa.int64()) for c in PLAN), ("audit", pa.string()), ("repaired_sha256", pa.string())], turns, conv_id)

    def begin(conversation, plan) -> dict:
        return {"plan": (conversation, *plan), "digest": hashlib.sha256(), "gap": b""}

    def message(state: dict, kept: tuple) -> list[tuple]:
        state["digest"].update(state["gap"] + f"{kept[2]}:{kept[3]}".encode())
        state["gap"] = b"\n"
        return []

    rows = _with_plans(turns, conv_id, turn, role, text)
    return rows.mapInArrow(lambda it: _edited(it, begin, message, lambda state: [(*state["plan"], state["digest"].hexdigest())], schema),
                           f"conversation {kind}, " + ", ".join(f"{c} long" for c in PLAN) + ", audit string, repaired_sha256 string")


def remainder(conv_id: Column, turn: Column, modulus: int) -> Column:
    """crc32 of ``conv_id:turn`` (nulls: one space), modulo ``modulus``."""
    key = F.concat(F.coalesce(conv_id.cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(turn.cast("string"), F.lit(" ")))
    return F.pmod(F.crc32(key.cast("binary")), F.lit(modulus))


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with faults, chosen by ``remainder`` of 20: 0 the row is dropped, 1 its text is empty, 2 it has no ``.!?``,
    3 it is there twice, 4 its role is user."""
    r = F.col("r")
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                        remainder(F.col("conv_id"), F.col("turn"), 20).alias("r")).where(r != 0)
    return rows.select("conv_id", "turn", F.when(r == 4, "user").otherwise(F.col("role")).alias("role"),
                       F.when(r == 1, "").when(r == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
                       F.explode(F.when(r == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def repair_damaged(turns: DataFrame) -> DataFrame:
    """``repair_report`` of the damaged conversations, with a row for every original conv_id."""
    report = repair_report(damaged(turns))
    ids = turns.select("conv_id").distinct()
    out = ids.join(report, F.col("conv_id").eqNullSafe(F.col("conversation")), "left")
    zero, empty = F.lit(0).cast("long"), hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", *[F.coalesce(F.col(c), zero).alias(c) for c in PLAN], F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))

"""Chat formatting in budgeted, turn-aligned windows.

A conversation's turns get prefix sums of their token counts.  A window takes
turns while the sums say that they fit the budget together with its context:
the leading system turn, and the last few turns before the window as far as
they fit ``history`` tokens.  Context repeats turns of earlier windows and is
masked; every turn is new in exactly one window, and the assistant turns among
the new ones are the loss targets.  A turn over budget gets a window of its own,
uncut.

The template marks turns as ``<|turn|>role\\n text <|end|>\\n``.  A control
string inside a role or a text is broken by a backslash after its first
character, one more than it has there already; taking one away restores it, so
the escape is reversible for any text.

A conversation may hold any share of the rows.  Turns are range partitioned by
conversation and number and written with the prefix sums of their partition.
How a partition continues the conversation that is open at its beginning is a
step function of the tokens already in the open window; windows soon fall into
step, so it has few steps.  The driver reads these functions, one row a
partition, and hands every partition its open window and context.  Then each
partition formats the windows that begin in it: the turns with which the next
partition fills the last one, and the context from earlier partitions, are sent
to it.  Memory is one window and the token counts of one partition.

Defined cases: null text is empty; a null role is empty; a null turn number
comes first; turns with the same number are ordered by the first 64 characters
of role and text, then by a hash; repeated rows are turns of their own; rows
with a null conversation id are one conversation with that id; an empty table
gives an empty result; only the four columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written

BUDGET = 1024
HISTORY_TURNS = 4
HISTORY_TOKENS = 256
#: fixed values: control strings of the template here and of common chat templates
CONTROL = ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TURN, END = "<|turn|>", "<|end|>\n"
SYSTEM, TARGET = "system", "assistant"

_ESCAPE = re.compile("|".join(f"{re.escape(c[0])}\\\\*{re.escape(c[1:])}" for c in CONTROL))
_UNESCAPE = re.compile("|".join(f"{re.escape(c[0])}\\\\+{re.escape(c[1:])}" for c in CONTROL))
_TURN = re.compile(re.escape(TURN) + r"(.*?)\n(.*?)" + re.escape(END), re.S)
_PIECE = re.compile(r"[^\W_]+|[^\w\s]|_")

WINDOWS = "conv_id long, window int, formatted string, loss array<struct<lo: int, hi: int>>, n_context int, n_tokens int"


def escape(text: str) -> str:
    """``text`` with its control strings broken."""
    return _ESCAPE.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    """Inverse of :func:`escape`."""
    return _UNESCAPE.sub(lambda m: m[0][0] + m[0][2:], text)


def _role(role: str) -> str:
    """A role on one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unrole(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)


def count_tokens(text: str) -> int:
    """Words and punctuation marks: the default measure of a turn."""
    return sum(1 for _ in _PIECE.finditer(text))


class _Turn:
    __slots__ = ("role", "formatted", "lo", "hi", "tokens")

    def __init__(self, role: str, text: str, count):
        head = f"{TURN}{_role(role)}\n"
        body = escape(text)
        self.role, self.formatted = role, head + body + END
        self.lo, self.hi = len(head), len(head) + len(body)
        self.tokens = count(text) + count(role) + 2  # and the two marks


def _context(system: _Turn | None, recent: deque, turn: _Turn, budget: int, history_turns: int, history_tokens: int) -> list[_Turn]:
    """What a window that begins with ``turn`` repeats: the system turn, and the last turns that fit."""
    left = min(history_tokens, budget - turn.tokens - (system.tokens if system else 0))
    out: list[_Turn] = []
    for old in list(recent)[::-1][:history_turns]:
        left -= old.tokens
        if left < 0 or old is system:
            break
        out.append(old)
    return ([system] if system else []) + out[::-1]


def _window(conv, number: int, context: list[_Turn], new: list[_Turn]) -> dict:
    at, loss = sum(len(t.formatted) for t in context), []
    for t in new:
        if t.role == TARGET:
            loss.append({"lo": at + t.lo, "hi": at + t.hi})
        at += len(t.formatted)
    return {"conv_id": conv, "window": number, "formatted": "".join(t.formatted for t in [*context, *new]), "loss": loss,
            "n_context": len(context), "n_tokens": sum(t.tokens for t in [*context, *new])}


def windows(turns: Iterator[tuple], budget: int = BUDGET, history_turns: int = HISTORY_TURNS, history_tokens: int = HISTORY_TOKENS,
            count=count_tokens) -> Iterator[dict]:
    """Windows of ``(conv_id, role, text)`` rows that come conversation by conversation, in order of turn."""
    return _windows(((0, "turn", None, *t) for t in turns), budget, history_turns, history_tokens, count)


def _windows(rows: Iterator[tuple], budget: int, history_turns: int, history_tokens: int, count) -> Iterator[dict]:
    """Windows of ``(home, kind, number, conv_id, role, text)`` rows, home by home.

    Kind ``system`` or ``recent`` is a turn of an earlier window.  ``number`` is
    the window that begins at a home's first turn where that turn is not the
    conversation's first.  ``total`` is the prefix sum of the new turns' tokens
    from the window's beginning.
    """
    home, conv, started = None, None, False
    system, recent, context, new, number, total, fixed = None, deque(maxlen=history_turns), [], [], 0, 0, 0
    for at, kind, first, conv_id, role, text in rows:
        turn = _Turn(role or "", text or "", count)
        if at != home or (kind == "turn" and started and conv_id != conv):
            if new:
                yield _window(conv, number, context, new)
            home, started = at, False
            system, recent, context, new, number, total, fixed = None, deque(maxlen=history_turns), [], [], 0, 0, 0
        if kind == "system":
            system = turn
            continue
        if kind == "recent":
            recent.append(turn)
            continue
        if not started and first is None:
            conv, started = conv_id, True
            system = turn if turn.role == SYSTEM else None
        elif not started or fixed + total + turn.tokens > budget:
            if new:
                yield _window(conv, number, context, new)
            context = _context(system, recent, turn, budget, history_turns, history_tokens)
            new, number, total, fixed = [], number + 1 if started else first, 0, sum(t.tokens for t in context)
            conv, started = conv_id, True
        new.append(turn)
        recent.append(turn)
        total += turn.tokens
    if new:
        yield _window(conv, number, context, new)


def _rows(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(i).to_pylist() for i in range(n)))


def _batches(rows: Iterator[dict], schema: pa.Schema, size) -> Iterator[pa.RecordBatch]:
    held, amount = [], 0
    for r in rows:
        held.append(r)
        amount += size(r)
        if amount > 1 << 22:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, amount = [], 0
    yield pa.RecordBatch.from_pylist(held, schema)


_TURNS = "part int, at int, sofar long, tokens int, conv_id long, role string, text string"
_EDGES = ("part int, n int, lead int, opens int, first struct<null: boolean, conv: long>, last struct<null: boolean, conv: long>, "
          "open_tokens long, open_system boolean, tail array<long>")
_STEPS = "part int, upto array<long>, used array<long>, breaks array<long>"


def _ordered(turns: DataFrame, count, partitions: int | None) -> DataFrame:
    """The turns in order: partition, place and prefix sum of tokens there."""
    key = ["conv_id", "turn", "_role", "_text", "_hash", "_row"]  # no text goes whole into the range bounds; equal rows spread
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text", F.substring("role", 1, 64).alias("_role"),
                        F.substring("text", 1, 64).alias("_text"), F.xxhash64("role", "text").alias("_hash"),
                        F.monotonically_increasing_id().alias("_row"))
    ordered = rows.repartitionByRange(*([partitions] if partitions else []), *key).sortWithinPartitions(*key)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, sofar = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            conv, role, text = batch.columns
            tokens = np.array([count(t or "") + count(r or "") + 2 for r, t in zip(role.to_pylist(), text.to_pylist())], dtype=np.int64)
            n = len(tokens)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n, dtype=np.int32)), pa.array(sofar + np.cumsum(tokens)),
                 pa.array(tokens.astype(np.int32)), conv, role, text], names=["part", "at", "sofar", "tokens", "conv_id", "role", "text"])
            at, sofar = at + n, sofar + int(tokens.sum())

    return written(ordered.select("conv_id", "role", "text").mapInArrow(number, _TURNS), "chat-turns")


def _stretches(rows: pd.DataFrame) -> tuple[pd.DataFrame, int, int]:
    """The rows of a partition in order, the length of its first conversation, and the place where its last one begins."""
    rows = rows.sort_values("at")
    conv, null = rows.conv.to_numpy(), rows.null.to_numpy()
    change = np.flatnonzero((conv[1:] != conv[:-1]) | (null[1:] != null[:-1])) + 1
    return (rows, int(change[0]), int(change[-1])) if len(change) else (rows, len(rows), 0)


def _edges(history_turns: int):
    def edges(rows: pd.DataFrame) -> pd.DataFrame:
        rows, lead, opens = _stretches(rows)
        first, last, open_ = rows.iloc[0], rows.iloc[-1], rows.iloc[opens]
        tail = rows.tokens.to_numpy()[max(opens, len(rows) - history_turns):]
        return pd.DataFrame({"part": [first.part], "n": [len(rows)], "lead": [lead], "opens": [opens],
                             "first": [{"null": bool(first.null), "conv": int(first.conv)}],
                             "last": [{"null": bool(last.null), "conv": int(last.conv)}],
                             "open_tokens": [open_.tokens], "open_system": [open_.system], "tail": [[int(t) for t in tail]]})

    return edges


def _steps(carried: dict[int, tuple[int, list[int]]], budget: int, history_turns: int, history_tokens: int):
    """``used`` and ``breaks`` at a partition's end, by the tokens of the open window at its beginning.

    A window that begins at turn s ends before the first turn at which the prefix
    sums pass the budget left by its context, so all ends are one binary search
    over the prefix sums, and a backward pass follows them to the partition's end.
    """
    def chain(tokens: np.ndarray, recent: list[int], system: int, lower: int, fresh: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, o = len(tokens), len(recent)
        all_, upto = np.concatenate([np.array(recent, np.int64), tokens]), np.cumsum(tokens)
        before = upto - tokens
        left = np.minimum(history_tokens, budget - tokens - system)
        fixed, open_ = np.full(n, system, np.int64), np.ones(n, dtype=bool)
        for j in range(1, history_turns + 1):
            place = np.arange(n) + o - j
            old = np.where(place >= 0, all_[np.maximum(place, 0)], 0)
            left = left - old
            open_ &= (place >= lower) & (left >= 0)
            fixed += np.where(open_, old, 0)
        if fresh:
            fixed[0] = 0
        following = np.maximum(np.searchsorted(upto, budget - fixed + before, "right"), np.arange(1, n + 1))
        used, breaks = fixed + upto[-1] - before, np.zeros(n, np.int64)
        for s in range(n - 1, -1, -1):
            if following[s] < n:
                used[s], breaks[s] = used[following[s]], breaks[following[s]] + 1
        return upto, used, breaks

    def steps(rows: pd.DataFrame) -> pd.DataFrame:
        rows, lead, opens = _stretches(rows)
        part, tokens = int(rows.part.iloc[0]), rows.tokens.to_numpy().astype(np.int64)
        if opens or part not in carried:  # a conversation begins here: its windows do not depend on what came before
            system = bool(rows.system.iloc[opens])
            _, used, breaks = chain(tokens[opens:], [], int(tokens[opens]) if system else 0, int(system), True)
            out = [[], used[:1], breaks[:1]]
        else:
            system, recent = carried[part]
            upto, used, breaks = chain(tokens, recent, system, 0, False)
            k = min(int(np.searchsorted(upto, budget, "right")) + 1, len(upto))  # the window may end before any of the first k turns
            last = np.append((np.diff(used[:k]) != 0) | (np.diff(breaks[:k]) != 0), True)
            out = [upto[:k][last], used[:k][last], breaks[:k][last]]
        return pd.DataFrame({"part": [part], **{c: [[int(x) for x in v]] for c, v in zip(("upto", "used", "breaks"), out)}})

    return steps


def _routes(ordered: DataFrame, budget: int, history_turns: int, history_tokens: int) -> tuple[DataFrame, DataFrame]:
    """Where the first turns of a partition go, and which earlier turns it needs.

    At most ``history_turns + 2`` small rows a partition, whatever the table: they can be broadcast.
    """
    spark = ordered.sparkSession
    narrow = ordered.select("part", "at", "tokens", F.coalesce("conv_id", F.lit(0)).alias("conv"), F.isnull("conv_id").alias("null"),
                            F.coalesce(F.col("role") == SYSTEM, F.lit(False)).alias("system"))
    parts = sorted(narrow.groupBy("part").applyInPandas(_edges(history_turns), _EDGES).collect(), key=lambda p: p.part)  # one row each
    carried, needs, conv, recent, system = {}, {}, None, [], None
    for p in parts:
        if p.first == conv:  # the conversation goes on: its system turn and its last turns
            carried[p.part] = (system[2] if system else 0, [t for _, _, t in recent])
            for kind, places in (("system", [system] if system else []), ("recent", recent)):
                for part, at, _ in places:
                    needs.setdefault((part, at), []).append((p.part, kind, None))
        tail = [(p.part, p.n - len(p.tail) + i, t) for i, t in enumerate(p.tail)]
        if p.opens or p.first != conv:
            system = (p.part, p.opens, p.open_tokens) if p.open_system else None
            recent = [r for r in tail if not system or r[1] != p.opens]
        else:
            recent = (recent + tail)[-history_turns:] if history_turns else []
        conv = p.last
    found = narrow.groupBy("part").applyInPandas(_steps(carried, budget, history_turns, history_tokens), _STEPS).collect()
    steps, moves, used, number, home = {r.part: r for r in found}, [], 0, 0, None
    for p in parts:
        upto, after, breaks = steps[p.part][1:]
        if p.part in carried:
            moves.append((p.part, p.lead, max(budget - used, 0), home, number + 1))
        if p.opens or p.part not in carried:
            used, number, home = after[0], breaks[0], p.part
        elif used + upto[-1] <= budget:
            used += upto[-1]
        else:
            i = next(i for i, u in enumerate(upto) if used + u > budget)
            used, number, home = after[i], number + 1 + breaks[i], p.part
    return (spark.createDataFrame(moves, "part int, lead int, room long, home int, number int"),
            spark.createDataFrame([(*place, to) for place, to in needs.items()], f"part int, at int, needs {_ROUTE}"))


_ROUTE = "array<struct<home: int, kind: string, number: int>>"


def format_conversations(turns: DataFrame, budget: int = BUDGET, history_turns: int = HISTORY_TURNS,
                         history_tokens: int = HISTORY_TOKENS, count=count_tokens, partitions: int | None = None) -> DataFrame:
    """``(conv_id, window, formatted, loss, n_context, n_tokens)`` of ``turns(conv_id, turn, role, text)``.

    ``loss`` holds the code points of ``formatted`` that are targets; the first
    ``n_context`` turns of a window repeat earlier ones.  ``partitions`` is the
    number of range partitions (default: the session's).
    """
    ordered = _ordered(turns, count, partitions)
    moves, needs = _routes(ordered, budget, history_turns, history_tokens)
    fills = F.expr("at < lead AND sofar <= room")  # the turn still fits the window that is open at the partition's beginning
    own = F.expr(f"CAST(array(named_struct('home', part, 'kind', 'turn', 'number', IF(at < lead, number, NULL))) AS {_ROUTE})")
    away = F.expr(f"CAST(array(named_struct('home', home, 'kind', 'turn', 'number', NULL), "
                  f"named_struct('home', part, 'kind', 'recent', 'number', NULL)) AS {_ROUTE})")
    rows = (ordered.join(F.broadcast(moves), "part", "left").join(F.broadcast(needs), ["part", "at"], "left")
            .select("part", "at", "conv_id", "role", "text",
                    F.explode(F.concat(F.when(fills, away).otherwise(own), F.coalesce("needs", F.array().cast(_ROUTE)))).alias("to"))
            .repartition("to.home").sortWithinPartitions("to.home", "part", "at")
            .select("to.home", "to.kind", "to.number", "conv_id", "role", "text"))
    schema = pa.schema([("conv_id", pa.int64()), ("window", pa.int32()), ("formatted", pa.string()),
                        ("loss", pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))), ("n_context", pa.int32()), ("n_tokens", pa.int32())])
    return rows.mapInArrow(lambda b: _batches(_windows(_rows(b, 6), budget, history_turns, history_tokens, count), schema,
                                              lambda r: len(r["formatted"]) + 100), WINDOWS)


def read_window(formatted: str) -> list[tuple[str, str]]:
    """Role and text of every turn of a formatted window."""
    return [(_unrole(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def digests(formatted: DataFrame) -> DataFrame:
    """What the windows say of each conversation: turns, their digest, and the text under the loss mask."""
    ordered = (formatted.select("conv_id", "window", "formatted", "loss", "n_context").repartition("conv_id")
               .sortWithinPartitions("conv_id", "window"))
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_windows", pa.int64())])

    def read(rows: Iterator[tuple]) -> Iterator[dict]:
        now, all_, under = None, None, None
        for conv, _, text, loss, n_context in rows:
            if now is None or now["conv_id"] != conv:
                if now:
                    yield now | {"turns_sha256": all_.hexdigest(), "loss_sha256": under.hexdigest()}
                now = {"conv_id": conv, "n_turns": 0, "loss_chars": 0, "formatted_chars": 0, "n_windows": 0}
                all_, under = hashlib.sha256(), hashlib.sha256()
            now["formatted_chars"] += len(text)
            now["n_windows"] += 1
            for role, body in read_window(text)[n_context:]:
                now["n_turns"] += 1
                all_.update(f"{role}\n{body}\n".encode("utf-8"))
            for span in loss:
                target = unescape(text[span["lo"]:span["hi"]])
                now["loss_chars"] += len(target)
                under.update(target.encode("utf-8"))
        if now:
            yield now | {"turns_sha256": all_.hexdigest(), "loss_sha256": under.hexdigest()}

    return ordered.mapInArrow(lambda b: _batches(read(_rows(b, 5)), schema, lambda r: 300),
                              "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long")

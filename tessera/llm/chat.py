"""Conversations as training windows under a token budget (operator 4)."""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import default_path, encoder

# Template: "<turn N ROLE>\nTEXT</turn>\n". Inside texts and roles a backslash
# is written \\ and "<" is written \l, so the marks cannot occur in them.
_TURN = re.compile(r"<turn (\d+) ([^>]*)>\n([^<]*)</turn>\n")
_ESCAPED = re.compile(r"\\(.)")
_PLAIN = {"\\": "\\", "l": "<", "g": ">", "n": "\n", "0": ""}


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\l")


def escape_role(role: str | None) -> str:
    return "\\0" if role is None else escape(role).replace(">", "\\g").replace("\n", "\\n")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _PLAIN[m[1]], text)


def parse(formatted: str) -> list[tuple[int, str, str]]:
    """(turn number, role, text) of each turn of a window."""
    return [(int(n), unescape(role), unescape(text)) for n, role, text in _TURN.findall(formatted)]


class Windows:
    """Turn-aligned spans of one conversation. Prefix sums of the turns'
    tokens decide where a span ends and how far back its history reaches; only
    the turns of the open span and its possible history are in memory."""

    def __init__(self, budget: int, history: int, count):
        self.budget, self.history, self.count = budget, history, count
        self.number = self.window = 0
        self.system = None          # (number, role, text, tokens) repeated in every window
        self.turns: deque = deque()  # history and new turns: (number, role, text, prefix before, tokens)
        self.fresh = 0              # first turn number not yet a target
        self.prefix = 0             # tokens of all turns so far, without the system turn

    def add(self, role: str | None, text: str) -> Iterator[tuple]:
        tokens = self.count(_mark(self.number, role, text))
        if self.number == 0 and role == "system":
            self.system, self.fresh, self.number = (0, role, text, tokens), 0, 1
            return
        held = self.system[3] if self.system else 0
        new = self.number > self.fresh and any(t[0] >= self.fresh for t in self.turns)
        start = self.turns[0][3] if self.turns else self.prefix
        if new and held + self.prefix + tokens - start > self.budget:
            yield self.flush()
            # history: the last turns of at most `history` tokens that leave room for this one
            least = max(self.prefix - self.history, held + self.prefix + tokens - self.budget)
            while self.turns and self.turns[0][3] < least:
                self.turns.popleft()
        self.turns.append((self.number, role, text, self.prefix, tokens))
        self.prefix += tokens
        self.number += 1

    def flush(self) -> tuple:
        out, at, starts, ends = [], 0, [], []
        for number, role, text, *_ in ([self.system] if self.system else []) + list(self.turns):
            head, body = f"<turn {number} {escape_role(role)}>\n", escape(text)
            if role == "assistant" and number >= self.fresh:
                starts.append(at + len(head))
                ends.append(at + len(head) + len(body))
            out.append(head + body + "</turn>\n")
            at += len(out[-1])
        tokens = (self.system[3] if self.system else 0) + sum(t[4] for t in self.turns)
        row = (self.window, self.fresh, self.number - 1, tokens, "".join(out), starts, ends)
        self.window, self.fresh = self.window + 1, self.number
        return row

    def end(self) -> Iterator[tuple]:
        if self.number > self.fresh:
            yield self.flush()


def _mark(number: int, role: str | None, text: str) -> str:
    return f"<turn {number} {escape_role(role)}>\n{escape(text)}</turn>\n"


_FIELDS = ["window", "first_turn", "last_turn", "tokens", "formatted", "loss_starts", "loss_ends"]
_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]


def _format(batches, id_type, path: str, budget: int, history: int) -> Iterator[pa.RecordBatch]:
    count = encoder(path).count
    current, state, rows = None, None, []

    def batch():
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [id_type, *_TYPES])],
                                          names=["conv", *_FIELDS])

    for b in batches:
        for conv, role, text in zip(*[b.column(k).to_pylist() for k in range(3)]):
            if state is None or conv != current:
                if state:
                    rows += [(current, *w) for w in state.end()]
                current, state = conv, Windows(budget, history, count)
            rows += [(current, *w) for w in state.add(role, text or "")]
            if len(rows) >= 256:
                yield batch()
                rows = []
    if state:
        rows += [(current, *w) for w in state.end()]
    if rows:
        yield batch()


def format_conversations(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text", budget: int = 512,
                         history: int = 128, tokenizer_path: str | None = None) -> DataFrame:
    """Windows of at most ``budget`` tokens over each conversation, in order.

    A window holds whole turns: the system turn (a first turn whose role is
    ``system``), up to ``history`` tokens of turns repeated from before, and
    new turns. A turn that exceeds the budget by itself has its own window.
    ``loss_starts`` / ``loss_ends`` mark the escaped texts of assistant turns
    the first time they occur; repeated ones are masked.

    Columns: conv (the id), window, first_turn, last_turn (new turns, numbered
    from 0 by ``turn_col``, ties by role and text), tokens, formatted,
    loss_starts, loss_ends (code points).

    A task streams its conversations turn by turn, so one long conversation
    does not have to fit into memory. Null text: empty; null role: written as
    such and read back empty; null id: one conversation; null turn: first.
    Repeated rows are turns like any other. Other columns are ignored.
    """
    path = tokenizer_path or default_path()
    src = conversations.select(F.col(id_col).alias("conv"), F.col(role_col).cast("string").alias("role"),
                               F.col(text_col).cast("string").alias("text"), F.col(turn_col).alias("turn"))
    ordered = src.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text").drop("turn")
    id_field = src.schema["conv"].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    id_type = to_arrow_type(id_field)
    return ordered.mapInArrow(
        lambda it: _format(it, id_type, path, budget, history),
        f"conv {id_field.simpleString()}, window int, first_turn long, last_turn long, tokens long, "
        "formatted string, loss_starts array<long>, loss_ends array<long>")


def _digest(batches, id_type) -> Iterator[pa.RecordBatch]:
    done: list[tuple] = []
    current, state = None, None

    def finish():
        done.append((current, state["n"], state["turns"].hexdigest(), state["loss_chars"],
                     state["loss"].hexdigest(), state["chars"]))

    def batch():
        types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*done), types)],
            names=["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    for b in batches:
        cols = {n: b.column(n).to_pylist() for n in ("conv", "formatted", "loss_starts", "loss_ends")}
        for conv, text, starts, ends in zip(*cols.values()):
            if state is None or conv != current:
                if state:
                    finish()
                current = conv
                state = {"n": 0, "turns": hashlib.sha256(), "loss_chars": 0, "loss": hashlib.sha256(), "chars": 0}
            for number, role, body in parse(text):
                if number >= state["n"]:  # not a repeated turn
                    state["turns"].update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
                    state["n"] = number + 1
            for s, e in zip(starts, ends):
                part = unescape(text[s:e])
                state["loss_chars"] += len(part)
                state["loss"].update(part.encode("utf-8", "surrogatepass"))
            state["chars"] += len(text)
            if len(done) >= 1000:
                yield batch()
                done.clear()
    if state:
        finish()
    if done:
        yield batch()


def conversation_digests(windows: DataFrame) -> DataFrame:
    """What can be read back from the formatted windows: per conversation
    conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars
    (code points of all its windows)."""
    from pyspark.sql.pandas.types import to_arrow_type
    field = windows.schema["conv"].dataType
    id_type = to_arrow_type(field)
    ordered = (windows.select("conv", "window", "formatted", "loss_starts", "loss_ends")
               .repartition("conv").sortWithinPartitions("conv", "window"))
    return ordered.mapInArrow(lambda it: _digest(it, id_type),
                              f"conv {field.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, "
                              "loss_sha256 string, formatted_chars long")

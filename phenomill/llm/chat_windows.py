"""Conversations as training windows under a token budget.

Rows are put in order of turn (ties by role, then text). A window holds the system turn (the conversation's
first turn, if it is one), some turns of history and then new turns, as many as the budget takes. Prefix sums of
the turns' tokens give both ends: history reaches back over whole turns worth at most ``history`` tokens,
less if the next new turn would not fit. Only new assistant texts are under the loss mask, so each is a
target exactly once; repeated ones are context. A turn larger than the budget has a window of its own, marked ``over``.

A turn is rendered as ``<|turn|>role<|text|>text<|end|>`` and a line feed. Control strings inside roles and texts
are broken up by an escape that can be undone: every backslash is doubled, and ``\\.`` is put behind the first
character of a control string.

Conversations are read as a sorted stream: a task holds the system turn, the history and one window, so a
conversation of any length is fine. Null roles and texts count as empty, a null conversation is one
of its own, repeated rows are turns of their own, an empty table gives no rows, other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenomill.llm.bpe import codec, read_ranks

BUDGET = 2048
HISTORY = 512

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
CONTROL = re.compile(r"(?=<\||\|>|</?s>|\[/?INST\]|<</?SYS>>)(.)", re.DOTALL)
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
RENDERED = re.compile(re.escape(TURN) + r"(.*?)" + re.escape(TEXT) + r"(.*?)" + re.escape(END) + "\n", re.DOTALL)

WINDOWS = (
    "conv_id long, window long, first_turn long, repeated int, n_tokens long, over boolean, formatted string, "
    "loss array<struct<start:long,end:long>>"
)
TURN_ROWS = "conv_id long, turn_index long, role string, text string, target boolean"
_LOSS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def escape(text: str) -> str:
    return CONTROL.sub(r"\1\\.", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: "\\" if m[1] == "\\" else "", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The turn and where its escaped text begins and ends."""
    head = TURN + escape(role) + TEXT
    body = escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


@functools.lru_cache(maxsize=2)
def token_counter(path: str, pattern: str) -> Callable[[str], int]:
    """Number of tokens of a text, as the tokenizer of this rank file and pre-token pattern has them."""
    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})

    def count(text: str) -> int:
        try:
            return len(encoding.encode(text, disallowed_special=()))
        except ValueError:  # white space too long for its splitter
            return len(codec(path, pattern).encode(text))

    return count


class WindowBuilder:
    """Takes the turns of one conversation in order, gives its windows."""

    def __init__(self, conv_id, budget: int, history: int):
        self.conv_id, self.budget, self.most_history = conv_id, budget, history
        self.system = None
        self.past: deque[tuple] = deque()  # (turn, prefix sum before it), at most the history's tokens
        self.repeated: list[tuple] = []
        self.new: list[tuple] = []
        self.total = 0  # prefix sum of the tokens of all turns so far
        self.used = 0
        self.turns = self.windows = 0

    def _start(self, tokens: int) -> None:
        """Choose what the next window repeats, so that a turn of ``tokens`` still fits."""
        base = self.system[4] if self.system else 0
        room = min(self.most_history, self.budget - base - tokens)
        # Prefix sums: turns from the first one whose sum is within ``room`` of the total.
        self.repeated = [turn for turn, before in self.past if self.total - before <= room]
        if self.system:
            self.repeated.insert(0, self.system)
        self.used = sum(t[4] for t in self.repeated)

    def _window(self) -> tuple:
        text, loss, at = [], [], 0
        for k, (rendered, start, end, role, _) in enumerate([*self.repeated, *self.new]):
            if k >= len(self.repeated) and role == "assistant":
                loss.append({"start": at + start, "end": at + end})
            text.append(rendered)
            at += len(rendered)
        row = (self.conv_id, self.windows, self.turns - len(self.new), len(self.repeated), self.used, self.used > self.budget, "".join(text), loss)
        self.windows += 1
        return row

    def add(self, role: str, text: str, tokens: int) -> Iterator[tuple]:
        turn = (*render(role, text), role, tokens)
        if self.new and self.used + tokens > self.budget:
            yield self._window()
            self.new = []
        if not self.new:
            self._start(tokens)
        self.new.append(turn)
        self.used += tokens
        if self.turns == 0 and role == "system":
            self.system = turn
        else:
            self.past.append((turn, self.total))
            self.total += tokens
            while self.past and self.total - self.past[0][1] > self.most_history:
                self.past.popleft()
        self.turns += 1

    def close(self) -> Iterator[tuple]:
        if self.new:
            yield self._window()


def _window_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in WINDOWS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.string(), _LOSS]
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)


def windows(
    turns: DataFrame,
    ranks_path: str,
    pattern: str,
    budget: int = BUDGET,
    history: int = HISTORY,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Windows of every conversation, each conversation's in order within one partition.

    Tokens are those of the rank file at ``ranks_path`` with the pre-tokens of ``pattern``, counted turn by turn.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_tokens = token_counter(ranks_path, pattern)
        for batch in batches:
            rendered = [render(r, t)[0] for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())]
            sizes = [n_tokens(x) for x in rendered]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64())], [*batch.schema.names, "n_tokens"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        builder, rows = None, []
        for batch in batches:
            for key, _, who, said, size in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if builder is None or builder.conv_id != key:
                    rows += builder.close() if builder else ()
                    builder = WindowBuilder(key, budget, history)
                rows += builder.add(who, said, size)
                if len(rows) >= 1000:
                    yield _window_batch(rows)
                    rows = []
        rows += builder.close() if builder else ()
        yield _window_batch(rows)

    rows = turns.select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    counted = rows.mapInArrow(count, "conv_id long, turn long, role string, text string, n_tokens long")
    ordered = counted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(build, WINDOWS)


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of the turns in a window, unescaped; start and end are those of the escaped text."""
    return [(unescape(m[1]), unescape(m[2]), m.start(2), m.end(2)) for m in RENDERED.finditer(formatted)]


def turn_rows(formatted: DataFrame) -> DataFrame:
    """Turns read back from the windows, each once: (conv_id, turn_index, role, text, target)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                masked = {(s["start"], s["end"]) for s in row["loss"]}
                for k, (role, text, start, end) in enumerate(parse(row["formatted"])[row["repeated"] :]):
                    rows.append((row["conv_id"], row["first_turn"] + k, role, text, (start, end) in masked))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], ["conv_id", "turn_index", "role", "text", "target"])

    return formatted.mapInArrow(run, TURN_ROWS)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests per conversation from windows in the order that ``windows`` gives them in.

    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, rows = None, []

        def done() -> tuple:
            return (state["id"], state["turns"], state["all"].hexdigest(), state["chars"], state["loss"].hexdigest(), state["formatted"])

        for batch in batches:
            for row in batch.to_pylist():
                if state is None or row["window"] == 0:
                    if state:
                        rows.append(done())
                    state = {"id": row["conv_id"], "turns": 0, "all": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "formatted": 0}
                text = row["formatted"]
                state["formatted"] += len(text)
                for role, said, _, _ in parse(text)[row["repeated"] :]:
                    state["turns"] += 1
                    state["all"].update(f"{role}\n{said}\n".encode())
                for span in row["loss"]:
                    target = unescape(text[span["start"] : span["end"]])
                    state["chars"] += len(target)
                    state["loss"].update(target.encode())
        if state:
            rows.append(done())
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        columns = list(zip(*rows)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.mapInArrow(run, schema)

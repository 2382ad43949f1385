"""Chat formatting in budgeted windows.

Conversations are cut into windows of whole turns. Prefix sums over the turns' token counts choose each window: the
system turn, as much history before its first new turn as the history budget allows, and new turns up to the budget.
The loss mask covers the texts of assistant turns that are new in their window; repeated ones are masked.

The template writes a turn as ``<|turn|>ROLE`` newline ``TEXT<|end|>`` newline. A backslash inside role or text is
doubled, and one is set into every control string (behind its first character) and before a line break in a role, so
the parts can be read back exactly.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.bpe import shared_vocabulary, tokenizer_of
from farebox.llm.tasks import small_batches, with_python_columns

BUDGET = 2048
HISTORY = 512
TURN, END = "<|turn|>", "<|end|>"
SYSTEM, ASSISTANT = "system", "assistant"

_CONTROL = re.compile(r"\\|<\||</?s>|\[/?INST\]")
_ESCAPED = re.compile(r"\\(.)", re.S)
_PART = re.compile(r"<\|turn\|>((?:[^\\\n]++|\\.)*+)\n((?:[^\\<]++|\\.|<(?!\|))*+)<\|end\|>\n", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\\\" if m.group() == "\\" else f"{m.group()[0]}\\{m.group()[1:]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def turn_text(role: str, text: str) -> tuple[str, str]:
    """A turn's opening and its escaped text; ``END`` and a line break follow."""
    return f"{TURN}{escape(role).replace(chr(10), chr(92) + chr(10))}\n", escape(text)


def turn_cost(role: str, text: str, count: Callable[[str], int]) -> int:
    """Tokens of the turn as it stands in a window, its marks and escapes included. A window's text is its turns' texts one
    after the other, and no token spans the line break and the mark between two of them."""
    head, body = turn_text(role, text)
    return count(f"{head}{body}{END}\n")


class Window:
    """Turns of one window: (role, text), how many of them are repeated, and the tokens of all."""

    def __init__(self, number: int, repeated: list[tuple[str, str]], tokens: int):
        self.number, self.turns, self.n_repeated, self.tokens = number, list(repeated), len(repeated), tokens

    def formatted(self) -> tuple[str, list[tuple[int, int]]]:
        """The text and the spans under the loss mask (code points, stop exclusive)."""
        out, mask, at = [], [], 0
        for i, (role, text) in enumerate(self.turns):
            head, body = turn_text(role, text)
            if i >= self.n_repeated and role == ASSISTANT and body:
                mask.append((at + len(head), at + len(head) + len(body)))
            out += [head, body, END, "\n"]
            at += len(head) + len(body) + len(END) + 1
        return "".join(out), mask


def windows_of(turns: Iterable[tuple[str, str, int]], budget: int = BUDGET, history: int = HISTORY) -> Iterator[Window]:
    """Windows of one conversation, one after the other, from its turns (role, text, cost); only the last turns within the
    history budget are kept.

    A window holds at most ``budget`` tokens, unless one turn with the system turn is longer by itself: turns are never cut.
    """
    system, system_cost = [], 0
    kept: list[tuple[str, str]] = []  # turns that later windows may repeat
    sums = [0]  # prefix sums of their tokens
    window = None
    for i, (role, text, cost) in enumerate(turns):
        if window is not None and window.tokens + cost > budget:
            yield window
            allowed = max(0, min(history, budget - system_cost - cost))
            first = bisect_left(sums, sums[-1] - allowed)
            window = Window(window.number + 1, system + kept[first:], system_cost + sums[-1] - sums[first])
        elif window is None:
            window = Window(0, [], 0)
        window.turns.append((role, text))
        window.tokens += cost
        if i == 0 and role == SYSTEM:
            system, system_cost = [(role, text)], cost
        else:
            kept.append((role, text))
            sums.append(sums[-1] + cost)
            gone = bisect_left(sums, sums[-1] - history)
            if gone > 64:
                del kept[:gone], sums[:gone]
    if window is not None:
        yield window


def read_back(text: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a formatted window; raises ValueError if it isn't one."""
    turns, at = [], 0
    while at < len(text):
        m = _PART.match(text, at)
        if m is None:
            raise ValueError("not a formatted window")
        turns.append((unescape(m.group(1)), unescape(m.group(2))))
        at = m.end()
    return turns


_WINDOWS = "conv_id long, window int, n_repeated int, n_tokens int, text string, loss array<struct<start:int,stop:int>>"


def format_conversations(
    conversations: DataFrame, rank_file: str, pattern: str, budget: int = BUDGET, history: int = HISTORY,
) -> DataFrame:
    """Windows (``conv_id``, ``window``, ``n_repeated`` turns, ``n_tokens``, ``text``, ``loss`` spans), those of a
    conversation next to each other and in order.

    Turns are ordered by ``turn`` (NULL first), ties by role and text; repeated rows are repeated turns. NULL roles and
    texts are empty, the conversations of id NULL are one. Other columns are not looked at. A conversation passes
    through one task turn by turn: what is held is one window and the history budget, whatever its length.
    """
    small_batches(conversations.sparkSession)
    vocabulary = shared_vocabulary(conversations, rank_file)
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))

    def costs():
        count = tokenizer_of(vocabulary.value, pattern).count
        return lambda roles, texts: [[turn_cost(r, t, count) for r, t in zip(roles, texts)]]

    # tokens are counted where the rows lie; only the choice of windows needs a conversation in order
    counted = with_python_columns(rows, ["role", "text"], "cost int", costs)
    ordered = counted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = (t for b in batches for t in zip(*[b.column(i).to_pylist() for i in (0, 2, 3, 4)]))
        names = ["conv_id", "window", "n_repeated", "n_tokens", "text", "loss"]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))]
        made, size = [], 0

        def batch():
            columns = list(zip(*made))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for conv_id, own in groupby(turns, key=lambda t: t[0]):
            for window in windows_of((t[1:] for t in own), budget, history):
                text, loss = window.formatted()
                made.append((conv_id, window.number, window.n_repeated, window.tokens, text, [{"start": a, "stop": b} for a, b in loss]))
                size += len(text)
                if len(made) >= 512 or size >= 4 << 20:
                    yield batch()
                    made, size = [], 0
        if made:
            yield batch()

    return ordered.mapInArrow(run, _WINDOWS)


_DIGESTS = "conv_id long, n_windows int, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_conversations(windows: DataFrame) -> DataFrame:
    """Each conversation read back from its windows: counts and digests of all turns and of all text under the mask.

    ``windows`` must hold the windows of a conversation next to each other and in order, as ``format_conversations``
    leaves them; nothing is shuffled and the digests are carried along, so a conversation's length is no matter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*[c.to_pylist() for c in b.columns]))
        made = []
        for conv_id, own in groupby(rows, key=lambda r: r[0]):
            turns_hash, loss_hash = hashlib.sha256(), hashlib.sha256()
            n_windows = n_turns = loss_chars = chars = 0
            for _, repeated, text, loss in own:
                for role, said in read_back(text)[repeated:]:
                    turns_hash.update(f"{role}\n{said}\n".encode())
                    n_turns += 1
                for span in loss:
                    said = unescape(text[span["start"]:span["stop"]])
                    loss_hash.update(said.encode())
                    loss_chars += len(said)
                chars += len(text)
                n_windows += 1
            made.append((conv_id, n_windows, n_turns, turns_hash.hexdigest(), loss_chars, loss_hash.hexdigest(), chars))
            if len(made) >= 2048:
                yield _digest_batch(made)
                made = []
        if made:
            yield _digest_batch(made)

    return windows.select("conv_id", "n_repeated", "text", "loss").mapInArrow(run, _DIGESTS)


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_windows", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

"""Chat formatting with prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns as context, and a loss mask over that reply's text
alone. Turns after the last assistant turn, or a conversation without one, give one more example without a mask, so that
the output holds every turn. Turns stand between control strings; control strings inside texts are escaped reversibly.

Rows of a conversation are ordered by turn, then role and text; repeated rows are turns like others. Null texts count as
empty, null roles as empty ones; null turns come first; rows of a null conversation id form one conversation. An empty
table gives an empty result; other columns are ignored. Conversations pass through tasks as sorted streams: a task holds
one conversation's turns and one of its examples at a time, however long the table; a conversation must fit a task some three
times over (its turns, their joined text, an example).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Control strings of the template.
START, END = "<|im_start|>", "<|im_end|>\n"
TRAINED = "assistant"
#: Characters of examples that are handed on at once.
CHARS = 4_000_000
_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """A text in which no control string begins: one more backslash between < and |."""
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def _escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def parsed(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted example."""
    turns = []
    for part in formatted.split(START)[1:]:
        role, _, body = part.partition("\n")
        turns.append((_unescape_role(role), unescape(body.removesuffix(END))))
    return turns


_NAMES = ["conv_id", "example", "is_last", "n_turns", "formatted", "loss_start", "loss_end"]
_TYPES = [pa.int64(), pa.int32(), pa.bool_(), pa.int32(), pa.string(), pa.int64(), pa.int64()]


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def examples(conversations: DataFrame) -> DataFrame:
    """conv_id, example (its number), is_last, n_turns, formatted, loss_start and loss_end (code points of formatted; null: no mask)."""
    flat = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "text")]
    lined = flat.repartition(F.col("conv_id")).sortWithinPartitions(*order).select("conv_id", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(conv: int | None, turns: list[str], replies: list[tuple[int, int, int]]) -> Iterator[tuple]:
            whole = "".join(turns)
            closing = not replies or replies[-1][0] < len(turns)
            for k, (n, start, end) in enumerate(replies):
                yield conv, k, k == len(replies) - 1 and not closing, n, whole[: end + len(END)], start, end
            if closing:
                yield conv, len(replies), True, len(turns), whole, None, None

        def conversations_of() -> Iterator[tuple]:
            now: tuple = ()
            turns: list[str] = []
            replies: list[tuple[int, int, int]] = []
            length = 0
            for batch in batches:
                for conv, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if now != (conv,):
                        if now:
                            yield from of(now[0], turns, replies)
                        now, turns, replies, length = (conv,), [], [], 0
                    head, body = f"{START}{_escape_role(role)}\n", escape(text)
                    turns.append(head + body + END)
                    if role == TRAINED:
                        replies.append((len(turns), length + len(head), length + len(head) + len(body)))
                    length += len(turns[-1])
            if now:
                yield from of(now[0], turns, replies)

        rows: list[tuple] = []
        held = 0
        for row in conversations_of():
            rows.append(row)
            held += len(row[4])
            if held >= CHARS or len(rows) >= 4096:
                yield _batch(rows, _NAMES, _TYPES)
                rows, held = [], 0
        if rows:
            yield _batch(rows, _NAMES, _TYPES)

    return lined.mapInArrow(run, "conv_id bigint, example int, is_last boolean, n_turns int, formatted string, loss_start bigint, loss_end bigint")


def read_back(made: DataFrame) -> DataFrame:
    """Digests per conversation of what examples hold: all turns, and all text under the mask in order of the examples.

    Each example is read where it lies; only the texts under masks, each of them once, are shuffled to their conversation.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, k, last, n, text, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sha, turns = None, None
                if last:
                    got = parsed(text)
                    sha, turns = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in got).encode("utf-8", "surrogatepass")).hexdigest(), len(got)
                    if turns != n:
                        raise ValueError(f"conversation {conv}: {n} turns went in and {turns} came back")
                rows.append((conv, k, turns, sha, None if start is None else unescape(text[start:end]), len(text)))
            if rows:
                yield _batch(rows, ["conv_id", "example", "n_turns", "turns_sha256", "loss", "chars"], [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64()])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: list | None = None
        names, types = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"], [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        close = lambda x: (*x[:4], x[4].hexdigest(), x[5])
        for batch in batches:
            rows = []
            for conv, turns, sha, loss, chars in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "n_turns", "turns_sha256", "loss", "chars")), strict=True):
                if now is None or now[0] != conv:
                    if now is not None:
                        rows.append(close(now))
                    now = [conv, None, None, 0, hashlib.sha256(), 0]
                if turns is not None:
                    now[1:3] = turns, sha
                if loss is not None:
                    now[3] += len(loss)
                    now[4].update(loss.encode("utf-8", "surrogatepass"))
                now[5] += chars
            if rows:
                yield _batch(rows, names, types)
        if now is not None:
            yield _batch([close(now)], names, types)

    each = made.select(*_NAMES).mapInArrow(read, "conv_id bigint, example int, n_turns bigint, turns_sha256 string, loss string, chars bigint")
    lined = each.repartition(F.col("conv_id")).sortWithinPartitions(F.asc_nulls_first("conv_id"), "example")
    return lined.mapInArrow(fold, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")

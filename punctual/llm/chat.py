"""Chat formatting from an event log.

The log of a conversation holds, by a sequence number of the conversation, events of its messages: ``open`` (role, place), ``delta``
(more text), ``edit`` (the text from now on) and ``regenerate`` (start over). Events of different messages may come between each
other, and a message may be edited after later turns. The role is the last one that any event of the message names; usually only
``open`` does. Logs are partitioned by conversation and sorted by turn, message and sequence; a task folds one message at a time and
renders it, so it holds one message and the digests of one conversation, whatever its length. Messages alone are dealt out one by one.

Template: ``<|im_start|>role`` line break text ``<|im_end|>`` line break. In texts and roles, each ``<`` that is followed by
backslashes and ``|`` gets one backslash more, which takes every control string apart and can be undone exactly. In roles a
line break and a backslash are written as two characters.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)
#: How many code points a streamed delta of the derived log has.
DELTA = 200


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The formatted message, and the start and end of the text in it."""
    head = f"{START}{escape(role.replace(chr(92), chr(92) * 2).replace(chr(10), chr(92) + 'n'))}\n"
    body = escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of formatted messages."""
    out = []
    for role, text in _TURN.findall(formatted):
        role = re.sub(r"\\(\\|n)", lambda m: "\n" if m[1] == "n" else "\\", unescape(role))
        out.append((role, unescape(text)))
    return out


def event_log(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A log which ends in the given messages: conv, turn, message, seq, kind, role, text.

    By a hash of the message, its text is streamed in deltas, or streamed as a draft and regenerated, or opened with a draft and
    edited. The messages of a conversation are streamed side by side: its sequence takes the first events of all of them, then the second.
    Rows tied in conversation and turn are ordered by role and text; repeated rows are counted, and are messages of their own.
    """
    counted = turns.select(
        F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    ).groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    messages = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).withColumn(
        "message", F.concat("role", F.lit("\n"), F.sha2(F.concat_ws("\n", "role", "text"), 256), F.lit("-"), F.lpad("copy", 19, "0")))
    style = F.pmod(F.xxhash64("conv", "turn", "message"), F.lit(3))
    pieces = F.transform(
        F.sequence(F.lit(0), F.floor((F.greatest(F.length("text"), F.lit(1)) - 1) / DELTA).cast("int")),
        lambda i: F.struct(F.lit("delta").alias("kind"), F.substring(F.col("text"), i * DELTA + 1, F.lit(DELTA)).alias("text")))
    one = lambda kind, column: F.array(F.struct(F.lit(kind).alias("kind"), column.alias("text")))
    draft = F.reverse(F.substring("text", 1, DELTA))
    events = F.when(style == 0, F.concat(one("open", F.lit("")), pieces)) \
        .when(style == 1, F.concat(one("open", F.lit("")), one("delta", draft), one("regenerate", F.lit("")), pieces)) \
        .otherwise(F.concat(one("open", F.lit("")), one("delta", draft), one("edit", F.col("text"))))
    role_of_open = F.when(F.col("event.kind") == "open", F.col("role"))
    place = F.col("at").cast("long") * (1 << 31) + F.pmod(F.coalesce("turn", F.lit(0)), F.lit(1 << 31))
    return messages.select("conv", "turn", "message", "role", F.posexplode(events).alias("at", "event")).select(
        "conv", "turn", "message", place.alias("seq"), "event.kind", role_of_open.alias("role"), "event.text")


class _Conversation:
    def __init__(self, conv):
        self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.said, self.learned = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, start: int, end: int, learn: bool) -> None:
        """Take one formatted message, as read back from it."""
        (role, text), = read_back(formatted)
        self.turns += 1
        self.chars += len(formatted)
        self.said.update(f"{role}\n{text}\n".encode())
        if learn:
            masked = unescape(formatted[start:end])
            self.loss_chars += len(masked)
            self.learned.update(masked.encode())

    def row(self) -> tuple:
        return self.conv, self.turns, self.said.hexdigest(), self.loss_chars, self.learned.hexdigest(), self.chars


def fold(events) -> Iterator[tuple]:
    """Sorted events (conv, turn, message, seq, kind, role, text) -> finished messages (conv, turn, role, text).

    An ``edit`` replaces what was streamed, ``regenerate`` drops it, later deltas go on from there. Events before an ``open`` count too.
    A message whose events name no role has the empty one.
    """
    key, role, parts = None, "", []
    for conv, turn, message, _, kind, who, text in events:
        if (conv, turn, message) != key:
            if key is not None:
                yield key[0], key[1], role, "".join(parts)
            key, role, parts = (conv, turn, message), "", []
        if who is not None:
            role = who
        if kind == "regenerate":
            parts = []
        elif kind == "edit":
            parts = [text or ""]
        elif kind in ("open", "delta"):
            parts.append(text or "")
    if key is not None:
        yield key[0], key[1], role, "".join(parts)


def _sorted_log(log: DataFrame, *together: str) -> DataFrame:
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_last(), F.col("message"), F.col("seq")]
    return log.select("conv", "turn", "message", "seq", "kind", "role", "text").repartition(*together).sortWithinPartitions(*order)


def _messages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    return fold(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))


def format_messages(log: DataFrame, learn: str = "assistant") -> DataFrame:
    """One row per message: conv, turn, formatted, loss_start, loss_end (code points within ``formatted``; null where nothing is learned)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for conv, turn, role, text in _messages(batches):
            formatted, start, end = render(role, text)
            rows.append((conv, turn, formatted, start if role == learn else None, end if role == learn else None))
            if len(rows) >= 1000:
                yield _batch(rows, _MESSAGE)
                rows = []
        if rows:
            yield _batch(rows, _MESSAGE)

    return _sorted_log(log, "conv", "turn", "message").mapInArrow(run, "conv long, turn long, formatted string, loss_start long, loss_end long")


def digests(log: DataFrame, learn: str = "assistant") -> DataFrame:
    """One row per conversation, read back from its formatted messages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []
        for conv, _, role, text in _messages(batches):
            if current is None or current.conv != conv:
                if current is not None:
                    rows.append(current.row())
                current = _Conversation(conv)
            current.add(*render(role, text), role == learn)
            if len(rows) >= 1000:
                yield _batch(rows, _DIGEST)
                rows = []
        if current is not None:
            rows.append(current.row())
        if rows:
            yield _batch(rows, _DIGEST)

    return _sorted_log(log, "conv").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


_MESSAGE = pa.schema([("conv", pa.int64()), ("turn", pa.int64()), ("formatted", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64())])
_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

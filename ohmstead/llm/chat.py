"""Chat formatting from event logs.

A log has one row per event of a conversation. Logs are partitioned by conversation and sorted by
message and sequence; one pass over a sorted partition folds streamed deltas, edits and regenerations
into final messages and renders each as one part of the output. A task holds one message at a time,
so a conversation with a third of all rows is streamed, not gathered. Only its order is sequential.

Events, by ``op``:

* ``message`` opens a new message with its text (null text: empty; null role: empty),
* ``delta`` appends its text to the message with the same number,
* ``edit`` replaces that message's text, ``regenerate`` empties it for new deltas.

A delta, edit or regeneration without an open message opens one. Other or null ops count as
``message``. Events of one sequence number come in the order of op, role and text, nulls first. Repeated ``message`` rows are repeated turns.

The template marks a turn as ``<turn ROLE>``, newline, TEXT, newline, ``</turn>``, newline. Inside
ROLE and TEXT a backslash goes before every backslash and angle bracket, so no text can close or open
a turn, and the escape is undone exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EVENTS = "conv_id bigint, msg bigint, seq bigint, op string, role string, text string"
PARTS = "conv_id bigint, part bigint, role string, formatted string, loss array<struct<start:bigint,end:bigint>>"
DIGESTS = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"

_HARD = re.compile(r"([\\<>])")
_SOFT = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<turn ([^\\>]*(?:\\.[^\\>]*)*)>\n([^\\<]*(?:\\.[^\\<]*)*)\n</turn>\n", re.S)


def escape(text: str) -> str:
    return _HARD.sub(r"\\\1", text)


def unescape(text: str) -> str:
    return _SOFT.sub(r"\1", text)


def render(role: str, text: str, trained: str = "assistant") -> tuple[str, list[dict]]:
    """A formatted turn and the spans in it that count for the loss, in code points."""
    head, body = f"<turn {escape(role)}>\n", escape(text)
    loss = [{"start": len(head), "end": len(head) + len(body)}] if role == trained and body else []
    return f"{head}{body}\n</turn>\n", loss


def parse(formatted: str) -> tuple[str, str]:
    m = _TURN.fullmatch(formatted)
    if not m:
        raise ValueError("not a formatted turn")
    return unescape(m[1]), unescape(m[2])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 512) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    yield pa.RecordBatch.from_pylist(held, schema)


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_PARTS = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("role", pa.string()), ("formatted", pa.string()), ("loss", _SPAN)])
_DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def fold(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conv_id, part, role, text) of final messages from sorted (conv_id, msg, seq, op, role, text)."""
    at, part, role, pieces = None, 0, None, []
    for conv, msg, _, op, who, text in rows:
        opened = at == (conv, msg) and role is not None
        if op not in ("delta", "edit", "regenerate") or not opened:
            if role is not None:
                yield at[0], part, role, "".join(pieces)
            part = part + 1 if at is not None and at[0] == conv else 0
            at, role, pieces = (conv, msg), who or "", [] if op == "regenerate" else [text or ""]
        elif op == "delta":
            pieces.append(text or "")
        else:
            pieces = [text or ""] if op == "edit" else []
    if role is not None:
        yield at[0], part, role, "".join(pieces)


def format_logs(events: DataFrame, trained: str = "assistant") -> DataFrame:
    """Formatted parts, in order of ``part`` the whole text of a conversation; ``events`` as ``EVENTS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[dict]:
            for conv, part, role, text in fold(_rows(batches)):
                formatted, loss = render(role, text, trained)
                yield {"conv_id": conv, "part": part, "role": role, "formatted": formatted, "loss": loss}

        yield from _batches(out(), _PARTS)

    cols = ["conv_id", "msg", "seq", "op", "role", "text"]
    sorted_log = events.select(*cols).repartition("conv_id").sortWithinPartitions(*cols)
    return sorted_log.mapInArrow(run, PARTS)


def digests(parts: DataFrame) -> DataFrame:
    """Per conversation, read back from its formatted parts in one streaming pass: turns, masked text, sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[dict]:
            at, state = None, None
            for conv, _, formatted, loss in _rows(batches):
                if state is None or conv != at:
                    if state is not None:
                        yield done(at, state)
                    at, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parse(formatted)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[4] += len(formatted)
                for span in loss or []:
                    masked = unescape(formatted[span["start"] : span["end"]])
                    state[2] += len(masked)
                    state[3].update(masked.encode())
            if state is not None:
                yield done(at, state)

        def done(conv, s) -> dict:
            return {"conv_id": conv, "n_turns": s[0], "turns_sha256": s[1].hexdigest(), "loss_chars": s[2], "loss_sha256": s[3].hexdigest(), "formatted_chars": s[4]}

        yield from _batches(out(), _DIGESTS)

    ordered = parts.select("conv_id", "part", "formatted", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return ordered.mapInArrow(run, DIGESTS)


def from_turns(turns: DataFrame) -> DataFrame:
    """Whole turns (conv_id, turn, role, text) as an event log."""
    turn = F.col("turn").cast("long")
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("msg"), turn.alias("seq"), F.lit("message").alias("op"), "role", "text")

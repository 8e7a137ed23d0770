"""Conversations as training text, assembled byte by byte in columns.

A turn becomes ``### Role:\\n``, its escaped text, and ``\\n</turn>\\n``. For a batch of turns
numpy computes the length of every segment, the cumulative offsets and the indices at which
headers, contents and footers go, and copies them into one preallocated buffer, which is the
data of the Arrow column that comes out. No turn is handled by itself.

Escaping puts a backslash before a backslash, before a ``#`` that follows a ``#``, and before
a ``/`` that follows a ``<``, so neither ``###`` nor ``</turn>`` ever occurs in an escaped
text, and taking each backslash away again, keeping what follows, restores it exactly. Role
names are escaped alike, with line breaks and colons too.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The parts of the template.
OPEN, CLOSE, END = b"### ", b":\n", b"\n</turn>\n"
ASSISTANT = "assistant"

_HASH, _SLASH, _LESS, _BACK = 35, 47, 60, 92
_ESCAPED = re.compile(rb"\\(.)", re.DOTALL)
_TURN = re.compile(rb"### ((?:\\.|[^\\:])*):\n(.*?)\n</turn>\n", re.DOTALL)


def escaped(data: np.ndarray, offsets: np.ndarray, extra: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """The escaped bytes of many texts laid end to end, and their offsets.

    ``extra`` names further bytes that are escaped wherever they stand.
    """
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets[:-1]] = True
    before = np.concatenate([[0], data[:-1]]).astype(np.uint8) if len(data) else data
    before = np.where(first[:-1], 0, before)
    marked = (data == _BACK) | ((data == _HASH) & (before == _HASH)) | ((data == _SLASH) & (before == _LESS))
    for byte in extra:
        marked |= data == byte
    grown = np.concatenate([[0], np.cumsum(marked)])
    out = np.full(len(data) + int(grown[-1]), _BACK, dtype=np.uint8)
    out[np.arange(len(data)) + grown[1:]] = data
    return out, offsets + grown[offsets]


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices ``start .. start + length - 1`` of every segment, one after the other."""
    total = int(lengths.sum())
    skipped = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) if len(lengths) else starts
    return np.arange(total) + skipped


def assembled(roles: tuple[np.ndarray, np.ndarray], texts: tuple[np.ndarray, np.ndarray]):
    """All turns of a batch in one buffer: bytes, offsets, and where each content starts and ends.

    ``roles`` and ``texts`` are bytes with offsets, as in an Arrow column.
    """
    role, role_at = escaped(*roles, extra=b":\n")
    text, text_at = escaped(*texts)
    role_n, text_n = np.diff(role_at), np.diff(text_at)
    size = len(OPEN) + role_n + len(CLOSE) + text_n + len(END)
    at = np.concatenate([[0], np.cumsum(size)])
    buffer = np.empty(int(at[-1]), dtype=np.uint8)
    start = at[:-1]
    for fixed, offset in (
        (OPEN, start),
        (CLOSE, start + len(OPEN) + role_n),
        (END, at[1:] - len(END)),
    ):
        buffer[offset[:, None] + np.arange(len(fixed))] = np.frombuffer(fixed, dtype=np.uint8)
    content = start + len(OPEN) + role_n + len(CLOSE)
    buffer[_spread(start + len(OPEN), role_n)] = role[role_at[0] : role_at[-1]]
    buffer[_spread(content, text_n)] = text[text_at[0] : text_at[-1]]
    return buffer, at, content - start, content - start + text_n


def _column(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null counts as empty."""
    array = array.fill_null("").cast(pa.large_string())
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    held = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, dtype=np.uint8)
    return held[at[0] : at[-1]], at - at[0]


def formatted_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, formatted, loss_start, loss_end`` for every row of ``turns``.

    A conversation's training text is its rows' ``formatted`` one after the other by ``turn``.
    The loss mask covers the bytes ``loss_start .. loss_end - 1`` of a row, the escaped text
    of an assistant's turn; for other roles it is empty. Null texts and roles count as
    empty. The result needs no shuffle; rows of one ``conv_id`` need not be together.
    """
    out = pa.schema(
        [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("formatted", pa.large_string()),
         ("loss_start", pa.int64()), ("loss_end", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            role = batch.column("role").fill_null("")
            buffer, at, start, end = assembled(_column(role), _column(batch.column("text")))
            masked = np.array([r == ASSISTANT for r in role.to_pylist()])
            text = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(buffer))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), role, text,
                 pa.array(start, pa.int64()), pa.array(np.where(masked, end, start), pa.int64())],
                schema=out,
            )

    narrow = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    return narrow.mapInArrow(
        run, "conv_id long, turn long, role string, formatted string, loss_start long, loss_end long"
    )


def parsed(formatted: bytes) -> list[tuple[str, str]]:
    """Roles and texts of the turns in a formatted text; fails on anything that is not one."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if found is None:
            raise ValueError(f"no turn at byte {at}")
        turns.append((unescaped(found[1]), unescaped(found[2])))
        at = found.end()
    return turns


def unescaped(data: bytes) -> str:
    return _ESCAPED.sub(rb"\1", data).decode()


def read_back(formatted: DataFrame) -> DataFrame:
    """A row per conversation from the formatted turns: what was in them, and what the mask covers.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``. Rows are
    dealt by ``conv_id`` and sorted by turn (ties by role, then by text), and every task
    streams over them, holding three counters and two running digests, so that a
    conversation of any length takes no more memory than one turn.
    A null ``conv_id`` is a conversation of its own; null turns come first.
    """
    out = pa.schema(
        [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
         ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        current, open_ = None, False
        turns = chars = masked = 0
        whole, loss = hashlib.sha256(), hashlib.sha256()
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "formatted", "loss_start", "loss_end")]
            for conv, text, start, end in zip(*columns, strict=True):
                if open_ and conv != current:
                    rows.append((current, turns, whole.hexdigest(), masked, loss.hexdigest(), chars))
                if not open_ or conv != current:
                    current, open_, turns, chars, masked = conv, True, 0, 0, 0
                    whole, loss = hashlib.sha256(), hashlib.sha256()
                data = text.encode()
                for role, content in parsed(data):
                    turns += 1
                    whole.update(f"{role}\n{content}\n".encode())
                under = unescaped(data[start:end])
                loss.update(under.encode())
                masked += len(under)
                chars += len(text)
            yield pa.RecordBatch.from_pylist([dict(zip(out.names, r, strict=True)) for r in rows], schema=out)
            rows = []
        if open_:
            rows.append((current, turns, whole.hexdigest(), masked, loss.hexdigest(), chars))
            yield pa.RecordBatch.from_pylist([dict(zip(out.names, r, strict=True)) for r in rows], schema=out)

    dealt = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "formatted")
    return dealt.select("conv_id", "formatted", "loss_start", "loss_end").mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )

"""Conversations as training text, with a loss mask, and back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weatherloom.llm.ngrams import text_bytes

#: A turn is ``### role:\n text </turn>\n`` without the blanks.
_OPEN, _MIDDLE, _CLOSE = b"### ", b":\n", b"</turn>\n"
_END = "</turn>"
#: Bytes of text formatted at once.
_STEP_BYTES = 8 << 20
FORMATTED = "conv_id long, block long, n_turns long, formatted string, loss_starts array<long>, loss_ends array<long>"
CHECKS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape_text(column: pa.Array) -> pa.Array:
    """Texts in which no control string is left: a backslash before every backslash and inside every control string."""
    column = pc.replace_substring(column, "\\", "\\\\")
    return pc.replace_substring(pc.replace_substring(column, "</turn>", "<\\/turn>"), "### ", "#\\## ")


def escape_role(column: pa.Array) -> pa.Array:
    """Roles without a colon."""
    return pc.replace_substring(pc.replace_substring(escape_text(column), ":", "\\;"), "\n", "\\n")


def unescape_text(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: {";": ":", "n": "\n"}.get(m[1], m[1]), role, flags=re.S)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, lengths) of a string column without nulls."""
    data, at = text_bytes(column)
    return data, at[:-1], np.diff(at)


def _scatter(out: np.ndarray, to: np.ndarray, source: np.ndarray, start: np.ndarray, length: np.ndarray) -> None:
    """Copies source[start : start + length] to out[to :], all segments at once."""
    within = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat(to, length) + within] = source[np.repeat(start, length) + within]


def assemble(role: pa.Array, text: pa.Array, loss: np.ndarray, conv: np.ndarray) -> tuple[pa.Array, list[np.ndarray], list[np.ndarray]]:
    """(formatted text of each run of equal ``conv``, start and end of its loss spans in code points).

    Lengths of all segments give the offsets of all segments; then constants, roles and texts are
    copied into one preallocated buffer, which becomes the values of the Arrow array.
    """
    role, text = escape_role(role), escape_text(text)
    rows = len(text)
    parts = [(np.frombuffer(c, np.uint8), np.zeros(rows, np.int64), np.full(rows, len(c))) for c in (_OPEN, _MIDDLE, _CLOSE)]
    segments = [parts[0], _bytes_of(role), parts[1], _bytes_of(text), parts[2]]
    lengths = np.stack([s[2] for s in segments], axis=1)
    ends = np.cumsum(lengths.ravel()).reshape(lengths.shape)
    begins = ends - lengths
    buffer = np.empty(int(ends[-1, -1]) if rows else 0, np.uint8)
    for k, (source, start, length) in enumerate(segments):
        _scatter(buffer, begins[:, k], source, start, length)
    first = np.flatnonzero(np.append(True, conv[1:] != conv[:-1])) if rows else np.zeros(0, np.int64)
    edges = np.append(begins[first, 0], len(buffer)).astype(np.int32)
    formatted = pa.StringArray.from_buffers(len(first), pa.py_buffer(edges), pa.py_buffer(buffer))
    points = np.stack([lengths[:, 0], pc.utf8_length(role).to_numpy(), lengths[:, 2], pc.utf8_length(text).to_numpy(), lengths[:, 4]], axis=1)
    over = np.cumsum(points.ravel()).reshape(points.shape)
    base = np.repeat((over - points)[first, 0], np.diff(np.append(first, rows)))
    starts, stops = (over - points)[:, 3] - base, over[:, 3] - base
    runs = np.split(np.arange(rows), first[1:])
    return formatted, [starts[r][loss[r]] for r in runs], [stops[r][loss[r]] for r in runs]


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """FORMATTED: each conversation as one or more blocks, adjacent in their partition and in order.

    Rows go by turn, then role, then text; null turns come first. A null role or text is empty,
    null conv_ids are one conversation, repeated rows are repeated turns, extra columns are
    ignored, no rows give no rows. The loss spans (code points within the block) cover the
    escaped texts of ``loss_roles``. Conversations are dealt out by hash and sorted on disk, a task
    formats what streams past in steps of bounded size and keeps no group, so the longest
    conversation needs no more memory than any other. ``block`` counts the turns before it.
    """
    rows = turns.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    sorted_rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, before = object(), 0
        for batch in batches:
            size = np.cumsum(pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False)) // _STEP_BYTES
            for step in np.split(np.arange(len(batch)), np.flatnonzero(np.diff(size)) + 1) if len(batch) else []:
                part = batch.slice(int(step[0]), len(step))
                ids = part.column(0).to_pylist()
                conv = np.cumsum([a != b for a, b in zip(ids, [object(), *ids])])
                loss = np.isin(np.array(part.column(1).to_pylist(), object), loss_roles)
                formatted, starts, stops = assemble(part.column(1), part.column(2), loss, conv)
                keys, turns_of = [], np.bincount(conv)[1:]
                blocks = []
                for key, n in zip([ids[i] for i in np.flatnonzero(np.diff(conv, prepend=0))], turns_of):
                    before = before if key == last else 0
                    keys.append(key)
                    blocks.append(before)
                    last, before = key, before + int(n)
                kind = pa.list_(pa.int64())
                arrays = [pa.array(keys, pa.int64()), pa.array(blocks, pa.int64()), pa.array(turns_of, pa.int64()), formatted, pa.array(starts, kind), pa.array(stops, kind)]
                yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "block", "n_turns", "formatted", "loss_starts", "loss_ends"])

    return sorted_rows.mapInArrow(run, FORMATTED)


def turns_of(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn of a block, unescaped."""
    at = 0
    while at < len(formatted):
        middle = formatted.index(":\n", at)
        end = formatted.index(_END, middle)
        yield unescape_role(formatted[at + len(_OPEN) : middle]), unescape_text(formatted[middle + 2 : end])
        at = end + len(_CLOSE)


def read_back(formatted: DataFrame) -> DataFrame:
    """CHECKS of every conversation, read from FORMATTED.

    turns_sha256 is over role, newline, text, newline of every turn; the loss columns are over the
    unescaped texts under the loss mask. Blocks must stand as :func:`format_conversations` puts them;
    sort a stored table by conv_id and block within hash partitions of conv_id first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = object(), None
        for batch in batches:
            done = []
            for conv, _, _, text, starts, stops in zip(*(c.to_pylist() for c in batch.columns)):
                if conv != last:
                    if state is not None:
                        done.append(_row(last, state))
                    last, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, content in turns_of(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{content}\n".encode())
                for a, b in zip(starts, stops):
                    masked = unescape_text(text[a:b])
                    state[2] += len(masked)
                    state[3].update(masked.encode())
                state[4] += len(text)
            yield _checks(done)
        if state is not None:
            yield _checks([_row(last, state)])

    return formatted.mapInArrow(run, CHECKS)


def _row(conv: int | None, state: list) -> tuple:
    return conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]


def _checks(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [(c.split()[0], kinds[c.split()[1]]) for c in CHECKS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(fields)], names=[n for n, _ in fields])

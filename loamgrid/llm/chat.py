"""Chat formatting by columnar byte assembly.

Conversations stream by, turns in order. For a batch of turns the lengths of all segments (header, content, closing mark) are
computed, summed to offsets, and the bytes of headers and contents are copied into one preallocated buffer with
numpy scatter indices; the buffer becomes the Arrow string column as it is.

A turn is `<s>[INST] role [/INST]` newline, the text, newline `</s>` newline. Inside roles and texts a backslash is doubled and every
control string gets a backslash and a hyphen after its first character, so no control string is left and the
original can be read back. The loss mask covers the contents of assistant turns.

A conversation is given in pieces of PIECE_TURNS turns at most, so one with any number of turns passes through bounded memory; pieces of
one conversation follow each other in one partition.

Edge cases: a null text or role is empty; turns stand by turn, null first, ties by role and text, repeated rows stay; an empty table
gives no rows; rows with a null conv_id form one conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, partitions, small_batches, utf8

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
HEAD, AFTER_ROLE, CLOSE = b"<s>[INST] ", b" [/INST]\n", b"\n</s>\n"
PIECE_TURNS = 256
LOSS_ROLE = "assistant"
FORMATTED = "conv_id long, piece int, last boolean, formatted string, loss_starts array<int>, loss_ends array<int>"
_turn = re.compile(re.escape(HEAD.decode()) + "(.*?)" + re.escape(AFTER_ROLE.decode()) + "(.*?)" + re.escape(CLOSE.decode()), re.S)
_escape = re.compile(r"\\[\\-]")


def escape(column: pa.Array) -> pa.Array:
    """Texts without control strings; reversible."""
    column = pc.replace_substring(pc.fill_null(column, ""), "\\", "\\\\")
    for mark in CONTROL:
        column = pc.replace_substring(column, mark, mark[0] + "\\-" + mark[1:])
    return column


def unescape(text: str) -> str:
    return _escape.sub(lambda m: "\\" if m[0] == "\\\\" else "", text) if "\\" in text else text


def scatter(target: np.ndarray, at: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Copy segment i of data (offsets[i] to offsets[i+1]) to target[at[i]:]."""
    if len(data):
        target[np.arange(len(data)) + np.repeat(at - offsets[:-1], np.diff(offsets))] = data


def assemble(role: pa.Array, text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One buffer of all formatted turns, the start of each (and the end of the last), and start and end of each content."""
    roles, role_at = utf8(escape(role))
    texts, text_at = utf8(escape(text))
    n = len(role_at) - 1
    role_len, text_len = np.diff(role_at), np.diff(text_at)
    starts = np.zeros(n + 1, np.int64)
    np.cumsum(len(HEAD) + role_len + len(AFTER_ROLE) + text_len + len(CLOSE), out=starts[1:])
    buffer = np.empty(int(starts[-1]), np.uint8)
    at = starts[:-1]
    content = at + len(HEAD) + role_len + len(AFTER_ROLE)
    fixed = ((at, HEAD), (at + len(HEAD) + role_len, AFTER_ROLE), (content + text_len, CLOSE))
    for place, mark in fixed:
        buffer[place[:, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)
    scatter(buffer, at + len(HEAD), roles, role_at)
    scatter(buffer, content, texts, text_at)
    return buffer, starts, content, content + text_len


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns in order to formatted pieces; a piece ends with its conversation, its slice or after PIECE_TURNS turns."""
    held: pa.RecordBatch | None = None
    count = piece = 0
    open_conv: object = object()
    for batch in _with_end(batches):
        if batch is None:
            break
        for part in chunks(batch, "text", rows=4 * PIECE_TURNS):
            # the last turn is held back, so that a piece knows whether its conversation goes on
            part = part if held is None else pa.Table.from_batches([held, part]).combine_chunks().to_batches()[0]
            held = part.slice(part.num_rows - 1)
            ready = part.slice(0, part.num_rows - 1)
            if ready.num_rows:
                made, open_conv, count, piece = _format(ready, held.column("conv_id")[0].as_py(), open_conv, count, piece)
                yield made
    if held is not None:
        yield _format(held, object(), open_conv, count, piece)[0]


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b for b in batches if b.num_rows)


def _format(part: pa.RecordBatch, following: object, open_conv: object, count: int, piece: int):
    buffer, starts, content, content_end = assemble(part.column("role"), part.column("text"))
    convs = part.column("conv_id").to_pylist()
    firsts, ids, numbers, lasts = [], [], [], []
    for i, conv in enumerate(convs):
        if conv != open_conv or i == 0 or count % PIECE_TURNS == 0:
            piece = piece + 1 if conv == open_conv else 0
            count = 0 if conv != open_conv else count
            firsts.append(i)
            ids.append(conv)
            numbers.append(piece)
            open_conv = conv
        count += 1
    edges = [*firsts, len(convs)]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        lasts.append((convs[b] if b < len(convs) else following) != convs[a])
    offsets = starts[edges]
    # positions of the mask count code points from the start of the piece
    points = np.zeros(len(buffer) + 1, np.int32)
    np.cumsum((buffer & 0xC0) != 0x80, out=points[1:])
    loss = np.flatnonzero(np.asarray(pc.fill_null(pc.equal(part.column("role"), LOSS_ROLE), False)))
    owner = np.searchsorted(edges, loss, "right") - 1
    base = points[offsets[owner]]
    cuts = pa.array(np.searchsorted(owner, np.arange(len(firsts) + 1)).astype(np.int32))
    spans = [pa.ListArray.from_arrays(cuts, pa.array(points[x[loss]] - base, pa.int32())) for x in (content, content_end)]
    text = pa.StringArray.from_buffers(len(firsts), pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(buffer))
    made = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(numbers, pa.int32()), pa.array(lasts), text, *spans], ["conv_id", "piece", "last", "formatted", "loss_starts", "loss_ends"])
    return made, open_conv, count, piece


def format_chats(turns: DataFrame) -> DataFrame:
    """Formatted pieces of every conversation, in order within a partition, with the spans of the loss mask in code points."""
    spark = turns.sparkSession
    small_batches(spark)
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    rows = rows.repartition(partitions(spark), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.mapInArrow(_pieces, FORMATTED)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn, read back from formatted text."""
    return [(unescape(role), unescape(text)) for role, text in _turn.findall(formatted)]


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(pieces: DataFrame) -> DataFrame:
    """Digests of what every conversation's pieces say, read from the formatted text and the mask alone.

    The pieces must come straight from format_chats, whose order this keeps: only running digests are held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns, loss = hashlib.sha256(), hashlib.sha256()
        n_turns = loss_chars = chars = 0
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                text = row["formatted"]
                said = parse(text)
                turns.update("".join(f"{role}\n{body}\n" for role, body in said).encode())
                learned = "".join(unescape(text[a:b]) for a, b in zip(row["loss_starts"], row["loss_ends"], strict=True))
                loss.update(learned.encode())
                n_turns, loss_chars, chars = n_turns + len(said), loss_chars + len(learned), chars + len(text)
                if row["last"]:
                    rows.append((row["conv_id"], n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                    n_turns = loss_chars = chars = 0
            if rows:
                columns = list(zip(*rows, strict=True))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in DIGEST.split(", ")])

    return pieces.mapInArrow(run, DIGEST)

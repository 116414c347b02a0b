"""Chat formatting: conversations as single strings with a loss mask, put together column by column.

A turn is ``[INST]role[/INST]text</s>``. Control strings inside roles and texts get a backslash after their
first character and backslashes are doubled, so that each control string found in the output is the template's.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

OPEN, MIDDLE, CLOSE = "[INST]", "[/INST]", "</s>"
#: Strings with a meaning to this template or to common tokenizers.
CONTROLS = ("[INST]", "[/INST]", "<s>", "</s>", "<|", "<<SYS>>", "<</SYS>>")
TRAINED_ROLE = "assistant"
# Text put together at a time, and bytes whose places are held at a time, 16 each.
SLICE_BYTES = 1 << 25
GATHER_BYTES = 1 << 22

_TURN = re.compile(re.escape(OPEN) + "(.*?)" + re.escape(MIDDLE) + "(.*?)" + re.escape(CLOSE), re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(texts: pa.Array) -> pa.Array:
    texts = pc.replace_substring(texts, "\\", "\\\\")
    for control in CONTROLS:
        texts = pc.replace_substring(texts, control, f"{control[0]}\\{control[1:]}")
    return texts


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def masked(formatted: str, mask: list[dict]) -> str:
    """The text under the loss mask, as it was before formatting."""
    raw = formatted.encode()
    return "".join(unescape(raw[span["begin"] : span["end"]].decode()) for span in mask)


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    data = texts.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def assemble(roles: pa.Array, texts: pa.Array, bounds: np.ndarray, trained: str) -> tuple[pa.Array, pa.Array]:
    """Formatted conversations and their masks; ``bounds`` are those of conversations in the turns."""
    turns = len(roles)
    fixed = np.frombuffer((OPEN + MIDDLE + CLOSE).encode(), np.uint8)
    (role_raw, role_at), (text_raw, text_at) = _bytes(escape(roles)), _bytes(escape(texts))
    source = np.concatenate([fixed, role_raw, text_raw])
    begins, lengths = np.empty((turns, 5), np.int64), np.empty((turns, 5), np.int64)
    for column, (begin, length) in enumerate(
        (
            (0, len(OPEN)),
            (len(fixed) + role_at[:-1], np.diff(role_at)),
            (len(OPEN), len(MIDDLE)),
            (len(fixed) + len(role_raw) + text_at[:-1], np.diff(text_at)),
            (len(OPEN) + len(MIDDLE), len(CLOSE)),
        )
    ):
        begins[:, column], lengths[:, column] = begin, length
    begins, lengths = begins.reshape(-1), lengths.reshape(-1)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if turns else 0
    out = np.empty(total, np.uint8)
    starts = ends - lengths
    for a in range(0, total, GATHER_BYTES):
        b = min(a + GATHER_BYTES, total)
        part = slice(np.searchsorted(ends, a, "right"), np.searchsorted(ends, b, "left") + 1)
        counts = np.minimum(ends[part], b) - np.maximum(starts[part], a)
        out[a:b] = source[np.arange(a, b) - np.repeat((starts - begins)[part], counts)]
    offsets = np.concatenate([[0], ends[4::5]])[bounds]
    formatted = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(offsets), pa.py_buffer(out))
    learned = np.flatnonzero(np.asarray(pc.equal(roles, trained).to_pylist(), bool))
    start = np.repeat(offsets[:-1], np.diff(bounds))[learned]
    spans = pa.StructArray.from_arrays(
        [pa.array((ends - lengths)[3::5][learned] - start), pa.array(ends[3::5][learned] - start)], ["begin", "end"]
    )
    return formatted, pa.ListArray.from_arrays(pa.array(np.searchsorted(learned, bounds).astype(np.int32)), spans)


def _conversations(batches: Iterator[pa.RecordBatch], trained: str) -> Iterator[pa.RecordBatch]:
    """Batches of whole conversations out of sorted turns; the last one of a batch waits for the next batch."""

    def parts(table: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Conversations together up to ``SLICE_BYTES`` of text, or one."""
        sizes = pc.add(pc.binary_length(table.column("role")), pc.binary_length(table.column("text")))
        upto = np.concatenate([[0], np.cumsum(sizes.to_numpy().astype(np.int64))])[bounds]
        begin = 0
        while begin < len(bounds) - 1:
            end = max(begin + 1, int(np.searchsorted(upto, upto[begin] + SLICE_BYTES, "right")) - 1)
            yield made(table.slice(bounds[begin], bounds[end] - bounds[begin]), bounds[begin : end + 1] - bounds[begin])
            begin = end

    def made(table: pa.Table, bounds: np.ndarray) -> pa.RecordBatch:
        column = lambda name: pa.concat_arrays(table.column(name).chunks)
        formatted, mask = assemble(column("role"), column("text"), bounds, trained)
        first = table.column("conv").take(pa.array(bounds[:-1])).combine_chunks()
        return pa.RecordBatch.from_arrays(
            [first, pa.array(np.diff(bounds)), formatted.cast(pa.string()), mask], ["conv", "turns", "formatted", "mask"]
        )

    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        if waiting and waiting[-1].column("conv")[-1] == batch.column("conv")[0] and _single(batch):
            waiting.append(batch)
            continue
        table = pa.Table.from_batches([*waiting, batch])
        bounds = _bounds(table.column("conv").combine_chunks())
        if len(bounds) > 2:
            yield from parts(table.slice(0, bounds[-2]), bounds[:-1])
        waiting = table.slice(bounds[-2]).to_batches()
    if waiting:
        table = pa.Table.from_batches(waiting)
        yield made(table, np.array([0, table.num_rows]))


def _single(batch: pa.RecordBatch) -> bool:
    conv = batch.column("conv")
    return conv[0] == conv[-1]


def _bounds(conv: pa.Array) -> np.ndarray:
    if len(conv) < 2:
        return np.array([0, len(conv)])
    a, b = conv[:-1], conv[1:]
    new = pc.fill_null(pc.not_equal(a, b), False)
    new = pc.or_(new, pc.xor(pc.is_null(a), pc.is_null(b)))
    return np.concatenate([[0], np.flatnonzero(new.to_numpy(zero_copy_only=False)) + 1, [len(conv)]])


def format_chat(
    turns: DataFrame,
    *,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    trained_role: str = TRAINED_ROLE,
) -> DataFrame:
    """Each conversation as ``conv``, ``n_turns``, ``formatted`` and ``mask``.

    ``mask`` lists the byte ranges of ``formatted`` in UTF-8 that hold the texts of ``trained_role``. Turns
    are in order of ``turn``, null first; turns of one number are in order of role and text and all kept. A null role or
    text is empty; rows without a conversation id form one conversation of their own. A conversation is one
    string and so made in one task, as large as a string can be (2 GiB). Conversations are put together up to
    ``SLICE_BYTES`` of text at a time. Other columns are ignored.
    """
    source = turns.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    kind = source.schema["conv"].dataType.simpleString()
    made = (
        source.repartition("conv")
        .sortWithinPartitions("conv", "turn", "role", "text")
        .drop("turn")
        .mapInArrow(
            lambda batches: _conversations(batches, trained_role),
            f"conv {kind}, turns long, formatted string, mask array<struct<begin:long,end:long>>",
        )
    )
    return made.withColumnsRenamed({"conv": conv, "turns": "n_turns"})

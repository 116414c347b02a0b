"""Edges of a block as arrays, and what their senders hold, sent to them in arrays too.

These are functions of Python workers: they see a block's rows, or those of a task, as a whole and count with numpy, where rows would
be joined, hashed and sorted one by one.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from weftgraph.operators import runtime

runtime.travels(__name__)

FLUSH_EDGES = 1 << 21
"""Edges that a task deals to blocks at a time."""
PART_EDGES = 1 << 20
"""Edges in a row of a block, at most."""

# Rows of a block: its edges, in parts; its receivers and how many edges each has; what a block sends to its peer.
EDGES, RECEIVERS, ROUTE = range(3)

SCATTERED = "block int, src binary, dst binary"
LAID = "block int, kind int, peer int, first binary, second binary"
MESSAGES = "block int, peer int, ids binary, labels binary"
FOUND = "block int, id long, label long, was long"

_SCATTERED = pa.schema([("block", pa.int32()), ("src", pa.binary()), ("dst", pa.binary())])
_LAID = pa.schema([(n, pa.int32()) for n in ("block", "kind", "peer")] + [(n, pa.binary()) for n in ("first", "second")])
_MESSAGES = pa.schema([("block", pa.int32()), ("peer", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary())])
_FOUND = pa.schema([("block", pa.int32()), ("id", pa.int64()), ("label", pa.int64()), ("was", pa.int64())])


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as bytes: the least one, and how far each is above it in as few bytes as the greatest needs."""
    if not len(values):
        return b""
    least = int(values.min())
    span = int(values.max()) - least
    width = next(w for w in (1, 2, 4, 8) if span < 1 << 8 * w)
    above = values.astype(np.int64).view(np.uint64) - np.uint64(least % (1 << 64))
    return struct.pack("<qb", least, width) + above.astype(f"<u{width}").tobytes()


def unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.int64)
    least, width = struct.unpack_from("<qb", data)
    above = np.frombuffer(data, f"<u{width}", offset=9).astype(np.uint64)
    return (above + np.uint64(least % (1 << 64))).view(np.int64)


def _joined(arrays: Iterable[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *arrays])


def blocks_of(ids: np.ndarray, blocks: int) -> np.ndarray:
    """``pmod(hash(id), blocks)`` as Spark has it."""

    def turned(x: np.ndarray, by: int) -> np.ndarray:
        return (x << np.uint32(by)) | (x >> np.uint32(32 - by))

    bits = ids.astype(np.int64).view(np.uint64)
    h = np.full(len(ids), 42, np.uint32)
    for half in ((bits & np.uint64(0xFFFFFFFF)).astype(np.uint32), (bits >> np.uint64(32)).astype(np.uint32)):
        h ^= turned(half * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)
        h = turned(h, 13) * np.uint32(5) + np.uint32(0xE6546B64)
    h ^= np.uint32(8)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h = (h ^ (h >> np.uint32(shift))) * np.uint32(factor)
    h ^= h >> np.uint32(16)
    return np.mod(h.view(np.int32).astype(np.int64), blocks)


def spans(keys: np.ndarray) -> list[tuple[int, slice]]:
    """The runs of equal values in sorted ``keys``, each with its value."""
    begin = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return [(int(keys[b]), slice(int(b), int(e))) for b, e in zip(begin, [*begin[1:], len(keys)])]


def scatter(batches: Iterable[pa.RecordBatch], blocks: int, both: bool) -> Iterator[pa.RecordBatch]:
    """Edges ``(src, dst)`` as a row for each receiver's block, many edges at a time; ``both`` adds the reverse of each."""
    held, size = [], 0

    def dealt() -> pa.RecordBatch:
        src, dst = (_joined(b[name].to_numpy() for b in held) for name in ("src", "dst"))
        if both:
            src, dst = np.concatenate([src, dst]), np.concatenate([dst, src])
        block = blocks_of(dst, blocks)
        order = np.argsort(block, kind="stable")
        src, dst, rows = src[order], dst[order], spans(block[order])
        columns = [[b for b, _ in rows], [pack(src[s]) for _, s in rows], [pack(dst[s]) for _, s in rows]]
        return pa.record_batch(columns, schema=_SCATTERED)

    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= FLUSH_EDGES:
            yield dealt()
            held, size = [], 0
    if size:
        yield dealt()


def lay_out(batches: Iterable[pa.RecordBatch], blocks: int) -> Iterator[pa.RecordBatch]:
    """The rows of a block of ``scatter``'s edges: they are sorted by receiver, and each names the place of its sender among all
    that the block hears of, sorted by their block and id.
    """
    sent: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        for block, src, dst in zip(*(batch[name].to_pylist() for name in ("block", "src", "dst"))):
            sent.setdefault(block, []).append((unpack(src), unpack(dst)))
    for block in sorted(sent):
        src, dst = (_joined(side) for side in zip(*sent.pop(block)))
        order = np.argsort(dst, kind="stable")
        receivers, degrees = np.unique(dst, return_counts=True)
        senders, place = np.unique(src[order], return_inverse=True)
        del src, dst, order
        home = blocks_of(senders, blocks)
        order = np.argsort(home, kind="stable")
        senders, home = senders[order], home[order]
        position = np.empty(len(order), np.int64)
        position[order] = np.arange(len(order))
        place = position[place]
        rows = [(block, RECEIVERS, 0, pack(receivers), pack(degrees))]
        rows += [(block, EDGES, i, pack(place[b : b + PART_EDGES]), None) for i, b in enumerate(range(0, len(place), PART_EDGES))]
        rows += [(peer, ROUTE, block, pack(senders[s]), None) for peer, s in spans(home)]
        yield pa.record_batch([list(column) for column in zip(*rows)], schema=_LAID)


def send(state: pa.Table, routes: pa.Table) -> pa.Table:
    """Labels of a block's vertices to all blocks that have edges from them; and to itself with the ids."""
    if not state.num_rows:
        if routes.num_rows:
            raise ValueError("edges name vertices that the graph does not have")
        return _MESSAGES.empty_table()
    ids, labels = state["id"].to_numpy(), state["label"].to_numpy()
    home = state["block"][0].as_py()
    rows = [(home, -1, pack(ids), pack(labels))]
    for peer, data in zip(routes["peer"].to_pylist(), routes["first"].to_pylist()):
        asked = unpack(data)
        at = np.minimum(np.searchsorted(ids, asked), len(ids) - 1)
        if not np.array_equal(ids[at], asked):
            raise ValueError("edges name vertices that the graph does not have")
        rows.append((peer, home, None, pack(labels[at])))
    return pa.table([list(column) for column in zip(*rows)], schema=_MESSAGES)


def most_frequent(laid: pa.Table, messages: pa.Table) -> pa.Table:
    """The label most frequent among the edges of each vertex of a block, the smallest of equals; its own one where there are none."""
    ids = labels = None
    heard: dict[int, np.ndarray] = {}
    for peer, own, sent in zip(*(messages[name].to_pylist() for name in ("peer", "ids", "labels"))):
        if own is None:
            heard[peer] = unpack(sent)
        else:
            ids, labels = unpack(own), unpack(sent)
    if ids is None:
        return _FOUND.empty_table()
    after = labels
    if laid.num_rows:
        parts: dict[int, np.ndarray] = {}
        for kind, part, first, second in zip(*(laid[name].to_pylist() for name in ("kind", "peer", "first", "second"))):
            if kind == RECEIVERS:
                receivers, degrees = unpack(first), unpack(second)
            else:
                parts[part] = unpack(first)
        # Labels as ranks, which keep their order, so that receiver and label are one number.
        known, rank = np.unique(_joined(heard[peer] for peer in sorted(heard)), return_inverse=True)
        key = rank[_joined(parts[part] for part in sorted(parts))]
        del parts, heard
        key += np.repeat(np.arange(len(receivers)) * len(known), degrees)
        key.sort()
        begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        times = np.diff(np.r_[begin, len(key)])
        key = key[begin]
        receiver, label = key // len(known), key % len(known)
        # More times come first, and the smaller label of equals.
        score = times * len(known) + (len(known) - 1 - label)
        best = np.maximum.reduceat(score, np.flatnonzero(np.r_[True, receiver[1:] != receiver[:-1]]))
        after = labels.copy()
        after[np.searchsorted(ids, receivers)] = known[len(known) - 1 - best % len(known)]
    block = np.full(len(ids), messages["block"][0].as_py(), np.int32)
    return pa.table([block, ids, after, labels], schema=_FOUND)

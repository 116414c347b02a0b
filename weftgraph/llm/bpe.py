"""Byte-level BPE encoding and decoding with a public vocabulary.

A text is split into words, and a word's bytes are merged pair by pair. A segment tree over the ranks of adjacent
pairs holds the least rank of each range; its root leads to the leftmost pair of the lowest rank, and a merge changes
three leaves, so a word of n bytes costs n log n, however long it is.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import DataType, StructField, StructType
from tokenizers import pre_tokenizers

from weftgraph.llm.columns import named, numbered
from weftgraph.llm.text import slices

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
MOST_BYTES = 64 << 20
"""Largest vocabulary file; it is read by the driver and sent to each executor once."""
WORDS_KEPT = 200_000
"""Words whose ids a task remembers; others are merged again when they come back."""
SLICE_BYTES = 1 << 20
"""Text handled at once in a task; a longer text is handled alone."""
TOGETHER = 64
"""Characters of the longest words that are merged many at a time; longer ones are merged alone."""

#: How byte-level vocabularies of this kind split texts, in general and for ASCII alone.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
ASCII_WORDS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^ \t-\rA-Za-z0-9]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+"
)

_NONE = 1 << 62


@dataclass(frozen=True)
class Vocabulary:
    """Ids of single bytes, merges as ``{first id << 32 | second id: rank}`` with the id each rank makes, the bytes
    of all ids, and the ids of strings that are never split."""

    singles: list[int]
    ranks: dict[int, int]
    made: list[int]
    pieces: dict[int, bytes]
    added: dict[str, int]


def byte_characters() -> list[str]:
    """The character that stands for each byte in the vocabulary: itself if it prints, else the next from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(byte) if byte in prints else chr(next(others)) for byte in range(256)]


def read_vocabulary(path: str) -> Vocabulary:
    """A vocabulary from a tokenizer file; others than byte-level BPE with the common splitting are refused."""
    file = Path(path)
    if file.stat().st_size > MOST_BYTES:
        raise ValueError(f"{path} is larger than {MOST_BYTES} bytes")
    found = json.loads(file.read_text(encoding="utf-8"))
    model, splits = found["model"], found["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and not any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    usual = splits.get("type") == "ByteLevel" and splits.get("use_regex", True) and not splits.get("add_prefix_space")
    if not (plain and usual and found["normalizer"] is None):
        raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
    if any(x["single_word"] or x["lstrip"] or x["rstrip"] for x in found["added_tokens"]):
        raise ValueError(f"{path} has added tokens that depend on what stands around them")
    characters = byte_characters()
    byte_of = {character: byte for byte, character in enumerate(characters)}
    ids, ranks, made = model["vocab"], {}, []
    for rank, pair in enumerate(model["merges"]):
        first, second = pair.split(" ") if isinstance(pair, str) else pair
        ranks.setdefault(ids[first] << 32 | ids[second], rank)
        made.append(ids[first + second])
    pieces = {i: bytes(byte_of[x] for x in piece) for piece, i in ids.items()}
    added = {x["content"]: x["id"] for x in found["added_tokens"]}
    pieces |= {i: content.encode() for content, i in added.items()}
    return Vocabulary([ids[x] for x in characters], ranks, made, pieces, added)


def merged(ids: list[int], ranks: dict[int, int], made: list[int]) -> list[int]:
    """``ids`` after all merges, always the leftmost of the pairs of lowest rank first."""
    n = len(ids)
    if n < 2:
        return ids
    ids = list(ids)
    size = 1 << (n - 2).bit_length()
    tree = [_NONE] * (2 * size)
    find = ranks.get
    tree[size : size + n - 1] = [find(ids[i] << 32 | ids[i + 1], _NONE) for i in range(n - 1)]
    for node in range(size - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))

    def put(place: int, rank: int) -> None:
        node = size + place
        tree[node] = rank
        while node > 1:
            other = tree[node ^ 1]
            if other < rank:
                rank = other
            node >>= 1
            if tree[node] == rank:
                return
            tree[node] = rank

    while (rank := tree[1]) < _NONE:
        node = 1
        while node < size:
            node *= 2
            if tree[node] != rank:
                node += 1
        place = node - size
        gone = after[place]
        new = ids[place] = made[rank]
        follows = after[place] = after[gone]
        ids[gone] = -1
        if gone < n - 1:
            put(gone, _NONE)
        if follows < n:
            before[follows] = place
            put(place, find(new << 32 | ids[follows], _NONE))
        else:
            put(place, _NONE)
        if place:
            earlier = before[place]
            put(earlier, find(ids[earlier] << 32 | new, _NONE))
    return [x for x in ids if x >= 0]


def merged_many(ids: np.ndarray, lengths: np.ndarray, pairs: Pairs) -> np.ndarray:
    """Columns of ``ids`` after all merges, as ``merged`` makes them, with -1 where an id has gone.

    Column ``w`` begins with the ``lengths[w]`` ids of a word, and -1 follows. All words have a tree of the same size,
    and all take their next merge at once.
    """
    rows, count = ids.shape
    bits = max(1, (rows - 3).bit_length())
    size = 1 << bits
    place_of = np.arange(size)[:, None]
    tree = np.full((2 * size, count), _NONE, np.int64)
    ranks = pairs.ranks(ids[:-1], ids[1:])[:size]
    tree[size : size + len(ranks)] = np.where(ranks < _NONE, ranks << bits | place_of[: len(ranks)], _NONE)
    for node in range(size - 1, 0, -1):
        np.minimum(tree[2 * node], tree[2 * node + 1], out=tree[node])
    before = np.repeat(np.arange(-1, rows - 1)[:, None], count, 1)
    after = np.repeat(np.arange(1, rows + 1)[:, None], count, 1)
    while len(word := np.flatnonzero(tree[1] < _NONE)):
        root = tree[1, word]
        place, new = root & (size - 1), pairs.made[root >> bits]
        gone = after[place, word]
        follows = after[gone, word]
        earlier = before[place, word]
        ids[place, word], ids[gone, word] = new, -1
        after[place, word], before[follows, word] = follows, place
        last, first = gone >= lengths[word] - 1, earlier < 0
        # A last id has no leaf and a first id no neighbour; the leaf of the new id is set in their place.
        leaves = [np.where(last, place, gone), place, np.where(first, place, earlier)]
        tree[size + leaves[0], word] = _NONE
        right = pairs.ranks(new, ids[follows, word])
        left = pairs.ranks(np.where(first, -1, ids[leaves[2], word]), new)
        tree[size + place, word] = np.where(right < _NONE, right << bits | place, _NONE)
        other = np.flatnonzero(~first)
        value = np.where(left < _NONE, left << bits | leaves[2], _NONE)[other]
        tree[size + leaves[2][other], word[other]] = value
        nodes = [size + leaf for leaf in leaves]
        for _ in range(bits):
            nodes = [node >> 1 for node in nodes]
            for node in nodes:
                tree[node, word] = np.minimum(tree[2 * node, word], tree[2 * node + 1, word])
    return ids


class Pairs:
    """Ranks of many pairs of ids at once."""

    def __init__(self, vocabulary: Vocabulary):
        keys = np.fromiter(vocabulary.ranks, np.int64, len(vocabulary.ranks))
        ranks = np.fromiter(vocabulary.ranks.values(), np.int64, len(keys))
        order = np.argsort(keys)
        self._keys, self._ranks = np.append(keys[order], _NONE), np.append(ranks[order], _NONE)
        self.made = np.array(vocabulary.made, np.int64)

    def ranks(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``_NONE`` where the vocabulary does not merge it or an id is -1."""
        asked = first.astype(np.int64) << 32 | second
        at = np.searchsorted(self._keys, asked)
        return np.where(self._keys[at] == asked, self._ranks[at], _NONE)


def words(text: str) -> list[str]:
    """``text`` split as the vocabulary's library splits it.

    Texts with characters younger than Python's Unicode tables, which pattern and library may class differently,
    are split by the library itself.
    """
    if text.isascii():
        return ASCII_WORDS.findall(text)
    if any(unicodedata.category(x) == "Cn" for x in set(text)):
        spans = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str(text)
        return [text[begin:end] for _, (begin, end) in spans]
    return WORDS.findall(text)


class Encoder:
    """Ids of texts; remembers those of words it has met, as far as their number is bounded."""

    def __init__(self, vocabulary: Vocabulary):
        self._of = vocabulary
        self._pairs = Pairs(vocabulary)
        self._singles = np.array([*vocabulary.singles, -1], np.int32)
        # Of several that begin at one place the longest counts.
        whole = sorted(vocabulary.added, key=len, reverse=True)
        self._split = re.compile("(" + "|".join(map(re.escape, whole)) + ")") if whole else None
        self._forget()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and the bounds of each text in it."""
        found = [self._words(text) for text in texts]
        if len(self._number) > WORDS_KEPT:
            self._forget()
        flat = list(chain.from_iterable(found))
        new = set(flat).difference(self._number)
        long = [word for word in new if len(word) > TOGETHER]
        self._learn([word for word in new if len(word) <= TOGETHER])
        held = self._ids, self._bounds
        for word in long:
            ids = merged([self._of.singles[x] for x in word.encode()], self._of.ranks, self._of.made)
            self._add([word], np.array(ids, np.int32), np.array([len(ids)]))
        number = self._number
        met = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
        begins, lengths = self._bounds[met], self._bounds[met + 1] - self._bounds[met]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        ids = self._ids[np.arange(ends[-1]) + np.repeat(begins - ends[:-1], lengths)]
        # Long words seldom come back and would fill the memory.
        self._ids, self._bounds = held
        for word in long:
            del number[word]
        return ids, ends[np.concatenate([[0], np.cumsum([len(text) for text in found], dtype=np.int64)])]

    def _words(self, text: str) -> list[str]:
        if self._split is None:
            return words(text)
        # Strings that are never split stand at odd places; no word can be one of them.
        parts = self._split.split(text)
        return words(text) if len(parts) == 1 else [word for i, x in enumerate(parts) for word in ([x] if i % 2 else words(x))]

    def _forget(self) -> None:
        self._number: dict[str, int] = {}
        self._ids, self._bounds = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self._add(list(self._of.added), np.array([*self._of.added.values()], np.int32), np.ones(len(self._of.added), np.int64))

    def _add(self, new: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        self._number.update(zip(new, range(len(self._number), len(self._number) + len(new)), strict=True))
        self._bounds = np.concatenate([self._bounds, self._bounds[-1] + np.cumsum(lengths)])
        self._ids = np.concatenate([self._ids, ids])

    def _learn(self, new: list[str]) -> None:
        raw = [word.encode() for word in new]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        bits = np.maximum(1, np.ceil(np.log2(np.maximum(size - 1, 1)))).astype(np.int64)
        for kind in np.unique(bits):
            group = np.flatnonzero(bits == kind)
            rows = (1 << int(kind)) + 2
            for some in np.array_split(group, -(-len(group) // 8192)):
                places = np.full((len(some), rows), 256)
                places[np.arange(rows) < size[some, None]] = np.frombuffer(b"".join([raw[i] for i in some]), np.uint8)
                ids = merged_many(np.ascontiguousarray(self._singles[places].T), size[some], self._pairs).T
                left = ids >= 0
                self._add([new[i] for i in some], ids[left], left.sum(axis=1))


def decoder(vocabulary: Vocabulary) -> Callable[[list[int]], str]:
    """A function from ids to their text; unknown ids are left out, bytes that are no UTF-8 become U+FFFD."""
    pieces = vocabulary.pieces
    return lambda ids: b"".join([pieces.get(x, b"") for x in ids]).decode("utf-8", "replace")


def read_ids(column: pa.Array) -> Iterator[list[int]]:
    """The ids of each row of a column of lists, taken from it in bulk; none for a null row, -1 for a null id."""
    flat = column.flatten().fill_null(-1).to_numpy()
    begin = 0
    for size in column.value_lengths().fill_null(0).to_pylist():
        yield flat[begin : begin + size].tolist()
        begin += size


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, *, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the token ids of ``text`` as ``ids``, in place of a column of that name.

    ``vocabulary`` is a tokenizer file on the driver. A null or empty text has no ids. Rows are kept as they are,
    repeated ones too; a text is one task's work whatever its length, and a batch of them is taken in slices.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def rows(batch: pa.RecordBatch, column: str, encoder: Encoder) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
        for part in slices(batch, column, SLICE_BYTES):
            found, bounds = encoder.encode([x or "" for x in part.column(column).to_pylist()])
            yield part, pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(found))

    return _with(docs, text, ids, "array<int>", rows, lambda: Encoder(shared.value))


def decode(tokens: DataFrame, vocabulary: str = VOCABULARY, *, ids: str = "ids", text: str = "text") -> DataFrame:
    """``tokens`` with the text of ``ids`` as ``text``, in place of a column of that name.

    No ids or null make an empty text; null ids and ids that the vocabulary lacks are left out; bytes that are no
    UTF-8 become U+FFFD.
    """
    shared = tokens.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def rows(batch: pa.RecordBatch, column: str, decode_ids: Callable) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
        # A null id has no text, as an unknown one.
        for begin in range(0, batch.num_rows, 256):
            part = batch.slice(begin, 256)
            yield part, pa.array(map(decode_ids, read_ids(part.column(column))), pa.string())

    return _with(tokens, ids, text, "string", rows, lambda: decoder(shared.value))


def _with(frame: DataFrame, given: str, wanted: str, kind: str, rows: Callable, make: Callable) -> DataFrame:
    """``frame`` with ``wanted`` of type ``kind``, as ``rows`` gives it for parts of a batch, with what ``make`` makes once a task."""
    held, names = numbered(frame)
    column = names[given]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = make()
        for batch in batches:
            for part, found in rows(batch, column, made):
                yield pa.RecordBatch.from_arrays([*part.columns, found], [*part.schema.names, "_made"])

    schema = StructType([*held.schema.fields, StructField("_made", DataType.fromDDL(kind))])
    full = held.mapInArrow(run, schema).withColumnRenamed("_made", wanted)
    return named(full, names, wanted)

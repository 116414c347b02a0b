"""Benchmark passages in documents, found by winnowing.

Of every window of consecutive k-grams the last one of least hash is kept, in documents and items alike, so
that two texts that share enough consecutive words keep the same k-gram of them at the same place. Kept
k-grams are joined and each pair is extended word by word to what the two texts share around it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftgraph.llm import text as tx
from weftgraph.llm.columns import named, numbered
from weftgraph.operators.runtime import cut

WINDOW = 10
GRAM = 4
FILTER_BITS = 26
"""The filter of item k-grams is a bitmap of this fixed size, whatever the number of items."""
BROADCAST_ROWS = 100_000
"""Item k-grams up to this number are broadcast to the candidates, more are shuffled."""

BROADCAST_HITS = 500_000
"""Documents to leave out up to this number are broadcast, more are shuffled."""

_KEPT = "t int, pos int, key long, around array<long>"


def _lengths(words: int) -> tuple[int, int, int]:
    """k, the windows' k-grams, and the words kept around a k-gram, for shared runs of ``words`` words."""
    k = min(GRAM, words)
    return k, words - k + 1, 2 * words - k


def _winnow(hashed: np.ndarray, bounds: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the kept k-grams and their hashes; ``bounds`` are those of texts in the words."""
    k, window, _ = _lengths(words)
    n = len(hashed)
    if n < words:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        grams = tx.mix(grams + hashed[i : n - k + 1 + i]) + np.uint64(i)
    grams = tx.mix(grams + np.uint64(words))
    m = n - words + 1
    least, at = grams[:m].copy(), np.zeros(m, np.int64)
    for i in range(1, window):
        lower = grams[i : m + i] <= least
        least = np.where(lower, grams[i : m + i], least)
        at[lower] = i
    whole = np.ones(m, bool)
    for offset in range(1, words):
        cut = bounds[1:-1] - offset
        whole[cut[(cut >= 0) & (cut < m)]] = False
    kept = np.unique((np.arange(m) + at)[whole])
    return kept, grams[kept]


def _around(hashed: np.ndarray, bounds: np.ndarray, text: np.ndarray, kept: np.ndarray, words: int) -> np.ndarray:
    """Hashes of the words around each kept k-gram; zero beyond its text."""
    k, _, width = _lengths(words)
    index = kept[:, None] + np.arange(-(words - k), width - (words - k))[None, :]
    outside = (index < bounds[text][:, None]) | (index >= bounds[text + 1][:, None])
    index[outside] = 0
    found = hashed[index] if len(hashed) else np.zeros(index.shape, np.uint64)
    found[outside] = 0
    return found


def _kept_grams(column: pa.Array, classes: list[int], bitmap: np.ndarray | None):
    """Word counts of the texts and, for each class, the kept k-grams that pass the filter."""
    raw, ends = tx.utf8(column)
    raw = tx.lowered(raw)
    starts, stops = tx.spans(raw, ends, tx.ALNUM)
    hashed = tx.hashes(raw, starts, stops)
    counts = tx.counts_per_text(starts, ends)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    found = []
    for words in classes:
        kept, keys = _winnow(hashed, bounds, words)
        if bitmap is not None:
            slot = (keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            passed = (bitmap[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1
            kept, keys = kept[passed], keys[passed]
        text = np.searchsorted(bounds, kept, "right") - 1
        around = _around(hashed, bounds, text, kept, words)
        found.append((text, kept - bounds[text], keys, around))
    return counts, found


def _rows(batch: pa.RecordBatch, carried: list[str], text: np.ndarray, more: dict[str, pa.Array]) -> pa.RecordBatch:
    taken = batch.select(carried).take(pa.array(text))
    return pa.RecordBatch.from_arrays([*taken.columns, *more.values()], [*carried, *more])


def _lists(values: np.ndarray) -> pa.Array:
    flat = pa.array(values.reshape(-1).view(np.int64))
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]), flat)


def _gram_map(carried: list[str], classes: list[int], shared=None) -> Callable:
    """Rows of kept k-grams; with a filter also one row of each text, of class -1, that meets no item."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = None if shared is None else shared.value
        for whole in batches:
            for batch in tx.slices(whole, "_text"):
                counts, found = _kept_grams(batch.column("_text"), classes, bitmap)
                every = np.arange(batch.num_rows)
                if bitmap is not None:
                    own = tx.mix(batch.column("_text_key").to_numpy().view(np.uint64) + every.astype(np.uint64))
                    found = [(every, np.zeros_like(every), own, np.zeros((len(every), 1), np.uint64)), *found]
                for words, (text, pos, keys, around) in zip(
                    [-1, *classes] if bitmap is not None else classes, found, strict=True
                ):
                    more = {
                        "n_words": pa.array(counts[text].astype(np.int64)),
                        "t": pa.array(np.full(len(text), words, np.int32)),
                        "pos": pa.array(pos.astype(np.int32)),
                        "key": pa.array(keys.view(np.int64)),
                        "around": _lists(around),
                    }
                    yield _rows(batch, carried, text, more)

    return rows


def _item_grams(benchmark: DataFrame, item: str, text: str, window: int) -> tuple[DataFrame, list[int]]:
    """Kept k-grams of all items and the window lengths that occur: the full one and those of shorter items."""
    words = F.regexp_count(F.col(text), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    items = benchmark.select(
        F.col(item).cast("string").alias("_item"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
        F.least(words, F.lit(window)).alias("_length"),
    ).filter("_length > 0")
    classes = sorted(row[0] for row in items.select("_length").distinct().collect())
    schema = f"_item string, n_words long, {_KEPT}"
    found = None
    for length in classes:
        part = items.filter(F.col("_length") == length).mapInArrow(_gram_map(["_item"], [length]), schema)
        found = part if found is None else found.unionByName(part)
    return found, classes


def _bitmap(grams: DataFrame):
    """All item keys as one bitmap of fixed size, put together on the executors."""
    slot = F.shiftrightunsigned("_key", 64 - FILTER_BITS)
    words = (
        grams.select(F.shiftright(slot, 6).alias("word"), slot.bitwiseAND(F.lit(63)).cast("int").alias("_bit"))
        .select("word", F.expr("shiftleft(1L, _bit)").alias("bits"))
        .groupBy("word")
        .agg(F.bit_or("bits").alias("bits"))
        .toPandas()
    )
    bitmap = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    bitmap[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return bitmap


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    doc: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Words of each document that stand in a benchmark passage.

    A passage is ``window`` consecutive words of an item, or all words of a shorter item. Returns ``doc``,
    ``text_key`` (xxhash64 of the text), ``n_words``, ``n_hit``, ``item_ids`` (strings, sorted), ``spans``
    (word ranges, end exclusive, each within a run shared with an item).

    Rows of one id and text are one document; one id with several texts gives a row for each. Null and empty
    texts have no words and items without words have no windows. An item without an id marks words and is
    not listed; a null document id is a value like others. Other columns are ignored.
    """
    spark = docs.sparkSession
    carried = ["_doc", "_text_key"]
    source = docs.select(
        F.col(doc).alias("_doc"),
        F.xxhash64(F.col(text)).alias("_text_key"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"),
    )
    kind = source.schema["_doc"].dataType.simpleString()
    schema = f"_doc {kind}, _text_key long, n_words long, {_KEPT}"
    grams, classes = _item_grams(benchmark, item, item_text, window)
    if grams is None:
        grams = spark.createDataFrame([], f"_item string, n_words long, {_KEPT}")
    grams = cut(
        grams.select(
            "_item", F.col("t").alias("_t"), F.col("key").alias("_key"), F.col("around").alias("_around")
        ).distinct()
    )
    shared = spark.sparkContext.broadcast(_bitmap(grams))
    few = grams.limit(broadcast_rows + 1).count() <= broadcast_rows
    rows = source.mapInArrow(_gram_map(carried, classes, shared), schema)
    met = rows.join(
        F.broadcast(grams) if few else grams, F.expr("key = _key and t = _t"), "left"
    )
    same = F.array_join(
        F.zip_with("around", "_around", lambda a, b: F.when((a == b) & (a != 0), "1").otherwise("0")), ""
    )
    met = (
        met.withColumn("k", F.least(F.col("t"), F.lit(GRAM)))
        .withColumn("same", F.when(F.col("_key").isNotNull(), same))
        .withColumn("before", F.length(F.regexp_extract(F.expr("substr(same, 1, t - k)"), "1*$", 0)))
        .withColumn("after", F.length(F.regexp_extract(F.expr("substr(same, t + 1)"), "^1*", 0)))
        .withColumn("hit", F.expr("coalesce(substr(same, t - k + 1, k) = repeat('1', k) and before + k + after >= t, false)"))
    )
    span = F.struct(
        (F.col("pos") - F.col("before")).alias("begin"), (F.col("pos") + F.col("k") + F.col("after")).alias("end")
    )
    return (
        met.groupBy("_doc", "_text_key")
        .agg(
            F.first("n_words").alias("n_words"),
            F.array_sort(F.collect_set(F.when(F.col("hit"), F.col("_item")))).alias("item_ids"),
            F.array_sort(F.collect_set(F.when(F.col("hit"), span))).alias("spans"),
        )
        .select(
            F.col("_doc").alias(doc),
            F.col("_text_key").alias("text_key"),
            "n_words",
            F.expr(
                """aggregate(spans, struct(0 as reach, 0L as total), (a, s) -> struct(
                  greatest(a.reach, s.end) as reach,
                  a.total + greatest(0, s.end - greatest(a.reach, s.begin)) as total)).total"""
            ).alias("n_hit"),
            "item_ids",
            "spans",
        )
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, *, doc: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """The documents without those that hold a benchmark passage, with all their columns and repeated rows."""
    found = contamination(docs, benchmark, doc=doc, text=text, **options).filter("n_hit > 0")
    with tx.small_batches(docs.sparkSession):
        found = cut(found.select(F.col(doc).alias("_hit_doc"), F.col("text_key").alias("_hit_key")))
    if found.limit(BROADCAST_HITS + 1).count() <= BROADCAST_HITS:
        found = F.broadcast(found)
    plain, names = numbered(docs)
    same = F.col(names[doc]).eqNullSafe(F.col("_hit_doc")) & (F.xxhash64(names[text]) == F.col("_hit_key"))
    return named(plain.join(found, same, "left_anti"), names)

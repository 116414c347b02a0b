"""Repeated runs of lines, found by a suffix array over line ids.

Each document is a sequence of line ids, and its suffixes are ranked by prefix doubling: the rank of a run of
``2n`` lines is that of the pair of ranks of its halves. Only runs that occur again stay in, so a round works on
what is repeated. A run of at least ``min_words`` words that several suffixes begin with is an interval of the
suffix array whose longest common prefix is that long; the first of them in the order of the text is kept,
and the run is deleted from the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from weftgraph.llm import text as tx
from weftgraph.llm.columns import named, numbered
from weftgraph.operators.runtime import cut

MIN_WORDS = 50
BROADCAST_LINES = 1_000_000
"""Texts that change and lines that go, up to this number together, are broadcast; more are shuffled."""

_DOC = ["_doc", "_key"]


def _windows(words: np.ndarray, least: int) -> set[tuple[int, int]]:
    """Start and length of the shortest runs with ``least`` words that start or that end at each line.

    A line of any longer run of so many words is in one of these that lies within that run.
    """
    sums = np.concatenate([[0], np.cumsum(words)])
    n = len(words)
    ends = np.searchsorted(sums, sums[:-1] + least, "left")
    found = {(int(a), int(b - a)) for a, b in zip(np.arange(n), ends, strict=True) if b <= n}
    starts = np.searchsorted(sums, sums[1:] - least, "right") - 1
    return found | {(int(a), int(b - a)) for a, b in zip(starts, np.arange(1, n + 1), strict=True) if a >= 0}


def _line_rows(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """A row for each line with words: its id, its place, the lines up to the next one, windows that start there."""
    digest = xxhash.xxh3_128_intdigest
    half = (1 << 64) - 1
    for whole in batches:
        for batch in tx.slices(whole, "_text"):
            rows: list[int] = []
            units, high, low, first, after, windows = [], [], [], [], [], []
            for row, text in enumerate(batch.column("_text").to_pylist()):
                lines = text.split("\n")
                counts = [len(line.split()) for line in lines]
                full = [i for i, count in enumerate(counts) if count]
                starting: dict[int, list[int]] = {}
                for start, length in _windows(np.array([counts[i] for i in full], np.int64), least):
                    starting.setdefault(start, []).append(length)
                for unit, i in enumerate(full):
                    name = digest(lines[i].strip().encode())
                    rows.append(row)
                    units.append(unit)
                    high.append(name >> 64)
                    low.append(name & half)
                    first.append(i)
                    after.append(full[unit + 1] if unit + 1 < len(full) else len(lines))
                    windows.append(sorted(starting.get(unit, ())))
            taken = batch.select(_DOC).take(pa.array(rows, pa.int64()))
            signed = lambda values: pa.array(np.array(values, np.uint64).view(np.int64))
            ints = lambda values: pa.array(values, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, ints(units), signed(high), signed(low), ints(first), ints(after), pa.array(windows, pa.list_(pa.int32()))],
                [*_DOC, "unit", "high", "low", "first", "after", "windows"],
            )


def _ranks(rows: DataFrame, *by: str) -> DataFrame:
    """Those of ``rows`` that agree with another in ``by``, with a ``rank`` in the order of ``by``."""
    again = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    order = cut(again.orderBy(*by).withColumn("rank", F.monotonically_increasing_id()))
    return rows.join(order, list(by)).drop(*by)


def repeated_lines(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``_doc, _key, _lines``: the line numbers (from 0) to delete from each document that has any."""
    source = docs.select(F.col(doc).alias("_doc"), F.xxhash64(text).alias("_key"), F.coalesce(text, F.lit("")).alias("_text"))
    kind = source.schema["_doc"].dataType.simpleString()
    lines = source.mapInArrow(
        lambda batches: _line_rows(batches, min_words),
        f"_doc {kind}, _key long, unit int, high long, low long, first int, after int, windows array<int>",
    )
    # Null ids must meet in joins.
    lines = lines.withColumn("_none", F.col("_doc").isNull()).withColumn("_doc", F.coalesce("_doc", F.lit(0).cast(kind)))
    at = ["_none", *_DOC, "unit"]
    with tx.small_batches(docs.sparkSession):
        lines = cut(lines.dropDuplicates(at))
    names = ["high", "low"]
    level = cut(_ranks(lines.select(*at, *names, "windows"), *names))
    windows = level.select(*at, F.explode("windows").alias("length"))
    keyed, size = None, 1
    level = level.select(*at, "rank")
    while True:
        # Windows of size to 2 * size - 1 lines: the ranks at their start and size lines before their end.
        fitting = windows.filter(F.col("length").between(size, 2 * size - 1))
        heads = fitting.join(level, at).withColumnsRenamed({"rank": "head", "unit": "start"})
        heads = heads.withColumn("unit", F.col("start") + F.col("length") - size)
        found = heads.join(level.withColumnRenamed("rank", "tail"), at).select(*at[:-1], "start", "length", "head", "tail")
        keyed = found if keyed is None else keyed.unionByName(found)
        if 2 * size > min_words or level.isEmpty():
            break
        ahead = level.select(*at[:-1], (F.col("unit") - size).alias("unit"), F.col("rank").alias("tail"))
        pairs = level.withColumnRenamed("rank", "head").join(ahead, at)
        level = cut(_ranks(pairs, "head", "tail"))
        size *= 2
    keyed = cut(keyed)
    place = F.struct("_none", *_DOC, "start")
    same = ["length", "head", "tail"]
    firsts = cut(
        keyed.groupBy(*same).agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    )
    later = keyed.join(firsts, same).filter(place != F.col("_first"))
    units = later.select(*at[:-1], F.explode(F.expr("sequence(start, start + length - 1)")).alias("unit")).distinct()
    gone = lines.select(*at, "first", "after").join(units, at)
    gone = gone.select(*at[:-1], F.explode(F.expr("sequence(first, after - 1)")).alias("line"))
    return (
        gone.groupBy(*at[:-1])
        .agg(F.array_sort(F.collect_list("line")).alias("_lines"))
        .select(F.when(~F.col("_none"), F.col("_doc")).alias("_doc"), "_key", "_lines")
    )


def drop_repeated_lines(
    docs: DataFrame, *, doc: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, deleted: str | None = None
) -> DataFrame:
    """``docs`` without the later copies of runs of lines that have ``min_words`` words or more.

    Texts are read in order of ``doc`` (null last), then of a hash of the text. Lines end at line feeds and
    are equal if they are but for white space around them; lines without words go with the one before. What is deleted is
    each line of a run of consecutive lines, within one text, that stands earlier as well, in this text or another; the
    first copy of each line stays. Rows of one id and text are one text and are all changed alike. A text of which
    nothing is left is empty, null stays null, and no row is dropped. ``deleted`` names a column for the
    number of deleted lines.
    """

    @F.pandas_udf("string")
    def rest(texts: pd.Series, lines: pd.Series) -> pd.Series:
        kept = []
        for value, numbers in zip(texts, lines, strict=True):
            if numbers is not None:
                gone = set(numbers.tolist())
                value = "\n".join(line for i, line in enumerate(value.split("\n")) if i not in gone)
            kept.append(value)
        return pd.Series(kept, dtype=object)

    gone = cut(repeated_lines(docs, doc=doc, text=text, min_words=min_words)).withColumnsRenamed(
        {"_doc": "_gone_doc", "_key": "_gone_key"}
    )
    texts, lines = gone.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("_lines")), F.lit(0))).first()
    if texts + lines <= BROADCAST_LINES:
        # Texts stay where they are.
        gone = F.broadcast(gone)
    plain, names = numbered(docs)
    same = F.col(names[doc]).eqNullSafe(F.col("_gone_doc")) & (F.xxhash64(names[text]) == F.col("_gone_key"))
    joined = plain.join(gone, same, "left").withColumn(names[text], rest(F.col(names[text]), F.col("_lines")))
    if deleted is None:
        return named(joined, names)
    return named(joined.withColumn(deleted, F.coalesce(F.size("_lines"), F.lit(0))), names, deleted)

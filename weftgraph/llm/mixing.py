"""Sources mixed to target weights by weighted fair queueing.

Within a source documents are shuffled, and each copy of a document gets a virtual finish time: the source's
words up to its end over the source's target. A copy that is being served at time one is split at the last whole
word before it. All copies of all sources are then sorted by finish time, their words are summed in that order,
and what lies beyond the budget is cut off. This is done on ids and sizes; texts join the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from weftgraph.llm.columns import named, numbered
from weftgraph.operators.runtime import cut

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3

_WORD = r"[^\x20\x09-\x0D]+"


def ordered(frame: DataFrame, *order: Column) -> DataFrame:
    """``frame`` sorted into ranges, ``_part``, and numbered upward in that order, ``_at``; no task sees more than its range."""
    held = cut(frame.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    return held.withColumn("_part", F.shiftright("_at", 33))


def summed(frame: DataFrame, value: Column, *within: str) -> DataFrame:
    """``frame``, as ``ordered`` gives it, with the sum of ``value`` over all earlier rows as ``_before``.

    With ``within``, over those that agree in these columns. A range is summed by one task, the sums of ranges have
    one row for each range and value of ``within`` in it.
    """
    parts = frame.groupBy("_part", *within).agg(F.sum(value).alias("_sum"))
    spans = (Window.unboundedPreceding, -1)
    earlier = F.sum("_sum").over(Window.partitionBy(*within).orderBy("_part").rowsBetween(*spans))
    parts = parts.select("_part", *within, F.coalesce(earlier, F.lit(0)).alias("_offset"))
    inside = F.sum(value).over(Window.partitionBy("_part", *within).orderBy("_at").rowsBetween(*spans))
    same = [F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}")) for name in ("_part", *within)]
    joined = frame.withColumn("_inside", F.coalesce(inside, F.lit(0))).alias("l").join(parts.alias("r"), same)
    return joined.select("l.*", (F.col("_offset") + F.col("_inside")).alias("_before")).drop("_inside")


def ranked(frame: DataFrame, *order: Column) -> DataFrame:
    """``frame`` with its position in a global order, from 0, as ``rank``; no task sees more than its range."""
    return summed(ordered(frame, *order), F.lit(1)).withColumnRenamed("_before", "rank").drop("_at", "_part")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``_source, _source_size, _target`` for sources of ``_source, _source_size``.

    Sources take their weights in turn by code point, null last. The total of all sizes is shared by weight,
    no source gets more than ``most`` times its size, and what is above is shared again among the others
    until none is above.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    held = cut(
        ranked(sizes, F.col("_source").asc_nulls_last()).select(
            "_source", "_source_size", weight.alias("_weight"), (most * F.col("_source_size")).alias("_cap")
        )
    )
    total = held.agg(F.sum("_source_size")).first()[0] or 0
    share, capped = 0.0, -1
    while True:
        above = F.lit(share) * F.col("_weight") > F.col("_cap")
        rest = F.when(above, 0).otherwise(F.col("_weight"))
        row = held.agg(
            F.count_if(above).alias("n"), F.sum(F.when(above, F.col("_cap"))).alias("cap"), F.sum(rest).alias("weight")
        ).first()
        if row["n"] == capped or not row["weight"]:
            break
        capped, share = row["n"], (total - (row["cap"] or 0)) / row["weight"]
    fair = F.lit(share) * F.col("_weight")
    return held.select(
        "_source",
        "_source_size",
        F.when(fair > F.col("_cap"), F.col("_cap").cast("double")).otherwise(fair).alias("_target"),
    )


def queued(placed: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """The queue: ``_id, _pass, _begin, _words, _finish`` for each copy in each of ``most`` passes over its source.

    ``placed`` has ``_id, _source, _start, _words, _source_size, _target``: words of the source before, and in, each entry.
    A copy with words on both sides of virtual time one is two entries. Passes that begin after that time are
    not queued.
    """
    passes = placed.withColumn("_pass", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    passes = passes.withColumn("_begin", F.col("_pass") * F.col("_source_size") + F.col("_start"))
    first = F.greatest(F.lit(0), F.least("_words", F.floor("_target") - F.col("_begin"))).cast("long")
    pieces = F.array(
        F.struct("_begin", first.alias("_words")),
        F.struct((F.col("_begin") + first).alias("_begin"), (F.col("_words") - first).alias("_words")),
    )
    return (
        passes.filter("_words > 0 and _begin <= _target")
        .select("_id", "_source", "_pass", "_target", F.explode(pieces).alias("_piece"))
        .select("_id", "_source", "_pass", "_target", "_piece.*")
        .filter("_words > 0")
        .withColumn("_finish", (F.col("_begin") + F.col("_words")) / F.col("_target"))
    )


def served(queue: DataFrame, budget: int) -> DataFrame:
    """``queue`` in order of finish time, ties by source and begin, cut at ``budget`` words: what is left, as ``_kept``."""
    merged = summed(ordered(queue, F.col("_finish"), F.col("_source").asc_nulls_last(), F.col("_begin")), F.col("_words"))
    kept = F.least("_words", F.lit(budget) - F.col("_before")).cast("long")
    return merged.withColumn("_kept", kept).filter("_kept > 0")


def schedule(
    docs: DataFrame,
    *,
    doc: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: str = "mix",
) -> DataFrame:
    """All rows of ``docs`` with ``size`` (words), ``source_size``, ``target``, ``start`` and ``taken``.

    Columns of ``docs`` that have one of these names are replaced. ``start`` is how many of its source's words come
    before the document in each pass over the source, and ``taken`` how many of its words the mix takes, repeats
    counted. The budget is the sum of all targets in whole words. Order within a source follows a digest of ``seed`` and
    the document id, so that runs agree; rows of one id follow a hash of their texts, and rows that agree in id, text
    and source follow one another and are interchangeable. Null and empty texts have size 0 and are never taken; null is a
    source of its own. No rows give no rows.
    """
    plain, names = numbered(docs)
    planned = _schedule(plain, names[doc], names[text], names[source], weights, most, seed)
    taken = sum(F.col("_taken")[copy] for copy in range(most))
    added = ["size", "source_size", "target", "start", "taken"]
    planned = planned.withColumn("_taken", taken).withColumnsRenamed({f"_{x}": x for x in added})
    return named(planned, names, *added)


def _schedule(
    docs: DataFrame, doc: str, text: str, source: str, weights: tuple[int, ...], most: int, seed: str
) -> DataFrame:
    """``docs`` with ``_size, _source_size, _target, _start`` and ``_taken``, an array of the words taken in each pass."""
    same = ["_source", "_doc", "_tie"]
    keys = {"_source": F.col(source), "_doc": F.col(doc), "_tie": F.xxhash64(text)}
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(_WORD)), F.lit(0)).cast("long")
    # Rows that agree are one run of as many words as all of them have.
    runs = docs.select(*[value.alias(name) for name, value in keys.items()], size.alias("_size"))
    runs = runs.groupBy(*same).agg(F.first("_size").alias("_size"), F.count(F.lit(1)).alias("_rows"))
    runs = runs.withColumn("_words", F.col("_size") * F.col("_rows"))
    key = F.md5(F.concat(F.coalesce(F.col("_doc").cast("string"), F.lit("")), F.lit(f":{seed}")))
    line = ordered(runs, F.col("_source"), key, F.col("_doc"), F.col("_tie"))
    share = cut(targets(line.groupBy("_source").agg(F.sum("_words").alias("_source_size")), weights, most))
    placed = summed(line, F.col("_words"), "_source").withColumnsRenamed({"_at": "_id", "_before": "_start"})
    on = F.col("l._source").eqNullSafe(F.col("r._source"))
    placed = cut(placed.alias("l").join(share.alias("r"), on).select("l.*", "r._source_size", "r._target").drop("_part"))
    total = share.agg(F.sum(F.floor("_target"))).first()[0] or 0
    passes = [F.coalesce(F.sum(F.when(F.col("_pass") == copy, F.col("_kept"))), F.lit(0)) for copy in range(most)]
    kept = served(queued(placed, most), total).groupBy("_id").agg(F.array(*passes).alias("_run"))
    placed = cut(placed.join(kept, "_id", "left").drop("_id"))
    on = [F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}")) for name in same]
    full = docs.withColumns(keys | {"_from": F.spark_partition_id()}).alias("l").join(placed.alias("r"), on)
    full = full.select("l.*", *[f"r.{name}" for name in placed.columns if name not in same]).withColumn("_nth", F.lit(0))
    if not placed.filter("_rows > 1").isEmpty():
        full = _nth(full, same)
    done = F.col("_nth") * F.col("_size")
    row = F.transform("_run", lambda run: F.greatest(F.lit(0), F.least("_size", run - done)).cast("long"))
    none = F.array(*[F.lit(0).cast("long")] * most)
    return (
        full.withColumn("_start", F.col("_start") + done)
        .withColumn("_taken", F.coalesce(row, none))
        .drop(*same, "_from", "_rows", "_run", "_nth", "_words")
    )


def _nth(full: DataFrame, same: list[str]) -> DataFrame:
    """Rows with their number among those that agree, from 0, counted for each partition they come from."""
    again = cut(full.filter("_rows > 1").drop("_nth"))
    counts = again.groupBy(*same, "_from").agg(F.count(F.lit(1)).alias("_count"))
    earlier = Window.partitionBy(*same).orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_earlier", F.coalesce(F.sum("_count").over(earlier), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy(*same, "_from").orderBy("_tie")) - 1
    on = [F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}")) for name in (*same, "_from")]
    again = again.withColumn("_place", inside).alias("l").join(counts.alias("r"), on).select("l.*", "r._earlier")
    again = again.withColumn("_nth", F.col("_earlier") + F.col("_place")).drop("_earlier", "_place")
    return full.filter("_rows = 1").unionByName(again)


def mix(
    docs: DataFrame,
    *,
    doc: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: str = "mix",
) -> DataFrame:
    """The mixed corpus: copies of ``docs`` in mix order, with ``copy`` (from 0), ``taken`` and ``finish``.

    A copy that the budget cuts keeps its first ``taken`` words, joined by blanks. Columns of ``docs`` that have one of
    the added names are replaced. Order, ties, nulls and empty texts are as in ``schedule``.
    """
    plain, names = numbered(docs)
    body = names[text]
    planned = _schedule(plain, names[doc], body, names[source], weights, most, seed)
    copies = planned.select("*", F.posexplode("_taken").alias("copy", "taken")).filter("taken > 0")
    words = F.filter(F.split(F.col(body), r"[\x20\x09-\x0D]+"), lambda x: x != "")
    first = F.array_join(F.slice(words, F.lit(1), F.greatest(F.lit(1), F.col("taken")).cast("int")), " ")
    begin = F.col("copy") * F.col("_source_size") + F.col("_start")
    copies = copies.withColumn(
        body, F.when(F.col("taken") == F.col("_size"), F.col(body)).otherwise(first)
    ).withColumn("finish", (begin + F.col("taken")) / F.col("_target"))
    order = ["finish", names[doc]]
    return named(copies.repartitionByRange(*order).sortWithinPartitions(*order), names, "copy", "taken", "finish")

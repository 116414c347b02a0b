"""Near duplicates by SimHash and covering locality-sensitive hashing.

Each bit of a fingerprint has a non-zero label of ``distance + 1`` bits, and each non-zero vector of that
length is a table, whose mask keeps the bits with an odd product of label and vector. At most ``distance``
differing bits have labels that some vector is orthogonal to, so that every pair within the distance agrees
under one of the ``2 ** (distance + 1) - 1`` masks, each of which keeps about half of the bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from weftgraph.llm import text as tx
from weftgraph.llm.columns import named, numbered
from weftgraph.llm.components import components
from weftgraph.operators.runtime import cut

BITS = 64
SHINGLE = 4
DISTANCE = 4
SEED = 42
MOST_COMPARED = 256
"""Members of a bucket that are compared at once; those of larger buckets are in parts."""
PART = 4
BROADCAST_ROWS = 1_000_000
"""Documents to leave out up to this number are broadcast, by id and text key; more are shuffled."""

#: For each byte, its eight bits as the eight bytes of a word.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).copy().view(np.uint64).reshape(-1)
_LANE = 255


def _fingerprints(column: pa.Array, shingle: int, seed: int) -> np.ndarray:
    """A fingerprint for each text: bit by bit, the majority over its shingles' hashes."""
    digest = xxhash.xxh64_intdigest
    found: list[int] = []
    counts = np.zeros(len(column), np.int64)
    for row, text in enumerate(column):
        words = b" ".join((text.as_py() or "").encode().lower().split())
        if not words:
            continue
        gaps = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
        starts, ends = [0, *(gaps + 1).tolist()], [*gaps.tolist(), len(words)]
        starts, ends = starts[: max(1, len(starts) - shingle + 1)], ends[min(shingle, len(ends)) - 1 :]
        found += [digest(words[start:end], seed) for start, end in zip(starts, ends, strict=True)]
        counts[row] = len(starts)
    rows = np.flatnonzero(counts)
    result = np.zeros(len(column), np.uint64)
    if not len(rows):
        return result
    begins = np.cumsum(counts[rows]) - counts[rows]
    # Sums of at most 255 hashes at once fit the byte of a bit.
    blocks = -(-counts[rows] // _LANE)
    firsts = np.cumsum(blocks) - blocks
    inside = np.arange(blocks.sum()) - np.repeat(firsts, blocks)
    cuts = np.repeat(begins, blocks) + inside * _LANE
    spread = _SPREAD[np.array(found, ">u8").view(np.uint8).reshape(-1, 8)]
    lanes = np.add.reduceat(spread, cuts, axis=0).view(np.uint8).reshape(-1, BITS)
    ones = np.add.reduceat(lanes.astype(np.int64), firsts, axis=0)
    result[rows] = np.packbits(2 * ones > counts[rows][:, None], axis=1).view(">u8").reshape(-1)
    return result


def fingerprints(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", shingle: int = SHINGLE, seed: int = SEED):
    """``doc``, ``_text_key`` and ``_fingerprint`` (a long of the 64 bits) for each row.

    ASCII letters are lower-cased, words end at ASCII white space and shingles are joined by blanks; a text of
    fewer words is one shingle, and null or a text without words has fingerprint zero.
    """
    source = docs.select(F.col(doc).alias("_doc"), F.xxhash64(text).alias("_text_key"), F.col(text).alias("_text"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in tx.slices(whole, "_text"):
                made = pa.array(_fingerprints(batch.column("_text"), shingle, seed).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [*batch.select(["_doc", "_text_key"]).columns, made], ["_doc", "_text_key", "_fingerprint"]
                )

    kind = source.schema["_doc"].dataType.simpleString()
    return source.mapInArrow(rows, f"_doc {kind}, _text_key long, _fingerprint long")


def masks(distance: int) -> list[int]:
    """One mask for each table, as signed 64-bit values."""
    vectors = range(1, 1 << (distance + 1))
    labels = [bit % len(vectors) + 1 for bit in range(BITS)]
    found = [sum(1 << bit for bit in range(BITS) if (labels[bit] & vector).bit_count() % 2) for vector in vectors]
    return [mask - (1 << BITS) if mask >> (BITS - 1) else mask for mask in found]


def links(values: DataFrame, distance: int = DISTANCE, most_compared: int = MOST_COMPARED) -> DataFrame:
    """``(a, b)``: enough of the pairs of ``values(v)`` within ``distance`` bits to connect all that are linked.

    ``values`` are distinct. Two values within the distance share a bucket. In buckets of up to
    ``most_compared`` values all are compared and each group is hung on its smallest value. Larger ones are dealt
    to parts of ``PART`` times as many, and each two parts are compared in a task in the same way, so that no pair is lost. A bucket of
    n different values takes n squared comparisons, spread over tasks of bounded size, and no row for a pair that is not hung.
    """
    tables = F.explode(
        F.array(*[F.struct(F.lit(i).alias("_table"), F.col("v").bitwiseAND(F.lit(m)).alias("_masked")) for i, m in enumerate(masks(distance))])
    )
    held = values.select("v", tables.alias("_t")).select("v", "_t.*")
    key = ["_table", "_masked"]
    sizes = cut(held.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"))
    met = held.join(sizes, key)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, int]] = []
            for members in batch.column("members").to_pylist():
                found += _forest(np.array(members, np.int64), distance)
            a, b = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    small = (
        met.filter(F.col("_n") <= most_compared)
        .groupBy(*key)
        .agg(F.collect_list("v").alias("members"))
        .select("members")
        .mapInArrow(compared, "a long, b long")
    )
    if sizes.filter(F.col("_n") > most_compared).isEmpty():
        return small.distinct()
    # Parts of about even size, whatever the values are; every two of them meet in a task.
    parts = F.ceil(F.col("_n") / (PART * most_compared)).cast("int")
    dealt = met.filter(F.col("_n") > most_compared).withColumn("_parts", parts)
    dealt = dealt.withColumn("_part", F.pmod(F.xxhash64("v"), F.col("_parts")).cast("int"))
    lists = dealt.groupBy(*key, "_parts", "_part").agg(F.collect_list("v").alias("members"))
    other = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_other")
    sides = lists.select(*key, "_part", "members", other).select(
        *key, F.least("_part", "_other").alias("_low"), F.greatest("_part", "_other").alias("_high"), "members"
    )
    large = (
        sides.groupBy(*key, "_low", "_high")
        .agg(F.flatten(F.collect_list("members")).alias("members"))
        .select("members")
        .mapInArrow(compared, "a long, b long")
    )
    return small.unionByName(large).distinct()


def _forest(values: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Each value with the smallest one that it reaches over links within the bucket."""
    values = np.sort(values)
    near = np.bitwise_count((values[:, None] ^ values[None, :]).view(np.uint64)) <= distance
    left = near.sum(axis=1) > 1
    found: list[tuple[int, int]] = []
    for root in range(len(values)):
        if not left[root]:
            continue
        # Smaller values that are left over would have reached this one. Each row is looked at once.
        front = np.array([root])
        left[root] = False
        while len(front):
            front = np.flatnonzero(near[front].any(axis=0) & left)
            left[front] = False
            found += [(v, int(values[root])) for v in values[front].tolist()]
    return found


def near_groups(
    docs: DataFrame,
    *,
    doc: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    seed: int = SEED,
    most_compared: int = MOST_COMPARED,
) -> DataFrame:
    """Each row's ``doc``, ``_text_key``, ``_fingerprint``, ``_root`` (its group) and ``component_id``.

    Documents are linked when their fingerprints differ in at most ``distance`` bits; a group is what links
    connect, and ``component_id`` its smallest document id. Rows without an id belong to groups like others, and
    a group of such rows only has component null. Repeated rows are kept. Other columns are ignored.
    """
    with tx.small_batches(docs.sparkSession):
        rows = cut(fingerprints(docs, doc=doc, text=text, shingle=shingle, seed=seed))
    classes = cut(rows.groupBy(F.col("_fingerprint").alias("v")).agg(F.min("_doc").alias("_least")))
    found = components(links(classes.select("v"), distance, most_compared))
    rooted = classes.join(found, F.col("v") == F.col("id"), "left").select(
        "v", "_least", F.coalesce("root", "v").alias("_root")
    )
    named = rooted.filter("v = _root or _least is not null").groupBy("_root").agg(F.min("_least").alias("component_id"))
    groups = cut(rooted.select("v", "_root").join(cut(named), "_root"))
    joined = rows.join(groups, rows["_fingerprint"] == groups["v"])
    return joined.select(F.col("_doc").alias(doc), "_text_key", "_fingerprint", "_root", "component_id")


def drop_near_duplicates(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each group, that of the smallest id and text key, with all columns of ``docs``."""
    groups = near_groups(docs, doc=doc, text=text, **options)
    chosen = F.min(F.struct(F.col(doc).isNull().alias("none"), F.col(doc).alias("id"), F.col("_text_key").alias("key")))
    kept = groups.groupBy("_root").agg(chosen.alias("_kept")).select(
        F.col("_kept.id").alias("_kept_doc"), F.col("_kept.key").alias("_kept_key")
    )
    kept = cut(kept.distinct())
    plain, names = numbered(docs)
    keyed = plain.withColumn("_key", F.xxhash64(names[text]))
    chosen = F.col(names[doc]).eqNullSafe(F.col("_kept_doc")) & (F.col("_key") == F.col("_kept_key"))
    # Chosen on ids and keys alone, so that texts stay where they are unless very many go or one is there twice.
    each = groups.groupBy(F.col(doc).alias("_gone_doc"), F.col("_text_key").alias("_gone_key")).agg(F.count(F.lit(1)).alias("_n"))
    one = F.col("_gone_doc").eqNullSafe(F.col("_kept_doc")) & (F.col("_gone_key") == F.col("_kept_key"))
    told = cut(each.join(kept, one, "left").withColumn("_goes", F.col("_kept_key").isNull()).filter("_goes or _n > 1"))
    going, twice = told.agg(F.count_if("_goes"), F.count_if(~F.col("_goes"))).first()
    if going <= BROADCAST_ROWS and not twice:
        gone = F.broadcast(told.select("_gone_doc", "_gone_key"))
        same = F.col(names[doc]).eqNullSafe(F.col("_gone_doc")) & (F.col("_key") == F.col("_gone_key"))
        return named(keyed.join(gone, same, "left_anti"), names)
    return named(keyed.join(kept, chosen, "left_semi").dropDuplicates([names[doc], "_key"]), names)

"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

A rotation learnt from a sample turns each vector into a balanced binary code. A code is cut into substrings with a
table each; a vector looks up its own substring and those one bit away, and what it finds there is compared by
cosine of the original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from weftgraph.llm.components import components
from weftgraph.operators.runtime import cut

LEAST_COSINE = 0.93
MOST_BITS = 64
SAMPLE_VALUES = 1_500_000
"""Components of the vectors that the rotation is learnt from, at most."""
SUBSTRING_BITS = (8, 16)
"""A substring has about as many bits as name the vectors of a label, between these."""
MOST_DIFFERENT = 0.4
"""Share of its bits in which a candidate's code may differ before it is compared."""


def rotation(sample: np.ndarray, bits: int, rounds: int = 50, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection for codes of ``bits`` bits: principal axes, turned so that signs lose least."""
    mean = sample.mean(axis=0)
    _, axes = np.linalg.eigh(np.cov((sample - mean).T).reshape(sample.shape[1], -1))
    axes = axes[:, ::-1][:, :bits]
    turned = (sample - mean) @ axes
    turn, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))
    for _ in range(rounds):
        u, _, v = np.linalg.svd(np.where(turned @ turn > 0, 1.0, -1.0).T @ turned)
        turn = (u @ v).T
    return mean, axes @ turn


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _units(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _coded(classes: DataFrame, size: int, mean: np.ndarray, axes: np.ndarray) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.zeros(batch.num_rows, np.uint64)
            if batch.num_rows:
                for bit, signs in enumerate(((_units(_matrix(batch.column("_vector"), size)) - mean) @ axes > 0).T):
                    codes |= signs.astype(np.uint64) << np.uint64(bit)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_class"), batch.column("_label"), pa.array(codes.view(np.int64))], ["_class", "_label", "code"]
            )

    kind = classes.schema["_label"].dataType.simpleString()
    return classes.select("_class", "_label", "_vector").mapInArrow(rows, f"_class long, _label {kind}, code long")


def _candidates(codes: DataFrame, bits: int, length: int) -> DataFrame:
    """``(a, b)``, a < b, of one label with substrings at most one bit apart, each pair once."""
    tables = max(1, bits // length)
    ones = (1 << length) - 1

    def part(code: Column, table: int) -> Column:
        return F.shiftrightunsigned(code, table * length).bitwiseAND(F.lit(ones))

    numbered = [(F.lit(t).alias("table"), part(F.col("code"), t)) for t in range(tables)]
    index = codes.select(
        F.col("_class").alias("b"),
        F.col("_label"),
        F.col("code").alias("code_b"),
        F.inline(F.array(*[F.struct(t, x.alias("value")) for t, x in numbered])),
    )
    near = [F.struct(t, x.bitwiseXOR(F.lit(flip)).alias("value")) for t, x in numbered for flip in (0, *(1 << i for i in range(length)))]
    asked = codes.select(F.col("_class").alias("a"), F.col("_label"), F.col("code").alias("code_a"), F.inline(F.array(*near)))
    apart = lambda t: F.bit_count(part(F.col("code_a").bitwiseXOR(F.col("code_b")), t))
    # A pair that meets in several tables counts in the first.
    first = [(F.col("l.table") <= t) | (apart(t) > 1) for t in range(tables - 1)]
    same = [F.col(f"l.{x}") == F.col(f"r.{x}") for x in ("_label", "table", "value")]
    close = F.bit_count(F.col("code_a").bitwiseXOR(F.col("code_b"))) <= math.ceil(MOST_DIFFERENT * bits)
    return (
        asked.alias("l")
        .join(index.alias("r"), reduce(Column.__and__, [*same, F.col("a") < F.col("b"), close, *first]))
        .select("a", "b")
    )


def _links(classes: DataFrame, size: int, least: float) -> DataFrame:
    """``(a, b, times_a, times_b)``: classes of vectors of ``size`` components whose cosine is at least ``least``."""
    held = classes.filter(F.size("_vector") == size)
    largest, total = held.groupBy("_label").count().agg(F.max("count"), F.sum("count")).first()
    wanted = max(2, SAMPLE_VALUES // size)
    chosen = F.pmod(F.xxhash64("_vector"), F.lit(1 << 30)) < F.lit(int(min(1.0, wanted / total) * (1 << 30)))
    sample = np.array([row[0] for row in held.filter(chosen).select("_vector").collect()], np.float64).reshape(-1, size)
    if len(sample) < 2:
        sample = np.array([row[0] for row in held.select("_vector").limit(2).collect()], np.float64).reshape(-1, size)
    bits = min(MOST_BITS, size)
    length = min(max(SUBSTRING_BITS[0], math.ceil(math.log2(max(2, largest)))), SUBSTRING_BITS[1], bits)
    mean, axes = rotation(_units(sample), bits) if len(sample) > 1 else (np.zeros(size), np.eye(size, bits))
    pairs = _candidates(_coded(held, size, mean, axes), bits, length)
    side = lambda x: held.select(F.col("_class").alias(x), F.col("_vector").alias(f"v{x}"), F.col("_times").alias(f"times_{x}"))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "times_a", "times_b"]
        for batch in batches:
            if batch.num_rows:
                a, b = (_units(_matrix(batch.column(x), size)) for x in ("va", "vb"))
                near = pa.array((a * b).sum(axis=1) >= least)
                yield batch.select(names).filter(near)

    return (
        pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(compared, "a long, b long, times_a long, times_b long")
    )


def near_vectors(
    vectors: DataFrame,
    *,
    vec: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    least: float = LEAST_COSINE,
) -> DataFrame:
    """``vec, n_links, component_id, kept`` for each row.

    Vectors are linked when labels are equal and not null and their cosine, in double precision, is at least ``least``
    and tables bring them together. Equal vectors of a label are one class, linked with one another and each with all that the class
    is linked with; repeated rows count each. ``component_id`` is the smallest id that links reach, ``kept`` whether
    it is the row's own. Vectors that are null, empty, zero or hold null or non-finite components, or without
    a label, link with nothing, and vectors of different lengths don't link. Other columns are ignored.
    """
    value = F.col("_vector")
    fine = F.coalesce(
        F.col("_label").isNotNull()
        & (F.size(value) > 0)
        & F.forall(value, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
        & F.exists(value, lambda x: x != 0),
        F.lit(False),
    )
    rows = vectors.select(F.col(vec).alias("_vec"), F.col(label).alias("_label"), F.col(embedding).alias("_vector"))
    rows = rows.withColumn("_fine", fine)
    classes = cut(
        rows.filter("_fine")
        .groupBy("_label", "_vector")
        .agg(F.min("_vec").alias("_least"), F.count(F.lit(1)).alias("_times"))
        .withColumn("_class", F.monotonically_increasing_id())
    )
    sizes = sorted(row[0] for row in classes.select(F.size("_vector")).distinct().collect())
    empty = vectors.sparkSession.createDataFrame([], "a long, b long, times_a long, times_b long")
    links = cut(reduce(DataFrame.unionByName, [_links(classes, size, least) for size in sizes], empty))
    both = links.select(F.col("a").alias("_class"), F.col("times_b").alias("n")).unionByName(
        links.select(F.col("b").alias("_class"), F.col("times_a").alias("n"))
    )
    found = components(links.select("a", "b"))
    rooted = cut(
        classes.join(both.groupBy("_class").agg(F.sum("n").alias("_others")), "_class", "left")
        .join(found, F.col("_class") == F.col("id"), "left")
        .withColumn("_root", F.coalesce("root", "_class"))
    )
    named = cut(rooted.groupBy("_root").agg(F.min("_least").alias("_component")))
    told = cut(
        rooted.join(named, "_root").select(
            F.col("_label").alias("_l"),
            F.col("_vector").alias("_v"),
            (F.coalesce("_others", F.lit(0)) + F.col("_times") - 1).alias("_n"),
            "_component",
        )
    )
    joined = rows.join(told, F.col("_fine") & (F.col("_label") == F.col("_l")) & (F.col("_vector") == F.col("_v")), "left")
    component = F.when(F.col("_v").isNull(), F.col("_vec")).otherwise(F.col("_component"))
    return joined.select(
        F.col("_vec").alias(vec),
        F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("_vec").eqNullSafe(component).alias("kept"),
    )

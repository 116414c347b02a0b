"""Hard negatives by Kronecker-packed products: exact integer inner products, several to a multiplication.

Components are whole numbers. Made non-negative by a bias, those of several candidates stand side by side in fields of
one wide integer, wide enough that sums of products never run over. One multiplication by an anchor's component, and
one addition, then serve all of them; the scores are cut out of the sums and the bias is taken off. The wide integers
are whole doubles of up to 53 bits, so that matrix products do the work, and Python integers of any size where
components are too large for that.

Anchors and candidates are cut into blocks of bounded size, and each pair of blocks is one group of a grid.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from weftgraph.operators.runtime import cut

SCALE = 256
POSITIVES = NEGATIVES = 5
LOWEST, HIGHEST = 80, 100
"""Hundredths of the positive's score that a hard negative's score lies between."""
BLOCK_ROWS = 65_536
"""Rows in a block of anchors or candidates, about."""
TILE = 1 << 21
"""Scores held at once in a task."""
EXACT_BITS = 53
_LONG = (1 << 63) - 1


def packed_products(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """The inner product of each anchor (row) with each candidate (column), both of whole doubles, exactly.

    Products beyond the range of a long are cut to its ends.
    """
    count, size = candidates.shape
    bias = max((float(np.abs(x).max()) for x in (anchors, candidates) if x.size), default=0.0)
    width = max(1, (size * (2 * int(bias)) ** 2).bit_length())
    if width > EXACT_BITS:
        return _wide_products(anchors, candidates, int(bias), width)
    fields = EXACT_BITS // width
    each = -(-count // fields)
    packed = np.zeros((each, size))
    for field in range(fields):
        some = candidates[field * each : (field + 1) * each]
        packed[: len(some)] += (some + bias) * float(1 << field * width)
    sums = ((anchors + bias) @ packed.T).astype(np.int64)
    scores = np.empty((len(anchors), fields * each), np.int64)
    for field in range(fields):
        np.bitwise_and(sums >> field * width, (1 << width) - 1, out=scores[:, field * each : (field + 1) * each])
    scores = scores[:, :count]
    whole = int(bias)
    scores -= whole * (anchors.sum(axis=1).astype(np.int64) + size * whole)[:, None]
    scores -= whole * candidates.sum(axis=1).astype(np.int64)
    return scores


def _wide_products(anchors: np.ndarray, candidates: np.ndarray, bias: int, width: int) -> np.ndarray:
    """The same with all candidates in one Python integer for each component."""
    room = -(-width // 8)
    whole = [[int(x) for x in row] for row in candidates]
    packed = [int.from_bytes(b"".join((x + bias).to_bytes(room, "little") for x in column), "little") for column in zip(*whole, strict=True)]
    taken = [bias * sum(row) for row in whole]
    scores = np.empty((len(anchors), len(candidates)), np.int64)
    for i, anchor in enumerate(anchors):
        own = [int(x) for x in anchor]
        sums = sum((x + bias) * wide for x, wide in zip(own, packed, strict=True)).to_bytes(room * len(candidates), "little")
        less = bias * (sum(own) + len(own) * bias)
        for k, more in enumerate(taken):
            score = int.from_bytes(sums[k * room : (k + 1) * room], "little") - less - more
            scores[i, k] = min(max(score, -_LONG - 1), _LONG)
    return scores


class Best:
    """The best ``keep`` of scored candidates for each of some askers: higher scores first, then earlier candidates."""

    def __init__(self, askers: int, keep: int):
        self._keep = keep
        self.asker = self.place = self.score = np.zeros(0, np.int64)
        self.floor = np.full(askers, -_LONG - 1)
        """A later candidate must score more than this to be kept."""

    def add(self, asker: np.ndarray, place: np.ndarray, score: np.ndarray) -> None:
        asker, place, score = (np.concatenate(x) for x in ((self.asker, asker), (self.place, place), (self.score, score)))
        # ~x turns the order around without an overflow.
        order = np.lexsort((place, ~score, asker))
        asker, place, score = asker[order], place[order], score[order]
        rank = np.arange(len(asker)) - np.searchsorted(asker, asker)
        self.asker, self.place, self.score = (x[rank < self._keep] for x in (asker, place, score))
        full = rank == self._keep - 1
        self.floor[asker[full]] = score[full]


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(values * SCALE).reshape(len(column), size)


def _tiles(anchors: pa.Table, candidates: pa.Table, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Scores of all anchors with some candidates after the other; few at first, to learn what is out of reach."""
    left, right = _matrix(anchors["vector"], size), _matrix(candidates["vector"], size)
    begin, most = 0, max(1, TILE // max(1, len(left)))
    step = min(most, 512)
    while begin < len(right):
        yield begin, packed_products(left, right[begin : begin + step])
        begin, step = begin + step, most


def _numbers(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(np.int64)


def _sorted(candidates: pa.Table) -> pa.Table:
    return candidates.sort_by([("id", "ascending"), ("row", "ascending")])


def _positives(key: tuple, anchors: pa.Table, candidates: pa.Table, keep: int) -> pa.Table:
    """The best candidates of the anchors' label; an anchor is not its own."""
    candidates = _sorted(candidates)
    own, rows = _numbers(anchors["row"]), _numbers(candidates["row"])
    best = Best(len(own), keep)
    if len(own):
        for begin, scores in _tiles(anchors, candidates, key[0].as_py()):
            some = rows[begin : begin + scores.shape[1]]
            fits = (scores > best.floor[:, None]) | (best.floor[:, None] == -_LONG - 1)
            asker, place = np.nonzero(fits & (own[:, None] != some))
            best.add(asker, place + begin, scores[asker, place])
    found = candidates.take(pa.array(best.place))
    return pa.table(
        {"anchor": own[best.asker], "positive": found["row"], "positive_id": found["id"], "score": best.score},
        pa.schema([("anchor", pa.int64()), ("positive", pa.int64()), ("positive_id", pa.int64()), ("score", pa.int64())]),
    )


def _negatives(key: tuple, anchors: pa.Table, candidates: pa.Table, keep: int, lowest: int, highest: int) -> pa.Table:
    """For each positive of each anchor the best candidates of other labels in the range that its score sets."""
    candidates = _sorted(candidates)
    listed = anchors["positives"].combine_chunks()
    count = np.diff(listed.offsets.to_numpy())
    owner, starts = np.repeat(np.arange(len(count)), count), np.cumsum(count) - count
    positive, positive_id, wanted = (_numbers(x) for x in listed.flatten().flatten())
    # The range in whole scores, by Python's integers, which can't run over.
    low = np.array([max(-_LONG - 1, -(-lowest * x // 100)) for x in wanted.tolist()], np.int64)
    high = np.array([min(_LONG, highest * x // 100) for x in wanted.tolist()], np.int64)
    mine, theirs = _numbers(anchors["label"]), _numbers(candidates["label"])
    best = Best(len(owner), keep)
    if len(owner):
        for begin, scores in _tiles(anchors, candidates, key[0].as_py()):
            least = np.maximum(low, np.where(best.floor > -_LONG - 1, np.minimum(best.floor, _LONG - 1) + 1, low))
            ends = np.full((2, len(mine)), _LONG)
            open_ = least <= high
            np.minimum.at(ends[0], owner[open_], least[open_])
            ends[1] = -_LONG - 1
            np.maximum.at(ends[1], owner[open_], high[open_])
            fits = (scores >= ends[0][:, None]) & (scores <= ends[1][:, None])
            anchor, place = np.nonzero(fits & (mine[:, None] != theirs[begin : begin + scores.shape[1]]))
            score = scores[anchor, place]
            for nth in range(count.max()):
                has = count[anchor] > nth
                asker = starts[anchor[has]] + nth
                inside = (score[has] >= least[asker]) & (score[has] <= high[asker])
                best.add(asker[inside], place[has][inside] + begin, score[has][inside])
    found = candidates.take(pa.array(best.place))
    return pa.table(
        {
            "anchor": _numbers(anchors["row"])[owner[best.asker]],
            "anchor_id": _numbers(anchors["id"])[owner[best.asker]],
            "positive": positive[best.asker],
            "positive_id": positive_id[best.asker],
            "positive_score": wanted[best.asker],
            "negative": found["row"],
            "negative_id": found["id"],
            "negative_score": best.score,
        },
        pa.schema([(name, pa.int64()) for name in _FOUND]),
    )


_FOUND = ("anchor", "anchor_id", "positive", "positive_id", "positive_score", "negative", "negative_id", "negative_score")


def _first(found: DataFrame, keep: int, by: tuple[str, ...], *order: Column) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return found.withColumn("rank", place).filter(F.col("rank") <= keep)


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    *,
    vec: str = "vec_id",
    embedding: str = "embedding",
    label: str | Column = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows where ``anchor`` holds.

    A component x counts as floor(256 x), and a score is the inner product of such vectors. An anchor's positives are
    its best ``positives`` other rows of the same label, a positive's negatives the best ``negatives`` rows of
    other labels whose score lies between ``lowest`` and ``highest`` hundredths of the positive's. Higher scores come first, then
    smaller ids. All rows are candidates, repeated ones too, an anchor's own copies among them.

    Rows without an id or a label, with a null vector or with null or non-finite components take no part. Only vectors
    of one length are compared; empty ones have the score 0 with one another. Anchors without positives or positives
    without such negatives return no row. Other columns are ignored. Scores beyond the range of a long are cut to its ends.
    """
    value = F.col("vector")
    fine = F.forall(value, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    given = vectors.select(
        F.col(vec).cast("long").alias("id"),
        (F.col(label) if isinstance(label, str) else label).alias("label"),
        F.col(embedding).alias("vector"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    )
    given = given.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & value.isNotNull() & fine)
    # Labels are compared by their hash in tasks and by themselves in groups.
    rows = cut(given.withColumn("row", F.monotonically_increasing_id()).withColumn("size", F.size("vector")))
    total, asking = rows.agg(F.count(F.lit(1)), F.count_if("anchor")).first()
    if not asking:
        return rows.sparkSession.createDataFrame([], RESULT)
    across = max(-(-total // BLOCK_ROWS), min(rows.sparkSession.sparkContext.defaultParallelism, -(-total // 1024)))
    down = -(-asking // BLOCK_ROWS)
    dealt = lambda parts: F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    plain = rows.select("row", "id", "label", "vector", "size", "anchor")
    candidates = plain.drop("anchor").withColumn("across", dealt(across)).withColumn("down", every(down))
    anchors = plain.filter("anchor").drop("anchor").withColumn("down", dealt(down))
    grid = ("size", "across", "down")

    def spread(asking: DataFrame) -> DataFrame:
        """Askers for each block of candidates, as columns of their own, not those of the candidates."""
        full = asking.withColumn("across", every(across))
        return full.select(*[F.col(name).alias(name) for name in full.columns])

    first = spread(anchors).groupBy("size", "label", "across", "down")
    near = first.cogroup(candidates.groupBy("size", "label", "across", "down")).applyInArrow(
        lambda key, left, right: _positives(key, left, right, positives),
        "anchor long, positive long, positive_id long, score long",
    )
    chosen = _first(near, positives, ("anchor",), F.col("score").desc(), F.col("positive_id"), F.col("positive"))
    listed = chosen.withColumnRenamed("anchor", "asker").groupBy("asker").agg(F.collect_list(F.struct("positive", "positive_id", "score")).alias("positives"))
    asked = anchors.join(listed, F.col("row") == F.col("asker")).drop("asker")
    number = lambda frame: frame.withColumn("label", F.xxhash64("label"))
    second = spread(number(asked)).groupBy(*grid)
    found = second.cogroup(number(candidates).groupBy(*grid)).applyInArrow(
        lambda key, left, right: _negatives(key, left, right, negatives, lowest, highest),
        ", ".join(f"{name} long" for name in _FOUND),
    )
    by = ("anchor", "positive")
    best = _first(found, negatives, by, F.col("negative_score").desc(), F.col("negative_id"), F.col("negative"))
    return best.select(*RESULT_COLUMNS)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
RESULT_COLUMNS = [part.split()[0] for part in RESULT.split(", ")]

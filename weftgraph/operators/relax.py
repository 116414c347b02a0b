"""Distances from one vertex, by rounds that cost what changes in them.

Vertices lie in blocks, and a round runs the blocks that distances have come to. A block's task relaxes edges until
nothing changes within the block, so a long path takes a round for each block on it and not for each edge.
Distances for other blocks are messages. Only distances below a bound send, and only over light edges; when nothing
below the bound is left, heavy edges of what has settled follow, and the bound rises (delta-stepping). The step grows
while rounds find little to do.

State is a base and deltas. A round writes the rows it has changed, for each block apart. Of the rows of a vertex the least
values hold, so reading is a minimum; after ``FOLD_ROUNDS`` deltas a block's next one has all its rows and replaces
them. Everything is written to the checkpoint folder and what no later round reads is deleted.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from weftgraph.operators import runtime
from weftgraph.operators.blocks import Blocks, block_column, blocks_of
from weftgraph.operators.runtime import checkpoint_dir, cut, delete, exists

runtime.travels(__name__)

FOLD_ROUNDS = 10
SMALL_SHARE, SMALL_EDGES = 0.01, 200_000
"""A round that relaxes less than this share of the edges, or fewer than so many, makes the next step wider."""
WIDER = 4

STATE, MESSAGE, STATUS, HOT = range(4)
# value: distance; light, heavy: the distance that was last sent over such edges; target: a message's block.
_ROW = "kind int, block int, target int, id long, value double, light double, heavy double"
_ARROW = pa.schema(
    [("kind", pa.int32()), ("block", pa.int32()), ("target", pa.int32()), ("id", pa.int64())]
    + [(name, pa.float64()) for name in ("value", "light", "heavy")]
)
_INF = float("inf")


@dataclass
class Work:
    """What a search has done: a row for each round of it."""

    rounds: list[dict] = field(default_factory=list)

    @property
    def relaxed(self) -> int:
        return sum(r["relaxed"] for r in self.rounds)


@dataclass(frozen=True)
class Step:
    """What the blocks' tasks of a round need to know."""

    bound: float
    limit: float
    delta: float
    heavy: bool
    folded: frozenset[int]
    bounds: np.ndarray
    hot: np.ndarray


class _Csr:
    """Edges by the place of their source."""

    def __init__(self, places: np.ndarray, count: int):
        self.begin = np.searchsorted(places, np.arange(count))
        self.size = np.searchsorted(places, np.arange(count), "right") - self.begin

    def edges(self, sources: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The edges of some sources, and for each the position of its source among them."""
        size = self.size[sources]
        ends = np.cumsum(size)
        owner = np.repeat(np.arange(len(sources)), size)
        return np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begin[sources] - ends + size, size), owner


def relax_block(block: int, state: pa.Table, edges: pa.Table, step: Step) -> pa.Table:
    """One round of a block: rows it has changed, messages to other blocks, and a status row."""
    if not state.num_rows:
        return _ARROW.empty_table()
    src, dst = edges["src"].to_numpy(), edges["dst"].to_numpy()
    weight = edges["weight"].to_numpy() if "weight" in edges.column_names else np.ones(len(src))
    inside = blocks_of(step.bounds, dst) == block
    ids = np.unique(np.concatenate([state["id"].to_numpy(), src, dst[inside]]))
    n = len(ids)
    at = np.searchsorted(ids, state["id"].to_numpy())
    columns = {name: np.full(n, _INF) for name in ("value", "stored", "light", "heavy")}
    for name, column in columns.items():
        column[at] = state[name].to_numpy()
    value, stored, light, heavy = columns.values()
    was_light, was_heavy = light.copy(), heavy.copy()
    # Of an edge of an undefined or infinite weight nothing comes.
    places = np.searchsorted(ids, src)
    kinds = []
    for chosen in (weight <= step.delta, (weight > step.delta) & (weight < _INF)):
        order = np.flatnonzero(chosen)
        order = order[np.argsort(places[order], kind="stable")]
        kinds.append((_Csr(places[order], n), order))
    (light_of, light_edges), (heavy_of, heavy_edges) = kinds
    hot = np.isin(ids, step.hot)
    sent: list[tuple[np.ndarray, np.ndarray]] = []
    relaxed = 0

    def follow(sources: np.ndarray, of: _Csr, order: np.ndarray) -> np.ndarray:
        """Relax the edges of ``sources``; the vertices of this block that come nearer."""
        nonlocal relaxed
        found, owner = of.edges(sources)
        found = order[found]
        new = value[sources][owner] + weight[found]
        relaxed += len(found)
        fits = new <= step.limit
        fits &= new < _INF
        near = inside[found] & fits
        far = fits & ~near
        if far.any():
            sent.append((dst[found[far]], new[far]))
        to, new = np.searchsorted(ids, dst[found[near]]), new[near]
        better = new < value[to]
        np.minimum.at(value, to[better], new[better])
        return np.unique(to[better])

    def settle(front: np.ndarray) -> None:
        while len(front := front[(value[front] < light[front]) & (value[front] < step.bound) & ~hot[front]]):
            light[front] = value[front]
            front = follow(front, light_of, light_edges)

    settle(np.flatnonzero(value < light))
    if step.heavy:
        front = np.flatnonzero((value < heavy) & (value < step.bound))
        heavy[front] = value[front]
        settle(follow(front, heavy_of, heavy_edges))
    # Vertices without such edges have nothing to send; those of a hot vertex are sent by many tasks.
    ready = hot & (value < light) & (value < step.bound)
    heavy[hot] = np.where(ready, value, heavy)[hot]
    light[ready] = value[ready]
    # What is light may be another matter in the next step, so only vertices without any edges wait for none.
    for column, none in ((light, light_of.size + heavy_of.size == 0), (heavy, (heavy_of.size == 0) & (value < step.bound))):
        idle = (none | (light_of.size + heavy_of.size == 0)) & ~hot & (value < column)
        column[idle] = value[idle]
    changed = (value < stored) | (light < was_light) | (heavy < was_heavy)
    if block in step.folded:
        changed = value < _INF
    parts = [_rows(STATE, block, -1, ids[changed], value[changed], light[changed], heavy[changed])]
    if sent:
        to, new = (np.concatenate(x) for x in zip(*sent, strict=True))
        order = np.lexsort((new, to))
        to, new = to[order], new[order]
        first = np.ones(len(to), bool)
        first[1:] = to[1:] != to[:-1]
        to, new = to[first], new[first]
        parts.append(_rows(MESSAGE, block, blocks_of(step.bounds, to), to, new, _INF, _INF))
    parts.append(_rows(HOT, block, -1, ids[ready], value[ready], _INF, _INF))
    waits = [np.min(value, where=value < column, initial=_INF) for column in (light, np.where(hot, -_INF, heavy))]
    parts.append(_rows(STATUS, block, int(changed.sum()), np.array([relaxed]), _INF, *waits))
    return pa.concat_tables(parts)


def _rows(kind: int, block: int, target, ids: np.ndarray, value, light, heavy) -> pa.Table:
    full = lambda x, kind: pa.array(np.broadcast_to(np.asarray(x), len(ids)).astype(kind))
    columns = [full(kind, np.int32), full(block, np.int32), full(target, np.int32), pa.array(ids)]
    return pa.Table.from_arrays([*columns, *(full(x, np.float64) for x in (value, light, heavy))], schema=_ARROW)


def distances(blocks: Blocks, reached: DataFrame, *, limit: float | None = None, work: Work | None = None) -> DataFrame:
    """``(id, value)`` of each vertex that paths from those ``reached(id, value, fresh)`` lead to: the least value and sum of weights.

    Values above ``limit`` don't count. No weight may be negative. What is not ``fresh`` has been sent over its edges already.
    Rounds are told in ``work``.
    """
    spark = blocks.edges.sparkSession
    search = _Search(spark, blocks, f"{checkpoint_dir(spark)}/distances-{uuid.uuid4().hex}", _INF if limit is None else float(limit))
    try:
        search.run(reached, Work() if work is None else work)
        return search.result()
    finally:
        delete(spark, search.folder)


class _Search:
    """The rounds of one search, and which files hold its state."""

    def __init__(self, spark: SparkSession, blocks: Blocks, folder: str, limit: float):
        self.spark, self.blocks, self.folder, self.limit = spark, blocks, folder, limit
        self.deltas: dict[int, list[int]] = defaultdict(list)
        """Rounds whose files hold a block's state."""
        self.kept = {0}
        """Rounds with a folder."""
        self.waiting = {"light": {}, "heavy": {}}
        """The least distance of each block that is not sent yet."""

    def run(self, reached: DataFrame, work: Work) -> None:
        self._begin(reached)
        arrived: dict[int, float] = {}
        number = 0
        delta = self.blocks.mean_weight
        width = delta
        bound = min(self.waiting["light"].values(), default=0.0) + width
        while True:
            light, heavy = self.waiting["light"], self.waiting["heavy"]
            near = min([*arrived.values(), *light.values()], default=_INF)
            later = min(heavy.values(), default=_INF)
            if near >= bound and later >= bound:
                least = min(near, later)
                if least == _INF:
                    return
                small = not work.rounds or work.rounds[-1]["relaxed"] < max(SMALL_EDGES, SMALL_SHARE * self.blocks.rows)
                width = width * WIDER if small else max(delta, width / WIDER)
                bound = max(least + width, float(np.nextafter(least, _INF)))
            settled = near >= bound
            active = set(arrived) | {b for b, x in light.items() if x < bound}
            if settled:
                active |= {b for b, x in heavy.items() if x < bound}
            number += 1
            # Light edges are those that can stay within the step; it changes only when all below the bound is sent.
            arrived = self._round(number, sorted(active), bound, width, settled, work)

    def _begin(self, reached: DataFrame) -> None:
        """Write the state that the search starts from; what is fresh there waits to be sent."""
        block = block_column(self.blocks.bounds, "id") if len(self.blocks.bounds) > 1 else F.lit(0)
        sent = F.when(F.col("fresh"), F.lit(_INF)).otherwise(F.col("value"))
        rows = reached.select(
            F.lit(STATE).alias("kind"), block.alias("block"), F.lit(-1).alias("target"), "id", "value", sent.alias("light"), sent.alias("heavy")
        )
        rows.repartition(self.blocks.partitions, "block").write.partitionBy("kind", "block").parquet(f"{self.folder}/round=0")
        fresh = F.min(F.when(F.col("light") == _INF, F.col("value"))).alias("least")
        for row in self._read([f"round=0/kind={STATE}"]).groupBy("block").agg(fresh).collect():
            self.deltas[row["block"]].append(0)
            if row["least"] is not None:
                self.waiting["light"][row["block"]] = row["least"]

    def _round(self, number: int, active: list[int], bound: float, delta: float, heavy: bool, work: Work) -> dict[int, float]:
        """Run the active blocks; the blocks that messages go to, with the least distance of each."""
        folder = f"{self.folder}/round={number}"
        folded = frozenset(b for b in active if len(self.deltas[b]) >= FOLD_ROUNDS)
        step = Step(bound, self.limit, delta, heavy, folded, self.blocks.bounds, self.blocks.hot)
        messages = self._read([f"round={number - 1}/kind={MESSAGE}"]).select(F.col("target").alias("block"), "id", "value", *_unknown("stored"))
        state = self._state(active)
        rows = messages.unionByName(state.select("block", "id", "value", "light", "heavy", F.col("value").alias("stored")))
        known = (
            rows.repartition(self.blocks.partitions, "block")
            .groupBy("block", "id")
            .agg(*[F.min(name).alias(name) for name in ("value", "light", "heavy", "stored")])
        )
        pairs = known.groupBy("block").cogroup(self.blocks.of(active).groupBy("block"))
        found = pairs.applyInArrow(lambda key, left, right: relax_block(key[0].as_py(), left, right, step), _ROW)
        found.write.partitionBy("kind", "block").parquet(folder)
        if self.blocks.spread is not None:
            self._spread(number)
        told = self._read([f"round={number}/kind={STATUS}"])
        heard = self._read([f"round={number}/kind={MESSAGE}"]).groupBy("kind", "target").agg(F.count(F.lit(1)).alias("id"), F.min("value").alias("value"))
        # A row for each block that has run and for each that messages go to.
        rows = told.unionByName(heard, allowMissingColumns=True).collect()
        made, sent = ([row for row in rows if row["kind"] == kind] for kind in (STATUS, MESSAGE))
        gone = [f"round={number - 1}/kind={MESSAGE}", *(f"round={number}/kind={kind}" for kind in (STATUS, HOT))]
        for row in made:
            block = row["block"]
            if block in folded:
                gone += [f"round={r}/kind={STATE}/block={block}" for r in self.deltas[block]]
                self.deltas[block] = []
            if row["target"]:
                self.deltas[block].append(number)
            for name in ("light", "heavy"):
                self.waiting[name].pop(block, None)
                if row[name] < _INF:
                    self.waiting[name][block] = row[name]
        self.kept.add(number)
        held = {r for rounds in self.deltas.values() for r in rounds} | {number}
        gone += [f"round={r}" for r in self.kept - held]
        self.kept &= held
        for path in gone:
            delete(self.spark, f"{self.folder}/{path}")
        work.rounds.append(
            {
                "blocks": len(active),
                "relaxed": sum(row["id"] for row in made),
                "changed": sum(row["target"] for row in made),
                "messages": sum(row["id"] for row in sent),
                "folded": len(folded),
            }
        )
        return {row["target"]: row["value"] for row in sent}

    def _spread(self, number: int) -> None:
        """Messages over the edges of hot vertices that come nearer; of those there are few."""
        ready = self._read([f"round={number}/kind={HOT}"]).select(F.col("id").alias("src"), F.col("value").alias("from"))
        if ready.isEmpty():
            return
        weight = F.col("weight") if "weight" in self.blocks.spread.columns else F.lit(1.0)
        sent = self.blocks.spread.join(F.broadcast(ready), "src").groupBy(F.col("dst").alias("id")).agg(F.min(F.col("from") + weight).alias("value"))
        sent = sent.where((F.col("value") <= self.limit) & (F.col("value") < _INF))
        target = block_column(self.blocks.bounds, "id")
        sent.select(target.alias("target"), "id", "value", *_unknown()).write.parquet(f"{self.folder}/round={number}/kind={MESSAGE}/block=-1")

    def _read(self, paths: list[str]) -> DataFrame:
        """Rows of some files below the search's folder, of those that exist."""
        found = [path for path in (f"{self.folder}/{p}" for p in paths) if exists(self.spark, path)]
        return self._rows(found)

    def _state(self, active: list[int]) -> DataFrame:
        """The base and deltas of some blocks."""
        return self._rows([f"{self.folder}/round={r}/kind={STATE}/block={b}" for b in active for r in self.deltas[b]])

    def _rows(self, found: list[str]) -> DataFrame:
        if not found:
            return self.spark.createDataFrame([], _ROW)
        return self.spark.read.schema(_ROW).option("basePath", self.folder).parquet(*found).select(*[x.split()[0] for x in _ROW.split(", ")])

    def result(self) -> DataFrame:
        return cut(self._state(list(self.deltas)).groupBy("id").agg(F.min("value").alias("value")))


def _unknown(*more: str) -> list:
    return [F.lit(_INF).alias(name) for name in ("light", "heavy", *more)]

"""Message passing in rounds, as DataFrame joins and aggregations."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.storagelevel import StorageLevel

from weftgraph.functions.combine import Combiner
from weftgraph.graph import Graph
from weftgraph.operators import skew
from weftgraph.operators.layout import Layout, arranged
from weftgraph.operators.runtime import ROWS_WORTH_A_WAIT, cut, discard

_RESERVED = {"src", "dst", "weight", "msg", "_changed", "_at", "_new", "_last", skew.SALT, skew.SALTS}


@dataclass(frozen=True)
class Superstep:
    """What a round knows besides its rows: its number, from 1, and totals over the state before it."""

    number: int
    totals: Mapping[str, float] = field(default_factory=dict)


def propagate(
    graph: Graph,
    state: DataFrame,
    message: Column | Callable[[Superstep], Column],
    combine: Combiner,
    update: Mapping[str, Column] | Callable[[Superstep], Mapping[str, Column]],
    *,
    direction: str = "out",
    senders: Column | None = None,
    totals: Mapping[str, Column] | None = None,
    max_iterations: int | None = None,
    keeps: bool = False,
) -> DataFrame:
    """Run rounds of send, combine, update over ``state(id, ...)`` and return the last state.

    message: what travels along an edge, over the sender's id ``src``, its state columns and ``weight``.
    combine: reduces the ``(id, msg)`` rows of a round, see ``weftgraph.functions``.
    update: new values of state columns, over the old ones and ``msg``, which is null where nothing came.
    direction: ``out`` follows the edges, ``all`` goes both ways. An undirected graph lists both already.
    senders: first senders; after them only vertices whose state changed send. Without it all vertices
        send in every round.
    totals: aggregates over the whole state, offered to the next round as ``Superstep.totals``.
    keeps: says that ``update`` changes nothing where no message came. With ``senders`` a round in which few vertices send
        then writes the rows that change only, and of a large graph reads the edges and rows that it needs.

    ``message`` and ``update`` may also be functions of the ``Superstep``. Rounds end after
    ``max_iterations``, or when no vertex changes. With such a function or ``totals`` a later round may still
    change something, so then all rounds are run and ``max_iterations`` is needed.
    """
    if direction not in ("out", "all"):
        raise ValueError(f"direction must be 'out' or 'all', not {direction!r}")
    if _RESERVED & set(state.columns):
        raise ValueError(f"state columns may not be named {sorted(_RESERVED)}")
    with arranged(graph, undirected=direction == "all", weighted=graph.weighted) as layout:
        return iterate(layout, state, message, combine, update, senders, totals, max_iterations, keeps=keeps)


def iterate(
    layout: Layout,
    state: DataFrame,
    message: Column | Callable[[Superstep], Column],
    combine: Combiner,
    update: Mapping[str, Column] | Callable[[Superstep], Mapping[str, Column]],
    senders: Column | None = None,
    totals: Mapping[str, Column] | None = None,
    max_iterations: int | None = None,
    pause: Callable[[int], bool] | None = None,
    keeps: bool = False,
) -> DataFrame:
    """``propagate`` over edges that are laid out already.

    ``pause`` is asked after each round, with the number of vertices that changed in it; where it agrees, the state so far
    is returned with its column ``_changed``, which it has in no other case.
    """
    columns = [c for c in state.columns if c != "id"]
    totals = dict(totals or {})
    settles = not (totals or callable(message) or callable(update))
    if not settles and max_iterations is None:
        raise ValueError("set max_iterations: rounds with totals or functions of the round don't end by themselves")
    watch = Observation()
    first = F.lit(True) if senders is None else senders
    # Sorted once here; from then on every round's join hands the order on.
    state = state.withColumn("_changed", first).repartition(layout.partitions, "id").sortWithinPartitions("id")
    state = cut(state, watch, _changed=F.count_if("_changed"), _vertices=F.count(F.lit(1)), **totals)
    layout.release()
    held = State(state, columns, watch.get["_vertices"])
    number = 0
    try:
        while max_iterations is None or number < max_iterations:
            seen = {name: value for name, value in watch.get.items() if name != "_vertices"}
            changing = seen.pop("_changed")
            if not changing and settles:
                break
            if pause is not None and pause(changing):
                return held.whole().select("id", *columns, "_changed")
            number += 1
            step = Superstep(number, seen)
            few = senders is not None and keeps and settles and changing < FEW * held.vertices
            sending = held.whole() if senders is None else held.changed()
            sending = sending.select(F.col("id").alias("src"), *columns)
            offer = message(step) if callable(message) else message
            near = few and held.vertices + layout.rows >= ROWS_WORTH_A_WAIT and changing <= NAMED
            sent = combine(layout.send(sending, offer, _ids(sending, "src") if near else None))
            new = update(step) if callable(update) else update
            changed = F.lit(False)
            for name, value in new.items():
                changed = changed | ~F.col(name).eqNullSafe(value)
            after = ["id", *[new.get(c, F.col(c)).alias(c) for c in columns], changed.alias("_changed")]
            watch = Observation()
            if few:
                asked = None
                if near:
                    sent = cut(sent)
                    asked = _ids(sent.limit(NAMED + 1), "id")
                rows = held.rows(asked if asked is not None and len(asked) <= NAMED else None)
                held.add(cut(rows.join(sent, "id").select(*after).where("_changed"), watch, _changed=F.count(F.lit(1))), watch)
                if near:
                    discard(sent)
            else:
                whole = held.rows().join(sent, "id", "left").select(*after)
                held.replace(cut(whole, watch, _changed=F.count_if("_changed"), **totals))
        return held.whole().select("id", *columns)
    finally:
        held.release()


FEW = 0.2
"""A round in which less than this share of the vertices send writes the rows that change, not all."""
FOLD_ROUNDS = 10
"""Such rounds after which their rows are merged into the base."""
NAMED = 1_000
"""So few senders, or receivers, are looked for by their ids among the cached edges, or rows."""


def _ids(rows: DataFrame, name: str) -> list[int]:
    """Ids of rows, of which there are known to be few."""
    return [row[0] for row in rows.select(name).collect()]


class State:
    """Rows of all vertices: a base of all, and of some rounds since the rows they changed.

    The base and each round's rows lie in the checkpoint folder, so that what is lost with an executor is read again from them.
    """

    def __init__(self, base: DataFrame, columns: list[str], vertices: int):
        self._base, self._columns, self.vertices = base, columns, vertices
        self._cached: DataFrame | None = None
        self._deltas: list[DataFrame] = []
        self._written = 0

    def changed(self) -> DataFrame:
        """The rows that the last round changed."""
        return self._deltas[-1] if self._deltas else self._base.where("_changed")

    def add(self, rows: DataFrame, watch: Observation) -> None:
        """Rows that a round has changed, as ``watch`` has counted them."""
        self._deltas.append(rows)
        self._written += watch.get["_changed"]
        if len(self._deltas) >= FOLD_ROUNDS or self._written > self.vertices:
            self.replace(cut(self.whole()))

    def replace(self, base: DataFrame) -> None:
        """All rows anew; the files that held them before are deleted."""
        self.release()
        discard(self._base, *self._deltas)
        self._base, self._deltas, self._written = base, [], 0

    def release(self) -> None:
        """Let go of cached rows; they stay in the checkpoint folder."""
        if self._cached is not None:
            self._cached.unpersist()
            self._cached = None

    def whole(self) -> DataFrame:
        """All rows as they are now, with ``_changed`` where the last round changed them."""
        if not self._deltas:
            return self._base
        last = self._deltas[-1].select("id", F.lit(True).alias("_last"))
        rows = self.rows().join(last, "id", "left")
        return rows.select("id", *self._columns, F.col("_last").isNotNull().alias("_changed"))

    def rows(self, ids: list[int] | None = None) -> DataFrame:
        """Rows as they are now, those of ``ids`` or all; of the base's cached batches only those that may hold one are read."""
        base = self._base
        if ids is not None:
            if self._cached is None:
                self._cached = base.persist(StorageLevel.MEMORY_AND_DISK)
            base = self._cached.where(F.col("id").isin(ids))
        base = base.select("id", *self._columns)
        if not self._deltas:
            return base
        named = [rows.select("id", F.lit(i).alias("_at"), F.struct(*self._columns).alias("_new")) for i, rows in enumerate(self._deltas)]
        latest = reduce(DataFrame.unionByName, named).groupBy("id").agg(F.max_by("_new", "_at").alias("_new"))
        if ids is not None:
            latest = latest.where(F.col("id").isin(ids))
        is_new = F.col("_new").isNotNull()
        return base.join(latest, "id", "left").select(
            "id", *[F.when(is_new, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in self._columns]
        )

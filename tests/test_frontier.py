"""Rounds by blocks: distances that cost what changes, their files, and what they read."""

import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weftgraph import Graph, bfs, propagate, sssp, wcc
from weftgraph.functions import reduced_by
from weftgraph.operators import blocks as layout, propagate as propagation
from weftgraph.operators import relax, runtime
from weftgraph.operators.blocks import blocked
from weftgraph.operators.layout import arranged
from weftgraph.operators.relax import Work
from weftgraph.plans import distances as plans


def brute(edges, source):
    out = {}
    for a, b, w in edges:
        if w < float("inf"):
            out.setdefault(a, []).append((b, w))
    found, queue = {source: 0.0}, [source]
    while queue:
        a = queue.pop()
        for b, w in out.get(a, ()):
            if found[a] + w < found.get(b, float("inf")):
                found[b] = found[a] + w
                queue.append(b)
    return found


def weighted(spark, edges):
    return Graph.from_edges(spark.createDataFrame(edges, "src long, dst long, weight double"))


def start(spark, source):
    return spark.createDataFrame([(source, 0.0, True)], "id long, value double, fresh boolean")


def small_blocks(monkeypatch, edges, task=10):
    monkeypatch.setattr(layout, "BLOCK_EDGES", edges)
    monkeypatch.setattr(runtime, "ROWS_WORTH_A_TASK", task)


@pytest.mark.parametrize(("seed", "edges", "delta", "wide"), [(1, 40, 2.0, 0), (2, 9, 0.5, 10**6), (3, 10**6, 5.0, 0), (4, 60, 1.0, 10**6)])
def test_equals_brute_force(spark, monkeypatch, seed, edges, delta, wide):
    small_blocks(monkeypatch, edges, 60)
    monkeypatch.setattr(relax, "FOLD_ROUNDS", 2)
    monkeypatch.setattr(relax, "SMALL_EDGES", wide)
    rng = random.Random(seed)
    # Ties, loops, parallel edges, weights of nothing, and weights that lead nowhere.
    weight = lambda: rng.choice([0.0, 0.5, 1.0, 1.5, 9.0, rng.random() * 4, float("inf"), float("nan")])
    rows = [(rng.randrange(60) - 9, rng.randrange(60) - 9, weight()) for _ in range(170)] + [(0, 1, 1.0), (0, 1, 0.5)]
    rows += [(5, rng.randrange(60), 1.0) for _ in range(30)]
    with blocked(weighted(spark, rows), weighted=True) as laid:
        assert (len(laid.hot) > 0) == (edges < 30)
        laid = layout.Blocks(**{**laid.__dict__, "mean_weight": delta})
        found = {r.id: r.value for r in relax.distances(laid, start(spark, 0)).collect()}
        near = {r.id: r.value for r in relax.distances(laid, start(spark, 0), limit=1.5).collect()}
        nowhere = relax.distances(laid, start(spark, 777)).collect()
    want = brute(rows, 0)
    assert found == want
    assert near == {v: d for v, d in want.items() if d <= 1.5}
    assert [tuple(r) for r in nowhere] == [(777, 0.0)]


def path(spark, n):
    edges = spark.range(n - 1).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    return Graph.from_edges(edges)


def test_a_long_path_takes_a_round_for_a_block_not_for_an_edge(spark, monkeypatch):
    small_blocks(monkeypatch, 800)
    work = Work()
    found = bfs(path(spark, 5000), 0, work=work)
    assert found.where("hops <> id").count() == 0 and found.count() == 5000
    assert 5 < len(work.rounds) < 40
    assert bfs(path(spark, 5000), 0, max_iterations=1234, unreachable=-1).groupBy().agg(F.max("hops"), F.count_if(F.col("hops") < 0)).first() == (1234, 3765)
    # The search runs some of the blocks in a round; each vertex sends about once.
    assert max(r["blocks"] for r in work.rounds) <= 3
    assert work.relaxed < 5100 and sum(r["changed"] for r in work.rounds) < 3 * 5000


def test_a_grid(spark, monkeypatch):
    small_blocks(monkeypatch, 3000)
    side = 60
    cell = spark.range(side * side)
    right = cell.where(F.col("id") % side < side - 1).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    down = cell.where(F.col("id") < side * (side - 1)).select(F.col("id").alias("src"), (F.col("id") + side).alias("dst"))
    graph = Graph.from_edges(right.unionByName(down), directed=False)
    found = bfs(graph, 0)
    assert found.where(F.col("hops") != (F.col("id") / side).cast("long") + F.col("id") % side).count() == 0


def test_a_round_reads_the_blocks_it_runs(spark, monkeypatch):
    """Of the cached edges only batches of the active blocks, of the state only their files."""
    small_blocks(monkeypatch, 500)
    batch = "spark.sql.inMemoryColumnarStorage.batchSize"
    with runtime.settings(spark, {batch: 100}), blocked(path(spark, 5000).checkpoint()) as laid:
        assert len(laid.bounds) >= 8
        laid.edges.count()
        some = laid.of([3])
        some.write.format("noop").mode("overwrite").save()
        plan = some._jdf.queryExecution().executedPlan().toString()
        assert "InMemoryTableScan" in plan and "block" in plan.split("InMemoryRelation")[0]
        rows = {r.block: r.n for r in laid.edges.groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect()}
        read = metric(some, "InMemoryTableScan", "numOutputRows")
        # The first and last batch may hold rows of other blocks too.
        assert rows[3] <= read <= rows[3] + 200


def metric(frame, operator, name):
    found = []

    def walk(node):
        if node.nodeName().startswith(operator):
            found.append(node.metrics().apply(name).value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    # Run through this very plan, so that its counters are those read.
    plan = frame._jdf.queryExecution().executedPlan()
    plan.execute().count()
    walk(plan)
    return sum(found)


def test_the_join_of_state_and_edges_moves_no_edges(spark, monkeypatch):
    small_blocks(monkeypatch, 500)
    with blocked(path(spark, 3000)) as laid:
        state = spark.range(10).select(F.lit(0).alias("block"), "id").repartition(laid.partitions, "block")
        pairs = state.groupBy("block").cogroup(laid.edges.groupBy("block"))
        plan = pairs.applyInArrow(lambda key, left, right: left, "block int, id long")._jdf.queryExecution().executedPlan().toString()
    assert plan.split("InMemoryRelation", 1)[0].count("Exchange") == 1


def files(folder):
    return sum(len(names) for _, _, names in os.walk(folder))


def test_files_of_a_search_stay_few_and_go(spark, monkeypatch):
    """Over many rounds a block has its base and a bounded number of deltas; nothing is left in the end."""
    small_blocks(monkeypatch, 200)
    monkeypatch.setattr(relax, "FOLD_ROUNDS", 3)
    monkeypatch.setattr(relax, "WIDER", 1)
    monkeypatch.setattr(relax, "SMALL_EDGES", 0)
    seen = []
    once = relax._Search._round

    def counted(self, number, *rest):
        found = once(self, number, *rest)
        seen.append((max(len(x) for x in self.deltas.values()), files(self.folder.removeprefix("file:"))))
        return found

    monkeypatch.setattr(relax._Search, "_round", counted)
    folder = runtime.checkpoint_dir(spark).removeprefix("file:")
    before = {x for x in os.listdir(folder) if x.startswith("distances-")}
    # A ring of 12 blocks, gone round by steps of one: each block is active for many rounds.
    n = 24
    rows = [(i, (i + 1) % n, 1.0) for i in range(n)] + [(i, i, 1.0) for i in range(n) for _ in range(40)]
    with blocked(weighted(spark, rows), weighted=True) as laid:
        blocks = len(laid.bounds)
        assert blocks > 3
        found = {r.id: r.value for r in relax.distances(laid, start(spark, 0)).collect()}
    assert found == {i: float(i) for i in range(n)}
    assert len(seen) >= 20 and max(x for x, _ in seen) <= 4
    # Of each block the last base and its deltas, of each round with some a mark of success, and messages; each with a checksum.
    assert max(x for _, x in seen) <= 2 * (2 * 4 * blocks + 4)
    assert {x for x in os.listdir(folder) if x.startswith("distances-")} == before


@pytest.mark.parametrize("fold", [1, 10])
def test_deltas_hold_what_changes(spark, monkeypatch, fold):
    small_blocks(monkeypatch, 300)
    monkeypatch.setattr(relax, "FOLD_ROUNDS", fold)
    work = Work()
    with blocked(path(spark, 2000)) as laid:
        found = relax.distances(laid, start(spark, 0), work=work).collect()
    assert sorted((r.id, r.value) for r in found) == [(i, float(i)) for i in range(2000)]
    written = sum(r["changed"] for r in work.rounds)
    assert written < 2.5 * 2000 if fold == 10 else written > 2000


def test_fewer_relaxations_than_rounds_over_all_edges(spark, monkeypatch):
    """Steps of distance relax fewer edges than sending along every edge of each vertex that changes."""
    small_blocks(monkeypatch, 4000, 2000)
    monkeypatch.setattr(relax, "SMALL_EDGES", 0)
    rng = np.random.default_rng(5)
    n = 1500
    rows = [(int(a), int(b), float(w)) for a, b, w in zip(rng.integers(0, n, 20_000), rng.integers(0, n, 20_000), rng.exponential(1, 20_000), strict=True)]
    out = {}
    for a, b, w in rows:
        out.setdefault(a, []).append((b, w))
    known, front, sent = {0: 0.0}, {0}, 0
    while front:
        new = {}
        for a in front:
            for b, w in out.get(a, ()):
                sent += 1
                new[b] = min(new.get(b, float("inf")), known[a] + w)
        front = {b for b, d in new.items() if d < known.get(b, float("inf"))}
        known |= {b: new[b] for b in front}
    work = Work()
    with blocked(weighted(spark, rows), weighted=True) as laid:
        found = {r.id: r.value for r in relax.distances(laid, start(spark, 0), work=work).collect()}
    assert found == known
    assert work.relaxed < 0.8 * sent


def test_algorithms_switch_to_blocks(spark, monkeypatch):
    monkeypatch.setattr(plans, "PATIENCE", 2)
    monkeypatch.setattr(plans, "FEW", 2.0)
    rng = random.Random(9)
    rows = [(i, i + 1, 1.0 + i % 3) for i in range(40)] + [(rng.randrange(50), rng.randrange(50), rng.choice([2.0, 30.0])) for _ in range(60)]
    graph = weighted(spark, rows)
    work = Work()
    want = brute(rows, 0)
    found = {r.id: r.distance for r in sssp(graph, 0, work=work).collect()}
    assert found == {v: want.get(v, float("inf")) for v in found} and work.rounds
    hops = brute([(a, b, 1.0) for a, b, _ in rows], 0)
    work = Work()
    found = {r.id: r.hops for r in bfs(graph.unweighted(), 0, max_iterations=7, unreachable=-1, work=work).collect()}
    assert found == {v: int(hops[v]) if hops.get(v, 99) <= 7 else -1 for v in found} and work.rounds


def test_a_block_alone():
    step = relax.Step(2.5, float("inf"), 1.0, False, frozenset(), np.array([0, 10]), np.zeros(0, np.int64))
    state = pa.table({"id": [1, 2], "value": [0.0, 9.0], "light": [float("inf")] * 2, "heavy": [float("inf")] * 2, "stored": [0.0, float("inf")]})
    edges = pa.table({"src": [1, 1, 2, 3], "dst": [2, 12, 3, 1], "weight": [1.0, 1.0, 1.0, 5.0]})
    made = relax.relax_block(0, state, edges, step).to_pylist()
    rows = lambda kind: [(r["id"], r["value"]) for r in made if r["kind"] == kind]
    assert rows(relax.STATE) == [(1, 0.0), (2, 1.0), (3, 2.0)] and rows(relax.MESSAGE) == [(12, 1.0)]
    # What is left: the heavy edge of 3 at distance 2; four light edges were relaxed, of 1, 2 and none of 3.
    status = next(r for r in made if r["kind"] == relax.STATUS)
    assert (status["id"], status["light"], status["heavy"]) == (3, float("inf"), 2.0)
    assert relax.relax_block(0, state.slice(0, 0), edges, step).num_rows == 0


@pytest.mark.parametrize(("fold", "named", "large"), [(1, 1000, 10**6), (10, 1000, 0), (3, 2, 0)])
def test_rounds_that_write_what_changes(spark, monkeypatch, fold, named, large):
    """Same results however often deltas are folded and whether rows are looked for by id."""
    monkeypatch.setattr(propagation, "FOLD_ROUNDS", fold)
    monkeypatch.setattr(propagation, "NAMED", named)
    monkeypatch.setattr(propagation, "ROWS_WORTH_A_WAIT", large)
    monkeypatch.setattr(propagation, "FEW", 0.5)
    written = []
    add = propagation.State.add
    monkeypatch.setattr(propagation.State, "add", lambda self, rows, watch: written.append(watch.get["_changed"]) or add(self, rows, watch))
    rng = random.Random(fold)
    rows = [(i, i + 1, rng.choice([1.0, 2.0])) for i in range(14)] + [(rng.randrange(30), rng.randrange(30), 7.0) for _ in range(20)]
    graph = weighted(spark, rows)
    want = brute(rows, 0)
    found = propagate(
        graph,
        graph.vertices.select("id", F.when(F.col("id") == 0, F.lit(0.0)).alias("far"), F.lit(None).cast("string").alias("note")),
        message=F.col("far") + F.col("weight"),
        combine=reduced_by(F.min),
        update={"far": F.least("far", "msg"), "note": F.when(F.col("msg") < F.col("far"), F.lit("again")).otherwise(F.col("note"))},
        senders=F.col("far").isNotNull(),
        keeps=True,
    )
    assert found.columns == ["id", "far", "note"]
    assert {r.id: r.far for r in found.collect()} == {v: want.get(v) for v in (r.id for r in graph.vertices.collect())}
    assert len(written) > 5 and max(written) < 30


def test_a_small_frontier_reads_few_batches(spark, monkeypatch):
    batch = "spark.sql.inMemoryColumnarStorage.batchSize"
    with runtime.settings(spark, {batch: 100}), arranged(path(spark, 5000).checkpoint()) as laid:
        laid.cold.count()
        some = laid.of(laid.cold, [17, 4000])
        assert metric(some, "InMemoryTableScan", "numOutputRows") <= 200
        base = spark.range(5000).withColumn("x", F.lit(1)).withColumn("_changed", F.lit(False))
        base = runtime.cut(base.repartition(laid.partitions, "id").sortWithinPartitions("id"))
        held = propagation.State(base, ["x"], 5000)
        held.rows([5]).count()
        assert metric(held.rows([17, 4000]), "InMemoryTableScan", "numOutputRows") <= 200
        held.replace(base)


def test_a_loop_deletes_the_states_it_no_longer_reads(spark):
    folder = runtime.checkpoint_dir(spark).removeprefix("file:")
    graph = Graph.from_edges(spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "src long, dst long")).checkpoint()
    before = len(os.listdir(folder))
    state = graph.vertices.select("id", F.col("id").alias("x"))
    update = {"x": F.coalesce("msg", F.lit(0)).cast("long")}
    found = propagate(graph, state, F.col("x") + 1, reduced_by(F.sum), update, max_iterations=50)
    assert len(os.listdir(folder)) <= before + 2
    assert sorted(map(tuple, found.collect())) == [(1, 52), (2, 53), (3, 51)]
    wcc(path(spark, 300)).count()
    assert len(os.listdir(folder)) <= before + 2 + 2


def test_only_own_files_are_deleted(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/kept")
    held = runtime.cut(spark.range(3).withColumn("x", F.lit(1)))
    runtime.discard(held)
    assert spark.read.parquet(f"{tmp_path}/kept").count() == 3
    with pytest.raises(Exception, match="heckpoint|not exist|No such"):
        held.collect()

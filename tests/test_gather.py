"""Messages by block, as arrays: their bytes, where they go, and what a round of label propagation does with rows."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import reference_results as py
from weftgraph import Graph, cdlp
from weftgraph.operators import gather, packed, skew
from weftgraph.operators.gather import received
from weftgraph.operators.runtime import cut

EXTREMES = [0, 1, -1, 255, 256, 1 << 32, -(1 << 40), (1 << 63) - 1, -(1 << 63)]


def test_numbers_survive_packing():
    for values in ([], [7], [7, 7, 8], [0, 255], [-1, 255], [5, 70_000], [1, 1 << 32], EXTREMES):
        array = np.array(values, np.int64)
        assert packed.unpack(packed.pack(array)).tolist() == values
    assert len(packed.pack(np.arange(1 << 40, (1 << 40) + 256))) == 9 + 256


def test_blocks_are_those_of_spark(spark):
    ids = EXTREMES + [random.Random(1).randrange(-(1 << 62), 1 << 62) for _ in range(200)]
    frame = spark.createDataFrame([(i,) for i in ids], "id long").select("id", gather._block("id", 37).alias("block"))
    assert {r.id: r.block for r in frame.collect()} == dict(zip(ids, packed.blocks_of(np.array(ids), 37).tolist()))


def test_a_round_counts_labels_in_arrays(spark):
    """No join, sort or hash table of a row for each edge: two cogroups over the blocks' rows are all that a round has."""
    edges = spark.range(200_000).select((F.col("id") % 97).alias("src"), (F.col("id") * 7 % 101 + 200).alias("dst"))
    with received(Graph.from_edges(edges).checkpoint(), undirected=True) as laid:
        assert laid.blocks > 1 and laid.hot is None
        first = F.col("dst").alias("id")
        state = cut(laid.placed(laid.per_receiver.select(first, F.col("dst").alias("label"))))
        round_ = laid.most_frequent(state.select("block", "id", "label"))
        text = round_._jdf.queryExecution().executedPlan().toString()
        loop = text.split("InMemoryRelation", 1)[0]
        assert text.count("FlatMapCoGroupsInArrow") == 2 and "Join" not in text and "Aggregate" not in loop
        # A row for each two blocks and each part of one, not for each edge or vertex.
        assert laid.packed.count() <= laid.blocks * (laid.blocks + 1 + -(-400_000 // packed.PART_EDGES))
        assert {(r.id, r.label, r.was) for r in round_.collect() if r.id in (0, 200)} == {(0, 200, 0), (200, 0, 200)}


@pytest.mark.parametrize("directed", [True, False])
@pytest.mark.parametrize("hot", [False, True])
def test_labels_with_many_blocks_and_parts(spark, monkeypatch, directed, hot):
    monkeypatch.setattr(gather, "BLOCK_EDGES", 40)
    monkeypatch.setattr(packed, "FLUSH_EDGES", 100)
    monkeypatch.setattr(packed, "PART_EDGES", 7)
    if hot:
        monkeypatch.setattr(skew, "HOT_ROWS", 8)
    rng = random.Random(4)
    ids = [rng.choice([-1, 1]) * rng.randrange(1 << 61) for _ in range(120)]
    edges = [(rng.choice(ids), rng.choice(ids), 1.0) for _ in range(150)] + [(ids[0], i, 1.0) for i in ids]
    edges += [(ids[1], ids[1], 1.0), edges[0], edges[0]]
    frame = spark.createDataFrame(edges, "src long, dst long, weight double")
    lone = [1 << 62]
    graph = Graph.from_tables(spark.createDataFrame([(i,) for i in ids + lone], "id long"), frame, directed).checkpoint()
    with received(graph, undirected=True) as laid:
        assert (laid.hot is not None) == hot and laid.blocks > 4
    vertices, listed = set(ids + lone), edges if directed else py.undirected(edges)
    for rounds in (1, 4):
        assert {r.id: r.label for r in cdlp(graph, rounds).collect()} == py.cdlp(vertices, listed, directed, rounds)


def test_ties_go_to_the_smallest_label_and_loops_count():
    edges = [(5, 1), (6, 1), (6, 1), (5, 1), (-9, 2), (7, 2)]
    laid = defaultdict(list)
    for batch in packed.lay_out(packed.scatter([packed.pa.record_batch([[s for s, _ in edges], [d for _, d in edges]], names=["src", "dst"])], 1, False), 1):
        for row in batch.to_pylist():
            laid[row["kind"]].append(row)
    schema = packed._LAID
    state = packed.pa.table({"block": [0] * 6, "id": sorted({-9, 1, 2, 5, 6, 7}), "label": sorted({-9, 1, 2, 5, 6, 7})})
    sent = packed.send(state, packed.pa.Table.from_pylist(laid[packed.ROUTE], schema))
    found = packed.most_frequent(packed.pa.Table.from_pylist(laid[packed.EDGES] + laid[packed.RECEIVERS], schema), sent)
    assert Counter(zip(found["id"].to_pylist(), found["label"].to_pylist())) == Counter([(-9, -9), (1, 5), (2, -9), (5, 5), (6, 6), (7, 7)])

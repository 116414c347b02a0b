import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from weftgraph.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"
OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def ordered(rows):
    convs = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            convs.setdefault(conv, []).append((turn is not None, turn or 0, digest(role, text), (role, text)))
    return {conv: [x[3] for x in sorted(turns)] for conv, turns in convs.items()}


def rebuilt(convs):
    found = {}
    for c, turns in convs.items():
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        h = zlib.crc32(str(c).encode()) % 6
        found[c] = turns if c == base else convs.get(base, [])[:h] + turns[h:]
    return found


def brute(convs):
    members = {}
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    rows = []
    for node, convs_ in members.items():
        under = [x for x in members if x[: len(node)] == node]
        inner = {x[:-1] for x in members if x}
        ends = sorted(c for c in convs_ if len(convs[c]) == len(node))
        rows.append(
            (
                min(convs_),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(convs_),
                sum(x[:-1] == node for x in members if x),
                sum(x not in inner for x in under),
                sum((len(members[x]) - 1) * len(x[-1][1]) for x in under if x),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(rows, key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.select(*OUT).collect()), key=str)


def some(seed, count=60, most=7, words=2):
    rng = random.Random(seed)
    rows = []
    for _ in range(count):
        c = rng.choice([*range(0, 8), *range(95, 105), 200, 207, -3, -100, -105, 399, 1001])
        for t in range(rng.randint(1, most)):
            rows.append((c, rng.choice([None, t]), rng.choice(["user", "a", None]), rng.choice(["é😀", "", None, "x" * 5][: words + 1])))
    return rows


@pytest.mark.parametrize("partitions", [1, 9])
def test_equals_brute_force(spark, partitions):
    rows = some(partitions)
    turns = trie.keyed(spark.createDataFrame([(*r, 1, "k") for r in rows], SCHEMA + ", depth int, key string").repartition(partitions))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        plain, shared = found(trie.prefix_trie(turns)), found(trie.prefix_trie(*trie.with_shared_beginnings(turns)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert plain == brute(ordered(rows))
    assert shared == brute(rebuilt(ordered(rows)))


def test_conversations_that_run_through_many_tasks(spark):
    rng = random.Random(3)
    long = [("user", f"w{rng.randrange(3)}") for _ in range(700)]
    rows = [(c, t, *x) for c, n in ((5, 700), (6, 650), (7, 1), (107, 2)) for t, x in enumerate(long[:n])]
    rows += [(6, 650 + t, "user", "other") for t in range(90)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        made = trie.prefix_trie(trie.keyed(spark.createDataFrame(rows, SCHEMA).repartition(4)))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found(made) == brute(ordered(rows))


def test_turnless_and_empty(spark):
    short = [(c, 0, "user", "hi") for c in range(1, 30)]
    assert any(zlib.crc32(str(c).encode()) % 6 for c in range(1, 30))
    turns = trie.keyed(spark.createDataFrame([*short, (None, 1, "user", "x")], SCHEMA))
    assert found(trie.prefix_trie(*trie.with_shared_beginnings(turns))) == brute(rebuilt(ordered(short)))
    empty = trie.keyed(spark.createDataFrame([], SCHEMA))
    assert trie.prefix_trie(empty).count() == 0
    assert trie.prefix_trie(*trie.with_shared_beginnings(empty)).count() == 0


def test_a_node_that_very_many_end_with(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE_BYTES", 100)
    same = spark.range(3000).selectExpr("id as conv_id", "0L as turn", "'user' as role", "'hi' as text")
    rows = [(c, 0, "user", "hi") for c in range(3000)]
    assert found(trie.prefix_trie(trie.keyed(same))) == brute(ordered(rows))


@pytest.mark.parametrize("hot", [1_000_000, 3])
def test_hot_parents(spark, monkeypatch, hot):
    monkeypatch.setattr(trie.skew, "HOT_ROWS", hot)
    rows = [(c, t, "user", f"{c if t == 1 else 0}") for c in range(40) for t in range(2)] + some(8)
    assert found(trie.prefix_trie(trie.keyed(spark.createDataFrame(rows, SCHEMA)))) == brute(ordered(rows))


def test_rounds_follow_the_logarithm(spark, monkeypatch):
    rng = random.Random(4)
    # Chains of 600 nodes with a bush at every hundredth and one forest root more.
    parent = {0: None, 1: None}
    for start in range(3):
        at = 0
        for i in range(600):
            node = 10 + start * 600 + i
            parent[node], at = at, node
    for i in range(300):
        parent[5000 + i] = rng.choice([*range(10, 1810, 100), 5000 + i - 1 if i else 10])
    depth = {}
    for node in parent:
        path, at = 0, node
        while parent[at] is not None:
            path, at = path + 1, parent[at]
        depth[node] = path
    inner = set(parent.values())
    value = {node: rng.randrange(100) for node in parent}
    rows = [(n, p, depth[n], n not in inner, value[n], 1) for n, p in parent.items()]
    want = {n: [value[n], 1] for n in parent}
    for node in sorted(parent, key=depth.get, reverse=True):
        if parent[node] is not None:
            for i in (0, 1):
                want[parent[node]][i] += want[node][i]
    rounds = []
    one = trie._contracted
    monkeypatch.setattr(trie, "_contracted", lambda *a: rounds.append(1) or one(*a))
    tree = spark.createDataFrame(rows, "id long, parent long, depth long, leaf boolean, v long, n long")
    sums = trie.subtree_sums(tree, ["v", "n"])
    assert {r.id: [r.v, r.n] for r in sums.collect()} == want
    assert len(rounds) <= 20
    assert trie.subtree_sums(tree.filter(F.lit(False)), ["v"]).count() == 0

"""Conversation prefix trie, and sums over its subtrees by parallel tree contraction.

Each turn becomes a digest of its role and text. The turns of all conversations are put in one global order, in which
tasks add up position-dependent hashes of the digests: the sum over the first d turns names the trie's node. What
a task needs of those before it is one conversation's sums so far, so a conversation may run through many tasks.

Sums over subtrees take rounds of joins whose number follows the logarithm of the tree's size, not its depth. In each,
leaves are raked into their parents, and of chains of nodes with one child some, never two in a row, are compressed: their
child is hung on their parent and carries what they held. Afterwards compressed nodes are expanded again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from weftgraph.llm.text import mix
from weftgraph.operators import runtime, skew
from weftgraph.operators.runtime import cut

SHARED_EVERY = 100
MOST_SHARED = 5
PIECE_BYTES = 1 << 16
"""Characters of a list of ids that are put together before a node's digest is made."""

_STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


def keyed(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, turn, key, chars)`` of each row with a conversation id: digest of role and text, code points of the text.

    Null roles and texts are empty.
    """
    role_, text_ = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    whole = F.concat(F.length(role_).cast("string"), F.lit(":"), role_, text_)
    return turns.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).alias("turn"),
        F.substring(F.unhex(F.sha2(whole, 256)), 1, 16).alias("key"),
        F.length(text_).cast("long").alias("chars"),
    )


def with_shared_beginnings(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of another: rows of ``keyed`` with ``part`` and ``skip``, and conversations.

    The first h turns of conversation c are those of c - c % 100, as many as it has; c's own follow after its first h. h is
    the unsigned crc32 of c's decimal digits modulo 6; a remainder has the sign of c. The second table has ``(conv)``,
    also those of which no turn is left.
    """
    counted = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("own"))
    shared = F.col("conv") - F.col("conv") % SHARED_EVERY
    length = (F.crc32(F.col("conv").cast("string").cast("binary")) % (MOST_SHARED + 1)).cast("int")
    convs = counted.select("conv", shared.alias("base"), F.when(shared == F.col("conv"), 0).otherwise(length).alias("skip"))
    # Spark keeps the first few of each partition before it shuffles them.
    place = F.row_number().over(Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "key"))
    first = turns.filter(F.col("conv") % SHARED_EVERY == 0).withColumn("place", place).filter(F.col("place") <= MOST_SHARED)
    heads = first.groupBy(F.col("conv").alias("base")).agg(F.sort_array(F.collect_list(F.struct("place", "key", "chars"))).alias("head"))
    begun = (
        convs.filter("skip > 0")
        .join(heads, "base")
        .select("conv", "skip", F.inline(F.slice("head", F.lit(1), F.col("skip"))))
        .select("conv", F.lit(0).alias("part"), F.col("place").cast("long").alias("turn"), "key", "chars", "skip")
    )
    own = turns.select(
        "conv",
        F.lit(1).alias("part"),
        F.col("turn"),
        "key",
        "chars",
        F.when(F.col("conv") % SHARED_EVERY == 0, 0).otherwise(length).alias("skip"),
    )
    return own.unionByName(begun), convs.select("conv")


def prefix_trie(turns: DataFrame, convs: DataFrame | None = None) -> DataFrame:
    """The nodes of the trie of all conversations, from rows of ``keyed``.

    Turns are in order of ``turn``, null first, and of their digests where that is equal; repeated ones are all kept. Where ``turns`` has
    ``part`` and ``skip`` as ``with_shared_beginnings`` gives them, part 0 comes first and the first ``skip`` rows of part 1 are passed over.
    ``convs(conv)`` are the distinct conversations, by default those of ``turns``; without any there is no node.

    A node is a sequence of first turns, the root that of none. Columns: ``node``; ``conv_id``, the smallest conversation
    that begins with it; ``depth``; ``parent_conv_id``; ``n_convs`` that begin with it; ``n_children``; ``n_leaves`` and
    ``saved_tokens``, the leaves below it or itself and the sum over its subtree of (n_convs - 1) times the
    code points in a node's last text; ``ends_sha256`` of the ascending ids of conversations that end there, comma-joined.
    """
    if "part" not in turns.columns:
        turns = turns.withColumns({"part": F.lit(1), "skip": F.lit(0)})
    convs = turns.select("conv").distinct() if convs is None else convs
    order = ["conv", "part", F.col("turn").asc_nulls_first(), "key", "_tie"]
    placed = cut(
        turns.withColumn("_tie", F.monotonically_increasing_id()).orderBy(*order).select("conv", "part", "skip", "key", "chars")
    )
    paths = cut(_paths(placed))
    here = F.struct("depth", "k1", "k2")
    nodes = paths.groupBy(here.alias("key")).agg(
        F.count(F.lit(1)).alias("n_convs"),
        F.min("conv").alias("conv_id"),
        F.min("chars").alias("chars"),
        F.min(F.struct((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))).alias("up"),
    )
    top = F.struct(F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"))
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id")).filter("n_convs > 0")
    root = root.select(top.alias("key"), "n_convs", "conv_id", F.lit(0).cast("long").alias("chars"))
    nodes = nodes.unionByName(root, allowMissingColumns=True).withColumn("node", F.monotonically_increasing_id())
    watch = Observation()
    nodes = cut(nodes, watch, nodes=F.count(F.lit(1)))

    below = nodes.filter("up is not null").groupBy(F.col("up").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.join(below, "key", "left").select("key", "node", "conv_id", F.coalesce("n_children", F.lit(0)).alias("n_children"))
    total = watch.get["nodes"]
    limit = skew.hot_threshold(total, runtime.partition_count(turns.sparkSession, total))
    hot = cut(skew.hot_keys(below, "key", "n_children", limit)) if total > limit else None
    up = parents.select("key", F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    children = nodes.filter("up is not null").select("node", F.col("key").alias("own"), "n_convs", "conv_id", "chars", F.col("up").alias("key"))
    known = skew.keyed_join(children, up, "key", hot).drop("key").withColumnRenamed("own", "key")
    known = known.unionByName(nodes.filter("up is null").drop("up"), allowMissingColumns=True)
    known = cut(known.join(parents.select("node", "n_children"), "node"))

    tree = known.select(
        F.col("node").alias("id"),
        "parent",
        F.col("key.depth").alias("depth"),
        (F.col("n_children") == 0).alias("leaf"),
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
    )
    sums = subtree_sums(tree, ["n_leaves", "saved_tokens"]).withColumnRenamed("id", "node")
    # Conversations without a turn end at the root; one row for each conversation.
    last = paths.groupBy("conv").agg(F.max(here).alias("key"))
    ends = convs.join(last, "conv", "left").select(F.coalesce("key", top).alias("key"), "conv")
    return (
        known.join(sums, "node")
        .join(_digests(ends), "key", "left")
        .select(
            "node",
            "conv_id",
            F.col("key.depth").alias("depth"),
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )


# The first rows of a task may go on with the conversation that the task before it ends with. Of that a task needs
# four numbers: rows of part 1, depth, and the two sums of hashes.
Carried = tuple[int, int, int, int, int]


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    keys = batch.column("key")
    bounds = np.frombuffer(keys.buffers()[1], np.int32, len(keys) + 1, 4 * keys.offset)
    raw = np.frombuffer(keys.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    numbers = [batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in ("conv", "part", "skip")]
    return (*numbers, raw.copy().view(np.uint64).reshape(-1, 2))


def _advance(carried: Carried | None, conv: np.ndarray, part: np.ndarray, skip: np.ndarray, keys: np.ndarray):
    """What the rows of a sorted batch come to: which count, their depths, both hash sums before and after them."""
    n = len(conv)
    new = np.ones(n, bool)
    new[1:] = conv[1:] != conv[:-1]
    goes_on = carried is not None and carried[0] == conv[0]
    begin = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    first = begin == 0

    def summed(values: np.ndarray, before: int) -> np.ndarray:
        """Sums of each conversation up to each row, from what was carried on."""
        sums = np.cumsum(values, dtype=values.dtype)
        sums = sums - (sums - values)[begin]
        return sums + np.where(first & goes_on, values.dtype.type(before), values.dtype.type(0))

    carried = carried if goes_on else (0, 0, 0, 0, 0)
    own = summed(part, carried[1])
    counts = (part == 0) | (own > skip)
    depth = summed(counts.astype(np.int64), carried[2])
    hashes = [np.where(counts, mix(keys[:, i] + depth.astype(np.uint64) * _STEPS[i]), np.uint64(0)) for i in (0, 1)]
    after = [summed(hashes[i], carried[3 + i]) for i in (0, 1)]
    before = [after[i] - hashes[i] for i in (0, 1)]
    last = (int(conv[-1]), int(own[-1]), int(depth[-1]), int(after[0][-1]), int(after[1][-1]))
    return counts, depth, before, after, last


def _paths(placed: DataFrame) -> DataFrame:
    """``(conv, depth, p1, p2, k1, k2, chars)`` of each turn that counts: hash sums before and after it."""
    carried = _carried(placed)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = carried.get(TaskContext.get().partitionId())
        for batch in batches:
            if batch.num_rows:
                conv, *rest = _columns(batch)
                counts, depth, before, after, at = _advance(at, conv, *rest)
                columns = [conv, depth, *(x.view(np.int64) for x in (*before, *after))]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x[counts]) for x in columns), batch.column("chars").filter(pa.array(counts))],
                    ["conv", "depth", "p1", "p2", "k1", "k2", "chars"],
                )

    return placed.mapInArrow(rows, "conv long, depth long, p1 long, p2 long, k1 long, k2 long, chars long")


def _carried(placed: DataFrame) -> dict[int, Carried]:
    """What each partition takes over from those before it, where a conversation runs over the bound.

    Two passes over the partitions, of which each tells a row: first how many rows its first and last conversation have
    there, which gives the depths; then the hash sums of its last conversation.
    """

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends: list[list[int]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            conv, part, skip, _ = _columns(batch)
            found = []
            for one in (int(conv[0]), int(conv[-1])):
                begin, end = np.searchsorted(conv, one), np.searchsorted(conv, one, "right")
                own = int(part[begin:end].sum())
                found.append([one, int(end - begin) - own, own, int(skip[begin])])
            if not ends:
                ends = found
                continue
            whole = ends[0][0] == ends[1][0]
            if found[0][0] == ends[1][0]:
                joined = [found[0][0], *(a + b for a, b in zip(ends[1][1:3], found[0][1:3], strict=True)), found[0][3]]
                ends = [joined if whole else ends[0], joined if found[0][0] == found[1][0] else found[1]]
            else:
                ends[1] = found[1]
        if ends:
            row = [TaskContext.get().partitionId(), *ends[0], *ends[1]]
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in row], names)

    names = ["part", "conv", "base", "own", "skip", "conv_", "base_", "own_", "skip_"]
    seen = sorted(map(tuple, placed.mapInArrow(counts, ", ".join(f"{x} long" for x in names)).collect()))
    depths: dict[int, Carried] = {}
    at = None
    for part, *both in seen:
        first, last = both[:4], both[4:]
        goes_on = at is not None and at[0] == first[0]
        if goes_on:
            depths[part] = (at[0], at[2], at[1] + max(0, at[2] - at[3]), 0, 0)
        at = [last[0], at[1] + last[1], at[2] + last[2], last[3]] if goes_on and first[0] == last[0] else last
    if not depths:
        return {}

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        state = depths.get(part)
        for batch in batches:
            if batch.num_rows:
                *_, state = _advance(state, *_columns(batch))
        if state is not None:
            row = [part, state[0], *(x - (1 << 64 if x >> 63 else 0) for x in state[3:])]
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in row], ["part", "conv", "k1", "k2"])

    added = {row["part"]: row for row in placed.mapInArrow(hashes, "part long, conv long, k1 long, k2 long").collect()}
    found: dict[int, Carried] = {}
    sums, wrap = (0, 0), (1 << 64) - 1
    for part, *both in seen:
        if part in depths:
            found[part] = (*depths[part][:3], *sums)
        new = tuple(x & wrap for x in (added[part]["k1"], added[part]["k2"]))
        whole = part in depths and both[0] == both[4]
        sums = tuple((a + b) & wrap for a, b in zip(sums, new, strict=True)) if whole else new
    return found


def subtree_sums(tree: DataFrame, values: Sequence[str]) -> DataFrame:
    """``(id, *values)``: of each node the sums of ``values`` over its subtree, by rake and compress.

    ``tree`` has ``id``, ``parent`` (null at roots), ``depth``, ``leaf`` and ``values``. Nodes may have any number of
    children and chains any length: rounds follow the logarithm of the number of nodes. Without nodes there are no rows.
    """
    spark = tree.sparkSession
    nodes, deepest = tree.agg(F.count(F.lit(1)), F.max("depth")).first()
    partitions = runtime.partition_count(spark, nodes)
    bits = (deepest or 0).bit_length()
    off = {v: f"off_{v}" for v in values}
    extra = {v: f"extra_{v}" for v in values}
    # Spark 4.1 keeps constraints of cut tables under names of columns that a union then looks for in vain.
    unconstrained = runtime.settings(spark, {"spark.sql.constraintPropagation.enabled": "false"})
    with runtime.loop_settings(spark, partitions), unconstrained:
        watch = Observation()
        state = tree.select("id", "parent", "depth", "leaf", *values, *[F.lit(0).cast("long").alias(off[v]) for v in values])
        live = cut(state.repartition(partitions, "id").sortWithinPartitions("id"), watch, inner=F.count_if(~F.col("leaf")))
        rounds, seen = [live], watch.get
        compressed = 0
        while seen["inner"]:
            live, seen = _contracted(live, values, off, extra, len(rounds) - 1, bits)
            rounds.append(live)
            compressed += bool(seen["skipped"])
        known = reduce(DataFrame.unionByName, [live.filter("leaf").select("id", *values) for live in rounds])
        if compressed:
            kept = [F.col("skipped").alias("id"), F.col("id").alias("below"), *extra.values()]
            held = reduce(DataFrame.unionByName, [live.filter("skipped is not null").select(*kept) for live in rounds[1:]])
            known = known.unionByName(_expanded(held, known, extra, compressed))
        return cut(known)


def _expanded(held: DataFrame, known: DataFrame, extra: dict[str, str], rounds: int) -> DataFrame:
    """Sums of compressed nodes: their child's and their extra.

    A child may have been compressed itself, in a later round. Such nodes first look past one another, twice as far in
    each step, until each names a node whose sum is known.
    """
    for _ in range((rounds - 1).bit_length()):
        held = cut(held)
        further = held.select(F.col("id").alias("below"), F.col("below").alias("next"), *[F.col(x).alias(f"more_{x}") for x in extra.values()])
        held = held.join(further, "below", "left").select(
            "id",
            F.coalesce("next", "below").alias("below"),
            *[(F.col(x) + F.coalesce(f"more_{x}", F.lit(0))).alias(x) for x in extra.values()],
        )
    whole = held.join(known.withColumnRenamed("id", "below"), "below")
    return whole.select("id", *[(F.col(v) + F.col(x)).alias(v) for v, x in extra.items()])


def _contracted(live: DataFrame, values: Sequence[str], off: dict, extra: dict, number: int, bits: int) -> tuple[DataFrame, dict]:
    """The next round's nodes, how many of them are no leaves, and how many were compressed.

    A compressed node stays as ``skipped`` and ``extra_*`` in the row of its child: its sum is the child's and that extra.
    """

    def coin(node: Column, depth: Column) -> Column:
        # Chains of the tree as it was have consecutive depths, so a bit of it halves them; later a hash decides.
        chance = F.shiftright(depth, number) if number < bits else F.xxhash64(node, F.lit(number))
        return chance.bitwiseAND(F.lit(1).cast("long")) == 1

    leaf = F.col("leaf")
    told = (
        live.filter("parent is not null")
        .groupBy(F.col("parent").alias("id"))
        .agg(
            *[F.coalesce(F.sum(F.when(leaf, F.col(v) + F.col(off[v]))), F.lit(0)).alias(f"got_{v}") for v in values],
            F.count_if(~leaf).alias("left"),
            F.min(F.when(~leaf, F.col("id"))).alias("child"),
            F.min(F.when(~leaf, F.col("depth"))).alias("child_depth"),
        )
    )
    picked = coin(F.col("id"), F.col("depth")) & ~coin(F.col("child"), F.col("child_depth"))
    compressed = F.coalesce((F.col("left") == 1) & F.col("parent").isNotNull() & picked, F.lit(False))
    # Read twice below; the sums told to parents, all that is shuffled for it, are made once.
    raked = (
        live.filter(~leaf)
        .join(told, "id")
        .select(
            "id",
            "parent",
            "depth",
            (F.col("left") == 0).alias("leaf"),
            *[(F.col(v) + F.col(f"got_{v}")).alias(v) for v in values],
            *off.values(),
            compressed.alias("out"),
            "child",
        )
    )
    # To the only child of a compressed node: its new parent, what it carries from now on, the node that it stands for.
    sent = raked.filter("out").select(
        F.col("child").alias("id"),
        F.col("parent").alias("above"),
        F.col("id").alias("skipped"),
        *[F.col(v).alias(f"held_{v}") for v in values],
        *[F.col(off[v]).alias(f"more_{v}") for v in values],
    )
    watch = Observation()
    zero = F.lit(0).cast("long")
    after = raked.filter(~F.col("out")).join(sent, "id", "left").select(
        "id",
        F.when(F.col("skipped").isNull(), F.col("parent")).otherwise(F.col("above")).alias("parent"),
        "depth",
        "leaf",
        *values,
        *[(F.col(off[v]) + F.coalesce(f"held_{v}", zero) + F.coalesce(f"more_{v}", zero)).alias(off[v]) for v in values],
        "skipped",
        *[(F.col(off[v]) + F.col(f"held_{v}")).alias(extra[v]) for v in values],
    )
    live = cut(after, watch, inner=F.count_if(~leaf), skipped=F.count("skipped"))
    return live, watch.get


def _digests(ends: DataFrame) -> DataFrame:
    """``(key, sha256)`` of the ascending ids ``conv`` of each ``key``, comma-joined.

    The list of a key that very many end with is put together in pieces by many tasks. A digest runs over its text from the first
    byte to the last, so one task reads a key's pieces, in order and one at a time.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size = None, [], 0
        for batch in batches:
            names = [batch.column(x).to_pylist() for x in ("depth", "k1", "k2", "conv")]
            made = []
            for *this, conv in zip(*names, strict=True):
                if this != key or size >= PIECE_BYTES:
                    if held:
                        made.append((*key, held[0], ",".join(map(str, held))))
                    key, held, size = this, [], 0
                held.append(conv)
                size += 20
            yield from _batch(made)
        if held:
            yield from _batch([(*key, held[0], ",".join(map(str, held)))])

    def _batch(made: list[tuple]) -> Iterator[pa.RecordBatch]:
        if made:
            kinds = [pa.int64()] * 4 + [pa.string()]
            columns = [pa.array(x, kind) for x, kind in zip(zip(*made, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["depth", "k1", "k2", "first", "piece"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, hashlib.sha256()
        kinds = [pa.int64()] * 3 + [pa.string()]
        columns = ["depth", "k1", "k2", "sha256"]
        for batch in batches:
            made = []
            for *this, piece in zip(*(batch.column(x).to_pylist() for x in ("depth", "k1", "k2", "piece")), strict=True):
                if this == key:
                    digest.update(b",")
                else:
                    if key is not None:
                        made.append((*key, digest.hexdigest()))
                    key, digest = this, hashlib.sha256()
                digest.update(piece.encode())
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*made, strict=True), kinds, strict=True)], columns)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((*key, digest.hexdigest()), kinds, strict=True)], columns)

    key = ["depth", "k1", "k2"]
    listed = ends.select("key.*", "conv").orderBy(*key, "conv")
    joined = listed.mapInArrow(pieces, "depth long, k1 long, k2 long, first long, piece string")
    # A key cut by a bound of ranges has its pieces in order of their first ids.
    gathered = joined.repartition(*key).sortWithinPartitions(*key, "first")
    found = gathered.mapInArrow(hashed, "depth long, k1 long, k2 long, sha256 string")
    return found.select(F.struct(*key).alias("key"), "sha256")

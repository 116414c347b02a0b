"""Triangles of the simple undirected graph underlying a graph."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from weftgraph.graph import Graph
from weftgraph.operators import runtime, skew

# Neighbours compared at a time; longer lists travel in pieces of this many.
PIECE = 4096

# Links in the lists that meet in a block at most, on average; a task holds those, some 5 bytes each.
BLOCK_LINKS = 48_000_000

# Ways of a link from a lower vertex to a higher one, as bits, and which of them may be asked for.
_OUT, _BACK = 1, 2
_KINDS = {"out": _OUT, "back": _BACK, "mutual": _OUT | _BACK}

# Bits of a link in one long: its ways, its id above the least one, and the degree.
_WAY_BITS, _ID_BITS, _DEGREE_BITS = 2, 31, 30


@dataclass(frozen=True)
class Codes:
    """How ids stand in lists: as whole numbers of four bytes above the least id where all fit, or else as they are.

    Links are then single numbers too, in the order of degree and id, instead of rows of three.
    """

    least: int
    short: bool

    @classmethod
    def of(cls, least: int | None, greatest: int | None, most: int | None) -> Codes:
        if least is None:
            return cls(0, True)
        return cls(least, greatest - least < 1 << _ID_BITS and most < 1 << _DEGREE_BITS)

    def code(self, id: Column) -> Column:
        return (id - F.lit(self.least)).cast("int") if self.short else id

    def id(self, code: Column) -> Column:
        return code.cast("long") + F.lit(self.least) if self.short else code

    def link(self, degree: Column, id: Column, ways: Column) -> Column:
        if not self.short:
            return F.struct(degree.alias("degree"), id.alias("id"), ways.alias("ways"))
        rest = F.shiftleft(id - F.lit(self.least), _WAY_BITS).bitwiseOR(ways.cast("long"))
        return F.shiftleft(degree.cast("long"), _ID_BITS + _WAY_BITS).bitwiseOR(rest)

    def code_of(self, link: Column) -> Column:
        if not self.short:
            return link["id"]
        return F.shiftright(link, _WAY_BITS).bitwiseAND(F.lit((1 << _ID_BITS) - 1)).cast("int")

    def ways_of(self, link: Column) -> Column:
        return (link.bitwiseAND(F.lit(_KINDS["mutual"])) if self.short else link["ways"]).cast("tinyint")


@dataclass(frozen=True)
class Closed:
    """``degrees(id, degree)`` counts distinct neighbours. ``common`` has a row per linked pair u-v, u the
    lower, and piece of u's list: the vertices ``third`` above both and linked to both, and whether the
    pair is linked ``out`` (u to v) and ``back``, which is only known if kinds are asked for. For each of those,
    ``u_<kind>`` and ``v_<kind>`` are the ones of ``third`` that u, or v, is linked to in that way. ``vertices(id)`` are all, if asked for.
    """

    degrees: DataFrame
    common: DataFrame
    vertices: DataFrame | None = None


@contextmanager
def closed(graph: Graph, kinds: Sequence[str] = (), *, every_vertex: bool = False) -> Iterator[Closed]:
    """Find the triangles of ``graph``, each once, at its pair of lowest corners.

    Edges are turned from the lower to the higher vertex by (degree, id). Then no vertex has more than
    sqrt(2 E) edges going up, a hub least of all, and a triangle is a linked pair with a common vertex in
    both lists of higher neighbours. A list is sent once to each block of vertices, where it meets the lists of those of the
    block that it names. They are compared inside that join, so open paths of two edges are never shuffled or sorted. ``every_vertex`` makes partitions enough for a row per vertex as well.
    """
    spark = graph.edges.sparkSession
    with runtime.shuffles_spent(spark):
        pairs, vertices = _pairs(graph, every_vertex)
        degrees = runtime.cut(
            pairs.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("degree"))
        )
        ends, most, *range_ = degrees.agg(F.sum("degree"), F.max("degree"), F.min("id"), F.max("id")).first()
        codes = Codes.of(*range_, most)
        partitions = runtime.partition_count(spark, max(ends or 0, vertices.count() if every_vertex else 0))
        blocks = runtime.partition_count(spark, ends or 0, 2 * BLOCK_LINKS, 2 * BLOCK_LINKS)
        limit = skew.hot_threshold(ends or 0, partitions)
        hot = None
        if (most or 0) > limit:
            hot = runtime.cut(skew.hot_keys(degrees, "id", "degree", limit))
        with runtime.settings(spark, {"spark.sql.shuffle.partitions": partitions}):
            lists = runtime.cut(_lists(pairs, degrees, hot, kinds, codes))
            runtime.discard(pairs)
    with runtime.settings(spark, {"spark.sql.shuffle.partitions": partitions}):
        with runtime.settings(spark, {"spark.sql.requireAllClusterKeysForCoPartition": "false"}):
            yield Closed(degrees, _common(lists, hot, kinds, codes, blocks), vertices)


def _pairs(graph: Graph, every_vertex: bool) -> tuple[DataFrame, DataFrame | None]:
    """``(a, b[, a_to_b, b_to_a])``, a row for every two linked vertices, a < b, and all vertices if those are asked for.

    Both are written, one after the other, so that what one has shuffled is gone when the next shuffles.
    """
    cached = graph.edges.storageLevel != StorageLevel.NONE
    rising = F.col("src") < F.col("dst")

    def found(edges: DataFrame) -> DataFrame:
        if not graph.directed:
            # Each pair is listed both ways, so one of them tells all.
            return runtime.cut(edges.where(rising).select(F.col("src").alias("a"), F.col("dst").alias("b")).distinct())
        pairs = edges.where(F.col("src") != F.col("dst")).groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
        return runtime.cut(pairs.agg(F.max(rising).alias("a_to_b"), F.max(~rising).alias("b_to_a")))

    if not every_vertex:
        if cached or runtime.written(graph.edges) or not graph.directed:
            return found(graph.edges), None
    elif cached or not graph.spanned:
        # Vertices may be derived from the edges too, which the cache gives then.
        with graph.ends_held() as held:
            return found(held.edges), runtime.cut(held.vertices.select("id"))
    graph = graph.ends_written()
    vertices = runtime.cut(graph.vertices.select("id")) if every_vertex else None
    pairs = found(graph.edges)
    runtime.discard(graph.edges)
    return pairs, vertices


def _named(hot: DataFrame | None, key: str) -> DataFrame | None:
    return None if hot is None else hot.withColumnRenamed("id", key)


def _lists(pairs: DataFrame, degrees: DataFrame, hot: DataFrame | None, kinds: Sequence[str], codes: Codes) -> DataFrame:
    """``(u, list[, ways])``: per vertex the codes of its higher neighbours in rising order of those, and if kinds are asked
    for the ways in which each is linked.
    """
    for end in ("a", "b"):
        # A partition's degrees are few next to its pairs, which are not sorted then.
        table = degrees.select(F.col("id").alias(end), F.col("degree").alias(f"degree_{end}")).hint("shuffle_hash")
        pairs = skew.keyed_join(pairs, table, end, _named(hot, end))

    def ways(out: str, back: str) -> Column:
        if not kinds:
            return F.lit(0)
        if out not in pairs.columns:
            return F.lit(_OUT | _BACK)
        return F.when(F.col(out), _OUT).otherwise(0) + F.when(F.col(back), _BACK).otherwise(0)

    upward = F.struct("degree_a", "a") < F.struct("degree_b", "b")
    turned = pairs.select(
        F.when(upward, F.col("a")).otherwise(F.col("b")).alias("u"),
        F.when(upward, codes.link(F.col("degree_b"), F.col("b"), ways("a_to_b", "b_to_a")))
        .otherwise(codes.link(F.col("degree_a"), F.col("a"), ways("b_to_a", "a_to_b")))
        .alias("link"),
    )
    lists = turned.groupBy("u").agg(F.sort_array(F.collect_list("link")).alias("higher"))
    found = lists.select("u", "higher", F.transform("higher", codes.code_of).alias("list"))
    return found.select("u", "list", *([F.transform("higher", codes.ways_of).alias("ways")] if kinds else []))


def _common(lists: DataFrame, hot: DataFrame | None, kinds: Sequence[str], codes: Codes, blocks: int) -> DataFrame:
    ways = ["ways"] if kinds else []
    # For the pair u-v only what comes after v in u's list can be above both.
    after, at_most = F.col("at") + 2, F.lit(PIECE)
    link = F.get("ways", F.col("at")) if kinds else F.lit(0)
    block = lambda code: F.pmod(F.hash(code), F.lit(blocks))
    table = lists.select(F.col("u").alias("v"), "list", *ways)

    def pieces(rows: DataFrame, own: Column | None) -> DataFrame:
        """A row per pair u-v, of those that ``own`` tells by the code of v, and piece of the list of u."""
        every = rows.select("*", F.posexplode("list").alias("at", "code"))
        return (
            (every if own is None else every.where(own))
            .where(after <= F.size("list"))
            .withColumn("start", F.explode(F.sequence(after, F.size("list"), at_most)))
            .select(
                *(["block"] if own is not None else []),
                "u",
                codes.id(F.col("code")).alias("v"),
                link.alias("link"),
                F.slice("list", F.col("start"), at_most).alias("piece"),
                *[F.slice(name, F.col("start"), at_most).alias("piece_ways") for name in ways],
            )
        )

    # A list travels once to each block of vertices that some of its own are in, from the first of those on, and meets
    # the lists of all of these there.
    sending, to = lists, block
    if hot is not None:
        sending = lists.crossJoin(F.broadcast(hot.agg(F.collect_list(codes.code(F.col("id"))).alias("hots"))))
        to = lambda code: F.when(~F.array_contains("hots", code), block(code))
    own = F.slice("list", 1, F.size("list") - 1)
    sent = (
        sending.where(F.size("list") > 1)
        .withColumn("places", F.transform(own, to))
        .withColumn("block", F.explode(F.filter(F.array_distinct("places"), lambda x: x.isNotNull())))
        .withColumn("first", F.array_position("places", F.col("block")).cast("int"))
        .select("block", "u", *[F.slice(name, F.col("first"), F.size(name)).alias(name) for name in ("list", *ways)])
        .repartitionById(blocks, "block")
    )
    cold = table if hot is None else table.join(F.broadcast(_named(hot, "v")), "v", "left_anti")
    cold = cold.withColumn("block", block(codes.code(F.col("v")))).repartitionById(blocks, "block")
    met = pieces(sent, block(F.col("code")) == F.col("block")).join(cold.hint("shuffle_hash"), ["block", "v"]).drop("block")
    if hot is not None:
        # A hub has few higher vertices, all of them hubs, so the lists repeated for its parts are short.
        met = met.unionByName(skew.split_join(pieces(lists, None), table, "v", _named(hot, "v")))

    def linked(ids: str, ways: str, kind: str) -> Column:
        return F.filter(ids, lambda _, i: F.get(F.col(ways), i).bitwiseAND(F.lit(_KINDS[kind])) == _KINDS[kind])

    def named(found: Column, name: str) -> Column:
        return F.transform(found, codes.id).alias(name)

    return (
        met
        .withColumn("third", F.array_intersect("piece", "list"))
        .where(F.size("third") > 0)
        .select(
            "u",
            "v",
            (F.col("link").bitwiseAND(F.lit(_OUT)) != 0).alias("out"),
            (F.col("link").bitwiseAND(F.lit(_BACK)) != 0).alias("back"),
            named(F.col("third"), "third"),
            *[named(F.array_intersect("third", linked("piece", "piece_ways", kind)), f"u_{kind}") for kind in kinds],
            *[named(F.array_intersect("third", linked("list", "ways", kind)), f"v_{kind}") for kind in kinds],
        )
    )


def triangles(graph: Graph) -> DataFrame:
    """``(a, b, c)``, a < b < c: every three vertices linked to each other, directions ignored."""
    with closed(graph) as found:
        corners = found.common.select("u", "v", F.explode("third").alias("w"))
        ordered = corners.select(F.sort_array(F.array("u", "v", "w")).alias("t"))
        return runtime.planned(ordered.select(*[F.col("t")[i].alias(c) for i, c in enumerate("abc")]))


def triangle_count(graph: Graph) -> DataFrame:
    """``(id, triangles)``: in how many triangles each vertex is; vertices in none are left out."""
    with closed(graph) as found:
        return runtime.cut(_per_vertex(found.common, F.size("third"), F.size("third"), F.lit(1), "triangles"))


def linked_neighbours(found: Closed, directed: bool) -> DataFrame:
    """``(id, links)``: directed edges among the neighbours of each vertex, a mutual pair counting two.

    In each triangle a vertex gains the edges between the other two corners. Needs kind ``mutual`` of a
    directed graph; in an undirected one every pair is mutual.
    """
    size = F.size("third")
    if not directed:
        return _per_vertex(found.common, 2 * size, 2 * size, F.lit(2), "links")
    between = F.when(F.col("out") & F.col("back"), F.lit(2)).otherwise(F.lit(1))
    return _per_vertex(found.common, size + F.size("v_mutual"), size + F.size("u_mutual"), between, "links")


def _per_vertex(common: DataFrame, at_u: Column, at_v: Column, at_third: Column, name: str) -> DataFrame:
    """Sum per vertex what the triangles of each row give to u, to v and to each third vertex."""

    def part(id: Column, count: Column) -> Column:
        return F.struct(id.alias("id"), count.cast("long").alias("count"))

    pair = F.array(part(F.col("u"), at_u), part(F.col("v"), at_v))
    parts = F.concat(pair, F.transform("third", lambda w: part(w, at_third)))
    return common.select(F.inline(parts)).groupBy("id").agg(F.sum("count").alias(name))


def corner_edges(graph: Graph) -> DataFrame:
    """``(id, src, dst)``: for each corner of each triangle, the directed edges between the other two.

    The lists carry the direction of each link, so no triangle is joined back to the edges, where a pair
    of hubs with very many triangles would gather them all.
    """
    with closed(graph, ("out", "back")) as found:

        def rows(thirds: str, id: str, src: str, dst: str) -> Column:
            return F.transform(
                thirds,
                lambda w: F.struct(
                    *[(w if c == "w" else F.col(c)).alias(n) for n, c in (("id", id), ("src", src), ("dst", dst))]
                ),
            )

        none = F.slice("third", 1, 0)
        present = found.common.withColumns(
            {
                "pair_out": F.when(F.col("out"), F.col("third")).otherwise(none),
                "pair_back": F.when(F.col("back"), F.col("third")).otherwise(none),
            }
        )
        turns = F.concat(
            rows("pair_out", "w", "u", "v"),
            rows("pair_back", "w", "v", "u"),
            rows("u_out", "v", "u", "w"),
            rows("u_back", "v", "w", "u"),
            rows("v_out", "u", "v", "w"),
            rows("v_back", "u", "w", "v"),
        )
        return runtime.planned(present.select(F.inline(turns)))

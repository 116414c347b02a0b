"""The graph: two DataFrames and a direction flag."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, IntegralType, NumericType, StringType
from pyspark.storagelevel import StorageLevel

from weftgraph.operators.runtime import cut, hold


@dataclass(frozen=True)
class Graph:
    """``vertices(id, ...)`` and ``edges(src, dst[, weight])``.

    With ``directed=False`` the edge table lists every edge in both directions, once each. The
    ``from_*`` constructors bring a table into that form; call the class itself only with tables
    that have it already. ``spanned`` says that the vertices are the ends of the edges and no more.
    """

    vertices: DataFrame
    edges: DataFrame
    directed: bool = True
    spanned: bool = False

    @classmethod
    def from_tables(
        cls,
        vertices: DataFrame,
        edges: DataFrame,
        directed: bool = True,
        *,
        id: str = "id",
        src: str = "src",
        dst: str = "dst",
        weight: str | None = None,
    ) -> Graph:
        """A graph of any two DataFrames.

        Every listed vertex is kept, isolated or not, and edge ends missing from ``vertices`` are
        added. ``weight`` names a numeric column; by default a column called ``weight`` is taken if
        there is one.
        """
        edges = _edge_table(edges, directed, src, dst, weight)
        ids = vertices.select(_key(vertices, id).alias("id")).unionByName(_ends(edges, directed))
        return cls(ids.distinct(), edges, directed)

    @classmethod
    def from_edges(
        cls,
        edges: DataFrame,
        directed: bool = True,
        *,
        src: str = "src",
        dst: str = "dst",
        weight: str | None = None,
    ) -> Graph:
        """A graph whose vertices are the ends of its edges."""
        edges = _edge_table(edges, directed, src, dst, weight)
        return cls(_ends(edges, directed).distinct(), edges, directed, True)

    @classmethod
    def from_listed(cls, edges: DataFrame, vertices: DataFrame | None = None) -> Graph:
        """An undirected graph of ``edges(src, dst[, weight])`` that list every edge in both directions already, once each."""
        edges = _edge_table(edges, True, "src", "dst", None)
        ids = _ends(edges, False)
        if vertices is not None:
            ids = vertices.select(_key(vertices, "id").alias("id")).unionByName(ids)
        return cls(ids.distinct(), edges, False, vertices is None)

    @property
    def weighted(self) -> bool:
        return "weight" in self.edges.columns

    def map_vertices(self, **columns: Column) -> Graph:
        """Set vertex columns from expressions over the vertex table."""
        return replace(self, vertices=self.vertices.withColumns(columns), spanned=False)

    def map_edges(self, **columns: Column) -> Graph:
        """Set edge columns from expressions over the edge table."""
        return replace(self, edges=self.edges.withColumns(columns), spanned=False)

    def unweighted(self) -> Graph:
        """The same graph without edge values."""
        return replace(self, edges=self.edges.select("src", "dst"))

    def symmetrise(self) -> Graph:
        """Add every edge reversed, keeping duplicates: a reciprocal pair is then listed twice.

        ``distinct_edges`` makes the result an undirected graph in the sense of this class.
        """
        return replace(self, edges=both_ways(self.edges), directed=False)

    def distinct_edges(self) -> Graph:
        """One row per (src, dst), the least of parallel ones by weight and then by the other columns."""
        rest = sorted((c for c in self.edges.columns if c not in ("src", "dst")), key=lambda c: c != "weight")
        if not rest:
            return replace(self, edges=self.edges.distinct())
        least = self.edges.groupBy("src", "dst").agg(F.min(F.struct(*rest)).alias("_least"))
        return replace(self, edges=least.select("src", "dst", "_least.*"))

    def checkpoint(self) -> Graph:
        """Write both tables to the checkpoint folder, so that later runs skip deriving them."""
        with self.held():
            return replace(self, vertices=cut(self.vertices), edges=cut(self.edges))

    @contextmanager
    def held(self) -> Iterator[Graph]:
        """Keep the edge table cached while the block runs, unless the caller has cached it."""
        ours = self.edges.storageLevel == StorageLevel.NONE
        if ours:
            hold(self.edges)
        try:
            yield self
        finally:
            if ours:
                self.edges.unpersist()

    def ends_written(self) -> Graph:
        """The graph without edge values, its edge table written to the checkpoint folder; vertices that are the ends of edges
        are taken from there.
        """
        edges = cut(self.edges.select("src", "dst"))
        vertices = _ends(edges, self.directed).distinct() if self.spanned else self.vertices
        return replace(self, vertices=vertices, edges=edges)

    @contextmanager
    def ends_held(self) -> Iterator[Graph]:
        """The graph without edge values, its edge table cached while the block runs, unless the caller has cached the edges."""
        if self.edges.storageLevel != StorageLevel.NONE:
            yield self.unweighted()
        else:
            with self.unweighted().held() as graph:
                yield graph


def both_ways(edges: DataFrame) -> DataFrame:
    """Each row and its reverse, from one pass over the table."""
    rest = [c for c in edges.columns if c not in ("src", "dst")]
    ends = F.array(
        F.struct(F.col("src").alias("src"), F.col("dst").alias("dst")),
        F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")),
    )
    return edges.select(F.inline(ends), *rest)


def _key(frame: DataFrame, name: str) -> Column:
    """A vertex id. One that is missing or no whole number fails the job rather than meeting another vertex."""
    value, kind = F.col(name), frame.schema[name].dataType
    if isinstance(kind, (FloatType, DoubleType, DecimalType)):
        # try_cast gives null beyond the range of ids, and so does a fraction.
        whole = value.try_cast("long")
        id = F.when(whole.cast(kind) == value, whole)
    elif isinstance(kind, (IntegralType, StringType)):
        id = F.when(value.rlike(r"^\s*[+-]?\d+\s*$"), value.try_cast("long")) if isinstance(kind, StringType) else value.cast("long")
    else:
        raise ValueError(f"vertex id column {name!r} must hold whole numbers, not {kind.simpleString()}")
    wrong = F.concat(F.lit(f"vertex id in column {name} is no whole number: "), value.cast("string"))
    return F.coalesce(id, F.raise_error(F.coalesce(wrong, F.lit(f"null vertex id in column {name}"))))


def _edge_table(edges: DataFrame, directed: bool, src: str, dst: str, weight: str | None) -> DataFrame:
    columns = [_key(edges, src).alias("src"), _key(edges, dst).alias("dst")]
    if weight is None and "weight" in edges.columns:
        weight = "weight"
    if weight is not None:
        kind = edges.schema[weight].dataType
        if not isinstance(kind, NumericType):
            raise ValueError(f"edge weight column {weight!r} must be numeric, not {kind.simpleString()}")
        value = F.coalesce(F.col(weight).cast("double"), F.raise_error(F.lit(f"null edge weight in column {weight}")))
        columns.append(value.alias("weight"))
    table = edges.select(*columns)
    return table if directed else _listed_both_ways(table)


def _listed_both_ways(edges: DataFrame) -> DataFrame:
    """One row per (src, dst) in each direction, however the input lists its undirected edges.

    Pairs are made unique while each is still one row, so the shuffle carries half of the result.
    """
    low, high = F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")
    if "weight" in edges.columns:
        pairs = edges.groupBy(low, high).agg(F.min("weight").alias("weight"))
    else:
        pairs = edges.select(low, high).distinct()
    ends = lambda src, dst: F.struct(F.col(src).alias("src"), F.col(dst).alias("dst"))
    ways = F.array_distinct(F.array(ends("src", "dst"), ends("dst", "src")))
    return pairs.select(F.inline(ways), *[c for c in pairs.columns if c not in ("src", "dst")])


def _ends(edges: DataFrame, directed: bool) -> DataFrame:
    # From the two columns that ``Graph.ends_held`` caches.
    edges = edges.select("src", "dst")
    if not directed:
        return edges.select(F.col("src").alias("id"))
    return edges.select(F.explode(F.array("src", "dst")).alias("id"))

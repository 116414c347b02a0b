"""Main text of web pages.

A page is read into blocks of text and compared with the page of the nearest path on its host: lines are aligned by
longest common subsequence, and those that both pages share are deleted. Where its markup says which parts are articles,
those that hold a line of the page's own are the main text, and shared lines within them are put back. Pages are paired by
paths and digests of their lines; lines are then aligned once for each two digests that meet, as hashes. Pages are read twice,
for the hashes and for the texts, since texts kept from the first time would be written to disk twice.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape
from os.path import commonprefix

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType

from weftgraph.llm import text as tx
from weftgraph.llm.mixing import ordered, summed
from weftgraph.operators.runtime import cut

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)"

#: Elements by what they mean for the main text.
_RAW = "script|style|textarea|title|noscript|iframe|xmp"
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
_CELLS = frozenset(["td", "th"])
_APART = frozenset("nav footer aside form head template svg button select menu dialog object audio video canvas".split())
_MAIN = ("article", "main")
_PAGE = frozenset("html body article main".split())
_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar form".split())
#: Words in class names and ids of parts that are not main text.
_CUES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent"
    " gdpr notice notification alert newsletter subscribe subscription signup login sidebar nav navbar navigation menu"
    " breadcrumb breadcrumbs footer comment comments commentlist disqus discussion respond reply replies share sharing"
    " social related recommended popup modal overlay widget pagination pager toolbar masthead search".split()
)

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Blocks:
    """Blocks of a page outside menus and the like, in page order, the names of the parts they are in, and their numbers."""

    texts: list[str]
    parts: list[str]
    numbers: list[int]

    def own(self) -> list[int] | None:
        """For each block the number of its article, or of its main part in a page that marks no article; 0 outside."""
        for part in _MAIN:
            if part in self.parts:
                return [n if own == part else 0 for own, n in zip(self.parts, self.numbers, strict=True)]
        return None

    def main(self) -> list[str] | None:
        own = self.own()
        return None if own is None else [text for text, n in zip(self.texts, own, strict=True) if n]


def _apart(tag: str, attributes: str, part: str) -> bool:
    """Whether an element holds something other than main text."""
    if tag in _APART or tag == "header" and part != "article":
        return True
    if not attributes.strip() or tag in _PAGE and part == "":
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name in ("class", "id") and not _CUES.isdisjoint(word.lower() for word in _NAME_WORD.findall(value)):
            return True
        if name == "role" and value.lower() in _ROLES or name == "hidden" and value.lower() != "until-found":
            return True
        if name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            return True
    return False


def blocks(html: str) -> Blocks:
    found = Blocks([], [], [])
    pieces: list[str] = []
    # Open elements: tag, whether inside a part to leave out, the part that the element is in, and its number.
    stack: list[tuple[str, bool, str, int]] = [("", False, "", 0)]
    entered = 0

    def end() -> None:
        text = " ".join(unescape("".join(pieces)).split())
        if text:
            found.texts.append(text)
            found.parts.append(stack[-1][2])
            found.numbers.append(stack[-1][3])
        pieces.clear()

    at = 0
    for token in _TOKEN.finditer(html):
        if token.start() > at and not stack[-1][1]:
            pieces.append(html[at : token.start()])
        at = token.end()
        closing, tag, attributes = token[2], token[3], token[4]
        if tag is None:
            closing, tag, attributes = token[5], token[6], token[7]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br" or tag in _CELLS:
            pieces.append(" ")
        if tag not in _INLINE and tag not in _CELLS:
            end()
        if tag in _VOID:
            continue
        if closing:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
            if depth:
                del stack[depth:]
        elif not attributes.endswith("/"):
            if tag not in _INLINE and stack[-1][0] == "p":
                stack.pop()
            _, apart, part, number = stack[-1]
            if not apart:
                apart = _apart(tag, attributes, part)
                if not apart and part != "article":
                    role = re.search(r"role\s*=\s*[\"']?(main|article)\b", attributes, re.IGNORECASE)
                    if tag in _MAIN or role:
                        part = tag if tag in _MAIN else role[1].lower()
                        number = entered = entered + 1
            if apart and tag in _INLINE or not (tag in _INLINE and attributes == ""):
                stack.append((tag, apart, part, number))
    if at < len(html) and not stack[-1][1]:
        pieces.append(html[at:])
    end()
    return found


def shared(lines: list, others: list) -> set[int]:
    """Places in ``lines`` of a longest common subsequence with ``others``."""
    places: dict[object, list[int]] = {}
    for i, line in enumerate(others):
        places.setdefault(line, []).append(i)
    ends: list[int] = []
    chains: list[tuple[int, tuple | None]] = []
    for i, line in enumerate(lines):
        for j in reversed(places.get(line, ())):
            k = bisect_left(ends, j)
            chain = (i, chains[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                chains.append(chain)
            else:
                ends[k], chains[k] = j, chain
    found: set[int] = set()
    chain = chains[-1] if chains else None
    while chain:
        found.add(chain[0])
        chain = chain[1]
    return found


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[Blocks], list[bytes], list[pa.Array]]]:
    """For each page its columns but the html, its blocks, their lines as one text, and a digest of that in two halves."""
    half = (1 << 64) - 1
    for whole in batches:
        for batch in tx.slices(whole, "_html"):
            found = [blocks(html) for html in batch.column("_html").to_pylist()]
            # Lines hold no line feed.
            texts = ["\n".join(page.texts).encode("utf-8", "surrogatepass") for page in found]
            names = [xxhash.xxh3_128_intdigest(text) for text in texts]
            signed = [(name >> 64) - (1 << 63) for name in names], [(name & half) - (1 << 63) for name in names]
            kept = batch.select([name for name in batch.schema.names if name != "_html"])
            yield kept, found, texts, [pa.array(part, pa.int64()) for part in signed]


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each page a hash of each line, and a digest of all."""
    for kept, found, _, digest in _parsed(batches):
        marks = [[xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) - (1 << 63) for x in page.texts] for page in found]
        yield pa.RecordBatch.from_arrays(
            [*kept.columns, pa.array(marks, pa.list_(pa.int64())), *digest], [*kept.schema.names, "_marks", "_high", "_low"]
        )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each page its lines, packed, which part they are in if its markup tells, and a digest of all."""
    for kept, found, texts, digest in _parsed(batches):
        lines = pa.array([zlib.compress(text) for text in texts], pa.binary())
        own = pa.array([page.own() for page in found], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([*kept.columns, lines, own, *digest], [*kept.schema.names, "_lines", "_own", "_high", "_low"])


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each row whether its lines are shared with the others', by a longest common subsequence."""
    names = ["_high", "_low", "_near_high", "_near_low"]
    for whole in batches:
        for i in range(whole.num_rows):
            batch = whole.slice(i, 1)
            lines, others = batch.column("_marks")[0].as_py(), batch.column("_others")[0].as_py()
            both = shared(lines, others)
            found = pa.array([[k in both for k in range(len(lines))]], pa.list_(pa.bool_()))
            yield pa.RecordBatch.from_arrays([*batch.select(names).columns, found], [*names, "_shared"])


def _kept(lines: list[str], own: list[int] | None, both: list[bool] | None) -> list[str]:
    """The lines not shared, or where markup tells the articles that hold such a line, or all of them if none does."""
    left = [True] * len(lines) if both is None else [not x for x in both]
    if own is not None:
        parts = {n for n, x in zip(own, left, strict=True) if n and x}
        left = [n in parts if parts else n > 0 for n in own]
    return [line for line, x in zip(lines, left, strict=True) if x]


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of each page, in batches of bounded size."""
    for batch in batches:
        begin, size, texts = 0, 0, []
        columns = [batch.column(name) for name in ("_lines", "_own", "_shared")]
        for end in range(1, batch.num_rows + 1):
            packed, own, both = (column[end - 1].as_py() for column in columns)
            text = zlib.decompress(packed).decode("utf-8", "surrogatepass")
            texts.append("\n".join(_kept(text.split("\n") if text else [], own, both)))
            size += len(texts[-1])
            if size >= tx.SLICE_BYTES or end == batch.num_rows:
                some = batch.select(["_page", "_url"]).slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(texts, pa.string())], ["_page", "_url", "_text"])
                begin, size, texts = end, 0, []


@F.pandas_udf(IntegerType())
def _in_common(paths: pd.Series, others: pd.Series) -> pd.Series:
    """Characters that two paths begin with in common; -1 if there is no other path."""
    pairs = zip(paths, others, strict=True)
    return pd.Series([-1 if other is None else len(commonprefix([path, other])) for path, other in pairs], dtype="int32")


def nearest(found: DataFrame) -> DataFrame:
    """``_host, _path, _page, _high, _low`` of pages and the digest ``_near_high, _near_low`` to compare with.

    Pages with a host and lines are put in one global order. Those of one digest in a row are a run, and a page of a run
    has two neighbours, the last page of the run before and the first of the run after, if they are on its host.
    """
    keys, name = ["_host", "_path", "_page"], ["_high", "_low"]
    narrow = found.filter((F.size("_marks") > 0) & F.col("_host").isNotNull())
    narrow = narrow.select(*keys, *name).distinct()
    line = summed(ordered(narrow, *[F.col(x) for x in (*keys, *name)]), F.lit(1)).withColumnRenamed("_before", "_place")
    line = cut(line)
    last = line.select((F.col("_place") + 1).alias("_place"), F.struct("_host", *name).alias("_last"))
    changes = (~F.col("_last").eqNullSafe(F.struct("_host", *name))).cast("long")
    line = line.join(last, "_place", "left").withColumn("_new", changes).drop("_last")
    line = cut(summed(line, F.col("_new")).withColumn("_run", F.col("_before") + F.col("_new")).drop("_before", "_new"))
    runs = line.groupBy("_run").agg(
        F.first("_host").alias("_host"),
        F.first("_high").alias("_high"),
        F.first("_low").alias("_low"),
        F.min_by("_path", "_place").alias("_begin"),
        F.max_by("_path", "_place").alias("_end"),
    )
    runs = cut(runs)
    beside = lambda step, path: runs.select(
        (F.col("_run") + step).alias("_run"), "_host", F.struct(F.col(path).alias("path"), *name).alias(path)
    )
    rows = line.join(beside(1, "_end"), ["_run", "_host"], "left").join(beside(-1, "_begin"), ["_run", "_host"], "left")
    before, after = _in_common("_path", F.col("_end.path")), _in_common("_path", F.col("_begin.path"))
    rows = rows.withColumn("_near", F.when(before >= after, F.col("_end")).otherwise(F.col("_begin"))).filter("_near is not null")
    return cut(rows.select(*keys, *name, F.col("_near._high").alias("_near_high"), F.col("_near._low").alias("_near_low")))


def extract(pages: DataFrame, *, page: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page``, ``url``, ``text`` for each row: the main text, its blocks joined by line feeds.

    Menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts and styles are left out by their
    elements, roles and names. Pages are sorted by host, path, page id and a digest of their lines, and each loses the lines
    that it shares with the one before or after it on its host, whichever path has more of its beginning in common (the one
    before if equal); neighbours with the very same lines or none are passed over. If the page marks articles, or else main
    parts, those that hold a line not lost are taken whole, or all of them if none does, and nothing else is. The result does not depend on how the pages are partitioned. Null and
    empty pages have an empty text; a page without a host is not compared. Page ids may be of any type that sorts. Repeated
    rows are kept, other columns ignored, and no rows give no rows.
    """
    host = F.lower(F.nullif(F.regexp_extract(F.col("_url"), _HOST, 1), F.lit("")))
    source = pages.select(F.col(page).alias("_page"), F.col(url).alias("_url"), F.coalesce(html, F.lit("")).alias("_html")).select(
        "*", host.alias("_host"), F.coalesce(F.regexp_extract("_url", _PATH, 1), F.lit("")).alias("_path")
    )
    kind = source.schema["_page"].dataType.simpleString()
    kept = f"_page {kind}, _url string, _host string, _path string"
    found = cut(source.drop("_url").mapInArrow(_marked, f"_page {kind}, _host string, _path string, _marks array<long>, _high long, _low long"))
    near, name, other = nearest(found), ["_high", "_low"], ["_near_high", "_near_low"]
    marks = found.groupBy(*name).agg(F.first("_marks").alias("_marks"))
    pairs = near.select(*name, *other).distinct().join(marks, name).join(marks.toDF(*other, "_others"), other)
    shares = pairs.mapInArrow(_aligned, "_high long, _low long, _near_high long, _near_low long, _shared array<boolean>")
    # Pages are read into texts again, so that those are written once only, packed, in the shuffle to what is shared.
    texts = source.mapInArrow(_packed, f"{kept}, _lines binary, _own array<int>, _high long, _low long")
    keys = ["_host", "_path", "_page", *name]
    shares = near.join(shares, [*name, *other]).select(*keys, "_shared")
    same = [F.col(f"l.{x}").eqNullSafe(F.col(f"r.{x}")) for x in keys]
    rows = texts.alias("l").join(shares.alias("r"), same, "left")
    rows = rows.select("l._page", "l._url", "l._lines", "l._own", "r._shared").mapInArrow(_written, f"_page {kind}, _url string, _text string")
    return rows.toDF(page, url, "text")

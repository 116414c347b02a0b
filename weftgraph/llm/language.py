"""Language of a text by cross-parsing entropy.

A suffix automaton of each language's labelled text reads a text in the longest phrases that occur there. The
fewer phrases, each worth the logarithm of the labelled text's length, the closer the language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from weftgraph.llm import text as tx
from weftgraph.llm.columns import named, numbered
from weftgraph.operators.runtime import cut

SAMPLE_SYMBOLS = 120_000
"""Symbols of labelled text to learn from, shared evenly by the languages."""
SAMPLE_TEXT = 2_000
"""Texts of up to this many characters are learnt from, or any where a language has none."""
SAMPLE_TEXTS = 400
"""Texts of a language, about, from which its share is filled in order of a hash."""
MOST_LETTERS = 62
PIECE = 256
"""Symbols after which a phrase always ends, so that parts of a long text are read side by side."""
FOLDS, HELD_OUT = 3, 1
UNDETERMINED = "und"


@cache
def _is_letter() -> np.ndarray:
    found = np.zeros(0x110000, bool)
    found[[point for point in range(0x110000) if chr(point).isalpha()]] = True
    return found


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of lower-cased texts, zero for what is not a letter, and the bounds of texts in them."""
    lowered = [text.lower() for text in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(_is_letter()[points], points, 0), np.concatenate([[0], np.cumsum([len(x) for x in lowered])])


def _single_gaps(points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without runs of gaps, and gaps at the start of texts."""
    kept = points != 0
    kept[1:] |= points[:-1] != 0
    kept[bounds[:-1][bounds[:-1] < len(points)]] &= points[bounds[:-1][bounds[:-1] < len(points)]] != 0
    return points[kept], np.concatenate([[0], np.cumsum(kept)])[bounds]


def suffix_automaton(symbols: list[int], size: int) -> np.ndarray:
    """Transitions by ``state * size + symbol``. Where there is none, the complement of the root's transition."""
    links, lengths, nexts = [-1], [0], [{}]
    last = 0
    for symbol in symbols:
        new = len(nexts)
        links.append(0)
        lengths.append(lengths[last] + 1)
        nexts.append({})
        at = last
        while at >= 0 and symbol not in nexts[at]:
            nexts[at][symbol] = new
            at = links[at]
        if at >= 0:
            to = nexts[at][symbol]
            if lengths[to] == lengths[at] + 1:
                links[new] = to
            else:
                copy = len(nexts)
                links.append(links[to])
                lengths.append(lengths[at] + 1)
                nexts.append(dict(nexts[to]))
                while at >= 0 and nexts[at].get(symbol) == to:
                    nexts[at][symbol] = copy
                    at = links[at]
                links[to] = links[new] = copy
        last = new
    root = np.zeros(size, np.int32)
    for symbol, to in nexts[0].items():
        root[symbol] = to
    table = np.tile(~root, (len(nexts), 1))
    for state, steps in enumerate(nexts):
        for symbol, to in steps.items():
            table[state, symbol] = to
    # A symbol that the language lacks is a phrase of its own.
    table[0, [symbol for symbol in range(size) if symbol not in nexts[0]]] = -1
    return table.reshape(-1)


@dataclass
class LanguageModel:
    letters: list[int]
    languages: list[str]
    tables: list[np.ndarray]
    costs: list[float]

    @property
    def size(self) -> int:
        return len(self.letters) + 2

    def symbols(self, points: np.ndarray) -> np.ndarray:
        """0 for gaps, then the letters, and one symbol for all letters not learnt."""
        numbers = np.full(0x110000, self.size - 1, np.uint8)
        numbers[0] = 0
        numbers[self.letters] = np.arange(1, len(self.letters) + 1)
        return numbers[points]

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits of a symbol by text and language, and whether a text has letters."""
        points, bounds = _single_gaps(*_points(texts))
        symbols, lengths = self.symbols(points).astype(np.int32), np.diff(bounds)
        pieces = -(-lengths // PIECE)
        text = np.repeat(np.arange(len(texts)), pieces)
        inside = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = bounds[text] + inside * PIECE
        length = np.minimum(PIECE, bounds[text + 1] - begin)
        order = np.argsort(-length, kind="stable")
        text, begin, length = text[order], begin[order], length[order]
        running = np.searchsorted(-length, -np.arange(PIECE), "left")
        bits = np.zeros((len(texts), len(self.tables)))
        for language, (table, cost) in enumerate(zip(self.tables, self.costs, strict=True)):
            state, phrases = np.zeros(len(text), np.int32), np.ones(len(text), np.int32)
            for step in range(int(length[0]) if len(length) else 0):
                n = running[step]
                to = table[state[:n] * np.int32(self.size) + symbols[begin[:n] + step]]
                broken = to >> 31
                phrases[:n] -= broken
                state[:n] = to ^ broken
            found = np.bincount(text, phrases, len(texts)) * cost
            bits[:, language] = found / np.maximum(lengths, 1)
        return bits, np.bincount(text, minlength=len(texts)) > 0

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        bits, lettered = self.entropies(texts)
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        best = bits.argmin(axis=1)
        least = bits[np.arange(len(texts)), best]
        if len(self.languages) > 1:
            second = np.partition(bits, 1, axis=1)[:, 1]
            score = np.where(lettered, 1 - least / np.maximum(second, 1e-12), 0.0)
        else:
            score = lettered.astype(float)
        names = [self.languages[i] if known else UNDETERMINED for i, known in zip(best, lettered, strict=True)]
        return names, np.clip(score, 0.0, 1.0)


def held_out(doc: str):
    return F.crc32(F.col(doc).cast("string")) % FOLDS == HELD_OUT


def fit(
    docs: DataFrame,
    *,
    doc: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample_symbols: int = SAMPLE_SYMBOLS,
    sample_text: int = SAMPLE_TEXT,
    sample_texts: int = SAMPLE_TEXTS,
) -> LanguageModel:
    """Learn from a bounded sample of the labelled documents that are not held out; equal texts count once."""
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~F.coalesce(held_out(doc), F.lit(False)))
    known = known.select(
        F.col(lang).alias("_lang"),
        F.col(text).alias("_text"),
        (F.length(text) > sample_text).alias("_long"),
        F.pmod(F.xxhash64(text), F.lit(1 << 30)).alias("_hash"),
    )
    # One row for each language.
    counts = cut(known.groupBy("_lang").agg(F.count_if(~F.col("_long")).alias("_short"), F.count(F.lit(1)).alias("_all")))
    share = F.least(F.lit(1.0), sample_texts / F.greatest(F.lit(1), F.when(F.col("_short") > 0, F.col("_short")).otherwise(F.col("_all"))))
    sample = (
        known.join(F.broadcast(counts), "_lang")
        .filter((~F.col("_long") | (F.col("_short") == 0)) & (F.col("_hash") < share * (1 << 30)))
        .select("_lang", "_hash", "_text")
        .distinct()
        .toPandas()
        .sort_values(["_lang", "_hash", "_text"])
    )
    languages = sorted(sample["_lang"].unique())
    read = {}
    for language in languages:
        points, bounds = _points([f"{text_} " for text_ in sample.loc[sample["_lang"] == language, "_text"]])
        read[language] = _single_gaps(points, np.array([0, len(points)]))[0][: sample_symbols // len(languages)]
    languages = [language for language in languages if len(read[language])]
    seen, times = np.unique(np.concatenate([read[x] for x in languages] or [np.zeros(0, np.uint32)]), return_counts=True)
    letters = [int(x) for x in seen[np.lexsort((seen, -times))] if x][:MOST_LETTERS]
    model = LanguageModel(letters, languages, [], [])
    for language in languages:
        symbols = model.symbols(read[language])
        model.tables.append(suffix_automaton(symbols.tolist(), model.size))
        model.costs.append(float(np.log2(len(symbols) + 1)))
    return model


def predict(docs: DataFrame, model: LanguageModel, *, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the language of each whole text and a score from 0 to 1: how much dearer the second is.

    A text that is null or has no letter is ``und`` with score 0. Rows and columns stay, but for columns of the two new names.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.letters, model.languages, model.tables, model.costs))
    (source, names), place = numbered(docs), docs.columns.index(text)
    columns = [*source.columns, lang, score]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = LanguageModel(*shared.value)
        for whole in batches:
            whole = whole.rename_columns([str(i) for i in range(whole.num_columns)])
            for batch in tx.slices(whole, str(place)):
                found, scores = ready.predict([x or "" for x in batch.column(place).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(found, pa.string()), pa.array(scores)], columns
                )

    more = [T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())]
    return named(source.mapInArrow(rows, T.StructType([*source.schema.fields, *more])), names, lang, score)

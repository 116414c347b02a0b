"""Toxic documents, also where words are disguised.

A noisy-channel decoder reads words written with look-alike characters, spread letters or repeated letters as
lattices of letters, and takes the most likely path under a trigram model of the corpus's letters. The restored
text is scored by words and beginnings of words that labelled documents show to be toxic.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from weftgraph.llm import text as tx
from weftgraph.llm.columns import named, numbered
from weftgraph.operators.runtime import cut

TRAINING_DOCS = 20_000
"""Labelled documents to learn from, about, chosen by a hash of their ids; all of them where there are fewer."""
FOLDS, HELD_OUT = 5, 0
PREFIXES = (5, 6, 7)
PRIOR_WEIGHT = 4.0
LEAST_DOCS = 3
SURE = 0.9

#: Letters of the character model, a boundary for all else.
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿßœ"
#: What look-alike characters may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "¢": "c", "*": "aeiou",
    "а": "a", "е": "e", "о": "o", "і": "i", "с": "c", "р": "p", "х": "x", "у": "y",
}
SEPARATORS = " .-_"
_INVISIBLE = dict.fromkeys(map(ord, "­​‌‍⁠﻿"))

_SIZE = len(LETTERS) + 1
_NUMBER = {letter: i + 1 for i, letter in enumerate(LETTERS)}
_LIKE = "".join(map(re.escape, LOOKALIKES))
_WORD = re.compile(r"[^\W\d_]+")
#: A token with a look-alike beside letters, single letters spread by signs, or a letter three times.
_DISGUISED = re.compile(
    rf"[{_LIKE}][^\W\d_]|[^\W\d_][0-9@]|([^\W\d_])\1\1|(?<!\w)[^\W_](?:[{re.escape(SEPARATORS)}][^\W_]){{2,}}(?!\w)"
)
#: Tokens of one character, one blank apart.
_SPREAD = re.compile(r"(?<!\S)[^\W_](?: [^\W_]){2,}(?!\S)")
_REPEATED = re.compile(r"(.)\1+")
_AROUND = ".,;:?!\"'()[]{}<>#%&*~^=/\\"


def _symbols(text: str) -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for letter, number in _NUMBER.items():
        table[ord(letter)] = number
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    return table[points].astype(np.int64)


def character_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log probabilities of a letter, or a boundary, after two others, counted over all of ``docs``."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SIZE**3, np.int64)
        for whole in batches:
            for batch in tx.slices(whole, "_text"):
                s = np.concatenate([[0, 0], _symbols("\n".join(batch.column("_text").to_pylist())), [0]])
                total += np.bincount((s[:-2] * _SIZE + s[1:-1]) * _SIZE + s[2:], minlength=_SIZE**3)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["gram", "n"])

    source = docs.select(F.coalesce(text, F.lit("")).alias("_text"))
    # At most one row for each three letters of the alphabet.
    table = source.mapInArrow(counts, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    grams = np.zeros(_SIZE**3)
    grams[table["gram"].to_numpy(np.int64)] = table["n"].to_numpy(np.float64)
    grams = grams.reshape(_SIZE, _SIZE, _SIZE)
    grams[:, 0, 0] = 0  # a boundary follows a letter
    pairs = grams.sum(axis=0)
    one = (pairs.sum(axis=0) + 1) / (pairs.sum() + _SIZE)
    two = (pairs + 20 * one) / (pairs.sum(axis=1, keepdims=True) + 20)
    return np.log((grams + 20 * two[None]) / (grams.sum(axis=2, keepdims=True) + 20))


class Decoder:
    """Restores disguised words. ``model`` as from ``character_model``."""

    def __init__(self, model: np.ndarray, cached: int = 100_000):
        self._model, self._known, self._cached = model.tolist(), {}, cached
        # Letters cost about as much as they do on average, or else the shortest reading would always win.
        self._gain = 2.3

    def __call__(self, token: str) -> str:
        found = self._known.get(token)
        if found is None:
            if len(self._known) >= self._cached:
                self._known.clear()
            found = self._known[token] = self._decode(token)
        return found

    def _lattice(self, token: str) -> list[list[str]]:
        """For each run of a character, the strings it may stand for."""
        steps: list[list[str]] = []
        for match in re.finditer(r"(.)\1*", token, re.DOTALL):
            run, char = len(match[0]), match[1]
            if char in SEPARATORS:
                steps.append(["", " "])
                continue
            letters = LOOKALIKES.get(char, char if char in _NUMBER else "")
            steps.append([letter * n for letter in letters for n in ((1, 2) if run > 1 else (1,))] or [" "])
        return steps

    def _decode(self, token: str) -> str:
        states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
        for options in [*self._lattice(token), [" "]]:
            after: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (score, read) in states.items():
                for option in options:
                    x, y, total = a, b, score
                    for letter in option:
                        number = _NUMBER.get(letter, 0)
                        if number or y:
                            total += self._model[x][y][number] + self._gain
                            x, y = y, number
                    if (x, y) not in after or after[x, y][0] < total:
                        after[x, y] = (total, read + option)
            states = after
        return max(states.values())[1].strip()


def _tokens(text: str | None) -> set[str]:
    """Distinct tokens of a text, and its runs of spread letters."""
    text = (text or "").lower()
    if not text.isascii():
        text = text.translate(_INVISIBLE)
    return {*text.split(), *(match[0] for match in _SPREAD.finditer(text))}


def _words(token: str, decoder: Decoder) -> list[str]:
    """Words of a token, as written and restored."""
    words = _WORD.findall(token)
    if _DISGUISED.search(token) or " " in token:
        read = decoder(token.rstrip(_AROUND).lstrip(_AROUND.replace("!", "")))
        joined = read.replace(" ", "")
        words += [*read.split(), joined, _REPEATED.sub(r"\1", joined)]
    return words


def _features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in PREFIXES if n <= len(word))]


@dataclass
class ToxicityModel:
    """Chances that a text with a word, or a word's beginning (``abcd*``), is toxic, and what they weigh together."""

    chances: dict[str, float]
    characters: np.ndarray
    weights: tuple[float, ...] = (0.0,) * 3
    cached: int = 300_000

    def __post_init__(self):
        self._decoder = Decoder(self.characters)
        self._known: dict[str, float] = {}

    def _odds(self, token: str) -> float:
        chance = max((self.chances.get(f, 0.0) for w in _words(token, self._decoder) for f in _features(w)), default=0.0)
        return float(np.log(chance / (1 - chance))) if chance > 0.5 else 0.0

    def evidence(self, text: str | None) -> tuple[float, float, float]:
        """One, the highest log odds of a token, and the logarithm of their sum."""
        most = total = 0.0
        for token in _tokens(text):
            found = self._known.get(token)
            if found is None:
                if len(self._known) >= self.cached:
                    self._known.clear()
                found = self._known[token] = self._odds(token)
            if found:
                most = max(most, found)
                total += found
        return 1.0, most, float(np.log1p(total))

    def score(self, text: str | None) -> float:
        x = sum(w * e for w, e in zip(self.weights, self.evidence(text), strict=True))
        return float(1 / (1 + np.exp(-min(max(x, -30.0), 30.0))))


def held_out(doc: str):
    return F.crc32(F.col(doc).cast("string")) % FOLDS == HELD_OUT


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    training_docs: int = TRAINING_DOCS,
) -> ToxicityModel:
    """Learn from ``labels(doc, label)`` of documents that are not held out; letters from all documents.

    Rows of ``labels`` without an id or label are left out, equal texts count once, and ids with both labels
    count as toxic. Without labels every text scores the same.
    """
    characters = character_model(docs, text)
    spark = docs.sparkSession
    known = (
        labels.filter(F.col(doc).isNotNull() & F.col(label).isNotNull() & ~held_out(doc))
        .groupBy(F.col(doc).alias("_doc"))
        .agg(F.max(F.col(label).cast("int")).alias("_label"))
    )
    number = known.count()
    if number > training_docs:
        known = known.filter(F.pmod(F.xxhash64("_doc"), F.lit(1 << 20)) < F.lit(int((1 << 20) * training_docs / number)))
    rows = docs.select(F.col(doc).alias("_doc"), F.coalesce(text, F.lit("")).alias("_text")).join(known, "_doc")
    shared = spark.sparkContext.broadcast(characters)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        seen: dict[tuple[str, int], list[int]] = {}

        def made() -> pa.RecordBatch:
            values = [[k[0] for k in seen], [k[1] for k in seen], [n[0] for n in seen.values()], [n[1] for n in seen.values()]]
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(values, kinds, strict=True)], ["feature", "half", "clean", "toxic"]
            )

        for batch in batches:
            for row in batch.to_pylist():
                words = {w for token in _tokens(row["_text"]) for w in _words(token, decoder)}
                for feature in {"", *(f for word in words for f in _features(word))}:
                    seen.setdefault((feature, row["_half"]), [0, 0])[row["_label"] > 0] += 1
                if len(seen) > 200_000:
                    yield made()
                    seen = {}
        yield made()

    half = F.pmod(F.xxhash64("_text"), F.lit(2)).cast("int").alias("_half")
    once = cut(
        rows.groupBy(F.xxhash64("_text").alias("_key"), half)
        .agg(F.max("_label").alias("_label"), F.first("_text").alias("_text"))
        .select("_half", "_label", "_text")
    )
    counted = (
        once.mapInArrow(features, "feature string, half int, clean long, toxic long")
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .filter(f"feature != '' and toxic >= {LEAST_DOCS} and toxic > clean")
        .toPandas()
    )
    candidates = spark.sparkContext.broadcast(({f: i for i, f in enumerate(sorted(counted["feature"]))}, characters))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, decoder = candidates.value[0], Decoder(candidates.value[1])
        for batch in batches:
            found = []
            for text_ in batch.column("_text").to_pylist():
                words = {w for token in _tokens(text_) for w in _words(token, decoder)}
                found.append(sorted({numbers[f] for word in words for f in _features(word) if f in numbers}))
            kept = [pa.array(found, pa.list_(pa.int32())), batch.column("_half"), batch.column("_label")]
            yield pa.RecordBatch.from_arrays(kept, ["held", "half", "label"])

    # Rows of the bounded sample, without their texts.
    sample = once.mapInArrow(held, "held array<int>, half int, label int").toPandas()
    if sample.empty:
        return ToxicityModel({}, characters, (-30.0, 0.0, 0.0))
    names = sorted(counted["feature"])

    def chances(part) -> dict[str, float]:
        return _explained(names, [list(x) for x in part["held"]], (part["label"] > 0).to_numpy())

    # One half shows what words tell, the other how to weigh it.
    first = spark.sparkContext.broadcast((chances(sample[sample["half"] == 0]), characters))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = ToxicityModel(*first.value)
        for batch in batches:
            found = np.array([ready.evidence(x.as_py()) for x in batch.column("_text")]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[:, i]) for i in range(3)] + [batch.column("_label")], ["a", "b", "c", "label"]
            )

    known = once.filter("_half = 1").mapInArrow(told, "a double, b double, c double, label int").toPandas()
    weights = _logistic(known[["a", "b", "c"]].to_numpy(), (known["label"] > 0).to_numpy(float))
    return ToxicityModel(chances(sample), characters, tuple(weights.tolist()))


def _explained(names: list[str], held: list[list[int]], toxic: np.ndarray) -> dict[str, float]:
    """Features and their chances: the sure ones, and of the others those that hold among texts without a sure one.

    So words that merely stand beside a toxic one, as in copies of one text, tell nothing.
    """
    texts = np.repeat(np.arange(len(held)), [len(x) for x in held])
    features = np.array([i for x in held for i in x], np.int64)

    def among(left: np.ndarray) -> np.ndarray:
        kept = left[texts]
        bad = np.bincount(features[kept & toxic[texts]], minlength=len(names))
        every = np.bincount(features[kept], minlength=len(names))
        prior = toxic[left].mean() if left.any() else 0.0
        return np.where(bad < LEAST_DOCS, 0.0, (bad + PRIOR_WEIGHT * prior) / (every + PRIOR_WEIGHT))

    chance = among(np.ones(len(held), bool))
    sure = chance >= SURE
    left = np.ones(len(held), bool)
    left[texts[sure[features]]] = False
    chance = np.where(sure, chance, among(left))
    return {name: float(c) for name, c in zip(names, chance, strict=True) if c > 0.5}


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 30) -> np.ndarray:
    """Weights of a logistic regression, by Newton's method; evidence never weighs less than nothing."""
    used = list(range(x.shape[1]))
    while True:
        z, w = x[:, used], np.zeros(len(used))
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            hessian = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
            w = w + np.linalg.solve(hessian, z.T @ (y - p) - ridge * w)
        if len(used) == 1 or w[1:].min() >= 0:
            weights = np.zeros(x.shape[1])
            weights[used] = w
            return weights
        used.pop(1 + int(w[1:].argmin()))


def score(docs: DataFrame, model: ToxicityModel, *, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1; rows and columns stay, but for one called ``name``; null and empty texts get the lowest score."""
    source, names = numbered(docs)
    shared = docs.sparkSession.sparkContext.broadcast((model.chances, model.characters, model.weights))
    place = docs.columns.index(text)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = ToxicityModel(*shared.value)
        for batch in batches:
            scores = pa.array([ready.score(x.as_py()) for x in batch.column(place)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, name])

    scored = source.mapInArrow(rows, T.StructType([*source.schema.fields, T.StructField(name, T.DoubleType())]))
    return named(scored, names, name)


def drop_toxic(docs: DataFrame, labels: DataFrame, *, text: str = "text", least: float = 0.5, **options) -> DataFrame:
    """The documents that score below ``least``, with all their columns."""
    name = "_toxicity"
    while name in docs.columns:
        name += "_"
    model = fit(docs, labels, text=text, **options)
    return score(docs, model, text=text, name=name).filter(F.col(name) < least).drop(name)

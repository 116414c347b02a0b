"""Licence notices in documents, by DataFrame operations only.

Each paragraph is classified by a sparse logistic regression over its words and word pairs into licence families or
unknown. The bar for a family is set on paragraphs held out of training, so that unknown ones seldom pass, and a
prediction counts only if a template of its family agrees with the paragraph.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weftgraph.llm.mixing import ordered, summed
from weftgraph.operators.runtime import cut

#: Notices by which licences are known, by family.
TEMPLATES = {
    "AGPL": (
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "BSD": (
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC0": ("To the extent possible under law, the author has waived all copyright and related rights to this work, CC0.",),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This work is licensed under the GNU General Public License, version 2.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files, to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}
MISTAKEN = 0.001
"""Share of unknown paragraphs that may pass the bar."""
AGREEMENT = 0.8
"""Share of a template's word pairs that a paragraph must hold, or of the paragraph's that the template holds."""
_PARTS = 3

_FAMILIES = sorted(TEMPLATES)


def _pairs(words: str) -> Column:
    """Pairs of words in a row; null where one of them is."""
    n = F.greatest(F.lit(0), F.size(words) - 1)
    ends = F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n)
    return F.zip_with(*ends, lambda a, b: F.concat(a, F.lit(" "), b))


def _once(rows: DataFrame, **column: Column) -> DataFrame:
    """``rows`` with a column that is made once a row, however often a filter reads it: none is pushed below an ``explode``."""
    ((name, value),) = column.items()
    return rows.select("*", F.explode(F.array(value)).alias(name))


def _with_words(lines: DataFrame) -> DataFrame:
    return _once(lines, _words=F.regexp_extract_all(F.lower("_line"), F.lit("[a-z0-9]+"), 0))


def _with_grams(lines: DataFrame) -> DataFrame:
    lines = _once(_with_words(lines), _pairs=F.array_distinct(_pairs("_words")))
    return lines.withColumn("_grams", F.concat("_words", "_pairs"))


def _with_known_grams(lines: DataFrame, vocabulary: list[str]) -> DataFrame:
    """``lines`` with those of their ``_pairs`` and ``_grams`` that the vocabulary may hold."""
    single = [gram for gram in vocabulary if " " not in gram]
    lines = _once(_with_words(lines), _known=F.transform("_words", lambda word: F.when(word.isin(single), word)))
    lines = _once(lines, _pairs=F.array_distinct(F.array_compact(_pairs("_known"))))
    return lines.withColumn("_grams", F.concat(F.array_compact("_known"), "_pairs"))


def _with_few(lines: DataFrame, held: list) -> DataFrame:
    """``lines`` with ``_few``, the number of different pairs of a paragraph hardly longer than a template, else null.

    Only of such a paragraph can nearly all pairs be the template's.
    """
    lines = _once(lines, _few=F.size(F.array_distinct(_pairs("_words"))))
    longest = max(len(row["_pairs"]) for row in held)
    return lines.withColumn("_few", F.when(F.col("_few") * AGREEMENT <= longest, F.col("_few")))


def _least(pairs: Collection[str]) -> float:
    """Pairs of a template that an agreeing paragraph holds at least: a share of them, or of five or more of its own."""
    return AGREEMENT * min(len(pairs), 5)


def _templates(spark: SparkSession) -> DataFrame:
    rows = [(i, text) for i, family in enumerate(_FAMILIES) for text in TEMPLATES[family]]
    literals = [F.struct(F.lit(n).alias("_at"), F.lit(i + 1.0).alias("label"), F.lit(text).alias("_line")) for n, (i, text) in enumerate(rows)]
    return spark.range(1).select(F.inline(F.array(*literals)))


def _agreement(templates: list, size: Column | None = None) -> Column:
    """How far a paragraph of ``size`` different pairs agrees with the closest template of each family, by class."""
    size = F.size("_pairs") if size is None else size

    def one(pairs: list[str]) -> Column:
        common = F.size(F.array_intersect(F.col("_pairs"), F.array(*map(F.lit, pairs))))
        quoted = F.when(size >= 5, common / size).otherwise(F.lit(0.0))
        return F.greatest(common / F.lit(len(pairs)), quoted)

    by_class: dict[float, list[Column]] = {}
    for row in templates:
        by_class.setdefault(row["label"], []).append(one(row["_pairs"]))
    best = [F.greatest(*found, F.lit(0.0)) for _, found in sorted(by_class.items())]
    return F.array(*best)


class LicenceModel:
    """A fitted classifier of paragraphs."""

    def __init__(self, vectors: CountVectorizerModel, model: LogisticRegressionModel, templates: list, bar: float = 0.0):
        self.vectors, self.model, self.templates, self.bar = vectors, model, templates, bar

    def scored(self, lines: DataFrame) -> DataFrame:
        """``lines`` of ``_line`` with ``_family`` (a class from 0) and its chance."""
        return self.told(self.vectors.transform(_with_grams(lines)))

    def told(self, rows: DataFrame) -> DataFrame:
        """``rows`` of ``features`` with ``_family`` and its chance."""
        told = self.model.transform(rows)
        chances = F.slice(vector_to_array("probability"), 2, len(_FAMILIES))
        told = told.withColumn("_chances", chances).withColumn("_chance", F.array_max("_chances"))
        return told.withColumn("_family", (F.array_position("_chances", F.col("_chance")) - 1).cast("int"))

    def notices(self, lines: DataFrame) -> DataFrame:
        """Those of ``lines`` that pass the bar and agree with a template of their family."""
        # A paragraph of fewer pairs than any template has agrees with none and need not be classified.
        least = min(_least(row["_pairs"]) for row in self.templates)
        near = _with_known_grams(lines, self.vectors.vocabulary).where(F.size("_pairs") >= least).select(*lines.columns)
        found = self.scored(near).filter(F.col("_chance") >= self.bar)
        agreed = F.element_at(_agreement(self.templates), F.col("_family") + 1)
        names = F.array(*map(F.lit, _FAMILIES))
        return found.withColumn("_agreement", agreed).filter(F.col("_agreement") >= AGREEMENT).withColumn(
            "family", F.element_at(names, F.col("_family") + 1)
        )


def _lines(docs: DataFrame, doc: str, text: str) -> DataFrame:
    source = docs.select(F.col(doc).alias("_doc"), F.xxhash64(text).alias("_key"), F.coalesce(text, F.lit("")).alias("_text"))
    return source.select("_doc", "_key", F.posexplode(F.split("_text", "\n")).alias("_number", "_line"))


def _counted(docs: DataFrame, text: str, vectors: CountVectorizerModel, held: list) -> DataFrame:
    """All paragraphs that agree with no template, those of the same features counted together.

    ``_part`` deals them by a hash and ``_at`` gives those of the first part a template each; ``_count`` is how many there are.
    """
    lines = docs.select(F.explode(F.split(F.col(text), "\n")).alias("_line")).where(F.trim("_line") != "")
    part = F.pmod(F.xxhash64("_line", F.lit(1)), F.lit(_PARTS))
    at = F.when(F.col("_part") == 0, F.pmod(F.xxhash64("_line", F.lit(2)), F.lit(len(held))))
    rows = _with_few(_with_known_grams(lines.withColumn("_part", part).withColumn("_at", at), vectors.vocabulary), held)
    rows = vectors.transform(rows)
    # Paragraphs of too few known pairs agree with none and aren't compared.
    least = min(_least(row["_pairs"]) for row in held)
    agrees = F.array_max(_agreement(held, F.col("_few"))) >= AGREEMENT
    rows = rows.where(~((F.size("_pairs") >= least) & agrees))
    return rows.groupBy("features", "_part", "_at", "_few").agg(F.count(F.lit(1)).alias("_count"))


def _bar(told: DataFrame, mistaken: float) -> float | None:
    """The least chance that no more than the share ``mistaken`` of the counted rows exceeds."""
    chances = told.groupBy("_chance").agg(F.sum("_count").alias("_count"))
    line = cut(summed(ordered(chances, F.col("_chance")), F.col("_count")))
    upto = F.col("_before") + F.col("_count")
    total = line.agg(F.max(upto)).first()[0]
    if not total:
        return None
    return line.where(upto >= (1 - mistaken) * total).agg(F.min("_chance")).first()[0]


def fit(docs: DataFrame, *, text: str = "text", mistaken: float = MISTAKEN) -> LicenceModel:
    """Learn from the templates, alone and within paragraphs of the corpus, and from its other paragraphs.

    A third of all paragraphs, by a hash, are learnt from with a template's features added, another as unknown text, and the
    rest set the bar; those that agree with a template themselves are left out. All paragraphs take part, each as often as
    it comes: those of the same features are one row with a weight.
    """
    spark = docs.sparkSession
    templates = cut(_with_grams(_templates(spark)))
    vocabulary = [row[0] for row in templates.select(F.explode("_grams")).distinct().orderBy("col").collect()]
    vectors = CountVectorizerModel.from_vocabulary(vocabulary, "_grams", "features")
    vectors.setBinary(True)
    held = templates.select("_at", "label", "_line", F.array_distinct("_pairs").alias("_pairs")).collect()
    counted = cut(_counted(docs, text, vectors, held))
    alone = vectors.transform(templates).select("_at", "features", "label")
    notices = F.broadcast(alone.select("_at", "label", vector_to_array("features").alias("_notice")))
    both = F.zip_with(vector_to_array("features"), "_notice", lambda a, b: F.greatest(a, b))
    within = counted.where("_part = 0").join(notices, "_at").select(array_to_vector(both).alias("features"), "label", "_count")
    other = counted.where("_part = 1").select("features", F.lit(0.0).alias("label"), "_count")
    # Every class is there, and unknown also where the corpus is empty.
    blank = vectors.transform(_with_grams(spark.range(1).select(F.lit("").alias("_line")))).select("features", F.lit(0.0).alias("label"))
    single = alone.select("features", "label").unionByName(blank).withColumn("_count", F.lit(1).cast("long"))
    rows = reduce(DataFrame.unionByName, [single, within, other]).withColumn("_weight", F.col("_count").cast("double"))
    learner = LogisticRegression(family="multinomial", maxIter=60, regParam=2e-3, elasticNetParam=0.5, weightCol="_weight")
    model = LicenceModel(vectors, learner.fit(rows), held)
    model.bar = max(0.5, _bar(model.told(counted.where("_part = 2")), mistaken) or 0.0)
    return model


def scan(docs: DataFrame, model: LicenceModel, *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's ``doc``, ``text_key``, ``n_notices``, ``families`` (distinct, sorted) and ``score`` (the highest chance).

    Paragraphs are the lines of a whole text. Without a notice ``families`` is empty and ``score`` 0. Rows of one id and text are
    one document; null and empty texts have no notices. Other columns are ignored.
    """
    found = model.notices(_lines(docs, doc, text)).select("_doc", "_key", "_number", "family", "_chance").distinct()
    by_doc = found.groupBy("_doc", "_key").agg(
        F.count(F.lit(1)).alias("n_notices"),
        F.array_sort(F.collect_set("family")).alias("families"),
        F.max("_chance").alias("score"),
    )
    every = docs.select(F.col(doc).alias("_d"), F.xxhash64(text).alias("text_key")).distinct()
    same = F.col("_d").eqNullSafe(F.col("_doc")) & (F.col("text_key") == F.col("_key"))
    return every.join(by_doc, same, "left").select(
        F.col("_d").alias(doc),
        "text_key",
        F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"),
        F.coalesce("families", F.array().cast("array<string>")).alias("families"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )

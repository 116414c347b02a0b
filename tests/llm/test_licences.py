import pytest

from weftgraph.llm import licences

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs, licences.fit(docs)


def test_notices_of_the_test_documents(fitted):
    docs, model = fitted
    lines = {
        "Apache-2.0": "Licensed under the Apache License, Version 2.0",
        "CC-BY-NC": "Licensed under CC BY-NC 4.0",
        "GPL": "licensed under the GNU General Public License, version 3",
        "MIT": "Released under the MIT License",
    }
    plain = lambda text: "".join(c for c in text.lower() if c.isalnum())
    want = {r.doc_id: sorted(k for k, v in lines.items() if plain(v) in plain(r.text)) for r in docs.collect()}
    found = {r.doc_id: r.families for r in licences.scan(docs, model).collect()}
    assert found == want and any(want.values())


def test_only_dataframe_operations(fitted):
    docs, model = fitted
    text = licences.scan(docs, model)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in text for word in ("Python", "Pandas", "Arrow"))


def test_awkward_rows(awkward, fitted):
    model = fitted[1]
    other = "thanea erly of and that was inthe re " * 6
    rows = [
        (1, None, None, None),
        (2, "", "en", "s"),
        (3, f"{other}\n{other} Released under the MIT License. {other}\nSPDX-License-Identifier: GPL-3.0-or-later", "en", "s"),
        (3, "Released under the MIT License.", "en", "s"),
        (3, "Released under the MIT License.", "en", "s"),
        (4, "My driving license was released under the bridge.\nThe public domain is general.", "en", "s"),
        (5, "word " * 200_000, "en", "s"),
        (None, "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "en", "s"),
    ]
    found = sorted(((r.doc_id, r.n_notices, r.families) for r in licences.scan(awkward(rows), model).collect()), key=str)
    want = [(1, 0, []), (2, 0, []), (3, 2, ["GPL", "MIT"]), (3, 1, ["MIT"]), (4, 0, []), (5, 0, []), (None, 1, ["MPL"])]
    assert found == sorted(want, key=str)
    assert licences.scan(awkward([]), model).count() == 0


def test_an_empty_corpus_can_be_learnt_from(awkward):
    model = licences.fit(awkward([]))
    found = licences.scan(awkward([(1, "Released under the MIT License.", "en", "s")]), model).first()
    assert found.families == ["MIT"]


def test_every_paragraph_is_learnt_from(awkward, fitted, monkeypatch):
    """Paragraphs that agree with no template, each as often as it comes: against a count of them one by one."""
    from pyspark.sql import functions as F

    templates = fitted[1].templates
    common = [f"the software is provided {i} as is" for i in range(60)] + ["Released under the MIT License.", "x", "of the of the of the"]
    text = "\n".join([*common, " ", *common])
    docs = awkward([(i, text, "en", "s") for i in range(40)] + [(50, None, "en", "s"), (51, "", "en", "s")])
    found = licences._counted(docs, "text", fitted[1].vectors, templates)
    assert found.agg(F.sum("_count")).first()[0] == 40 * 2 * (len(common) - 1)
    lines = docs.select(F.explode(F.split("text", "\n")).alias("_line")).where("trim(_line) <> ''")
    want = licences._with_grams(lines).where(F.array_max(licences._agreement(templates)) < licences.AGREEMENT)
    want = fitted[1].vectors.transform(want).groupBy("features").count()
    total = lambda frame: {r.features: r[1] for r in frame.collect()}
    assert total(found.groupBy("features").agg(F.sum("_count"))) == total(want)


def test_only_known_pairs_are_made_and_compared(awkward, fitted):
    """Features and agreement by known words alone are those by all words, and a filter doesn't make pairs again."""
    from pyspark.sql import functions as F

    model = fitted[1]
    texts = [text for some in licences.TEMPLATES.values() for text in some]
    words = " ".join(texts).split()
    texts += [" ".join(words[i : i + n]) for i in range(0, 250, 7) for n in (2, 4, 5, 6, 9)] + [f"a{i} {t} b{i}" for i, t in enumerate(texts)]
    texts += ["of the of the of the", "the license the license x y", "", "x", "in the Software without other things"]
    docs = awkward([(i, text, "en", "s") for i, text in enumerate(texts)])
    lines = docs.select(F.col("text").alias("_line"))
    known = licences._with_few(licences._with_known_grams(lines, model.vectors.vocabulary), model.templates)
    known = model.vectors.transform(known)
    every = model.vectors.transform(licences._with_grams(lines))
    features = lambda rows: {r._line: r.features for r in rows.collect()}
    assert features(known) == features(every)
    agrees = lambda rows, size: {r._line for r in rows.where(F.array_max(licences._agreement(model.templates, size)) >= licences.AGREEMENT).collect()}
    found = agrees(known, F.col("_few"))
    assert found == agrees(every, None) and 0 < len(found) < len(set(texts))
    least = min(licences._least(row["_pairs"]) for row in model.templates)
    assert found <= {r._line for r in known.where(F.size("_pairs") >= least).collect()}
    for rows in (licences._counted(docs, "text", model.vectors, model.templates), model.notices(licences._lines(docs, "doc_id", "text"))):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("regexp_extract_all") <= 6


def test_the_bar_is_passed_by_no_more_than_its_share(spark):
    for seed in range(3):
        rows = spark.range(500).selectExpr(f"cast(pmod(xxhash64(id, {seed}), 97) as double) / 97 as _chance", "id % 7 + 1 as _count")
        every = sorted(r._chance for r in rows.collect() for _ in range(r._count))
        for share in (0.5, 0.1, 0.001):
            bar = licences._bar(rows, share)
            above = sum(x > bar for x in every) / len(every)
            assert above <= share and sum(x >= bar for x in every) / len(every) > share
    assert licences._bar(rows.limit(0), 0.1) is None

import pytest
from pyspark.sql import functions as F

from weftgraph.llm import toxicity

SF = "/root/testdata/sf0.1"
INSULTS = ["idiot", "moron", "stupid", "pathetic", "worthless"]


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    return docs, labels, toxicity.fit(docs, labels)


def test_held_out_documents(fitted):
    docs, labels, model = fitted
    scored = toxicity.score(docs.select("doc_id", "text"), model).join(labels, "doc_id").filter(toxicity.held_out("doc_id"))
    rows = scored.select("toxic", (F.col("score") >= 0.5).cast("int").alias("said")).collect()
    hits = sum(r.toxic and r.said for r in rows)
    assert hits / sum(r.said for r in rows) > 0.9 and hits / sum(r.toxic for r in rows) > 0.85


@pytest.mark.parametrize("word", INSULTS)
def test_disguises_are_undone(fitted, word):
    model = fitted[2]
    plain = "the and of " + " ".join(f"wh{i}" for i in range(300))
    assert model.score(plain) < 0.5
    forms = [word, word.upper(), word.translate(str.maketrans("aeiost", "431057")), " ".join(word), "-".join(word)]
    forms += [".".join(word), word[0] + word[1] * 5 + word[2:], word[:2] + "​" + word[2:], f"({word.replace('i', '!').replace('o', '0')})"]
    for form in forms:
        assert model.score(f"{plain} {form} and the") >= 0.5, form


def test_the_letter_model_counts_every_text(spark):
    one = spark.createDataFrame([("abc " * 50,), (None,), ("",)], "text string")
    more = one.unionByName(spark.createDataFrame([("abd " * 5000,)], "text string"))
    at = lambda model, third: model[1][2][toxicity._NUMBER[third]]
    assert at(toxicity.character_model(one), "c") > at(toxicity.character_model(one), "d")
    assert at(toxicity.character_model(more), "c") < at(toxicity.character_model(more), "d")


def test_awkward_rows(spark, awkward, fitted):
    model = fitted[2]
    rows = [(1, None, None, None), (2, "", "en", "s"), (3, "idiot " * 50_000, "en", "s"), (3, "fine", "en", "s"), (None, "idiot", "en", "s")]
    scored = toxicity.score(awkward(rows), model, name="toxicity")
    assert scored.columns == [*awkward(rows).columns, "toxicity"]
    found = sorted((r.toxicity for r in scored.collect()))
    assert all(0 <= x <= 1 for x in found) and sum(x >= 0.5 for x in found) == 2
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1)], "doc_id long, toxic int")
    kept = toxicity.drop_toxic(awkward(rows), labels)
    assert kept.columns == awkward(rows).columns
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.drop_toxic(awkward(rows), none).count() == 5 and toxicity.drop_toxic(awkward([]), none).count() == 0

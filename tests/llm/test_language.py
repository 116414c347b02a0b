import random

import numpy as np

from weftgraph.llm import language

SF = "/root/testdata/sf0.1"


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    told = language.predict(docs, language.fit(docs)).filter(language.held_out("doc_id")).select("lang", "lang_pred", "score").collect()
    assert np.mean([r.lang == r.lang_pred for r in told]) > 0.98 and all(0 <= r.score <= 1 for r in told)


def phrases(symbols, read):
    """Greedy longest phrases of ``symbols`` that stand in ``read``; a symbol that doesn't is a phrase."""
    count, at = 0, 0
    while at < len(symbols):
        end = at + 1
        while end < len(symbols) and symbols[at : end + 1] in read:
            end += 1
        count, at = count + 1, end
    return count


def test_entropy_against_substring_search(monkeypatch):
    monkeypatch.setattr(language, "PIECE", 10)
    rng = random.Random(0)
    read = "".join(rng.choice("ab ") for _ in range(60))
    model = language.LanguageModel([97, 98], ["x"], [], [7.0])
    number = {" ": 0, "a": 1, "b": 2}
    model.tables.append(language.suffix_automaton([number[c] for c in read], model.size))
    for _ in range(200):
        text = "a" + "".join(rng.choice("ab c") for _ in range(rng.randint(0, 30)))
        symbols = " ".join(text.split()) + (" " if text.endswith(" ") else "")
        pieces = [symbols[i : i + 10] for i in range(0, len(symbols), 10)]
        want = 0
        for piece in pieces:
            # A letter not learnt breaks the phrase and starts the next one at the root.
            want += max(1, sum(phrases(x, read) for x in piece.split("c")) + piece.count("c")) if "c" in piece else phrases(piece, read)
        bits, lettered = model.entropies([text])
        if "c" not in text:
            assert lettered[0] and round(bits[0, 0] * len(symbols) / 7.0) == want, (text, read)


def test_awkward_rows(spark, awkward):
    words = {"one": "the of and that", "two": "der die und das", None: "nobody knows"}
    rows = [(i, " ".join(random.Random(i).choices(words[x].split(), k=20)), x, "s") for i in range(60) for x in words]
    model = language.fit(awkward(rows))
    assert model.languages == ["one", "two"]
    more = [(1, None, "one", "s"), (2, "", "one", "s"), (3, "123 !?", "two", "s"), (4, "und " * 100_000, None, None), (4, "of", "one", "s"), (None, "das und", None, "s")]
    told = language.predict(awkward(more), model, score="certainty")
    assert told.columns == [*awkward(more).columns, "lang_pred", "certainty"]
    found = {(r.doc_id, (r.text or "")[:3]): r.lang_pred for r in told.collect()}
    assert found == {(1, ""): "und", (2, ""): "und", (3, "123"): "und", (4, "und"): "two", (4, "of"): "one", (None, "das"): "two"}
    assert sum(r.text is None for r in told.collect()) == 1
    empty = language.fit(awkward([]))
    assert {r.lang_pred for r in language.predict(awkward(more), empty).collect()} == {"und"}
    assert language.predict(awkward([]), model).count() == 0

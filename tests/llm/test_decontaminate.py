import hashlib
import random
import re
import tracemalloc

import pyarrow as pa
import pytest

from weftgraph.llm import decontaminate as module, text as tx
from weftgraph.llm.decontaminate import contamination, decontaminate

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def brute(text, items, window=10):
    found, hit, mine = words(text), set(), set()
    for item, body in items:
        other = words(body)
        n = min(window, len(other))
        grams = {tuple(other[i : i + n]) for i in range(len(other) - n + 1)} if n else set()
        for i in range(len(found) - n + 1):
            if tuple(found[i : i + n]) in grams:
                hit.update(range(i, i + n))
                mine.add(str(item))
    return len(found), len(hit), sorted(mine)


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_against_brute_force(spark, awkward, broadcast_rows, monkeypatch):
    monkeypatch.setattr(module.tx, "SLICE_BYTES", 500)
    rng = random.Random(3)
    vocabulary = ["the", "Ñu", "a1", "x", "été", "zz"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 3, 5, 9, 10, 11, 25, 40]) if i > 3 else 30)) for i in range(14)]
    items += [(20, None), (21, ""), (22, "the the the the the the the the the the the the"), (3, text(12)), (100, "y " * 12)]
    docs = [(i, text(rng.choice([0, 3, 9, 10, 40, 200])), "en", "s") for i in range(40)]
    docs += [(50 + i, text(8) + "! " + items[i][1].upper() + "; " + text(8), "en", "s") for i in range(4)]
    docs += [(60, None, None, None), (61, "", "en", "s"), (62, "the " * 3000, "en", "s"), (None, items[0][1], "en", "s")]
    docs += [docs[0], (0, "another text", "en", "s")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = contamination(awkward(docs), benchmark, broadcast_rows=broadcast_rows).collect()
    got = sorted((r.doc_id is None, r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in found)
    want = sorted((d is None, d, *brute(t, items)) for d, t in {(d, t) for d, t, *_ in docs})
    assert got == want
    # Windows of one word hit nearly all of these texts; longer items alone leave some.
    long = [x for x in items if len(words(x[1])) >= 10]
    kept = decontaminate(awkward(docs), spark.createDataFrame(long, "item_id long, text string"), broadcast_rows=broadcast_rows)
    assert kept.columns == awkward(docs).columns
    clean = [d for d, t, *_ in docs if not brute(t, long)[1]]
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, clean)) and 0 < len(clean) < len(docs)


def test_empty_tables(spark, awkward):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = awkward([(1, "some words", "en", "s")])
    assert [(r.n_words, r.n_hit) for r in contamination(docs, none).collect()] == [(2, 0)]
    items = spark.createDataFrame([(1, "some words")], none.schema)
    assert contamination(awkward([]), items).count() == 0 and decontaminate(docs, items).count() == 0


def test_a_task_holds_little_of_a_large_batch():
    import tracemalloc

    text = "the quick brown fox jumps over lazy dogs " * 500
    import pyarrow as pa

    keys = pa.array(range(800), pa.int64())
    batch = pa.RecordBatch.from_arrays([keys, keys, pa.array([text] * 800)], ["_doc", "_text_key", "_text"])
    rows = module._gram_map(["_doc", "_text_key"], [10])
    tracemalloc.start()
    found = sum(part.num_rows for part in rows(iter([batch])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found and most < 64 << 20


def test_texts_reach_workers_a_few_mb_at_a_time(spark, monkeypatch):
    """While documents are searched, a task's Python worker holds no batch of more than ``BATCH_BYTES`` or so of texts."""
    key, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []
    before, cut = spark.conf.get(key, None), module.cut

    def watched(frame):
        def sizes(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

        texts = docs.select("text").mapInArrow(sizes, "n long")
        seen.append(texts.agg({"n": "max"}).first()[0])
        return cut(frame)

    docs = spark.range(0, 3000, numPartitions=1).selectExpr("id as doc_id", "repeat(concat('word', id, ' '), 500) as text")
    items = spark.createDataFrame([("a", "one two three four five six seven eight nine ten")], "item_id string, text string")
    monkeypatch.setattr(module, "cut", watched)
    assert decontaminate(docs, items).count() == 3000
    assert seen[-1] < 2 * tx.BATCH_BYTES < seen[0]
    assert spark.conf.get(key, None) == before


def test_hashing_a_slice_takes_little_memory():
    batch = pa.RecordBatch.from_arrays([pa.array(["some words of a text " * 100] * 2000)], ["_text"])
    tracemalloc.start()
    try:
        for part in tx.slices(batch, "_text"):
            module._kept_grams(part.column("_text"), [10], None)
        assert tracemalloc.get_traced_memory()[1] < 20 << 20
    finally:
        tracemalloc.stop()

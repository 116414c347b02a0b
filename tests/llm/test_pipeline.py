import random

import corpus_pipeline
from weftgraph.llm.toxicity import held_out

SF = "/root/testdata/sf0.01"


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_dedup", "decontamination", "mixing"]


def test_planted_cases(spark, tmp_path):
    """Toxic documents, copies, shared passages and benchmark passages go, each where it should; the clean ones stay."""
    rng = random.Random(8)
    base = spark.read.parquet(f"{SF}/documents.parquet")
    syllables = ["ka", "lo", "mi", "ne", "ru", "ta", "vo", "sel", "dor", "pin"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(2, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, item = text(70), text(30)
    rows = [(90_000 + i, f"{text(80)}\n{text(20)}", "en", "clean", 0) for i in range(20)]
    rows += [(91_000, rows[0][1], "en", "copy", 0), (91_001, rows[1][1].replace("\n", " tail\n"), "en", "near", 0)]
    rows += [(92_000 + i, f"{text(90)}\n{passage}\n{text(40)}", "en", "shared", 0) for i in range(3)]
    rows += [(93_000, f"{text(30)} {item} {text(30)}", "en", "leak", 0)]
    rows += [(94_000 + i, f"{text(100)} stupid {text(20)} 1d10t moron", "en", "toxic", 0) for i in range(3)]
    docs = base.unionByName(spark.createDataFrame(rows, base.schema))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    benchmark.unionByName(spark.createDataFrame([(999, item)], benchmark.schema)).write.parquet(f"{tmp_path}/benchmark.parquet")
    kept, before = {}, spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, before, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        before = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r.doc_id: r.text for r in before.select("doc_id", "text").collect()}
        if name != "mixing":
            assert before.columns == docs.columns
    planted = lambda name, low, high: {i for i in kept[name] if low <= i < high}
    assert not planted("toxicity", 94_000, 94_003) and len(planted("toxicity", 90_000, 94_000)) == 26
    lines = kept["line_dedup"]
    assert len(lines) == len(kept["toxicity"]) and lines[91_000] == ""
    assert [passage in lines[92_000 + i] for i in range(3)] == [True, False, False]
    assert all(lines[i] == t for i, t, *_ in rows[:20])
    assert planted("simhash_dedup", 90_000, 90_020) == {*range(90_000, 90_020)}
    assert 91_000 not in kept["simhash_dedup"] or lines[91_000] == "" and min(i for i, t in lines.items() if not t.split()) == 91_000
    assert not planted("decontamination", 93_000, 93_001)
    assert planted("decontamination", 90_000, 90_020) == {*range(90_000, 90_020)}
    toxic = {r.doc_id for r in labels.filter("toxic = 0").filter(~held_out("doc_id")).collect()} & {r.doc_id for r in base.collect()}
    assert len(toxic & set(kept["toxicity"])) > 0.97 * len(toxic)

import random

import pyarrow as pa
import pytest

from weftgraph.llm import chat

PARTS = ["</s>", "[INST]", "[/INST]", "<s>", "\\", "<|", "<<SYS>>", "é", " ", "\n", "ok", "[", "<", "/", "\\[INST]", "😀"]


def test_round_trip(spark, monkeypatch):
    rng = random.Random(1)
    text = lambda: "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12)))
    rows = [(c, t, rng.choice(["user", "assistant", "system", "[INST]x"]), text()) for c in range(60) for t in range(rng.randint(1, 6))]
    rows += [(100, None, "user", "first"), (100, 1, None, None), (100, 1, "assistant", None), (100, 1, "assistant", "same"), (100, 1, "assistant", "same")]
    rows += [(None, 2, "assistant", "b"), (None, 1, "user", "a"), (101, 1, "assistant", "long " * 100_000)]
    turns = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, conv string, formatted string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        found = {r.conv_id: r for r in chat.format_chat(turns.repartition(5)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert set(found) == {r[0] for r in rows}
    for conv, row in found.items():
        mine = [(t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv]
        want = [(role, text) for _, _, role, text in sorted(mine)]
        assert chat.parse(row.formatted) == want and row.n_turns == len(want)
        mask = [span.asDict() for span in row.mask]
        assert chat.masked(row.formatted, mask) == "".join(text for role, text in want if role == "assistant")
        assert len(mask) == sum(role == "assistant" for role, _ in want)


def test_no_rows(spark):
    assert chat.format_chat(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


@pytest.mark.parametrize("gather, size", [(1, 1), (7, 40), (1000, 300)])
def test_slices_make_the_same(monkeypatch, gather, size):
    rng = random.Random(gather)
    text = lambda: "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12)))
    rows = sorted((rng.randint(0, 30), rng.choice(["", "user", "assistant"]), text()) for _ in range(120))
    rows = [(None if c == 30 else c, role, said) for c, role, said in rows]
    schema = pa.schema([("conv", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    batches = pa.Table.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema).to_batches(50)
    whole = pa.Table.from_batches(chat._conversations(iter(batches), "assistant")).to_pylist()
    monkeypatch.setattr(chat, "GATHER_BYTES", gather)
    monkeypatch.setattr(chat, "SLICE_BYTES", size)
    cut = list(chat._conversations(iter(batches), "assistant"))
    assert [row for batch in cut for row in batch.to_pylist()] == whole
    assert len(cut) > 3 and [r["conv"] for r in whole] == list(dict.fromkeys(r[0] for r in rows))
    for row in whole:
        assert chat.parse(row["formatted"]) == [(role, said) for c, role, said in rows if c == row["conv"]]

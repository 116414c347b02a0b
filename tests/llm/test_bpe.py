import hashlib
import random
import unicodedata

import pytest
from tokenizers import Tokenizer, pre_tokenizers

from weftgraph.llm import bpe, queries

PARTS = ["hello", " the", "  ", "\n", "\t", " don't", "'ll", "é", "😀", "中文", "<|endoftext|>", "<|endoftext", "a" * 9, "123", "՘", "\x1c", "\xa0"]
PARTS += ["!!!", "\U0003fc3d", "́", "x" * 50, "y" * 90, "\r\n", "   ", "'S", "_", "\0", "  ", "٣"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.VOCABULARY)


def texts(count, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(count)]


def test_ids_and_texts_are_those_of_the_library(library):
    made = bpe.Encoder(bpe.read_vocabulary(bpe.VOCABULARY))
    given = texts(4000)
    ids, bounds = made.encode(given)
    for i, text in enumerate(given):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, text
    decode = bpe.decoder(bpe.read_vocabulary(bpe.VOCABULARY))
    rng = random.Random(2)
    for _ in range(2000):
        ids = [rng.randrange(50_257) for _ in range(rng.randint(0, 9))]
        assert decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_one_at_a_time_and_many_at_once_agree():
    vocabulary = bpe.read_vocabulary(bpe.VOCABULARY)
    rng = random.Random(3)
    some = ["".join(rng.choice("abehntr\xe9 ") for _ in range(rng.randint(1, 64))) for _ in range(3000)]
    ids, bounds = bpe.Encoder(vocabulary).encode(some)
    for i, text in enumerate(some):
        one = [x for word in bpe.words(text) for x in bpe.merged([vocabulary.singles[b] for b in word.encode()], vocabulary.ranks, vocabulary.made)]
        assert ids[bounds[i] : bounds[i + 1]].tolist() == one


def test_equals_repeated_search_for_the_lowest_pair():
    rng = random.Random(4)
    for _ in range(300):
        ranks, made = {}, []
        for rank in range(8):
            pair = rng.randrange(4 + rank) << 32 | rng.randrange(4 + rank)
            ranks.setdefault(pair, rank)
            made.append(4 + rank)
        ids = [rng.randrange(4) for _ in range(rng.randint(0, 40))]
        want = list(ids)
        while True:
            found = [(ranks[a << 32 | b], i) for i, (a, b) in enumerate(zip(want, want[1:], strict=False)) if a << 32 | b in ranks]
            if not found:
                break
            rank, i = min(found)
            want[i : i + 2] = [made[rank]]
        assert bpe.merged(ids, ranks, made) == want


def test_long_words(library):
    vocabulary = bpe.read_vocabulary(bpe.VOCABULARY)
    made = bpe.Encoder(vocabulary)
    rng = random.Random(5)
    given = ["a" * 50_000, " " * 30_000, "".join(rng.choice("abcdefgh") for _ in range(50_000)), "é" * 5_000, "word " * 200_000]
    ids, bounds = made.encode(given)
    for i, text in enumerate(given):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids
    assert all(len(word) <= bpe.TOGETHER or word in vocabulary.added for word in made._number)


def test_words_are_split_like_the_library_splits_them():
    split = pre_tokenizers.ByteLevel(add_prefix_space=False)
    for begin in range(0, 0x3000, 64):
        text = "".join(f"a{x}1{x}.{x} {x}" for x in map(chr, range(begin, begin + 64)) if unicodedata.category(x) != "Cs")
        assert bpe.words(text) == [text[a:b] for _, (a, b) in split.pre_tokenize_str(text)], hex(begin)


def test_tables(spark, awkward, library, monkeypatch):
    given = [*texts(40), "", None, "a b " * 100_000, "same", "same"]
    rows = [(i // 2, text, None, None) for i, text in enumerate(given)]
    docs = awkward(rows).withColumnRenamed("a", "_made").repartition(3)
    found = bpe.encode(docs, ids="key")
    assert found.columns == [*(c for c in docs.columns if c != "key"), "key"]
    back = bpe.decode(found.drop("text"), ids="key").collect()
    want = sorted((i // 2, library.encode(x or "", add_special_tokens=False).ids, x or "") for i, x in enumerate(given))
    assert sorted((r.doc_id, r.key, r.text) for r in back) == want
    assert bpe.encode(docs.limit(0)).count() == 0
    odd = spark.createDataFrame([(None,), ([],), ([None, 15339, 99_999_999],)], "ids array<int>")
    assert [r.text for r in bpe.decode(odd).collect()] == ["", "", library.decode([15339])]


def test_ids_are_read_in_bulk():
    import time

    import pyarrow as pa

    odd = pa.array([[9, 9], [1, None, 2], None, [], [3]], pa.list_(pa.int32())).slice(1)
    assert list(bpe.read_ids(odd)) == [[1, -1, 2], [], [], [3]] and list(bpe.read_ids(odd.slice(0, 0))) == []
    column = pa.array([list(range(1000))] * 400, pa.list_(pa.int32()))
    begin = time.process_time()
    want = [row.as_py() for row in column]
    middle = time.process_time()
    assert list(bpe.read_ids(column)) == want
    assert time.process_time() - middle < (middle - begin) / 3


def test_query(spark, tmp_path, library):
    rows = [(i, text) for i, text in enumerate([*texts(60, 6), None])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for row in queries.bpe_round_trip(spark, str(tmp_path)).collect():
        ids = library.encode(rows[row.doc_id][1] or "", add_special_tokens=False).ids
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert tuple(row) == (row.doc_id, len(ids), sha(",".join(map(str, ids))), sha(decoded))


def test_other_vocabularies_are_refused(tmp_path):
    with pytest.raises(ValueError, match="not a plain"):
        bpe.read_vocabulary("/opt/tokenizers/word_bpe_49k.json")

import random

import numpy as np
import pytest
import xxhash

from weftgraph.llm import simhash
from weftgraph.llm.components import components


def fingerprint(text, shingle=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashed = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashed) > len(hashed))


def groups(values, distance=4):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= distance:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(values))]


def test_fingerprints_and_components(awkward, monkeypatch):
    rng = random.Random(2)
    text = lambda n: " ".join(f"w{rng.randint(0, 50)}" for _ in range(n))
    docs = [(i, text(rng.choice([1, 3, 4, 30, 700])), "en", "s") for i in range(40)]
    docs += [(100 + i, docs[i][1] + " End", "en", "s") for i in range(40)] + [(200, "", "en", "s"), (201, None, None, None), (202, "  \n", "en", "s")]
    docs += [docs[5], (None, docs[7][1], "en", "s"), (None, "alone with no id", "en", "s"), (300, " x É ß y", "en", "s")]
    monkeypatch.setattr(simhash.tx, "SLICE_BYTES", 2000)
    rows = simhash.near_groups(awkward(docs)).collect()
    assert len(rows) == len(docs)
    assert sorted(str((r.doc_id, r._fingerprint % (1 << 64))) for r in rows) == sorted(str((d, fingerprint(t))) for d, t, *_ in docs)
    label = groups([fingerprint(t) for _, t, *_ in docs])
    least = {}
    for (d, *_), g in zip(docs, label):
        least[g] = min((x for x in (least.get(g), d) if x is not None), default=None)
    assert sorted(str((r.doc_id, r.component_id)) for r in rows) == sorted(str((d, least[g])) for (d, *_), g in zip(docs, label))
    kept = simhash.drop_near_duplicates(awkward(docs))
    assert kept.columns == awkward(docs).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, least.values()))


def test_empty(awkward):
    assert simhash.near_groups(awkward([])).count() == 0 and simhash.drop_near_duplicates(awkward([])).count() == 0


def test_masks_cover_every_pair_within_the_distance():
    rng = random.Random(0)
    tables = simhash.masks(4)
    assert len(tables) == 31
    for _ in range(3000):
        difference = sum(1 << bit for bit in rng.sample(range(64), 4))
        assert any(mask & difference == 0 for mask in tables)


@pytest.mark.parametrize("most_compared", [256, 6, 1])
def test_large_buckets_lose_no_link(spark, most_compared):
    """The same groups whether buckets are compared whole or by neighbourhoods."""
    rng = random.Random(4)
    values = set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(40):
            values.add(centre ^ sum(1 << bit for bit in rng.sample(range(64), rng.randint(0, 7))))
    values = sorted(values)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    links = simhash.links(spark.createDataFrame([(v,) for v in signed], "v long"), 4, most_compared)
    root = {r.id: r.root for r in components(links).collect()}
    got = [root.get(v, v) for v in signed]
    pairs = set(zip(groups(values), got))
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs}) < len(values)


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, 2000 + i) for i in range(300)] + [(5, 5), (7, 6)]
    found = {r.id: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{2000 + i: 1000 for i in range(300)}, 1000: 1000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0

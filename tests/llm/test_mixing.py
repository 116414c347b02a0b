import pytest

from weftgraph.llm import mixing


def shares(sizes, weights=(1, 2, 3), most=3):
    """Targets by sharing again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in capped)
        share = rest / max(1, sum(weight[s] for s in order if s not in capped))
        more = {s for s in order if s not in capped and share * weight[s] > most * sizes[s]}
        if not more:
            return {s: most * sizes[s] if s in capped else share * weight[s] for s in order}
        capped |= more


ROWS = [(i, "w " * (1 + i * 7 % 23), "en", f"s{i % 5}") for i in range(200)]
ROWS += [(1000 + i, "x y", "en", "tiny") for i in range(3)] + [(2000, "long " * 500, "en", None), (2001, None, None, "s1")]
ROWS += [(2002, "", "en", "void"), (2003, " \t\n", "en", "s2"), ROWS[0], ROWS[0], (None, "no id", "en", "s3"), (0, "other text", "en", "s0")]


def test_targets_and_copies(awkward):
    rows = mixing.schedule(awkward(ROWS)).collect()
    assert len(rows) == len(ROWS)
    sizes = {}
    for _, text, _, source in ROWS:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = shares(sizes)
    taken = dict.fromkeys(sizes, 0)
    for row in rows:
        assert row.size == len((row.text or "").split()) and row.source_size == sizes[row.source]
        assert row.target == pytest.approx(want[row.source]) and 0 <= row.taken <= 3 * row.size
        taken[row.source] += row.taken
    assert all(want[s] - 1 < taken[s] <= want[s] + 1e-6 for s in sizes)
    again = mixing.schedule(awkward(ROWS[::-1]).repartition(3)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_mix_is_cut_at_the_budget_and_in_order(awkward):
    mixed = mixing.mix(awkward(ROWS))
    assert mixed.columns == [*(c for c in awkward(ROWS).columns if c != "copy"), "copy", "taken", "finish"]
    rows = mixed.collect()
    assert all(len(r.text.split()) == r.taken > 0 for r in rows) and max(r.copy for r in rows) == 2
    assert [r.finish for r in rows] == sorted(r.finish for r in rows) and rows[-1].finish <= 1
    planned = {str(k): 0 for k in {(r[0], r[1]) for r in ROWS}}
    for row in mixing.schedule(awkward(ROWS)).collect():
        planned[str((row.doc_id, row.text))] += row.taken
    assert sum(r.taken for r in rows) == sum(planned.values())


def test_empty_and_wordless(awkward):
    assert mixing.mix(awkward([])).count() == 0 and mixing.schedule(awkward([])).count() == 0
    rows = mixing.schedule(awkward([(1, None, None, None), (2, "", "en", "a")])).collect()
    assert [(r.size, r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 2


def test_rank_is_global(spark):
    ranked = mixing.ranked(spark.range(1000).selectExpr("(id * 37) % 1000 as x").repartition(7), __import__("pyspark").sql.functions.col("x"))
    assert all(r.x == r["rank"] for r in ranked.collect())


def test_the_cut_is_made_in_the_merged_order(spark):
    import heapq
    import random

    rng = random.Random(1)
    sizes = {s: [rng.randint(0, 9) for _ in range(n)] for s, n in (("a", 300), ("b", 20), (None, 60))}
    want = {s: float(x) for s, x in shares({s: sum(x) for s, x in sizes.items()}).items()}
    rows, queue = [], []
    for s, own in sizes.items():
        for i, words in enumerate(own):
            rows.append((len(rows), s, sum(own[:i]), words, sum(own), want[s]))
            for turn in range(3):
                begin = turn * sum(own) + sum(own[:i])
                first = max(0, min(words, int(want[s]) - begin))
                for start, length in ((begin, first), (begin + first, words - first)):
                    if length and begin <= want[s]:
                        heapq.heappush(queue, ((start + length) / want[s], s is None, s or "", start, rows[-1][0], turn, length))
    placed = spark.createDataFrame(rows, "_id long, _source string, _start long, _words long, _source_size long, _target double").repartition(5)
    for budget in (0, 1, 500, sum(int(x) for x in want.values())):
        left, kept, rest = budget, {}, queue[:]
        while rest and left:
            *_, name, turn, length = heapq.heappop(rest)
            kept[name, turn] = kept.get((name, turn), 0) + min(left, length)
            left -= min(left, length)
        got = {}
        for row in mixing.served(mixing.queued(placed), budget).collect():
            got[row["_id"], row["_pass"]] = got.get((row["_id"], row["_pass"]), 0) + row["_kept"]
        assert got == kept


def test_many_rows_that_agree_are_numbered_across_partitions(awkward):
    rows = [(7, "a b c", "en", "s")] * 50 + [(None, "d e", "en", "s")] * 20 + [(8, "x " * 400, "en", "t")]
    found = mixing.schedule(awkward(rows).repartition(6)).collect()
    starts = sorted(r.start for r in found if r.source == "s")
    by_size = {n: sorted(r.start for r in found if r.source == "s" and r.size == n) for n in (2, 3)}
    assert all(b - a == n for n, own in by_size.items() for a, b in zip(own, own[1:])) and len(set(starts)) == 70
    for source in "st":
        own = [r for r in found if r.source == source]
        assert sum(r.taken for r in own) == int(own[0].target) and all(r.taken <= 3 * r.size for r in own)

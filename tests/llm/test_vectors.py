import numpy as np

from weftgraph.llm import vectors


def made(seed, size=32, groups=25, each=12):
    """Groups of vectors at many angles from their centres, so that cosines fall on both sides of the limit."""
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = rng.standard_normal(size)
        for _ in range(each):
            rows.append((centre + rng.uniform(0, 0.35) * rng.standard_normal(size)).astype(np.float32).tolist())
    return [(i, v, int(i % 3)) for i, v in enumerate(rows * 1)]


def brute(rows, least=0.93):
    ok = [i for i, (_, v, label) in enumerate(rows) if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i in range(len(rows))}
    for a in ok:
        for b in ok:
            if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                    links[a].add(b)
                    links[b].add(a)
    return links


def test_recall_and_precision(spark):
    rows = made(1)
    links = brute(rows)
    found = {r.vec_id: r.n_links for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    assert all(found[i] <= len(links[i]) for i in links)
    total = sum(map(len, links.values()))
    assert total > 200 and sum(found.values()) >= 0.9 * total


def test_awkward_rows(spark):
    nan, inf, big = float("nan"), float("inf"), 3e38
    x, y = [1.0, 0.0, 0.5], [0.0, 1.0, 0.2]
    rows = [(1, x, 1), (2, x, 1), (2, x, 1), (3, x, 2), (4, x, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1), (8, [nan, 1.0, 1.0], 1)]
    rows += [(9, [inf, 1.0, 1.0], 1), (10, [None, 1.0, 1.0], 1), (11, [1.0, 0.01, 0.5], 1), (12, y, 1), (13, [big, 0.0, big / 2], 1), (None, y, 1), (14, [1.0, 0.0], 1), (15, [1.0, 0.0], 1), (16, [1.0], 2)]
    table = spark.createDataFrame([(*r, 9, 8) for r in rows], "vec_id long, embedding array<float>, label int, _class int, code int")
    found = sorted(vectors.near_vectors(table).collect(), key=str)
    links = brute(rows)
    want = []
    for i, (vec, *_) in enumerate(rows):
        group, queue = {i}, [i]
        while queue:
            for j in links[queue.pop()] - group:
                group.add(j)
                queue.append(j)
        least = min((rows[j][0] for j in group if rows[j][0] is not None), default=None)
        want.append((vec, len(links[i]), least, vec == least))
    assert sorted(map(str, (tuple(r) for r in found))) == sorted(map(str, want))
    assert vectors.near_vectors(table.limit(0)).count() == 0


def test_many_copies_are_one_class(spark):
    same = spark.range(5000).selectExpr("id as vec_id", "array(float(1), float(2), float(-1)) as embedding", "1 as label")
    rows = vectors.near_vectors(same).groupBy("n_links", "component_id").count().collect()
    assert [tuple(r) for r in rows] == [(4999, 0, 5000)]

"""The six algorithms over plain Python lists, straight from their definitions."""

import heapq
from collections import Counter, defaultdict
from itertools import combinations


def undirected(edges):
    best = {}
    for s, d, w in edges:
        for pair in ((s, d), (d, s)):
            best[pair] = min(w, best.get(pair, w))
    return [(s, d, w) for (s, d), w in best.items()]


def _out(edges):
    out = defaultdict(list)
    for s, d, w in edges:
        out[s].append((d, w))
    return out


def sssp(vertices, edges, source):
    out, best = _out(edges), {}
    heap = [(0.0, source)] if source in vertices else []
    while heap:
        d, v = heapq.heappop(heap)
        if v not in best:
            best[v] = d
            for n, w in out[v]:
                heapq.heappush(heap, (d + w, n))
    return {v: best.get(v, float("inf")) for v in vertices}


def bfs(vertices, edges, source):
    hops = sssp(vertices, [(s, d, 1.0) for s, d, _ in edges], source)
    return {v: 9223372036854775807 if h == float("inf") else int(h) for v, h in hops.items()}


def wcc(vertices, edges):
    root = {v: v for v in vertices}

    def find(v):
        while root[v] != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    for s, d, _ in edges:
        a, b = sorted((find(s), find(d)))
        root[b] = a
    return {v: find(v) for v in vertices}


def cdlp(vertices, edges, directed, rounds):
    near = defaultdict(list)
    for s, d, _ in edges:
        near[d].append(s)
        if directed:
            near[s].append(d)
    label = {v: v for v in vertices}
    for _ in range(rounds):
        new = {}
        for v in vertices:
            counts = Counter(label[n] for n in near[v])
            new[v] = min(counts, key=lambda x: (-counts[x], x)) if counts else label[v]
        label = new
    return label


def pagerank(vertices, edges, rounds, damping):
    n, out = len(vertices), _out(edges)
    rank = {v: 1.0 / n for v in vertices}
    for _ in range(rounds):
        lost = sum(rank[v] for v in vertices if not out[v])
        new = {v: (1 - damping) / n + damping * lost / n for v in vertices}
        for v in vertices:
            for d, _ in out[v]:
                new[d] += damping * rank[v] / len(out[v])
        rank = new
    return rank


def simple(edges):
    return {(s, d) for s, d, _ in edges if s != d}


def neighbours(edges):
    near = defaultdict(set)
    for s, d in simple(edges):
        near[s].add(d)
        near[d].add(s)
    return near


def triangles(edges):
    near = neighbours(edges)
    return {(a, b, c) for a in near for b, c in combinations(sorted(x for x in near[a] if x > a), 2) if c in near[b]}


def corner_edges(edges):
    links = simple(edges)
    found = []
    for t in triangles(edges):
        for v in t:
            p, q = (x for x in t if x != v)
            found += [(v, s, d) for s, d in ((p, q), (q, p)) if (s, d) in links]
    return found


def lcc(vertices, edges):
    links, near, result = simple(edges), neighbours(edges), {}
    for v in vertices:
        d = len(near[v])
        c = sum((a, b) in links for a in near[v] for b in near[v])
        result[v] = c / (d * (d - 1)) if d > 1 else 0.0
    return result

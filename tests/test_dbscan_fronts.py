"""Fronts of crowded neighbouring cells, exact ties at eps, and linear work where two cells hold most points."""

import math

import numpy as np

from tessera.operators import dbscan as D
from tessera.operators import graph as G

from .test_operators import _brute_dbscan


def test_front_reaches_what_the_points_reach():
    rng = np.random.default_rng(1)
    for t in range(300):
        eps, side = 1.0, 1 / math.sqrt(2)
        n = rng.integers(1, 60)
        x, y = rng.uniform(0, side, n), rng.uniform(0, side, n)
        if t % 3 == 0:
            x, y = np.round(x, 1), np.round(y, 1)
        off = 1.7e9 if t % 5 == 0 else 0.0
        keep = D.front_of(x + off, y + off, eps)
        b = np.stack([rng.uniform(side, side + 1, 400), rng.uniform(-1.5, 2.2, 400)], axis=1)
        d = np.sqrt((x[:, None] - b[:, 0]) ** 2 + (y[:, None] - b[:, 1]) ** 2)
        clear = np.abs(d.min(0) - eps) > 1e-6
        assert ((d.min(0) <= eps) == (d[keep].min(0) <= eps))[clear].all()


def test_crowded_neighbours_match_brute_force(spark, monkeypatch, block_rows=32):
    monkeypatch.setattr(D, "FEW", 8)
    rng = np.random.default_rng(2)
    side = D.side_of(1.0)
    crowds = []
    for gap, at in ((0.98, 0.0), (1.02, 40.0)):
        # two crowds in neighbouring columns of cells, about eps apart
        crowds.append(np.stack([at * side + rng.uniform(0, 0.05, 120), rng.uniform(0, side, 120)], axis=1))
        crowds.append(np.stack([at * side + rng.uniform(0.05 + gap, 0.1 + gap, 120), rng.uniform(0, side, 120)], axis=1))
    x = np.concatenate([*crowds, rng.uniform(-3, 4, (20, 2))])
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(x)]
    got = {r["id"]: (r["flag"], r["cluster"]) for r in
           D.dbscan(spark.createDataFrame(rows, "id long, x double, y double"), 1.0, 5, block_rows=block_rows).collect()}
    assert got == _brute_dbscan(rows, 1.0, 5)


def test_lattice_points_exactly_eps_apart(spark):
    rows = [(i * 12 + j, float(i), float(j)) for i in range(12) for j in range(12)] + [(900 + i, 20.0 + i * 1.0000001, 3.0) for i in range(6)]
    got = {r["id"]: (r["flag"], r["cluster"]) for r in D.dbscan(spark.createDataFrame(rows, "id long, x double, y double"), 1.0, 3).collect()}
    assert got == _brute_dbscan(rows, 1.0, 3)


def test_two_cells_with_most_points_take_linear_work(spark):
    rng = np.random.default_rng(3)
    side = D.side_of(1.0)

    def rows(n):
        a = np.stack([rng.uniform(0, 0.2, n), rng.uniform(0, side * 0.999, n)], axis=1)
        b = np.stack([rng.uniform(1.25, 1.4, n), rng.uniform(0, side * 0.999, n)], axis=1)  # out of reach of the first: never a certain link
        x = np.concatenate([a, b])
        return spark.createDataFrame([(i, float(p), float(q)) for i, (p, q) in enumerate(x)], "id long, x double, y double")

    seen = []
    original = D._closest

    def counted(q, c, block_rows):
        seen.append((q.count(), c.count()))
        return original(q, c, block_rows)

    D._closest = counted
    try:
        for n in (16000,):
            out = D.dbscan(rows(n), 1.0, 5)
            assert out.filter("flag = 'core'").count() == 2 * n and out.select("cluster").distinct().count() == 2
    finally:
        D._closest = original
    assert max(seen[0]) < 300, seen   # what is compared does not follow the size of the cells


def test_shortest_paths_merge_like_plain_dijkstra(spark):
    import heapq
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b), float(w)) for a, b, w in zip(rng.integers(0, 80, 300), rng.integers(0, 80, 300), rng.integers(0, 9, 300))]
    edges += [(i, i + 1, 1.0) for i in range(80, 85)] + [(3, 80, 2.0)]
    out = {}
    for s, t, w in edges:
        out.setdefault(s, []).append((t, w))
    dist, heap = {0: 0.0}, [(0.0, 0)]
    while heap:
        d, u = heapq.heappop(heap)
        if d > dist[u]:
            continue
        for t, w in out.get(u, []):
            if d + w < dist.get(t, math.inf):
                dist[t] = d + w
                heapq.heappush(heap, (d + w, t))
    v = spark.createDataFrame([(i,) for i in range(87)], "id long")
    e = spark.createDataFrame(edges, "src long, dst long, weight double")
    for every in (3,):
        rows = {r["id"]: (r["distance"], r["predecessor"]) for r in G.shortest_paths(v, e, 0, merge_every=every).collect()}
        assert {i: d for i, (d, _) in rows.items() if d is not None} == dist and len(rows) == 87
        for i, (d, p) in rows.items():
            if p is not None:
                assert any(s == p and t == i and dist[s] + w == d for s, t, w in edges)
                seen = {i}
                while p is not None:           # following predecessors leads to the origin
                    assert p not in seen
                    seen.add(p)
                    p = rows[p][1]
                assert 0 in seen or i == 0
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tessera_")]


def test_chunks_that_share_no_pair_of_cells(spark):
    # one group of chunks holds rows of two different pairs and finds no distance: its empty frame keeps text keys
    q = spark.createDataFrame([("a", "b", 0, 0, 1, 0.0, 0.0)], "src string, dst string, cx long, cy long, id long, x double, y double")
    c = spark.createDataFrame([("a", "c", 0, 0, 2, 1.0, 0.0)], q.schema)
    assert D._closest(q, c, 16).collect() == []

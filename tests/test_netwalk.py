import heapq
import random
from collections import defaultdict

import pytest

from ridgeline.operators import netwalk
from tests.test_solver import cross, metres

WAYS, STARTS, LINES = "way long, seq int, lat double, lon double", "gap long, lat double, lon double", "gap long, seq int, lat double, lon double"


def plain(ways, starts, lines, most, reach):
    near = defaultdict(set)
    for pts in ways.values():
        pts = [(round(a, 5), round(b, 5)) for a, b in pts]
        for p, q in zip(pts, pts[1:], strict=False):
            if p != q:
                near[p].add(q)
                near[q].add(p)
    out = {}
    for gap, s in starts.items():
        d, n0 = min(((metres(s, n), n) for n in near), default=(1e9, None))
        if d > reach:
            continue
        dist, heap, best = {n0: 0.0}, [(0.0, n0)], None
        while heap:
            m, u = heapq.heappop(heap)
            if m > dist[u] or m > most:
                continue
            for v in near[u]:
                for p, q in zip(lines[gap], lines[gap][1:], strict=False):
                    x = cross(u, v, p, q)
                    if x and (best is None or m + metres(u, x) < best):
                        best = m + metres(u, x)
                if m + metres(u, v) < dist.get(v, 1e18):
                    dist[v] = m + metres(u, v)
                    heapq.heappush(heap, (dist[v], v))
        if best is not None:
            out[gap] = best
    return out


@pytest.mark.parametrize("most,reach", [(1200.0, 120.0), (300.0, 60.0)])
def test_walks_are_those_of_a_heap(spark, most, reach):
    rng = random.Random(int(most))
    node = lambda i, j: (46 + i * 0.0009, 10 + j * 0.0013)
    ways = {}
    for i in range(9):
        for j in range(9):
            for di, dj in ((0, 1), (1, 0)):
                if rng.random() < 0.7:
                    a, b = node(i, j), node(i + di, j + dj)
                    ways[len(ways)] = [a, ((a[0] + b[0]) / 2 + rng.uniform(-1e-4, 1e-4), (a[1] + b[1]) / 2 + rng.uniform(-1e-4, 1e-4)), b]
    place = lambda: (46 + rng.uniform(-0.002, 0.01), 10 + rng.uniform(-0.002, 0.014))
    starts, lines = {}, {}
    for gap in range(60):
        starts[gap], p = place(), place()
        lines[gap] = [p] if gap % 20 == 0 else [p, (p[0] + rng.uniform(-0.002, 0.002), p[1] + rng.uniform(-0.002, 0.002)), place()]
    rows = lambda d: [(k, i, *p) for k, pts in d.items() for i, p in enumerate(pts)]
    got = netwalk.first_cuts(spark.createDataFrame(rows(ways), WAYS), spark.createDataFrame([(k, *p) for k, p in starts.items()], STARTS), spark.createDataFrame(rows(lines), LINES), most_m=most, reach_m=reach).collect()
    want = plain(ways, starts, lines, most, reach)
    assert {r.gap for r in got} == set(want) and len(want) >= 5
    edges = {(e.src, e.dst): e.w for e in netwalk.network_edges(spark.createDataFrame(rows(ways), WAYS)).collect()}
    for r in got:
        assert r.walked_m == pytest.approx(want[r.gap], abs=1e-6)
        assert r.path[-1] == r.node and sum(edges[x] for x in zip(r.path, r.path[1:], strict=False)) <= r.walked_m


def test_nothing_to_walk(spark):
    ways, starts, lines = (spark.createDataFrame([], s) for s in (WAYS, STARTS, LINES))
    assert netwalk.first_cuts(ways, starts, lines).count() == 0
    one = spark.createDataFrame([(1, 0, 46.0, 10.0), (1, 1, 46.0, 10.001)], WAYS)
    assert netwalk.first_cuts(one, spark.createDataFrame([(5, 46.0, 10.0)], STARTS), lines).count() == 0


def test_starts_at_one_node_with_one_line_walk_once(spark, monkeypatch):
    """Gaps that share node and line have one walk, however many they are; each gets its row."""
    rows: dict[str, list[int]] = defaultdict(list)
    settled = netwalk.settled

    def counted(df, name):
        out = settled(df, name)
        rows[name].append(out.count())
        return out

    monkeypatch.setattr(netwalk, "settled", counted)
    ways = [(1, k, 46.0, 10 + k * 0.001) for k in range(6)]
    starts = [(g, 46.00001 * (1 + g % 3 * 1e-8), 10.0) for g in range(60)]
    lines = [(g, k, 45.999 + k * 0.002, 10.0025 + g % 2 * 0.001) for g in range(60) for k in range(2)]
    got = netwalk.first_cuts(spark.createDataFrame(ways, WAYS), spark.createDataFrame(starts, STARTS), spark.createDataFrame(lines, LINES)).collect()
    want = {g: metres((46.0, 10.0), (46.0, 10.0025 + g % 2 * 0.001)) for g in range(60)}
    assert {r.gap: pytest.approx(r.walked_m, abs=1e-3) for r in got} == want and len(got) == 60
    assert max(rows["front"]) == 2 and max(rows["seen"]) <= 12 and sum(rows["cuts"]) <= 8

import random
from collections import defaultdict

import pytest

from ridgeline.operators import waymerge
from tests.test_solver import metres

SCHEMA = "way long, kind string, name string, seq int, lat double, lon double"


def plain(ways, tol=1.0):
    """(pieces, lines): ends given away pair by pair, then each chain walked from its smallest way."""
    ends = {2 * w + e: (k, n, pts[-e]) for w, (k, n, pts) in ways.items() if len(pts) > 1 for e in (0, 1)}
    pairs = sorted((metres(p, q), u, v) for u, (k, n, p) in ends.items() for v, (l, m, q) in ends.items() if u < v and u // 2 != v // 2 and (k, n) == (l, m) and metres(p, q) <= tol)
    match = {}
    for _, u, v in pairs:
        if u not in match and v not in match:
            match[u], match[v] = v, u
    pieces, lines, seen = {}, {}, set()
    for w in sorted(ways):
        if w in seen:
            continue
        node, members = 2 * w, {w}  # back to the head of the direction in which w lies as it is
        while node in match and (b := match[node] ^ 1) != 2 * w:
            node = b
            members.add(node // 2)
        order, n = [], node
        while True:
            order.append(n)
            members.add(n // 2)
            if (n ^ 1) not in match or match[n ^ 1] == node:
                break
            n = match[n ^ 1]
        if (node in match) and match[node] ^ 1 == order[-1]:  # a ring: from w on
            k = order.index(2 * w)
            order = order[k:] + order[:k]
        seen |= members
        line = []
        for pos, n in enumerate(order):
            pieces[n // 2] = (w, pos, n % 2 == 1)
            pts = ways[n // 2][2]
            line += (pts[::-1] if n % 2 else pts)[1 if pos else 0 :]
        lines[w] = line
    return pieces, lines


def run(spark, ways, tol=1.0):
    rows = [(w, k, n, i, *p) for w, (k, n, pts) in ways.items() for i, p in enumerate(pts)]
    random.Random(1).shuffle(rows)
    pieces, line = waymerge.merged_ways(spark.createDataFrame(rows, SCHEMA).repartition(3), tol)
    lines = defaultdict(list)
    for r in sorted(line.collect(), key=lambda r: (r.chain, r.seq)):
        assert r.seq == len(lines[r.chain])
        lines[r.chain].append((r.lat, r.lon))
    return {r.way: (r.chain, r.pos, r.reversed) for r in pieces.collect()}, dict(lines)


def street(lat, lon, n, step=0.001):
    return [(float(lat), lon + step * k) for k in range(n + 1)]


def test_long_chain_settles_in_few_rounds(spark, monkeypatch):
    """60 ways one after the other, some the other way round, in shuffled order of ids."""
    rng = random.Random(3)
    ids = rng.sample(range(1000), 60)
    pts = street(46.0, 10.0, 60)
    ways = {w: ("track", "long", [pts[k], pts[k + 1]][:: rng.choice((1, -1))]) for k, w in enumerate(ids)}
    rounds = []
    kept = waymerge.settled
    monkeypatch.setattr(waymerge, "settled", lambda df, name: rounds.append(name) or kept(df, name))
    assert run(spark, ways) == plain(ways)
    assert rounds.count("ranks") <= 8


def test_rings_junctions_and_single_ways(spark):
    """Rings of one to four ways, junctions of three and four, kinds and names that differ, at the pole and at 180 degrees."""
    def ring(lat, lon, n):
        lat = float(lat)
        around = [(lat, lon), (lat, lon + 0.001), (lat + 0.001, lon + 0.001), (lat + 0.001, lon)]
        cut = around[:n] + [around[0]]
        return [[cut[k], cut[k + 1]] for k in range(n)]

    ways = {}
    put = lambda pts, kind="path", name=None: ways.__setitem__(3 + 7 * len(ways) % 997, (kind, name, pts))
    for n in (2, 3, 4):
        for k, pts in enumerate(ring(46 + n, 10.0, n)):
            put(pts[:: 1 if k % 2 else -1])
    put([(50.0, 8.0), (50.001, 8.0), (50.0, 8.0)])  # a ring of itself
    for lat, lon in ((51, 8), (51.001, 8), (50.999, 8), (51, 8.001)):
        put([(51.0, 8.0), (lat + 0.0005, lon + 0.0004)])
    put(street(52, 9, 1), "track", "a")
    put(street(52, 9.001, 1), "track", "b")
    put(street(52, 9.002, 1), None, "b")
    put(street(52, 9.003, 1), None, "b")
    put([(53.0, 9.0)])
    put([(60.0, 179.9995), (60.0, 180.0)])
    put([(60.0, -179.999996), (60.0, -179.9995)])
    put([(89.9999, 10.0), (89.99999999, 10.0)])
    put([(89.99999999, -120.0), (89.9998, -120.0)])
    got, want = run(spark, ways), plain(ways)
    assert got == want and len({c for c, _, _ in got[0].values()}) < len(ways)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_networks(spark, seed):
    rng = random.Random(seed)
    node = lambda: (46 + rng.randrange(9) * 0.001 + rng.uniform(-3e-6, 3e-6), 10 + rng.randrange(9) * 0.001)
    ways = {rng.randrange(10**6): (rng.choice(("path", "track", None)), rng.choice(("x", "y", None)), [node() for _ in range(rng.randint(2, 4))]) for _ in range(160)}
    assert run(spark, ways) == plain(ways)


def test_empty(spark):
    pieces, line = waymerge.merged_ways(spark.createDataFrame([], SCHEMA))
    assert pieces.count() == 0 and line.count() == 0


def test_rows_that_explode_are_not_sent_through_the_driver(spark):
    from pyspark.sql import functions as F

    from ridgeline.operators.nearest import around_in_space
    from ridgeline.operators.settle import settled

    places = spark.range(50).select("id", (46 + F.col("id") / 1000).alias("lat"), F.lit(10.0).alias("lon"))
    around, small = around_in_space(places, "lat", "lon", 100.0), settled(places, "places")
    for met in (around.join(places.select(F.col("id").alias("_x")), "_x"), places.join(small.select("id"), "id", "left_anti")):
        assert "Broadcast" not in met._jdf.queryExecution().executedPlan().toString()


def test_long_chains_of_one_type_are_one_group(spark):
    from pyspark.sql import functions as F

    from ridgeline.operators.gaps import same_type_groups

    i = F.col("id")
    ways = spark.range(120).select(i.alias("way"), F.lit("path").alias("kind"), F.when(i < 100, "x").otherwise("y").alias("name"), (46 + i / 1000).alias("a_lat"), F.lit(10.0).alias("a_lon"), (46 + (i + 1) / 1000).alias("b_lat"), F.lit(10.0).alias("b_lon"))
    got = {r.way: r.group for r in same_type_groups(ways).collect()}
    assert got == {k: 0 if k < 100 else 100 for k in range(120)}


def test_ends_of_ways_meet_by_a_shuffle(spark):
    """Few bytes of ends are many rows around them: a driver of 750 MB could not hold them."""
    ways = spark.createDataFrame([(1, "a", "b", 0, 46.0, 10.0), (1, "a", "b", 1, 46.1, 10.0), (2, "a", "b", 0, 46.1, 10.0), (2, "a", "b", 1, 46.2, 10.0)], SCHEMA)
    assert "Broadcast" not in waymerge.touching_ends(ways, 1.0)._jdf.queryExecution().executedPlan().toString()

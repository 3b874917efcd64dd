import math
import random

from pyspark.sql import functions as F

from ridgeline.operators import gaps, lines, nearest, ranking, regions
from ridgeline.sources import scans


def test_catalog_literal(spark):
    source = """x = 1; // REGION_ in a comment {
    const REGION_CATALOG = { /* old: { label: "no" }, */
      aa: { label: "Alpha/Beta", url: "http://x.y//z", trailCount: 12, box: [[1, 2], { a: 1 }], subRegions: { north: { label: 'Nord "x"', color: "#fff" }, south: { color: "#000" } } },
      bb: { label: "B-Land" } // no sub-regions }
    }; const other = { zz: { label: "z" } };"""
    got = scans.catalog_rows(spark, source)
    assert sorted(got.collect(), key=str) == sorted([("aa", "Alpha/Beta", 12, "north", "#fff", 'Nord "x"'), ("aa", "Alpha/Beta", 12, "south", "#000", None), ("bb", "B-Land", None, None, None, None)], key=str)
    labels = {r.region_key: r.labels for r in scans.region_labels(got).collect()}
    assert labels == {"aa": ["Alpha", "Alpha/Beta", "Beta", 'Nord "x"'], "bb": ["B", "B-Land", "Land"]}


def _globe(rng, n):
    return [(round(math.degrees(math.asin(rng.uniform(-1, 1))), 6), rng.uniform(-180, 180)) for _ in range(n)]


def _km(p, q):
    x = math.sin(math.radians(q[0] - p[0]) / 2) ** 2 + math.cos(math.radians(p[0])) * math.cos(math.radians(q[0])) * math.sin(math.radians(q[1] - p[1]) / 2) ** 2
    return 2 * 6371 * math.asin(min(1, math.sqrt(x)))


#: The poles, both sides of 180 degrees, far from everything, beside an anchor.
ODD = [(90.0, 0.0), (-90.0, 77.0), (89.99, -120.0), (0.5, 179.99), (0.5, -179.99), (80.0, 0.0), (-75.0, 0.0), (0.0, 180.0), (47.0004, 10.0), (47.2, 10.3)]


def test_anchors_by_list_and_by_cells_agree(spark, monkeypatch):
    rng = random.Random(3)
    anchors = _globe(rng, nearest.FEW + 200) + [(47.0, 10.0), (47.001, 10.0), (0.5, -179.95), (0.5, 179.9), (47.0, 10.0)] + [(46 + rng.uniform(0, 0.5), 10 + rng.uniform(0, 0.5)) for _ in range(200)]
    near = [(46 + rng.uniform(-0.5, 1), 10 + rng.uniform(-0.5, 1)) for _ in range(60)]
    rows = _globe(rng, 120) + ODD + near
    a = spark.createDataFrame([(i, *p) for i, p in enumerate(anchors)], "anchor int, lat double, lon double")
    at = spark.createDataFrame([(i, *p) for i, p in enumerate(rows)], "line int, lat double, lon double").repartition(3)
    got = {r.line: (r.anchor, r.km) for r in nearest.nearest_anchor(at, a).collect()}
    for i, p in enumerate(rows):
        best = min((_km(p, q), k) for k, q in enumerate(anchors))
        assert got[i][0] == best[1] and abs(got[i][1] - best[0]) < 1e-6, p
    monkeypatch.setattr(nearest, "FEW", 5000)
    assert {r.line: r.anchor for r in nearest.nearest_anchor(at, a).collect()} == {k: v[0] for k, v in got.items()}


def test_lines_far_from_a_long_list(spark):
    """All anchors in one place: lines on the other side of the globe go down the cells."""
    rng = random.Random(4)
    anchors = [(46 + rng.uniform(0, 2), 10 + rng.uniform(0, 2)) for _ in range(nearest.FEW + 50)]
    a = spark.createDataFrame([(i, *p) for i, p in enumerate(anchors)], "anchor int, lat double, lon double")
    rows = ODD + _globe(rng, 30)
    got = {r.line: (r.anchor, r.km) for r in nearest.nearest_anchor(spark.createDataFrame([(i, *p) for i, p in enumerate(rows)], "line int, lat double, lon double"), a, 100.0).collect()}
    for i, p in enumerate(rows):
        d, k = min((_km(p, q), k) for k, q in enumerate(anchors))
        assert got[i][0] == (k if d <= 100 else None) and abs(got[i][1] - d) < 1e-6


def test_cheapest_places_of_a_long_list(spark):
    rng = random.Random(5)
    places = [(*p, rng.choice((0.0, 500.0, 40_000.0, 3e6))) for p in _globe(rng, nearest.FEW + 100)]
    q = spark.createDataFrame([(i, *p) for i, p in enumerate(places)], "anchor int, la double, lo double, extra double")
    rows = _globe(rng, 60) + ODD
    out = nearest.cheapest_places(spark.createDataFrame([(i, *p) for i, p in enumerate(rows)], "line int, lat double, lon double"), q, 4).collect()
    got = {(r.line, r.rank): (r.anchor, r.cost) for r in out}
    assert len(out) == 4 * len(rows)
    for i, p in enumerate(rows):
        for rank, (cost, k) in enumerate(sorted((1000 * _km(p, x[:2]) + x[2], k) for k, x in enumerate(places))[:4], 1):
            assert got[i, rank][0] == k and abs(got[i, rank][1] - cost) < 1e-3


def test_dense_places_are_settled_by_rings(spark, monkeypatch):
    """Lines among many places meet those in the cubes around, and never all first cubes of the tree; copies of a place share an answer."""
    rng = random.Random(6)
    spots = [(46 + rng.uniform(0, 1), 10 + rng.uniform(0, 1)) for _ in range(nearest.FEW + 100)]
    places = [(*p, rng.choice((0.0, 500.0, 4_000.0))) for p in spots + spots[:9] * 6]
    q = spark.createDataFrame([(i, *p) for i, p in enumerate(places)], "anchor int, la double, lo double, extra double")
    rows = [(46.2 + rng.uniform(0, 0.6), 10.2 + rng.uniform(0, 0.6)) for _ in range(30)] * 2 + spots[:9]
    monkeypatch.setattr(nearest, "_down_the_cells", None)
    out = nearest.cheapest_places(spark.createDataFrame([(i, *p) for i, p in enumerate(rows)], "line int, lat double, lon double"), q, 4).collect()
    got = {(r.line, r.rank): (r.anchor, r.cost) for r in out}
    assert len(out) == 4 * len(rows)
    for i, p in enumerate(rows):
        for rank, (cost, k) in enumerate(sorted((1000 * _km(p, x[:2]) + x[2], k) for k, x in enumerate(places))[:4], 1):
            assert got[i, rank][0] == k and abs(got[i, rank][1] - cost) < 1e-3


def test_preferences_and_arrows(spark):
    assert regions.preferences("3:2 way, 7:0,x:1, 9, 11:") == {3: "2 way", 7: "0"}
    got = regions.arrows(spark.createDataFrame([(1, 0.0), (2, 0.1), (3, 100.0)], "line int, km double")).groupBy("line").count().collect()
    assert sorted(map(tuple, got)) == [(2, 1), (3, 40)]


def test_profile_slice(spark):
    p = spark.createDataFrame([(1, k, e) for k, e in ((0.0, 1000.0), (1.0, 1100.0), (2.0, 900.0), (3.0, 900.0))], "line int, km double, ele double")
    got = regions.profile_slice(p, spark.createDataFrame([(1, 0.5, 1.5)], "line int, lo double, hi double")).orderBy("km").collect()
    assert [(r.km, r.ele) for r in got] == [(0.5, 1050.0), (1.0, 1100.0), (1.5, 1000.0)]


def test_ways_chain_and_trails_are_built(spark):
    step = lambda a, b: [(46 + i / 1000, 10.0) for i in range(a, b)]
    rows = [("g", 0, i, *p) for i, p in enumerate(step(0, 5))] + [("g", 1, i, *p) for i, p in enumerate(step(4, 7)[::-1])] + [("g", 2, i, *p) for i, p in enumerate(step(90, 92))]
    got = lines.chained_ways(spark.createDataFrame(rows, "group string, piece int, seq int, lat double, lon double")).orderBy("seq").collect()
    assert [round(r.lat, 3) for r in got] == [round(46 + i / 1000, 3) for i in range(7)] and {r.left_over for r in got} == {1}
    raw = [(1, i, 46 + i / 1000, 10.0 + (0.001 if i == 3 else 0), 500.0 + 10 * i) for i in range(7)] + [(1, 7, 46.006, 10.0, None)]
    known = spark.createDataFrame([("46.00600,10.00000", 560.0)], "key string, ele double")
    built = lines.built_trails(spark.createDataFrame(raw, "line int, seq int, lat double, lon double, ele double"), known).orderBy("k").collect()
    assert [(r.lat, r.lon) for r in built] == [(46.006, 10.0), (46.004, 10.0), (46.003, 10.001), (46.002, 10.0), (46.0, 10.0)]
    assert built[0].ele == 560.0 and built[-1].ele == 500.0


def test_bridge_along_the_way_that_fits(spark):
    way = lambda w, lon: [(1, w, i, 46 + i / 1000, lon) for i in range(8)]
    ways = spark.createDataFrame(way(10, 10.0) + way(11, 10.01), "gap int, way int, seq int, lat double, lon double")
    points = spark.createDataFrame([(1, i, 46 + i / 1000, 10.00001) for i in range(4)], "gap int, i int, lat double, lon double")
    penalty = spark.createDataFrame([(10, 0.0), (11, 0.0)], "way int, penalty_m double")
    ends = spark.createDataFrame([(1, 46.0055, 10.0, 46.0015, 10.0)], "gap int, a_lat double, a_lon double, b_lat double, b_lon double")
    got = gaps.bridge_along_way(ends, points, ways, penalty).orderBy("k").collect()
    assert [round(r.lat, 4) for r in got] == [46.0055, 46.005, 46.004, 46.003, 46.002, 46.0015]


def test_route_pages_and_aerialways(spark):
    html = "encodedpath: '_p~iF~ps|U_ulLnnqC_p~iF~ps|U' "
    pages = spark.createDataFrame([("a", html), ("b", "none")], "slug string, html string")
    got = {r.slug: r.points for r in scans.route_geometry(pages).collect()}
    assert len(got["a"]) == 3 and got["a"][0].ele is None and got["b"] is None
    w = spark.createDataFrame([(1, {"aerialway": "gondola", "name": "G"}, [(46.0, 10.0), (46.01, 10.0)]), (2, {"aerialway": "t-bar"}, [(46.0, 10.0), (46.0001, 10.0)]), (3, {"highway": "path"}, [(46.0, 10.0), (47.0, 10.0)])], "way_id int, tags map<string, string>, points array<struct<lat: double, lon: double>>")
    assert [(r.way_id, r.kind, r.name) for r in scans.aerialways(w).collect()] == [(1, "gondola", "G")]


def test_shapes(spark):
    rows = [("in", [5.0] * 10), ("tail", [1.0] * 6 + [20.0, 40.0, 70.0, 120.0]), ("few", [1.0, 2.0]), ("mixed", [1.0, 500.0] * 5)]
    got = {r.k: r.s for r in spark.createDataFrame(rows, "k string, d array<double>").select("k", ranking.profile_shape(F.col("d")).alias("s")).collect()}
    assert got == {"in": "subsumed", "tail": "junction", "few": "unclear", "mixed": "unclear"}


def test_more_groups_than_a_list_holds(spark):
    """Means of very many groups go by cells; none is refused and none is crossed with all points."""
    n = 100_500
    members = spark.range(n).selectExpr("id as region", "cast(id % 300 as double) / 10 + 30 as lat", "cast(floor(id / 300) as double) / 10 - 10 as lon")
    rows = [(1, 30.02, -9.99), (2, 45.01, 5.02), (3, 59.9, 23.4)]
    got = {r.line: r.region for r in regions.nearest_centroid(spark.createDataFrame(rows, "line int, lat double, lon double"), members).collect()}
    assert got == {1: 0, 2: 150 * 300 + 150, 3: 334 * 300 + 299}


def test_copies_of_a_place_are_no_conflicts(spark, monkeypatch):
    rng = random.Random(7)
    spots = [(46 + rng.uniform(0, 0.02), 10 + rng.uniform(0, 0.03)) for _ in range(25)]
    rows = [(i, *rng.choice(spots)) for i in range(400)]
    seen, settle = [], ranking.greedy_survivors
    monkeypatch.setattr(ranking, "greedy_survivors", lambda nodes, conflicts, node: (seen.append(conflicts.count()), settle(nodes, conflicts, node))[1])
    got = {r.id for r in ranking.first_of_near(spark.createDataFrame(rows, "id int, lat double, lon double"), 500.0, (0.006, 0.009)).collect()}
    kept = []
    for i, *p in rows:
        if all(_km(p, q) * 1000 > 500 for _, q in kept):
            kept.append((i, p))
    assert got == {i for i, _ in kept} and seen[0] <= 25 * 24 / 2


def test_near_route_with_copies_of_boxes(spark):
    # 30 boxes of routes and 40 of lines, each many times; arrays of 3, so a box has several
    box = lambda df, m, k: df.select(F.col("id").alias(k), *((F.lit(b) + F.col("id") % m * s + d).alias(c) for c, b, s, d in (("min_lat", -0.05, 0.004, 0.0), ("min_lon", 9.95, 0.003, 0.0), ("max_lat", -0.05, 0.004, 0.03), ("max_lon", 9.95, 0.003, 0.02))))
    r, b = box(spark.range(150), 30, "route"), box(spark.range(200), 40, "line")
    got = regions.near_route(r, b, 0.001, chunk=3)
    rows = [(x.route, x.line) for x in got.collect()]
    left = [tuple(x) for x in r.collect()]
    want = [(i, j) for i, a, o, c, d in left for j, e, f, g, h in (tuple(x) for x in b.collect()) if a - 0.001 <= g and e <= c + 0.001 and o - 0.001 <= h and f <= d + 0.001]
    assert sorted(rows) == sorted(want) and len(want) > 5000
    # boxes meet, not rows: some hundred arrays are joined
    assert len(rows) > 5 * got.sparkSession.createDataFrame(rows, "route long, line long").select(F.col("route") % 30, F.col("line") % 40).distinct().count()
    assert "_route" in got._jdf.queryExecution().optimizedPlan().toString()

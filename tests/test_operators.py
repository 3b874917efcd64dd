import json

import pytest
from pyspark.sql import functions as F

from ridgeline.operators import chain, facets, graph, lines, nearest, ranking, runs, tables
from ridgeline.sources import scans, sinks
from ridgeline.streaming import tracks

GPX = """<gpx><metadata><name>412 &quot;Crag &amp; Fern&quot;</name></metadata><trk><trkseg><trkpt lon="10.5" lat="46.5"><ele><![CDATA[1500]]></ele></trkpt>
<trkpt lat="46.6" lon="10.6"/><trkpt lat="46.7"></trkpt><trkpt lat="-46.8" lon="-10.7"><ele> 1490.5 </ele></trkpt></trkseg></trk></gpx>"""


def points(spark, *lists):
    rows = [(n, i, float(p[0]), float(p[1]), None if len(p) < 3 or p[2] is None else float(p[2])) for n, line in enumerate(lists) for i, p in enumerate(line)]
    return spark.createDataFrame(rows, "line int, seq int, lat double, lon double, ele double")


def test_gpx_scan(spark):
    files = spark.createDataFrame([("a", GPX), ("b", '<rte><rtept lat="1" lon="2">x</rtept></rte>'), ("c", ""), ("d", None)], "path string, text string")
    got = [(r.path, r.seq, r.lat, r.lon, r.ele) for r in scans.gpx_points(files).orderBy("path", "seq").collect()]
    assert got == [("a", 0, 46.5, 10.5, 1500.0), ("a", 1, 46.6, 10.6, None), ("a", 2, -46.8, -10.7, 1490.5), ("b", 0, 1.0, 2.0, None)]
    names = {r.path: r.n for r in files.select("path", scans.gpx_name(F.col("text")).alias("n")).collect()}
    assert names["a"] == "Crag & Fern" and names["b"] is None


def test_kml_and_triples(spark):
    files = spark.createDataFrame([("k", "<coordinates>10.5,46.5,900 bad 10.6,46.6</coordinates><coordinates>\n11,47,0\n</coordinates>")], "path string, text string")
    assert [(r.seq, r.lat, r.lon, r.ele) for r in scans.kml_points(files).orderBy("seq").collect()] == [(0, 46.5, 10.5, 900.0), (1, 46.6, 10.6, None), (2, 47.0, 11.0, 0.0)]
    x = spark.createDataFrame([("10,46,0 11,47,5",)], "g string")
    assert [p.ele for p in x.select(scans.triples(F.col("g"), " ", drop_zero=True).alias("p")).first().p] == [None, 5.0]


def test_polyline(spark):
    x = spark.createDataFrame([("_p~iF~ps|U_ulLnnqC_mqNvxq`@",), (None,)], "p string")
    rows = x.select(scans.decoded_polyline(F.col("p")).alias("q")).collect()
    assert [(round(p.lat, 3), round(p.lon, 3)) for p in rows[0].q] == [(38.5, -120.2), (40.7, -120.95), (43.252, -126.453)] and rows[1].q is None


def test_listing(spark):
    cells = "".join(f'<td data-v="{v}">x</td>' for v in ("1720", "-173.1", "12"))
    row = f'<tr ><td title="Status"><span class="x" title="Open"></span></td><td><span class="dicon_small d2" title="Intermediate / Blue Square"></span></td><td><a href="https://www.trailforks.com/trails/alpha-line/" class="green">Alpha <b>Line</b></a><a href="https://www.trailforks.com/region/some-area/">Some Area</a></td>{cells}</tr>'
    hidden = row.replace("alpha-line", "beta").replace('class="green"', 'class="hidden_trail"')
    html = f'<p>x</p><table id="trails_table">{row}{hidden}<tr ><td>short</td></tr></table><table>{row}</table>'
    pages = spark.createDataFrame([(1, html), (2, "no table"), (3, None)], "page int, html string")
    got = scans.listing_rows(pages).orderBy("row_no").collect()
    assert [(r.slug, r.name, r["diff"], r.area, r.area_slug, r.m, r.down, r.up, r.hidden) for r in got] == [("alpha-line", "Alpha Line", "Intermediate / Blue Square", "Some Area", "some-area", 1720.0, -173.1, 12.0, False), ("beta", "Alpha Line", "Intermediate / Blue Square", "Some Area", "some-area", 1720.0, -173.1, 12.0, True)]
    listed = scans.listing_rows(pages).withColumn("seed_no", F.lit(2)).union(scans.listing_rows(pages).withColumn("seed_no", F.lit(1)))
    first = scans.first_seed_wins(listed).collect()
    assert len(first) == 2 and {r.seed_no for r in first} == {1}
    assert [r.slug for r in scans.to_harvest(scans.listing_rows(pages), scans.listing_rows(pages).where("hidden")).collect()] == ["alpha-line"]


def test_halves_collapse_as_often_as_they_repeat(spark):
    x = spark.createDataFrame([([1, 2] * 64,), ([1, 2, 3] * 32,), (None,)], "a array<int>")
    assert [r.h for r in x.select(scans.halves_collapsed(F.col("a")).alias("h")).collect()] == [[1, 2], [1, 2, 3], None]


def test_page_geometry_and_halves(spark):
    html = """encodedpath: '_p~iF~ps|U_ulLnnqC'; new ElevationChart({"id":1,"x":"0","y":1500,"lat":"46.5","lng":"10.5"},{"id":2,"x":10.5,"y":"1490","lat":46.6,"lng":10.6})"""
    pages = spark.createDataFrame([("a", html), ("b", "nothing")], "slug string, html string")
    far = 'new ElevationChart(' + ",".join('{"id":%d,"x":%d,"y":1,"lat":2,"lng":3}' % (i, i) for i in range(20_000)) + ")"
    assert len(far) > 400_000 and len(scans.page_geometry(spark.createDataFrame([("c", far)], "slug string, html string")).first().p) == 20_000
    got = {r.slug: r for r in scans.page_geometry(pages).collect()}
    assert len(got["a"].c) == 2 and [(p.x, p.ele, p.lat, p.lon) for p in got["a"].p] == [(0.0, 1500.0, 46.5, 10.5), (10.5, 1490.0, 46.6, 10.6)]
    assert got["b"].c is None and got["b"].p is None
    x = spark.createDataFrame([([1, 2, 1, 2, 1, 2, 1, 2],), ([1, 2, 1, 3],), ([1, 1],)], "a array<int>")
    assert [r.h for r in x.select(scans.halves_collapsed(F.col("a")).alias("h")).collect()] == [[1, 2], [1, 2, 1, 3], [1, 1]]


def test_osm_and_elevation(spark):
    body = json.dumps({"elements": [{"type": "way", "id": 7, "tags": {"highway": "path"}, "geometry": [{"lat": 46.5, "lon": 10.5}]}, {"type": "node", "id": 1}]})
    w = scans.osm_ways(spark.createDataFrame([(body,)], "text string")).first()
    assert w.way_id == 7 and w.tags["highway"] == "path" and w.points[0].lat == 46.5
    known = spark.createDataFrame([("46.50000,10.50000", 900.0)], "key string, ele double")
    assert [r.ele_found for r in scans.elevations(points(spark, [(46.5, 10.5), (46.6, 10.5)]), known).orderBy("seq").collect()] == [900.0, None]


def test_profile(spark):
    flat = [(47 + k * 0.001, 10.0, None if k == 3 else 0.0 if k == 5 else 1500 - 5 * k) for k in range(20)]
    zero = [(47 + k * 0.001, 10.0, 0.0) for k in range(5)]
    p = lines.cumulative_km(lines.clean_elevation(points(spark, flat, zero)))
    got = lines.resample(p)
    assert {r.line: r.n for r in got.groupBy("line").agg(F.count(F.lit(1)).alias("n")).collect()} == {0: 100, 1: 100}
    assert got.where("line = 0").agg(F.min("ele")).first()[0] > 1400 and got.where("line = 1").agg(F.max("ele")).first()[0] == 0
    total = {r.line: (r.gain, r.loss) for r in lines.gain_loss(got).collect()}
    assert total[0][0] == 0 and 75 <= total[0][1] <= 95 and total[1] == (0, 0)
    sizes = points(spark, [(47, 10 + 0.001 * k, 5) for k in range(120)], [(47 + 0.1 * k, 10, 5) for k in range(4)])
    n = {r.line: r.n for r in lines.resample(lines.cumulative_km(lines.clean_elevation(sizes))).groupBy("line").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert n == {0: 150, 1: 200}


def test_linear_reference(spark):
    profile = spark.createDataFrame([(1, 0.0, 1000.0), (1, 1.0, 1100.0), (1, 2.0, 900.0), (1, 3.0, 900.0)], "line int, km double, ele double")
    at = spark.createDataFrame([(1, 0.5), (1, 1.5), (1, 99.0), (1, -1.0)], "line int, at double")
    assert {r["at"]: r.ele for r in lines.value_at(profile, at).collect()} == {0.5: 1050.0, 1.5: 1000.0, 99.0: 900.0, -1.0: 1000.0}


def test_split_on_gaps(spark):
    got = lines.split_on_gaps(points(spark, [(47, 10), (47.0005, 10), (47.1, 10), (47.1002, 10)])).orderBy("piece").collect()
    assert [(r.first, r.last, r.n, r["rank"]) for r in got] == [(0, 1, 2, 1), (2, 3, 2, 2)]


def test_joint_gaps(spark):
    seg = [(1, 0, 47.0, 10.0, 47.01, 10.0), (1, 1, 47.01, 10.0, 47.02, 10.0), (1, 2, 47.023, 10.0, 47.006, 10.0), (2, 0, 47.0, 10.0, 48.0, 10.0)]
    frame = spark.createDataFrame(seg, "line int, seq int, start_lat double, start_lon double, end_lat double, end_lon double")
    got = {(r.seq, r.next_seq): r.gap_m for r in runs.joint_gaps(frame, 100.0).collect()}
    assert set(got) == {(1, 2), (2, 0)} and abs(got[1, 2] - 333) < 2 and abs(got[2, 0] - 667) < 2
    assert runs.joint_gaps(frame, 100.0, wrap=False).count() == 1


def test_votes_and_runs(spark):
    labels = ["a", None, "b", "b", None, None, "a", "a", "a"]
    frame = spark.createDataFrame([(1, i, x) for i, x in enumerate(labels)], "line int, seq int, label string")
    from collections import Counter

    want = [Counter(labels[max(0, i - 1) : i + 2]).most_common(1)[0][0] for i in range(len(labels))]
    assert [r.voted for r in runs.majority(frame, 3).orderBy("seq").collect()] == want
    r = [(x.label, x.a, x.b) for x in runs.run_lengths(frame).orderBy("a").collect()]
    assert r == [("a", 0, 0), (None, 1, 1), ("b", 2, 3), (None, 4, 5), ("a", 6, 8)]
    assert [(x.label, x.a, x.b) for x in runs.consolidated(runs.run_lengths(frame), 3, 2).orderBy("a").collect()] == [("b", 2, 3), ("a", 6, 8)]


def test_direction_split(spark):
    rows = [(1, i, p) for i, p in enumerate([0.0, 0.2, 0.4, 0.6, 0.8, 0.6, 0.4, 0.2, 0.0])] + [(2, i, 0.1 * i) for i in range(9)] + [(3, i, p) for i, p in enumerate([0.8, 0.6, 0.4, 0.2, 0.0, 0.2, 0.4, 0.6, 0.8])]
    got = {r.line: r.turn for r in runs.direction_split(spark.createDataFrame(rows, "line int, seq int, position double")).collect()}
    assert got == {1: 4, 2: None, 3: 4}


def test_network_labels(spark):
    network = points(spark, [(47, 10), (47.002, 10)], [(47, 10.001), (47.002, 10.001)]).withColumnRenamed("line", "cand")
    track = points(spark, [(47.001, 10.0001), (47.001, 10.0009), (47.5, 10.5)]).drop("ele")
    got = nearest.label_points(track, network, 15.0).orderBy("seq").collect()
    assert [r.label for r in got] == [0, 1, None] and abs(got[0].d - 7.6) < 0.2


def test_greedy_survivors(spark):
    nodes = spark.createDataFrame([(i,) for i in range(8)], "id int")
    conflicts = spark.createDataFrame([(0, 1), (1, 2), (2, 3), (4, 5), (4, 6), (5, 6)], "a int, b int")
    assert sorted(r.id for r in ranking.greedy_survivors(nodes, conflicts).collect()) == [0, 2, 4, 7]


def test_spaced_places(spark):
    rows = [("r", "s", "big", 47.0, 10.0, False, False, 0, 5000, 1.0), ("r", "s", "near", 47.01, 10.0, False, False, 0, 100, 1.0), ("r", "s", "namesake", 47.02, 10.0, False, True, 2, 0, 1.0), ("r", "s", "far", 47.2, 10.0, False, False, 1, 50, 2.0), ("r", "s", "forced", 47.001, 10.0, True, False, 3, 0, 9.0)]
    frame = spark.createDataFrame(rows, "region string, sub string, name string, lat double, lon double, forced boolean, namesake boolean, kind_rank int, population int, km double")
    assert {r.name for r in ranking.spaced_places(frame).collect()} == {"forced", "namesake", "far"}
    assert {r.name for r in ranking.spaced_places(frame, quota={"s": 1}).collect()} == {"forced"}


def test_shortest_paths(spark):
    e = [(1, "a", "b", 1.0), (1, "b", "c", 1.0), (1, "a", "c", 3.0), (2, "a", "c", 1.5)]
    edges = spark.createDataFrame(e + [(p, d, s, w) for p, s, d, w in e], "part int, src string, dst string, w double")
    gaps = spark.createDataFrame([(1, "a", "c"), (2, "a", "c"), (1, "a", "z")], "part int, src string, dst string")
    got = {(r.part, r.dst): (r.metres, r.hops) for r in graph.shortest_paths(edges, gaps).collect()}
    assert got[1, "c"] == (2.0, 2) and got[2, "c"] == (1.5, 1)
    assert got[1, "z"][0] is None or got[1, "z"][0] != got[1, "z"][0]


def test_merge_and_constraints(spark):
    old = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    new = spark.createDataFrame([(2, "b"), (3, "c")], "k int, v string")
    assert sorted(map(tuple, sinks.upsert(old, new, "k").collect())) == [(1, "a"), (2, "b"), (3, "c")]
    assert {r.k: r.state for r in tables.snapshot_diff(old, new, "k", "v").collect()} == {1: "removed", 2: "changed", 3: "added"}
    line = spark.createDataFrame([(1, 0, 47.0, 10.0), (1, 1, 47.1, 10.0)], "line int, seq int, lat double, lon double")
    assert tables.concatenation_errors(line, line).count() == 0
    assert tables.concatenation_errors(line, line.where("seq = 0")).count() == 1


def test_region_documents(spark):
    t = spark.createDataFrame([("r", "a", "A", 1.5)], "region_key string, id string, name string, len double")
    g = spark.createDataFrame([("r", "a", 1, 47.1, 10.0), ("r", "a", 0, 47.0, 10.0)], "region_key string, id string, seq int, lat double, lon double")
    e = spark.createDataFrame([("r", "a", 0, 0.0, 900.0)], "region_key string, id string, k int, km double, ele double")
    d = json.loads(sinks.region_documents(t, g, e).first().document)
    assert d["trailGeo"] == {"a": [[47.0, 10.0], [47.1, 10.0]]} and d["lineTrails"][0]["name"] == "A"
    assert list(json.loads(sinks.region_text({"places": [], "lineTrails": [1], "lifts": []}))) == ["lineTrails", "places"]


def test_facets_solo_and_chain(spark):
    lifts = spark.createDataFrame([("l1",), ("l2",), ("l3",)], "id string")
    segments = spark.createDataFrame([("loop", "l1"), ("other", "l2"), ("loop", None)], "loop_id string, lift_id string")
    assert {r.id: r.hidden for r in facets.hidden_by_solo(lifts, segments, "loop", "l3").collect()} == {"l1": False, "l2": True, "l3": False}
    assert facets.active_groups(["a", "b", "a", "c", "d"]) == ["b", "c", "d"]
    profiles = spark.createDataFrame([("t", k, float(k), 1000.0 - 100 * k) for k in range(4)], "id string, k int, km double, ele double")
    known = spark.createDataFrame([("t", 3.0, 5, 300)], "id string, len double, up int, down int")
    elements = spark.createDataFrame([("c", 0, "t", 0.0, 3.0, False), ("c", 1, "t", 2.0, 0.5, True)], "chain string, seq int, id string, from_km double, to_km double, clipped boolean")
    r = chain.chain_totals(elements, known, profiles).first()
    assert (r.km, r.up, r.down) == (4.5, 155.0, 300.0)


def test_match_scores(spark):
    truth = spark.createDataFrame([("x", i, c, False) for i, c in enumerate("aabcd")], "case string, seq int, id string, reversed boolean")
    found = spark.createDataFrame([("x", i, c, c == "d") for i, c in enumerate("abxd")], "case string, seq int, id string, reversed boolean")
    r = chain.match_scores(truth, found).first()
    assert (r.found, r.direction_ok, r.total) == (3, 2, 4)


def test_streams(spark, tmp_path):
    rows = [("d", 10.0), ("d", 350.0), ("d", 350.0)]
    batch = spark.createDataFrame([([h for _, h in rows],)], "h array<double>").select(tracks.smoothed_headings(F.col("h")).alias("s")).first().s
    state = 10.0
    for h in (350.0, 350.0):
        state = (state + ((h - state + 540) % 360 - 180) * 0.2) % 360
    assert abs(batch - state) < 1e-9
    shown = tracks.readout(spark.createDataFrame([(5.0, None), (None, 1203.4)], "speed double, altitude double")).collect()
    assert [(r.kmh, r.altitude_shown) for r in shown] == [("18 km/h", "–"), ("–", "1203 m")]
    source = str(tmp_path / "in")
    spark.createDataFrame([(1, "2026-01-01 00:00:00"), (1, "2026-01-01 00:10:00"), (1, "2026-01-01 02:00:00")], "user_id int, t string").select("user_id", F.col("t").cast("timestamp").alias("ts")).write.parquet(source)
    stream = spark.readStream.schema("user_id int, ts timestamp").parquet(source)
    q = tracks.sessions(stream).writeStream.format("memory").queryName("sessions").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.n for r in spark.table("sessions").collect()) == [1, 2]


def test_stretch_starts_at_the_first_of_equal_places(spark):
    from ridgeline.operators import gaps

    rows = [(1, 0, 46.0, 0.0), (1, 1, 46.01, 1200.0), (1, 2, 46.01, 1200.0), (1, 3, 46.02, 2400.0), (2, 0, 46.01, 0.0), (2, 1, 46.01, 0.0), (2, 2, 46.01, 0.0)]
    recording = spark.createDataFrame([(line, seq, lat, 10.0, m) for line, seq, lat, m in rows], "line int, seq int, lat double, lon double, m double")
    ends = spark.createDataFrame([(1, 46.01, 10.0, 46.02, 10.0, 1112.0), (2, 46.01, 10.0, 46.01, 10.0, 0.0)], "line int, a_lat double, a_lon double, b_lat double, b_lon double, gap_m double")
    got = gaps.stretch_between(recording, ends, 60.0)
    assert [tuple(r) for r in got.orderBy("line").collect()] == [(1, 1, 3, 1200.0), (2, 0, 1, 0.0)]


def test_name_keys_keep_numbers(spark, tmp_path):
    from ridgeline.plans import queries

    docs = [(1, "829484 grün"), (2, "Section 12 Höhe"), (3, "jump section à é")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.resort_key for r in queries.name_keys(spark, str(tmp_path)).collect()}
    assert got == {1: "829484gruntrail", 2: "section12hohetrail", 3: "jumpsectionaetrail"}


def test_nearest_in_cells_meets_each_place_once(spark):
    import time

    probes = spark.range(30_000).select(F.col("id").alias("probe"), F.when(F.col("id") == 7, 46.001).otherwise(46.0).alias("lat"), F.lit(10.0).alias("lon"))
    places = spark.range(30_000).select((F.col("id") + 5).alias("point"), F.when(F.col("id") == 9, 46.001).otherwise(46.0).alias("lat"), F.lit(10.0).alias("lon"))
    began = time.time()
    got = {r.probe: (r.point, round(r.d)) for r in nearest.nearest_in_cells(probes, places, 300.0, (0.003, 0.0045)).collect()}
    assert got == {k: (14, 0) if k == 7 else (5, 0) for k in range(30_000)} and time.time() - began < 30


def test_places_meet_ways_once(spark, monkeypatch):
    """Of copies of a point, or of an edge, one meets the ways, and all have its answer."""
    from ridgeline.operators import gaps, nearest

    met = []
    for module in (gaps, nearest):
        monkeypatch.setattr(module, "in_cell", lambda df, size, f=module.in_cell: (met.append(df), f(df, size))[1])
    ways = spark.createDataFrame([(1, 0, 46.0, 10.0), (1, 1, 46.0, 10.01), (2, 0, 46.001, 10.0), (2, 1, 46.001, 10.01)], "way int, seq int, lat double, lon double")
    copies = spark.createDataFrame([(k, s, 46.0002 + 0.004 * s, 10.002) for k in range(40) for s in (0, 1)] + [(99, 0, None, 10.0)], "line int, seq int, lat double, lon double")
    near = {(r.line, r.seq): (r.way, round(r.d, 3)) for r in gaps.nearest_edge(copies, ways, 100.0, 0.002, ["line", "seq"]).collect()}
    assert set(near) == {(k, 0) for k in range(40)} and len(set(near.values())) == 1 and near[0, 0][0] == 1
    labels = nearest.label_points(copies, ways.withColumnRenamed("way", "cand"), 100.0, 0.002).collect()
    assert len(labels) == 81 and all((r.label == 1) == (r.seq == 0 and r.line < 99) for r in labels)
    off = {r.line: (round(r.length_m), round(r.off_m)) for r in gaps.off_way_metres(copies, ways, 50.0, 10.0).collect()}
    assert set(off) == set(range(40)) and len(set(off.values())) == 1 and 0 < off[0][1] < off[0][0] == 445
    assert [df.count() for df in met] == [2, 2, 45]


@pytest.mark.parametrize("front_rows", [0, 1000])
def test_large_parts_are_searched_in_rounds(spark, monkeypatch, front_rows):
    """The same metres, hops and ways as the search by one task, ties among them."""
    import random

    rng = random.Random(11)
    e = {(p, f"n{rng.randrange(12)}", f"n{rng.randrange(12)}", float(rng.randint(1, 3))) for p in range(4) for _ in range(18)}
    edges = spark.createDataFrame([*e, *((p, d, s, w) for p, s, d, w in e)], "part int, src string, dst string, w double")
    gaps = spark.createDataFrame([(p, f"n{rng.randrange(13)}", f"n{rng.randrange(13)}") for p in range(5) for _ in range(8)] + [(0, "n1", "n1")] * 2, "part int, src string, dst string")
    told = lambda: sorted((r.part, r.src, r.dst, r.metres if r.hops is not None and r.hops == r.hops else None, tuple(r.path or ())) for r in graph.shortest_paths(edges, gaps).collect())
    by_task = told()
    monkeypatch.setattr(graph, "PART_EDGES", 0)
    monkeypatch.setattr(graph, "FRONT_ROWS", front_rows)
    assert told() == by_task and any(len(r[4]) > 2 for r in by_task) and any(not r[4] for r in by_task)


def test_boxes_of_copies_meet_once(spark):
    import random

    rng = random.Random(4)
    places = [(rng.randrange(12) * 0.001, rng.randrange(12) * 0.001, rng.randrange(4) * 0.001, rng.randrange(4) * 0.001) for _ in range(12)]
    b = [(i, *(lambda p: (p[0], p[1], p[0] + p[2], p[1] + p[3]))(places[rng.randrange(12)])) for i in range(80)]
    boxes = spark.createDataFrame(b, "line long, min_lat double, min_lon double, max_lat double, max_lon double")
    plain = sorted((p[0], q[0]) for p in b for q in b if p[0] < q[0] and p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4])
    got = nearest.overlapping_boxes(boxes, 0.002)
    assert sorted(map(tuple, got.collect())) == plain and len(plain) > 200
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") >= 1  # distinct boxes meet, not rows


def test_closest_of_all_blocks_is_closest_by_cells(spark):
    from ridgeline.operators import gaps

    # places of a grid, so that many pairs are equally far, on both sides of the equator and of Greenwich
    at = F.pmod(F.hash("id"), F.lit(400))
    t = spark.range(1500).select((F.col("id") % 40).alias("line"), F.col("id").alias("seq"), ((at / 20).cast("int") * 0.0007 - 0.007).alias("lat"), ((at % 20) * 0.0007 - 0.007).alias("lon"))
    t = t.unionByName(spark.sql("select 77L line, 0L seq, cast(null as double) lat, 0d lon"))
    a, b = t.withColumnRenamed("line", "a"), t.withColumnRenamed("line", "b")
    rows = lambda df: sorted((r.a, r.b, r.sa, r.sb, round(r.d, 6)) for r in df.collect())
    want = rows(gaps.closest_vertices(a, b, 90.0, (0.002, 0.003)))
    got = gaps.closest_of_all(a, b, 90.0, (0.002, 0.003), block=200, ways=16)
    assert rows(got) == want and len(want) > 1000
    assert rows(gaps.closest_of_all(a.where("a < 0"), b, 90.0, (0.002, 0.003))) == []
    # no pair of vertices is shuffled: what meets is blocks
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan

import numpy as np
from pyspark.sql import functions as F

from ridgeline.operators import match


def line(a, b, n):
    return np.linspace(a, b, n)


def test_votes_and_merging(spark):
    labels = ["a"] * 5 + ["b"] + ["a"] * 4 + [None] * 3 + ["a"] * 4 + ["c"] * 2
    points = spark.createDataFrame([(1, i, x) for i, x in enumerate(labels)], "line int, seq int, label string")
    voted = match.by_vote(points, "label", F.lit(1))
    got = [r.voted for r in voted.orderBy("seq").collect()]
    assert got[5] == "a" and got[11] is None
    sizes = spark.createDataFrame([(1, 1.0, 4, 3)], "line int, spacing_m double, gap int, least int")
    own = spark.createDataFrame([("a", 100.0), ("c", 2.0)], "cand string, length_m double")
    assert [(r.label, r.a, r.b) for r in match.long_runs(voted, sizes, own).orderBy("a").collect()] == [("a", 0, 16), ("c", 17, 18)]
    assert [(r.label, r.a, r.b) for r in match.long_runs(voted, sizes, own.where("cand = 'a'")).collect()] == [("a", 0, 16)]


def test_turn(spark):
    rows = [(1, 0, "A", i, k, 75.0) for i, k in enumerate([0.0, 0.1, 0.2, 0.3, 0.2, 0.1, 0.0])] + [(2, 0, "A", i, k, 75.0) for i, k in enumerate([0.0, 0.1, 0.2, 0.3])]
    got = match.ridden(spark.createDataFrame(rows, "line int, run int, cand string, seq int, km double, spacing_m double"))
    assert sorted((r.line, r.a, r.b, r.reversed) for r in got.collect()) == [(1, 0, 3, False), (1, 4, 6, True), (2, 0, 3, False)]


def test_track_against_network(spark):
    """Down one line, over open ground, up and back down a second, one of them recorded 25 m aside."""
    a, b = line([47.0, 10.0], [47.02, 10.0], 41), line([47.03, 10.01], [47.045, 10.01], 31)
    net = [("A", i, *p) for i, p in enumerate(a.tolist())] + [("B", i, *p) for i, p in enumerate(b.tolist())]
    network = spark.createDataFrame(net, "cand string, seq int, lat double, lon double")
    ride = np.concatenate([a[::-1] + [0, 0.00005], line([47.0, 10.0], [47.03, 10.0101], 30)[1:-1] + [0, 0.004], b + [0, 0.00033], b[::-1] + [0, 0.00033]])
    track = spark.createDataFrame([(1, i, *p) for i, p in enumerate(ride.tolist())], "line int, seq int, lat double, lon double")
    m = match.matched(track, network)
    got = [(r.cand, r.reversed) for r in m.orderBy("a").collect()]
    assert got == [("A", True), ("B", False), ("B", True)]
    e = match.extended(m, track, network).orderBy("a").collect()
    assert e[0].lo_km == 0.0 and abs(e[0].hi_km - 2.2239) < 0.01


def test_tracks_that_stand_still(spark):
    """A parked recorder, one point, one point twice, beside a proper ride: no track is lost and none stops the others."""
    a = line([47.0, 10.0], [47.02, 10.0], 41)
    network = spark.createDataFrame([("A", i, *p) for i, p in enumerate(a.tolist())], "cand string, seq int, lat double, lon double")
    rows = [(1, i, *p) for i, p in enumerate(a.tolist())] + [(2, i, 47.01, 10.0) for i in range(300)] + [(3, 0, 47.01, 10.0)] + [(4, i, 50.0, 8.0) for i in range(2)]
    track = spark.createDataFrame(rows, "line int, seq int, lat double, lon double").repartition(3)
    got = {(r.line, r.cand, r.a, r.b, r.reversed) for r in match.matched(track, network).collect()}
    assert (1, "A", 0, 40, False) in got and {x[0] for x in got} <= {1, 2, 3}
    assert match.matched(track.where("line > 9"), network).count() == 0
    assert match.matched(track, network.where("seq > 99")).count() == 0


def test_windows_are_no_longer_than_the_track(spark):
    sizes = spark.createDataFrame([(1e-9, 1), (1e-9, 300), (10.0, 300), (10.0, 5)], "m double, n long")
    got = [r[0] for r in sizes.select(match.in_points(150.0, F.col("m"), 3, F.col("n"))).collect()]
    assert got == [3, 301, 15, 6]


def test_points_far_from_their_run_s_line_meet_all_its_edges(spark):
    a = line([47.0, 10.0], [47.02, 10.0], 41)
    network = spark.createDataFrame([("A", i, *p) for i, p in enumerate(a.tolist())], "cand string, seq int, lat double, lon double")
    track = spark.createDataFrame([(1, 0, 47.0, 10.0), (1, 1, 47.01, 10.05), (1, 2, 47.02, 10.0001)], "line int, seq int, lat double, lon double")
    runs = spark.createDataFrame([(1, 0, "A", 0, 2)], "line int, run int, cand string, a int, b int")
    got = {r.seq: r.km for r in match.places(runs, track, network).collect()}
    assert abs(got[0]) < 1e-9 and abs(got[1] - 1.112) < 0.01 and abs(got[2] - 2.2239) < 0.001

"""Small facts computed by hand, and kernels against plain Python."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridgeline.functions import geo, text
from ridgeline.operators import chain, lines, ranking


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def L(*v):
    return tuple(F.lit(float(x)) for x in v)


def test_haversine(spark):
    assert abs(one(spark, geo.haversine_m(*L(47, 10, 47.01, 10))) - 1112) < 5
    assert abs(one(spark, geo.haversine_m(*L(47, 10, 47, 10.01))) - 758) < 5
    assert one(spark, geo.haversine_m(F.lit(None).cast("double"), *L(10, 47, 10))) is None


def test_line_and_edge_distances_differ_beyond_the_ends(spark):
    p, a, b = L(47.01, 10.05), L(47, 10), L(47, 10.01)
    assert abs(one(spark, geo.perp_distance_m(p, a, b)) - 1105.4) < 2
    assert one(spark, geo.edge_distance_m(p, a, b)) > 3000
    assert one(spark, geo.edge_projection(p, a, b)["t"]) == 1.0
    assert one(spark, geo.edge_projection(p, a, a)["t"]) == 0.0
    assert abs(one(spark, geo.perp_distance_m(p, a, a)) - one(spark, geo.haversine_m(*p, *a))) < 1e-6


def test_crossing(spark):
    hit = one(spark, geo.crossing(L(0, 0), L(1, 1), L(0, 1), L(1, 0)))
    assert abs(hit.lat - 0.5) < 1e-9 and abs(hit.lon - 0.5) < 1e-9
    assert one(spark, geo.crossing(L(0, 0), L(1, 1), L(1, 0), L(2, 1))) is None
    assert one(spark, geo.crossing(L(0, 0), L(0.4, 0.4), L(0, 1), L(1, 0))) is None


def test_boxes_and_padding(spark):
    box = lambda *v: F.struct(*(F.lit(float(x)).alias(n) for n, x in zip(("min_lat", "min_lon", "max_lat", "max_lon"), v, strict=True)))
    assert one(spark, geo.boxes_overlap(box(0, 0, 1, 1), box(1, 1, 2, 2))) is True
    assert one(spark, geo.boxes_overlap(box(0, 0, 1, 1), box(1.1, 0, 2, 1))) is False
    b = one(spark, geo.padded_box(*L(47, 10, 47.01, 10.01), 1113.2))
    assert abs(b.min_lat - 46.99) < 1e-4 and abs(b.max_lon - (10.01 + 0.01 / math.cos(math.radians(47.005)))) < 1e-4


def test_bearing_and_destination_are_inverse(spark):
    end = one(spark, geo.destination(*L(46, 9, 63, 1500)))
    assert abs(one(spark, geo.haversine_m(*L(46, 9, end.lat, end.lon))) - 1500) < 0.01
    assert abs(one(spark, geo.bearing_deg(*L(46, 9, end.lat, end.lon))) - 63) < 0.01
    assert one(spark, geo.lift_climb(*L(1000, 1958.4))) == 958 and one(spark, geo.lift_climb(*L(2000, 1000))) == 0


def test_text_keys(spark):
    s = F.lit
    assert one(spark, text.slug(s(" Schöne Grüße – Trail! "))) == "schoene_gruesse_trail"
    assert one(spark, text.duplicate_key(s("Borderline Trail"))) == "borderline" and one(spark, text.duplicate_key(s("Borderline Uphill"))) == "borderline_uphill"
    assert one(spark, text.resort_key(s("703 Rock'n'Roll Sektion 2"))) == "rocknroll" and one(spark, text.resort_key(s("Brambrüesch"))) == "brambruesch"
    assert one(spark, text.prefixed_id("gd", s("601--Pernici/Trail"))) == "gd_601_pernici_trail"
    assert one(spark, text.ascii_key(s("Äbc-1 d"))) == "bc1d"
    keys = [one(spark, text.natural_key(s(x))) for x in ("Trail 2", "Trail 10", "Trail 1a")]
    assert keys[2] < keys[0] < keys[1]


def test_fuzzy_lookup(spark):
    left = spark.createDataFrame([("Flow Line",), ("Flwo Line",), ("nothing like it",), (None,)], "asked string")
    right = spark.createDataFrame([("flow-line",), ("Rock Garden",)], "name string")
    got = {r.asked: r.found for r in text.fuzzy_lookup(left, right, "asked", "name").collect()}
    assert got == {"Flow Line": "flow-line", "Flwo Line": "flow-line", "nothing like it": None}


def test_access_rules(spark):
    tags = lambda **k: F.create_map(*(F.lit(x) for kv in k.items() for x in kv))
    assert one(spark, ranking.blocked_reason(tags(vehicle="forestry"))) == "vehicle=forestry"
    assert one(spark, ranking.blocked_reason(tags(vehicle="forestry", bicycle="yes"))) is None
    assert one(spark, ranking.blocked_reason(tags(access="private", vehicle="no"))) == "access=private"
    assert one(spark, ranking.type_penalty(F.lit("track"))) == 6 and one(spark, ranking.type_penalty(F.lit("unheard of"))) == 12


@pytest.mark.parametrize(
    "distances, shape",
    [([0, 1, 2], "unclear"), ([1, 2, 3, 4], "subsumed"), ([30, 40, 50, 55], "subsumed"), ([5, 5, 5, 60, 90, 150, 220], "junction"), ([220, 150, 90, 60, 5, 5, 5], "junction"), ([100, 5, 100, 5, 100, 5], "unclear"), ([90, 100, 110, 120], "unclear"), ([70, 5, 5, 5, 75], "subsumed")],
)
def test_profile_shape(spark, distances, shape):
    frame = spark.createDataFrame([([float(x) for x in distances],)], "d array<double>")
    assert frame.select(ranking.profile_shape(F.col("d")).alias("s")).first().s == shape


def test_simplification_and_spacing():
    straight = np.array([[47 + k * 0.001, 10.0] for k in range(5)])
    assert lines.kept_by_shape(straight, 2.0).tolist() == [True, False, False, False, True]
    corner = np.array([[47, 10.0], [47.001, 10.0], [47.001, 10.001]])
    assert lines.kept_by_shape(corner, 2.0).all()
    close = np.array([[47, 10.0], [47.000001, 10.0], [47.000002, 10.0], [47.01, 10.0]])
    assert lines.kept_by_spacing(close, 0.5).tolist() == [True, False, False, True]


def test_chaining():
    a, b, c = (np.array(x, float) for x in ([[0, 0], [0, 0.01]], [[0, 0.02], [0, 0.01]], [[5, 5], [5, 5.001]]))
    line, left = lines.chained([a, b, c])
    assert left == [2] and line[0].tolist() in ([0, 0], [0, 0.02]) and len(line) == 3


def test_chain_resolution():
    known = {"a": {"km": 2.0}, "b": {"km": 3.0}}
    out = chain.resolve([{"id": "a", "reversed": False, "entry": None, "exit": 1.5, "gap_m": 20}, {"id": "b", "reversed": True, "entry": 2.0, "exit": 2.5, "gap_m": 10}, {"id": "a", "reversed": False, "entry": 2.0, "exit": 1.0, "gap_m": 400}], known)
    assert (out[0]["from"], out[0]["to"], out[0]["clipped"]) == (0.0, 1.5, True)
    assert (out[1]["from"], out[1]["to"], out[1]["reason"]) == (2.0, 0.0, "exit")
    assert (out[2]["from"], out[2]["to"], out[2]["reason"]) == (0.0, 2.0, "next")
    assert chain.aligned(list("abcde"), list("xbdey")) == [(1, 1), (3, 2), (4, 3)]


def test_of_equal_deviations_the_first_stays():
    # two places that deviate equally, where products of whole coordinates part them by a micrometre
    for ids, kept in (([285, 361, 713, 117], [0, 1, 3]), ([265, 281, 746, 334, 450, 588, 932, 315, 106], [0, 1, 4, 5, 6, 8])):
        xy = np.array([[46 + i * 37 % 1000 / 20000, 10 + i * 91 % 1000 / 20000] for i in ids])
        assert np.flatnonzero(lines.kept_by_shape(xy, 400.0)).tolist() == kept

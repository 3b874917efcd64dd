"""Queries of the gap-closing operators over the driver's tables, and of the matcher, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridgeline.functions import geo
from ridgeline.operators import gaps, graph, lines, match, nearest, ranking, runs
from ridgeline.plans.queries import _NETWORK, CUM, SEGMENTS, STEPS, TOWNS, TRACK, TRAILS, _network, _segments, hav, query, table, towns, track, trails

CAP_M, SIZE = 200.0, 0.004


def _near_sql(points: str, keys: str, cap: float = CAP_M) -> str:
    """CTEs down to `near`: each point's nearest place on the network, by brute force."""
    own = ", ".join(f"p.{k}" for k in keys.split(", "))
    return f"""n0 AS (SELECT {own}, p.lat AS plat, p.lon AS plon, n.line AS way, n.lat AS a, n.lon AS b, n.lat2 AS c, n.lon2 AS d, greatest(0.15, cos(radians((n.lat + n.lat2) / 2))) AS co FROM {points} p JOIN net n
  ON p.lat BETWEEN n.lat - 0.01 AND n.lat2 + 0.01 AND p.lon BETWEEN n.lon - 0.02 AND n.lon2 + 0.02),
 n1 AS (SELECT *, ((plon - b) * co * 111320 * (d - b) * co * 111320 + (plat - a) * 110540 * (c - a) * 110540) / (pow((d - b) * co * 111320, 2) + pow((c - a) * 110540, 2)) AS t0 FROM n0),
 n2 AS (SELECT *, CASE WHEN t0 < 0 THEN 0 WHEN t0 > 1 THEN 1 ELSE t0 END AS t FROM n1), n3 AS (SELECT *, a + t * (c - a) AS at_lat, b + t * (d - b) AS at_lon FROM n2),
 n4 AS (SELECT *, {hav("plat", "plon", "at_lat", "at_lon")} AS dist FROM n3),
 near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY dist, way) AS rk FROM n4 WHERE dist <= {cap}) WHERE rk = 1)"""


_EDGE = "edge AS (SELECT line, seq, lat, lon, lead(lat) OVER w AS lat2, lead(lon) OVER w AS lon2, row_number() OVER w AS i, count(*) OVER (PARTITION BY line) AS n FROM track WINDOW w AS (PARTITION BY line ORDER BY seq))"


def _ways(spark, sf_dir):
    return _network(spark, sf_dir).withColumnRenamed("line", "way")


def _track(spark, sf_dir):
    return track(spark, sf_dir).select("line", "seq", "lat", "lon")


@query(f"WITH {TRACK}, {TOWNS}, {_NETWORK}, {_near_sql('track', 'line, seq')} SELECT line, seq, way, round(dist, 2) AS d, round(t, 4) AS t FROM near")
def nearest_way(spark, sf_dir):
    got = gaps.nearest_edge(_track(spark, sf_dir), _ways(spark, sf_dir), CAP_M, SIZE, ["line", "seq"])
    return got.select("line", "seq", "way", F.round("d", 2).alias("d"), F.round("t", 4).alias("t"))


@query(f"""WITH {TRACK}, {TOWNS}, {_NETWORK}, {_EDGE}, m AS (SELECT *, {hav("lat", "lon", "lat2", "lon2")} AS m FROM edge WHERE lat2 IS NOT NULL),
 c AS (SELECT *, unnest(range(parts)) AS k FROM (SELECT *, CASE WHEN m > 250 THEN ceil(m / 250)::INT ELSE 1 END AS parts FROM m)),
 mid AS (SELECT line, seq, k, m / parts AS m, lat + (k + 0.5) / parts * (lat2 - lat) AS lat, lon + (k + 0.5) / parts * (lon2 - lon) AS lon FROM c), {_near_sql('mid', 'line, seq, k')}
SELECT x.line, round(sum(x.m), 1) AS length_m, round(sum(CASE WHEN y.line IS NULL THEN x.m ELSE 0 END), 1) AS off_m FROM mid x LEFT JOIN near y ON x.line = y.line AND x.seq = y.seq AND x.k = y.k GROUP BY 1""")
def off_way_metres(spark, sf_dir):
    got = gaps.off_way_metres(_track(spark, sf_dir), _ways(spark, sf_dir), CAP_M, 250.0, SIZE)
    return got.select("line", F.round("length_m", 1).alias("length_m"), F.round("off_m", 1).alias("off_m"))


@query(f"""WITH {TRACK}, {TOWNS}, {_NETWORK}, {_EDGE}, mid AS (SELECT line, seq, {hav("lat", "lon", "lat2", "lon2")} AS m, (lat + lat2) / 2 AS lat, (lon + lon2) / 2 AS lon FROM edge WHERE lat2 IS NOT NULL AND n >= 4 AND i > 1 AND i < n - 1), {_near_sql('mid', 'line, seq')}
SELECT t.line, round(coalesce(sum(x.m), 0), 1) AS double_m FROM (SELECT DISTINCT line FROM track) t LEFT JOIN (SELECT mid.* FROM mid JOIN near USING (line, seq)) x ON x.line = t.line GROUP BY 1""")
def double_ride_metres(spark, sf_dir):
    got = gaps.double_ride_metres(_track(spark, sf_dir), _ways(spark, sf_dir), CAP_M, SIZE)
    return got.select("line", F.round("double_m", 1).alias("double_m"))


_ENDS = {"a": (46.01, 10.02), "b": (46.03, 10.03)}


def _ends(spark, sf_dir):
    both = F.array(*(F.struct(F.lit(k).alias("which"), F.lit(v[0]).alias("lat"), F.lit(v[1]).alias("lon")) for k, v in _ENDS.items()))
    return track(spark, sf_dir).select("line").distinct().select("line", F.explode(both).alias("e")).select("line", "e.*")


_PROJECTED = f"""{TRACK}, {_EDGE}, ends AS (SELECT * FROM (VALUES {", ".join(f"('{k}', {v[0]}::DOUBLE, {v[1]}::DOUBLE)" for k, v in _ENDS.items())}) AS v(which, qlat, qlon)),
 p0 AS (SELECT line, which, seq AS edge, qlat, qlon, lat AS a, lon AS b, lat2 AS c, lon2 AS d, greatest(0.15, cos(radians((lat + lat2) / 2))) AS co FROM edge, ends WHERE lat2 IS NOT NULL),
 p1 AS (SELECT *, pow((d - b) * co * 111320, 2) + pow((c - a) * 110540, 2) AS sq FROM p0),
 p2 AS (SELECT *, CASE WHEN sq = 0 THEN 0 ELSE ((qlon - b) * co * 111320 * (d - b) * co * 111320 + (qlat - a) * 110540 * (c - a) * 110540) / sq END AS t0 FROM p1), p3 AS (SELECT *, CASE WHEN t0 < 0 THEN 0 WHEN t0 > 1 THEN 1 ELSE t0 END AS t FROM p2),
 p4 AS (SELECT *, a + t * (c - a) AS at_lat, b + t * (d - b) AS at_lon FROM p3), p5 AS (SELECT *, {hav("qlat", "qlon", "at_lat", "at_lon")} AS dist FROM p4),
 best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY line, which ORDER BY dist, edge) AS rk FROM p5) WHERE rk = 1)"""


@query(f"WITH {_PROJECTED} SELECT line, which, edge, round(t, 4) AS t, round(dist, 2) AS d FROM best")
def project_on_line(spark, sf_dir):
    p = gaps.projections(_ends(spark, sf_dir), _track(spark, sf_dir))
    return p.select("line", "which", "edge", F.round("t", 4).alias("t"), F.round("d", 2).alias("d"))


@query(f"""WITH {_PROJECTED}, ab AS (SELECT line, max(edge + t) FILTER (which = 'a') AS sa, max(edge + t) FILTER (which = 'b') AS sb FROM best GROUP BY 1),
 s AS (SELECT track.line, seq::DOUBLE AS s, lat, lon FROM track JOIN ab ON ab.line = track.line AND seq > least(sa, sb) AND seq < greatest(sa, sb) UNION ALL SELECT line, edge + t, at_lat, at_lon FROM best)
SELECT s.line, row_number() OVER (PARTITION BY s.line ORDER BY CASE WHEN sb < sa THEN -s ELSE s END) - 1 AS k, round(lat, 6) AS lat, round(lon, 6) AS lon FROM s JOIN ab USING (line)""")
def slice_between(spark, sf_dir):
    got = gaps.slice_between(_track(spark, sf_dir), _ends(spark, sf_dir))
    return got.select("line", F.col("k").cast("long").alias("k"), F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


@query(f"""WITH {TRACK}, ends AS (SELECT * FROM (VALUES {", ".join(f"('{k}', {v[0]}::DOUBLE, {v[1]}::DOUBLE)" for k, v in _ENDS.items())}) AS v(which, qlat, qlon)),
 v AS (SELECT line, which, seq, row_number() OVER (PARTITION BY line, which ORDER BY {hav("lat", "lon", "qlat", "qlon")}, seq) AS rk FROM track, ends),
 ab AS (SELECT line, max(seq) FILTER (which = 'a') AS a, max(seq) FILTER (which = 'b') AS b FROM v WHERE rk = 1 GROUP BY 1)
SELECT t.line, row_number() OVER (PARTITION BY t.line ORDER BY CASE WHEN b < a THEN -seq ELSE seq END) - 1 AS k, seq FROM track t JOIN ab ON ab.line = t.line AND seq BETWEEN least(a, b) AND greatest(a, b)""")
def clip_by_vertices(spark, sf_dir):
    return gaps.clip_by_vertices(_track(spark, sf_dir), _ends(spark, sf_dir)).select("line", F.col("k").cast("long").alias("k"), "seq")


@query(f"""WITH {TRACK}, {TOWNS}, v AS (SELECT t.line AS gap, t.seq AS i, a.anchor AS way, min({hav("t.lat", "t.lon", "x.lat", "x.lon")}) AS d, any_value(a.region) AS region FROM track t, towns a, LATERAL (SELECT a.lat, a.lon UNION ALL SELECT a.lat + 0.01, a.lon + 0.012) x
 WHERE a.region = t.line % 5 GROUP BY 1, 2, 3), s AS (SELECT gap, way, avg(d) AS mean_m, avg(d) + any_value(way % 4) * 6 AS score FROM v GROUP BY 1, 2)
SELECT gap, way, round(mean_m, 2) AS mean_m, round(score, 2) AS score FROM (SELECT *, row_number() OVER (PARTITION BY gap ORDER BY score, way) AS rk FROM s) WHERE rk = 1""")
def best_matching_way(spark, sf_dir):
    """A track's points against the ways of one sub-region."""
    t = towns(spark, sf_dir)
    points = _track(spark, sf_dir).select(F.col("line").alias("gap"), F.col("seq").alias("i"), "lat", "lon")
    own = points.select("gap").distinct().join(t.select("anchor", "region"), F.col("gap") % 5 == F.col("region")).select("gap", F.col("anchor").alias("way"))
    vertices = _network(spark, sf_dir).select((F.col("line") - 1_000_000).alias("_w"), "lat", "lon")
    cut = own.join(vertices, F.col("way") == F.col("_w")).select("gap", "way", "lat", "lon")
    penalty = t.select(F.col("anchor").alias("way"), (F.col("anchor") % 4 * 6).cast("double").alias("penalty_m"))
    return gaps.best_matching_way(points, cut, penalty).select("gap", "way", F.round("mean_m", 2).alias("mean_m"), F.round("score", 2).alias("score"))


@query(f"""WITH {TRACK}, {TOWNS}, {_NETWORK}, {_near_sql('track', 'line, seq')}, r AS (SELECT line, seq, row_number() OVER (PARTITION BY line ORDER BY seq) AS k FROM near)
SELECT line, seq FROM r WHERE k <= 6 UNION ALL SELECT line, min(seq) FROM track WHERE line NOT IN (SELECT line FROM near) GROUP BY 1""")
def reliable_points(spark, sf_dir):
    return gaps.reliable_points(_track(spark, sf_dir), _ways(spark, sf_dir), CAP_M, 6, SIZE)


@query(f"""WITH {TOWNS}, {_NETWORK}, {_PROJECTED.replace("best AS", "bst AS")}, best AS (SELECT * FROM bst WHERE which = 'a'), {_near_sql('track', 'line, seq')},
 st AS (SELECT line, seq, sum(coalesce({hav("plat", "plon", "lat", "lon")}, 0)) OVER (PARTITION BY line ORDER BY seq) AS m FROM (SELECT *, lag(lat) OVER (PARTITION BY line ORDER BY seq) AS plat, lag(lon) OVER (PARTITION BY line ORDER BY seq) AS plon FROM track)),
 m0 AS (SELECT b.line, b.edge, x.m + b.t * (y.m - x.m) AS m0 FROM best b JOIN st x ON x.line = b.line AND x.seq = b.edge JOIN st y ON y.line = b.line AND y.seq = b.edge + 1),
 w AS (SELECT st.line, CASE WHEN st.seq > m0.edge THEN 'forward' ELSE 'backward' END AS direction, st.seq, abs(st.m - m0) AS walked FROM st JOIN near ON near.line = st.line AND near.seq = st.seq JOIN m0 ON m0.line = st.line)
SELECT line, direction, seq, round(walked, 1) AS walked_m FROM (SELECT *, row_number() OVER (PARTITION BY line, direction ORDER BY walked, seq) AS rk FROM w WHERE walked <= 60000) WHERE rk = 1""")
def walk_to_line(spark, sf_dir):
    p = gaps.projections(_ends(spark, sf_dir), _track(spark, sf_dir)).where("which = 'a'")
    got = gaps.walk_to_line(_track(spark, sf_dir), p, _ways(spark, sf_dir), CAP_M, 60_000.0, SIZE)
    return got.select("line", "direction", "seq", F.round("walked_m", 1).alias("walked_m"))


@query(f"""WITH {TRACK}, d AS (SELECT x.line AS a, y.line AS b, x.seq AS sa, y.seq AS sb, {hav("x.lat", "x.lon", "y.lat", "y.lon")} AS d FROM track x JOIN track y ON x.line % 2 = 0 AND y.line % 2 = 1 AND abs(x.lat - y.lat) < 0.003 AND abs(x.lon - y.lon) < 0.004)
SELECT a, b, sa, sb, round(d, 2) AS d FROM (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY d, sa, sb) AS rk FROM d WHERE d <= 150) WHERE rk = 1""")
def junction_vertices(spark, sf_dir):
    """Of tracks of two kinds, even and odd, the closest vertices, where two ways can go over into each other."""
    t = _track(spark, sf_dir)
    a, b = t.where("line % 2 = 0").withColumnRenamed("line", "a"), t.where("line % 2 = 1").withColumnRenamed("line", "b")
    return gaps.closest_of_all(a, b, 150.0, (0.002, 0.003)).select("a", "b", "sa", "sb", F.round("d", 2).alias("d"))


_GAP_ENDS = "46 + (o_orderkey * 37 % 1000) / 20000.0::DOUBLE AS a_lat, 10 + (o_orderkey * 91 % 1000) / 20000.0::DOUBLE AS a_lon, 46 + (o_custkey * 37 % 1000) / 20000.0::DOUBLE AS b_lat, 10 + (o_custkey * 91 % 1000) / 20000.0::DOUBLE AS b_lon"


def _gap_ends(spark, sf_dir):
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    place = lambda k, m, base: (F.lit(base) + (k * m % 1000) / 20000.0)
    return table(spark, sf_dir, "orders").select(o.alias("gap"), place(o, 37, 46).alias("a_lat"), place(o, 91, 10).alias("a_lon"), place(c, 37, 46).alias("b_lat"), place(c, 91, 10).alias("b_lon"))


@query(f"""WITH {SEGMENTS}, con AS (SELECT line AS tour, seq // 4 AS segment, seq, start_lat AS lat, start_lon AS lon FROM seg), g AS (SELECT o_orderkey AS gap, {_GAP_ENDS} FROM orders),
 e AS (SELECT gap, segment, seq, {hav("a_lat", "a_lon", "lat", "lon")} AS da, {hav("b_lat", "b_lon", "lat", "lon")} AS db FROM g JOIN con ON con.tour = g.gap),
 a AS (SELECT gap, segment, seq AS ia, da FROM (SELECT *, row_number() OVER (PARTITION BY gap, segment ORDER BY da, seq) AS rk FROM e) WHERE rk = 1 AND da <= 2500),
 b AS (SELECT gap, segment, seq AS ib, db FROM (SELECT *, row_number() OVER (PARTITION BY gap, segment ORDER BY db, seq) AS rk FROM e) WHERE rk = 1 AND db <= 2500)
SELECT gap, segment, ia, ib, round(score, 2) AS score FROM (SELECT a.gap, a.segment, ia, ib, da + db AS score, row_number() OVER (PARTITION BY a.gap ORDER BY da + db, a.segment) AS rk FROM a JOIN b ON a.gap = b.gap AND a.segment = b.segment AND ia <> ib) WHERE rk = 1""")
def reusable_connector(spark, sf_dir):
    con = _segments(spark, sf_dir).select(F.col("line").alias("tour"), F.floor(F.col("seq") / 4).alias("segment"), "seq", F.col("start_lat").alias("lat"), F.col("start_lon").alias("lon"))
    g = _gap_ends(spark, sf_dir).withColumn("tour", F.col("gap"))
    got = gaps.reusable_connector(con, g, 2500.0)
    return got.select("gap", "segment", "ia", "ib", F.round("score", 2).alias("score"))


_STRETCH_GAP = hav("46.01", "10.02", "46.03", "10.03")


@query(f"""WITH {CUM}, x AS (SELECT line, seq, km * 1000 AS m, {hav("lat", "lon", "46.01", "10.02")} <= 900 AS at_a, {hav("lat", "lon", "46.03", "10.03")} <= 900 AS at_b, {_STRETCH_GAP} AS gap FROM cum),
 y AS (SELECT p.line, p.seq AS ia, q.seq AS ib, q.m - p.m AS r FROM x p JOIN x q ON p.line = q.line AND p.seq < q.seq AND p.at_a AND q.at_b AND q.m - p.m >= p.gap - 5 AND q.m - p.m <= greatest(12 * p.gap, p.gap + 250))
SELECT line, ia, ib, round(r, 1) AS ridden_m FROM (SELECT *, row_number() OVER (PARTITION BY line ORDER BY r, ia, ib) AS rk FROM y) WHERE rk = 1""")
def recording_stretch(spark, sf_dir):
    c = lines.cumulative_km(track(spark, sf_dir)).select("line", "seq", "lat", "lon", (F.col("km") * 1000).alias("m"))
    a, b = (tuple(map(F.lit, _ENDS[k])) for k in ("a", "b"))
    g = c.select("line").distinct().select("line", a[0].alias("a_lat"), a[1].alias("a_lon"), b[0].alias("b_lat"), b[1].alias("b_lon"), geo.haversine_m(*a, *b).alias("gap_m"))
    return gaps.stretch_between(c, g, 900.0, times=12.0).select("line", "ia", "ib", F.round("ridden_m", 1).alias("ridden_m"))


_SEQ_CAND = "c AS (SELECT line AS gap, seq AS no, row_number() OVER (PARTITION BY line ORDER BY l_extendedprice, seq) AS rank, l_returnflag <> 'N' AS relaxed, l_quantity AS trim FROM seg), g AS (SELECT o_orderkey AS gap, o_totalprice / 200 AS beeline, 20.0 + o_custkey % 30 AS budget FROM orders)"


@query(f"""WITH {SEGMENTS}, {_SEQ_CAND} SELECT gap, no, CASE WHEN relaxed THEN 'relaxed' ELSE 'strict' END AS mode FROM (SELECT c.gap, no, relaxed, row_number() OVER (PARTITION BY c.gap ORDER BY relaxed, rank, no) AS rk FROM c JOIN g USING (gap) WHERE beeline <= 1000 AND trim <= budget) WHERE rk = 1""")
def budgeted_acceptance(spark, sf_dir):
    from pyspark.sql import Window as W

    c = _segments(spark, sf_dir).select(F.col("line").alias("gap"), F.col("seq").alias("no"), F.row_number().over(W.partitionBy("line").orderBy("l_extendedprice", "seq")).alias("rank"), (F.col("l_returnflag") != "N").alias("relaxed"), F.col("l_quantity").alias("trim"))
    g = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("gap"), (F.col("o_totalprice") / 200).alias("beeline_m"), (F.lit(20.0) + F.col("o_custkey") % 30).alias("budget_m"))
    return gaps.accepted(c, g, 1000.0)


@query(f"""WITH {SEGMENTS}, s AS (SELECT line, seq AS pos, CASE WHEN l_returnflag = 'N' THEN 'connector' ELSE 'trail' END AS kind, CASE WHEN l_linestatus = 'O' THEN l_quantity END AS metres FROM seg),
 n AS (SELECT *, lead(kind) OVER (PARTITION BY line ORDER BY pos) AS nk FROM s), m AS (SELECT *, metres IS NOT NULL AND nk IS NOT DISTINCT FROM 'connector' AS to_next FROM n),
 k AS (SELECT line, pos::DOUBLE AS o, kind, CASE WHEN metres IS NOT NULL AND NOT to_next AND kind = 'connector' THEN metres ELSE 0 END + coalesce(lag(CASE WHEN to_next THEN metres ELSE 0 END) OVER (PARTITION BY line ORDER BY pos), 0) AS grown FROM m
  UNION ALL SELECT line, pos + 0.5, 'connector', metres FROM m WHERE metres IS NOT NULL AND NOT to_next AND kind <> 'connector')
SELECT line, row_number() OVER (PARTITION BY line ORDER BY o) - 1 AS at, kind, round(grown, 2) AS grown_m FROM k""")
def apply_bridges(spark, sf_dir):
    s = _segments(spark, sf_dir).select("line", F.col("seq").alias("pos"), F.when(F.col("l_returnflag") == "N", "connector").otherwise("trail").alias("kind"), F.col("l_quantity").alias("metres"), "l_linestatus")
    got = gaps.applied(s.select("line", "pos", "kind"), s.where("l_linestatus = 'O'").select("line", "pos", "metres"))
    return got.select("line", F.col("at").cast("long").alias("at"), "kind", F.round("grown_m", 2).alias("grown_m"))


@query("""WITH RECURSIVE w AS (SELECT p_partkey AS way, p_size % 4 AS kind, p_brand AS name, p_partkey % 97 AS a, p_partkey * 7 % 97 AS b FROM part),
 e AS (SELECT way, kind, name, unnest([a, b]) AS x FROM w), l AS (SELECT DISTINCT p.way AS u, q.way AS v FROM e p JOIN e q ON p.kind = q.kind AND p.name = q.name AND p.x = q.x),
 r AS (SELECT way AS u, way AS v FROM w UNION SELECT r.u, l.v FROM r JOIN l ON l.u = r.v) SELECT u AS way, min(v) AS "group" FROM r GROUP BY 1""")
def same_type_merge(spark, sf_dir):
    """Ways of one kind and name whose ends touch; ends are grid nodes."""
    p = F.col("p_partkey")
    node = lambda x: (46 + x / 1000.0)
    w = table(spark, sf_dir, "part").select(
        p.alias("way"), (F.col("p_size") % 4).cast("string").alias("kind"), F.col("p_brand").alias("name"), node(p % 97).alias("a_lat"), F.lit(10.0).alias("a_lon"), node(p * 7 % 97).alias("b_lat"), F.lit(10.0).alias("b_lon")
    )
    return gaps.same_type_groups(w)


@query("SELECT l_returnflag || l_linestatus AS method, count(*) AS n, round(avg(l_extendedprice / (l_quantity * 400)), 4) AS mean_factor, count(*) FILTER (l_extendedprice / (l_quantity * 400) > 3) AS suspicious FROM lineitem GROUP BY 1")
def closing_report(spark, sf_dir):
    g = table(spark, sf_dir, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("method"), (F.col("l_quantity") * 400).alias("beeline_m"), F.col("l_extendedprice").alias("route_m"))
    return gaps.closing_report(g).withColumn("mean_factor", F.round("mean_factor", 4))


@query(f"""WITH {TRACK}, p AS (SELECT line, seq, round(lat, 5) AS la, round(lon, 5) AS lo, lat, lon FROM track), e AS (SELECT line, la, lo, lead(la) OVER w AS la2, lead(lo) OVER w AS lo2, {hav("lat", "lon", "lead(lat) OVER w", "lead(lon) OVER w")} AS w FROM p WINDOW w AS (PARTITION BY line ORDER BY seq)),
 two AS (SELECT la, lo, w FROM e WHERE w > 0 UNION ALL SELECT la2, lo2, w FROM e WHERE w > 0) SELECT la, lo, count(*) AS degree, round(sum(w), 1) AS metres FROM two GROUP BY 1, 2""")
def road_graph(spark, sf_dir):
    """Degree and metres of each node of the graph of track edges."""
    e = graph.road_edges(_track(spark, sf_dir))
    place = F.split("src", ",")
    return e.groupBy(place[0].cast("double").alias("la"), place[1].cast("double").alias("lo")).agg(F.count(F.lit(1)).alias("degree"), F.round(F.sum("w"), 1).alias("metres"))


# --- the matcher ----------------------------------------------------------------------------------------------------

#: Radii and lengths that suit points kilometres apart.
_FIT = {"strict_m": 150.0, "smooth_m": 9000.0, "gap_m": 9000.0, "run_m": 6000.0, "second_m": 12000.0}
_LOOSE, _TURN = 400.0, 3000.0


def _pts(m: float, least: int) -> str:
    return f"greatest({least}, round_even({m} / spacing, 0)::INT)"


def _vote(cte: str, label: str, out: str) -> str:
    return f"""{out}_v AS (SELECT p.line, p.seq, coalesce(q.{label}, -1) AS l, count(*) AS n, min(q.seq) AS f FROM {cte} p JOIN {cte} q ON p.line = q.line AND q.seq BETWEEN p.seq - p.half AND p.seq + p.half GROUP BY 1, 2, 3),
 {out} AS (SELECT {cte}.*, nullif(l, -1) AS voted FROM {cte} JOIN (SELECT line, seq, l FROM (SELECT *, row_number() OVER (PARTITION BY line, seq ORDER BY n DESC, f) AS rk FROM {out}_v) WHERE rk = 1) USING (line, seq))"""


def _runs_sql(cte: str, label: str, out: str) -> str:
    return f"""{out}_n AS (SELECT line, seq, {label} AS label, sum(CASE WHEN seq = 0 OR {label} IS DISTINCT FROM pv THEN 1 ELSE 0 END) OVER (PARTITION BY line ORDER BY seq) AS run FROM (SELECT *, lag({label}) OVER (PARTITION BY line ORDER BY seq) AS pv FROM {cte})),
 {out} AS (SELECT line, run, any_value(label) AS label, min(seq) AS a, max(seq) AS b FROM {out}_n GROUP BY 1, 2)"""


def _long_sql(runs: str, out: str) -> str:
    return f"""{out}_m AS (SELECT *, sum(CASE WHEN label = pl AND a - pb <= gap THEN 0 ELSE 1 END) OVER (PARTITION BY line ORDER BY a) AS k FROM (SELECT r.*, s.gap, s.least, s.spacing, lag(label) OVER w AS pl, lag(b) OVER w AS pb FROM {runs} r JOIN sizes s USING (line) WHERE label IS NOT NULL WINDOW w AS (PARTITION BY line ORDER BY a))),
 {out} AS (SELECT x.line, x.label, x.a, x.b FROM (SELECT line, any_value(label) AS label, min(a) AS a, max(b) AS b, any_value(least) AS least, any_value(spacing) AS spacing FROM {out}_m GROUP BY line, k) x LEFT JOIN own ON own.cand = x.label WHERE b - a + 1 >= least OR b - a + 1 >= own_m / spacing * 0.5)"""


_MATCH = f"""{STEPS}, {TOWNS}, {_NETWORK}, own AS (SELECT line AS cand, {hav("lat", "lon", "lat2", "lon2")} AS own_m FROM net), sp AS (SELECT line, sum(coalesce(step_m, 0)) / count(*) AS spacing FROM steps GROUP BY 1),
 sizes AS (SELECT line, spacing, {_pts(_FIT["gap_m"], 1)} AS gap, {_pts(_FIT["run_m"], 2)} AS least, {_pts(_FIT["second_m"], 1)} AS open_points, {_pts(_FIT["smooth_m"], 3)} // 2 AS half FROM sp),
 {_near_sql("track", "line, seq", _LOOSE).replace("greatest(0.15, cos(radians((n.lat + n.lat2) / 2)))", "cos(radians(n.lat))")},
 pts AS (SELECT t.line, t.seq, t.lat, t.lon, n.way AS label, CASE WHEN n.dist <= {_FIT["strict_m"]} THEN n.way END AS strict, s.half, s.open_points FROM track t JOIN sizes s USING (line) LEFT JOIN near n ON n.line = t.line AND n.seq = t.seq),
 {_vote("pts", "strict", "v1")}, {_runs_sql("v1", "voted", "r1")}, {_long_sql("r1", "l1")},
 cov AS (SELECT v1.*, EXISTS (SELECT 1 FROM l1 WHERE l1.line = v1.line AND v1.seq BETWEEN l1.a AND l1.b)::INT AS c FROM v1), {_runs_sql("cov", "c", "oc")},
 op AS (SELECT oc.line, a, b FROM oc JOIN sizes USING (line) WHERE label = 0 AND b - a + 1 >= open_points),
 mix AS (SELECT line, seq, lat, lon, half, CASE WHEN EXISTS (SELECT 1 FROM op WHERE op.line = v1.line AND v1.seq BETWEEN op.a AND op.b) THEN label ELSE voted END AS mixed FROM v1),
 {_vote("mix", "mixed", "v2")}, {_runs_sql("v2", "voted", "r2")}, {_long_sql("r2", "l2")}, fin AS (SELECT line, row_number() OVER (PARTITION BY line ORDER BY a) - 1 AS run, label AS cand, a, b FROM l2)"""


def _labelled(spark, sf_dir):
    own = _network(spark, sf_dir).withColumnRenamed("line", "cand")
    return _track(spark, sf_dir), own


@query(f"WITH {_MATCH} SELECT line, run, cand, a, b FROM fin")
def track_match_runs(spark, sf_dir):
    t, net = _labelled(spark, sf_dir)
    spacing = lines.line_measures(t).select("line", "spacing_m")
    labelled = nearest.label_points(t, net, _LOOSE, 0.006).join(spacing, "line")
    got = match.two_pass_runs(labelled, lines.line_measures(net, "cand", "seq").select("cand", "length_m"), **_FIT)
    return got.select("line", F.col("run").cast("long").alias("run"), "cand", "a", "b")


@query(f"""WITH {_MATCH}, q0 AS (SELECT f.line, f.run, f.cand, t.seq, t.lat AS plat, t.lon AS plon, n.lat AS a, n.lon AS b, n.lat2 AS c, n.lon2 AS d, cos(radians(n.lat)) AS co, own_m, s.spacing FROM fin f JOIN track t ON t.line = f.line AND t.seq BETWEEN f.a AND f.b JOIN net n ON n.line = f.cand JOIN own ON own.cand = f.cand JOIN sp s ON s.line = f.line),
 q1 AS (SELECT *, ((plon - b) * co * 111320 * (d - b) * co * 111320 + (plat - a) * 110540 * (c - a) * 110540) / (pow((d - b) * co * 111320, 2) + pow((c - a) * 110540, 2)) AS t0 FROM q0),
 q2 AS (SELECT line, run, cand, seq, CASE WHEN t0 < 0 THEN 0 WHEN t0 > 1 THEN 1 ELSE t0 END * own_m / 1000 AS km, {_pts(_TURN, 2)} AS side, row_number() OVER (PARTITION BY line, run ORDER BY seq) - 1 AS i, count(*) OVER (PARTITION BY line, run) AS n FROM q1),
 q3 AS (SELECT line, run, arg_max(i, (km, -i)) AS ti, max(km) AS tk, arg_min(i, (km, i)) AS li, min(km) AS lk, arg_min(km, i) AS k0, arg_max(km, i) AS k1, any_value(side) AS side, any_value(n) AS n FROM q2 GROUP BY 1, 2),
 q4 AS (SELECT line, run, CASE WHEN ti >= side AND n - ti >= side AND abs(tk - k0) >= 0.1 AND abs(tk - k1) >= 0.1 THEN ti WHEN li >= side AND n - li >= side AND abs(lk - k0) >= 0.1 AND abs(lk - k1) >= 0.1 THEN li END AS turn FROM q3),
 q5 AS (SELECT line, run, cand, CASE WHEN i > turn THEN 1 ELSE 0 END AS part, min(seq) AS a, max(seq) AS b, arg_min(km, seq) AS f, arg_max(km, seq) AS t FROM q2 JOIN q4 USING (line, run) GROUP BY 1, 2, 3, 4)
SELECT line, run, cand, a, b, t < f AS reversed, round(f, 4) AS from_km, round(t, 4) AS to_km FROM q5""")
def track_match(spark, sf_dir):
    """The whole matcher: runs, turns, and the ridden stretch of each line."""
    t, net = _labelled(spark, sf_dir)
    got = match.matched(t, net, loose_m=_LOOSE, turn_m=_TURN, size=0.006, **_FIT)
    return got.select("line", F.col("run").cast("long").alias("run"), "cand", "a", "b", "reversed", F.round("from_km", 4).alias("from_km"), F.round("to_km", 4).alias("to_km"))


@query(f"""WITH {STEPS}, x AS (SELECT *, max(seq) OVER (PARTITION BY line) AS last FROM steps WHERE step_m > 0) SELECT line, list_sort(list(step_m))[count(*) // 2 + 1]::DECIMAL(18, 3)::DOUBLE AS spacing_m FROM x GROUP BY line""")
def own_spacing(spark, sf_dir):
    """The upper median of a line's steps."""
    s = lines.with_steps(track(spark, sf_dir)).where("step_m > 0")
    return s.groupBy("line").agg(F.round(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY step_m DESC)"), 3).alias("spacing_m"))


# --- whole jobs -----------------------------------------------------------------------------------------------------


def _gap_box(k: int) -> str:
    return f"""b AS (SELECT gap, least(a_lat, b_lat) - {k} / 111320.0 AS la, greatest(a_lat, b_lat) + {k} / 111320.0 AS ha, least(a_lon, b_lon) - {k} / (111320 * cos(radians((a_lat + b_lat) / 2))) AS lo, greatest(a_lon, b_lon) + {k} / (111320 * cos(radians((a_lat + b_lat) / 2))) AS ho FROM g)"""


@query(f"WITH {TOWNS}, {_NETWORK}, g AS (SELECT o_orderkey AS gap, {_GAP_ENDS} FROM orders), {_gap_box(300)} SELECT gap, line AS way FROM b JOIN net ON net.lat <= ha AND net.lat2 >= la AND net.lon <= ho AND net.lon2 >= lo")
def gap_ways(spark, sf_dir):
    return gaps.ways_for_gaps(_ways(spark, sf_dir), _gap_ends(spark, sf_dir), 300.0)


@query(f"WITH {TOWNS}, {_NETWORK}, g AS (SELECT o_orderkey AS gap, {_GAP_ENDS} FROM orders), {_gap_box(300)}, v AS (SELECT line, lat, lon FROM net UNION ALL SELECT line, lat2, lon2 FROM net) SELECT DISTINCT gap, line AS way FROM b JOIN v ON lat BETWEEN la AND ha AND lon BETWEEN lo AND ho")
def gap_way_vertices(spark, sf_dir):
    return gaps.ways_for_gaps(_ways(spark, sf_dir), _gap_ends(spark, sf_dir), 300.0, vertices=True)


@query(f"""WITH {CUM}, x AS (SELECT line, seq, km * 1000 AS m, {hav("lat", "lon", "46.01", "10.02")} <= 900 AS at_a, {hav("lat", "lon", "46.03", "10.03")} <= 900 AS at_b, {_STRETCH_GAP} AS gap FROM cum),
 y AS (SELECT p.line, p.seq AS ia, q.seq AS ib, q.m - p.m AS r FROM x p JOIN x q ON p.line = q.line AND p.seq < q.seq AND p.at_a AND q.at_b AND q.m - p.m >= p.gap - 5 AND q.m - p.m <= greatest(2 * p.gap, p.gap + 250)),
 z AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY line ORDER BY r, ia, ib) AS rk FROM y) WHERE rk = 1)
SELECT t.line, ia, ib, round(r, 1) AS ridden_m, CASE WHEN ia IS NULL THEN 'open gap' ELSE 'recorded' END AS note FROM (SELECT DISTINCT line FROM cum) t LEFT JOIN z USING (line)""")
def recorded_connectors(spark, sf_dir):
    c = lines.cumulative_km(track(spark, sf_dir)).select("line", "seq", "lat", "lon", (F.col("km") * 1000).alias("m"))
    a, b = (tuple(map(F.lit, _ENDS[k])) for k in ("a", "b"))
    g = c.select("line").distinct().select("line", a[0].alias("a_lat"), a[1].alias("a_lon"), b[0].alias("b_lat"), b[1].alias("b_lon"), geo.haversine_m(*a, *b).alias("gap_m"))
    return gaps.recorded_connectors(c, g, within_m=900.0, times=2.0).select("line", "ia", "ib", F.round("ridden_m", 1).alias("ridden_m"), "note")

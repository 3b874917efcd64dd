"""Queries of scans, rules, tours, reports and the app's views over the driver's tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ridgeline.functions import geo, text
from ridgeline.operators import chain, facets, lines, nearest, ranking, regions, runs, tables
from ridgeline.plans.gaps import _EDGE, _MATCH, _FIT, _LOOSE, _labelled, _near_sql, _network, _track, _ways
from ridgeline.plans.queries import _NETWORK, _PART, _SEQ, _VOTE, CUM, SEGMENTS, STEPS, TOWNS, TRACK, TRAILS, _parts, _profile, _PROFILE, _segments, hav, query, table, towns, track, trails
from ridgeline.sources import scans

# --- kernels --------------------------------------------------------------------------------------------------------

_NEXT2 = "e AS (SELECT line, seq, lat, lon, lead(lat) OVER w AS lat2, lead(lon) OVER w AS lon2, lead(lat, 2) OVER w AS lat3, lead(lon, 2) OVER w AS lon3 FROM track WINDOW w AS (PARTITION BY line ORDER BY seq))"


def _three(spark, sf_dir):
    w = W.partitionBy("line").orderBy("seq")
    return track(spark, sf_dir).select("line", "seq", "lat", "lon", *(F.lead(c, k - 1).over(w).alias(f"{c}{k}") for k in (2, 3) for c in ("lat", "lon"))).where("lat3 is not null")


@query(f"""WITH {TRACK}, {_NEXT2}, f AS (SELECT *, cos(radians(lat)) * 111320 AS k, (lon2 - lon) * cos(radians(lat)) * 111320 AS dx, (lat2 - lat) * 110540 AS dy FROM e WHERE lat3 IS NOT NULL)
SELECT line, seq, round(CASE WHEN dx * dx + dy * dy = 0 THEN {hav("lat3", "lon3", "lat", "lon")} ELSE abs(dy * (lon3 - lon) * k - dx * (lat3 - lat) * 110540) / sqrt(dx * dx + dy * dy) END, 2) AS d FROM f""")
def perpendicular_distances(spark, sf_dir):
    d = geo.perp_distance_m(*((F.col(f"lat{k}"), F.col(f"lon{k}")) for k in ("3", "", "2")))
    return _three(spark, sf_dir).select("line", "seq", F.round(d, 2).alias("d"))


@query(f"""WITH {TRACK}, {_EDGE}, g AS (SELECT *, greatest(0.15, cos(radians((lat + 46.0003) / 2))) AS co FROM edge WHERE lat2 IS NOT NULL),
 h AS (SELECT *, (lon2 - lon) * co * 0.05 - (lat2 - lat) * 0.047 * co AS det, ((10.0001 - lon) * co * 0.05 - (46.0003 - lat) * 0.047 * co) AS tn, ((10.0001 - lon) * co * (lat2 - lat) - (46.0003 - lat) * (lon2 - lon) * co) AS un FROM g)
SELECT line, seq, round(lat + tn / det * (lat2 - lat), 6) AS lat, round(lon + tn / det * (lon2 - lon), 6) AS lon FROM h WHERE abs(det) > 1e-15 AND tn / det BETWEEN 0 AND 1 AND un / det BETWEEN 0 AND 1""")
def edge_crossings(spark, sf_dir):
    """Where track edges cross the diagonal of the area."""
    e = nearest.edges_of(track(spark, sf_dir))
    c = geo.crossing((F.col("lat"), F.col("lon")), (F.col("lat2"), F.col("lon2")), (F.lit(46.0003), F.lit(10.0001)), (F.lit(46.0503), F.lit(10.0471)))
    return e.select("line", "seq", c.alias("c")).where("c is not null").select("line", "seq", F.round("c.lat", 6).alias("lat"), F.round("c.lon", 6).alias("lon"))


@query(f"""WITH {TRACK}, {_EDGE}, g AS (SELECT *, 500 / (111320 * greatest(0.15, abs(cos(radians((lat + lat2) / 2))))) AS dlon FROM edge WHERE lat2 IS NOT NULL)
SELECT line, seq, round(least(lat, lat2) - 500 / 111320.0, 6) AS min_lat, round(least(lon, lon2) - dlon, 6) AS min_lon, round(greatest(lat, lat2) + 500 / 111320.0, 6) AS max_lat, round(greatest(lon, lon2) + dlon, 6) AS max_lon FROM g""")
def padded_boxes(spark, sf_dir):
    e = nearest.edges_of(track(spark, sf_dir))
    return e.select("line", "seq", geo.padded_box(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"), 500.0).alias("b")).select("line", "seq", "b.*")


@query(f"WITH {TRACK}, d AS (SELECT radians((event_id * 7) % 360) AS b, (event_id % 900) / 6371000.0 AS d, radians(lat) AS p, * FROM track), t AS (SELECT *, asin(sin(p) * cos(d) + cos(p) * sin(d) * cos(b)) AS q FROM d) SELECT event_id, round(degrees(q), 6) AS lat, round(lon + degrees(atan2(sin(b) * sin(d) * cos(p), cos(d) - sin(p) * sin(q))), 6) AS lon FROM t")
def destinations(spark, sf_dir):
    i = F.col("event_id")
    d = geo.destination(F.col("lat"), F.col("lon"), (i * 7 % 360).cast("double"), (i % 900).cast("double"))
    return track(spark, sf_dir).select("event_id", d.alias("d")).select("event_id", F.round("d.lat", 6).alias("lat"), F.round("d.lon", 6).alias("lon"))


# --- scans ----------------------------------------------------------------------------------------------------------


@query("SELECT p_partkey, CASE WHEN p_partkey % 5 <> 0 THEN p_name || ' & Co' END AS name FROM part")
def gpx_names(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    tag = F.when(F.col("p_partkey") % 5 != 0, F.concat(F.lit("<name>12 &quot;"), "p_name", F.lit("  &amp; Co&quot;</name>"))).otherwise("")
    return p.select("p_partkey", F.concat(F.lit('<gpx><metadata a="1">'), tag, F.lit('</metadata><trk><trkpt lat="1" lon="2"/></trk></gpx>')).alias("t")).select("p_partkey", scans.gpx_name(F.col("t")).alias("name"))


@query(f"WITH {TRACK} SELECT line, seq, round(lat, 6) AS lat, round(lon, 6) AS lon, CASE WHEN ele <> 0 THEN round(ele, 3) END AS ele FROM track")
def kml_round_trip(spark, sf_dir):
    """Tracks written as KML coordinates, a bad token among them, and scanned again; heights of 0 are left out."""
    t = track(spark, sf_dir)
    token = F.concat_ws(",", F.col("lon").cast("string"), F.col("lat").cast("string"), F.when(F.col("ele") != 0, F.round("ele", 3).cast("string")))
    docs = t.groupBy("line").agg(F.concat(F.lit("<kml><coordinates>\nbad "), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", token.alias("x")))), lambda s: s["x"]), " "), F.lit("</coordinates></kml>")).alias("text"))
    p = scans.kml_points(docs, "line")
    return p.select("line", F.col("seq").cast("long").alias("seq"), F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "ele")


@query(f"WITH {TRACK}, p AS (SELECT *, lag(lat) OVER w AS pl, lag(lon) OVER w AS po FROM track WINDOW w AS (PARTITION BY line ORDER BY seq)) SELECT line, row_number() OVER (PARTITION BY line ORDER BY seq) - 1 AS seq, round(lat, 6) AS lat, round(lon, 6) AS lon FROM p WHERE seq = 0 OR lat <> pl OR lon <> po")
def nested_json_tracks(spark, sf_dir):
    """Tracks as nested JSON, every point twice and a point shape among the lines, scanned again."""
    c = F.array(F.col("lon"), F.col("lat"))
    t = track(spark, sf_dir).groupBy("line").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("seq", c.alias("c")))), lambda s: F.array(s["c"], s["c"]))).alias("xs"))
    shape = lambda kind, xs: F.struct(F.struct(F.lit(kind).alias("type"), xs.alias("coordinates")).alias("geometry"))
    odd = F.array(F.array(F.lit(1.0), F.lit(2.0)))
    doc = F.to_json(F.struct(F.array(F.struct(F.array(F.struct(F.array(shape("Point", odd), shape("LineString", F.col("xs"))).alias("features"))).alias("routes"))).alias("segments")))
    p = scans.nested_tracks(t.select("line", doc.alias("text")), "line")
    return p.select("line", F.col("seq").cast("long").alias("seq"), F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


_LIST = "SELECT p_partkey AS id, p_name AS name, p_size, p_brand, 'line-' || p_partkey AS slug, p_partkey % 3 AS seed, p_partkey % 7 = 0 AS hidden FROM part"


def _listing(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    size = F.col("p_size").cast("string")
    cells = F.concat(*(F.concat(F.lit('<td data-v="'), x, F.lit('">x</td>')) for x in (size, F.concat(F.lit("-"), size), F.lit("12.5"))))
    link = F.concat(F.lit('<td><a class="'), F.when(F.col("p_partkey") % 7 == 0, "hidden_trail").otherwise("green"), F.lit('" href="https://example.org/trails/line-'), (F.col("p_partkey") % 500).cast("string"), F.lit('/">'), "p_name", F.lit('</a><a href="https://example.org/region/'), "p_brand", F.lit('/"><b>'), "p_brand", F.lit("</b></a></td>"))
    mark = F.when(F.col("p_size") % 10 == 0, F.lit("<td></td>")).otherwise(F.concat(F.lit('<td title="Status"><span class="dicon_small d" title="Grade '), (F.col("p_size") % 4).cast("string"), F.lit('"></span></td>')))
    row = F.concat(F.lit("<tr ><td>1</td>"), mark, link, cells, F.lit("</tr>"))
    pages = p.groupBy((F.col("p_partkey") % 3).alias("seed_no"), F.floor(F.col("p_partkey") / 100).alias("page")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("p_partkey", row.alias("r")))), lambda x: x["r"]), "").alias("rows"))
    html = F.concat(F.lit('<table id="other"><tr><td>a</td></tr></table><table class="t" id="trails_table"><tr><td>head</td></tr>'), "rows", F.lit("</table>"))
    got = pages.select(F.struct("seed_no", "page").alias("at"), html.alias("html"))
    return scans.listing_rows(got, "at").withColumn("seed_no", F.col("at.seed_no")).withColumn("page", F.col("at.page")).drop("at")


_LISTED = "l AS (SELECT 'line-' || (p_partkey % 500) AS slug, p_name AS name, CASE WHEN p_size % 10 <> 0 THEN 'Grade ' || (p_size % 4) END AS diff, p_brand AS area_slug, p_size::DOUBLE AS m, -p_size::DOUBLE AS down, 12.5::DOUBLE AS up, p_partkey % 7 = 0 AS hidden, p_partkey % 3 AS seed_no, p_partkey // 100 AS page, p_partkey FROM part)"


@query(f"WITH {_LISTED} SELECT slug, name, diff, area_slug, area_slug AS area, m, down, up, hidden, seed_no FROM l")
def listing_scan(spark, sf_dir):
    return _listing(spark, sf_dir).select("slug", "name", "diff", "area_slug", "area", "m", "down", "up", "hidden", "seed_no")


@query(f"WITH {_LISTED} SELECT slug, name, seed_no FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY seed_no, page, p_partkey) AS rk FROM l) WHERE rk = 1")
def first_seed(spark, sf_dir):
    return scans.first_seed_wins(_listing(spark, sf_dir)).select("slug", "name", "seed_no")


@query(f"WITH {_LISTED} SELECT slug, diff, count(*) AS n FROM l WHERE diff IS NOT NULL AND area_slug <> 'Brand#11' AND slug NOT IN (SELECT slug FROM l WHERE hidden) GROUP BY 1, 2")
def still_to_harvest(spark, sf_dir):
    l = _listing(spark, sf_dir)  # noqa: E741
    return scans.to_harvest(l, l.where("hidden"), ("Brand#11",)).groupBy("slug", "diff").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {CUM}, o AS (SELECT line, seq, lat, lon, coalesce(ele, 0) AS ele, km FROM cum) SELECT line, count(*) AS n, round(sum(ele), 2) AS ele, round(max(x), 1) AS last_x FROM (SELECT *, round(km * 1000, 2) AS x FROM o) GROUP BY 1")
def page_scan(spark, sf_dir):
    """Tracks as chart points in a page's script, scanned again."""
    c = lines.cumulative_km(track(spark, sf_dir))
    quoted = lambda x: F.concat(F.lit('"'), x.cast("string"), F.lit('"'))
    obj = F.concat(F.lit('{"id":'), F.col("seq").cast("string"), F.lit(',"x":'), quoted(F.round(F.col("km") * 1000, 2)), F.lit(',"y":'), F.coalesce("ele", F.lit(0.0)).cast("string"), F.lit(',"lat":'), F.col("lat").cast("string"), F.lit(',"lng":'), quoted(F.col("lon")), F.lit("}"))
    html = c.groupBy("line").agg(F.concat(F.lit("<script>new ElevationChart(["), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", obj.alias("o")))), lambda s: s["o"]), ","), F.lit("])")).alias("html"))
    p = scans.page_geometry(html, "line").select("line", F.explode("p").alias("p"))
    return p.groupBy("line").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("p.ele"), 2).alias("ele"), F.round(F.max("p.x"), 1).alias("last_x"))


@query("SELECT p_partkey AS way_id, p_size % 4 AS kind, p_name AS name FROM part WHERE p_size % 4 IN (1, 2) AND p_name LIKE '%a%'")
def map_ways(spark, sf_dir):
    """Ways of a map response in JSON, filtered by name and kind."""
    p = table(spark, sf_dir, "part")
    e = F.struct(F.lit("way").alias("type"), F.col("p_partkey").alias("id"), F.create_map(F.lit("name"), F.col("p_name"), F.lit("highway"), (F.col("p_size") % 4).cast("string")).alias("tags"), F.array(F.struct(F.lit(46.0).alias("lat"), F.lit(10.0).alias("lon"))).alias("geometry"))
    body = p.groupBy((F.col("p_partkey") % 9).alias("file")).agg(F.to_json(F.struct(F.collect_list(e).alias("elements"))).alias("text"))
    w = scans.named_ways(scans.osm_ways(body), "a", ("1", "2"))
    return w.select("way_id", F.col("tags")["highway"].cast("int").alias("kind"), F.col("tags")["name"].alias("name"))


@query(f"WITH {TRACK}, k AS (SELECT DISTINCT round(46 + ((event_id * 37) % 1000) / 20000.0::DOUBLE, 5) AS la, round(10 + ((event_id * 91) % 1000) / 20000.0::DOUBLE, 5) AS lo FROM events WHERE event_id % 2 = 0) SELECT line, seq, CASE WHEN la IS NOT NULL THEN round(la + lo, 3) END AS ele_found FROM track LEFT JOIN k ON round(lat, 5) = la AND round(lon, 5) = lo")
def cached_elevations(spark, sf_dir):
    t = track(spark, sf_dir)
    known = t.where("event_id % 2 = 0").select(F.format_string("%.5f,%.5f", F.col("lat"), F.col("lon")).alias("key"), F.round(F.round("lat", 5) + F.round("lon", 5), 3).alias("ele")).distinct()
    return scans.elevations(t, known).select("line", "seq", "ele_found")


# --- rules ----------------------------------------------------------------------------------------------------------

_WAY_TAGS = """w AS (SELECT p_partkey AS way, CASE p_size % 5 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' WHEN 2 THEN 'private' END AS bicycle, CASE p_partkey % 4 WHEN 0 THEN 'private' WHEN 1 THEN 'customers' END AS access FROM part),
 b AS (SELECT way, CASE WHEN bicycle = 'yes' THEN NULL WHEN bicycle IN ('no', 'private') THEN 'bicycle=' || bicycle WHEN access IS NOT NULL THEN 'access=' || access END AS reason FROM w)"""


@query(f"WITH {_WAY_TAGS} SELECT way, reason FROM b")
def rideable_ways(spark, sf_dir):
    p, pick = F.col("p_partkey"), lambda x, v: F.coalesce(*(F.when(x == i, y) for i, y in v.items()))
    tags = F.create_map(F.lit("bicycle"), pick(F.col("p_size") % 5, {0: "yes", 1: "no", 2: "private"}), F.lit("access"), pick(p % 4, {0: "private", 1: "customers"}))
    kept, gone = regions.rideable(table(spark, sf_dir, "part").select(p.alias("way"), tags.alias("tags")))
    return kept.select("way", F.lit(None).cast("string").alias("reason")).unionByName(gone.select("way", "reason"))


@query("SELECT doc_id, regexp_matches(lower(trim(replace(text, chr(10), ' '))), '^(access|uphill|aufstieg|connection|umleitung)([^a-z0-9_äöüß]|$)') AS access FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'Access ' WHEN doc_id % 3 = 1 THEN ' UPHILL2' ELSE 'Aufstieg-' END || text AS text FROM documents WHERE text IS NOT NULL)")
def access_titles(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where("text is not null")
    head = F.when(F.col("doc_id") % 3 == 0, "Access ").when(F.col("doc_id") % 3 == 1, " UPHILL2").otherwise("Aufstieg-")
    return d.select("doc_id", regions.is_access(F.replace(F.concat(head, "text"), F.lit("\n"), F.lit(" "))).alias("access"))


_ROUTES = "r AS (SELECT line AS route, min(lat) - 0.0005 AS a, min(lon) - 0.0005 AS b, max(lat) + 0.0005 AS c, max(lon) + 0.0005 AS d FROM track GROUP BY 1)"


@query(f"WITH {TRACK}, {TRAILS}, {_ROUTES} SELECT route, trails.line AS line FROM r JOIN trails ON lat BETWEEN a AND c AND lon BETWEEN b AND d")
def near_route(spark, sf_dir):
    r = track(spark, sf_dir).groupBy(F.col("line").alias("route")).agg(*(f(c).alias(f"{n}_{c}") for n, f in (("min", F.min), ("max", F.max)) for c in ("lat", "lon")))
    boxes = trails(spark, sf_dir).select("line", *(F.col(c).alias(f"{n}_{c}") for n in ("min", "max") for c in ("lat", "lon")))
    return regions.near_route(r, boxes, 0.0005)


@query("SELECT c_custkey AS line, CASE WHEN c_custkey % 13 = 0 THEN -1 ELSE c_nationkey END AS region FROM customer")
def overrides(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("line"), F.col("c_nationkey").alias("region"))
    return regions.overridden(c, c.where("line % 13 = 0").select("line", F.lit(-1).alias("region")), "line", "region")


_RUNS3 = f"""{_VOTE}, rr AS (SELECT line, run, any_value(voted) AS cand, min(seq) AS a, max(seq) AS b FROM (SELECT *, sum(CASE WHEN seq = 0 OR voted IS DISTINCT FROM pv THEN 1 ELSE 0 END) OVER (PARTITION BY line ORDER BY seq) AS run FROM (SELECT *, lag(voted) OVER (PARTITION BY line ORDER BY seq) AS pv FROM voted)) GROUP BY 1, 2 HAVING any_value(voted) IS NOT NULL)"""


def _voted_runs(spark, sf_dir):
    r = runs.run_lengths(runs.majority(track(spark, sf_dir), 11), "voted").where("label is not null")
    return r.select("line", F.col("label").alias("cand"), "a", "b")


@query(f"WITH {_RUNS3} SELECT r.line, cand, a, b FROM rr r JOIN track x ON x.line = r.line AND x.seq = a JOIN track y ON y.line = r.line AND y.seq = b WHERE NOT (cand IN ('click', 'view') AND coalesce(x.ele - y.ele > 20, false))")
def direction_veto(spark, sf_dir):
    up = spark.createDataFrame([("click",), ("view",)], "cand string")
    return regions.wrong_direction(_voted_runs(spark, sf_dir), track(spark, sf_dir), up)


@query(f"""WITH {_RUNS3}, z AS (SELECT line, max(seq) AS last FROM track GROUP BY 1), n AS (SELECT z.line, last, a, b, cand, lag(b) OVER w AS pb, lead(a) OVER w AS na FROM z LEFT JOIN rr ON rr.line = z.line WINDOW w AS (PARTITION BY z.line ORDER BY a)),
 p AS (SELECT line, 0 AS a, last AS b, NULL AS cand FROM n WHERE a IS NULL UNION ALL SELECT line, 0, a, NULL FROM n WHERE pb IS NULL AND a > 0 UNION ALL SELECT line, a, b, cand FROM n WHERE a IS NOT NULL UNION ALL SELECT line, b, na, NULL FROM n WHERE na IS NOT NULL UNION ALL SELECT line, b, last, NULL FROM n WHERE na IS NULL AND b < last)
SELECT line, row_number() OVER (PARTITION BY line ORDER BY a, b) - 1 AS at, a, b, cand FROM p""")
def interleaved_connectors(spark, sf_dir):
    z = track(spark, sf_dir).groupBy("line").agg(F.max("seq").alias("last"))
    got = regions.interleaved(_voted_runs(spark, sf_dir), z)
    return got.select("line", F.col("at").cast("long").alias("at"), "a", "b", "cand")


@query(f"WITH {TRAILS}, c AS (SELECT nation, avg(lat) AS la, avg(lon) AS lo FROM trails WHERE line % 2 = 0 GROUP BY 1) SELECT line, nation FROM (SELECT t.line, c.nation, row_number() OVER (PARTITION BY t.line ORDER BY {hav('t.lat', 't.lon', 'la', 'lo')}, c.nation) AS rk FROM trails t, c) WHERE rk = 1")
def nearest_centroid(spark, sf_dir):
    t = trails(spark, sf_dir)
    return regions.nearest_centroid(t.select("line", "lat", "lon"), t.where("line % 2 = 0"), "line", "nation")


@query(f"WITH {SEGMENTS} SELECT line, seq, last_value(CASE WHEN l_returnflag <> 'N' THEN l_suppkey END IGNORE NULLS) OVER (PARTITION BY line ORDER BY seq ROWS UNBOUNDED PRECEDING) AS sub FROM seg")
def inherited_regions(spark, sf_dir):
    s = _segments(spark, sf_dir).select("line", "seq", F.when(F.col("l_returnflag") != "N", F.col("l_suppkey")).alias("sub"))
    return regions.inherited(s, "sub", ["seq"], "line")


@query("""WITH s AS (SELECT n_nationkey AS spec, '.*' || lower(substr(n_name, 1, 3)) || '.*' AS pattern, n_nationkey % 2 = 0 AS typed, n_regionkey AS kind FROM nation), h AS (SELECT spec, count(*) FILTER (regexp_full_match(lower(m.n_name), pattern)) AS hits, min(m.n_nationkey) FILTER (regexp_full_match(lower(m.n_name), pattern)) AS r FROM s JOIN nation m ON NOT typed OR m.n_regionkey = kind GROUP BY 1)
SELECT spec, hits, CASE WHEN hits = 1 THEN r END AS row, CASE WHEN hits = 1 THEN 'ok' WHEN hits = 0 THEN 'none' ELSE 'several' END AS state FROM h""")
def anchored_single_match(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    rows = n.select(F.col("n_nationkey").alias("row"), F.lower("n_name").alias("name"), F.col("n_regionkey").alias("kind"))
    specs = n.select(F.col("n_nationkey").alias("spec"), F.concat(F.lit(".*"), F.lower(F.substring("n_name", 1, 3)), F.lit(".*")).alias("pattern"), F.when(F.col("n_nationkey") % 2 == 0, F.col("n_regionkey")).alias("kind"))
    return regions.single_matches(specs, rows)


@query(f"WITH {SEGMENTS}, s AS (SELECT line, seq, CASE WHEN l_returnflag <> 'N' THEN l_suppkey % 3 END AS id, l_linestatus = 'F' AS reversed FROM seg), p AS (SELECT *, lag(id) OVER (PARTITION BY line ORDER BY seq) AS pv FROM s WHERE id IS NOT NULL) SELECT line, row_number() OVER (PARTITION BY line ORDER BY seq) - 1 AS at, id, reversed FROM p WHERE pv IS NULL OR pv <> id")
def ground_truth(spark, sf_dir):
    s = _segments(spark, sf_dir).select("line", "seq", F.when(F.col("l_returnflag") != "N", F.col("l_suppkey") % 3).alias("id"), (F.col("l_linestatus") == "F").alias("reversed"))
    return regions.sequence_of(s, "line").select("line", F.col("at").cast("long").alias("at"), "id", "reversed")


# --- reports --------------------------------------------------------------------------------------------------------


@query(f"""WITH {TRACK}, {TOWNS}, {_NETWORK}, {_near_sql('track', 'line, seq')}, {_EDGE}, s AS (SELECT e.line, {hav("e.lat", "e.lon", "e.lat2", "e.lon2")} AS m, n.way AS cand, n.dist <= 100 AS clean FROM edge e LEFT JOIN near n ON n.line = e.line AND n.seq = e.seq WHERE e.lat2 IS NOT NULL)
SELECT line, round(sum(m), 1) AS total, round(sum(CASE WHEN cand IS NOT NULL THEN m ELSE 0 END) / sum(m), 4) AS named_share, round(sum(CASE WHEN cand IS NOT NULL AND clean THEN m ELSE 0 END) / sum(m), 4) AS clean_share, count(DISTINCT cand) AS parts FROM s GROUP BY 1""")
def loop_attribution(spark, sf_dir):
    """Metres of each track named by the way nearest to an edge's start, and clean within 100 m of it."""
    from ridgeline.operators.gaps import nearest_edge

    near = nearest_edge(_track(spark, sf_dir), _ways(spark, sf_dir), 200.0, 0.004, ["line", "seq"]).select(F.col("line").alias("_l"), F.col("seq").alias("_s"), "way", "d")
    e = nearest.edges_of(_track(spark, sf_dir))
    s = e.join(near, (F.col("line") == F.col("_l")) & (F.col("seq") == F.col("_s")), "left")
    m = geo.haversine_m(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))
    a = regions.attribution(s.select("line", m.alias("m"), F.col("way").alias("cand"), (F.col("d") <= 100).alias("clean")))
    return a.select("line", F.round("total", 1).alias("total"), F.round("named_share", 4).alias("named_share"), F.round("clean_share", 4).alias("clean_share"), "parts")


@query(f"""WITH {TRACK}, {TOWNS}, {_NETWORK}, {_near_sql('track', 'line, seq')}, d AS (SELECT line, round(dist, 3) AS d FROM near), a AS (SELECT line, count(*) AS n, avg((d <= 80)::INT) AS share, list_sort(list(d))[count(*) // 2 + 1] AS um, max(d) AS worst FROM d GROUP BY 1)
SELECT line, n, round(share, 4) AS share, round(um, 2) AS upper_median, round(worst, 2) AS worst, CASE WHEN share < 0.5 THEN 'bad' WHEN share < 0.8 THEN 'check' ELSE 'ok' END AS flag FROM a""")
def way_agreement(spark, sf_dir):
    from ridgeline.operators.gaps import nearest_edge

    near = nearest_edge(_track(spark, sf_dir), _ways(spark, sf_dir), 200.0, 0.004, ["line", "seq"])
    a = regions.agreement(near.select("line", F.round("d", 3).alias("d")), 80.0)
    return a.select("line", "n", F.round("share", 4).alias("share"), F.round("upper_median", 2).alias("upper_median"), F.round("worst", 2).alias("worst"), "flag")


@query(f"WITH {SEGMENTS}, s AS (SELECT l_partkey % 500 AS line, line AS segment, max(l_quantity) AS m, avg((l_returnflag = 'R')::INT) AS share FROM seg GROUP BY 1, 2) SELECT line, round(sum(m * share) / sum(m), 4) AS kept FROM s GROUP BY 1")
def loop_ground(spark, sf_dir):
    s = _segments(spark, sf_dir).select((F.col("l_partkey") % 500).alias("line"), F.col("line").alias("segment"), F.col("l_quantity").alias("m"), (F.col("l_returnflag") == "R").alias("near"))
    return regions.loop_ground_share(s).withColumn("kept", F.round("kept", 4))


@query("""WITH m AS (SELECT o_custkey AS loop, o_orderkey % 2 AS side, avg(o_totalprice) / 1000 AS km, avg((o_orderstatus = 'F')::INT) AS clean_share FROM orders GROUP BY 1, 2), b AS (SELECT * FROM m WHERE side = 0), a AS (SELECT * FROM m WHERE side = 1)
SELECT coalesce(b.loop, a.loop) AS loop, round(coalesce(a.km, 0) - coalesce(b.km, 0), 4) AS km_delta, round(coalesce(a.clean_share, 0) - coalesce(b.clean_share, 0), 4) AS clean_share_delta, coalesce(a.clean_share, 0) - coalesce(b.clean_share, 0) < -0.005 AS fell FROM b FULL JOIN a ON a.loop = b.loop""")
def report_deltas(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("loop"), (F.col("o_orderkey") % 2).alias("side")).agg((F.avg("o_totalprice") / 1000).alias("km"), F.avg((F.col("o_orderstatus") == "F").cast("double")).alias("clean_share"))
    d = regions.metric_deltas(o.where("side = 0"), o.where("side = 1"), "loop", ["km", "clean_share"])
    return d.select("loop", F.round("km_delta", 4).alias("km_delta"), F.round("clean_share_delta", 4).alias("clean_share_delta"), "fell")


@query("SELECT l_suppkey AS id, count(*) AS n FROM lineitem WHERE l_suppkey % 9 = 0 GROUP BY 1")
def dangling_references(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").where("s_suppkey % 9 = 0").select(F.col("s_suppkey").alias("id"))
    return regions.dangling(s, table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("id")))


@query(f"WITH {_PART} SELECT id, row_number() OVER (ORDER BY kind = 'loop', id) - 1 AS pos FROM p")
def loops_last(spark, sf_dir):
    p = _parts(spark, sf_dir).select("id", (F.col("kind") == "loop").alias("loop"), F.col("id").alias("ord"))
    return regions.loops_last(p).select("id", F.col("pos").cast("long").alias("pos"))


@query(f"""WITH {TRAILS}, l AS (SELECT s_suppkey AS lift, s_nationkey AS region, 46 + (s_suppkey * 53 % 1000) / 20000.0::DOUBLE AS lat, 10 + (s_suppkey * 71 % 1000) / 20000.0::DOUBLE AS lon FROM supplier), v AS (SELECT * FROM trails WHERE nation % 4 <> 0),
 n AS (SELECT DISTINCT lift FROM l JOIN v ON v.line % 3 = 0 AND {hav("l.lat", "l.lon", "v.lat", "v.lon")} <= 250)
SELECT lift, CASE WHEN region NOT IN (SELECT nation FROM v) THEN 'region without lines' ELSE 'far from all lines' END AS reason FROM l WHERE region NOT IN (SELECT nation FROM v) OR lift NOT IN (SELECT lift FROM n)""")
def far_lifts(spark, sf_dir):
    s = F.col("s_suppkey")
    l = table(spark, sf_dir, "supplier").select(s.alias("lift"), F.col("s_nationkey").alias("region"), (46 + (s * 53 % 1000) / 20000.0).alias("lat"), (10 + (s * 71 % 1000) / 20000.0).alias("lon"))  # noqa: E741
    v = trails(spark, sf_dir).where("nation % 4 <> 0").select(F.col("nation").alias("region"), F.col("line").alias("seq"), "lat", "lon")
    return regions.far_lifts(l, v, 250.0, (0.003, 0.0045))


@query(f"WITH {TRACK}, a AS (SELECT line, seq, lat, lon FROM track), b AS (SELECT line, seq, lat, CASE WHEN event_id % 50 = 0 THEN lon + 1 ELSE lon END AS lon FROM track) SELECT line, seq, 'line' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT line, seq, 'segments' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)")
def concatenation_errors(spark, sf_dir):
    t = track(spark, sf_dir)
    moved = t.withColumn("lon", F.when(F.col("event_id") % 50 == 0, F.col("lon") + 1).otherwise(F.col("lon")))
    return tables.concatenation_errors(t, moved).select("line", "seq", "side")


@query("SELECT doc_id, CASE WHEN lang = 'en' THEN 'north' WHEN lang = 'de' THEN 'south' WHEN source = 'web' THEN 'west' ELSE lang END AS sub FROM documents")
def region_tags(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", regions.resolved_tag(F.concat_ws(",", "lang", "source"), {"en": "north", "de": "south", "web": "west"}, F.col("lang")).alias("sub"))


# --- the app --------------------------------------------------------------------------------------------------------


@query("SELECT s_suppkey AS lift FROM supplier WHERE s_nationkey IN (1, 2, 3, 4, 5, 6) AND lower(s_name) LIKE '%1%'")
def lift_filter(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    return s.where(regions.lift_passes(True, F.col("s_nationkey"), [1, 2, 3, 4, 5, 6], F.col("s_name"), "1")).select(F.col("s_suppkey").alias("lift"))


@query("""SELECT r_name AS country, count(*) AS n, string_agg(n_name, ',' ORDER BY n_name) AS keys FROM (SELECT n_name, r_name, n_nationkey::VARCHAR AS code FROM nation JOIN region ON r_regionkey = n_regionkey)
 WHERE lower(n_name) LIKE '%ica%' OR lower(r_name) LIKE '%ica%' OR code LIKE '%ica%' OR EXISTS (SELECT 1 FROM customer JOIN nation m ON m.n_nationkey = c_nationkey WHERE m.n_name = nation.n_name AND lower(c_mktsegment) LIKE '%ica%') GROUP BY 1""".replace("nation.n_name AND", "x.n_name AND").replace("ON r_regionkey = n_regionkey)", "ON r_regionkey = n_regionkey) x"))
def region_dialog(spark, sf_dir):
    subs = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.collect_set("c_mktsegment").alias("subs"))
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).join(subs, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    r = n.select(F.col("n_name").alias("key"), F.col("n_name").alias("name"), F.col("r_name").alias("country"), F.col("n_nationkey").cast("string").alias("code"), F.coalesce("subs", F.array().cast("array<string>")).alias("subs"))
    return regions.region_dialog(r, "ÍCA")


@query(f"WITH {CUM}, t AS (SELECT line, max(km) AS km FROM cum GROUP BY 1 HAVING max(km) > 0), n AS (SELECT *, greatest(1, least(40, floor(km / 5)::INT)) AS n FROM t), x AS (SELECT *, unnest(range(1, n + 1)) AS k FROM n) SELECT line, k::INT AS k, round(km * k / (n + 1), 4) AS at FROM x")
def direction_arrows(spark, sf_dir):
    t = lines.cumulative_km(track(spark, sf_dir)).groupBy("line").agg(F.max("km").alias("km"))
    return regions.arrows(t, 5.0).select("line", "k", F.round("at", 4).alias("at"))


@query(f"WITH {_PROFILE}, z AS (SELECT line, max(km) AS z FROM prof GROUP BY 1) SELECT line, round(z - km, 4) AS km, round(ele, 2) AS ele, round(km * (z + 1) / z, 4) AS on_line FROM prof JOIN z USING (line)")
def reversed_profile(spark, sf_dir):
    """Profiles ridden the other way, with each place mapped onto a line a kilometre longer."""
    m = regions.mirrored(_profile(spark, sf_dir)).withColumn("z", F.max("km").over(W.partitionBy("line")))
    place = regions.axis_map(F.col("z") - F.col("km"), F.col("z"), F.col("z") + 1)
    return m.select("line", F.round("km", 4).alias("km"), F.round("ele", 2).alias("ele"), F.round(place, 4).alias("on_line"))


@query("SELECT s_suppkey, CASE WHEN round(s_acctbal - s_suppkey * 50) > 0 THEN round(s_acctbal - s_suppkey * 50) ELSE 0 END::INT AS climb FROM supplier")
def lift_climbs(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", geo.lift_climb(F.col("s_suppkey") * 50, F.col("s_acctbal")).alias("climb"))


@query("SELECT 'regions/' || n_name || '.json?v=' || substr(md5(n_name), 1, 10) AS url FROM nation")
def versioned_urls(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(facets.versioned_url(F.col("n_name"), F.substring(F.md5("n_name"), 1, 10)).alias("url"))


@query(f"WITH {_PART} SELECT region, count(*) FILTER (diff IN ('gruen', 'rot')) AS shown, count(*) FILTER (diff NOT IN ('gruen', 'rot')) AS hidden, count(*) AS total FROM p GROUP BY 1")
def facet_counts_by_region(spark, sf_dir):
    return facets.counts(_parts(spark, sf_dir), F.col("diff").isin("gruen", "rot"), "region")


@query(f"WITH {_PART} SELECT id, region, row_number() OVER (PARTITION BY region ORDER BY up DESC, id) AS by_up, row_number() OVER (PARTITION BY region ORDER BY down DESC, id) AS by_down FROM p")
def facet_sort_by_height(spark, sf_dir):
    pos = lambda by: F.row_number().over(W.partitionBy("region").orderBy(*facets.sort_key(by))).cast("long")
    return _parts(spark, sf_dir).select("id", "region", pos("up").alias("by_up"), pos("down").alias("by_down"))


_CHAIN = f"c AS (SELECT l_orderkey AS chain, {_SEQ} AS seq, l_partkey AS id, l_discount * 10 AS lo, l_discount * 10 + l_quantity / 20 AS hi, l_linestatus = 'O' AS clipped, l_tax * 4000 AS gap, l_returnflag = 'A' AS off, l_returnflag = 'R' AS back FROM lineitem)"


def _chain(spark, sf_dir):
    i = _segments(spark, sf_dir)
    lo, hi, back = F.col("l_discount") * 10, F.col("l_discount") * 10 + F.col("l_quantity") / 20, F.col("l_returnflag") == "R"
    return i.select(F.col("line").alias("chain"), "seq", F.col("l_partkey").alias("id"), F.when(back, hi).otherwise(lo).alias("from_km"), F.when(back, lo).otherwise(hi).alias("to_km"), (F.col("l_linestatus") == "O").alias("clipped"), (F.col("l_tax") * 4000).alias("gap_m"), (F.col("l_returnflag") == "A").alias("off"))


@query(f"""WITH {_CHAIN}, pr AS (SELECT p_partkey AS id, k, k * 1.0::DOUBLE AS k0, k + 1.0::DOUBLE AS k1, CASE WHEN (p_partkey + k) % 3 = 0 THEN 30.0 ELSE -10.0 END AS rise FROM part, range(4) AS r(k)),
 x AS (SELECT c.chain, c.seq, any_value(hi - lo) AS km, sum(CASE WHEN b * g > 0 THEN b * g ELSE 0 END) AS up, sum(CASE WHEN b * g < 0 THEN -b * g ELSE 0 END) AS down FROM (SELECT c.*, greatest(0, least(hi, k1) - greatest(lo, k0)) AS g, CASE WHEN back THEN -rise ELSE rise END AS b FROM c JOIN pr ON pr.id = c.id WHERE clipped) c GROUP BY 1, 2
  UNION ALL SELECT chain, seq, p_retailprice / 100, CASE WHEN back THEN p_partkey % 70 ELSE p_size END, CASE WHEN back THEN p_size ELSE p_partkey % 70 END FROM c JOIN part ON p_partkey = id WHERE NOT clipped)
SELECT chain, round(sum(km), 3) AS km, round(sum(up), 3) AS up, round(sum(down), 3) AS down FROM x GROUP BY 1""")
def chain_totals(spark, sf_dir):
    p = F.col("p_partkey")
    parts = table(spark, sf_dir, "part")
    steps = parts.select(p.alias("id"), F.explode(F.sequence(F.lit(0), F.lit(4))).alias("k"))
    rise = F.when((F.col("id") + F.col("k") - 1) % 3 == 0, 30.0).otherwise(-10.0)
    ele = F.sum(F.when(F.col("k") == 0, 0.0).otherwise(rise)).over(W.partitionBy("id").orderBy("k").rowsBetween(W.unboundedPreceding, 0))
    prof = steps.select("id", "k", F.col("k").cast("double").alias("km"), ele.alias("ele"))
    whole = parts.select(p.alias("id"), (F.col("p_retailprice") / 100).alias("len"), F.col("p_size").alias("up"), (p % 70).alias("down"))
    t = chain.chain_totals(_chain(spark, sf_dir), whole, prof)
    return t.select("chain", *(F.round(c, 3).alias(c) for c in ("km", "up", "down")))


@query(f"WITH {_CHAIN} SELECT chain, count(*) AS n, count(*) FILTER (off OR round(gap, 4) > 150) AS unconnected FROM c GROUP BY 1")
def chain_export(spark, sf_dir):
    """The export documents, read again."""
    d = regions.export_documents(_chain(spark, sf_dir).withColumn("gap_m", F.round("gap_m", 4)))
    back = F.from_json("document", "struct<elements: array<struct<id: bigint, km: double>>, unconnected: bigint>")
    return d.select("chain", back.alias("x")).select("chain", F.size("x.elements").cast("long").alias("n"), F.col("x.unconnected").alias("unconnected"))


@query("WITH g AS (SELECT l_orderkey AS line, list(l_quantity ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS xs FROM lineitem GROUP BY 1) SELECT line, unnest(range(len(xs))) AS k, unnest(xs) AS y FROM g")
def profile_flatten(spark, sf_dir):
    """Nested sections of a profile as points in order."""
    s = _segments(spark, sf_dir).select("line", "seq", F.floor(F.col("seq") / 3).alias("section"), F.col("l_quantity").alias("y"))
    sections = s.groupBy("line", "section").agg(F.transform(F.sort_array(F.collect_list(F.struct("seq", "y"))), lambda x: x["y"]).alias("ys"))
    nested = sections.groupBy("line").agg(F.transform(F.sort_array(F.collect_list(F.struct("section", "ys"))), lambda x: x["ys"]).alias("nested"))
    return lines.flattened(nested, "nested").select("line", F.col("k").cast("long").alias("k"), F.col("v").alias("y"))


@query(f"WITH {TRACK} SELECT line, piece, seq - lo AS k, seq FROM track JOIN (VALUES (0, 0, 10), (1, 5, 25), (2, 40, 45)) AS c(piece, lo, hi) ON seq >= lo AND seq < hi")
def index_cuts(spark, sf_dir):
    cuts = spark.createDataFrame([(0, 0, 10), (1, 5, 25), (2, 40, 45)], "piece int, lo int, hi int")
    t = track(spark, sf_dir)
    return lines.cut_by_index(t.select("line", "seq"), t.select("line").distinct().join(F.broadcast(cuts))).select("line", "piece", "k", "seq")


# --- validators, sinks, streams, SQL functions ----------------------------------------------------------------------


@query("""WITH ext AS (SELECT c_nationkey AS k, round(min(46 + (c_custkey * 37 % 1000) / 20000.0::DOUBLE), 5) AS a, round(max(46 + (c_custkey * 37 % 1000) / 20000.0::DOUBLE), 5) AS b FROM customer GROUP BY 1)
SELECT 'falling' AS rule, o_custkey::VARCHAR AS entity, count(*)::VARCHAR AS detail FROM (SELECT o_custkey, o_totalprice, lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS p FROM orders) WHERE o_totalprice < p GROUP BY 2
UNION ALL SELECT 'segment', c_custkey::VARCHAR, c_mktsegment FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY')
UNION ALL SELECT 'name', p_name, '^[a-z]+ [a-z]' FROM part WHERE NOT regexp_matches(p_name, '^[a-z]+ [a-z]')
UNION ALL SELECT 'extents', k::VARCHAR, 'min_lat,max_lat' FROM ext WHERE k % 3 = 0
UNION ALL SELECT 'hash', n_name, CASE WHEN n_nationkey % 5 = 0 THEN 'changed' ELSE 'removed' END FROM nation WHERE n_nationkey % 5 = 0 OR n_nationkey > 20""")
def region_validator(spark, sf_dir):
    c, o, p, n = (table(spark, sf_dir, t) for t in ("customer", "orders", "part", "nation"))
    k = F.col("c_custkey")
    points = c.select(F.col("c_nationkey").alias("k"), (46 + (k * 37 % 1000) / 20000.0).alias("lat"), (10 + (k * 91 % 1000) / 20000.0).alias("lon"))
    sides = [f(x).alias(f"{m}_{x}") for m, f in (("min", F.min), ("max", F.max)) for x in ("lat", "lon")]
    off = F.when(F.col("k") % 3 == 0, 0.01).otherwise(0.0)
    declared = points.groupBy("k").agg(*sides).withColumn("min_lat", F.col("min_lat") + off).withColumn("max_lat", F.col("max_lat") + off)
    hashed = n.select(F.col("n_name").alias("key"), F.md5("n_name").alias("hash"), "n_nationkey")
    files = hashed.where("n_nationkey <= 20").withColumn("hash", F.when(F.col("n_nationkey") % 5 == 0, "x").otherwise(F.col("hash")))
    return tables.all_violations([
        tables.falling(o, "o_custkey", "o_orderkey", "o_totalprice", "falling"), tables.not_one_of(c, "c_custkey", "c_mktsegment", ["BUILDING", "AUTOMOBILE", "MACHINERY"], "segment"),
        tables.misnamed(p, "p_name", "^[a-z]+ [a-z]", "name"), tables.wrong_extents(points, "k", declared, "extents"), tables.stale_hashes(hashed, files, "hash"),
    ])


@query(f"WITH {TRAILS} SELECT nation AS region_key, '{{ label: \"N' || nation || '\", trailCount: ' || count(*) || ', bounds: [[' || printf('%.5f', min(lat)) || ', ' || printf('%.5f', min(lon)) || '], [' || printf('%.5f', max(lat)) || ', ' || printf('%.5f', max(lon)) || ']], subRegions: [' || string_agg(DISTINCT diff, ', ' ORDER BY diff) || '] }}' AS entry FROM trails GROUP BY 1")
def catalog_entries(spark, sf_dir):
    from ridgeline.sources.sinks import catalog_entries as entries

    t = trails(spark, sf_dir)
    return entries(t.select(F.col("nation").alias("region_key"), F.concat(F.lit("N"), F.col("nation").cast("string")).alias("label"), F.col("diff").alias("sub"), "lat", "lon"))


@query(f"WITH {TRAILS} SELECT nation AS region_key, count(*) AS trails, count(*) * 2 AS points, count(*) FILTER (line % 5 = 0) AS lifts, count(*) FILTER (line % 5 = 0) > 0 AS has_lifts FROM trails GROUP BY 1")
def region_documents(spark, sf_dir):
    """Region documents with all their parts, read again."""
    from ridgeline.sources.sinks import region_documents as documents

    t = trails(spark, sf_dir).select(F.col("nation").alias("region_key"), F.col("line").cast("string").alias("id"), "name", "lat", "lon", "line")
    both = t.select("region_key", "id", F.explode(F.array(F.lit(0), F.lit(1))).alias("seq"), "lat", "lon")
    prof = both.select("region_key", "id", F.col("seq").alias("k"), F.col("seq").cast("double").alias("km"), F.lit(500.0).alias("ele"))
    lifts = t.where("line % 5 = 0").select("region_key", "id", "name")
    d = documents(t.select("region_key", "id", "name"), both, prof, places=t.select("region_key", "name"), lifts=lifts)
    back = F.from_json("document", "struct<lineTrails: array<struct<id: string>>, trailGeo: map<string, array<array<double>>>, lifts: array<struct<id: string>>>")
    x = d.select("region_key", "document", back.alias("x"))
    points = F.aggregate(F.map_values("x.trailGeo"), F.lit(0), lambda a, p: a + F.size(p))
    return x.select("region_key", F.size("x.lineTrails").cast("long").alias("trails"), points.cast("long").alias("points"), F.coalesce(F.greatest(F.size("x.lifts"), F.lit(0)), F.lit(0)).cast("long").alias("lifts"), F.contains("document", F.lit('"lifts":')).alias("has_lifts"))


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN '–' ELSE round(value * 3.6)::BIGINT || ' km/h' END AS kmh, CASE WHEN event_id % 6 = 0 THEN '–' ELSE (event_id % 3000) || ' m' END AS altitude_shown FROM events")
def live_readout(spark, sf_dir):
    from ridgeline.streaming.tracks import readout

    i = F.col("event_id")
    fixes = table(spark, sf_dir, "events").select("event_id", F.when(i % 4 != 0, F.col("value")).alias("speed"), F.when(i % 6 != 0, (i % 3000).cast("double")).alias("altitude"))
    return readout(fixes).select("event_id", "kmh", "altitude_shown")


@query("SELECT p_partkey AS slug, CASE WHEN p_partkey % 2 = 0 AND p_partkey % 3 <> 0 THEN 'old' ELSE 'new' END AS body FROM part")
def resumed_harvest(spark, sf_dir):
    """What an interrupted harvest left, and what a second run fetches of the rest or anew, put in by key."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("slug"))
    kept = p.where("slug % 2 = 0").withColumn("body", F.lit("old"))
    rest = p.join(kept.select("slug"), "slug", "left_anti").unionByName(p.where("slug % 6 = 0")).withColumn("body", F.lit("new"))
    from ridgeline.sources.sinks import upsert

    return upsert(kept, rest, "slug")


@query(f"""WITH RECURSIVE s AS (SELECT s_suppkey AS id, 46 + (s_suppkey * 53 % 1000) / 20000.0::DOUBLE AS lat, 10 + (s_suppkey * 71 % 1000) / 20000.0::DOUBLE AS lon, row_number() OVER (ORDER BY s_suppkey) AS rk FROM supplier),
 g AS (SELECT 0::BIGINT AS rk, NULL::BIGINT AS id, false AS keep, []::STRUCT(a DOUBLE, b DOUBLE)[] AS kept UNION ALL SELECT x.rk, x.id, x.ok, CASE WHEN x.ok THEN list_append(x.kept, struct_pack(a := x.lat, b := x.lon)) ELSE x.kept END FROM (SELECT s.*, g.kept, len(list_filter(g.kept, lambda k: {hav("k.a", "k.b", "s.lat", "s.lon")} <= 500)) = 0 AS ok FROM g JOIN s ON s.rk = g.rk + 1) x)
SELECT id FROM g WHERE keep""")
def ordered_duplicates(spark, sf_dir):
    """Places in order of id; one goes if one that stays before it lies within 500 m."""
    s = F.col("s_suppkey")
    p = table(spark, sf_dir, "supplier").select(s.alias("id"), (46 + (s * 53 % 1000) / 20000.0).alias("lat"), (10 + (s * 71 % 1000) / 20000.0).alias("lon"))
    return ranking.first_of_near(p, 500.0, (0.006, 0.009))


@query(f"WITH {TRACK}, {_EDGE} SELECT line, seq, round({hav('lat', 'lon', 'lat2', 'lon2')}, 3) AS m FROM edge WHERE lat2 IS NOT NULL")
def sql_functions(spark, sf_dir):
    """The kernels as SQL functions of the session."""
    from ridgeline.functions import sql

    sql.register(spark)
    e = nearest.edges_of(track(spark, sf_dir))
    return e.select("line", "seq", F.round(F.expr("haversine_m(lat, lon, lat2, lon2)"), 3).alias("m"))


@query(f"""WITH RECURSIVE {SEGMENTS}, c AS (SELECT line, seq, start_lat, start_lon, end_lat, end_lon FROM seg),
 r AS (SELECT line, seq, end_lat AS x, end_lon AS y, false AS flipped, NULL::DOUBLE AS m FROM c WHERE (line, seq) IN (SELECT (line, min(seq)) FROM c GROUP BY line)
  UNION ALL SELECT line, seq, CASE WHEN to_b < to_a THEN start_lat ELSE end_lat END, CASE WHEN to_b < to_a THEN start_lon ELSE end_lon END, to_b < to_a, least(to_a, to_b) FROM
   (SELECT c.*, {hav('r.x', 'r.y', 'c.start_lat', 'c.start_lon')} AS to_a, {hav('r.x', 'r.y', 'c.end_lat', 'c.end_lon')} AS to_b FROM r JOIN c ON c.line = r.line AND c.seq = r.seq + 1))
SELECT line, seq AS piece, flipped, round(m, 2) AS joint_m FROM r""")
def section_chain(spark, sf_dir):
    """The segments of each line as sections: how each has to be turned to follow the one before."""
    s = _segments(spark, sf_dir).select("line", F.col("seq").alias("piece"), F.col("start_lat").alias("a_lat"), F.col("start_lon").alias("a_lon"), F.col("end_lat").alias("b_lat"), F.col("end_lon").alias("b_lon"))
    return lines.chained_sections(s, 1000.0).select("line", "piece", "flipped", F.round("joint_m", 2).alias("joint_m"))

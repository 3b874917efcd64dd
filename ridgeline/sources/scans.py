"""Scans: track files, listing pages and map responses into rows, by built-in functions over whole texts.

Strict parsers fail on real files (unescaped &, attributes in any order), so these are regular expressions on the JVM.
Every scan takes a DataFrame with a text column, from spark.read.text(path, wholetext=True) or any table.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_whole(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of each file."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def attribute(tag: Column, name: str) -> Column:
    """A tag's attribute by name, in either quotes; null if it has none."""
    quoted = F.regexp_extract(tag, rf"""\s{name}\s*=\s*("[^"]*"|'[^']*')""", 1)
    return F.when(quoted != "", quoted.substr(F.lit(2), F.length(quoted) - 2))


def elements(text: Column, name: str) -> Column:
    """Whole elements of a name in order, as strings: those with a body, and those that close themselves."""
    return F.regexp_extract_all(text, F.lit(rf"(?s)(<{name}(?=[\s/>])[^>]*(?:(?<=/)>|(?<!/)>.*?</{name}\s*>))"), F.lit(1))


def opening(element: Column) -> Column:
    return F.substring_index(element, ">", 1)


def body(element: Column) -> Column:
    """What stands between an element's opening tag and its closing one."""
    rest = F.substring(element, F.length(opening(element)) + 2, F.length(element))
    return F.regexp_replace(rest, r"</[^<]*$", "")


def plain(x: Column) -> Column:
    """Text without tags and outer spaces."""
    return F.trim(F.regexp_replace(x, "<[^>]*>", ""))


def number(x: Column) -> Column:
    return F.trim(x).try_cast("double")


def gpx_points(files: DataFrame, key: str = "path", text: str = "text") -> DataFrame:
    """(key, seq, lat, lon, ele): track points, or route points where there are none; points without both coordinates are
    skipped, an absent height is null."""
    track = elements(F.col(text), "trkpt")
    found = F.when(F.size(track) > 0, track).otherwise(elements(F.col(text), "rtept"))
    rows = files.select(key, F.posexplode(found).alias("pos", "p"))
    height = body(F.try_element_at(elements(F.col("p"), "ele"), F.lit(1)))
    height = F.replace(F.replace(height, F.lit("<![CDATA["), F.lit("")), F.lit("]]>"), F.lit(""))
    rows = rows.select(key, "pos", opening(F.col("p")).alias("o"), height.alias("h"))
    rows = rows.select(key, "pos", number(attribute(F.col("o"), "lat")).alias("lat"), number(attribute(F.col("o"), "lon")).alias("lon"), number(F.col("h")).alias("ele")).where("lat is not null and lon is not null")
    from ridgeline.operators.lines import along

    return rows.withColumn("seq", F.row_number().over(along(key, "pos")) - 1).select(key, "seq", "lat", "lon", "ele")


def unescaped(x: Column) -> Column:
    """The named and usual numbered entities."""
    for a, b in (("&quot;", '"'), ("&#39;", "'"), ("&#34;", '"'), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def gpx_name(text: Column) -> Column:
    """The name of the metadata, else the first name there is, without entities, a number or the letters TC before it, and quotes; null if there is none."""
    first = lambda x, name: F.try_element_at(elements(x, name), F.lit(1))
    name = F.coalesce(body(first(first(text, "metadata"), "name")), body(first(text, "name")))
    name = F.ltrim(F.trim(unescaped(name)))
    digits = F.length(name) - F.length(F.ltrim(name, F.lit("0123456789")))
    name = F.trim(F.when(digits > 0, F.ltrim(name, F.lit("0123456789"))).when(F.startswith(name, F.lit("TC")), F.substring(name, 3, 1 << 30)).otherwise(name))
    return F.array_join(F.filter(F.split(F.trim(F.btrim(name, F.lit('"“”'))), r"\s"), lambda w: w != ""), " ")


def triples(x: Column, separator: str, lon_first: bool = True, drop_zero: bool = False) -> Column:
    """array<struct<lat, lon, ele>> of 'lon,lat[,ele]' tokens; bad tokens are skipped, with drop_zero a height of '0' is null."""
    parts = F.transform(F.split(F.trim(x), separator), lambda t: F.split(t, ","))
    number = lambda a, i: F.try_element_at(a, F.lit(i)).try_cast("double")
    height = lambda a: F.when(F.lit(drop_zero) & (F.try_element_at(a, F.lit(3)) == "0"), F.lit(None)).otherwise(number(a, 3))
    lat, lon = (2, 1) if lon_first else (1, 2)
    made = F.transform(parts, lambda a: F.struct(number(a, lat).alias("lat"), number(a, lon).alias("lon"), height(a).alias("ele")))
    return F.filter(made, lambda p: p["lat"].isNotNull() & p["lon"].isNotNull())


def kml_points(files: DataFrame, key: str = "path", text: str = "text") -> DataFrame:
    """(key, seq, lat, lon, ele) of all coordinate blocks in order."""
    blocks = F.regexp_extract_all(F.col(text), F.lit(r"(?s)<coordinates>(.*?)</coordinates>"), F.lit(1))
    points = F.flatten(F.transform(blocks, lambda b: triples(b, r"\s+")))
    return files.select(key, F.posexplode(points).alias("seq", "p")).select(key, "seq", "p.*")


# What a listing page calls its table, its difficulty marks, its hidden lines and its links' kinds.
LISTING_TABLE, DIFFICULTY_MARK, HIDDEN_MARK, LINE_LINK, AREA_LINK = "trails_table", "dicon_small", "hidden_trail", "trails", "region"


def listing_rows(pages: DataFrame, key: str = "page", html: str = "html") -> DataFrame:
    """Rows of a listing table: slug, name, diff, area, area_slug, m, down, up, hidden. The difficulty is the title of the
    row's difficulty mark, not the first title in it; rows with under six cells or without a link are none.

    Rows and cells are cut first; links, marks and values are then read by their attributes' names."""
    page = F.col(html)
    table = F.filter(elements(page, "table"), lambda t: attribute(opening(t), "id") == LISTING_TABLE)
    rows = pages.select(key, F.posexplode(elements(F.try_element_at(table, F.lit(1)), "tr")).alias("row_no", "r"))
    rows = rows.select(key, "row_no", elements(F.col("r"), "td").alias("cells"), elements(F.col("r"), "a").alias("links"), elements(F.col("r"), "span").alias("marks"))
    path = lambda link: F.filter(F.split(attribute(opening(link), "href"), "/"), lambda x: x != "")
    of_kind = lambda kind: F.filter(F.col("links"), lambda x: F.try_element_at(path(x), F.lit(-2)) == kind)
    titled = F.filter(F.col("marks"), lambda x: F.coalesce(F.startswith(attribute(opening(x), "class"), F.lit(DIFFICULTY_MARK)), F.lit(False)))
    values = F.filter(F.transform(F.col("cells"), lambda c: number(attribute(opening(c), "data-v"))), lambda v: v.isNotNull())
    first = lambda x: F.try_element_at(x, F.lit(1))
    found = rows.where(F.size("cells") >= 6).select(key, "row_no", first(of_kind(LINE_LINK)).alias("line"), first(of_kind(AREA_LINK)).alias("area_link"), first(titled).alias("mark"), values.alias("v"))
    slug = lambda link: F.try_element_at(path(F.col(link)), F.lit(-1))
    return found.where("line is not null").select(
        key, "row_no", slug("line").alias("slug"), plain(body(F.col("line"))).alias("name"), attribute(opening(F.col("mark")), "title").alias("diff"), plain(body(F.col("area_link"))).alias("area"), slug("area_link").alias("area_slug"),
        *(F.try_element_at("v", F.lit(i + 1)).alias(c) for i, c in enumerate(("m", "down", "up"))), F.coalesce(F.contains(attribute(opening(F.col("line")), "class"), F.lit(HIDDEN_MARK)), F.lit(False)).alias("hidden"),
    )


def first_seed_wins(rows: DataFrame, seed_no: str = "seed_no", page: str = "page") -> DataFrame:
    """One row a slug: that of the first seed, page and row."""
    best = F.min_by(F.struct(*rows.columns), F.struct(seed_no, page, "row_no"))
    return rows.groupBy("slug").agg(best.alias("b")).select("b.*")


def to_harvest(listing: DataFrame, harvested: DataFrame, skip_areas: tuple[str, ...] = ()) -> DataFrame:
    """Listing rows with a real difficulty that are not harvested yet."""
    real = listing.where(F.col("diff").isNotNull() & ~F.lower("diff").startswith("access") & ~F.coalesce(F.col("area_slug").isin(*skip_areas), F.lit(False)))
    return real.join(harvested.select("slug"), "slug", "left_anti")


def decoded_polyline(x: Column, precision: int = 5) -> Column:
    """array<struct<lat, lon>> of an encoded polyline; a cut-off end is dropped."""
    scale = 10.0**precision

    @F.pandas_udf("array<struct<lat: double, lon: double>>")
    def decode(lines: pd.Series) -> pd.Series:
        out = []
        for line in lines:
            if line is None:
                out.append(None)
                continue
            code = np.frombuffer(line.encode("latin-1", "replace"), np.uint8).astype(np.int64) - 63
            last = np.flatnonzero(code < 32)  # a number's last five bits
            code = code[: last[-1] + 1] if len(last) else code[:0]
            first = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
            place = np.arange(len(code)) - np.repeat(first, np.diff(np.append(first, len(code))))
            raw = np.add.reduceat((code & 31) << (5 * place), first) if len(first) else first
            steps = np.where(raw & 1, ~(raw >> 1), raw >> 1)
            points = np.cumsum(steps[: len(steps) // 2 * 2].reshape(-1, 2), axis=0) / scale
            out.append([{"lat": a, "lon": b} for a, b in points.tolist()])
        return pd.Series(out)

    return decode(x)


def page_geometry(pages: DataFrame, key: str = "slug", html: str = "html") -> DataFrame:
    """(key, c, p): a page's encoded line decoded, and its chart points (x, ele, lat, lon), numbers quoted or not; null where absent.
    A page that has neither is a row of nulls, so it differs from a page never fetched."""
    quoted = F.substring_index(F.substring_index(html, "encodedpath", -1), "'", 2)
    path = F.when(F.contains(F.col(html), F.lit("encodedpath")), F.replace(F.substring_index(quoted, "'", -1), F.lit("\\\\"), F.lit("\\")))
    # whole objects of numbers after the chart's marker, then each number by its name
    chart = F.when(F.contains(F.col(html), F.lit("new ElevationChart(")), F.substring_index(html, "new ElevationChart(", -1))
    value = lambda o, name: number(F.replace(F.regexp_extract(o, f'"{name}"\\s*:([^,}}]*)', 1), F.lit('"'), F.lit("")))
    objects = F.transform(F.regexp_extract_all(chart, F.lit(r"(\{[^{}]*\})"), F.lit(1)), lambda o: F.struct(value(o, "x").alias("x"), value(o, "y").alias("ele"), value(o, "lat").alias("lat"), value(o, "lng").alias("lon")))
    points = F.filter(objects, lambda o: o["x"].isNotNull() & o["ele"].isNotNull() & o["lat"].isNotNull() & o["lon"].isNotNull())
    return pages.select(key, decoded_polyline(F.nullif(path, F.lit(""))).alias("c"), F.when(F.size(points) > 0, points).alias("p"))


def osm_ways(responses: DataFrame, body: str = "text") -> DataFrame:
    """(way_id, tags, points) of map responses in JSON."""
    schema = "struct<elements: array<struct<type: string, id: bigint, tags: map<string, string>, geometry: array<struct<lat: double, lon: double>>>>>"
    rows = responses.select(F.explode(F.from_json(F.col(body), schema)["elements"]).alias("e")).where("e.type = 'way'")
    return rows.select(F.col("e.id").alias("way_id"), F.col("e.tags").alias("tags"), F.col("e.geometry").alias("points"))


def halves_collapsed(points: Column, rounds: int = 31) -> Column:
    """While an array of even length from 4 on repeats its first half, only that stays; 31 rounds cover any array."""

    def once(x: Column, _: Column) -> Column:
        half = F.greatest((F.size(x) / 2).cast("int"), F.lit(1))
        twice = (F.size(x) >= 4) & (F.size(x) % 2 == 0) & (F.slice(x, 1, half) == F.slice(x, half + 1, half))
        return F.when(twice, F.slice(x, 1, half)).otherwise(x)

    return F.aggregate(F.array_repeat(F.lit(0), rounds), points, once)


def elevations(points: DataFrame, known: DataFrame) -> DataFrame:
    """points with ele_found from a cache (key 'lat,lon' to 5 places, ele); misses stay null."""
    key = F.format_string("%.5f,%.5f", F.col("lat"), F.col("lon"))
    return points.withColumn("_key", key).join(known.select(F.col("key").alias("_key"), F.col("ele").alias("ele_found")), "_key", "left").drop("_key")


def nested_tracks(responses: DataFrame, key: str = "tour", body: str = "text") -> DataFrame:
    """(key, seq, lat, lon, ele) of tours in nested JSON: segments, routes, features, lines of [lon, lat, ele]; other shapes
    than lines and immediate repeats are left out."""
    schema = "struct<segments: array<struct<routes: array<struct<features: array<struct<geometry: struct<type: string, coordinates: array<array<double>>>>>>>>>>"
    routes = F.flatten(F.transform(F.from_json(F.col(body), schema)["segments"], lambda s: F.coalesce(s["routes"], F.from_json(F.lit("[]"), "array<struct<features: array<struct<geometry: struct<type: string, coordinates: array<array<double>>>>>>>"))))
    shapes = F.flatten(F.transform(routes, lambda r: r["features"]))
    lines = F.filter(shapes, lambda f: f["geometry"]["type"] == "LineString")
    points = responses.select(key, F.posexplode(F.flatten(F.transform(lines, lambda f: f["geometry"]["coordinates"]))).alias("pos", "c"))
    at = lambda i: F.try_element_at("c", F.lit(i))
    from ridgeline.operators.lines import along

    p = points.select(key, "pos", at(2).alias("lat"), at(1).alias("lon"), at(3).alias("ele"))
    w = along(key, "pos")
    same = F.col("lat").eqNullSafe(F.lag("lat").over(w)) & F.col("lon").eqNullSafe(F.lag("lon").over(w)) & (F.row_number().over(w) > 1)
    p = p.withColumn("_same", same).where("not _same")
    return p.withColumn("seq", F.row_number().over(w) - 1).select(key, "seq", "lat", "lon", "ele")


def route_geometry(pages: DataFrame, key: str = "slug", html: str = "html") -> DataFrame:
    """(key, points): a route page's chart points, else its encoded line without heights, and no repeated halves."""
    g = page_geometry(pages, key, html)
    chart = F.transform("p", lambda p: F.struct(p["lat"].alias("lat"), p["lon"].alias("lon"), p["ele"].alias("ele")))
    line = F.transform("c", lambda p: F.struct(p["lat"].alias("lat"), p["lon"].alias("lon"), F.lit(None).cast("double").alias("ele")))
    return g.select(key, halves_collapsed(F.coalesce(chart, line)).alias("points"))


def named_ways(ways: DataFrame, pattern: str, highways: tuple[str, ...]) -> DataFrame:
    """Ways of given kinds whose name holds a pattern."""
    return ways.where(F.coalesce(F.col("tags")["name"].rlike(pattern), F.lit(False)) & F.col("tags")["highway"].isin(*highways))


def aerialways(ways: DataFrame, least_m: float = 200.0) -> DataFrame:
    """(way_id, kind, name, length_m) of cable ways of least_m or more from end to end along their points."""
    from ridgeline.operators.lines import line_measures

    own = ways.where(F.col("tags")["aerialway"].isNotNull())
    points = own.select("way_id", F.posexplode("points").alias("seq", "p")).select("way_id", "seq", "p.lat", "p.lon")
    size = line_measures(points, "way_id", "seq").select(F.col("way_id").alias("_w"), "length_m").where(F.col("length_m") >= least_m)
    return own.join(size, F.col("way_id") == F.col("_w")).select("way_id", F.col("tags")["aerialway"].alias("kind"), F.col("tags")["name"].alias("name"), "length_m")


_TOKEN = re.compile(r'''//[^\n]*|/\*.*?\*/|(?P<text>"(?:\\.|[^"\\])*"|'(?:\\.|[^'\\])*')|(?P<name>[A-Za-z_$][\w$]*|\d+(?:\.\d+)?)|(?P<mark>[{}\[\]:,])''', re.S)


def object_literal(source: str, name: str) -> dict:
    """The object literal assigned to a name in script text, as nested dicts; comments and strings don't confuse it, lists are left out.

    One token at a time goes onto a stack of open objects."""
    at = source.find("{", source.index(name))
    root: dict = {}
    stack, key, word, depth = [root], None, None, 0
    for m in _TOKEN.finditer(source, at + 1):
        mark = m.group("mark")
        if mark == "[":
            depth += 1
        elif mark == "]":
            depth -= 1
        if depth or mark == "]":
            continue
        if m.group("text") is not None:
            word = m.group("text")[1:-1]
        elif m.group("name") is not None:
            word = m.group("name")
        if mark == ":":
            key, word = word, None
        elif mark == "{":
            inner: dict = {}
            stack[-1][key] = inner
            stack.append(inner)
            key = word = None
        elif mark in (",", "}"):
            if key is not None and word is not None:
                stack[-1][key] = word
            key = word = None
            if mark == "}":
                stack.pop()
                if not stack:
                    return root
    raise ValueError(f"{name}: the literal is not closed")


def catalog_rows(spark: SparkSession, source: str, name: str = "REGION_CATALOG") -> DataFrame:
    """(region_key, label, trail_count, sub, color, sub_label): the catalog in a page's script, a row a sub-region, or one with nulls."""
    rows = []
    for key, entry in object_literal(source, name).items():
        count = entry.get("trailCount")
        head = (key, entry.get("label", key), int(count) if count else None)
        subs = entry.get("subRegions") or {None: {}}
        rows += [(*head, k, v.get("color"), v.get("label")) for k, v in subs.items()]
    return spark.createDataFrame(rows, "region_key string, label string, trail_count int, sub string, color string, sub_label string")


def region_labels(catalog: DataFrame) -> DataFrame:
    """(region_key, labels): the region's own label and those of its sub-regions, split at slashes and hyphens."""
    each = catalog.select("region_key", F.explode(F.array("label", "sub_label")).alias("l")).where("l is not null")
    parts = each.select("region_key", F.explode(F.split("l", r"\s*[/-]\s*")).alias("p")).unionByName(each.select("region_key", F.col("l").alias("p")))
    return parts.where("p <> ''").groupBy("region_key").agg(F.sort_array(F.collect_set("p")).alias("labels"))

"""Sinks: region documents, manifests, GPX text."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The order of a region document's keys; the last two are written only where they hold something.
REGION_KEYS = ("lineTrails", "trailGeo", "elevationProfiles", "places", "trailSegments", "lifts")


def region_documents(trails: DataFrame, points: DataFrame, profiles: DataFrame, places: DataFrame | None = None, segments: DataFrame | None = None, lifts: DataFrame | None = None, key: str = "region_key") -> DataFrame:
    """(key, document): one JSON text a region from the tables of trails (id and its fields), points (id, seq, lat, lon),
    profiles (id, k, km, ele), and where given places, segments (loop_id, pos and its fields) and lifts; the last two are
    left out of a region that has none. Written with df.write.text it is one file a region, which is the sink's unit."""

    def rows_of(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*[c for c in df.columns if c != key]))).alias(name))

    def by_id(df: DataFrame, order: str, pair: tuple[str, str], name: str) -> DataFrame:
        each = df.groupBy(key, "id").agg(F.sort_array(F.collect_list(F.struct(order, F.array(*pair).alias("p")))).alias("a"))
        return each.groupBy(key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("id", F.transform("a", lambda x: x["p"]).alias("v"))))).alias(name))

    parts = [by_id(points, "seq", ("lat", "lon"), "trailGeo"), by_id(profiles, "k", ("km", "ele"), "elevationProfiles")]
    parts += [rows_of(df, name) for df, name in ((places, "places"), (segments, "trailSegments"), (lifts, "lifts")) if df is not None]
    out = rows_of(trails, "lineTrails")
    for p in parts:
        out = out.join(p, key, "left")
    return out.select(key, F.to_json(F.struct(*[k for k in REGION_KEYS if k in out.columns])).alias("document"))


def catalog_entries(rows: DataFrame, key: str = "region_key") -> DataFrame:
    """(key, entry): a region's catalog text from rows (key, label, sub, lat, lon): label, number, bounds to 5 places and the
    sub-regions in use."""
    side = lambda x: F.format_string("%.5f", x)
    g = rows.groupBy(key).agg(F.first("label").alias("label"), F.count(F.lit(1)).alias("n"), F.array_join(F.sort_array(F.collect_set("sub")), ", ").alias("subs"), *(f(c).alias(f"{m}_{c}") for m, f in (("min", F.min), ("max", F.max)) for c in ("lat", "lon")))
    bounds = F.concat(F.lit("[["), side(F.col("min_lat")), F.lit(", "), side(F.col("min_lon")), F.lit("], ["), side(F.col("max_lat")), F.lit(", "), side(F.col("max_lon")), F.lit("]]"))
    entry = F.concat(F.lit('{ label: "'), "label", F.lit('", trailCount: '), F.col("n").cast("string"), F.lit(", bounds: "), bounds, F.lit(", subRegions: ["), "subs", F.lit("] }"))
    return g.select(key, entry.alias("entry"))


def region_text(document: dict) -> str:
    """A region document with keys in order, empty optional ones left out, no ASCII escapes."""
    keep = {k: document[k] for k in REGION_KEYS if k in document and (document[k] or k not in REGION_KEYS[4:])}
    return json.dumps(keep, ensure_ascii=False)


def file_hash(content: Column) -> Column:
    """The first ten hex digits of a content's MD5."""
    return F.substring(F.md5(content), 1, 10)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(key, hash) of the JSON files in a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(folder)
    return files.select(F.regexp_extract("path", r"([^/]+)\.json$", 1).alias("key"), file_hash(F.col("content")).alias("hash"))


def gpx_texts(points: DataFrame, line: str = "line", seq: str = "seq") -> DataFrame:
    """(line, gpx): each line as GPX text; a null height is left out."""
    ele = F.coalesce(F.concat(F.lit("<ele>"), F.col("ele").cast("string"), F.lit("</ele>")), F.lit(""))
    point = F.concat(F.lit('<trkpt lat="'), F.col("lat").cast("string"), F.lit('" lon="'), F.col("lon").cast("string"), F.lit('">'), ele, F.lit("</trkpt>"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col(seq).alias("s"), point.alias("p")))), lambda x: x["p"]), "")
    return points.groupBy(line).agg(F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?><gpx version="1.1"><trk><trkseg>'), body, F.lit("</trkseg></trk></gpx>")).alias("gpx"))


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old with new's rows put in by key; new's columns win."""
    n = new.select(*(F.col(c).alias(f"_n_{c}") for c in new.columns))
    both = old.join(n, F.col(key) == F.col(f"_n_{key}"), "full_outer")
    return both.select(*(F.when(F.col(f"_n_{key}").isNotNull(), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) for c in old.columns))

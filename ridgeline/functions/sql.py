"""The kernels as SQL functions of a session: scalar ones that Catalyst inlines, and a table function."""

from __future__ import annotations

from pyspark.sql import SparkSession

_HAVERSINE = "2 * 6371000 * asin(sqrt(pow(sin(radians(lat2 - lat1) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2)))"
FUNCTIONS = {
    "haversine_m(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) RETURNS DOUBLE": _HAVERSINE,
    "bearing_deg(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) RETURNS DOUBLE": "pmod(degrees(atan2(sin(radians(lon2 - lon1)) * cos(radians(lat2)), cos(radians(lat1)) * sin(radians(lat2)) - sin(radians(lat1)) * cos(radians(lat2)) * cos(radians(lon2 - lon1)))) + 360, 360)",
    "ascii_key(x STRING) RETURNS STRING": "regexp_replace(lower(x), '[^a-z0-9]', '')",
    "lift_climb(base DOUBLE, top DOUBLE) RETURNS INT": "cast(CASE WHEN round(top - base) > 0 THEN round(top - base) ELSE 0 END AS INT)",
    "way_penalty(highway STRING) RETURNS DOUBLE": "CASE WHEN highway IN ('path', 'footway', 'cycleway', 'bridleway') THEN 0D WHEN highway = 'track' THEN 6D WHEN highway IN ('service', 'residential') THEN 10D WHEN highway IN ('unclassified', 'tertiary', 'secondary', 'primary') THEN 20D ELSE 12D END",
    "stations(total_km DOUBLE, n INT) RETURNS TABLE (k INT, km DOUBLE)": "SELECT k, total_km * k / (n - 1) FROM (SELECT explode(sequence(0, n - 1)) AS k)",
}


def register(spark: SparkSession) -> list[str]:
    """Creates the functions in this session; their names."""
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [h.split("(")[0] for h in FUNCTIONS]

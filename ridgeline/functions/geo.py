"""Geometry kernels as Column expressions: all stay inside whole-stage code generation.

The distances differ on purpose: great circle, infinite line and clamped edge, with the metres a degree and the
latitude of the cosine that each metric is defined with. Null in, null out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
EARTH_M = 6_371_000.0
M_PER_LAT, M_PER_LON = 110_540.0, 111_320.0
KM_PER_LAT = 110.574


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres. No least(): it skips null, and a null step would become half the earth."""
    x = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_M) * F.asin(F.sqrt(F.when(x > 1, 1.0).otherwise(x)))


def _frame(lat: Column, lon: Column, lat0: Column, per_lat: float) -> tuple[Column, Column]:
    return lon * F.cos(F.radians(lat0)) * M_PER_LON, lat * per_lat


def perp_distance_m(p: tuple[Column, Column], a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """Metres from p to the infinite line through a and b, in the frame at a's latitude; to a where a = b."""
    (px, py), (ax, ay), (bx, by) = (_frame(*q, a[0], M_PER_LAT) for q in (p, a, b))
    dx, dy = bx - ax, by - ay
    length = F.sqrt(dx * dx + dy * dy)
    return F.when(length == 0, haversine_m(*p, *a)).otherwise(F.abs(dy * (px - ax) - dx * (py - ay)) / length)


def _clamped(t: Column) -> Column:
    return F.when(t < 0, 0.0).when(t > 1, 1.0).otherwise(t)


def edge_projection(p: tuple[Column, Column], a: tuple[Column, Column], b: tuple[Column, Column], mid_latitude: bool = False) -> Column:
    """struct(d, t, lat, lon): the nearest place on an edge and the great-circle metres to it.

    The frame's cosine is at a's latitude, or at the edge's middle and 0.15 at least with mid_latitude.
    """
    cos = F.cos(F.radians((a[0] + b[0]) / 2)) if mid_latitude else F.cos(F.radians(a[0]))
    if mid_latitude:
        cos = F.when(cos < 0.15, 0.15).otherwise(cos)
    dx, dy = (b[1] - a[1]) * cos * M_PER_LON, (b[0] - a[0]) * M_PER_LAT
    ex, ey = (p[1] - a[1]) * cos * M_PER_LON, (p[0] - a[0]) * M_PER_LAT
    square = dx * dx + dy * dy
    t = F.when(square == 0, 0.0).otherwise(_clamped((ex * dx + ey * dy) / square))
    lat, lon = a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])
    return F.struct(haversine_m(*p, lat, lon).alias("d"), t.alias("t"), lat.alias("lat"), lon.alias("lon"))


def edge_distance_m(p: tuple[Column, Column], a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """Metres to a clamped edge in latitude-equivalent degrees, longitudes scaled at p's latitude."""
    cos = F.cos(F.radians(p[0]))
    dx, dy = (b[1] - a[1]) * cos, b[0] - a[0]
    ex, ey = (p[1] - a[1]) * cos, p[0] - a[0]
    square = dx * dx + dy * dy
    t = F.when(square == 0, 0.0).otherwise(_clamped((ex * dx + ey * dy) / square))
    return F.sqrt(F.pow(ex - t * dx, 2) + F.pow(ey - t * dy, 2)) * M_PER_LON


def crossing(p1: tuple, p2: tuple, p3: tuple, p4: tuple) -> Column:
    """struct(lat, lon, t, u) where two edges cross, ends included; null where parallel or apart."""
    cos = F.cos(F.radians((p1[0] + p3[0]) / 2))
    cos = F.when(cos < 0.15, 0.15).otherwise(cos)
    xy = lambda q: (q[1] * cos, q[0])
    (x1, y1), (x2, y2), (x3, y3), (x4, y4) = map(xy, (p1, p2, p3, p4))
    det = (x2 - x1) * (y4 - y3) - (y2 - y1) * (x4 - x3)
    t = ((x3 - x1) * (y4 - y3) - (y3 - y1) * (x4 - x3)) / F.nullif(det, F.lit(0.0))
    u = ((x3 - x1) * (y2 - y1) - (y3 - y1) * (x2 - x1)) / F.nullif(det, F.lit(0.0))
    inside = (F.abs(det) > 1e-15) & t.between(0, 1) & u.between(0, 1)
    return F.when(inside, F.struct((p1[0] + t * (p2[0] - p1[0])).alias("lat"), (p1[1] + t * (p2[1] - p1[1])).alias("lon"), t.alias("t"), u.alias("u")))


def boxes_overlap(a: Column, b: Column) -> Column:
    """Of structs (min_lat, min_lon, max_lat, max_lon); touching counts."""
    return (a["min_lat"] <= b["max_lat"]) & (b["min_lat"] <= a["max_lat"]) & (a["min_lon"] <= b["max_lon"]) & (b["min_lon"] <= a["max_lon"])


def padded_box(lat1: Column, lon1: Column, lat2: Column, lon2: Column, pad_m: float) -> Column:
    """The box of two points with pad_m metres around, to 6 decimals."""
    cos = F.abs(F.cos(F.radians((lat1 + lat2) / 2)))
    cos = F.when(cos < 0.15, 0.15).otherwise(cos)
    dlat, dlon = pad_m / M_PER_LON, pad_m / (M_PER_LON * cos)
    lo = lambda x, y: F.when(x < y, x).otherwise(y)
    hi = lambda x, y: F.when(x > y, x).otherwise(y)
    sides = {"min_lat": lo(lat1, lat2) - dlat, "min_lon": lo(lon1, lon2) - dlon, "max_lat": hi(lat1, lat2) + dlat, "max_lon": hi(lon1, lon2) + dlon}
    return F.struct(*(F.round(v, 6).alias(k) for k, v in sides.items()))


def signed_km_to_line(lat: Column, lon: Column, west: tuple[float, float], east: tuple[float, float]) -> Column:
    """Kilometres of latitude above (positive) or below a boundary through two points, extrapolated beyond them."""
    slope = (east[0] - west[0]) / (east[1] - west[1])
    return (lat - (F.lit(west[0]) + F.lit(slope) * (lon - F.lit(west[1])))) * KM_PER_LAT


def bearing_deg(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial bearing, from 0 up to 360."""
    dl = F.radians(lon2 - lon1)
    y = F.sin(dl) * F.cos(F.radians(lat2))
    x = F.cos(F.radians(lat1)) * F.sin(F.radians(lat2)) - F.sin(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(dl)
    return F.pmod(F.degrees(F.atan2(y, x)) + 360, F.lit(360.0))


def destination(lat: Column, lon: Column, bearing: Column, metres: Column) -> Column:
    """struct(lat, lon) after so many metres along a bearing."""
    d, b, p = metres / EARTH_M, F.radians(bearing), F.radians(lat)
    to = F.asin(F.sin(p) * F.cos(d) + F.cos(p) * F.sin(d) * F.cos(b))
    dl = F.atan2(F.sin(b) * F.sin(d) * F.cos(p), F.cos(d) - F.sin(p) * F.sin(to))
    return F.struct(F.degrees(to).alias("lat"), (lon + F.degrees(dl)).alias("lon"))


def lift_climb(base: Column, top: Column) -> Column:
    """Metres that a lift gains, never below zero."""
    rise = F.round(top - base)
    return F.when(rise > 0, rise).otherwise(0).cast("int")

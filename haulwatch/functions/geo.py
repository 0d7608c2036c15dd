"""Coordinate conversion, distance and containment as Column expressions.

Everything here is built from Spark's own functions, so it runs in the JVM.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from haulwatch.functions.exprs import ColumnLike, col

# Constants of the published WGS-84 / GCJ-02 / BD-09 formulas.
PI = 3.14159265358979324
AXIS = 6378245.0
ECCENTRICITY_SQUARED = 0.00669342162296594323
X_PI = 3.14159265358979324 * 3000.0 / 180.0
BD_LNG_SHIFT = 0.0065
BD_LAT_SHIFT = 0.006
BD_RADIUS_WAVE = 0.00002
BD_ANGLE_WAVE = 0.000003
GCJ_ORIGIN_LNG = 105.0
GCJ_ORIGIN_LAT = 35.0
# Polynomial and sine terms (amplitude, angular rate) of the GCJ-02 offset.
SHARED_WAVES = ((20.0, 6.0 * PI), (20.0, 2.0 * PI))
LAT_WAVES = ((20.0, PI), (40.0, PI / 3.0), (160.0, PI / 12.0), (320.0, PI / 30.0))
LNG_WAVES = ((20.0, PI), (40.0, PI / 3.0), (150.0, PI / 12.0), (300.0, PI / 30.0))

EARTH_RADIUS_M = 6371000.0
METRES_PER_DEGREE = EARTH_RADIUS_M * PI / 180.0

Pair = tuple[Column, Column]


def _waves(x: Column, terms) -> Column:
    return reduce(lambda a, b: a + b, [F.sin(x * rate) * amp for amp, rate in terms]) * (2.0 / 3.0)


def wgs2gcj(lat: ColumnLike, lng: ColumnLike) -> Pair:
    """WGS-84 to GCJ-02; returns ``(lat, lng)``."""
    lat, lng = col(lat), col(lng)
    x, y = lng - GCJ_ORIGIN_LNG, lat - GCJ_ORIGIN_LAT
    common = x * y * 0.1 + F.sqrt(F.abs(x)) * 0.2
    north = x * 2.0 - 100.0 + y * 3.0 + y * y * 0.2 + common + _waves(x, SHARED_WAVES) + _waves(y, LAT_WAVES)
    east = (
        x + 300.0 + y * 2.0 + x * x * 0.1 + x * y * 0.1 + F.sqrt(F.abs(x)) * 0.1
        + _waves(x, SHARED_WAVES) + _waves(x, LNG_WAVES)
    )
    radians = lat / 180.0 * PI
    curvature = F.lit(1.0) - F.pow(F.sin(radians), 2) * ECCENTRICITY_SQUARED
    meridian = F.lit(AXIS * (1 - ECCENTRICITY_SQUARED)) / (curvature * F.sqrt(curvature)) * PI
    parallel = F.lit(AXIS) / F.sqrt(curvature) * F.cos(radians) * PI
    return lat + north * 180.0 / meridian, lng + east * 180.0 / parallel


def _polar_shift(x: Column, y: Column, sign: float) -> Pair:
    radius = F.sqrt(x * x + y * y) + F.sin(y * X_PI) * (sign * BD_RADIUS_WAVE)
    angle = F.atan2(y, x) + F.cos(x * X_PI) * (sign * BD_ANGLE_WAVE)
    return radius * F.sin(angle), radius * F.cos(angle)


def gcj2bd(lat: ColumnLike, lng: ColumnLike) -> Pair:
    """GCJ-02 to BD-09; returns ``(lat, lng)``."""
    y, x = _polar_shift(col(lng), col(lat), 1.0)
    return y + BD_LAT_SHIFT, x + BD_LNG_SHIFT


def bd2gcj(lat: ColumnLike, lng: ColumnLike) -> Pair:
    """BD-09 to GCJ-02; returns ``(lat, lng)``."""
    return _polar_shift(col(lng) - BD_LNG_SHIFT, col(lat) - BD_LAT_SHIFT, -1.0)


def wgs2bd(lat: ColumnLike, lng: ColumnLike) -> Pair:
    """WGS-84 to BD-09; returns ``(lat, lng)``."""
    return gcj2bd(*wgs2gcj(lat, lng))


def distance_m(
    lng1: ColumnLike, lat1: ColumnLike, lng2: ColumnLike, lat2: ColumnLike, radius: float = EARTH_RADIUS_M
) -> Column:
    """Great-circle distance in metres on a sphere."""
    phi1, phi2 = F.radians(col(lat1)), F.radians(col(lat2))
    half_chord = F.pow(F.sin((phi2 - phi1) / 2), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(
        F.sin(F.radians(col(lng2) - col(lng1)) / 2), 2
    )
    # ``least`` would turn a missing coordinate into the longest distance; this keeps it null.
    return F.asin(F.sqrt(F.when(half_chord > 1.0, 1.0).otherwise(half_chord))) * (2.0 * radius)


def parse_ring_text(text: ColumnLike) -> Column:
    """``lng,lat;lng,lat`` as an array of ``(lng, lat)`` structs."""

    def vertex(part: Column) -> Column:
        pair = F.split(part, ",")
        return F.struct(
            F.trim(F.element_at(pair, 1)).try_cast("double").alias("lng"),
            F.trim(F.try_element_at(pair, F.lit(2))).try_cast("double").alias("lat"),
        )

    return F.transform(F.filter(F.split(col(text), ";"), lambda part: F.trim(part) != ""), vertex)


def _pairs_to_ring(pairs: Column) -> Column:
    return F.transform(
        pairs,
        lambda p: F.struct(F.try_element_at(p, F.lit(1)).alias("lng"), F.try_element_at(p, F.lit(2)).alias("lat")),
    )


def parse_ring_json(text: ColumnLike) -> Column:
    """``[[lng,lat],...]`` as an array of ``(lng, lat)`` structs."""
    return _pairs_to_ring(F.from_json(col(text), "array<array<double>>"))


def parse_routes_json(text: ColumnLike) -> Column:
    """``[[[lng,lat],...],...]`` as one flat array of ``(lng, lat)`` route vertices."""
    return _pairs_to_ring(F.flatten(F.from_json(col(text), "array<array<array<double>>>")))


def closed_edges(ring: Column) -> Column:
    """Edges of a closed ring as structs ``(x1, y1, x2, y2)``."""
    following = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.zip_with(
        ring,
        following,
        lambda a, b: F.struct(
            a["lng"].alias("x1"), a["lat"].alias("y1"), b["lng"].alias("x2"), b["lat"].alias("y2")
        ),
    )


def ring_edges(ring: Column) -> Column:
    """``closed_edges`` without vertical ones, which never cross."""
    return F.filter(closed_edges(ring), lambda e: e["x1"] != e["x2"])


def crosses(lng: ColumnLike, lat: ColumnLike, edge: Column | Mapping[str, Column]) -> Column:
    """Whether a line upwards from the point crosses an edge (``x1, y1, x2, y2``); half-open on longitude."""
    x, y = col(lng), col(lat)
    height = (edge["y2"] - edge["y1"]) * (x - edge["x1"]) / (edge["x2"] - edge["x1"]) + edge["y1"]
    return ((edge["x1"] > x) != (edge["x2"] > x)) & (y < height)


def crosses_odd(lng: ColumnLike, lat: ColumnLike, edges: Column) -> Column:
    """Even-odd rule over ``ring_edges``; half-open on longitude."""
    return F.size(F.filter(edges, lambda e: crosses(lng, lat, e))) % 2 == 1


def in_polygon(lng: ColumnLike, lat: ColumnLike, ring: Column) -> Column:
    """Whether the point lies inside the ring; a missing coordinate or ring counts as outside."""
    return F.coalesce(crosses_odd(lng, lat, ring_edges(ring)), F.lit(False))


def off_route(lng: ColumnLike, lat: ColumnLike, routes: Column, radius_m: float = 500.0) -> Column:
    """True when no route vertex (vertices, not segments) lies within ``radius_m`` of the point."""
    return ~F.exists(routes, lambda v: distance_m(lng, lat, v["lng"], v["lat"]) <= radius_m)

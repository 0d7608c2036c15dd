"""Point-to-site and point-to-polygon matching by an equi-join on grid cells.

Targets are laid out over the cells they can touch; each point has exactly one cell, so points are never
multiplied before the join. The exact test follows the join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulwatch.functions import geo
from haulwatch.operators import covering
from haulwatch.operators.lookups import BROADCAST_BYTES, salted_join

# Bounds of the polygon cell size, and the size when there is no polygon to measure.
MIN_CELL_DEG, MAX_CELL_DEG, DEFAULT_CELL_DEG = 1e-3, 5.0, 0.05
# The grid box is a little wider than the radius, so rounding cannot lose a match.
MARGIN = 1.0001
# Most cells a site expands to below 60 degrees of latitude, for the broadcast size check.
CELLS_PER_TARGET = 16
# Pairs of a point and a site of its cell that one task compares.
TASK_PAIRS = 20_000_000
# Bytes of a polygon cell, whose number is bounded from the polygons' boxes.
ROW_BYTES, EDGE_BYTES = 256, 48


def _cells(df: DataFrame, west: Column, east: Column, south: Column, north: Column, size: float) -> DataFrame:
    def span(low: Column, high: Column) -> Column:
        return F.explode(F.sequence(F.floor(low / size), F.floor(high / size)))

    return df.withColumn("_cx", span(west, east)).withColumn("_cy", span(south, north))


def _with_cell(points: DataFrame, size: float) -> DataFrame:
    return points.withColumns({"_cx": F.floor(F.col("lng") / size), "_cy": F.floor(F.col("lat") / size)})


def _site_cell_deg(radius_m: float) -> float:
    return max(2.0 * radius_m / geo.METRES_PER_DEGREE, 1e-4)


def site_cells(
    sites: DataFrame, radius_m: float, on: Sequence[str], lng: str = "lng", lat: str = "lat", cell_deg: float | None = None
) -> DataFrame:
    """Sites over the grid cells within ``radius_m``: columns ``on``, ``_cx``, ``_cy``, ``target``."""
    half = radius_m / geo.METRES_PER_DEGREE * MARGIN
    payload = [c for c in sites.columns if c not in on]
    placed = sites.filter(F.col(lng).isNotNull() & F.col(lat).isNotNull()).select(
        *on, F.struct(*payload).alias("target")
    )
    x, y = F.col(f"target.{lng}"), F.col(f"target.{lat}")
    shrink = F.greatest(F.cos(F.radians(F.least(F.abs(y) + half, F.lit(89.9)))), F.lit(1e-3))
    return _cells(placed, x - F.lit(half) / shrink, x + F.lit(half) / shrink, y - half, y + half,
                  _site_cell_deg(radius_m) if cell_deg is None else cell_deg)


def match_sites(
    points: DataFrame,
    sites: DataFrame,
    radius_m: float,
    on: Sequence[str] = ("dept_id",),
    lng: str = "lng",
    lat: str = "lat",
    **kw,
) -> DataFrame:
    """Pairs of a point and a site strictly closer than ``radius_m``: point columns, ``target``, ``distance``.

    There can be very many more pairs than points. They are counted first: where they are more than one task should compare, points
    and sites are dealt by small cells, a cell with many pairs over many tasks, so that the tasks grow in number with the pairs.
    """
    keys = [*on, "_cx", "_cy"]
    dealt = None if points.isStreaming or sites.isStreaming else _dealt_by_pairs(points, sites, radius_m, on, lng, lat)
    if dealt is None:
        cells = site_cells(sites, radius_m, on, lng, lat)
        joined = salted_join(_with_cell(points, _site_cell_deg(radius_m)), cells, keys, "inner", growth=CELLS_PER_TARGET, **kw)
    else:
        joined = dealt
    x, y = F.col(f"target.{lng}"), F.col(f"target.{lat}")
    half = radius_m / geo.METRES_PER_DEGREE * MARGIN
    # The box, which costs less than the distance, holds the circle but near the poles.
    boxed = (F.abs(F.col("lat") - y) <= half) & (F.abs(F.col("lng") - x) * F.cos(F.radians(F.abs(y) + half)) <= half)
    joined = joined.drop("_cx", "_cy").filter(boxed | (F.abs(y) > 85))
    away = geo.distance_m("lng", "lat", f"target.{lng}", f"target.{lat}")
    return joined.withColumn("distance", away).filter(F.col("distance") < radius_m)


def _dealt_by_pairs(points: DataFrame, sites: DataFrame, radius_m: float, on: Sequence[str], lng: str, lat: str) -> DataFrame | None:
    """Points and sites of a cell, in as many tasks as their pairs are worth; None where one task may compare them all."""
    size = max(radius_m / geo.METRES_PER_DEGREE / 2, 1e-4)
    keys = [*on, "_cx", "_cy"]
    placed, cells = _with_cell(points, size), site_cells(sites, radius_m, on, lng, lat, size)
    counts = placed.groupBy(*keys).agg(F.count("*").alias("_n")).join(cells.groupBy(*keys).agg(F.count("*").alias("_m")), keys)
    counts = counts.select(*keys, (F.col("_n") * F.col("_m")).alias("_pairs"))
    pairs, most = counts.agg(F.sum("_pairs"), F.max("_pairs")).first()
    if not pairs or pairs <= TASK_PAIRS:
        return None
    tasks = max(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-pairs // TASK_PAIRS))
    salts = F.lit(1)
    if most > TASK_PAIRS:  # there are no more such cells than tasks
        hot = F.broadcast(counts.filter(F.col("_pairs") > TASK_PAIRS).select(*keys, F.ceil(F.col("_pairs") / TASK_PAIRS).alias("_salts")))
        placed, cells = placed.join(hot, keys, "left"), cells.join(hot, keys, "left")
        salts = F.coalesce("_salts", salts)
    spread = ["row_key"] if "row_key" in points.columns else points.columns
    placed = placed.withColumn("_salt", F.pmod(F.xxhash64(*spread), salts).cast("int")).drop("_salts")
    cells = cells.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts.cast("int") - 1))).drop("_salts")
    by = [*keys, "_salt"]
    return placed.repartition(tasks, *by).join(cells.repartition(tasks, *by).hint("merge"), by).drop("_salt")


def in_home_cells(points: DataFrame, sites: DataFrame, radius_m: float, on: Sequence[str] = ("dept_id",)) -> tuple[DataFrame, DataFrame]:
    """``sites`` with the one cell (``_cx``, ``_cy``) that they lie in, and a copy of each point for each cell in its reach.

    Whoever partitions the points by a key and the cell has all that a site of the cell meets of the key in one task, before
    there are any pairs. ``lng`` and ``lat`` of the sites become ``site_lng`` and ``site_lat``.
    """
    size = _site_cell_deg(radius_m)
    half = radius_m / geo.METRES_PER_DEGREE * MARGIN
    x, y = F.col("lng"), F.col("lat")
    shrink = F.greatest(F.cos(F.radians(F.least(F.abs(y) + half, F.lit(89.9)))), F.lit(1e-3))
    copies = _cells(points, x - F.lit(half) / shrink, x + F.lit(half) / shrink, y - half, y + half, size)
    homes = _with_cell(sites.filter(x.isNotNull() & y.isNotNull()), size).withColumnsRenamed({"lng": "site_lng", "lat": "site_lat"})
    return copies, homes


def lowest_sites(
    points: DataFrame, sites: DataFrame, radius_m: float, id_col: str, most: int, on: Sequence[str] = ("dept_id",),
    lng: str = "lng", lat: str = "lat", **kw,
) -> DataFrame:
    """Pairs as ``match_sites`` gives them, but for some that are not among the ``most`` lowest ids of a point (null is lowest).

    Where a cell lies wholly within reach of sites with so many different ids, sites above these are nobody's lowest and leave the
    cell, so a point meets a number of sites that does not grow with the table.
    """
    cell_deg = max(radius_m / geo.METRES_PER_DEGREE / 2, 1e-4)
    keys = [*on, "_cx", "_cy"]
    cells = site_cells(sites, radius_m, on, lng, lat, cell_deg).withColumn("_id", F.col(f"target.{id_col}"))
    xs, ys = ([F.col(c) * cell_deg, (F.col(c) + 1) * cell_deg] for c in ("_cx", "_cy"))
    away = F.greatest(*[geo.distance_m(x, y, f"target.{lng}", f"target.{lat}") for x in xs for y in ys])
    # The margin is for rounding and for cells' parallels, which are no great circles; it holds for small cells off the poles.
    sure = (away <= radius_m * 0.999) & (F.greatest(*[F.abs(y) for y in ys]) <= 85) & F.lit(cell_deg <= 1)
    rank = F.dense_rank().over(Window.partitionBy(*keys).orderBy("_id"))
    last = cells.filter(sure).select(*keys, "_id").withColumn("_rank", rank).filter(F.col("_rank") == most)
    last = last.groupBy(*keys).agg(F.max("_id").alias("_last"))
    cells = cells.join(last, keys, "left").filter(F.col("_last").isNull() | F.col("_id").isNull() | (F.col("_id") <= F.col("_last")))
    joined = salted_join(_with_cell(points, cell_deg), cells.drop("_id", "_last"), keys, "inner", **kw).drop("_cx", "_cy")
    distance = geo.distance_m("lng", "lat", f"target.{lng}", f"target.{lat}")
    return joined.withColumn("distance", distance).filter(F.col("distance") < radius_m)


def points_near_sites(d: DataFrame, sites: DataFrame, radius_m: float = 500.0, **kw) -> DataFrame:
    """Positions within ``radius_m`` of a disposal site of their department."""
    pairs = match_sites(d, sites, radius_m, **kw)
    return pairs.select(
        *[c for c in d.columns if c != "disposal_site_id"],
        F.col("target.disposal_site_id").alias("disposal_site_id"),
        F.col("distance").alias("site_distance_m"),
        F.col("target").alias("site"),
    )


def polygon_grid(
    polygons: DataFrame, ring: Column, cell_deg: float | None = None, max_broadcast: int | None = None
) -> tuple[float, int]:
    """Cell size for the polygons and the broadcast limit that goes with it, from one small aggregate.

    Unless given, the cell is a square of the polygons' mean bounding-box area: they then cover a handful of cells
    each on average, however small or large they are, and a point meets little more than the polygons around it.
    The limit is 0 (join with a salt) unless an upper bound of the cells' size fits.
    """
    boxes = polygons.select(ring.alias("_ring")).filter(F.size("_ring") >= 3)
    xs, ys = F.col("_ring.lng"), F.col("_ring.lat")
    width, height = F.array_max(xs) - F.array_min(xs), F.array_max(ys) - F.array_min(ys)
    weight = ROW_BYTES + EDGE_BYTES * F.size("_ring")
    area, n, area_bytes, rim_bytes, one_bytes = boxes.agg(
        F.sum(width * height), F.count(F.lit(1)),
        F.sum(weight * width * height), F.sum(weight * (width + height)), F.sum(weight),
    ).first()
    limit = BROADCAST_BYTES if max_broadcast is None else max_broadcast
    if not n:
        return cell_deg or DEFAULT_CELL_DEG, limit
    cell = cell_deg or min(max(math.sqrt(area / n), MIN_CELL_DEG), MAX_CELL_DEG)
    # A box touches at most (width / cell + 2) * (height / cell + 2) cells.
    size = area_bytes / cell**2 + 2 * rim_bytes / cell + 4 * one_bytes
    return cell, limit if size <= limit else 0


def polygon_cells(polygons: DataFrame, ring: Column, on: Sequence[str], cell_deg: float) -> DataFrame:
    """Polygons over the cells of their bounding box: ``on``, ``_cx``, ``_cy``, ``target``, ``box``, ``edges``.

    Each cell keeps only the edges that can lie above a point of that cell, so a long ring is split among its
    cells instead of being copied into every one.
    """
    payload = [c for c in polygons.columns if c not in on]
    shaped = polygons.select(*on, F.struct(*payload).alias("target"), ring.alias("_ring")).filter(
        F.size("_ring") >= 3
    )
    xs, ys = F.col("_ring.lng"), F.col("_ring.lat")
    placed = _cells(
        shaped.withColumn("_edges", geo.ring_edges(F.col("_ring"))),
        F.array_min(xs), F.array_max(xs), F.array_min(ys), F.array_max(ys), cell_deg,
    )
    west = F.col("_cx") * cell_deg
    south = F.col("_cy") * cell_deg
    slack = cell_deg * 1e-6

    def reachable(e: Column) -> Column:
        return (
            (F.least(e["x1"], e["x2"]) <= west + cell_deg + slack)
            & (F.greatest(e["x1"], e["x2"]) >= west - slack)
            & (F.greatest(e["y1"], e["y2"]) >= south - slack)
        )

    box = F.struct(
        F.array_min(xs).alias("west"), F.array_max(xs).alias("east"), F.array_min(ys).alias("south"),
        F.array_max(ys).alias("north"),
    )
    return placed.select(*on, "_cx", "_cy", "target", box.alias("box"), F.filter("_edges", reachable).alias("edges"))


def _contains(box: Column, edges: Column) -> Column:
    """Exact test behind a bounding-box test that needs no loop."""
    near = F.col("lng").between(box["west"], box["east"]) & F.col("lat").between(box["south"], box["north"])
    return near & geo.crosses_odd("lng", "lat", edges)


def points_in_fences(
    d: DataFrame, rules: DataFrame, cell_deg: float | None = None, max_broadcast: int | None = None
) -> DataFrame:
    """Pairs of a position and a rule of its department whose fence contains it; the rule is in ``rule``.

    Each fence is laid over cells of its own size (``covering``), unless one size is given for all.
    """
    ring = geo.parse_ring_json("coords")
    if cell_deg is None:
        inside = covering.points_in(d, covering.cover(rules, ring, ["dept_id"], max_broadcast, leave=["coords"]))
        return _with_rule(inside, d.columns)
    cell_deg, limit = polygon_grid(rules, ring, cell_deg, max_broadcast)
    cells = polygon_cells(rules, ring, ["dept_id"], cell_deg)
    joined = salted_join(_with_cell(d, cell_deg), cells, ["dept_id", "_cx", "_cy"], "inner", limit)
    return _with_rule(joined.filter(_contains(F.col("box"), F.col("edges"))), d.columns)


def _with_rule(inside: DataFrame, columns: Sequence[str]) -> DataFrame:
    return inside.select(
        *columns,
        F.col("target.condition_id").alias("condition_id"),
        F.col("target").dropFields("coords").alias("rule"),
    )


def tag_region(
    d: DataFrame,
    areas: DataFrame,
    cell_deg: float | None = None,
    max_broadcast: int | None = None,
) -> DataFrame:
    """Add ``region_id`` / ``region_name``: the lowest-numbered valid area of the department containing the point.

    A cell carries its candidate areas in id order, so every position meets one row and the join keeps all
    rows without a second shuffle, in batches and streams alike and without a key of the rows. Copies of a polygon are
    reduced to the lowest id first; a cell holds only areas whose box meets it, with their edges near it.
    """
    keys = ["dept_id", "_cx", "_cy"]
    valid = (
        areas.filter("state = 1")
        .groupBy("dept_id", "coords")
        .agg(F.min(F.struct("id", "city_name")).alias("_a"))
        .select("dept_id", "coords", "_a.id", "_a.city_name")
    )
    ring = geo.parse_ring_text("coords")
    d = d.drop("region_id", "region_name")
    if cell_deg is None:
        found = covering.first_in(
            d, covering.cover(valid, ring, ["dept_id"], max_broadcast, leave=["coords"]), lambda t: F.struct(t["id"].alias("id"), t["city_name"].alias("city_name")), "_hit"
        )
        return _with_region(found, d.columns)
    cell_deg, limit = polygon_grid(valid, ring, cell_deg, max_broadcast)
    cells = polygon_cells(valid, ring, ["dept_id"], cell_deg)
    points = _with_cell(d, cell_deg)
    candidates = cells.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("target.id", "target.city_name", "box", "edges"))).alias("_areas")
    )
    hit = F.filter("_areas", lambda a: _contains(a["box"], a["edges"]))
    joined = salted_join(points, candidates, keys, "left", limit).withColumn("_hit", F.try_element_at(hit, F.lit(1)))
    return _with_region(joined, d.columns)


def _with_region(joined: DataFrame, columns: Sequence[str]) -> DataFrame:
    return joined.select(
        *columns,
        F.col("_hit.id").cast("string").alias("region_id"),
        F.col("_hit.city_name").alias("region_name"),
    )


def near_ids(
    points: DataFrame, sites: DataFrame, radius_m: float, on: Sequence[str], id_col: str, name: str,
    lng: str = "lng", lat: str = "lat", inclusive: bool = False, **kw,
) -> DataFrame:
    """Add an array ``name`` of the ids within ``radius_m`` of each point, sorted; every point stays one row.

    A cell carries its sites as an array, which is of the order of the resulting arrays themselves. ``match_sites``
    gives the same as rows.
    """
    cells = site_cells(sites.select(*on, id_col, lng, lat), radius_m, on, lng, lat)
    cells = cells.groupBy(*on, "_cx", "_cy").agg(F.collect_list("target").alias("_near"))
    joined = salted_join(
        _with_cell(points, _site_cell_deg(radius_m)), cells, [*on, "_cx", "_cy"], "left", growth=CELLS_PER_TARGET, **kw
    )

    def within(s: Column) -> Column:
        away = geo.distance_m("lng", "lat", s[lng], s[lat])
        return away <= radius_m if inclusive else away < radius_m

    ids = F.array_distinct(F.transform(F.filter("_near", within), lambda s: s[id_col]))
    none = F.array().cast(T.ArrayType(sites.schema[id_col].dataType))
    return joined.select(*points.columns, F.coalesce(F.array_sort(ids), none).alias(name))


def route_points(permits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct route vertices: ``keys``, ``lng``, ``lat``."""
    flat = permits.select(*keys, F.explode(geo.parse_routes_json("coords")).alias("_v"))
    return flat.select(*keys, F.col("_v.lng").alias("lng"), F.col("_v.lat").alias("lat")).distinct()


def flag_off_route(
    d: DataFrame,
    permits: DataFrame,
    radius_m: float = 500.0,
    keys: Sequence[str] = ("dept_id", "vehicle_id", "permit_id"),
    cell_deg: float | None = None,
    **kw,
) -> DataFrame:
    """Add ``off_route``: no route vertex of the same ``keys`` lies within ``radius_m``.

    A cell carries the distinct vertices of one route as an array, so positions stay single rows.
    """
    cell_deg = _site_cell_deg(radius_m) if cell_deg is None else cell_deg
    cells = site_cells(route_points(permits, keys), radius_m, keys, cell_deg=cell_deg)
    cell_keys = [*keys, "_cx", "_cy"]
    points = _with_cell(d, cell_deg)
    vertices = cells.groupBy(*cell_keys).agg(F.collect_list("target").alias("_vertices"))
    joined = salted_join(points, vertices, cell_keys, "left", growth=CELLS_PER_TARGET, **kw)
    near = ~geo.off_route("lng", "lat", F.col("_vertices"), radius_m)
    joined = joined.withColumn("off_route", ~F.coalesce(near, F.lit(False)))
    return joined.select(*d.columns, "off_route")


def off_route_points(
    d: DataFrame, permits: DataFrame, radius_m: float = 500.0, cell_deg: float | None = None, **kw
) -> DataFrame:
    """Positions of permit holders from which no vertex of any permitted route is within reach."""
    keys = ["dept_id", "vehicle_id"]
    holders = salted_join(d, permits.select(*keys).distinct(), keys, "left_semi", **kw)
    return flag_off_route(holders, permits, radius_m, keys, cell_deg, **kw).filter("off_route").drop("off_route")

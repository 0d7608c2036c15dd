"""Polygons laid over grid cells of several sizes, each polygon over cells of its own size.

Cells of level k are squares of FINEST_DEG * 4**k degrees. A polygon takes the level at which its box spans at most SPAN cells
either way, whatever the sizes of the others, so it has at most (SPAN + 1) ** 2 cells. A cell that no edge touches lies wholly
inside, and its points need no further test, or wholly outside, and is left out. A cell with more than FEW_EDGES edges is cut
once into 16 of the level below. A point has one cell at each level in use, of which there are twelve at most.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulwatch.functions import geo
from haulwatch.operators.lookups import BROADCAST_BYTES, salted_join

FINEST_DEG, TOP_LEVEL, SPAN, FEW_EDGES = 1e-4, 11, 8, 16
#: Bytes of a cell without edges, and of an edge.
CELL_BYTES, EDGE_BYTES = 256, 48
#: Pairs of a cell and an edge that are judged at once, and cells with their edges that are handed on at once.
BLOCK, ROWS = 1 << 20, 1 << 16
#: Edges that a cell may have to be tested one by one, without a loop over an array.
UNROLLED = 4
EDGE = "x1", "y1", "x2", "y2"


class Covering(NamedTuple):
    """Cells (keys, ``_level``, ``_cx``, ``_cy``, ``target``, ``edges``; no edges: wholly inside), the levels in use, the
    broadcast limit that goes with their measured size (0: too large), that size, and how many cells have more edges than ``UNROLLED``."""

    cells: DataFrame
    keys: list[str]
    levels: list[int]
    limit: int
    size: int
    crowded: int


def _size(level: Column) -> Column:
    return F.lit(FINEST_DEG) * F.pow(F.lit(4.0), level)


class Rings(NamedTuple):
    """Closed rings: where the edges of each begin, how many there are, and their ends."""

    begin: np.ndarray
    count: np.ndarray
    x1: np.ndarray
    y1: np.ndarray
    x2: np.ndarray
    y2: np.ndarray


class Cells(NamedTuple):
    ring: np.ndarray
    level: np.ndarray
    cx: np.ndarray
    cy: np.ndarray

    def some(self, which: np.ndarray | slice) -> Cells:
        return Cells(*(c[which] for c in self))


def _spread(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Indexes of runs one after another, from where each begins and how long it is."""
    return np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


def _rings(column: pa.ListArray) -> Rings:
    count = column.value_lengths().fill_null(0).to_numpy()
    begin = np.cumsum(count) - count
    vertices = column.flatten()
    x, y = (vertices.field(c).cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False) for c in ("lng", "lat"))
    x, y = (np.where(np.isfinite(v), v, np.nan) for v in (x, y))
    following = np.arange(1, len(x) + 1)
    following[(begin + count - 1)[count > 0]] = begin[count > 0]
    return Rings(begin, count, x, y, x[following], y[following])


def _first_cells(rings: Rings) -> Iterator[Cells]:
    """The cells of each ring's box, at the ring's level; rings without a place have none."""
    known = np.flatnonzero(rings.count > 0)
    if not len(known):
        return
    least, most = (np.array([f.reduceat(v, rings.begin[known]) for v in (rings.x1, rings.y1)]) for f in (np.fmin, np.fmax))
    known, least, most = (v[..., np.isfinite(least).all(axis=0) & np.isfinite(most).all(axis=0)] for v in (known, least, most))
    extent = np.maximum((most - least).max(axis=0, initial=0.0), FINEST_DEG)
    level = np.clip(np.ceil(np.log(extent / (SPAN * FINEST_DEG)) / np.log(4.0) - 1e-9), 0, TOP_LEVEL).astype(np.int64)
    size = FINEST_DEG * 4.0**level
    low, high = (np.floor(v / size).astype(np.int64) for v in (least, most))
    wide, tall = high - low + 1
    ends = np.cumsum(wide * tall)
    a = 0
    while a < len(known):  # some rings at once, but one at least
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + BLOCK, "right")))
        n = (wide * tall)[a:b]
        of = np.repeat(np.arange(a, b), n)
        place = _spread(np.zeros(b - a, np.int64), n)
        yield Cells(known[of], level[of], low[0][of] + place // tall[of], low[1][of] + place % tall[of])
        a = b


def _judged(cells: Cells, rings: Rings) -> Iterator[tuple[Cells, np.ndarray, np.ndarray, np.ndarray]]:
    """Some cells at a time: those that an edge touches or that lie wholly inside; whether touched; and for touched ones the number of the
    edges that matter to their points, and these edges one after another."""
    ends = np.cumsum(rings.count[cells.ring])
    a = 0
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + BLOCK, "right")))
        here = cells.some(slice(a, b))
        a = b
        count = rings.count[here.ring]
        first = np.cumsum(count) - count
        edge = _spread(rings.begin[here.ring], count)
        x1, y1, x2, y2 = (v[edge] for v in rings[2:])
        size = FINEST_DEG * 4.0**here.level
        slack = size * 1e-6
        every = lambda v: np.repeat(v, count)  # noqa: B023, E731
        west, south = every(here.cx * size - slack), every(here.cy * size - slack)
        east, north = every(here.cx * size + size + slack), every(here.cy * size + size + slack)
        left, right, low, high = np.minimum(x1, x2), np.maximum(x1, x2), np.minimum(y1, y2), np.maximum(y1, y2)
        across = (left <= east) & (right >= west) & (high >= south)
        # An edge touches a cell if their boxes meet and the cell's corners are not all on one side of the edge's line.
        near = np.flatnonzero(across & (low <= north))
        dx, dy = x2[near] - x1[near], y2[near] - y1[near]
        sides = [dx * (v[near] - y1[near]) - dy * (u[near] - x1[near]) for u in (west, east) for v in (south, north)]
        touching = np.zeros(len(edge), bool)
        touching[near] = (np.minimum.reduce(sides) <= 0) & (np.maximum.reduce(sides) >= 0)
        touched = np.logical_or.reduceat(touching, first)
        x, y = every((here.cx + 0.5) * size), every((here.cy + 0.5) * size)
        over = np.flatnonzero((x1 > x) != (x2 > x))
        height = (y2[over] - y1[over]) * (x[over] - x1[over]) / (x2[over] - x1[over]) + y1[over]
        crossed = np.zeros(len(edge), np.int64)
        crossed[over] = y[over] < height
        inside = np.add.reduceat(crossed, first) % 2 == 1
        # An edge that a line upwards from a point of the cell can cross.
        above = across & (x1 != x2) & np.repeat(touched, count)
        kept = touched | inside
        yield here.some(kept), touched[kept], np.add.reduceat(above.astype(np.int64), first)[kept], edge[above]


def _covered(rings: Rings) -> Iterator[tuple[Cells, np.ndarray, np.ndarray, np.ndarray]]:
    """``_judged`` cells, those with many edges cut once into 16 of the level below."""
    for first in _first_cells(rings):
        for cells, touched, n, edges in _judged(first, rings):
            cut = touched & (n > FEW_EDGES) & (cells.level > 0)
            yield cells.some(~cut), touched[~cut], n[~cut], edges[np.repeat(~cut, n)]
            if cut.any():
                large = cells.some(cut)
                x, y = np.repeat(np.arange(4), 4), np.tile(np.arange(4), 4)
                each = lambda v, k: (4 * v[:, None] + k).ravel()
                yield from _judged(Cells(np.repeat(large.ring, 16), np.repeat(large.level - 1, 16), each(large.cx, x), each(large.cy, y)), rings)


def cells_of_task(batches: Iterator[pa.RecordBatch], on: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Cells of the polygons of a task, a bounded number at a time."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rings = _rings(batch["_ring"])
        for cells, touched, n, edges in _covered(rings):
            offsets = np.concatenate(([0], np.cumsum(n)))
            a = 0
            while a < len(n):
                b = max(a + 1, min(a + ROWS, int(np.searchsorted(offsets, offsets[a] + 8 * ROWS, "right")) - 1))
                of = edges[offsets[a] : offsets[b]]
                values = pa.StructArray.from_arrays([pa.array(v[of]) for v in rings[2:]], names=EDGE)
                starts = pa.array((offsets[a : b + 1] - offsets[a]).astype(np.int32))
                lists = pa.ListArray.from_arrays(starts, values, mask=pa.array(~touched[a:b]))
                ring = pa.array(cells.ring[a:b])
                placed = [pa.array(cells.level[a:b].astype(np.int32)), pa.array(cells.cx[a:b]), pa.array(cells.cy[a:b])]
                columns = [*(batch[c].take(ring) for c in on), *placed, batch["target"].take(ring), lists]
                yield pa.RecordBatch.from_arrays(columns, [*on, "_level", "_cx", "_cy", "target", "edges"])
                a = b


def cover(polygons: DataFrame, ring: Column, on: Sequence[str], max_broadcast: int | None = None, leave: Sequence[str] = ()) -> Covering:
    """Polygons over cells; one aggregate over the cells tells the levels in use and the size. ``target`` has the other columns but for
    those to ``leave``."""
    payload = [c for c in polygons.columns if c not in on and c not in leave]
    # A table of very many polygons may be one file, and their texts and cells are the work.
    session = polygons.sparkSession
    polygons = polygons.repartition(min(int(session.conf.get("spark.sql.shuffle.partitions")), 2 * session.sparkContext.defaultParallelism))
    shaped = polygons.select(*on, F.struct(*payload).alias("target"), ring.alias("_ring")).filter(F.size("_ring") >= 3)
    on = list(on)
    fields = [*(shaped.schema[c] for c in on), T.StructField("_level", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in ("_cx", "_cy"))]
    edges = T.ArrayType(T.StructType([T.StructField(c, T.DoubleType()) for c in EDGE]))
    fields += [shaped.schema["target"], T.StructField("edges", edges)]
    cells = shaped.mapInArrow(lambda batches: cells_of_task(batches, on), T.StructType(fields))
    count = F.coalesce(F.size("edges"), F.lit(0))
    n, n_edges, levels, crowded = cells.agg(F.count("*"), F.sum(count), F.collect_set("_level"), F.count_if(count > UNROLLED)).first()
    limit = BROADCAST_BYTES if max_broadcast is None else max_broadcast
    size = n * CELL_BYTES + (n_edges or 0) * EDGE_BYTES
    return Covering(cells, on, sorted(levels), limit if size <= limit else 0, size, crowded)


def _at(points: DataFrame, level: Column) -> DataFrame:
    size = _size(F.col("_level"))
    return points.withColumn("_level", level).withColumns({"_cx": F.floor(F.col("lng") / size), "_cy": F.floor(F.col("lat") / size)})


def _contains(edges: Column) -> Column:
    return edges.isNull() | F.coalesce(geo.crosses_odd("lng", "lat", edges), F.lit(False))


def points_in(points: DataFrame, covering: Covering) -> DataFrame:
    """Pairs of a point and a polygon of its keys that contains it: the point's columns and ``target``.

    Most cells have few edges. Their edges are columns, so that the test is compiled with the join; cells with more meet the points in a
    join of their own, where there are any. Streams have one join with all.
    """
    levels = F.explode(F.array(*map(F.lit, covering.levels)) if covering.levels else F.array().cast("array<int>"))
    placed, keys = _at(points, levels), [*covering.keys, "_level", "_cx", "_cy"]

    def joined(cells: DataFrame) -> DataFrame:
        return salted_join(placed, cells, keys, "inner", covering.limit, size=covering.size)

    def looped(cells: DataFrame) -> DataFrame:
        return joined(cells).filter(_contains(F.col("edges"))).select(*points.columns, "target")

    if points.isStreaming:
        return looped(covering.cells)
    crowded = F.coalesce(F.size("edges") > UNROLLED, F.lit(False))
    # An edge that is not there is never crossed: both ends lie right of any point.
    ends = [[F.coalesce(F.get("edges", F.lit(i))[c], F.lit(math.inf if c[0] == "x" else 0.0)).alias(f"_{c}_{i}") for c in EDGE] for i in range(UNROLLED)]
    few = covering.cells.filter(~crowded).select(*keys, "target", F.col("edges").isNull().alias("_whole"), *[e for edge in ends for e in edge])
    crossed = [F.when(geo.crosses("lng", "lat", {c: F.col(f"_{c}_{i}") for c in EDGE}), 1).otherwise(0) for i in range(UNROLLED)]
    inside = joined(few).filter(F.col("_whole") | (sum(crossed[1:], crossed[0]) % 2 == 1)).select(*points.columns, "target")
    return inside.unionByName(looped(covering.cells.filter(crowded))) if covering.crowded else inside


def first_in(points: DataFrame, covering: Covering, rank: Callable[[Column], Column], name: str) -> DataFrame:
    """Each point once, with the least ``rank`` of the polygons that contain it in ``name``, by one join for each level: a cell carries
    its polygons as an array, so no point multiplies."""
    keys = [*covering.keys, "_level", "_cx", "_cy"]
    held = covering.cells.select(*keys, F.struct(rank(F.col("target")).alias("rank"), F.col("edges").isNull().alias("whole"), "edges").alias("area"))
    held = held.groupBy(*keys).agg(F.collect_list("area").alias("_areas"))
    columns, found = points.columns, []
    for k in covering.levels:
        points = salted_join(_at(points, F.lit(k)), held.filter(F.col("_level") == k), keys, "left", covering.limit, size=covering.size)
        hit = F.filter("_areas", lambda a: a["whole"] | _contains(a["edges"]))
        points = points.withColumn(f"_found_{k}", F.array_min(F.transform(hit, lambda a: a["rank"]))).drop("_areas", "_level", "_cx", "_cy")
        found.append(f"_found_{k}")
    if not found:  # no polygon at all
        return points.withColumn(name, F.lit(None).cast(covering.cells.select(rank(F.col("target"))).schema[0].dataType))
    return points.select(*columns, F.array_min(F.array(*found)).alias(name))

"""Polygons of very different sizes over cells of their own size."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from haulwatch.functions import geo
from haulwatch.operators import covering, spatial

RULES = "dept_id int, condition_id int, coords string"


def star(rng, x, y, size, corners):
    turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(corners))
    return [[x + size * rng.uniform(0.3, 1) * math.cos(t), y + size * rng.uniform(0.3, 1) * math.sin(t)] for t in turns]


def fences(seed, sizes=(1e-4, 3e-4, 2e-3, 0.02, 0.4, 6.0, 20.0)):
    rng, rows = random.Random(seed), []
    for k in range(60):
        size = rng.choice(sizes)
        ring = star(rng, 113 + rng.uniform(-0.05, 0.05), 34.7 + rng.uniform(-0.05, 0.05), size, rng.choice([3, 4, 9, 80]))
        rows.append((1 + k % 2, k, str(ring)))
    square = [[113.0, 34.7], [113.0, 34.8], [113.1, 34.8], [113.1, 34.7]]  # with vertical edges
    return [*rows, (1, 90, str(square)), (1, 91, str([[1, 2], [3, 4]])), (2, 92, None), (1, 93, "[]")]


def spots(seed, n=1500):
    rng = random.Random(seed)
    near = [(k, 1 + k % 2, 113 + rng.uniform(-0.06, 0.06), 34.7 + rng.uniform(-0.06, 0.06)) for k in range(n)]
    far = [(n + k, 1 + k % 2, 113 + rng.uniform(-25, 25), 34.7 + rng.uniform(-25, 25)) for k in range(n // 3)]
    return [*near, *far, (9001, 1, None, 34.7), (9002, 1, -113.05, -34.71), (9003, 1, 113.05, None)]


@pytest.mark.parametrize("limit", [None, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_test_of_all_pairs(spark, seed, limit):
    points = spark.createDataFrame(spots(seed), "row_key bigint, dept_id int, lng double, lat double")
    rules = spark.createDataFrame(fences(seed), RULES)
    got = spatial.points_in_fences(points, rules, max_broadcast=limit).select("row_key", "condition_id").collect()
    pairs = points.join(rules, "dept_id").filter(geo.in_polygon("lng", "lat", geo.parse_ring_json("coords")))
    want = pairs.select("row_key", "condition_id").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(want) > 3000


def test_lowest_region_of_mixed_sizes(spark):
    points = spark.createDataFrame(spots(3), "row_key bigint, dept_id int, lng double, lat double")
    rows = [(d, k, f"city {k}", c.replace("], [", ";").replace("[", "").replace("]", "") if c else c, 1) for d, k, c in fences(3)]
    areas = spark.createDataFrame(rows, "dept_id int, id int, city_name string, coords string, state int")
    inside = points.join(areas, "dept_id").filter(geo.in_polygon("lng", "lat", geo.parse_ring_text("coords")))
    want = {r.row_key: str(r.id) for r in inside.groupBy("row_key").agg(F.min("id").alias("id")).collect()}
    for limit in (None, 0):
        got = spatial.tag_region(points, areas, max_broadcast=limit).collect()
        assert {r.row_key: r.region_id for r in got if r.region_id} == want and len(got) == points.count()
    none = spatial.tag_region(points, areas.filter("false"))
    assert none.filter("region_id is not null or region_name is not null").count() == 0 and none.count() == points.count()


def test_cells_are_bounded_and_inner_ones_have_no_edges(spark):
    rng = random.Random(5)
    rows = [(1, k, str(star(rng, 113, 34.7, size, 400))) for k, size in enumerate((1e-4, 1e-3, 0.1, 2.0, 30.0))]
    made = covering.cover(spark.createDataFrame(rows, RULES), geo.parse_ring_json("coords"), ["dept_id"])
    cells = made.cells.select("target.condition_id", "_level", F.size("edges").alias("n"), F.col("edges").isNull().alias("whole")).collect()
    most = (covering.SPAN + 1) ** 2 * 16
    for k in range(5):
        mine = [c for c in cells if c.condition_id == k]
        assert 0 < len(mine) <= most and (len({c._level for c in mine}) <= 2)
        assert k == 0 or any(c.whole for c in mine)
    assert len(made.levels) <= covering.TOP_LEVEL + 1 and made.limit > 0
    none = spark.createDataFrame([], RULES)
    points = spark.createDataFrame(spots(1, 9), "row_key bigint, dept_id int, lng double, lat double")
    assert spatial.points_in_fences(points, none).count() == 0

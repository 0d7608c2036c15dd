"""Cells of polygons are judged in arrays, and points are tested against few edges without a loop."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F
from test_covering import RULES, fences, spots
from test_crowds import executed

from haulwatch.functions import geo
from haulwatch.operators import covering, spatial

POINTS = "row_key bigint, dept_id int, lng double, lat double"
ODD = [
    (1, 200, "[[113.0,34.7],[113.0,34.7],[113.05,34.75],[113.1,34.7],[113.1,34.7]]"),  # vertices that come twice
    (1, 201, "[[113.0,34.7],[null,34.72],[113.05,34.75],[113.1,34.7]]"), (1, 202, "[[null,null],[null,null],[null,null]]"),
    (1, 203, "[[113.0,34.7],[113.0,34.7],[113.0,34.7]]"), (2, 204, "[[113.0,34.7],[113.05,34.75],[113.1,34.7],[113.05,34.75]]"),
    (None, 205, "[[113.0,34.6],[113.05,34.9],[113.1,34.6]]"), (2, None, "[[113.0,34.6],[113.05,34.9],[113.1,34.6]]"),
]


def test_odd_rings_equal_test_of_all_pairs(spark):
    points = spark.createDataFrame(spots(4, 600), POINTS)
    for rows in (ODD, [*fences(4), *ODD]):  # few edges only, and cells with many, too
        rules = spark.createDataFrame([r for r in rows if r[1] != 201], RULES)  # an open line has no inside
        got = spatial.points_in_fences(points, rules).select("row_key", "condition_id").collect()
        want = points.join(rules, "dept_id").filter(geo.in_polygon("lng", "lat", geo.parse_ring_json("coords"))).select("row_key", "condition_id").collect()
        assert sorted(map(str, got)) == sorted(map(str, want)) and len(want) > 100


def test_few_edges_are_tested_without_a_loop(spark):
    points, ring = spark.createDataFrame(spots(4, 20), POINTS), geo.parse_ring_json("coords")
    made = covering.cover(spark.createDataFrame(ODD, RULES), ring, ["dept_id"])
    assert made.crowded == 0 and "lambda" not in executed(covering.points_in(points, made)).split("MapInArrow")[0]
    assert covering.cover(spark.createDataFrame(fences(4), RULES), ring, ["dept_id"]).crowded > 0


def test_cells_do_not_depend_on_blocks(spark, monkeypatch):
    rules = spark.createDataFrame([*fences(6), *ODD], RULES).withColumn("_ring", geo.parse_ring_json("coords")).filter(F.size("_ring") >= 3)
    table = rules.select("dept_id", F.struct("condition_id").alias("target"), "_ring").coalesce(1).toArrow()
    made = []
    for block, rows, size in ((1 << 20, 1 << 16, 10_000), (50, 3, 4), (1, 1, 1)):
        monkeypatch.setattr(covering, "BLOCK", block)
        monkeypatch.setattr(covering, "ROWS", rows)
        cells = pa.Table.from_batches([*covering.cells_of_task(iter(table.to_batches(max_chunksize=size)), ["dept_id"])])
        made.append(sorted(map(str, cells.to_pylist())))
    assert made[0] == made[1] == made[2] and len(made[0]) > 500

"""Site visits found in arrays: the same as by rows, however reports and sites are shared out and cut into blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from conftest import frame, random_positions
from pyspark.sql import functions as F
from test_crowds import SITE, crowded_sites, executed

from haulwatch.functions import geo
from haulwatch.operators import visits
from haulwatch.plans import vehicles


def odd_reports(spark):
    """Reports of a file with some twice, and some without time, key, place or department."""
    points = frame(spark, random_positions(8, vehicles=4, reports=100, hot=60))
    other = points.filter("row_key % 29 = 3").withColumn("row_key", F.col("row_key") + 10000)
    later = F.col("time") + F.expr("interval 7 seconds")
    odd = [
        points.filter("row_key % 31 = 5"), other.withColumn("time", F.lit(None).cast("timestamp")).limit(1), other.withColumn("time", later).withColumn("row_key", F.lit(None).cast("bigint")),
        other.withColumn("lat", F.lit(None).cast("double")), other.withColumn("dept_id", F.lit(None).cast("int")),
    ]
    for rows in odd:
        points = points.unionByName(rows)
    return points


def odd_sites(spark):
    rows = [(7, "again", 2, 113.0061, 34.7051), (None, "none", 1, 113.0, 34.7), (8, "no department", None, 113.0, 34.7), (9, "nowhere", 1, None, 34.7)]
    sites = crowded_sites(spark, 60).filter("disposal_site_id <> 7").union(spark.createDataFrame([(7, "first", 2, 113.006, 34.705), *rows], SITE))
    return sites.unionByName(sites.filter("disposal_site_id % 10 = 4"))


def found(points, sites, **kw):
    out = vehicles.site_visits(points, sites, 800.0, 60, time=lambda s: s, **kw)
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("target, limit", [(None, None), (90, 0)])
def test_shares_of_cells_make_no_difference(spark, monkeypatch, target, limit):
    points, sites = odd_reports(spark), odd_sites(spark)
    some = []
    for pairs in (10**9, 400):  # one share; shares by vehicle and by site
        monkeypatch.setattr(visits, "TASK_PAIRS", pairs)
        some.append(found(points, sites, target_rows=target, max_broadcast=limit))
    monkeypatch.setattr(vehicles, "_fit_for_homes", lambda *_: None)
    by_rows = found(points, sites, target_rows=None)
    assert some[0] == some[1] == by_rows and len(by_rows) > 100


def test_pairs_are_no_rows(spark):
    plan = executed(vehicles.site_visits(odd_reports(spark), odd_sites(spark), 800.0, 60))
    assert "Generate" in plan and not [line for line in plan.splitlines() if "Window" in line and "disposal_site_id" in line]


def test_blocks_make_no_difference(spark, monkeypatch):
    points, sites = odd_reports(spark), odd_sites(spark)
    want = found(points, sites)
    monkeypatch.setattr(type(points), "mapInArrow", lambda self, work, schema: self)
    dealt = vehicles.site_visits(points, sites, 800.0, 60, time=lambda s: s).coalesce(1).toArrow()
    for block, reports, rows in ((1 << 18, 256, 10_000), (40, 5, 7), (1, 1, 1)):
        monkeypatch.setattr(visits, "BLOCK", block)
        monkeypatch.setattr(visits, "BLOCK_REPORTS", reports)
        made = [*visits.visits_of_task(iter(dealt.to_batches(max_chunksize=rows)), 800.0, 60)]
        got = pa.Table.from_batches(made).to_pylist()
        assert sorted((tuple(r.values()) for r in got), key=str) == want


def test_time_is_made_of_reports(spark):
    points, sites = odd_reports(spark), odd_sites(spark)
    text = lambda s: F.date_format(F.timestamp_seconds(s), "yyyy-MM-dd HH:mm:ss")
    got = vehicles.site_visits(points, sites, 800.0, 60, time=text)
    want = vehicles.site_visits(points, sites, 800.0, 60)
    assert dict(want.dtypes)["enter_time"] == "timestamp"
    want = want.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("enter_time", "exit_time")})
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("radius", [0.05, 800.0, 60_000.0, 30_000_000.0])
def test_nearness_is_that_of_the_distance(spark, radius):
    rng = np.random.default_rng(3)
    spread = min(2 * radius / geo.METRES_PER_DEGREE, 80)
    lng, lat = 113 + rng.uniform(-spread, spread, 60), 5 + rng.uniform(-spread, spread, 60)
    rows = pa.table({c: pa.array([0] * 40) for c in visits.GROUP} | {"disposal_site_id": pa.array(range(40)), "lng": lng[:40], "lat": lat[:40]})
    zero = np.zeros(20, np.int64)
    reports = visits.Reports(zero, lng[40:], lat[40:], visits.on_sphere(lng[40:], lat[40:]), *[zero] * 7)
    near = np.concatenate([inside for _, inside in visits.Places(rows).blocks(reports, radius)])
    pairs = [(float(lng[i]), float(lat[i]), float(lng[40 + j]), float(lat[40 + j])) for i in range(40) for j in range(20)]
    away = spark.createDataFrame(pairs, "a double, b double, x double, y double").coalesce(1).select(geo.distance_m("x", "y", "a", "b").alias("m"))
    assert near.ravel().tolist() == [r.m < radius for r in away.collect()] and (near.any() or radius < 1)

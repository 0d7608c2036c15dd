"""Work and copies that must not grow faster than the tables: crowded sites, large dimensions, many polygons in one file."""

from __future__ import annotations

import random
import re

from conftest import S, frame, random_positions
from pyspark.sql import functions as F

from haulwatch.functions import geo
from haulwatch.operators import covering, lookups, spatial
from haulwatch.plans import alarms, vehicles

SITE = "disposal_site_id bigint, disposal_site_name string, dept_id int, lng double, lat double"


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def crowded_sites(spark, n=400, seed=5):
    rng = random.Random(seed)
    rows = [(i, f"site {i}", 1 + i % 2, 113.0 + rng.uniform(-0.01, 0.04), 34.7 + rng.uniform(-0.01, 0.02)) for i in range(n)]
    return spark.createDataFrame(rows, SITE)


def test_copies_of_a_dimension_are_not_broadcast_by_their_estimate(spark):
    facts = spark.range(500).select(F.col("id").alias("row_key"), (F.col("id") % 20).alias("k"))
    dim = spark.range(12).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert "Broadcast" not in executed(lookups.salted_join(facts, dim, ["k"], how, max_broadcast=0))


def test_compressed_dimension_is_measured(spark, tmp_path):
    spark.range(40000).select("id", F.repeat(F.md5(F.col("id").cast("string")), 6).alias("text")).coalesce(1).write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim")).select("id", F.concat("text", "text").alias("twice"))
    assert lookups.measured_bytes(dim) > 15 << 20
    wide = dim.select("id", *[F.col("twice").alias(f"c{i}") for i in range(6)])
    assert lookups.fits(wide, 200 << 20) and not lookups.fits(wide, 8 << 20)


def test_large_dimension_is_copied_less(spark, monkeypatch):
    facts = spark.range(500).select(F.col("id").alias("row_key"), (F.col("id") % 20).alias("k"))
    dim = spark.range(12).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    want = sorted(map(tuple, facts.join(dim, "k").collect()))

    def copies(limit):
        monkeypatch.setattr(lookups, "COPIES_BYTES", limit)
        out = lookups.salted_join(facts, dim, ["k"], "inner", max_broadcast=0, size=1000)
        assert sorted(map(tuple, out.collect())) == want
        return int(re.search(r"sequence\(0, (\d+)", out._jdf.queryExecution().analyzed().toString()).group(1))

    assert copies(512 << 20) == lookups.SALTS - 1 and copies(900) == 0


def test_lowest_sites_are_those_of_all_pairs(spark):
    points = frame(spark, random_positions(3, vehicles=4, reports=60))
    sites = crowded_sites(spark).union(spark.createDataFrame([(None, "none", 1, 113.0, 34.7), (7, "again", 2, 113.006, 34.705)], SITE))
    site = F.col("target.disposal_site_id")
    pairs = spatial.match_sites(points, sites, 1500.0).select("row_key", site.alias("id")).distinct().collect()
    some = spatial.lowest_sites(points, sites, 1500.0, "disposal_site_id", 3).select("row_key", site.alias("id")).collect()
    order = lambda i: (i is not None, i or 0)

    def lowest(rows):
        of = {}
        for r in rows:
            of.setdefault(r.row_key, set()).add(r.id)
        return {k: sorted(ids, key=order)[:3] for k, ids in of.items()}

    assert lowest(pairs) == lowest(some) and len(some) < len(pairs) / 3


def test_illegal_disposal_meets_few_of_crowded_sites(spark):
    points = frame(spark, random_positions(4, vehicles=4, reports=60))
    sites = crowded_sites(spark)
    permits = spark.createDataFrame([(1 + v % 2, v, i) for v in (1, 2, 3) for i in (0, 1, 2, 5 + v)], "dept_id int, vehicle_id int, disposal_site_id bigint")
    for match in ("not_permitted", "any_other"):
        full = alarms.illegal_site_visits(points, permits, sites, 1500.0, match)
        few = alarms.illegal_site_visits(points, permits, sites, 1500.0, match, lowest=True)
        least = lambda df: sorted(map(tuple, df.groupBy("row_key").agg(F.min("disposal_site_id")).collect()))
        assert least(full) == least(few) and few.count() < full.count() / 3


def visits_of(df):
    return sorted((r.dept_id, r.vehicle_id, r.disposal_site_id, r.enter_time, r.exit_time) for r in df.collect())


def test_pairs_of_site_visits_are_not_shuffled(spark, tmp_path):
    points = frame(spark, random_positions(6, vehicles=4, reports=100))
    crowded_sites(spark).write.parquet(str(tmp_path / "sites"))  # a file has a size, by which it is broadcast
    sites = spark.read.parquet(str(tmp_path / "sites"))
    for sliced in (None, 80):
        plan = executed(vehicles.site_visits(points, sites, 100.0, 60, target_rows=sliced))
        assert not [line for line in plan.splitlines() if "hashpartitioning" in line and "disposal_site_id" in line.split("hashpartitioning")[1]]


def test_site_visits_by_home_cells_equal_the_rest(spark, monkeypatch):
    points = frame(spark, random_positions(7, vehicles=4, reports=100))
    sites = crowded_sites(spark, 60)
    some = [visits_of(vehicles.site_visits(points, sites, 800.0, 60, target_rows=n)) for n in (None, 60)]
    monkeypatch.setattr(vehicles, "_fit_for_homes", lambda *_: False)
    assert some == [visits_of(vehicles.site_visits(points, sites, 800.0, 60, target_rows=None))] * 2 and some[0]


def test_site_with_two_places_keeps_one_visit(spark):
    rows = [(i, 1, 1, S + 30 * i, 113.0 + (0.1 if i % 2 else 0.0) if i < 20 else 114.0, 34.7, 0.0, "1", "1") for i in range(40)]
    points = spark.createDataFrame(rows, "row_key bigint, dept_id int, vehicle_id int, t bigint, lng double, lat double, speed double, audit_state string, manage_state string")
    points = points.withColumn("time", F.timestamp_seconds("t")).drop("t")
    sites = spark.createDataFrame([(1, "a", 1, 113.0, 34.7), (1, "b", 1, 113.1, 34.7)], SITE)
    assert len(visits_of(vehicles.site_visits(points, sites, 500.0, 180))) == 1


def test_many_polygons_in_one_file_are_covered_by_many_tasks(spark):
    rows = [(1, i, f"[[{x},34.7],[{x + 0.001},34.701],[{x + 0.002},34.7]]") for i in range(50) for x in (113 + i / 1000,)]
    rules = spark.createDataFrame(rows, "dept_id int, condition_id int, coords string").coalesce(1)
    cover = covering.cover(rules, spatial.geo.parse_ring_json("coords"), ["dept_id"])
    assert cover.cells.rdd.getNumPartitions() > 1 and cover.size > 0


def test_pairs_near_sites_are_dealt_by_their_number(spark, monkeypatch):
    points = frame(spark, random_positions(4, vehicles=4, reports=60)).coalesce(1)
    one = points.limit(1)
    points = points.union(one).union(one.withColumn("dept_id", F.lit(None).cast("int"))).union(one.withColumn("lat", F.lit(None).cast("double"))).coalesce(1)
    odd = [(None, "none", 1, 113.0, 34.7), (7, "again", 2, 113.006, 34.705), (8, None, None, 113.0, 34.7), (9, "nowhere", 1, None, 34.7), (10, "north", 1, 113.0, 89.99)]
    sites = crowded_sites(spark, n=150).union(spark.createDataFrame(odd, SITE)).coalesce(1)
    named = sites.select("dept_id", *[F.col(c).alias(f"s_{c}") for c in ("disposal_site_id", "disposal_site_name", "lng", "lat")])
    away = geo.distance_m("lng", "lat", "s_lng", "s_lat")
    every = points.join(named, "dept_id").withColumn("m", away).filter("m < 1500").select("row_key", "s_disposal_site_id", "s_disposal_site_name", "m")
    want = sorted(map(str, every.collect()))
    found = []
    for task_pairs in (10**9, 1000, 50):  # in one task; dealt by cells; and cells over several tasks, too
        monkeypatch.setattr(spatial, "TASK_PAIRS", task_pairs, raising=False)
        near = spatial.match_sites(points, sites, 1500.0)
        assert near.columns == ["dept_id", *[c for c in points.columns if c != "dept_id"], "target", "distance"]
        found.append(near.rdd.getNumPartitions())
        got = near.select("row_key", F.col("target.disposal_site_id").alias("s_disposal_site_id"), F.col("target.disposal_site_name").alias("s_disposal_site_name"), F.col("distance").alias("m"))
        assert sorted(map(str, got.collect())) == want
    assert len(want) > 1000 and found[0] == 1 and found[1] >= len(want) / 1000 and found[2] >= len(want) / 50

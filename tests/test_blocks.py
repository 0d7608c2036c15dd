"""Building blocks at their boundaries and against plain loops."""

from __future__ import annotations

import random

import pytest
from conftest import S, track
from pyspark.sql import functions as F

from haulwatch.operators import blocks
from haulwatch.operators.lookups import lookup, one_per_key, salted_join
from haulwatch.operators.sequence import VEHICLE, ordered_scan, prepare


def candidates(spark, times, key=1):
    rows = [(key, t, i) for i, t in enumerate(times)]
    return spark.createDataFrame(rows, "k int, epoch_s bigint, row_key bigint")


def greedy(times, seconds):
    out = []
    for t in sorted(times):
        if not out or t - out[-1] > seconds:
            out.append(t)
    return out


@pytest.mark.parametrize("times, n", [([S, S + 7200], 1), ([S, S + 7201], 2), ([S, S], 1)])
def test_cooldown_boundary(spark, times, n):
    assert blocks.cooldown(candidates(spark, times), ["k"], 7200).count() == n


@pytest.mark.parametrize("seed", range(4))
def test_cooldown_over_many_slices(spark, seed):
    """Chains run through dense slices, past empty ones, and across slice borders."""
    rng = random.Random(seed)
    seconds = rng.choice([1, 7, 13])
    rows, want = [], set()
    for key in range(6):
        t, times = S + rng.randrange(1000), []
        for _ in range(600):
            t += rng.choice([0, 1, 1, 2, 3]) if key < 4 else rng.choice([1, 5, 30, 400])
            times.append(t)
        rows += [(key, t) for t in times]
        want |= {(key, t) for t in greedy(times, seconds)}
    rng.shuffle(rows)
    df = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(rows)], "k int, epoch_s bigint, row_key bigint")
    fired = blocks.cooldown(df, ["k"], seconds, slice_s=1).collect()
    assert {(r.k, r.epoch_s) for r in fired} == want and len(fired) == len(want)
    lowest = {}
    for i, kt in enumerate(rows):
        lowest.setdefault(kt, i)
    assert all(r.row_key == lowest[(r.k, r.epoch_s)] for r in fired)


def test_cooldown_of_a_vehicle_week_with_wide_rows(spark):
    """One report a second for a week, 40 text columns: only the times of a key are gathered."""
    n = 7 * 86400
    wide = {f"c{i}": F.concat(F.lit(f"column {i} of "), F.col("id").cast("string")) for i in range(40)}
    df = spark.range(n).select(F.lit(1).alias("k"), (F.col("id") + S).alias("epoch_s"), F.col("id").alias("row_key"), *[c.alias(x) for x, c in wide.items()])
    fired = blocks.cooldown(df, ["k"], 7200)
    assert sorted(r.epoch_s for r in fired.select("epoch_s").collect()) == [S + i for i in range(0, n, 7201)]
    plan = blocks.cooldown(df, ["k"], 7200)._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "collect_" in line and "c39" in line]
    assert fired.agg(F.max("c39")).first()[0].startswith("column 39 of ")


def test_cooldown_of_null_keys(spark):
    df = spark.createDataFrame([(None, S, 1), (None, S + 9, 2), (1, S, 3)], "k int, epoch_s bigint, row_key bigint")
    assert {(r.k, r.row_key) for r in blocks.cooldown(df, ["k"], 5).collect()} == {(None, 1), (None, 2), (1, 3)}


@pytest.mark.parametrize(
    "reports, qualifies",
    [
        ([(0, True), (300, True)], []),
        ([(0, True), (301, True)], [301]),
        ([(0, True), (100, False), (301, True)], []),
        ([(0, True), (100, None), (301, True)], []),  # a missing verdict counts as clean
        ([(0, False), (10, True), (311, True), (400, True)], [311, 400]),
    ],
)
def test_sustain(spark, reports, qualifies):
    rows = [(1, S + dt, i, bad) for i, (dt, bad) in enumerate(reports)]
    df = spark.createDataFrame(rows, "k int, epoch_s bigint, row_key bigint, bad boolean")
    out = blocks.sustained(df, ["k"], F.col("bad"), 5).collect()
    assert sorted(r.epoch_s - S for r in out) == qualifies


def test_first_per_day_and_latest(spark):
    df = candidates(spark, [S, S + 50, S + 86400, S + 86400])
    assert sorted(r.row_key for r in blocks.first_per_day(df, ["k"]).collect()) == [0, 2]
    assert blocks.latest_position(df, ["k"]).first().row_key == 3


@pytest.mark.parametrize("stuck", [False, True])
@pytest.mark.parametrize("target", [None, 1000, 30, 7])
def test_scan_is_the_same_in_slices(spark, target, stuck):
    """``stuck``: many reports in one second, several times over."""
    rng = random.Random(5)
    rows, t = [], S
    for i in range(400):
        t += rng.choice([0, 0, 1, 60, 4000, 100000] if i % 50 == 0 else [0, 1, 2, 60]) if not stuck or i % 100 < 20 else 0
        rows.append((t, 113.0 + i * 1e-5, 34.7, i % 7))
    d = prepare(track(spark, rows), target_rows=target)
    if target == 7:
        assert d.groupBy("slice").count().agg(F.max("count")).first()[0] <= (16 if stuck else 60)
    assert ("slice" in d.columns) == (target is not None and target < 400)
    mark = F.when(F.col("speed") == 3, F.struct("epoch_s", "row_key"))
    out = ordered_scan(d, VEHICLE, ["speed"], mark=lambda prev: mark, following=True)
    got = {r.row_key: r for r in out.collect()}
    assert len(got) == 400
    ordered = sorted(range(400), key=lambda i: (rows[i][0], i))
    last = None
    for n, i in enumerate(ordered):
        r = got[i]
        last = i if rows[i][3] == 3 else last
        assert (r.prev.row_key if r.prev else None) == (ordered[n - 1] if n else None)
        assert (r.next.row_key if r.next else None) == (ordered[n + 1] if n < 399 else None)
        assert (r.mark.row_key if r.mark else None) == last


def test_salted_join_equals_broadcast(spark):
    facts = spark.range(500).select(F.col("id").alias("row_key"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 20).alias("k"))
    dim = spark.range(12).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        a = sorted(map(tuple, salted_join(facts, dim, ["k"], how).collect()), key=str)
        b = sorted(map(tuple, salted_join(facts, dim, ["k"], how, max_broadcast=0).collect()), key=str)
        assert a == b
    plan = salted_join(facts, dim, ["k"], "inner", max_broadcast=0)._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan


def test_duplicate_dimension_keys_do_not_multiply_rows(spark):
    dim = spark.createDataFrame([(1, "a", 5), (1, "b", 2), (2, "c", 1)], "k int, name string, n int")
    facts = spark.createDataFrame([(1, 1), (2, 1), (3, 3)], "row_key int, k int")
    assert sorted(map(tuple, one_per_key(dim, ["k"]).collect())) == [(1, "b", 2), (2, "c", 1)]
    assert lookup(facts, dim, ["k"]).count() == 3


def test_joined_dimension_is_measured(spark, tmp_path):
    from haulwatch.operators.lookups import fits, plan_bytes

    for name in ("a", "b"):
        spark.range(20000).select("id", F.col("id").alias(name)).write.parquet(str(tmp_path / name))
    a, b = (spark.read.parquet(str(tmp_path / n)) for n in ("a", "b"))
    joined = a.join(b, "id")
    limit = 4 << 20
    assert plan_bytes(joined) > limit and fits(joined, limit)
    assert not fits(joined, 1000)
    assert not fits(joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(10)))), limit)

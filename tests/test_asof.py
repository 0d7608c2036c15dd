"""Positions with dimensions as they were."""

from __future__ import annotations

import random

from conftest import S, frame, random_positions
from pyspark.sql import functions as F

from haulwatch.operators.asof import as_of, changes
from haulwatch.operators.sequence import VEHICLE

DDL = "dept_id int, vehicle_id int, taken_t bigint, state int, name string"


def snapshots(seed, taken):
    rng, rows, now = random.Random(seed), [], {}
    for t in taken:
        for v in range(1, 7):
            if rng.random() < 0.4:
                now[v] = None if rng.random() < 0.3 else (rng.choice([0, 1, None]), rng.choice(["a", "b"]))
        rows += [(1 + v % 2, v, t, *r) for v, r in now.items() if r is not None]
    return rows


def test_history_of_snapshots(spark):
    """Each position gets the row of the last snapshot before it, from changes alone."""
    taken = [S - 40000 + 30000 * k for k in range(14)]
    rows = snapshots(3, taken)
    history = changes(spark.createDataFrame(rows, DDL).withColumn("taken_at", F.timestamp_seconds("taken_t")).drop("taken_t"), VEHICLE)
    assert history.count() < len(rows)
    pdf = random_positions(5, vehicles=8, reports=80)
    by_key = {(v, t): (state, name) for _, v, t, state, name in rows}
    want = {}
    for r in pdf.itertuples():
        before = [t for t in taken if t <= r.t]
        want[r.row_key] = by_key.get((r.vehicle_id, before[-1])) if before else None
    for limit in (None, 0):
        out = as_of(frame(spark, pdf).withColumn("card", F.lit(1)), history, VEHICLE, "card", max_broadcast=limit).collect()
        assert len(out) == len(pdf)
        assert {r.row_key: None if r.card is None else (r.card.state, r.card.name) for r in out} == want
    assert sum(w is not None for w in want.values()) > 100


def test_history_without_rows(spark):
    history = spark.createDataFrame([(1, 1, None, 0)], "dept_id int, vehicle_id int, valid_from timestamp, state int")
    out = as_of(frame(spark, random_positions(5, reports=5)), history, VEHICLE, "card").collect()
    assert len(out) == 20 and all(r.card is None for r in out)

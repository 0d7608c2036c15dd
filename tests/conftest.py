from __future__ import annotations

import random
import sys
from pathlib import Path

import pandas as pd
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from haulwatch.session import local_session  # noqa: E402

S = 1704096000  # 2024-01-01 08:00:00
DEGREE_M = 111194.92664455873


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(cores=4, shuffle_partitions=4, memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    return session


COLUMNS = ["row_key", "dept_id", "vehicle_id", "t", "lng", "lat", "speed", "audit_state", "manage_state"]
DDL = ("row_key bigint, dept_id int, vehicle_id int, t bigint, lng double, lat double, speed double, "
       "audit_state string, manage_state string")


def track(spark, rows, vehicle=1):
    """Positions of one vehicle from ``(t, lng, lat, speed)`` tuples."""
    data = [(i, 1, vehicle, t, lng, lat, float(speed), "1", "1") for i, (t, lng, lat, speed) in enumerate(rows)]
    return frame(spark, pd.DataFrame(data, columns=COLUMNS))


def frame(spark, pdf):
    from pyspark.sql import functions as F

    rows = [tuple(r) for r in pdf[COLUMNS].itertuples(index=False)]
    rows = [(int(a), int(b), int(c), int(d), float(e), float(f), float(g), h, i) for a, b, c, d, e, f, g, h, i in rows]
    return spark.createDataFrame(rows, DDL).withColumn("time", F.timestamp_seconds("t")).drop("t")


def random_positions(seed: int, vehicles: int = 4, reports: int = 120, hot: int = 0) -> pd.DataFrame:
    """Vehicles that wander between a few spots, stop, fall silent and send reports in the same second.

    Vehicle 1 gets ``hot`` extra reports, so it can hold a third of all rows and more.
    """
    rng = random.Random(seed)
    rows, key = [], 0
    for vehicle in range(1, vehicles + 1):
        t = S + rng.randrange(4 * 86400)
        spot, speed = 0, 0.0
        for _ in range(reports + (hot if vehicle == 1 else 0)):
            t += rng.choice([0, 1, 10, 30, 30, 60, 60, 61, 100, 179, 180, 181, 240, 900])
            if rng.random() < 0.02:
                t += rng.choice([7200, 40000])
            if rng.random() < 0.25:
                spot = rng.randrange(5)
            if rng.random() < 0.3:
                speed = rng.choice([0.0, 0.0, 5.0, 14.0, 15.0, 30.0])
            lng = 113.0 + spot * 0.006 + rng.uniform(-0.003, 0.003)
            lat = 34.7 + (spot % 2) * 0.005 + rng.uniform(-0.003, 0.003)
            rows.append((key, 1 + vehicle % 2, vehicle, t, lng, lat, speed, "1", "1"))
            key += 1
    rng.shuffle(rows)
    return pd.DataFrame(rows, columns=COLUMNS)


def replay(pdf: pd.DataFrame, step, key=("dept_id", "vehicle_id"), order=("t", "row_key")):
    """Run a transition over every key in time order."""
    out = []
    for k, group in pdf.groupby(list(key)):
        state = {}
        for r in group.sort_values(list(order)).to_dict("records"):
            state, emitted = step(state, r)
            out += [dict(zip(key, k)) | e for e in emitted]
    return out

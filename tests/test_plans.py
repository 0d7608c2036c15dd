"""Shape of the physical plans: no cross joins, narrow scans, no shuffle of facts where none is needed."""

from __future__ import annotations

from pathlib import Path

import pytest
from conftest import frame, random_positions

from fixtures.queries import QUERIES
from haulwatch.operators.lookups import lookup
from haulwatch.plans import alarms

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
@pytest.mark.parametrize("name", QUERIES)
def test_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
def test_data_bus_does_not_shuffle_positions(spark):
    lines = plan(QUERIES["data_bus"](spark, SF)).splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "event_id" in line)
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    above, level = [], depth[scan]
    for i in range(scan, -1, -1):
        if depth[i] < level:
            above.append(lines[i])
            level = depth[i]
    assert sum("BroadcastHashJoin" in line for line in above) >= 5
    assert not any("Exchange hashpartitioning" in line for line in above)


def test_scan_is_pruned_and_filtered(spark, tmp_path):
    from pyspark.sql import functions as F

    wide = frame(spark, random_positions(1)).withColumns({f"unused_{i}": F.lit(i) for i in range(5)})
    wide.write.parquet(str(tmp_path / "bus"))
    d = spark.read.parquet(str(tmp_path / "bus"))
    text = plan(alarms.alarm_gps_gap(d.drop(*[c for c in d.columns if c.startswith("unused")]), target_rows=None))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "unused" not in scan
    assert "EqualTo(audit_state,1)" in scan and "EqualTo(manage_state,1)" in scan
    # One shuffle serves the order of the reports and the first alarm of the day.
    assert text.count("Exchange hashpartitioning") == 1


def test_small_dimension_is_broadcast_and_large_is_salted(spark, tmp_path):
    spark.range(1000).selectExpr("id as k", "id as v").write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim"))
    facts = spark.range(5000).selectExpr("id as row_key", "id % 1000 as k")
    assert "BroadcastHashJoin" in plan(lookup(facts, dim, ["k"]))
    text = plan(lookup(facts, dim, ["k"], max_broadcast=0))
    assert "_salt" in text and "Generate explode" in text

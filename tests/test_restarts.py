"""Sinks over repeated batches, and over queries that begin anew with another checkpoint."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from haulwatch.sources.sinks import append_partitioned, stream_batches, write_json
from haulwatch.streaming import records

DDL = "vehicle_id int, dept_id int, terminal_id string, time string, lng double, lat double, speed double, gprs_state int, acc_state int, vehicle_status int, online_time bigint, online_status int"


def rows(spark, first, n):
    return spark.range(first, first + n).select("id", F.lit("2024-01").alias("month_id"), F.lit("1").alias("day_id"), F.lit("8").alias("hour_id"))


def test_new_checkpoint_replaces_nothing(spark, tmp_path):
    """Batch 0 of the second query has other rows than that of the first."""
    folder, out, text = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "text")
    for k, checkpoint in enumerate(("a", "a", "b")):
        rows(spark, 10 * k, 10).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema("id bigint, month_id string, day_id string, hour_id string").option("maxFilesPerTrigger", 1).parquet(folder)
        for write, name in ((append_partitioned(out), "t"), (write_json(text), "j")):
            source = stream if checkpoint == "a" else stream.filter("id >= 20")
            stream_batches(source, write, str(tmp_path / f"{name}-{checkpoint}"), interval=None).awaitTermination()
    table = spark.read.parquet(out)
    assert sorted(r.id for r in table.collect()) == list(range(30))
    assert table.select("run_id").distinct().count() == 2 and {r.batch_id for r in table.select("batch_id").distinct().collect()} >= {0, 1}
    assert spark.read.text(text).count() == 30


def batch(spark, vehicle, hour, status=0):
    report = F.to_json(F.struct(F.lit(float(hour)).alias("speed"), F.lit("T").alias("devid")))
    one = spark.range(1).select(F.lit(vehicle).alias("vehicle_id"), F.lit(1).alias("dept_id"), F.lit(hour).cast("bigint").alias("row_key"))
    one = one.withColumns({"report": report if status == 0 else F.lit(None).cast("string"), "vehicle_status": F.lit(status), "online_time": F.lit(60 * hour).cast("bigint"), "online_status": F.lit(1)})
    return one.withColumn("time", F.to_timestamp(F.lit(f"2024-01-01 {hour:02}:00:00")))


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "status")
    records.create_status(spark.createDataFrame([(v, 1, "old", "2023-12-31 00:00:00", 0.0, 0.0, 9.0, 1, 1, 1, 0, 1) for v in (1, 2, 3)], DDL), path)
    return path


def status(spark, path):
    return {r.vehicle_id: (r.time[11:13], r.speed, r.vehicle_status) for r in records.read_status(spark, path).collect()}


def test_status_over_a_new_checkpoint(spark, table):
    first, second = records.upsert_status(table, "first"), records.upsert_status(table, "second")
    first(batch(spark, 1, 1), 0)
    first(batch(spark, 2, 2), 1)
    first(batch(spark, 2, 2), 1)  # run again
    assert status(spark, table) == {1: ("01", 1.0, 0), 2: ("02", 2.0, 0), 3: ("00", 9.0, 1)}
    second(batch(spark, 1, 3), 0)
    assert status(spark, table) == {1: ("03", 3.0, 0), 2: ("02", 2.0, 0), 3: ("00", 9.0, 1)}
    first(batch(spark, 2, 2), 1)  # a late repeat changes nothing
    assert status(spark, table)[1] == ("03", 3.0, 0)


def test_status_is_compacted(spark, table, monkeypatch):
    monkeypatch.setattr(records, "COMPACT_AFTER", 3)
    write = records.upsert_status(table, "run")
    for k in range(8):
        write(batch(spark, 1 + k % 2, k + 1), k)
        write(batch(spark, 1 + k % 2, k + 1), k)
    assert status(spark, table) == {1: ("07", 7.0, 0), 2: ("08", 8.0, 0), 3: ("00", 9.0, 1)}
    commits = records._commits(spark, table)
    assert sum(c.whole for c in commits) == 2 and len(commits) < 8
    assert {r.version for r in spark.read.parquet(table).select("version").distinct().collect()} == {c.version for c in commits}
    # a version that was written but not committed is not there
    spark.read.parquet(f"{table}/version={commits[-1].version}").write.parquet(f"{table}/version=99")
    assert status(spark, table)[2] == ("08", 8.0, 0)

"""The jobs in a row as streams: records to enriched positions to alarms to tables."""

from __future__ import annotations

import json

import worlds
from conftest import S, frame, random_positions
from pyspark.sql import functions as F
from test_detectors import secs
from test_streaming import run, source, write_parts

from haulwatch.functions.timefn import time_text
from haulwatch.operators.lookups import join_vehicle, sanitize_positions
from haulwatch.plans import alarms, outputs
from haulwatch.sources import scans
from haulwatch.sources.sinks import append_partitioned, stream_batches, stream_out, write_json
from haulwatch.streaming import detectors, records


def text_stream(spark, folder):
    return scans.read(spark, "text", path=str(folder), streaming=True)


def dims(spark):
    vehicle = spark.createDataFrame(
        [(v, f"T{v}", f"P{v}", worlds.dept(v), v, "e", "1", "1") for v in range(1, 5)],
        "vehicle_id int, terminal_id string, car_card_number string, dept_id int, driver_id int, enterprise_id string, audit_state string, manage_state string",
    )
    both = [(d,) for d in (1, 2)]
    fee = vehicle.filter("vehicle_id <> 4").select("vehicle_id", "dept_id", F.lit(0).alias("state"))
    driver = spark.createDataFrame([(1, 2, "Ann")], "driver_id int, dept_id int, driver_name string")
    enterprise = spark.createDataFrame([(*d, "e", "Haul Ltd", 1.0, 2.0) for d in both], "dept_id int, enterprise_id string, enterprise_name string, lng double, lat double")
    card = spark.createDataFrame([(1, 2, 1)], "vehicle_id int, dept_id int, state int")
    area = spark.createDataFrame([(9, "town", 2, "112,34;114,34;114,36;112,36", 1)], "id int, city_name string, dept_id int, coords string, state int")
    return vehicle, (fee, driver, enterprise, card, area)


def test_records_to_alarm_table(spark, tmp_path):
    pdf = random_positions(11, reports=60).sort_values("t")
    raw = frame(spark, pdf).select(
        F.to_json(F.struct(F.concat(F.lit("P"), "vehicle_id").alias("car_card_number"), time_text("time").alias("time"), "lng", "lat", F.col("speed").cast("string").alias("speed"), F.col("row_key").cast("string").alias("zxcqi"))).alias("value")
    )
    raw.coalesce(1).write.text(str(tmp_path / "raw"))
    vehicle, bus_dims = dims(spark)

    p = sanitize_positions(scans.scan_positions(text_stream(spark, tmp_path / "raw")).drop("devid"))
    stream_out(join_vehicle(p, vehicle), "text", str(tmp_path / "c1"), {"path": str(tmp_path / "etl")}, interval=None).awaitTermination()
    bus = outputs.data_bus(scans.scan_bus(text_stream(spark, tmp_path / "etl")), *bus_dims)
    stream_out(bus, "text", str(tmp_path / "c2"), {"path": str(tmp_path / "bus")}, interval=None).awaitTermination()

    sent = scans.scan_bus(spark.read.text(str(tmp_path / "bus")))
    assert sent.count() == 180 and sent.filter("service_state = 1 and enterprise_lng = 1.0").count() == 180
    ann = sent.filter("vehicle_id = 1").first()
    assert (ann.devid, ann.driver_name, ann.region_name, ann.transport_card_state) == ("T1", "Ann", "town", 1)

    d = scans.scan_bus(text_stream(spark, tmp_path / "bus")).withColumn("row_key", F.col("zxcqi").cast("long"))
    found = records.alarm_records(detectors.stream_gps_gap(d, max_m=900.0))
    stream_batches(found, write_json(str(tmp_path / "alarm")), str(tmp_path / "c3"), interval=None, mode="update").awaitTermination()
    kinds = spark.createDataFrame([(2, "0118", "short", "long", 1.0, 2.0, 3.0)], "dept_id int, illegal_type_code string, illegal_type_short_desc string, illegal_type_desc string, enterprise_score double, vehicle_score double, driver_score double")
    enriched = outputs.enrich_alarms(scans.scan_alarms(text_stream(spark, tmp_path / "alarm" / "*")), kinds)
    stream_batches(enriched, append_partitioned(str(tmp_path / "table")), str(tmp_path / "c4"), interval=None).awaitTermination()

    table = spark.read.parquet(str(tmp_path / "table"))
    batch = alarms.alarm_gps_gap(sent.withColumn("row_key", F.col("zxcqi").cast("long")), max_m=900.0)
    want = sorted((r.vehicle_id, secs(r.alarm_start_time), secs(r.alarm_end_time)) for r in batch.collect())
    got = table.collect()
    assert sorted((r.vehicle_id, secs(r.alarm_start_time), secs(r.alarm_end_time)) for r in got) == want and want
    assert all((r.vehicle_score == 2.0) == (r.dept_id == 2) and r.interval_distance > 900 and r.enterprise_name == "Haul Ltd" for r in got)


def test_frames_stream(spark, tmp_path):
    from test_functions import FRAME

    spark.createDataFrame([(FRAME,), ("7E" + FRAME + "7E",), ("07040000",)], "value string").write.text(str(tmp_path / "in"))
    out = run(spark, scans.scan_frames(text_stream(spark, tmp_path / "in"), "value"), tmp_path).collect()
    assert [(r.devid, r.speed, secs(r.time)) for r in out] == [("13007252658", 36.5, S - 28800 + 4 * 86400 + 29730)] * 2


def test_status_table(spark, tmp_path):
    ddl = ("vehicle_id int, dept_id int, terminal_id string, time string, lng double, lat double, speed double, gprs_state int, acc_state int, "
           "vehicle_status int, online_time bigint, online_status int")
    rows = [(v, 1, "old", "2024-01-01 07:59:00", 0.0, 0.0, 9.0, 1, 1, 0, 60, 1) for v in (1, 2)] + [(5, 1, "old", "2023-01-01 00:00:00", 0.0, 0.0, 9.0, 1, 1, 1, 7, 1)]
    root = str(tmp_path / "status")
    records.create_status(spark.createDataFrame(rows, ddl), root)
    seed = records.initial_status(records.read_status(spark, root), dept_id=1)
    assert sorted((r.vehicle_id, r.t - S, r.online_time) for r in seed.collect()) == [(1, -60, 60), (2, -60, 60)]

    def part(reports):
        import pandas as pd
        from conftest import COLUMNS

        data = [(i, 1, v, t, 113.0, 34.7, s, "1", "1") for i, (v, t, s) in enumerate(reports)]
        frame(spark, pd.DataFrame(data, columns=COLUMNS)).withColumn("accflag", F.lit("0")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    part([(1, S, 10.0), (2, S, 20.0), (3, S, 5.0)])
    part([(2, S + 500, 21.0)])
    part([(2, S + 560, 22.0)])
    df = detectors.stream_vehicle_status(source(spark, str(tmp_path / "in")), grace_s=1, seed=seed)
    query = stream_batches(df, records.upsert_status(root), str(tmp_path / "checkpoint"), interval=None, mode="update")
    query.awaitTermination()
    out = {r.vehicle_id: r for r in records.read_status(spark, root).collect()}
    versions = spark.read.parquet(root).filter("version >= 1")
    assert versions.filter("vehicle_id = 5").isEmpty() and not versions.isEmpty()  # what no batch touches is written once
    assert set(out) == {1, 2, 5}
    assert (out[1].vehicle_status, out[1].time, out[1].speed, out[1].gprs_state, out[1].acc_state) == (1, "2024-01-01 08:00:00", 10.0, 9, 0)
    assert (out[2].vehicle_status, out[2].speed, out[2].online_time) == (0, 22.0, 60 + 60 + 60)
    assert (out[5].time, out[5].terminal_id, out[5].vehicle_status) == ("2023-01-01 00:00:00", "old", 1)


def test_report_restores_the_position(spark, tmp_path):
    pdf = random_positions(12, reports=40)
    folder = write_parts(spark, pdf, tmp_path / "in", parts=2)
    out = run(spark, records.alarm_records(detectors.stream_gps_gap(source(spark, folder), max_m=900.0)), tmp_path)
    rows = out.select("vehicle_id", "audit_state", "time", "alarm_start_time", "illegal_type_code").collect()
    assert rows and all(r.audit_state == "1" and r.time == r.alarm_start_time and r.illegal_type_code == "0118" for r in rows)
    assert json.loads(out.select(F.to_json(F.struct("*")).alias("v")).first().v)["illegal_type_code"] == "0118"

"""Scans, sinks and table merges."""

from __future__ import annotations

import json

from conftest import S
from pyspark.sql import functions as F

from haulwatch import schemas
from haulwatch.operators.lookups import join_vehicle
from haulwatch.plans.vehicles import mark_offline, merge_status
from haulwatch.sources import scans
from haulwatch.sources.sinks import append_partitioned, to_json_value, write_json


def test_scan_is_typed_and_drops_unreadable_records(spark):
    good = {"devid": "1", "time": "2024-01-01 08:00:00", "lng": 113.0, "lat": 34.7, "speed": "12.5", "unknown": 1}
    texts = [json.dumps(good), json.dumps({**good, "time": "bad", "speed": "fast"}), "{not json"]
    out = scans.scan_positions(spark.createDataFrame([(t,) for t in texts], "value string")).collect()
    assert len(out) == 2
    assert (out[0].speed, int(out[0].time.timestamp()) - S, out[0].pos) == (12.5, 0, None)
    assert out[1].time is None and out[1].speed is None


def test_numbers_in_any_form_and_rejected_records(spark):
    texts = ['{"vehicle_id":"7","lng":"113.1","lat":34}', '{"vehicle_id":7.0,"lng":1.5e2,"driver_id":null}', '{"vehicle_id":" 8 ","lng":""}',
             '{"vehicle_id":"x","lng":1}', '{"lng":[1]}', '[1,2]', "", None, '{"vehicle_id":99999999999}', '{"vehicle_id":7.9,"name":{"a":1}}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "offset int, value string")
    out = scans.scan_json(df, schemas.DATA_BUS, columns=["vehicle_id", "lng", "lat", "driver_id"]).collect()
    assert [(r.vehicle_id, r.lng, r.lat) for r in out] == [(7, 113.1, 34.0), (7, 150.0, None), (8, None, None), (7, None, None)]
    bad = {r.offset: r.reason for r in scans.rejected_json(df, schemas.DATA_BUS).collect()}
    assert bad[3] == bad[8] == "vehicle_id: not a int" and bad[4] == "lng: not a double" and {bad[k] for k in (5, 6, 7)} == {"not a JSON object"}
    assert len(out) + len(bad) == len(texts)


def test_row_key_of_partition_and_offset(spark):
    df = spark.createDataFrame([(0, 5), (1, 5), (1, 6)], "partition int, offset bigint")
    assert [r.row_key for r in scans.with_row_key(df, "partition", "offset").collect()] == [5, (1 << 47) + 5, (1 << 47) + 6]
    assert scans.with_row_key(df.withColumn("devid", F.lit("a")), "devid", "offset").select("row_key").distinct().count() == 2


def test_json_keeps_null_fields(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    row = to_json_value(df, key_col="a").first()
    assert json.loads(row.value) == {"a": 1, "b": None} and row.key == "1"


def test_conform_copies_by_name(spark):
    df = spark.range(1).select(F.lit(1).alias("vehicle_id"), F.timestamp_seconds(F.lit(S)).alias("time"), F.lit(2).alias("other"))
    out = schemas.conform(df, schemas.ALARM)
    assert out.schema == schemas.ALARM or [f.name for f in out.schema] == schemas.ALARM.names
    assert out.first().time == "2024-01-01 08:00:00" and out.first().vehicle_id == 1


def test_vehicle_join_trims_both_sides(spark):
    vehicle = spark.createDataFrame([(1, "T1", " P1", 2), (2, "T2", "P2 ", 1)], "vehicle_id int, terminal_id string, car_card_number string, dept_id int")
    p = spark.createDataFrame([(1, "P1 "), (2, " P2"), (3, "P3"), (4, None)], "row_key int, car_card_number string")
    out = join_vehicle(p, vehicle).orderBy("row_key").collect()
    assert [(r.row_key, r.vehicle_id, r.devid) for r in out] == [(1, 1, "T1"), (2, 2, "T2")]


def test_repeated_batch_replaces_its_rows(spark, tmp_path):
    df = spark.range(10).select("id", *[F.lit(v).alias(n) for n, v in (("month_id", "2024-01"), ("day_id", "1"), ("hour_id", "8"))])
    write = append_partitioned(str(tmp_path / "t"))
    write(df, 0)
    write(df.filter("id < 4"), 1)
    write(df.filter("id < 4"), 1)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 14
    text = write_json(str(tmp_path / "j"))
    text(df, 3)
    text(df, 3)
    assert spark.read.text(str(tmp_path / "j")).count() == 10


def test_status_merge(spark):
    ddl = "vehicle_id int, dept_id int, terminal_id string, time string, speed double, gprs_state int, acc_state int, vehicle_status int"
    old = spark.createDataFrame([(1, 1, "a", "t0", 5.0, 1, 1, 0), (2, 1, "b", "t0", 6.0, 1, 1, 0)], ddl)
    new = spark.createDataFrame([(1, 1, "A", "t1", 0.0, None, "0"), (3, 1, "C", "t1", 0.0, "1", "1")], "vehicle_id int, dept_id int, devid string, time string, speed double, gpsflag string, accflag string")
    out = {r.vehicle_id: r for r in merge_status(old, new).collect()}
    assert set(out) == {1, 2}
    assert (out[1].terminal_id, out[1].gprs_state, out[1].acc_state, out[1].vehicle_status) == ("A", 9, 0, 0)
    assert (out[2].terminal_id, out[2].gprs_state) == ("b", 1)


def test_mark_offline(spark):
    df = spark.createDataFrame([(1, 0, S), (2, 0, S + 1), (3, 1, S)], "vehicle_id int, vehicle_status int, t bigint").withColumn("time", F.timestamp_seconds("t"))
    out = mark_offline(df, F.timestamp_seconds(F.lit(S + 181)))
    assert [r.vehicle_status for r in out.orderBy("vehicle_id").collect()] == [1, 0, 1]

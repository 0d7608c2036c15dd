"""Streaming queries fed in several files give the batch result."""

from __future__ import annotations

import time

import pandas as pd
import pytest
import worlds
from conftest import S, frame, random_positions
from pyspark.sql import functions as F
from test_detectors import secs

from haulwatch.plans import alarms, vehicles
from haulwatch.plans.off_route import alarm_off_route
from haulwatch.sources.dims import TABLES, Dims
from haulwatch.sources.sinks import append_partitioned, stream_batches
from haulwatch.streaming import detectors


def write_parts(spark, pdf, folder, parts=3):
    """The rows in time order, one file per part; ties of a vehicle stay together."""
    pdf = pdf.sort_values(["t", "row_key"]).reset_index(drop=True)
    cuts = [pdf.t.iloc[len(pdf) * i // parts] for i in range(1, parts)]
    part = sum((pdf.t >= c).astype(int) for c in cuts)
    for i in range(parts):
        frame(spark, pdf[part == i]).coalesce(1).write.mode("append").parquet(str(folder))
    return str(folder)


def run(spark, df, tmp_path, name="out"):
    out = str(tmp_path / name)

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    query = stream_batches(df, write, str(tmp_path / f"{name}-checkpoint"), interval=None, mode="update")
    query.awaitTermination()
    return spark.read.option("mergeSchema", "true").parquet(out)


def source(spark, folder):
    schema = spark.read.parquet(folder).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def alarm_rows(df):
    return sorted(
        (r.vehicle_id, r.row_key, secs(r.alarm_start_time) or 0, secs(r.alarm_end_time) or 0) for r in df.collect()
    )


def _three_rules(s):
    return worlds.rules(s, start_date="08:00", end_date="17:30"), worlds.rules(s), worlds.rules(s, speed=1)


CASES = {
    "no_register": (
        lambda s, d: alarms.alarm_no_register(d, worlds.cards(s).filter("vehicle_id <> 2")),
        lambda s, d: detectors.stream_no_register(d, worlds.cards(s).filter("vehicle_id <> 2")),
    ),
    "gps_gap": (
        lambda s, d: alarms.alarm_gps_gap(d, max_m=900.0),
        lambda s, d: detectors.stream_gps_gap(d, max_m=900.0),
    ),
    "overspeed": (
        lambda s, d: alarms.alarm_overspeed(d, worlds.rules(s, speed=1), cooldown_s=300),
        lambda s, d: detectors.stream_overspeed(d, worlds.rules(s, speed=1), cooldown_s=300),
    ),
    "restricted_zone": (
        lambda s, d: alarms.alarm_restricted_zone(d, worlds.rules(s), cooldown_s=300),
        lambda s, d: detectors.stream_restricted_zone(d, worlds.rules(s), cooldown_s=300),
    ),
    "work_time": (
        lambda s, d: alarms.alarm_work_time(d, worlds.rules(s, start_date="08:00", end_date="17:30"), cooldown_s=300),
        lambda s, d: detectors.stream_work_time(d, worlds.rules(s, start_date="08:00", end_date="17:30"), cooldown_s=300),
    ),
    "fences": (
        lambda s, d: alarms.alarm_fences(d, *_three_rules(s), cooldown_s=300),
        lambda s, d: detectors.stream_fences(d, *_three_rules(s), cooldown_s=300),
    ),
    "file_control": (
        lambda s, d: alarms.alarm_file_control(d, worlds.rules(s, start_date="2024-01-01 00:00:00", end_date="2024-01-04 00:00:00"), cooldown_s=300),
        lambda s, d: detectors.stream_file_control(d, worlds.rules(s, start_date="2024-01-01 00:00:00", end_date="2024-01-04 00:00:00"), cooldown_s=300),
    ),
    "illegal_disposal": (
        lambda s, d: alarms.alarm_illegal_disposal(d, worlds.cards(s), worlds.sites(s), cooldown_s=600),
        lambda s, d: detectors.stream_illegal_disposal(d, worlds.cards(s), worlds.sites(s), cooldown_s=600),
    ),
    "off_route": (
        lambda s, d: alarm_off_route(d, worlds.permits(s), 330.0, 20, 31.0, 1, 300),
        lambda s, d: detectors.stream_off_route(d, worlds.permits(s), 330.0, 20, 31.0, 1, 300),
    ),
}


@pytest.mark.parametrize("name", CASES)
def test_alarm_stream_equals_batch(spark, tmp_path, name):
    batch, stream = CASES[name]
    pdf = random_positions(7, reports=150)
    folder = write_parts(spark, pdf, tmp_path / "in")
    got = alarm_rows(run(spark, stream(spark, source(spark, folder)), tmp_path))
    assert got == alarm_rows(batch(spark, frame(spark, pdf))) and len(got) > 2


def test_site_visits_stream(spark, tmp_path):
    pdf = random_positions(8, reports=150)
    folder = write_parts(spark, pdf, tmp_path / "in")
    out = run(spark, detectors.stream_site_visits(source(spark, folder), worlds.sites(spark)), tmp_path)

    def rows(df):
        return sorted((r.vehicle_id, r.disposal_site_id, secs(r.enter_time), secs(r.exit_time)) for r in df.collect())

    got = rows(out)
    assert got == rows(vehicles.site_visits(frame(spark, pdf), worlds.sites(spark))) and len(got) > 4


def test_stop_history_stream_survives_restart(spark, tmp_path):
    pdf = random_positions(9, reports=150).sort_values(["t", "row_key"])
    folder, out = tmp_path / "in", str(tmp_path / "out")
    half = pdf.t.iloc[len(pdf) // 2]
    for part in (pdf[pdf.t < half], pdf[pdf.t >= half]):
        frame(spark, part).coalesce(1).write.mode("append").parquet(str(folder))
        stops = detectors.stream_stop_history(source(spark, str(folder)))
        from haulwatch.functions.timefn import partition_ids

        write = append_partitioned(out)
        stream_batches(
            partition_ids(stops, "start_time"), write, str(tmp_path / "checkpoint"), interval=None, mode="update"
        ).awaitTermination()

    def rows(df):
        return sorted((r.vehicle_id, secs(r.stop_time), secs(r.start_time)) for r in df.collect())

    got = spark.read.parquet(out)
    assert {"month_id", "day_id", "hour_id", "batch_id"} <= set(got.columns)
    assert rows(got) == rows(vehicles.stop_history(frame(spark, pdf))) and got.count() > 4


def test_vehicle_status_stream(spark, tmp_path):
    """Vehicle 1 reports, then falls silent while vehicle 2 moves the clock on."""
    from conftest import COLUMNS

    def part(rows):
        data = [(i, 1, v, t, 113.0, 34.7, s, "1", "1") for i, (v, t, s) in enumerate(rows)]
        frame(spark, pd.DataFrame(data, columns=COLUMNS)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    part([(1, S, 10.0), (1, S + 60, 0.0), (2, S, 5.0)])
    part([(2, S + 120, 5.0), (1, S + 100, 0.0)])
    part([(2, S + 1000, 5.0)])
    part([(2, S + 1060, 5.0)])
    seed = spark.createDataFrame([(1, 1, S - 40, 500)], "dept_id int, vehicle_id int, t bigint, online_time bigint")
    df = detectors.stream_vehicle_status(source(spark, str(tmp_path / "in")), grace_s=1, seed=seed)
    rows = [
        (r.vehicle_id, secs(r.time) - S, r.vehicle_status, r.online_time)
        for r in run(spark, df, tmp_path).orderBy("batch", "vehicle_id", "time").collect()
    ]
    assert (1, 60, 0, 600) in rows  # 500 known at start, 40 + 60 more
    assert (1, 100, 0, 640) in rows
    assert (1, 100, 1, 640) in rows  # silent for more than 180 s
    assert (2, 1000, 0, 120) in rows and (2, 1060, 0, 180) in rows  # offline time is not counted


def test_dimension_snapshot_ages(spark, tmp_path):
    now = [0.0]
    path = tmp_path / "dim_cwp_d_driver_info"
    spark.range(1).write.parquet(str(path))
    dims = Dims(spark, root=str(tmp_path), max_age=3600, clock=lambda: now[0])
    first = dims.load("driver")
    assert first.count() == 1
    # Written past Spark, which would otherwise refresh its cache.
    pd.DataFrame({"id": range(5)}).to_parquet(path / "more.parquet")
    now[0] = 3599.0
    assert dims.load("driver").count() == 1
    now[0] = 3600.0
    assert dims.load("driver").count() == 6
    assert Dims(spark, root=str(tmp_path)).load("driver").count() == 6


def test_stream_reads_dimension_changes(spark, tmp_path):
    """A dimension joined to a stream is read anew by every batch."""
    from conftest import COLUMNS

    from haulwatch.operators.lookups import join_driver

    folder, dim = str(tmp_path / "in"), str(tmp_path / "driver")

    def part(key):
        data = [(key, 1, 1, S + key, 113.0, 34.7, 1.0, "1", "1")]
        frame(spark, pd.DataFrame(data, columns=COLUMNS)).coalesce(1).write.mode("append").parquet(folder)

    ddl = "driver_id int, dept_id int, driver_name string"
    for key, name in ((1, "first"), (2, "second")):
        part(key)
        spark.createDataFrame([(7, 1, name)], ddl).write.mode("overwrite").parquet(dim)
        d = source(spark, folder).withColumn("driver_id", F.lit(7))
        out = join_driver(d, spark.read.parquet(dim)).select("row_key", "driver_name")
        result = run(spark, out, tmp_path)
    assert sorted(map(tuple, result.select("row_key", "driver_name").collect())) == [(1, "first"), (2, "second")]


def holes(pdf):
    """Reports without a position or a speed."""
    pdf = pdf.copy()
    pdf.loc[pdf.row_key % 9 == 4, ["lng", "lat"]] = float("nan")
    pdf.loc[pdf.row_key % 11 == 5, "speed"] = float("nan")
    return pdf


def with_nulls(df):
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("lng", "lat", "speed")})


def test_null_fields_pass_through_streams(spark, tmp_path):
    pdf = holes(random_positions(7, reports=150))
    folder = write_parts(spark, pdf, tmp_path / "in")
    batch = with_nulls(frame(spark, pdf))
    for name in ("gps_gap", "restricted_zone"):
        want, stream = CASES[name]
        got = alarm_rows(run(spark, stream(spark, with_nulls(source(spark, folder))), tmp_path, name))
        assert got == alarm_rows(want(spark, batch)) and got
    rules = worlds.rules(spark).withColumn("alarm_date", F.lit(None).cast("int"))
    assert run(spark, detectors.stream_restricted_zone(with_nulls(source(spark, folder)), rules), tmp_path, "no_minutes").count() == 0
    stops = run(spark, detectors.stream_stop_history(with_nulls(source(spark, folder))), tmp_path, "stops")
    key = lambda df: sorted((r.vehicle_id, r.stop_time, r.start_time) for r in df.collect())
    assert key(stops) == key(vehicles.stop_history(batch))


def test_state_of_silent_keys_expires(spark, tmp_path):
    """A query with expiring state runs on; the alarms are those of the batch as long as nothing has expired."""
    pdf = random_positions(7, reports=150)
    folder = write_parts(spark, pdf, tmp_path / "in")
    out = str(tmp_path / "out")

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    stream = detectors.stream_gps_gap(source(spark, folder), max_m=900.0, expire_s=86400)
    query = stream_batches(stream, write, str(tmp_path / "checkpoint"), interval="1 second", mode="update")
    try:  # such a query is never idle, since time passes
        for _ in range(120):
            if sum(p["numInputRows"] for p in query.recentProgress) >= len(pdf):
                break
            time.sleep(0.5)
    finally:
        query.stop()
    got = alarm_rows(spark.read.parquet(out))
    assert got == alarm_rows(alarms.alarm_gps_gap(frame(spark, pdf), max_m=900.0)) and got


def test_running_query_sees_a_rewritten_dimension(spark, tmp_path):
    """The table's files are replaced while the query runs."""
    from haulwatch.streaming.refresh import run_refreshing

    pdf = random_positions(3, reports=60)
    folder, dims_at = tmp_path / "in", str(tmp_path / TABLES["driver"])
    dept = pdf.groupby("vehicle_id").dept_id.first().to_dict()
    card = lambda ids: spark.createDataFrame([(int(dept[i]), i, 0) for i in ids], "dept_id int, vehicle_id int, state int").coalesce(1).write.mode("overwrite").parquet(dims_at)
    card([1, 2, 3])
    frame(spark, pdf).coalesce(1).write.parquet(str(folder))
    out, starts = str(tmp_path / "out"), []

    def start():
        if starts:  # new reports of a later day, and another table
            card([1])
            frame(spark, pdf.assign(t=pdf.t + 10 * 86400, row_key=pdf.row_key + 1000)).coalesce(1).write.mode("append").parquet(str(folder))
        starts.append(1)
        dims = Dims(spark, root=str(tmp_path), max_age=3600)
        alarm = detectors.stream_no_register(source(spark, str(folder)), dims.load("driver").withColumn("state", F.lit(0)))
        # the files go away under the query that has just been built
        card([1, 2, 3] if len(starts) == 1 else [1])

        def write(batch, batch_id):
            batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

        return stream_batches(alarm, write, str(tmp_path / "checkpoint"), interval=None, mode="update")

    run_refreshing(start, 60, until=lambda: len(starts) == 2)
    rows = spark.read.parquet(out).collect()
    assert {r.vehicle_id for r in rows if r.row_key < 1000} == {4} and {r.vehicle_id for r in rows if r.row_key >= 1000} == {2, 3, 4}


def arrive(spark, pdf, folder, parts):
    """Parts in order of arrival; a last one of another vehicle, far ahead, moves the clock on."""
    for part in parts:
        frame(spark, part).coalesce(1).write.mode("append").parquet(str(folder))
    for k in range(2):
        ahead = pdf.head(1).assign(t=pdf.t.max() + 40000 + k, row_key=10**6 + k, vehicle_id=99)
        frame(spark, ahead).coalesce(1).write.mode("append").parquet(str(folder))
    return str(folder)


def delayed(pdf, delay_s, n, seed=1):
    """The reports in parts by time of arrival, at most delay_s after their own, shuffled within a part."""
    shift = pd.Series(range(len(pdf)), index=pdf.index).sample(frac=1, random_state=seed) * delay_s // (len(pdf) + 1)
    arrival = pdf.t + shift.sort_index()
    cuts = [arrival.quantile((i + 1) / n) for i in range(n)]
    part = sum((arrival > c).astype(int) for c in cuts[:-1])
    return [pdf[part == i].sample(frac=1, random_state=i) for i in range(n)]


@pytest.mark.parametrize("name", ["gps_gap", "fences", "off_route"])
def test_shuffled_stream_equals_batch(spark, tmp_path, name):
    batch, _ = CASES[name]
    streams = {
        "gps_gap": lambda d: detectors.stream_gps_gap(d, max_m=900.0, delay_s=3600),
        "fences": lambda d: detectors.stream_fences(d, *_three_rules(spark), cooldown_s=300, delay_s=3600),
        "off_route": lambda d: detectors.stream_off_route(d, worlds.permits(spark), 330.0, 20, 31.0, 1, 300, delay_s=3600),
    }
    pdf = random_positions(7, reports=100)
    folder = arrive(spark, pdf, tmp_path / "in", delayed(pdf, 3000, 4))
    got = [r for r in alarm_rows(run(spark, streams[name](source(spark, folder)), tmp_path)) if r[0] != 99]
    assert got == alarm_rows(batch(spark, frame(spark, pdf))) and len(got) > 2


def test_late_reports_come_out_and_are_counted(spark, tmp_path):
    """Reports of an earlier time than the delay allows change nothing; each comes out once."""
    from haulwatch.sources.sinks import split_late

    pdf = random_positions(7, reports=100)
    late = pdf[pdf.row_key % 17 == 3]
    rest = pdf.drop(late.index)
    last = rest.groupby("vehicle_id").t.max()
    late = late[late.t < late.vehicle_id.map(last) - 7300]
    rest = pdf.drop(late.index)
    middle = [rest.assign(vehicle_id=98, row_key=rest.row_key + 20000).tail(1).assign(t=pdf.t.max() + 10000 + k) for k in range(2)]
    folder = arrive(spark, pdf, tmp_path / "in", [*delayed(rest, 500, 3), *middle, late])
    result = detectors.stream_gps_gap(source(spark, folder), max_m=900.0, delay_s=600, late=True)
    out, other = str(tmp_path / "alarms"), str(tmp_path / "late")
    write = split_late(append_batches(out), append_batches(other))
    query = stream_batches(result, write, str(tmp_path / "checkpoint"), interval=None, mode="update")
    query.awaitTermination()
    got = [r for r in alarm_rows(spark.read.parquet(out)) if r[0] < 90]
    assert got == alarm_rows(alarms.alarm_gps_gap(frame(spark, rest), max_m=900.0))
    rows = spark.read.parquet(other)
    assert sorted(r.row_key for r in rows.collect()) == sorted(late.row_key) and len(late) > 10
    counted = sum(p["observedMetrics"]["late_reports"]["n"] for p in query.recentProgress if p["observedMetrics"])
    assert counted == len(late)


def append_batches(path):
    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write

"""Detector thresholds, one case each."""

from __future__ import annotations

import pytest
import worlds
from conftest import DEGREE_M, S, frame, track
from pyspark.sql import functions as F
from test_detectors import secs

from haulwatch.operators import lookups, spatial
from haulwatch.plans import alarms, outputs, vehicles
from haulwatch.plans.off_route import alarm_off_route

HOME = (113.0, 34.7)
AWAY = (113.5, 34.7)


def at(dt, where, speed=1.0):
    return (S + dt, *where, speed)


@pytest.mark.parametrize("metres, n", [(2000.0 - 1e-3, 0), (2000.0 + 1e-3, 1)])
def test_gap_distance(spark, metres, n):
    rows = [at(0, HOME), at(10, (113.0, 34.7 + metres / DEGREE_M))]
    assert alarms.alarm_gps_gap(track(spark, rows)).count() == n


def test_gap_over_midnight(spark):
    midnight = 16 * 3600  # S is 08:00
    rows = [at(midnight - 60, HOME), at(midnight + 60, AWAY), at(midnight + 300, HOME)]
    out = alarms.alarm_gps_gap(track(spark, rows)).collect()
    assert [(secs(r.alarm_start_time) - S, secs(r.alarm_end_time) - S) for r in out] == [(midnight - 60, midnight + 60)]
    assert out[0].alarm_start_lng == HOME[0] and out[0].alarm_end_lng == AWAY[0]


@pytest.mark.parametrize(
    "rows, n",
    [
        ([(0, 0), (100, 0), (181, 5)], 1),
        ([(0, 0), (100, 0), (180, 5)], 0),
        ([(0, 0), (180, 5)], 0),  # silent for 180 s
        ([(0, 0), (179, 0), (358, 5)], 1),
        ([(0, 0), (181, 0), (300, 5)], 0),  # silence over 180 s starts a new stop
        ([(0, 0), (180, 0), (300, 5)], 1),
        ([(0, 5), (10, 5)], 0),
    ],
)
def test_stop(spark, rows, n):
    assert vehicles.stop_history(track(spark, [at(t, HOME, v) for t, v in rows])).count() == n


@pytest.mark.parametrize(
    "rows, visits",
    [
        ([(0, 1), (181, 1), (200, 0), (381, 0)], [(0, 200)]),
        ([(0, 1), (180, 1), (200, 0), (381, 0)], []),  # never confirmed
        ([(0, 1), (181, 1), (200, 0), (380, 0)], []),  # not yet out for long enough
        ([(0, 1), (181, 1), (200, 0), (300, 1), (381, 0)], []),  # back in: the exit is withdrawn
        ([(0, 1), (181, 1), (200, 0), (300, 1), (310, 0), (491, 0)], [(0, 310)]),
        ([(0, 1), (100, 0), (400, 1), (410, 0), (591, 0)], [(0, 410)]),  # outside does not undo an unconfirmed entry
    ],
)
def test_visit(spark, rows, visits):
    d = track(spark, [at(t, HOME if inside else AWAY) for t, inside in rows]).withColumn("dept_id", F.lit(2))
    sites = worlds.sites(spark).filter("disposal_site_id = 10")
    out = vehicles.site_visits(d, sites).collect()
    assert [(secs(r.enter_time) - S, secs(r.exit_time) - S) for r in out] == visits


@pytest.mark.parametrize("still, status", [(179, 1), (180, 0)])
def test_status_standstill(spark, still, status):
    d = track(spark, [at(0, HOME, 0), at(still, HOME, 0)])
    assert vehicles.vehicle_status(d, F.timestamp_seconds(F.lit(S + still))).first().online_status == status


@pytest.mark.parametrize("silence, status", [(180, 0), (181, 1)])
def test_status_offline(spark, silence, status):
    d = track(spark, [at(0, HOME)])
    assert vehicles.vehicle_status(d, F.timestamp_seconds(F.lit(S + silence))).first().vehicle_status == status


def test_status_online_time_restarts_at_midnight(spark):
    midnight = 16 * 3600
    rows = [at(midnight + dt, HOME) for dt in range(-300, 301, 100)]
    out = vehicles.vehicle_status(track(spark, rows), F.timestamp_seconds(F.lit(S + midnight + 300))).first()
    # 300 s before midnight exceed the 0 s since midnight at the report on midnight itself, then 300 s follow.
    assert (out.online_time, out.vehicle_status) == (300, 0)


@pytest.mark.parametrize("late, n", [(239, 0), (240, 1)])
def test_off_route_minutes(spark, late, n):
    build, route = (113.018, 34.705), (113.006, 34.705)
    rows = [at(0, build, 1), at(181, build, 1), at(200, route, 40), at(300, AWAY, 40), at(300 + late, AWAY, 40)]
    d = track(spark, rows).withColumn("dept_id", F.lit(2))
    permits = worlds.permits(spark).filter("permit_id = 100")
    out = alarm_off_route(d, permits).collect()
    assert len(out) == n
    if n:
        r = out[0]
        assert (secs(r.alarm_start_time) - S, secs(r.alarm_end_time) - S) == (300, 540)
        assert (r.alarm_start_lng, r.alarm_start_lat, r.permit_id) == (*AWAY, 100)


@pytest.mark.parametrize("site, match, n", [(1, "not_permitted", 0), (3, "not_permitted", 1), (1, "any_other", 1), (3, "any_other", 1)])
def test_illegal_disposal(spark, site, match, n):
    sites = spark.createDataFrame([(i, 1, f"s{i}", 113.0 + i / 10, 34.7) for i in (1, 2, 3)], "disposal_site_id int, dept_id int, disposal_site_name string, lng double, lat double")
    card = spark.createDataFrame([(1, 1, 1, 0), (1, 1, 2, 0)], "dept_id int, vehicle_id int, disposal_site_id int, state int")
    d = track(spark, [at(0, (113.0 + site / 10, 34.7))])
    assert alarms.alarm_illegal_disposal(d, card, sites, match=match).count() == n
    assert alarms.alarm_illegal_disposal(d, card.filter("state = 1"), sites, match=match).count() == 0


def test_sanity_bounds(spark):
    rows = [(20.0, 110.0, 1), (20.1, 110.0, 1), (39.9, 119.9, 0), (40.0, 110.0, 1), (30.0, 100.0, 1), (30.0, 110.0, 100), (30.0, 110.0, -1)]
    df = spark.createDataFrame([(i, lat, lng, float(v)) for i, (lat, lng, v) in enumerate(rows)], "row_key int, lat double, lng double, speed double")
    df = df.withColumn("time", F.timestamp_seconds(F.lit(S)))
    assert sorted(r.row_key for r in lookups.sanitize_positions(df).collect()) == [1, 2]
    assert lookups.sanitize_positions(df, as_of_date="2024-01-02").count() == 0


def test_supervision_drops_missing_states(spark):
    rows = [(1, "1", "1"), (2, "1", None), (3, None, "1"), (4, "0", "1")]
    df = spark.createDataFrame(rows, "row_key int, audit_state string, manage_state string")
    assert [r.row_key for r in lookups.supervised(df).collect()] == [1]


def test_region_takes_lowest_id_and_keeps_rows(spark):
    ring = "112.9,34.6;113.1,34.6;113.1,34.8;112.9,34.8"
    areas = spark.createDataFrame(
        [(5, "five", 1, ring, 1), (3, "three", 1, ring, 1), (2, "closed", 1, ring, 0), (1, "other dept", 2, ring, 1)],
        "id int, city_name string, dept_id int, coords string, state int",
    )
    d = track(spark, [at(0, HOME), at(1, AWAY)])
    for options in ({}, {"max_broadcast": 0}, {"cell_deg": 5.0}, {"cell_deg": 5.0, "max_broadcast": 0}):
        out = spatial.tag_region(d, areas, **options).orderBy("row_key").collect()
        assert [(r.region_id, r.region_name) for r in out] == [("3", "three"), (None, None)]


def test_region_of_rows_with_one_key(spark):
    """No plan depends on a key of the rows."""
    ring = "112.9,34.6;113.1,34.6;113.1,34.8;112.9,34.8"
    areas = spark.createDataFrame([(i, f"a{i}", 1, ring.replace("112.9", f"112.{900 - i:03}"), 1) for i in range(1, 300)], "id int, city_name string, dept_id int, coords string, state int")
    d = track(spark, [at(0, HOME), at(1, AWAY)])
    for rows in (d.withColumn("row_key", F.lit(1)), d.drop("row_key")):
        out = spatial.tag_region(rows, areas).orderBy("time").collect()
        assert [r.region_id for r in out] == ["1", None]


def test_missing_coordinates_are_outside(spark):
    import pandas as pd
    from conftest import COLUMNS

    d = frame(spark, pd.DataFrame([(1, 1, 1, S, float("nan"), 34.7, 1.0, "1", "1")], columns=COLUMNS))
    d = d.withColumn("lng", F.lit(None).cast("double"))
    assert spatial.points_in_fences(d, worlds.rules(spark)).count() == 0


def test_alarm_enrichment(spark):
    times = [(1, S, S + 3605), (2, S, None), (3, None, S)]
    rows = [(i, 1, code, a, b, 113.0, 34.7, 113.0 if i == 1 else None, 34.7) for (i, a, b), code in zip(times, ("0118", "0118", "9"))]
    df = spark.createDataFrame(rows, "row_key int, dept_id int, illegal_type_code string, a bigint, b bigint, alarm_start_lng double, alarm_start_lat double, alarm_end_lng double, alarm_end_lat double")
    df = df.withColumns({"alarm_start_time": F.timestamp_seconds("a"), "alarm_end_time": F.timestamp_seconds("b")}).drop("a", "b")
    kinds = spark.createDataFrame(
        [(1, "0118", "short", "long", 1.0, 2.0, 3.0)],
        "dept_id int, illegal_type_code string, illegal_type_short_desc string, illegal_type_desc string, enterprise_score double, vehicle_score double, driver_score double",
    )
    out = {r.row_key: r for r in outputs.enrich_alarms(df, kinds, F.timestamp_seconds(F.lit(S))).collect()}
    assert (out[1].interval_time, out[1].interval_seconds, out[1].interval_distance) == ("1小时5分", 3605, 0.0)
    assert out[2].interval_time is None and secs(out[2].alarm_end_time) == S and out[2].interval_distance is None
    assert out[1].vehicle_score == 2.0 and out[3].vehicle_score is None
    assert (out[1].month_id, out[1].day_id, out[1].hour_id, out[1].scoring_year) == ("2024-01", "1", "8", 2024)
    assert len({r.uuid for r in out.values()}) == 3

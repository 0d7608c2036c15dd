"""Batch plans against a plain replay of the transitions, as one group per vehicle, in time slices, and with
salted instead of broadcast joins."""

from __future__ import annotations

from functools import partial

import pytest
import worlds
from conftest import frame, random_positions, replay

from haulwatch.plans import alarms, vehicles
from haulwatch.plans.off_route import alarm_off_route
from haulwatch.streaming import transitions
from haulwatch.streaming.transitions import metres

SLICED = [None, 40]
SEEDS = [1, 2, 3]


def secs(ts):
    from datetime import UTC

    return None if ts is None else int(ts.replace(tzinfo=UTC).timestamp())


def fired(df):
    return sorted(
        (r.vehicle_id, r.row_key, secs(r.alarm_start_time), secs(r.alarm_end_time)) for r in df.collect()
    )


def expected(rows):
    return sorted((r["vehicle_id"], r["row_key"], r.get("alarm_start_t"), r.get("alarm_end_t")) for r in rows)


@pytest.mark.parametrize("target", SLICED)
@pytest.mark.parametrize("seed", SEEDS)
def test_gps_gap(spark, seed, target):
    pdf = random_positions(seed, hot=300)
    got = fired(alarms.alarm_gps_gap(frame(spark, pdf), max_m=900.0, target_rows=target))
    want = expected(replay(pdf, partial(transitions.gps_gap, max_m=900.0)))
    assert got == want and len(got) > 4


@pytest.mark.parametrize("target", SLICED)
@pytest.mark.parametrize("seed", SEEDS)
def test_stop_history(spark, seed, target):
    pdf = random_positions(seed, hot=300)
    out = vehicles.stop_history(frame(spark, pdf), target_rows=target)
    got = sorted((r.vehicle_id, secs(r.stop_time), secs(r.start_time), r.stop_lng, r.start_lat) for r in out.collect())
    want = sorted(
        (r["vehicle_id"], r["stop_t"], r["start_t"], r["stop_lng"], r["lat"]) for r in replay(pdf, transitions.stop_history)
    )
    assert got == want and len(got) > 4


@pytest.mark.parametrize("target", SLICED)
@pytest.mark.parametrize("seed", SEEDS)
def test_vehicle_status(spark, seed, target):
    pdf = random_positions(seed, hot=300)
    from pyspark.sql import functions as F

    as_of = int(pdf.t.max())
    out = vehicles.vehicle_status(frame(spark, pdf), as_of=F.timestamp_seconds(F.lit(as_of)), offline_s=900, target_rows=target)
    got = sorted((r.vehicle_id, secs(r.time), r.vehicle_status, r.online_time, r.online_status) for r in out.collect())
    last = {r["vehicle_id"]: r for r in replay(pdf, partial(transitions.vehicle_status, offline_s=900))}
    want = sorted((v, r["t"], int(as_of - r["t"] > 900), r["online_time"], r["online_status"]) for v, r in last.items())
    assert got == want and any(w[3] > 0 for w in want)


def near(pdf, radius, points=worlds.SITES):
    pdf = pdf.copy()
    pdf["near"] = [[i for i, x, y in points if metres(r.lng, r.lat, x, y) < radius] for r in pdf.itertuples()]
    return pdf


@pytest.mark.parametrize("target, limit", [(None, None), (40, None), (None, 0), (40, 0)])
@pytest.mark.parametrize("seed", SEEDS)
def test_site_visits(spark, seed, target, limit, monkeypatch):
    if target is not None:  # stays of many periods
        monkeypatch.setattr(vehicles, "PERIOD_S", 700)
    pdf = random_positions(seed, hot=300)
    out = vehicles.site_visits(frame(spark, pdf), worlds.sites(spark), target_rows=target, max_broadcast=limit)
    got = sorted((r.vehicle_id, r.disposal_site_id, secs(r.enter_time), secs(r.exit_time)) for r in out.collect())
    rows = replay(near(pdf, 500.0), transitions.site_visits)
    assert got == sorted((r["vehicle_id"], int(r["site"]), r["enter_t"], r["exit_t"]) for r in rows) and len(got) > 10


@pytest.mark.parametrize("target, limit", [(None, None), (40, None), (40, 0)])
@pytest.mark.parametrize("seed", SEEDS)
def test_overspeed(spark, seed, target, limit):
    pdf = random_positions(seed, hot=600)
    rules = worlds.rules(spark, speed=1)
    out = alarms.alarm_overspeed(frame(spark, pdf), rules, cooldown_s=300, target_rows=target, max_broadcast=limit)
    want = []
    for fence, ring in worlds.FENCES:
        inside = pdf[[worlds.in_ring(r.lng, r.lat, ring) for r in pdf.itertuples()]].copy()
        inside["violating"], inside["minutes"] = inside.speed > 1, 2
        rows = replay(inside, partial(transitions.sustained, cooldown_s=300))
        want += [(r["vehicle_id"], r["row_key"], r["alarm_start_t"], r["alarm_end_t"], str(fence)) for r in rows]
    got = [(r.vehicle_id, r.row_key, secs(r.alarm_start_time), secs(r.alarm_end_time), r.fence_id) for r in out.collect()]
    assert sorted(got) == sorted(want) and len(got) > 4


@pytest.mark.parametrize("target", SLICED)
@pytest.mark.parametrize("match", ["not_permitted", "any_other"])
@pytest.mark.parametrize("seed", SEEDS)
def test_illegal_disposal(spark, seed, match, target):
    pdf = random_positions(seed, hot=300)
    sites = worlds.sites(spark)
    out = alarms.alarm_illegal_disposal(frame(spark, pdf), worlds.cards(spark), sites, cooldown_s=600, match=match, target_rows=target)
    allowed: dict[int, set] = {}
    for v, _, _, s, _ in worlds.CARDS:
        allowed.setdefault(v, set()).add(s)
    rows = near(pdf, 500.0).explode("near").dropna(subset="near")
    ok = {
        "not_permitted": lambda v, s: s not in allowed.get(v, {s}),
        "any_other": lambda v, s: any(p != s for p in allowed.get(v, ())),
    }[match]
    rows = rows[[ok(r.vehicle_id, r.near) for r in rows.itertuples()]]
    want = replay(rows, partial(transitions.spaced, cooldown_s=600), order=("t", "near", "row_key"))
    got = [(r.vehicle_id, r.row_key, secs(r.alarm_end_time), r.disposal_site_id) for r in out.collect()]
    assert sorted(got) == sorted((r["vehicle_id"], r["row_key"], r["t"], r["near"]) for r in want) and len(got) > 4


def route_flags(pdf, radius, max_speed):
    """What is near each report, permit by permit."""
    build, disposal = {i: (x, y) for i, x, y in worlds.BUILD}, {i: (x, y) for i, x, y in worlds.SITES}
    pdf = pdf.copy()
    columns = {"build": [], "disposal": [], "on_route": []}
    for r in pdf.itertuples():
        mine = [c for c in worlds.CARDS if c[0] == r.vehicle_id]

        def close(point, equal=False):
            d = metres(r.lng, r.lat, *point)
            return d < radius or (equal and d == radius)

        columns["build"].append([c[1] for c in mine if r.speed < max_speed and close(build[c[2]])])
        columns["disposal"].append([c[1] for c in mine if close(disposal[c[3]])])
        columns["on_route"].append([c[1] for c in mine if any(close(v, True) for line in worlds.ROUTES[c[4]] for v in line)])
    return pdf.assign(**columns)


@pytest.mark.parametrize("target, limit", [(None, None), (60, None), (60, 0)])
@pytest.mark.parametrize("seed", [1, 2])
def test_off_route(spark, seed, target, limit):
    pdf = random_positions(seed, hot=500)
    options = {"dwell_s": 20, "off_minutes": 1, "cooldown_s": 300}
    out = alarm_off_route(
        frame(spark, pdf), worlds.permits(spark), radius_m=330.0, max_speed=31.0, target_rows=target, max_broadcast=limit, **options
    )
    want = replay(route_flags(pdf, 330.0, 31.0), partial(transitions.off_route, **options))
    got = [(r.vehicle_id, r.row_key, secs(r.alarm_start_time), secs(r.alarm_end_time), r.permit_id) for r in out.collect()]
    assert sorted(got) == sorted(
        (r["vehicle_id"], r["row_key"], r["alarm_start_t"], r["alarm_end_t"], r["permit_id"]) for r in want
    )
    assert len(got) > 4


@pytest.mark.parametrize("target", SLICED)
def test_fences_together(spark, target):
    d = frame(spark, random_positions(4, hot=200))
    hours = {"start_date": "08:00", "end_date": "17:30"}
    rules = worlds.rules(spark, **hours), worlds.rules(spark), worlds.rules(spark, speed=10)
    detectors = alarms.alarm_work_time, alarms.alarm_restricted_zone, alarms.alarm_overspeed
    one_by_one = [f(d, r, cooldown_s=300) for f, r in zip(detectors, rules)]
    got = alarms.alarm_fences(d, *rules, cooldown_s=300, target_rows=target).collect()
    want = [r for df in one_by_one for r in df.collect()]

    def keys(rows):
        return sorted((r.illegal_type_code, r.vehicle_id, r.fence_id, r.row_key, r.alarm_start_time) for r in rows)

    assert keys(got) == keys(want) and len({r.illegal_type_code for r in got}) == 3


@pytest.mark.parametrize("options", [{}, {"cell_deg": 0.5}, {"cell_deg": 0.5, "max_broadcast": 0}])
def test_off_route_flag(spark, options):
    from haulwatch.operators.spatial import flag_off_route

    pdf = random_positions(6)
    d = frame(spark, pdf)
    out = flag_off_route(d, worlds.cards(spark), 330.0, ("dept_id", "vehicle_id"), **options)
    got = {r.row_key: r.off_route for r in out.collect()}
    want = {r.row_key: not r.on_route for r in route_flags(pdf, 330.0, 99.0).itertuples()}
    assert got == want and 0 < sum(got.values()) < len(got)

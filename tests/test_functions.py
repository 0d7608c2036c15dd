"""Scalars at their boundaries."""

from __future__ import annotations

import random

import pytest
import worlds
from conftest import DEGREE_M, S
from pyspark.sql import functions as F

from haulwatch.functions import geo
from haulwatch.functions.frames import decode_frames
from haulwatch.functions.timefn import duration_text, in_daily_range, in_effective_range, parse_time, partition_ids
from haulwatch.streaming.transitions import metres

FRAME = "020000260130072526580001000280000000000302117AE006BDC4E00064016D010E24010508153001040001E24002020195E7"


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_coordinates(spark):
    lat, lng = F.lit(34.7), F.lit(113.1)
    gcj, bd = geo.wgs2gcj(lat, lng), geo.wgs2bd(lat, lng)
    back = geo.bd2gcj(*bd)
    r = one(spark, a=gcj[0], b=gcj[1], c=bd[0], d=bd[1], e=back[0], f=back[1])
    assert (r.a, r.b) == pytest.approx((34.69911720025154, 113.10650065626423), abs=1e-9)
    assert (r.c, r.d) == pytest.approx((34.704802286326824, 113.11311488048605), abs=1e-9)
    assert (r.e, r.f) == pytest.approx((r.a, r.b), abs=1e-5)


def test_distance(spark):
    r = one(
        spark,
        a=geo.distance_m(F.lit(113.1), F.lit(34.7), F.lit(113.105), F.lit(34.7)),
        b=geo.distance_m(F.lit(113.1), F.lit(34.7), F.lit(113.1), F.lit(34.72)),
        c=geo.distance_m(F.lit(0.0), F.lit(0.0), F.lit(180.0), F.lit(0.0)),
        d=geo.distance_m(F.lit(113.1), F.lit(34.7), F.lit(None).cast("double"), F.lit(34.7)),
    )
    assert r.a == pytest.approx(457.0912316) and r.b == pytest.approx(2223.8985329)
    assert r.c == pytest.approx(20015086.796) and r.d is None
    assert metres(113.1, 34.7, 113.105, 34.7) == pytest.approx(r.a)


@pytest.mark.parametrize(
    "start, end, times",
    [
        ("05:00", "23:00", {"05:00:00": False, "05:00:01": True, "23:00:00": False, "22:59:59": True}),
        ("20:30", "05:10", {"20:00:00": True, "05:09:00": False, "04:59:59": True, "19:59:59": False}),
        ("08:10", "08:50", {"08:30:00": False}),
        ("06:00", "06:00", {"00:00:00": True, "06:00:00": True}),
    ],
)
def test_daily_range(spark, start, end, times):
    for text, want in times.items():
        assert one(spark, x=in_daily_range(parse_time(F.lit(f"2024-01-05 {text}")), F.lit(start), F.lit(end))).x is want


def test_effective_range_and_bad_text(spark):
    def inside(text):
        time = parse_time(F.lit(text))
        return one(spark, x=in_effective_range(time, F.lit("2024-01-01 01:00:00"), F.lit("2024-01-01 02:00:00"))).x

    assert [inside(f"2024-01-01 {t}") for t in ("01:00:00", "01:00:01", "02:00:00")] == [False, True, False]
    assert inside("yesterday") is None


@pytest.mark.parametrize(
    "seconds, text", [(3599, "59分"), (3605, "1小时5分"), (7260, "2小时0分"), (0, "0分"), (None, None)]
)
def test_duration(spark, seconds, text):
    assert one(spark, x=duration_text(F.lit(seconds).cast("long"))).x == text


def test_partition_ids(spark):
    r = partition_ids(spark.range(1).select(F.timestamp_seconds(F.lit(S)).alias("time")), "time").first()
    assert (r.month_id, r.day_id, r.hour_id) == ("2024-01", "1", "8")


def test_polygons_against_plain_loop(spark):
    rng = random.Random(1)
    ring = worlds.FENCES[1][1]
    points = [(113.0 + rng.uniform(0, 0.016), 34.698 + rng.uniform(0, 0.013)) for _ in range(500)] + [tuple(v) for v in ring]
    df = spark.createDataFrame(points, "lng double, lat double")
    text = ";".join(f"{x},{y}" for x, y in ring)
    as_json = str([list(v) for v in ring])
    out = df.select(
        "lng", "lat",
        geo.in_polygon("lng", "lat", geo.parse_ring_text(F.lit(text))).alias("a"),
        geo.in_polygon("lng", "lat", geo.parse_ring_json(F.lit(as_json))).alias("b"),
        geo.in_polygon("lng", F.lit(None).cast("double"), geo.parse_ring_json(F.lit(as_json))).alias("c"),
    ).collect()
    for r in out:
        assert r.a == r.b == worlds.in_ring(r.lng, r.lat, ring) and r.c is False
    assert 50 < sum(r.a for r in out) < 450


def test_off_route_is_inclusive(spark):
    step = 500.0 / DEGREE_M
    routes = F.array(F.struct(F.lit(113.0).alias("lng"), F.lit(34.7).alias("lat")))
    away = geo.distance_m(F.lit(113.0), F.lit(34.7 + step), F.lit(113.0), F.lit(34.7))
    exact = one(spark, x=away).x
    r = one(
        spark,
        at=geo.off_route(F.lit(113.0), F.lit(34.7 + step), routes, exact),
        beyond=geo.off_route(F.lit(113.0), F.lit(34.7 + step), routes, exact - 1e-6),
        near=geo.off_route(F.lit(113.0), F.lit(34.7), routes),
    )
    assert (r.at, r.beyond, r.near) == (False, True, False)


def decode(spark, *frames):
    df = spark.createDataFrame([(i, f) for i, f in enumerate(frames)], "i int, frame string")
    return {r.i: r for r in decode_frames(df).collect()}


def test_frame(spark):
    r = decode(spark, FRAME)[0]
    assert r.devid == "13007252658" and r.time == "2024-01-05 08:15:30"
    assert (r.lat, r.lng, r.point) == (34.7, 113.1, "34.7,113.1")
    assert (r.speed, r.pos, r.altitude) == ("36.5", "270", 100)
    assert (r.sharpturn, r.brake, r.accflag, r.gpsflag) == ("1", "1", "1", "1")
    assert (r.gpsdistance, r.mainoilper, r.auxiliaryflag) == ("12345.60", "40.5", "0")
    assert r.checksum_ok and r.flow_id == 1 and r.subpackages is None and len(r["items"]) == 2


def checked(hexes: str) -> str:
    x = 0
    for i in range(0, len(hexes), 2):
        x ^= int(hexes[i : i + 2], 16)
    return hexes + f"{x:02X}"


def test_frame_variants(spark):
    bare = FRAME[:-2]
    split = bare[:4] + "2026" + bare[8:24] + "00030002" + bare[24:]
    no_items = "0200001C" + bare[8 : 24 + 56]
    early = bare.replace("240105081530", "090105081530")
    long_item = no_items.replace("0200001C", "0200001F") + "01FF00"
    repeated = "0200002C" + bare[8:] + "010400000014"
    out = decode(
        spark, bare + "00", "7e" + FRAME.lower() + "7e", checked(split), checked(no_items), checked(early),
        checked(long_item), FRAME.replace("0200", "0704", 1), checked(repeated),
    )
    assert not out[0].checksum_ok and out[0].lat == 34.7
    assert out[1].checksum_ok and out[1].speed == "36.5"
    assert (out[2].subpackages, out[2].subpackage_seq, out[2].lat, out[2].checksum_ok) == (3, 2, 34.7, True)
    assert (out[3].gpsdistance, out[3].mainoilper) == ("0", None) and list(out[3]["items"]) == []
    assert out[4].time == "2009-01-05 08:15:30"
    assert list(out[5]["items"]) == [] and out[5].gpsdistance == "0"
    assert 6 not in out
    assert out[7].gpsdistance == "2.00" and len(out[7]["items"]) == 3


def test_fence_cells_follow_the_fences(spark):
    from haulwatch.operators.spatial import points_in_fences, polygon_grid

    ring = geo.parse_ring_json("coords")
    rules = worlds.rules(spark)
    cell, limit = polygon_grid(rules, ring)
    assert 0.004 < cell < 0.011 and limit > 0
    assert polygon_grid(rules.filter("false"), ring)[0] == 0.05
    assert polygon_grid(rules, ring, cell_deg=1e-6)[1] == 0  # far too many cells to broadcast
    rng = random.Random(2)
    rows = [(i, 1, 112.99 + rng.uniform(0, 0.03), 34.69 + rng.uniform(0, 0.03)) for i in range(800)]
    d = spark.createDataFrame(rows, "row_key int, dept_id int, lng double, lat double")
    want = sorted((i, f) for i, _, x, y in rows for f, ring in worlds.FENCES if worlds.in_ring(x, y, ring))
    for options in ({}, {"cell_deg": 0.001}, {"cell_deg": 1.0}, {"max_broadcast": 0}):
        out = points_in_fences(d, rules, **options).select("row_key", "condition_id").collect()
        assert sorted(map(tuple, out)) == want

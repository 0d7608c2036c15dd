"""Small dimension tables around the spots of ``random_positions``."""

from __future__ import annotations

import json

SITES = [(10, 113.0, 34.7), (11, 113.006, 34.705), (12, 113.012, 34.7), (13, 113.0125, 34.7005)]
BUILD = [(20, 113.018, 34.705), (21, 113.006, 34.705)]
FENCES = [
    (1, [[112.998, 34.698], [113.002, 34.698], [113.002, 34.702], [112.998, 34.702]]),
    (2, [[113.003, 34.701], [113.011, 34.7], [113.014, 34.708], [113.004, 34.709], [113.007, 34.705]]),
]
ROUTES = [[[[113.0, 34.7], [113.006, 34.705]], [[113.012, 34.7]]], [[[113.018, 34.705], [113.024, 34.7]]]]
# (vehicle, permit, build site, disposal site, route)
CARDS = [(1, 100, 20, 10, 0), (1, 101, 21, 12, 1), (2, 102, 20, 11, 0), (3, 103, 21, 10, 1)]


def dept(vehicle: int) -> int:
    return 1 + vehicle % 2


def sites(spark):
    rows = [(i, f"site {i}", d, x, y) for i, x, y in SITES for d in (1, 2)]
    return spark.createDataFrame(rows, "disposal_site_id bigint, disposal_site_name string, dept_id int, lng double, lat double")


def one_site_per_id(spark):
    return sites(spark).dropDuplicates(["disposal_site_id"])


def build(spark):
    return spark.createDataFrame(BUILD, "build_site_id bigint, lng double, lat double")


def cards(spark):
    rows = [(v, dept(v), p, b, s, json.dumps(ROUTES[r]), 0) for v, p, b, s, r in CARDS]
    return spark.createDataFrame(
        rows, "vehicle_id int, dept_id int, permit_id bigint, build_site_id bigint, disposal_site_id bigint, coords string, state int"
    )


def permits(spark):
    from haulwatch.operators.lookups import permit_routes

    return permit_routes(cards(spark), build(spark), one_site_per_id(spark).drop("dept_id"))


def rules(spark, **columns):
    values = {"alarm_date": 2, **columns}
    names = list(values)
    kinds = {int: "int", float: "double", str: "string"}
    ddl = "condition_id int, dept_id int, coords string, " + ", ".join(f"{n} {kinds[type(v)]}" for n, v in values.items())
    rows = [(i, d, json.dumps(ring), *[values[n] for n in names]) for i, ring in FENCES for d in (1, 2)]
    return spark.createDataFrame(rows, ddl)


def in_ring(lng, lat, ring):
    inside = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (x1 > lng) != (x2 > lng) and lat < (y2 - y1) * (lng - x1) / (x2 - x1) + y1:
            inside = not inside
    return inside

"""Streaming forms of the detectors: narrow work and static joins in the JVM, then one keyed-state step.

Input is a streaming DataFrame of enriched positions with ``row_key``. State lives in the state store; each result
equals that of the batch plan as long as a vehicle's reports arrive in time order, or with ``delay_s`` at most so late.
Every result carries the triggering report as JSON in ``report``. ``**state`` goes to ``keyed``: with ``expire_s``, silent
keys lose their state; with ``delay_s``, reports are put in order first; with ``late=True``, late reports come out, too, as rows
with ``late_t``.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwatch.functions.timefn import epoch
from haulwatch.operators.lookups import lookup, one_per_key, permitted_sites, supervised, valid_sites
from haulwatch.operators.sequence import VEHICLE
from haulwatch.operators.spatial import near_ids, points_in_fences, route_points
from haulwatch.plans import alarms
from haulwatch.plans.off_route import PERMIT, with_permit_id
from haulwatch.streaming import transitions
from haulwatch.streaming.keyed import EVENT_TIME, StatusStep, keyed, timed

ALARM_FIELDS = {
    "row_key": "bigint", "alarm_start_t": "bigint", "alarm_start_lng": "double", "alarm_start_lat": "double",
    "alarm_end_t": "bigint", "alarm_end_lng": "double", "alarm_end_lat": "double", "report": "string",
}


def _report(d: DataFrame) -> DataFrame:
    """Whole seconds in ``t`` and the row itself as JSON in ``report``."""
    whole = F.to_json(F.struct(*d.columns), {"timestampFormat": "yyyy-MM-dd HH:mm:ss"})
    return timed(d.filter(F.col("vehicle_id").isNotNull()).withColumns({"t": epoch("time"), "report": whole}))


def _as_alarm(df: DataFrame, code: str) -> DataFrame:
    times = {f"alarm_{s}_time": F.timestamp_seconds(f"alarm_{s}_t") for s in ("start", "end")}
    return df.withColumns({"illegal_type_code": F.lit(code), **times}).drop("alarm_start_t", "alarm_end_t")


POINT = "row_key: bigint, t: bigint, lng: double, lat: double, report: string"
FENCES = "fences map<string, struct<active: bigint, fired: bigint>>"
CORE = ["t", "row_key", "lng", "lat", "report", EVENT_TIME]


def stream_no_register(d: DataFrame, card: DataFrame, **state) -> DataFrame:
    without = lookup(_report(supervised(d)), card.filter("state = 0").select(*VEHICLE), VEHICLE, "left_anti")
    out = keyed(without.select(*VEHICLE, *CORE), VEHICLE, transitions.first_of_day, "day bigint", ALARM_FIELDS, **state)
    return _as_alarm(out, alarms.NO_REGISTER)


def stream_gps_gap(d: DataFrame, max_m: float = 2000.0, **state) -> DataFrame:
    d = _report(supervised(d)).select(*VEHICLE, *CORE)
    step = partial(transitions.gps_gap, max_m=max_m)
    return _as_alarm(keyed(d, VEHICLE, step, f"last struct<{POINT}>, day bigint", ALARM_FIELDS, **state), alarms.GPS_GAP)


def _stream_fence(d: DataFrame, rules: DataFrame, violating: Column, code: str, cooldown_s: int, **state) -> DataFrame:
    inside = points_in_fences(_report(supervised(d)), one_per_key(rules, ["dept_id", "condition_id"]))
    flagged = inside.select(
        *VEHICLE, "condition_id", F.lit(code).alias("kind"), *CORE, F.coalesce(violating, F.lit(False)).alias("violating"),
        F.col("rule.alarm_date").alias("minutes"),
    )
    return _fence_alarms(flagged, cooldown_s, code != alarms.FILE_CONTROL, **state)


def _fence_alarms(flagged: DataFrame, cooldown_s: int, from_start: bool = True, **state) -> DataFrame:
    """One state for all fences of a vehicle."""
    id_type = flagged.schema["condition_id"].dataType.simpleString()
    fields = {"condition_id": id_type, "kind": "string", **ALARM_FIELDS}
    step = partial(transitions.per_fence, cooldown_s=cooldown_s, from_start=from_start)
    out = _as_alarm(keyed(flagged, VEHICLE, step, FENCES, fields, order=("t", "row_key", "condition_id", "kind"), **state), "")
    return out.withColumns({"fence_id": F.col("condition_id").cast("string"), "illegal_type_code": F.col("kind")}).drop("kind")


def stream_work_time(d: DataFrame, rules: DataFrame, cooldown_s: int = alarms.COOLDOWN_S, **state) -> DataFrame:
    return _stream_fence(d, rules, alarms.work_time_broken(), alarms.WORK_TIME, cooldown_s, **state)


def stream_restricted_zone(d: DataFrame, rules: DataFrame, cooldown_s: int = alarms.COOLDOWN_S, **state) -> DataFrame:
    return _stream_fence(d, rules, alarms.restricted_zone_broken(), alarms.RESTRICTED_ZONE, cooldown_s, **state)


def stream_overspeed(d: DataFrame, rules: DataFrame, cooldown_s: int = alarms.COOLDOWN_S, **state) -> DataFrame:
    return _stream_fence(d, rules, alarms.overspeed_broken(), alarms.OVERSPEED, cooldown_s, **state)


def stream_file_control(d: DataFrame, rules: DataFrame, cooldown_s: int = alarms.COOLDOWN_S, **state) -> DataFrame:
    return _stream_fence(d, rules, alarms.file_control_broken(), alarms.FILE_CONTROL, cooldown_s, **state)


def stream_fences(
    d: DataFrame, work_time: DataFrame, restricted: DataFrame, over_speed: DataFrame, cooldown_s: int = alarms.COOLDOWN_S,
    **state,
) -> DataFrame:
    """Work-time, restricted-zone and overspeed alarms in one query with one state store."""
    inside = points_in_fences(_report(supervised(d)), alarms.fence_rules(work_time, restricted, over_speed))
    inside = inside.withColumn("kind", F.col("rule.kind"))
    flagged = inside.select(
        *VEHICLE, "condition_id", "kind", *CORE, F.coalesce(alarms.any_fence_broken(), F.lit(False)).alias("violating"),
        F.col("rule.alarm_date").alias("minutes"),
    )
    return _fence_alarms(flagged, cooldown_s, **state)


def stream_illegal_disposal(
    d: DataFrame, card: DataFrame, sites: DataFrame, radius_m: float = 500.0, cooldown_s: int = alarms.COOLDOWN_S,
    match: str = "not_permitted", dept_id: int | None = None, **state,
) -> DataFrame:
    sites = valid_sites(sites, dept_id)
    permits = permitted_sites(card, sites).dropna(subset=["lng", "lat"])
    near = alarms.illegal_site_visits(_report(supervised(d)), permits, sites, radius_m, match)
    candidates = near.select(*VEHICLE, *CORE, "disposal_site_id")
    fields = {**ALARM_FIELDS, "disposal_site_id": "bigint"}
    step = partial(transitions.spaced, cooldown_s=cooldown_s)
    out = keyed(candidates, VEHICLE, step, "fired bigint", fields, order=("t", "disposal_site_id", "row_key"), **state)
    return _as_alarm(out, alarms.ILLEGAL_DISPOSAL)


def stream_site_visits(
    d: DataFrame, sites: DataFrame, radius_m: float = 500.0, dwell_s: int = 180, **state
) -> DataFrame:
    points = near_ids(_report(supervised(d)), sites, radius_m, ["dept_id"], "disposal_site_id", "near")
    step = partial(transitions.site_visits, dwell_s=dwell_s)
    fields = {"site": "string", "enter_t": "bigint", "exit_t": "bigint"}
    sites_state = "sites map<string, struct<enter: bigint, confirmed: boolean, exit: bigint>>"
    out = keyed(points.select(*VEHICLE, "t", "row_key", "near", EVENT_TIME), VEHICLE, step, sites_state, fields, **state)
    return out.select(
        *VEHICLE, *_late(out),
        F.col("site").cast(sites.schema["disposal_site_id"].dataType).alias("disposal_site_id"),
        F.timestamp_seconds("enter_t").alias("enter_time"),
        F.timestamp_seconds("exit_t").alias("exit_time"),
    )


def stream_off_route(
    d: DataFrame, permits: DataFrame, radius_m: float = 500.0, dwell_s: int = 180, max_speed: float = 15.0,
    off_minutes: int = 3, cooldown_s: int = alarms.COOLDOWN_S, **state,
) -> DataFrame:
    permits = with_permit_id(permits)
    points = _report(supervised(d.drop("permit_id")))
    for side in ("build", "disposal"):
        site = permits.select(*PERMIT, f"{side}_lng", f"{side}_lat").distinct()
        points = near_ids(points, site, radius_m, VEHICLE, "permit_id", side, f"{side}_lng", f"{side}_lat")
    slow = F.col("speed") < max_speed
    points = points.withColumn("build", F.when(slow, F.col("build")).otherwise(F.slice("build", 1, 0)))
    points = near_ids(points, route_points(permits, PERMIT), radius_m, VEHICLE, "permit_id", "on_route", inclusive=True)
    step = partial(transitions.off_route, dwell_s=dwell_s, off_minutes=off_minutes, cooldown_s=cooldown_s)
    fields = {**ALARM_FIELDS, "permit_id": "bigint"}
    narrow = points.select(*VEHICLE, *CORE, "build", "disposal", "on_route")
    held = f"dwell map<string, bigint>, held bigint, off struct<{POINT}, permit_id: bigint>, fired bigint"
    return _as_alarm(keyed(narrow, VEHICLE, step, held, fields, **state), alarms.OFF_ROUTE)


def stream_stop_history(d: DataFrame, min_s: int = 180, silence_s: int = 180, **state) -> DataFrame:
    points = _report(d).select(*VEHICLE, *CORE, "speed")
    step = partial(transitions.stop_history, min_s=min_s, silence_s=silence_s)
    fields = {"stop_t": "bigint", "stop_lng": "double", "stop_lat": "double", "start_t": "bigint", "lng": "double",
              "lat": "double", "report": "string"}
    stop = "stop struct<t: bigint, lng: double, lat: double, seen: bigint>"
    out = keyed(points, VEHICLE, step, stop, fields, **state)
    return out.select(
        *VEHICLE, *_late(out), F.timestamp_seconds("stop_t").alias("stop_time"), "stop_lng", "stop_lat",
        F.timestamp_seconds("start_t").alias("start_time"), F.col("lng").alias("start_lng"),
        F.col("lat").alias("start_lat"), "report",
    )


def _late(out: DataFrame) -> list[str]:
    return [c for c in out.columns if c == "late_t"]


def stream_vehicle_status(
    d: DataFrame, offline_s: int = 180, still_s: int = 180, grace_s: int = 30, seed: DataFrame | None = None, **state
) -> DataFrame:
    """Status changes: per batch the latest row of each vehicle that reported, and a row when one falls silent.

    ``seed`` gives the known state of vehicles at start: ``dept_id, vehicle_id, t, online_time``. A silent vehicle is offline
    when the largest time is ``grace_s`` seconds (with ``delay_s``: so many) past ``offline_s``.
    """
    points = _report(d).select(*VEHICLE, *CORE, "speed")
    fields = {"t": "bigint", "row_key": "bigint", "vehicle_status": "int", "online_time": "bigint",
              "online_status": "int", "report": "string"}
    step = partial(transitions.vehicle_status, offline_s=offline_s, still_s=still_s)
    seeds = None if seed is None else seed.select(*VEHICLE, "t", "online_time").groupBy(*VEHICLE)
    held = "seen bigint, online bigint, zero bigint, offline boolean, moving int"
    out = keyed(
        points, VEHICLE, step, held, fields, seed=seeds, processor=StatusStep, last_only=True,
        offline_s=offline_s, grace_s=grace_s, **state,
    )
    return out.withColumn("time", F.timestamp_seconds("t")).drop("t")

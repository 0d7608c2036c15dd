"""Violation detectors over enriched positions.

Input positions need ``dept_id, vehicle_id, time, lng, lat, speed, audit_state, manage_state`` and a unique
``row_key``; all other columns are copied to the alarm. Times are compared in whole seconds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwatch.functions.exprs import ColumnLike, col
from haulwatch.functions.geo import distance_m
from haulwatch.functions.timefn import in_daily_range, in_effective_range
from haulwatch.operators.asof import as_of
from haulwatch.operators.blocks import cooldown, first_per_day, sustained
from haulwatch.operators.lookups import lookup, one_per_key, permitted_sites, salted_join, supervised, valid_sites
from haulwatch.operators.sequence import TARGET_ROWS, VEHICLE, ordered_scan, prepare
from haulwatch.operators.spatial import lowest_sites, match_sites, points_in_fences

# Violation codes.
OVERSPEED = "0110"
NO_REGISTER = "0111"
OFF_ROUTE = "0112"
RESTRICTED_ZONE = "0115"
WORK_TIME = "0116"
GPS_GAP = "0118"
FILE_CONTROL = "0119"
ILLEGAL_DISPOSAL = "0123"

COOLDOWN_S = 7200
HELPERS = ("epoch_s", "hot", "slice", "prev", "next", "mark", "rule", "site", "active_t")

Point = tuple[ColumnLike | None, ColumnLike | None, ColumnLike | None]
NOWHERE: Point = (None, None, None)


def as_alarm(df: DataFrame, code: str, start: Point = NOWHERE, end: Point = NOWHERE, **extra: Column) -> DataFrame:
    """Copy the position and add the alarm columns; ``start`` and ``end`` are ``(epoch_s, lng, lat)``."""

    def part(side: str, point: Point) -> list[Column]:
        t, lng, lat = (F.lit(None) if x is None else col(x) for x in point)
        return [
            F.timestamp_seconds(t.cast("long")).alias(f"alarm_{side}_time"),
            lng.cast("double").alias(f"alarm_{side}_lng"),
            lat.cast("double").alias(f"alarm_{side}_lat"),
        ]

    kept = [c for c in df.columns if c not in HELPERS and c not in extra]
    return df.select(
        *kept,
        F.lit(code).alias("illegal_type_code"),
        *part("start", start),
        *part("end", end),
        *[c.alias(name) for name, c in extra.items()],
    )


def alarm_no_register(d: DataFrame, card: DataFrame, **kw) -> DataFrame:
    """Vehicle without a valid register card: one alarm per vehicle and day."""
    valid = card.filter("state = 0").select(*VEHICLE)
    without = lookup(prepare(supervised(d), target_rows=None), valid, VEHICLE, "left_anti", **kw)
    return as_alarm(first_per_day(without, VEHICLE), NO_REGISTER, start=("epoch_s", "lng", "lat"))


def alarm_no_register_as_of(d: DataFrame, card_history: DataFrame, **kw) -> DataFrame:
    """``alarm_no_register`` with the cards (``state``) as they were at the time of each position."""
    held = as_of(prepare(supervised(d), target_rows=None), card_history, VEHICLE, "_card", **kw)
    without = held.filter(F.coalesce(F.col("_card.state") != 0, F.lit(True))).drop("_card")
    return as_alarm(first_per_day(without, VEHICLE), NO_REGISTER, start=("epoch_s", "lng", "lat"))


def alarm_gps_gap(d: DataFrame, max_m: float = 2000.0, target_rows: int | None = TARGET_ROWS) -> DataFrame:
    """Jump of more than ``max_m`` between consecutive reports: the first of each vehicle and day of arrival.

    The alarm carries the report before the jump.
    """
    d = prepare(supervised(d), target_rows=target_rows)
    carried = [c for c in d.columns if c not in (*VEHICLE, "epoch_s", "row_key", "hot", "slice")]
    jumps = ordered_scan(d, VEHICLE, carried).filter(distance_m("lng", "lat", "prev.lng", "prev.lat") > max_m)
    jumps = jumps.select(*VEHICLE, "epoch_s", "row_key", "lng", "lat", "prev")
    first = first_per_day(jumps, VEHICLE).select(
        *VEHICLE, "prev.*", *[F.col(c).alias(f"_end_{c}") for c in ("epoch_s", "lng", "lat")]
    )
    return as_alarm(first, GPS_GAP, start=("epoch_s", "lng", "lat"), end=("_end_epoch_s", "_end_lng", "_end_lat")).drop(
        "_end_epoch_s", "_end_lng", "_end_lat"
    )


def sustained_in_fence(
    d: DataFrame, rules: DataFrame, violating: Column, key: Sequence[str] = (*VEHICLE, "condition_id"),
    target_rows: int | None = TARGET_ROWS, **kw,
) -> DataFrame:
    """Positions inside a rule's fence that have broken the rule for longer than its ``alarm_date`` minutes."""
    rules = one_per_key(rules, ["dept_id", "condition_id"])
    inside = points_in_fences(prepare(supervised(d), target_rows=target_rows), rules, **kw)
    return sustained(inside, key, violating, F.col("rule.alarm_date"))


def _fence_alarm(d, rules, violating, code, cooldown_s, from_start=True, **kw) -> DataFrame:
    key = [*VEHICLE, "condition_id"]
    fired = cooldown(sustained_in_fence(d, rules, violating, key, **kw), key, cooldown_s)
    fence = F.col("condition_id").cast("string")
    if from_start:
        return as_alarm(fired, code, start=("active_t", "lng", "lat"), end=("epoch_s", None, None), fence_id=fence)
    return as_alarm(fired, code, start=("epoch_s", "lng", "lat"), fence_id=fence)


def work_time_broken() -> Column:
    return ~in_daily_range("time", "rule.start_date", "rule.end_date") & (F.col("speed") > 0)


def alarm_work_time(d: DataFrame, rules: DataFrame, cooldown_s: int = COOLDOWN_S, **kw) -> DataFrame:
    """Moving inside the fence outside its working hours."""
    return _fence_alarm(d, rules, work_time_broken(), WORK_TIME, cooldown_s, **kw)


def restricted_zone_broken() -> Column:
    return F.col("speed") > 0


def alarm_restricted_zone(d: DataFrame, rules: DataFrame, cooldown_s: int = COOLDOWN_S, **kw) -> DataFrame:
    """Moving inside a restricted zone."""
    return _fence_alarm(d, rules, restricted_zone_broken(), RESTRICTED_ZONE, cooldown_s, **kw)


def overspeed_broken() -> Column:
    return F.col("speed") > F.col("rule.speed")


def alarm_overspeed(d: DataFrame, rules: DataFrame, cooldown_s: int = COOLDOWN_S, **kw) -> DataFrame:
    """Faster than the fence's limit."""
    return _fence_alarm(d, rules, overspeed_broken(), OVERSPEED, cooldown_s, **kw)


def file_control_broken() -> Column:
    return in_effective_range("time", "rule.start_date", "rule.end_date") & (F.col("speed") > 0)


def alarm_file_control(d: DataFrame, rules: DataFrame, cooldown_s: int = COOLDOWN_S, **kw) -> DataFrame:
    """Moving inside the fence while a control document is in force."""
    return _fence_alarm(d, rules, file_control_broken(), FILE_CONTROL, cooldown_s, from_start=False, **kw)


FENCE_KINDS = {WORK_TIME: work_time_broken, RESTRICTED_ZONE: restricted_zone_broken, OVERSPEED: overspeed_broken}
RULE_FIELDS = {"start_date": "string", "end_date": "string", "speed": "double"}


def fence_rules(work_time: DataFrame, restricted: DataFrame, over_speed: DataFrame) -> DataFrame:
    """The three kinds of rules as one table; ``kind`` is the violation code."""
    kinds = []
    for code, rules in ((WORK_TIME, work_time), (RESTRICTED_ZONE, restricted), (OVERSPEED, over_speed)):
        rules = one_per_key(rules, ["dept_id", "condition_id"])
        fields = [(F.col(c) if c in rules.columns else F.lit(None)).cast(t).alias(c) for c, t in RULE_FIELDS.items()]
        kinds.append(rules.select("dept_id", "condition_id", "alarm_date", "coords", F.lit(code).alias("kind"), *fields))
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2])


def any_fence_broken() -> Column:
    broken = F.lit(False)
    for code, rule in FENCE_KINDS.items():
        broken = F.when(F.col("rule.kind") == code, rule()).otherwise(broken)
    return broken


def alarm_fences(
    d: DataFrame, work_time: DataFrame, restricted: DataFrame, over_speed: DataFrame, cooldown_s: int = COOLDOWN_S,
    target_rows: int | None = TARGET_ROWS, **kw,
) -> DataFrame:
    """Work-time, restricted-zone and overspeed alarms in one pass: one fence join, one scan in time order."""
    inside = points_in_fences(prepare(supervised(d), target_rows=target_rows), fence_rules(work_time, restricted, over_speed), **kw)
    inside = inside.withColumn("kind", F.col("rule.kind"))
    key = [*VEHICLE, "condition_id", "kind"]
    fired = cooldown(sustained(inside, key, any_fence_broken(), F.col("rule.alarm_date")), key, cooldown_s)
    out = as_alarm(fired, "", start=("active_t", "lng", "lat"), end=("epoch_s", None, None), fence_id=F.col("condition_id").cast("string"))
    return out.withColumn("illegal_type_code", F.col("kind")).drop("kind")


def illegal_site_visits(
    d: DataFrame, permits: DataFrame, sites: DataFrame, radius_m: float = 500.0, match: str = "not_permitted", lowest: bool = False, **kw
) -> DataFrame:
    """Positions of permit holders near a disposal site they may not use.

    ``match="not_permitted"`` takes sites outside the vehicle's permits; ``"any_other"`` takes every site that
    differs from at least one permitted site. ``lowest`` leaves out sites that are not the lowest such of a position.
    """
    allowed = permits.select(*VEHICLE, "disposal_site_id").distinct()
    limit = {"max_broadcast": kw["max_broadcast"]} if "max_broadcast" in kw else {}

    def near(points: DataFrame, passed_over: int) -> DataFrame:
        """``passed_over``: how many sites at most a position's lowest ids are that do not count."""
        if lowest:
            pairs = lowest_sites(points, sites, radius_m, "disposal_site_id", passed_over + 1, **kw)
        else:
            pairs = match_sites(points, sites, radius_m, **kw)
        pairs = pairs.withColumn("disposal_site_id", F.col("target.disposal_site_id"))
        return pairs.drop("distance").withColumnRenamed("target", "site")

    # Permit holders first: the others' positions meet no site.
    if match == "not_permitted":
        holders = salted_join(d, allowed.select(*VEHICLE).distinct(), VEHICLE, "left_semi", **limit)
        most = allowed.groupBy(*VEHICLE).count().agg(F.max("count")).first()[0] if lowest else None
        return salted_join(near(holders, most or 0), allowed, [*VEHICLE, "disposal_site_id"], "left_anti", **limit)
    if match != "any_other":
        raise ValueError(f"match: {match}")
    ends = allowed.groupBy(*VEHICLE).agg(
        F.min("disposal_site_id").alias("_low"), F.max("disposal_site_id").alias("_high")
    )
    site_id = F.col("disposal_site_id")
    # Only the one permitted site of a vehicle does not count, and sites without an id.
    paired = near(salted_join(d, ends, VEHICLE, "inner", **limit), 2)
    return paired.filter((F.col("_low") != site_id) | (F.col("_high") != site_id)).drop("_low", "_high")


# Site columns copied to the alarm and their names there.
DISPOSAL_COLUMNS = {
    "disposal_site_name": "disposal_site_name",
    "disposal_site_short_name": "disposal_site_short_name",
    "disposal_type": "disposal_type",
    "province_id": "disposal_province_id",
    "city_id": "disposal_city_id",
    "area_id": "disposal_area_id",
    "address": "disposal_address",
    "lng": "disposal_lng",
    "lat": "disposal_lat",
}


def alarm_illegal_disposal(
    d: DataFrame,
    card: DataFrame,
    sites: DataFrame,
    radius_m: float = 500.0,
    cooldown_s: int = COOLDOWN_S,
    match: str = "not_permitted",
    dept_id: int | None = None,
    target_rows: int | None = TARGET_ROWS,
    **kw,
) -> DataFrame:
    """A permit holder near a disposal site it may not use; the cooldown is per vehicle, over all sites.

    At equal time the lowest site id is reported.
    """
    sites = valid_sites(sites, dept_id)
    permits = permitted_sites(card, sites).dropna(subset=["lng", "lat"])
    d = prepare(supervised(d), target_rows=target_rows)
    candidates = illegal_site_visits(d, permits, sites, radius_m, match, lowest=True, **kw)
    fired = cooldown(candidates, VEHICLE, cooldown_s, tie=("disposal_site_id", "row_key"))
    extra = {name: F.col(f"site.{c}") for c, name in DISPOSAL_COLUMNS.items() if c in sites.columns}
    return as_alarm(fired, ILLEGAL_DISPOSAL, end=("epoch_s", "lng", "lat"), **extra)

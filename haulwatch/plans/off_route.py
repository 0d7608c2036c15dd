"""Off-route detector.

A vehicle that stays at the build site of one of its permits takes on that permit's route until it reaches the
permit's disposal site. Leaving the route in between for long enough raises an alarm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulwatch.operators.blocks import cooldown
from haulwatch.operators.lookups import supervised
from haulwatch.operators.sequence import (
    ORDER, TARGET_ROWS, VEHICLE, ensure_checkpoint_dir, group_columns, ordered_scan, prepare,
)
from haulwatch.operators.spatial import flag_off_route, near_ids
from haulwatch.plans.alarms import COOLDOWN_S, OFF_ROUTE, as_alarm

PERMIT = [*VEHICLE, "permit_id"]


def with_permit_id(permits: DataFrame) -> DataFrame:
    """Number permits by content where the table has no ``permit_id``; equal permits share a number."""
    if "permit_id" in permits.columns:
        return permits
    return permits.withColumn(
        "permit_id", F.xxhash64("build_lng", "build_lat", "disposal_lng", "disposal_lat", "coords")
    )


def _route_events(d, permits, radius_m, dwell_s, max_speed, **kw) -> DataFrame:
    """Per report: ``take``, the lowest permit whose dwell is confirmed, and ``leave``, permits whose disposal site is near.

    One read of the facts: both kinds of sites come as arrays of a report, so that only the few reports near one of them
    go on after the scan that finds the report before each.
    """
    group = group_columns(d, VEHICLE)
    points = d.select(*group, *ORDER, "lng", "lat", "speed")
    for side in ("build", "disposal"):
        site = permits.select(*PERMIT, f"{side}_lng", f"{side}_lat").distinct()
        points = near_ids(points, site, radius_m, VEHICLE, "permit_id", side, f"{side}_lng", f"{side}_lat", **kw)
    slow = F.when(F.col("speed") < max_speed, F.col("build")).otherwise(F.slice("build", 1, 0))
    points = points.select(*group, *ORDER, slow.alias("build"), "disposal")
    chained = ordered_scan(points, VEHICLE).withColumn("_previous", F.col("prev.row_key")).drop("prev")
    near = chained.filter((F.size("build") > 0) | (F.size("disposal") > 0))
    # The dwell starts anew unless the report just before this one was at the same build site. Reports at no build
    # site have a null permit: they confirm nothing.
    at_build = near.withColumn("permit_id", F.explode_outer("build")).drop("build")
    broken = F.col("prev").isNull() | (F.col("prev.row_key") != F.col("_previous"))
    dwelling = ordered_scan(at_build, PERMIT, mark=lambda prev: F.when(broken, F.col("epoch_s")))
    confirmed = F.when(F.col("epoch_s") - F.col("mark") > dwell_s, F.col("permit_id"))
    events = dwelling.groupBy(*group, *ORDER).agg(
        F.min(confirmed).alias("take"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("disposal")))).alias("leave")
    )
    return events.filter(F.col("take").isNotNull() | (F.size("leave") > 0))


def _after(state: Column, event: Column) -> Column:
    """Permit held after one event."""
    held = F.coalesce(state, event["take"])
    return F.when(held.isNotNull() & ~F.array_contains(event["leave"], held), held)


def route_changes(events: DataFrame) -> DataFrame:
    """Reports at which the held permit changes, with the permit held from there on in ``held`` (null for none).

    Repeating an event changes nothing, so runs of equal events shrink to their first. Where vehicles are sliced, a
    slice is summarised by the permit it ends with for every permit it may start with; running through a vehicle's
    summaries gives each slice its start, and slices then replay their events independently.
    """
    group = group_columns(events, VEHICLE)
    order = Window.partitionBy(*group).orderBy(*ORDER)
    what = F.struct("take", "leave")
    news = events.withColumn("_was", F.lag(what).over(order)).filter(
        F.col("_was").isNull() | ~F.col("_was").eqNullSafe(what)
    )
    slices = news.groupBy(*group).agg(
        F.sort_array(F.collect_list(F.struct(*ORDER, "take", "leave"))).alias("_events")
    )
    nothing = F.lit(None).cast(events.schema["take"].dataType)
    entry = nothing
    if "slice" in group:
        ensure_checkpoint_dir(events.sparkSession)
        slices = slices.checkpoint()
        slices = slices.join(_slice_starts(slices, nothing), [*VEHICLE, "slice"], "left")
        entry = F.col("_entry")

    change = T.StructType(
        [T.StructField(c, events.schema[c].dataType) for c in ORDER] + [T.StructField("held", events.schema["take"].dataType)]
    )

    def step(acc: Column, e: Column) -> Column:
        held = _after(acc["held"], e)
        here = F.array(F.struct(*[e[c].alias(c) for c in ORDER], held.alias("held")))
        out = F.when(held.eqNullSafe(acc["held"]), acc["out"]).otherwise(F.concat(acc["out"], here))
        return F.struct(held.alias("held"), out.alias("out"))

    start = F.struct(entry.alias("held"), F.array().cast(T.ArrayType(change)).alias("out"))
    changes = F.aggregate("_events", start, step, lambda acc: acc["out"])
    return slices.select(*group, F.explode(changes).alias("_c")).select(*group, "_c.*")


def _slice_starts(slices: DataFrame, nothing: Column) -> DataFrame:
    """The permit held before each slice of events, in ``_entry``."""

    def end(start: Column) -> Column:
        first = F.struct(start.alias("held"))
        return F.aggregate("_events", first, lambda acc, e: F.struct(_after(acc["held"], e).alias("held")))["held"]

    # A permit that no event of the slice gives back is still held at its end.
    leavable = F.array_distinct(F.flatten(F.transform("_events", lambda e: e["leave"])))
    ends = slices.select(
        *VEHICLE,
        F.struct(
            "slice",
            end(nothing).alias("none"),
            F.transform(leavable, lambda p: F.struct(p.alias("p"), end(p).alias("to"))).alias("ends"),
        ).alias("_s"),
    )
    vehicles = ends.groupBy(*VEHICLE).agg(F.sort_array(F.collect_list("_s")).alias("_all"))
    start = F.struct(F.lit(None).cast(slices.schema["slice"].dataType).alias("slice"), nothing.alias("entry"))

    def run(acc: Column, s: Column) -> Column:
        # The last element of the list so far holds the state before this slice; the one added holds that after it.
        held = F.element_at(acc, -1)["entry"]
        hit = F.try_element_at(F.filter(s["ends"], lambda x: x["p"] == held), F.lit(1))
        to = F.when(held.isNull(), s["none"]).when(hit.isNull(), held).otherwise(hit["to"])
        return F.concat(acc, F.array(F.struct(s["slice"].alias("slice"), to.alias("entry"))))

    after = F.aggregate("_all", F.array(start), run)
    before = F.zip_with(
        F.transform("_all", lambda s: s["slice"]),
        F.slice(after, 1, F.size("_all")),
        lambda at, s: F.struct(at.alias("slice"), s["entry"].alias("_entry")),
    )
    return vehicles.select(*VEHICLE, F.explode(before).alias("_b")).select(*VEHICLE, "_b.*")


def alarm_off_route(
    d: DataFrame,
    permits: DataFrame,
    radius_m: float = 500.0,
    dwell_s: int = 180,
    max_speed: float = 15.0,
    off_minutes: int = 3,
    cooldown_s: int = COOLDOWN_S,
    target_rows: int | None = TARGET_ROWS,
    **kw,
) -> DataFrame:
    """Vehicles off the route of the permit they hold for more than ``off_minutes`` whole minutes.

    (a) A permit is taken once the vehicle, holding none, has been within ``radius_m`` of its build site, slower
    than ``max_speed``, for more than ``dwell_s``. (b) It is given back within ``radius_m`` of its disposal site.
    (c) While it is held, a report with no route vertex within ``radius_m`` is off route. The alarm starts at the
    first report of an unbroken off-route run and ends at the report that raises it; a run whose start is less
    than ``cooldown_s`` after the start of the last alarm stays silent.
    """
    permits = with_permit_id(permits)
    d = prepare(supervised(d.drop("permit_id")), target_rows=target_rows)
    group = group_columns(d, VEHICLE)
    changes = route_changes(_route_events(d, permits, radius_m, dwell_s, max_speed, **kw))
    held_type = changes.schema["held"].dataType
    order = (*ORDER, "_rank")
    points = d.withColumns({"_rank": F.lit(1), "_held": F.lit(None).cast(held_type)})
    marks = changes.select(*group, *ORDER, F.lit(0).alias("_rank"), F.col("held").alias("_held"))
    change = F.when(F.col("_rank") == 0, F.struct(F.col("_held").alias("held")))
    merged = points.unionByName(marks, allowMissingColumns=True)
    held = ordered_scan(merged, VEHICLE, mark=lambda prev: change, order=order).filter("_rank = 1")
    held = held.withColumn("permit_id", F.col("mark.held")).drop("mark", "prev", "_rank", "_held")
    flagged = flag_off_route(held, permits, radius_m, **kw)
    flagged = flagged.withColumn("_off", F.col("permit_id").isNotNull() & F.col("off_route"))
    carried = [c for c in d.columns if c not in (*VEHICLE, "row_key", "hot", "slice")]
    start = F.when(F.col("_off") & ~F.coalesce(F.col("prev._off"), F.lit(False)), F.struct("row_key", "permit_id", *carried))
    runs = ordered_scan(flagged, VEHICLE, ["_off"], mark=lambda prev: start)
    late = runs.filter(F.col("_off") & (F.floor((F.col("epoch_s") - F.col("mark.epoch_s")) / 60) > off_minutes))
    first = late.groupBy(*VEHICLE, "mark").agg(F.min(F.struct(*ORDER, "lng", "lat")).alias("_end"))
    fired = cooldown(first.select(*VEHICLE, "mark.*", "_end"), VEHICLE, cooldown_s - 1)
    return as_alarm(fired, OFF_ROUTE, start=("epoch_s", "lng", "lat"), end=("_end.epoch_s", "_end.lng", "_end.lat")).drop("_end")

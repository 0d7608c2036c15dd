"""Stop history, site visits and vehicle status."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulwatch.functions.exprs import ColumnLike, col
from haulwatch.functions.timefn import epoch, partition_ids, second_of_day
from haulwatch.operators.lookups import supervised
from haulwatch.operators.sequence import DAY, ORDER, TARGET_ROWS, VEHICLE, group_columns, ordered_scan, prepare
from haulwatch.operators.spatial import in_home_cells, match_sites
from haulwatch.operators.visits import HOME_ROWS, Counted, counted_homes, visits_by_home


def stop_history(
    d: DataFrame, min_s: int = 180, silence_s: int = 180, target_rows: int | None = TARGET_ROWS
) -> DataFrame:
    """Stops longer than ``min_s`` that end with a move.

    A stop opens at the first report with speed 0 and runs on while such reports follow within ``silence_s``.
    A moving report less than ``silence_s`` after the last of them closes it; a longer silence discards it.
    """
    d = prepare(d, target_rows=target_rows)
    still = F.col("speed") == 0
    gap = F.col("epoch_s") - F.col("prev.epoch_s")
    continues = (F.col("prev.speed") == 0) & (gap <= silence_s)
    opened = F.when(still & ~F.coalesce(continues, F.lit(False)), F.struct("epoch_s", "lng", "lat"))
    rows = ordered_scan(d, VEHICLE, ["speed"], mark=lambda prev: opened)
    closing = (F.col("speed") > 0) & (F.col("prev.speed") == 0) & (gap < silence_s)
    kept = rows.filter(closing & (F.col("epoch_s") - F.col("mark.epoch_s") > min_s))
    bus = [c for c in ("enterprise_id", "car_card_number", "department_id") if c in d.columns]
    stops = kept.select(
        *VEHICLE,
        *bus,
        F.timestamp_seconds("mark.epoch_s").alias("stop_time"),
        F.col("mark.lng").alias("stop_lng"),
        F.col("mark.lat").alias("stop_lat"),
        F.timestamp_seconds("epoch_s").alias("start_time"),
        F.col("lng").alias("start_lng"),
        F.col("lat").alias("start_lat"),
    )
    return partition_ids(stops, "start_time")


def site_visits(
    d: DataFrame, sites: DataFrame, radius_m: float = 500.0, dwell_s: int = 180,
    target_rows: int | None = TARGET_ROWS, time: Callable[[Column], Column] = F.timestamp_seconds, **kw,
) -> DataFrame:
    """Completed visits of vehicles to disposal sites.

    The visit starts with the first report inside and is confirmed by a report inside more than ``dwell_s``
    later. Once confirmed, the first report outside sets the exit; the visit ends when a report more than
    ``dwell_s`` after the exit is still outside, and returning earlier withdraws the exit.

    Reports inside are grouped into stays, split where the vehicle was outside for more than ``dwell_s``. A stay
    longer than ``dwell_s`` is a visit. A shorter one is still unconfirmed when the next stay begins and is merged
    with it, so stays after the last long one pair up two by two.

    ``time`` says what the times of a visit are made of whole epoch seconds. There can be very many more visits than reports.
    """
    d = prepare(supervised(d), target_rows=target_rows)
    d = d.select(*group_columns(d, VEHICLE), *ORDER, "lng", "lat")
    last_seen = d.groupBy(*VEHICLE).agg(F.max("epoch_s").alias("_seen"))
    whole = ordered_scan(d, VEHICLE, following=True)
    whole = whole.withColumnsRenamed({"prev": "_from", "next": "_to"}).join(last_seen, list(VEHICLE), "left")
    sites = sites.select("dept_id", "disposal_site_id", "lng", "lat").filter("disposal_site_id is not null")

    counted = _fit_for_homes(d, sites, radius_m, target_rows)
    if counted:
        return visits_by_home(whole.drop("hot", "slice"), sites, radius_m, dwell_s, counted, time, **kw)
    key = [*VEHICLE, "disposal_site_id"]
    inside = match_sites(whole, sites, radius_m, **kw)
    inside = inside.withColumn("disposal_site_id", F.col("target.disposal_site_id")).drop("target", "distance")
    # The vehicle was outside from the report after the previous one inside to the report before this one.
    went_out = F.col("_from.row_key") != F.col("prev.row_key")
    outside_s = F.col("_from.epoch_s") - F.col("prev._to.epoch_s")
    split = F.col("prev").isNull() | (went_out & (outside_s > dwell_s))
    stays = ordered_scan(inside, key, ["_to"], mark=lambda prev: F.when(split, F.struct("epoch_s", "row_key")))
    stays = (
        stays.groupBy(*key, "mark")
        .agg(F.max(F.struct("epoch_s", "row_key", "_to", "_seen")).alias("_last"))
        .select(
            *key,
            F.col("mark.epoch_s").alias("_start"),
            F.col("mark.row_key").alias("_start_key"),
            F.col("_last.epoch_s").alias("_end"),
            F.col("_last._to.epoch_s").alias("_exit"),
            F.col("_last._seen").alias("_seen"),
        )
    )
    stays = _numbered(stays, key, dwell_s)
    pending = F.col("_since_long") % 2 == 1
    visits = stays.filter(F.col("_long") | pending).withColumn(
        "_enter", F.when(pending, F.col("_previous")).otherwise(F.col("_start"))
    )
    ended = ~F.col("_open") | (F.col("_seen") - F.col("_exit") > dwell_s)
    return visits.filter(ended).select(
        *VEHICLE,
        "disposal_site_id",
        time(F.col("_enter")).alias("enter_time"),
        time(F.col("_exit")).alias("exit_time"),
    )


def _fit_for_homes(d: DataFrame, sites: DataFrame, radius_m: float, target_rows: int | None) -> Counted | None:
    """What ``counted_homes`` counts where a worker may hold a vehicle's reports around a cell (``HOME_ROWS``), no cell has more than
    ``target_rows`` of a sliced vehicle, no site id has places in two cells and keys of reports are whole numbers; else None."""
    if not isinstance(d.schema["row_key"].dataType, T.IntegralType):
        return None
    _, homes = in_home_cells(d, sites, radius_m)
    if not homes.groupBy("dept_id", "disposal_site_id").agg(F.count_distinct("_cx", "_cy").alias("_n")).filter("_n > 1").isEmpty():
        return None
    if "slice" in d.columns:
        _, cells = in_home_cells(d, d.filter("hot"), radius_m)
        most = TARGET_ROWS if target_rows is None else target_rows
        if not cells.groupBy(*VEHICLE, "_cx", "_cy").count().filter(F.col("count") > most).isEmpty():
            return None
    counted = counted_homes(d, sites, radius_m)
    return counted if counted.most <= HOME_ROWS else None


# Stays of a vehicle at a site are numbered within such periods: no more than this many seconds by dwell_s each.
PERIOD_S = 30 * DAY


def _numbered(stays: DataFrame, key: list[str], dwell_s: int) -> DataFrame:
    """Add ``_long``, the number of stays since the last long one (``_since_long``), the start of the stay before
    (``_previous``) and whether no stay follows (``_open``).

    Rows meet by key and period; of whole keys, only one summary per period meets.
    """
    part = [*key, "_period"]
    stays = stays.withColumns({"_period": F.floor(F.col("_start") / PERIOD_S), "_long": F.col("_end") - F.col("_start") > dwell_s})
    order = Window.partitionBy(*part).orderBy("_start", "_start_key")
    place = F.row_number().over(order) - 1
    stays = stays.withColumns({"_i": place, "_lag": F.lag("_start").over(order), "_lead": F.lead("_start").over(order)})
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    stays = stays.withColumn("_long_i", F.max(F.when(F.col("_long"), F.col("_i"))).over(before))

    periods = stays.groupBy(*part).agg(
        F.count(F.lit(1)).alias("_n"), F.max(F.when(F.col("_long"), F.col("_i"))).alias("_last_long"), F.max("_start").alias("_last")
    )
    time = Window.partitionBy(*key).orderBy("_period")
    past = time.rowsBetween(Window.unboundedPreceding, -1)
    # How many stays of the key there are up to and with the last long one.
    periods = periods.withColumn("_up_to_long", F.sum("_n").over(time) - F.col("_n") + F.col("_last_long") + 1)
    total = F.coalesce(F.sum("_n").over(past), F.lit(0))
    anchor = F.coalesce(F.last("_up_to_long", ignorenulls=True).over(past), F.lit(0))
    periods = periods.select(
        *part, (total - anchor).alias("_carry"), F.lag("_last").over(time).alias("_last_before"),
        F.lead("_period").over(time).isNull().alias("_final"),
    )
    stays = stays.join(periods, part)
    since = F.when(F.col("_long_i").isNull(), F.col("_carry") + F.col("_i")).otherwise(F.col("_i") - F.col("_long_i") - 1)
    return stays.withColumns(
        {"_since_long": since, "_previous": F.coalesce("_lag", "_last_before"), "_open": F.col("_lead").isNull() & F.col("_final")}
    )


STATUS_COLUMNS = (
    "devid", "lng", "lat", "speed", "pos", "gpsflag", "accflag", "residualoil", "viceresidualoil", "region_id",
    "department_id",
)


def vehicle_status(
    d: DataFrame,
    as_of: ColumnLike | None = None,
    offline_s: int = 180,
    still_s: int = 180,
    target_rows: int | None = TARGET_ROWS,
) -> DataFrame:
    """Latest state of each vehicle at ``as_of`` (a timestamp; default now).

    ``online_time`` adds up the seconds between reports no more than ``offline_s`` apart; a sum above the seconds
    since midnight starts again at 0. ``online_status`` is 0 once speed has been 0 for ``still_s``, else 1.
    ``vehicle_status`` is 1 when the vehicle has been silent for more than ``offline_s``. A report no later than
    the one before it is ignored.
    """
    d = prepare(d, target_rows=target_rows)
    now = F.unix_seconds(F.current_timestamp()) if as_of is None else epoch(as_of)
    newer = F.col("prev.epoch_s").isNull() | (F.col("epoch_s") > F.col("prev.epoch_s"))
    rows = ordered_scan(d, VEHICLE, mark=lambda prev: F.when(newer, F.struct("epoch_s", "speed")), before=True)
    rows = rows.filter(newer)
    gap = F.col("epoch_s") - F.col("mark.epoch_s")
    online = gap <= offline_s
    still = F.col("speed") == 0
    still_since = F.when(still & ~F.coalesce(online & (F.col("mark.speed") == 0), F.lit(False)), F.col("epoch_s"))
    kept = [c for c in STATUS_COLUMNS if c in d.columns]
    days = rows.groupBy(*VEHICLE, F.floor(F.col("epoch_s") / DAY).alias("_day")).agg(
        F.sum(F.when(online, gap)).alias("_online"),
        F.min_by(
            F.when(online, F.struct(gap.alias("gap"), second_of_day(F.timestamp_seconds("epoch_s")).alias("clock"))),
            F.when(online, F.col("epoch_s")),
        ).alias("_first"),
        F.max(still_since).alias("_still"),
        F.max_by(F.struct("epoch_s", *kept), F.struct("epoch_s", "row_key")).alias("_last"),
    )

    # Within a day the sum can pass the clock only at the first report counted, since both then grow alike.
    def add_day(total: Column, day: Column) -> Column:
        start = total + day["_first"]["gap"]
        checked = F.when(start > day["_first"]["clock"], F.lit(0).cast("long")).otherwise(start)
        return F.when(day["_first"].isNull(), total).otherwise(checked + day["_online"] - day["_first"]["gap"])

    per_vehicle = days.groupBy(*VEHICLE).agg(
        F.sort_array(F.collect_list(F.struct("_day", "_online", "_first"))).alias("_days"),
        F.max("_still").alias("_still"),
        F.max_by("_last", "_day").alias("_last"),
    )
    last = F.col("_last")
    stopped = (last["speed"] == 0) & (last["epoch_s"] - F.col("_still") >= still_s)
    return per_vehicle.select(
        *VEHICLE,
        F.timestamp_seconds(last["epoch_s"]).alias("time"),
        *[last[c].alias(c) for c in kept],
        F.when(now - last["epoch_s"] > offline_s, 1).otherwise(0).alias("vehicle_status"),
        F.aggregate("_days", F.lit(0).cast("long"), add_day).alias("online_time"),
        F.when(stopped, 0).otherwise(1).alias("online_status"),
    )


def merge_status(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """Update-only merge by ``(vehicle_id, dept_id)``: rows of ``snapshot``, with the columns of ``changes`` taken over.

    Vehicles that are not in ``snapshot`` are not added. A missing ``gprs_state`` or ``acc_state`` is stored as 9.
    """
    keys = ["vehicle_id", "dept_id"]
    changes = changes.withColumnsRenamed({c: n for c, n in STATUS_NAMES.items() if c in changes.columns})
    taken = [c for c in changes.columns if c not in keys]
    joined = snapshot.join(
        changes.select(*keys, F.struct(*taken).alias("_new")), keys, "left"
    )
    def merged(name: str) -> Column:
        if name not in taken:
            return F.col(name)
        value = F.col("_new")[name]
        if name in ("gprs_state", "acc_state"):
            value = F.coalesce(value.cast("int"), F.lit(9))
        return F.when(F.col("_new").isNotNull(), value.cast(snapshot.schema[name].dataType)).otherwise(F.col(name))

    return joined.select(*[(F.col(c) if c in keys else merged(c)).alias(c) for c in snapshot.columns])


# Names of position columns in the status table.
STATUS_NAMES = {
    "devid": "terminal_id",
    "pos": "direction",
    "gpsflag": "gprs_state",
    "accflag": "acc_state",
    "residualoil": "main_oil_consumption",
    "viceresidualoil": "vice_oil_consumption",
    "region_id": "vehicle_area",
}


def mark_offline(snapshot: DataFrame, as_of: ColumnLike, offline_s: int = 180) -> DataFrame:
    """Set ``vehicle_status`` to 1 for online vehicles silent for more than ``offline_s``."""
    silent = (F.col("vehicle_status") == 0) & (epoch(as_of) - epoch(col("time")) > offline_s)
    return snapshot.withColumn(
        "vehicle_status", F.when(silent, F.lit(1)).otherwise(F.col("vehicle_status")).cast("int")
    )

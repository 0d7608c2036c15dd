"""Enriched alarm table, trip table and the data bus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwatch.functions.exprs import ColumnLike, col
from haulwatch.functions.geo import distance_m
from haulwatch.functions.timefn import duration_text, partition_ids, seconds_between, time_text
from haulwatch.operators import lookups
from haulwatch.operators.spatial import tag_region

SCORING = ("illegal_type_short_desc", "illegal_type_desc", "enterprise_score", "vehicle_score", "driver_score")


def _now(as_of: ColumnLike | None) -> Column:
    return F.current_timestamp() if as_of is None else col(as_of)


def enrich_alarms(a: DataFrame, illegal_type: DataFrame, as_of: ColumnLike | None = None, **kw) -> DataFrame:
    """Add partition ids, duration, distance, scoring, a uuid and the scoring year to alarms.

    ``interval_time`` is the duration label and ``interval_seconds`` the plain number beside it; both are null when
    either time is. Afterwards a missing end time takes the start time.
    """
    now = _now(as_of)
    seconds = seconds_between("alarm_end_time", "alarm_start_time")
    keys = ["dept_id", "illegal_type_code"]
    a = a.drop(*SCORING)
    out = lookups.lookup(a, illegal_type.select(*keys, *SCORING), keys, "left", **kw)
    out = out.withColumns(
        {
            "interval_seconds": seconds,
            "interval_time": duration_text(seconds),
            "interval_distance": distance_m("alarm_start_lng", "alarm_start_lat", "alarm_end_lng", "alarm_end_lat"),
            "uuid": F.expr("uuid()"),
            "scoring_year": F.year(now),
        }
    )
    out = partition_ids(out, now)
    return out.withColumn("alarm_end_time", F.coalesce("alarm_end_time", "alarm_start_time"))


# Device columns of the trip table; a trip never fills them.
TRIP_DEVICE_COLUMNS = (
    "device_id", "time", "gps_lng", "gps_lat", "speed", "pos", "gps_flag", "wire_flag", "power_flag", "acc_flag",
    "auxiliary_flag", "temperature", "door", "all_distance", "all_dist_fuel", "gps_distance", "gps_all_distance",
    "report_time", "zxcqi", "alarm_flag", "main_oil_per", "residual_oil", "vice_oil_per", "vice_residual_oil",
    "oil_difference", "sharp_turn", "brake",
)


def _trip_site(prefix: str, source: str, time: Column, order: str) -> list[Column]:
    parts = {
        "time": time,
        "flag": F.coalesce(F.col(f"{source}_sit_flag"), F.lit(-1)),
        **{n: F.col(f"{source}_site_{n}") for n in ("id", "name", "address", "province_id", "city_id", "area_id", "lat", "lng")},
    }
    return [parts[n].alias(f"{prefix}_site_{n}") for n in order.split()]


def trip_table(trips: DataFrame, as_of: ColumnLike | None = None) -> DataFrame:
    """Trips with both end points, in the layout of the trip table (``e_``: destination, ``s_``: origin)."""
    now = _now(as_of)
    complete = trips.dropna(subset=[f"{s}_site_{c}" for s in ("from", "to") for c in ("lng", "lat")])
    plain = ["car_card_number", "load", "enterprise_name", "province_id", "city_id", "area_id"]
    table = complete.select(
        *[F.lit(None).cast("string").alias(c) for c in TRIP_DEVICE_COLUMNS],
        *_trip_site("e", "to", F.col("to_site_inter_time"), "time id name address province_id city_id area_id lat lng flag"),
        F.lit(0).alias("status"),
        F.lit(None).cast("string").alias("dev_id"),
        F.lit(0).alias("dev_status"),
        *_trip_site(
            "s", "from", F.coalesce("from_site_inter_time", F.lit("")),
            "id name flag lng lat area_id province_id city_id address time",
        ),
        time_text(now).alias("updatetime"),
        "dept_id",
        "vehicle_id",
        F.col("enterprise_id").alias("transport_enterprise_id"),
        *plain,
        F.coalesce("vehicle_empty", F.lit(1)).alias("vehicle_empty"),
    )
    return partition_ids(table, now)


def data_bus(
    p: DataFrame, service_fee: DataFrame, driver: DataFrame, enterprise: DataFrame, transport_card: DataFrame,
    areas: DataFrame, **kw,
) -> DataFrame:
    """Enrich positions: valid service fee, driver, enterprise, transport card flag, region."""
    d = lookups.filter_service_fee(p, service_fee, **kw)
    d = lookups.join_driver(d, driver, **kw)
    d = lookups.join_enterprise(d, enterprise, **kw)
    d = lookups.flag_transport_card(d, transport_card, **kw)
    return tag_region(d, areas, **kw)

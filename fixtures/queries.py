"""One query per operator over the adapted test tables.

Positions jump at random, so dwell-based detectors get wider radii and shorter times; ``fast`` positions get a
shorter cooldown. The parameters are named in each query and repeated in the oracle text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures.adapter import AS_OF, DATE, frames, positions, table
from haulwatch import schemas
from haulwatch.functions import geo
from haulwatch.functions.timefn import duration_text, in_daily_range, in_effective_range, seconds_between, time_text
from haulwatch.functions.timefn import partition_ids as add_partition_ids
from haulwatch.operators import asof, blocks, lookups, spatial
from haulwatch.operators.sequence import VEHICLE, ensure_checkpoint_dir, ordered_scan, prepare
from haulwatch.plans import alarms, outputs, vehicles
from haulwatch.plans.off_route import alarm_off_route
from haulwatch.session import configure
from haulwatch.sources import scans, sinks

COOLDOWN = 1800
WIDE_M = 1500.0
ROUTE_M = 2000.0
DWELL_S = 30

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir.rstrip("/"))

    QUERIES[fn.__name__] = run
    return fn


def _texts(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: time_text(n) for n in names})


def _second_text(second):
    return time_text(F.timestamp_seconds(second))


def _t():
    return F.col("epoch_s").alias("t")


def _as_of():
    return F.lit(AS_OF).cast("timestamp")


def _alarm_view(df: DataFrame, *extra: str) -> DataFrame:
    core = ["dept_id", "vehicle_id", "row_key", "illegal_type_code", "alarm_start_time", "alarm_start_lng",
            "alarm_start_lat", "alarm_end_time", "alarm_end_lng", "alarm_end_lat"]
    return _texts(df.select(*core, *extra), "alarm_start_time", "alarm_end_time")


def _json_positions(spark, sf_dir, quoted=False) -> DataFrame:
    """Position records; ``quoted`` writes the numbers of every other record as text."""
    p = positions(spark, sf_dir, "positions")
    if quoted:
        texts = {c: F.when(F.col("row_key") % 2 == 0, F.concat(F.lit('"'), F.col(c).cast("string"), F.lit('"'))).otherwise(F.col(c).cast("string")) for c in ("lng", "lat")}
        numbers = F.concat_ws(",", *[F.concat(F.lit(f'"{c}":'), v) for c, v in texts.items()])
        rest = F.to_json(F.struct(time_text("time").alias("time"), F.col("speed").cast("string").alias("speed"), F.concat(F.lit("T"), F.col("vehicle_id").cast("string")).alias("devid"), F.col("row_key").cast("string").alias("zxcqi")))
        return p.select("row_key", F.concat(F.lit("{"), numbers, F.lit(","), F.substring(rest, 2, 1 << 20)).alias("value"))
    return p.select(
        F.to_json(
            F.struct(
                F.concat(F.lit(" P"), F.col("vehicle_id").cast("string"), F.lit(" ")).alias("car_card_number"),
                F.concat(F.lit("T"), F.col("vehicle_id").cast("string")).alias("devid"),
                time_text("time").alias("time"), "lng", "lat", F.col("speed").cast("string").alias("speed"),
                F.col("row_key").cast("string").alias("zxcqi"),
            )
        ).alias("value")
    )


# Scans and sinks


@query
def scan_positions(spark, sf_dir):
    out = scans.scan_positions(_json_positions(spark, sf_dir))
    return out.select(F.col("zxcqi").cast("long").alias("row_key"), "devid", time_text("time").alias("time"), "lng", "lat", "speed")


@query
def scan_positions_mixed(spark, sf_dir):
    """The same records with the numbers of every other one in quotes."""
    out = scans.scan_positions(_json_positions(spark, sf_dir, quoted=True))
    return out.select(F.col("zxcqi").cast("long").alias("row_key"), "devid", time_text("time").alias("time"), "lng", "lat", "speed")


@query
def rejected_records(spark, sf_dir):
    """Records with a word for a number, and records cut short."""
    sent = _json_positions(spark, sf_dir, quoted=True)
    broken = F.when(F.col("row_key") % 10 == 3, F.regexp_replace("value", '"lng":[^,]*', '"lng":"east"'))
    broken = broken.when(F.col("row_key") % 10 == 4, F.substring("value", 1, 20)).otherwise(F.col("value"))
    return scans.rejected_json(sent.withColumn("value", broken), schemas.RAW_POSITION).select("row_key", "reason")


@query
def decode_frames(spark, sf_dir):
    out = scans.scan_frames(frames(spark, sf_dir))
    return out.select(
        "event_id", "devid", time_text("time").alias("time"), "lng", "lat", "speed", "pos", "altitude", "gpsflag", "accflag",
        "sharpturn", "brake", "gpsdistance", "mainoilper", "flow_id", "subpackages", "subpackage_seq", "checksum_ok",
        F.size("items").alias("n_items"),
    )


@query
def json_sink_roundtrip(spark, sf_dir):
    bus = lookups.join_driver(_with_vehicle(spark, sf_dir), table(spark, sf_dir, "driver"))
    sent = sinks.to_json_value(bus.select("devid", "time", "lng", "lat", "vehicle_id", "dept_id", "driver_name"))
    sent = sent.withColumn("nulls_written", F.col("value").contains('"driver_name":'))
    back = scans.typed(scans.scan_json(sent, schemas.DATA_BUS, keep=["nulls_written"]))
    return _texts(back.select("devid", "time", "lng", "lat", "vehicle_id", "dept_id", "driver_name", "nulls_written"), "time")


# Filters and scalars


@query
def sanitize_positions(spark, sf_dir):
    out = lookups.sanitize_positions(positions(spark, sf_dir, "positions"))
    return out.select("row_key", F.round("lat", 6).alias("lat"), F.round("lng", 6).alias("lng"), "speed")


@query
def sanitize_positions_of_one_date(spark, sf_dir):
    out = lookups.sanitize_positions(positions(spark, sf_dir, "positions"), as_of_date=DATE)
    return out.select("row_key", F.round("lat", 6).alias("lat"), F.round("lng", 6).alias("lng"), "speed")


@query
def supervised_positions(spark, sf_dir):
    return _texts(lookups.supervised(positions(spark, sf_dir, "positions")), "time").select("row_key", "vehicle_id", "time")


@query
def convert_coordinates(spark, sf_dir):
    p = positions(spark, sf_dir, "positions")
    pairs = {
        "gcj": geo.wgs2gcj("lat", "lng"),
        "bd": geo.wgs2bd("lat", "lng"),
        "shifted": geo.gcj2bd("lat", "lng"),
        "back": geo.bd2gcj(*geo.gcj2bd("lat", "lng")),
    }
    cols = [F.round(c, 6).alias(f"{n}_{s}") for n, pair in pairs.items() for s, c in zip(("lat", "lng"), pair, strict=True)]
    return p.select("row_key", *cols)


@query
def consecutive_distance(spark, sf_dir):
    d = ordered_scan(prepare(positions(spark, sf_dir)), VEHICLE, ["lng", "lat"]).filter("prev is not null")
    metres = geo.distance_m("prev.lng", "prev.lat", "lng", "lat")
    return d.select("row_key", F.col("prev.row_key").alias("prev_row_key"), F.round(metres, 2).alias("metres"))


@query
def in_daily_time_range(spark, sf_dir):
    p = positions(spark, sf_dir, "positions")
    ranges = {"day": ("05:00", "23:00"), "night": ("20:30", "05:10"), "same_hour": ("08:10", "08:50"), "all": ("06:00", "06:00")}
    return p.select(
        "row_key", *[in_daily_range("time", F.lit(a), F.lit(b)).alias(f"in_{n}") for n, (a, b) in ranges.items()]
    )


@query
def in_effective_time_range(spark, sf_dir):
    p = positions(spark, sf_dir, "positions")
    inside = in_effective_range("time", F.lit("2024-01-05 06:00:00"), F.lit("2024-01-20 18:00:00"))
    return p.select("row_key", inside.alias("in_range"))


@query
def alarm_duration(spark, sf_dir):
    d = ordered_scan(prepare(positions(spark, sf_dir)), VEHICLE, ["time"]).filter("prev is not null")
    seconds = seconds_between("time", "prev.time")
    return d.select("row_key", seconds.alias("seconds"), duration_text(seconds).alias("label"))


@query
def append_read_back(spark, sf_dir):
    """The partitioned table after two runs of a query, whose batches have the same ids; one batch was run twice."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/append-{uuid.uuid4()}"
    rows = add_partition_ids(positions(spark, sf_dir, "fast"), "time").select("row_key", "vehicle_id", "month_id", "day_id", "hour_id")
    for run in ("first", "second"):
        write = sinks.append_partitioned(path, run=run)
        part = rows.filter((F.col("vehicle_id") % 2 == 0) == F.lit(run == "first"))
        for batch_id in (0, 1, 1):
            write(part.filter(F.col("row_key") % 2 == batch_id), batch_id)
    back = spark.read.schema("row_key bigint, vehicle_id int, run_id string, batch_id int, month_id string, day_id string, hour_id string").parquet(path)
    return back.select("row_key", "month_id", "day_id", "hour_id")


@query
def partition_ids(spark, sf_dir):
    out = add_partition_ids(positions(spark, sf_dir, "positions"), "time")
    return out.select("row_key", "month_id", "day_id", "hour_id")


# Joins


def _with_vehicle(spark, sf_dir) -> DataFrame:
    raw = scans.scan_positions(_json_positions(spark, sf_dir))
    return lookups.join_vehicle(raw.drop("devid"), table(spark, sf_dir, "vehicle")).withColumn("row_key", F.col("zxcqi").cast("long"))


def _bus(spark, sf_dir) -> DataFrame:
    return positions(spark, sf_dir).join(
        table(spark, sf_dir, "vehicle").drop("dept_id"), "vehicle_id"
    )


@query
def join_vehicle_by_plate(spark, sf_dir):
    return _with_vehicle(spark, sf_dir).select("row_key", "vehicle_id", "dept_id", "devid", "driver_id", "enterprise_id")


@query
def join_vehicle_by_terminal(spark, sf_dir):
    raw = scans.scan_positions(_json_positions(spark, sf_dir)).drop("car_card_number")
    out = lookups.join_vehicle(raw, table(spark, sf_dir, "vehicle"), on="devid")
    return out.select(F.col("zxcqi").cast("long").alias("row_key"), "vehicle_id", "dept_id", "car_card_number", "driver_id")


@query
def filter_service_fee(spark, sf_dir):
    out = lookups.filter_service_fee(positions(spark, sf_dir), table(spark, sf_dir, "service_fee"))
    return out.select("row_key", "vehicle_id", "service_state")


@query
def join_driver(spark, sf_dir):
    out = lookups.join_driver(_bus(spark, sf_dir), table(spark, sf_dir, "driver"))
    return out.select("row_key", "vehicle_id", "driver_id", "driver_name")


@query
def join_enterprise(spark, sf_dir):
    out = lookups.join_enterprise(_bus(spark, sf_dir), table(spark, sf_dir, "enterprise"))
    return out.select("row_key", "enterprise_id", "enterprise_name", "enterprise_lng", "enterprise_lat")


@query
def flag_transport_card(spark, sf_dir):
    out = lookups.flag_transport_card(positions(spark, sf_dir), table(spark, sf_dir, "transport_card"))
    return out.select("row_key", "vehicle_id", "transport_card_state")


@query
def flag_register_card(spark, sf_dir):
    out = lookups.flag_register_card(positions(spark, sf_dir), table(spark, sf_dir, "register_card"))
    return out.select("row_key", "vehicle_id", "register_card_state")


@query
def tag_region(spark, sf_dir):
    out = spatial.tag_region(positions(spark, sf_dir), table(spark, sf_dir, "area").drop("cx", "cy"))
    return out.select("row_key", "region_id", "region_name")


@query
def tag_region_crowded(spark, sf_dir):
    """All areas are candidates of one cell."""
    out = spatial.tag_region(positions(spark, sf_dir), table(spark, sf_dir, "area").drop("cx", "cy"), cell_deg=5.0, max_broadcast=0)
    return out.select("row_key", "region_id", "region_name")


@query
def data_bus(spark, sf_dir):
    names = ("service_fee", "driver", "enterprise", "transport_card")
    dims = [table(spark, sf_dir, n) for n in names]
    out = outputs.data_bus(_bus(spark, sf_dir), *dims, table(spark, sf_dir, "area").drop("cx", "cy"))
    return out.select(
        "row_key", "vehicle_id", "dept_id", "service_state", "driver_name", "enterprise_name", "enterprise_lng",
        "transport_card_state", "region_id", "region_name",
    )


def _fences(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "fence").select(F.col("condition_id").alias("id"), "coords")


def _rules(spark, sf_dir, name: str) -> DataFrame:
    return lookups.active_fence_rules(table(spark, sf_dir, name), _fences(spark, sf_dir))


@query
def active_fence_rules(spark, sf_dir):
    names = {"rule_work_time": "work time", "rule_restricted": "restricted", "rule_over_speed": "over speed",
             "rule_document_control": "document control"}
    parts = [
        _rules(spark, sf_dir, n).select(F.lit(label).alias("rule"), "condition_id", "dept_id", "alarm_date", "coords")
        for n, label in names.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query
def points_in_fences(spark, sf_dir):
    out = spatial.points_in_fences(positions(spark, sf_dir), _rules(spark, sf_dir, "rule_restricted"))
    return out.select("row_key", "condition_id")


@query
def points_in_fences_mixed(spark, sf_dir):
    """Fences of a country's size, of a city's and of very many yards in one table."""
    rules = table(spark, sf_dir, "mixed_fence").drop("cx", "cy", "half")
    return spatial.points_in_fences(positions(spark, sf_dir), rules).select("row_key", "condition_id")


@query
def permitted_sites(spark, sf_dir):
    out = lookups.permitted_sites(table(spark, sf_dir, "register_card"), table(spark, sf_dir, "disposal_site"))
    return out.select("vehicle_id", "dept_id", "disposal_site_id", "disposal_site_name")


def _permits(spark, sf_dir) -> DataFrame:
    return lookups.permit_routes(*[table(spark, sf_dir, n) for n in ("register_card", "build_site", "disposal_site")])


@query
def permit_routes(spark, sf_dir):
    out = _permits(spark, sf_dir)
    return out.select("permit_id", "vehicle_id", "dept_id", "build_lng", "build_lat", "disposal_lng", "disposal_lat", "coords")


@query
def points_near_sites(spark, sf_dir):
    out = spatial.points_near_sites(positions(spark, sf_dir), table(spark, sf_dir, "disposal_site"), radius_m=500.0)
    return out.select("row_key", "disposal_site_id", F.round("site_distance_m", 2).alias("metres"))


@query
def off_route_points(spark, sf_dir):
    out = spatial.off_route_points(positions(spark, sf_dir), _permits(spark, sf_dir), radius_m=WIDE_M)
    return out.select("row_key", "vehicle_id")


@query
def off_route_points_crowded(spark, sf_dir):
    """A whole route is one cell, and the vertices are shuffled."""
    out = spatial.off_route_points(positions(spark, sf_dir), _permits(spark, sf_dir), radius_m=WIDE_M, cell_deg=1.0, max_broadcast=0)
    return out.select("row_key", "vehicle_id")


# Building blocks


@query
def latest_position(spark, sf_dir):
    d = prepare(positions(spark, sf_dir), target_rows=None)
    out = blocks.latest_position(d, VEHICLE)
    return _texts(out.select("dept_id", "vehicle_id", "row_key", "time", "lng", "lat", "speed"), "time")


@query
def sustained_violations(spark, sf_dir):
    out = alarms.sustained_in_fence(
        positions(spark, sf_dir, "fast"), _rules(spark, sf_dir, "rule_over_speed"), alarms.overspeed_broken()
    )
    return out.select("vehicle_id", "condition_id", "row_key", _t(), "active_t")


@query
def cooldown_events(spark, sf_dir):
    d = prepare(positions(spark, sf_dir, "fast"), target_rows=None).filter("speed > 20")
    return blocks.cooldown(d, VEHICLE, COOLDOWN).select("dept_id", "vehicle_id", _t(), "row_key", "speed")


@query
def first_event_per_day(spark, sf_dir):
    d = prepare(positions(spark, sf_dir), target_rows=None).filter("speed > 20")
    return blocks.first_per_day(d, VEHICLE).select("dept_id", "vehicle_id", _t(), "row_key", "speed")


# Detectors


@query
def alarm_no_register(spark, sf_dir):
    return _alarm_view(alarms.alarm_no_register(positions(spark, sf_dir), table(spark, sf_dir, "register_card")))


def _card_history(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "card_history").withColumn("valid_from", F.timestamp_seconds("from_t")).drop("from_t")


@query
def cards_as_of(spark, sf_dir):
    """The state of a vehicle's card when the position was reported."""
    out = asof.as_of(positions(spark, sf_dir), _card_history(spark, sf_dir), VEHICLE, "card")
    return out.select("row_key", F.col("card.state").alias("card_state"))


@query
def alarm_no_register_as_of(spark, sf_dir):
    return _alarm_view(alarms.alarm_no_register_as_of(positions(spark, sf_dir), _card_history(spark, sf_dir)))


@query
def alarm_gps_gap(spark, sf_dir):
    return _alarm_view(alarms.alarm_gps_gap(positions(spark, sf_dir), max_m=2000.0))


def _fence_query(name: str, detector, rule: str) -> None:
    def run(spark, sf_dir):
        out = detector(positions(spark, sf_dir, "fast"), _rules(spark, sf_dir, rule), cooldown_s=COOLDOWN)
        return _alarm_view(out, "fence_id")

    run.__name__ = name
    query(run)


_fence_query("alarm_work_time", alarms.alarm_work_time, "rule_work_time")
_fence_query("alarm_restricted_zone", alarms.alarm_restricted_zone, "rule_restricted")
_fence_query("alarm_overspeed", alarms.alarm_overspeed, "rule_over_speed")
_fence_query("alarm_file_control", alarms.alarm_file_control, "rule_document_control")


@query
def alarm_fences(spark, sf_dir):
    rules = [_rules(spark, sf_dir, n) for n in ("rule_work_time", "rule_restricted", "rule_over_speed")]
    return _alarm_view(alarms.alarm_fences(positions(spark, sf_dir, "fast"), *rules, cooldown_s=COOLDOWN), "fence_id")


@query
def alarm_off_route_query(spark, sf_dir):
    out = alarm_off_route(
        positions(spark, sf_dir, "fast"), _permits(spark, sf_dir), radius_m=ROUTE_M, dwell_s=0, max_speed=1000.0,
        off_minutes=0, cooldown_s=600,
    )
    return _alarm_view(out, "permit_id")


QUERIES["alarm_off_route"] = QUERIES.pop("alarm_off_route_query")


@query
def alarm_off_route_dwell(spark, sf_dir):
    """Only vehicles that stay at a build site for three minutes take a route; alarms after three minutes off it."""
    out = alarm_off_route(
        positions(spark, sf_dir, "fast"), _permits(spark, sf_dir), radius_m=ROUTE_M, dwell_s=180, max_speed=40.0,
        off_minutes=3, cooldown_s=600,
    )
    return _alarm_view(out, "permit_id")


def _disposal_query(name: str, match: str) -> None:
    def run(spark, sf_dir):
        out = alarms.alarm_illegal_disposal(
            positions(spark, sf_dir, "fast"), table(spark, sf_dir, "register_card"), table(spark, sf_dir, "disposal_site"),
            radius_m=WIDE_M, cooldown_s=COOLDOWN, match=match,
        )
        return _alarm_view(out, "disposal_site_id", "disposal_site_name", "disposal_lng", "disposal_lat")

    run.__name__ = name
    query(run)


_disposal_query("alarm_illegal_disposal", "not_permitted")
_disposal_query("alarm_illegal_disposal_any_other", "any_other")


@query
def site_visits(spark, sf_dir):
    return vehicles.site_visits(
        positions(spark, sf_dir, "fast"), table(spark, sf_dir, "disposal_site"), radius_m=WIDE_M, dwell_s=DWELL_S, time=_second_text
    )


@query
def vehicle_status(spark, sf_dir):
    out = vehicles.vehicle_status(positions(spark, sf_dir, "fast"), as_of=_as_of(), offline_s=600, still_s=30)
    return _texts(out, "time").select(
        "dept_id", "vehicle_id", "time", "lng", "lat", "speed", "vehicle_status", "online_time", "online_status"
    )


@query
def vehicle_status_daily(spark, sf_dir):
    out = vehicles.vehicle_status(positions(spark, sf_dir), as_of=_as_of(), offline_s=40000, still_s=30000)
    return _texts(out, "time").select("dept_id", "vehicle_id", "time", "vehicle_status", "online_time", "online_status")


@query
def stop_history(spark, sf_dir):
    out = vehicles.stop_history(positions(spark, sf_dir, "fast"), min_s=DWELL_S, silence_s=600)
    return _texts(out, "stop_time", "start_time")


# Outputs


def _raw_alarms(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "alarms_raw").select(
        "row_key", "vehicle_id", "dept_id", "illegal_type_code",
        F.timestamp_seconds("start_t").alias("alarm_start_time"), F.timestamp_seconds("end_t").alias("alarm_end_time"),
        F.col("s_lng").alias("alarm_start_lng"), F.col("s_lat").alias("alarm_start_lat"),
        F.col("e_lng").alias("alarm_end_lng"), F.col("e_lat").alias("alarm_end_lat"),
    )


@query
def scan_alarms(spark, sf_dir):
    """Alarms in the full record layout, written as JSON and read back."""
    raw = _raw_alarms(spark, sf_dir).withColumn("zxcqi", F.col("row_key").cast("string"))
    back = scans.scan_alarms(sinks.to_json_value(schemas.conform(raw, schemas.ALARM)))
    out = back.select(
        F.col("zxcqi").cast("long").alias("row_key"), "vehicle_id", "dept_id", "illegal_type_code", "alarm_start_time",
        "alarm_start_lng", "alarm_end_time", "alarm_end_lat", "driver_name", "uuid",
    )
    return _texts(out, "alarm_start_time", "alarm_end_time")


@query
def enrich_alarms(spark, sf_dir):
    out = outputs.enrich_alarms(_raw_alarms(spark, sf_dir), table(spark, sf_dir, "illegal_type"), as_of=_as_of())
    out = out.withColumn("interval_distance", F.round("interval_distance", 2))
    return _texts(out.drop("uuid"), "alarm_start_time", "alarm_end_time")


@query
def trip_table(spark, sf_dir):
    raw = table(spark, sf_dir, "trips_raw")
    sent = sinks.to_json_value(raw)
    return outputs.trip_table(scans.scan_trips(sent), as_of=_as_of())


@query
def status_upsert(spark, sf_dir):
    changes = vehicles.vehicle_status(
        positions(spark, sf_dir, "fast").withColumns({"gpsflag": F.lit(None).cast("string"), "accflag": F.lit("1")}),
        as_of=_as_of(), offline_s=600, still_s=30,
    )
    snapshot = table(spark, sf_dir, "status_snapshot")
    return vehicles.merge_status(snapshot, _texts(changes, "time"))


@query
def mark_offline(spark, sf_dir):
    """Status half an hour early, then the vehicles that have fallen silent since."""
    early = F.lit("2024-01-01 05:30:00").cast("timestamp")
    status = vehicles.vehicle_status(positions(spark, sf_dir, "fast"), as_of=early, offline_s=600, still_s=30)
    out = vehicles.mark_offline(status, _as_of(), offline_s=600)
    return _texts(out, "time").select("dept_id", "vehicle_id", "time", "vehicle_status")


# The ways that only large inputs take: vehicles in slices, dimensions shuffled with a salt

SLICE_ROWS = 40


@query
def alarm_gps_gap_sliced(spark, sf_dir):
    return _alarm_view(alarms.alarm_gps_gap(positions(spark, sf_dir), max_m=2000.0, target_rows=SLICE_ROWS))


@query
def alarm_restricted_zone_sliced(spark, sf_dir):
    out = alarms.alarm_restricted_zone(
        positions(spark, sf_dir, "fast"), _rules(spark, sf_dir, "rule_restricted"), cooldown_s=COOLDOWN, target_rows=SLICE_ROWS,
        max_broadcast=0,
    )
    return _alarm_view(out, "fence_id")


@query
def alarm_off_route_sliced(spark, sf_dir):
    out = alarm_off_route(
        positions(spark, sf_dir, "fast"), _permits(spark, sf_dir), radius_m=ROUTE_M, dwell_s=0, max_speed=1000.0,
        off_minutes=0, cooldown_s=600, target_rows=SLICE_ROWS,
    )
    return _alarm_view(out, "permit_id")


@query
def alarm_illegal_disposal_sliced(spark, sf_dir):
    out = alarms.alarm_illegal_disposal(
        positions(spark, sf_dir, "fast"), table(spark, sf_dir, "register_card"), table(spark, sf_dir, "disposal_site"),
        radius_m=WIDE_M, cooldown_s=COOLDOWN, target_rows=SLICE_ROWS, max_broadcast=0,
    )
    return _alarm_view(out, "disposal_site_id", "disposal_site_name", "disposal_lng", "disposal_lat")


@query
def site_visits_sliced(spark, sf_dir):
    return vehicles.site_visits(
        positions(spark, sf_dir, "fast"), table(spark, sf_dir, "disposal_site"), radius_m=WIDE_M, dwell_s=DWELL_S,
        target_rows=SLICE_ROWS, time=_second_text,
    )


@query
def stop_history_sliced(spark, sf_dir):
    out = vehicles.stop_history(positions(spark, sf_dir, "fast"), min_s=DWELL_S, silence_s=600, target_rows=SLICE_ROWS)
    return _texts(out, "stop_time", "start_time")


@query
def vehicle_status_sliced(spark, sf_dir):
    out = vehicles.vehicle_status(
        positions(spark, sf_dir, "fast"), as_of=_as_of(), offline_s=600, still_s=30, target_rows=SLICE_ROWS
    )
    return _texts(out, "time").select(
        "dept_id", "vehicle_id", "time", "lng", "lat", "speed", "vehicle_status", "online_time", "online_status"
    )


@query
def join_enterprise_shuffled(spark, sf_dir):
    out = lookups.join_enterprise(_bus(spark, sf_dir), table(spark, sf_dir, "enterprise"), max_broadcast=0)
    return out.select("row_key", "enterprise_id", "enterprise_name", "enterprise_lng", "enterprise_lat")


@query
def points_in_fences_shuffled(spark, sf_dir):
    out = spatial.points_in_fences(positions(spark, sf_dir), _rules(spark, sf_dir, "rule_restricted"), max_broadcast=0)
    return out.select("row_key", "condition_id")

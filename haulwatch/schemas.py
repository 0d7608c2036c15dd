"""Record layouts of the wire formats and result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "float": T.FloatType(), "double": T.DoubleType()}


def _struct(spec: str) -> T.StructType:
    fields = (part.split() for part in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


# Field names of the position record.
POSITION_DDL = (
    "devid string, time string, lng double, lat double, point string, speed string, pos string, gpsflag string, "
    "wireflag string, powerflag string, accflag string, auxiliaryflag string, t string, door string, "
    "alldistance string, alldistfuel string, gpsdistance string, gpsalldistance string, createdatetime string, "
    "zxcqi string, alarmflag string, mainoilper string, residualoil string, viceoilper string, "
    "viceresidualoil string, oildifference string, sharpturn string, brake string"
)
# Columns enrichment adds to a position.
BUS_DDL = (
    "vehicle_id int, car_card_number string, vehicle_model_id string, vehicle_type_id string, "
    "vehicle_type_state string, vehicle_state string, if_new_energy int, approved_tonnage float, driver_id int, "
    "enterprise_id string, dept_id int, audit_state string, manage_state string, driver_card_number string, "
    "driver_name string, enterprise_name string, department_id int, address string, enterprise_lng double, "
    "enterprise_lat double, enterprise_type_id string, province_id string, city_id string, area_id string, "
    "coords string, register_card_state int, transport_card_state int, service_state int, region_id string, "
    "region_name string, at_work int"
)
# Columns an alarm adds to the enriched position.
ALARM_DDL = (
    "fence_id string, fence_name string, fence_area_id string, fence_flag int, alarm_start_time string, "
    "alarm_start_lng double, alarm_start_lat double, alarm_start_address string, alarm_end_time string, "
    "alarm_end_lng double, alarm_end_lat double, alarm_end_address string, illegal_type_code string, "
    "illegal_type_short_desc string, illegal_type_desc string, enterprise_score double, vehicle_score double, "
    "driver_score double, uuid string, scoring_year int, interval_time string, interval_distance double, "
    "disposal_site_id string, disposal_site_name string, disposal_site_short_name string, disposal_type string, "
    "disposal_province_id string, disposal_city_id string, disposal_area_id string, disposal_address string, "
    "disposal_lng double, disposal_lat double, month_id string, day_id string, hour_id string"
)


def _site(prefix: str) -> str:
    return (
        f"{prefix}_site_id string, {prefix}_site_name string, {prefix}_site_province_id string, "
        f"{prefix}_site_city_id string, {prefix}_site_area_id string, {prefix}_site_address string, "
        f"{prefix}_site_lng double, {prefix}_site_lat double, {prefix}_sit_flag int, {prefix}_site_inter_time string"
    )


TRIP_DDL = (
    "vehicle_id int, car_card_number string, load double, enterprise_id string, enterprise_name string, "
    f"province_id string, city_id string, area_id string, dept_id int, vehicle_empty int, {_site('from')}, {_site('to')}"
)

POSITION = _struct(POSITION_DDL)
# The plate-keyed feed names the vehicle by its plate.
RAW_POSITION = _struct(POSITION_DDL + ", car_card_number string")
DATA_BUS = _struct(f"{POSITION_DDL}, {BUS_DDL}")
ALARM = _struct(f"{POSITION_DDL}, {BUS_DDL}, {ALARM_DDL}")
TRIP = _struct(TRIP_DDL)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Same-name copy onto ``schema``: missing columns are null, other columns are dropped."""

    def pick(field: T.StructField) -> Column:
        if field.name not in df.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        column = F.col(field.name)
        if isinstance(df.schema[field.name].dataType, T.TimestampType) and isinstance(field.dataType, T.StringType):
            column = F.date_format(column, TIME_FORMAT)
        return column.cast(field.dataType).alias(field.name)

    return df.select(*[pick(f) for f in schema.fields])

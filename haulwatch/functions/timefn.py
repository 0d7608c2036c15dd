"""Time rules as Column expressions; everything works on whole seconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwatch.functions.exprs import ColumnLike, col
from haulwatch.schemas import TIME_FORMAT


def parse_time(text: ColumnLike) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text to a timestamp; bad text becomes null."""
    return F.try_to_timestamp(col(text), F.lit(TIME_FORMAT))


def time_text(time: ColumnLike) -> Column:
    return F.date_format(col(time), TIME_FORMAT)


def epoch(time: ColumnLike) -> Column:
    return F.unix_seconds(col(time))


def seconds_between(later: ColumnLike, earlier: ColumnLike) -> Column:
    return epoch(later) - epoch(earlier)


def second_of_day(time: ColumnLike) -> Column:
    time = col(time)
    return F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)


def in_daily_range(time: ColumnLike, start: ColumnLike, end: ColumnLike) -> Column:
    """Whether ``time`` lies in the daily range ``start``-``end`` (``HH:mm`` texts).

    Equal texts mean the whole day. A range inside one day is open at both ends and exact to the second;
    a range over midnight looks at hours only; equal hours with different minutes never match.
    """
    start, end = col(start), col(end)

    def part(text: Column, n: int) -> Column:
        return F.try_element_at(F.split(text, ":"), F.lit(n)).try_cast("int")

    start_hour, end_hour = part(start, 1), part(end, 1)
    now = second_of_day(time)
    within_day = (now > start_hour * 3600 + part(start, 2) * 60) & (now < end_hour * 3600 + part(end, 2) * 60)
    hour = F.hour(col(time))
    return (
        F.when(start == end, F.lit(True))
        .when(start_hour < end_hour, within_day)
        .when(start_hour > end_hour, (hour >= start_hour) | (hour < end_hour))
        .otherwise(F.lit(False))
    )


def in_effective_range(time: ColumnLike, start: ColumnLike, end: ColumnLike) -> Column:
    """Strictly between two ``yyyy-MM-dd HH:mm:ss`` texts."""
    now = epoch(time)
    return (now > epoch(parse_time(start))) & (now < epoch(parse_time(end)))


def duration_text(seconds: Column) -> Column:
    """Duration label of an alarm; from one hour on, the second part is ``seconds % 60``."""
    hours = F.floor(seconds / 3600)
    return F.when(
        hours >= 1, F.concat(hours.cast("string"), F.lit("小时"), (seconds % 60).cast("string"), F.lit("分"))
    ).otherwise(F.concat(F.floor(seconds / 60).cast("string"), F.lit("分")))


def partition_ids(df: DataFrame, time: ColumnLike) -> DataFrame:
    """Add the ``month_id`` / ``day_id`` / ``hour_id`` text columns tables are partitioned by."""
    time = col(time)
    return df.withColumns(
        {
            "month_id": F.date_format(time, "yyyy-MM"),
            "day_id": F.dayofmonth(time).cast("string"),
            "hour_id": F.hour(time).cast("string"),
        }
    )

"""Scans of the record streams: JSON text and terminal frames, batch or streaming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulwatch import schemas
from haulwatch.functions.frames import decode_frames
from haulwatch.functions.timefn import parse_time


def read(spark: SparkSession, fmt: str, options: dict[str, str] | None = None, path: str | None = None,
         schema: T.StructType | str | None = None, streaming: bool = False) -> DataFrame:
    """Open a source; ``fmt`` is any installed connector (``kafka``, ``text``, ``parquet``, ...)."""
    reader = (spark.readStream if streaming else spark.read).format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def _parsed(
    df: DataFrame, schema: T.StructType, value_col: str, columns: Sequence[str] | None
) -> tuple[DataFrame, Column, Column]:
    """``df`` with the fields as text, the typed record, and why it is unreadable (null if it is not).

    Fields are read as text and then converted, so quoted and decimal numbers are read as numbers (a whole-number field
    takes the whole part). A record is unreadable if its text is no JSON object, or if a field holds text that is not
    of its type; null and empty text are missing values. ``columns`` limits the fields that are parsed.
    """
    fields = [f for f in schema.fields if columns is None or f.name in columns]
    texts = T.StructType([*(T.StructField(f.name, T.StringType()) for f in fields), T.StructField("_corrupt", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    # Through generators, so that the text is parsed once and each field is converted once.
    once = lambda rows, value, name: rows.select("*", F.inline(F.array(F.struct(value.alias(name)))))
    parsed = once(df, F.from_json(F.col(value_col).cast("string"), texts, options), "_text")
    text = lambda f: F.col("_text")[f.name]
    given = lambda f: F.nullif(F.trim(text(f)), F.lit(""))
    parsed = once(parsed, F.struct(*[(text(f) if isinstance(f.dataType, T.StringType) else _converted(given(f), f.dataType)).alias(f.name) for f in fields]), "_record")
    wrong = [
        F.when(F.col("_record")[f.name].isNull() & given(f).isNotNull(), F.lit(f"{f.name}: not a {f.dataType.simpleString()}"))
        for f in fields if not isinstance(f.dataType, T.StringType)
    ]
    broken = F.when(F.col("_text").isNull() | F.col("_text._corrupt").isNotNull(), F.lit("not a JSON object"))
    return parsed, F.col("_record"), F.coalesce(broken, *wrong)


def _converted(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.IntegralType):
        return F.coalesce(text.try_cast(kind), text.try_cast("decimal(38,9)").try_cast(kind))
    return text.try_cast(kind)


def scan_json(
    df: DataFrame, schema: T.StructType, value_col: str = "value", columns: Sequence[str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Readable records as typed columns, after the columns ``keep`` of ``df``; missing fields are null.

    ``rejected_json`` has the others. A generator drops them: a filter on all fields at once is more than the optimizer's
    inference of constraints can take.
    """
    parsed, record, reason = _parsed(df, schema, value_col, columns)
    return parsed.select(*keep, F.inline(F.when(reason.isNull(), F.array(record))))


def rejected_json(
    df: DataFrame, schema: T.StructType, value_col: str = "value", columns: Sequence[str] | None = None
) -> DataFrame:
    """Unreadable records: the columns of ``df`` and ``reason``."""
    parsed, _, reason = _parsed(df, schema, value_col, columns)
    return parsed.select(*df.columns, F.explode(F.when(reason.isNotNull(), F.array(reason))).alias("reason"))


def typed(df: DataFrame) -> DataFrame:
    """Position text fields as types: ``time`` a timestamp, ``speed`` a number; bad text becomes null."""
    kinds = {"time": parse_time("time"), "speed": F.col("speed").try_cast("double")}
    return df.withColumns({name: value for name, value in kinds.items() if name in df.columns})


def scan_positions(df: DataFrame, value_col: str = "value", schema: T.StructType = schemas.RAW_POSITION, columns: Sequence[str] | None = None) -> DataFrame:
    """Position records; ``columns`` limits the fields that are parsed (``time`` and ``speed`` are needed)."""
    return typed(scan_json(df, schema, value_col, columns))


def scan_bus(df: DataFrame, value_col: str = "value", columns: Sequence[str] | None = None) -> DataFrame:
    return typed(scan_json(df, schemas.DATA_BUS, value_col, columns))


def with_row_key(df: DataFrame, *parts: str) -> DataFrame:
    """Add the unique numeric ``row_key`` that detectors need, from columns that tell records apart.

    A broker's partition and offset are whole numbers: the partition takes the upper 16 bits. Other columns are hashed.
    """
    if len(parts) == 2 and all(isinstance(df.schema[c].dataType, T.IntegralType) for c in parts):
        return df.withColumn("row_key", F.shiftleft(F.col(parts[0]).cast("long"), 47).bitwiseOR(F.col(parts[1]).cast("long")))
    return df.withColumn("row_key", F.xxhash64(*parts))


def scan_frames(df: DataFrame, hex_col: str = "frame") -> DataFrame:
    """Decoded position frames; ``createdatetime`` is the time of reading."""
    read_at = F.date_format(F.current_timestamp(), schemas.TIME_FORMAT)
    return typed(decode_frames(df, hex_col)).withColumn("createdatetime", read_at)


def scan_alarms(df: DataFrame, value_col: str = "value", columns: Sequence[str] | None = None) -> DataFrame:
    alarms = typed(scan_json(df, schemas.ALARM, value_col, columns))
    return alarms.withColumns({c: parse_time(c) for c in ("alarm_start_time", "alarm_end_time") if c in alarms.columns})


def scan_trips(df: DataFrame, value_col: str = "value") -> DataFrame:
    trips = scan_json(df, schemas.TRIP, value_col)
    return trips.withColumn("vehicle_empty", F.coalesce("vehicle_empty", F.lit(1)))

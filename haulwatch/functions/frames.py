"""Terminal frames (message 0x0200) as Column expressions over hex text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwatch.functions.exprs import ColumnLike, col

# Fixed values of the terminal protocol: message id, header layout, body layout, item ids, flag bits.
POSITION_MESSAGE = "0200"
LENGTH_MASK = 0x3FF
ENCRYPTION_MASK = 0x1C00
ENCRYPTION_SHIFT = 10
SUBPACKAGE_MASK = 0x2000
HEADER_BYTES = 12
SUBPACKAGE_HEADER_BYTES = 16
FIXED_BODY_BYTES = 28
MILEAGE_ITEM = 0x01
MAIN_OIL_ITEM = 0x02
WORD_BYTES = 7
ACC_BIT, LOCATED_BIT = 0, 1
SHARP_TURN_BIT, BRAKE_BIT = 15, 17


def hex_number(text: Column) -> Column:
    return F.conv(text, 16, 10).try_cast("long")


def _bytes(text: Column, start: int | Column, count: int | Column) -> Column:
    """``count`` bytes from byte ``start`` (0-based) of hex text."""
    start = F.lit(start) if isinstance(start, int) else start
    count = F.lit(count) if isinstance(count, int) else count
    return F.substring(text, start * 2 + 1, count * 2)


def _bit(number: Column, bit: int) -> Column:
    return F.shiftright(number, bit).bitwiseAND(F.lit(1)).cast("int")


def _with_xor_of_bytes(df: DataFrame, text: Column, name: str) -> DataFrame:
    """Add the exclusive or of all bytes of hex ``text``: folds words of seven bytes, then the bytes of the result.

    Works in steps over helper columns, since a loop body would evaluate them again at every turn.
    """
    digits = WORD_BYTES * 2
    words = F.ceil(F.length(text) / digits).cast("int")
    df = df.withColumn("_padded", F.rpad(text, words * digits, F.lit("0")))
    padded = F.col("_padded")
    df = df.withColumn(
        "_words",
        F.transform(
            F.sequence(F.lit(0), F.floor(F.length(padded) / digits).cast("int")),
            lambda i: F.coalesce(hex_number(_bytes(padded, i * WORD_BYTES, WORD_BYTES)), F.lit(0)),
        ),
    )
    df = df.withColumn("_folded", F.aggregate("_words", F.lit(0).cast("long"), lambda acc, w: acc.bitwiseXOR(w)))
    parts = [F.shiftright("_folded", 8 * i).bitwiseAND(F.lit(0xFF)) for i in range(WORD_BYTES)]
    return df.withColumn(name, reduce(lambda a, b: a.bitwiseXOR(b), parts)).drop("_padded", "_words", "_folded")


def body_items(tail: Column, values: Column) -> Column:
    """Additional items, as an array of ``(id, length, hex)``; stops at the end of the body.

    ``tail`` is the hex text after the fixed part of the body and ``values`` its bytes as numbers.
    """
    size = F.size(values)
    none = F.array().cast("array<struct<id:int,length:int,hex:string>>")
    # An item takes at least two bytes, so this many steps reach the end.
    steps = F.sequence(F.lit(0), F.floor(size / 2).cast("int"))

    def step(acc: Column, _: Column) -> Column:
        at = acc["at"]
        length = F.get(values, at + 1)
        item = F.struct(F.get(values, at).alias("id"), length.alias("length"), _bytes(tail, at + 2, length).alias("hex"))
        following = F.struct((at + 2 + length).alias("at"), F.concat(acc["items"], F.array(item)).alias("items"))
        stop = F.struct(size.alias("at"), acc["items"].alias("items"))
        return F.when((at + 2 <= size) & (at + 2 + length <= size), following).otherwise(stop)

    start = F.struct(F.lit(0).alias("at"), none.alias("items"))
    return F.aggregate(steps, start, step, lambda acc: acc["items"])


def _item(items: Column, item_id: int) -> Column:
    """Value of an item; of several with the same id the last one."""
    found = F.filter(items, lambda i: i["id"] == item_id)
    return hex_number(F.try_element_at(found, F.lit(-1))["hex"])


def decode_frames(df: DataFrame, hex_col: ColumnLike = "frame") -> DataFrame:
    """Decode position frames; rows with another message id are dropped. Keeps the other columns of ``df``.

    Enclosing ``7e`` delimiters are removed. ``checksum_ok`` tells whether the last byte is the exclusive or of
    the bytes before it; a wrong one does not drop the row.
    """
    text = F.upper(F.trim(col(hex_col)))
    wrapped = text.startswith("7E") & text.endswith("7E") & (F.length(text) >= 4)
    text = F.when(wrapped, F.substring(text, F.lit(3), F.length(text) - 4)).otherwise(text)
    frame = df.filter(col(hex_col).rlike(rf"^\s*(7[eE])?{POSITION_MESSAGE}")).withColumn("_x", text)
    x = F.col("_x")
    frame = frame.withColumn("_props", hex_number(_bytes(x, 2, 2)))
    props = F.col("_props")
    split = props.bitwiseAND(SUBPACKAGE_MASK) != 0
    start = F.when(split, SUBPACKAGE_HEADER_BYTES).otherwise(HEADER_BYTES)
    frame = frame.withColumn("_body", _bytes(x, start, props.bitwiseAND(LENGTH_MASK)))
    body = F.col("_body")
    frame = frame.withColumn("_tail", _bytes(body, FIXED_BODY_BYTES, LENGTH_MASK))
    tail = F.col("_tail")
    count = F.floor(F.length(tail) / 2).cast("int")
    places = F.slice(F.sequence(F.lit(0), count), F.lit(1), count)
    frame = frame.withColumn("_values", F.transform(places, lambda i: hex_number(_bytes(tail, i, 1)).cast("int")))
    frame = frame.withColumns(
        {
            "_items": body_items(tail, F.col("_values")),
            "_alarm": hex_number(_bytes(body, 0, 4)),
            "_state": hex_number(_bytes(body, 4, 4)),
        }
    )

    def number(at: int, count: int) -> Column:
        return hex_number(_bytes(body, at, count))

    frame = _with_xor_of_bytes(frame, F.substring(x, F.lit(1), F.length(x) - 2), "_xor")
    mileage, oil = _item(F.col("_items"), MILEAGE_ITEM), _item(F.col("_items"), MAIN_OIL_ITEM)
    lng, lat = number(12, 4) / 1e6, number(8, 4) / 1e6
    clock = F.try_to_timestamp(F.concat(F.lit("20"), _bytes(body, 22, 6)), F.lit("yyyyMMddHHmmss"))
    return frame.select(
        *df.columns,
        props.bitwiseAND(LENGTH_MASK).alias("body_length"),
        F.shiftright(props.bitwiseAND(ENCRYPTION_MASK), ENCRYPTION_SHIFT).alias("encryption"),
        F.when(split, hex_number(_bytes(x, 12, 2))).alias("subpackages"),
        F.when(split, hex_number(_bytes(x, 14, 2))).alias("subpackage_seq"),
        hex_number(_bytes(x, 10, 2)).alias("flow_id"),
        (hex_number(F.right(x, F.lit(2))) == F.col("_xor")).alias("checksum_ok"),
        F.regexp_replace(_bytes(x, 4, 6), "^0", "").alias("devid"),
        F.date_format(clock, "yyyy-MM-dd HH:mm:ss").alias("time"),
        lng.alias("lng"),
        lat.alias("lat"),
        F.concat(lat.cast("string"), F.lit(","), lng.cast("string")).alias("point"),
        (number(18, 2) / 10).cast("string").alias("speed"),
        number(20, 2).cast("string").alias("pos"),
        number(16, 2).cast("int").alias("altitude"),
        _bit(F.col("_state"), LOCATED_BIT).cast("string").alias("gpsflag"),
        _bit(F.col("_state"), ACC_BIT).cast("string").alias("accflag"),
        F.lit("0").alias("auxiliaryflag"),
        F.when(mileage.isNull(), F.lit("0")).otherwise(F.format_string("%.2f", mileage / 10)).alias("gpsdistance"),
        (oil / 10).cast("string").alias("mainoilper"),
        _bit(F.col("_alarm"), SHARP_TURN_BIT).cast("string").alias("sharpturn"),
        _bit(F.col("_alarm"), BRAKE_BIT).cast("string").alias("brake"),
        F.col("_alarm").alias("alarm_bits"),
        F.col("_state").alias("state_bits"),
        F.col("_items").alias("items"),
    )

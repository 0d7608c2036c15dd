"""Dimension joins that neither multiply rows nor pile a hot key onto one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulwatch.functions.exprs import ColumnLike, col

# A side is broadcast only when its rows are below this bound.
BROADCAST_BYTES = 64 << 20
# Up to here the optimizer's estimate is believed; it is made from compressed files, so that above it the rows are measured.
BELIEVED_BYTES = 1 << 20
# Copies of each dimension row in a shuffled join; the fact rows of one key spread over as many tasks. A session with many
# shuffle partitions gets more of both.
SALTS, MOST_SALTS, PARTITIONS_PER_SALT = 16, 256, 8
# All copies of a dimension together, beyond one: a larger dimension has fewer, and the session splits skewed partitions.
COPIES_BYTES = 512 << 20


def plan_bytes(df: DataFrame) -> int:
    """Optimizer's estimate of the size of ``df``; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def source_bytes(df: DataFrame) -> int:
    """Estimated size of all tables ``df`` is made from; no job runs."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def _fixed_bytes(kind: T.DataType) -> int | None:
    """Bytes of a value in a row; None where values differ."""
    if isinstance(kind, T.StructType):
        parts = [_fixed_bytes(f.dataType) for f in kind.fields]
        return None if None in parts else 16 + sum(parts)
    return None if isinstance(kind, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.VariantType)) else 8


def _value_bytes(value: Column, kind: T.DataType) -> Column:
    fixed = _fixed_bytes(kind)
    if fixed is not None:
        return F.lit(fixed)
    if isinstance(kind, T.StructType):
        return sum((_value_bytes(value[f.name], f.dataType) for f in kind.fields), F.lit(16))
    if isinstance(kind, T.ArrayType) and (each := _fixed_bytes(kind.elementType)) is not None:
        return 16 + each * F.greatest(F.coalesce(F.size(value), F.lit(0)), F.lit(0))
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return 8 + F.coalesce(F.octet_length(value), F.lit(0))
    return 8 + F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0))


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows of ``df``, by a job over it."""
    row = sum((_value_bytes(df[f"`{f.name}`"], f.dataType) for f in df.schema.fields), F.lit(16))
    return df.agg(F.sum(row)).first()[0] or 0


def _size_up_to(df: DataFrame, limit: int, growth: int) -> int | None:
    """A size of ``df`` that is not above ``limit``: the estimate where that is small, else the measured one; None above."""
    estimate = plan_bytes(df) * growth
    if estimate <= min(limit, BELIEVED_BYTES):
        return estimate
    if source_bytes(df) > limit:
        return None
    measured = measured_bytes(df)
    return measured if measured <= limit else None


def fits(df: DataFrame, limit: int, growth: int = 1) -> bool:
    """Whether ``df`` is below ``limit`` bytes, ``growth`` being what the estimate may still be multiplied by.

    The optimizer multiplies the sizes of joined tables, so a dimension joined from small tables can look huge, and takes
    the sizes of compressed files, so one read from them can look small. But for tiny tables the rows are measured.
    """
    return _size_up_to(df, limit, growth) is not None


def one_per_key(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key; among duplicates the greatest remaining columns win, whatever the read order."""
    rest = [c for c in dim.columns if c not in keys]
    if not rest:
        return dim.distinct()
    return dim.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row")).select(*keys, "_row.*")


def salted_join(
    facts: DataFrame, dim: DataFrame, keys: Sequence[str], how: str, max_broadcast: int | None = None, growth: int = 1,
    size: int | None = None,
) -> DataFrame:
    """Equi-join that broadcasts a small ``dim`` and otherwise shuffles on ``keys`` plus a salt.

    ``growth`` is how many rows the estimate may still be multiplied by (an explode the estimate does not see), ``size`` the
    bytes of ``dim`` where they are known. All copies of ``dim`` together are not above ``COPIES_BYTES``, but for the one
    that there must be: a larger dimension is spread by its own keys, and the session splits partitions that are skewed. In streams
    it does not, and they take all copies.
    """
    limit = BROADCAST_BYTES if max_broadcast is None else max_broadcast
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = min(max(SALTS, partitions // PARTITIONS_PER_SALT), MOST_SALTS)
    stream = facts.isStreaming or dim.isStreaming
    if size is None:
        size = _size_up_to(dim, limit if stream else max(limit, COPIES_BYTES), growth)
    if limit > 0 and size is not None and size <= limit:
        return facts.join(F.broadcast(dim), list(keys), how)
    if not stream:
        salts = 1 if size is None else max(1, min(salts, COPIES_BYTES // max(size, 1)))
    spread = ["row_key"] if "row_key" in facts.columns else facts.columns
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    # The optimizer's estimate does not see the copies; without the hint it would broadcast them.
    return salted.join(copies.hint("merge"), [*keys, "_salt"], how).drop("_salt")


def lookup(
    facts: DataFrame, dim: DataFrame, keys: Sequence[str], how: str = "left", max_broadcast: int | None = None
) -> DataFrame:
    """``salted_join`` against one row per key. Column names other than ``keys`` must not overlap."""
    return salted_join(facts, one_per_key(dim, keys), keys, how, max_broadcast)


def _drop_existing(facts: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    return facts.drop(*[c for c in dim.columns if c not in keys and c in facts.columns])


def join_vehicle(p: DataFrame, vehicle: DataFrame, on: str = "car_card_number", **kw) -> DataFrame:
    """Inner join by trimmed plate, or by terminal id when ``on="devid"``; also sets the other identifier."""
    key = {"car_card_number": "car_card_number", "devid": "terminal_id"}[on]
    dim = vehicle.withColumn("_match", F.trim(key)).filter(F.col("_match") != "")
    other = {"car_card_number": "terminal_id", "devid": "car_card_number"}[on]
    dim = dim.drop(key)
    if on == "car_card_number" and other in dim.columns:
        dim = dim.withColumnRenamed(other, "devid")
    p = _drop_existing(p, dim, ["_match"]).withColumn("_match", F.trim(on))
    return lookup(p, dim, ["_match"], "inner", **kw).drop("_match")


def filter_service_fee(d: DataFrame, fee: DataFrame, **kw) -> DataFrame:
    """Keep vehicles with a valid fee (state 0) and set ``service_state`` to 1."""
    valid = fee.filter("state = 0").select("dept_id", "vehicle_id")
    return lookup(d, valid, ["dept_id", "vehicle_id"], "left_semi", **kw).withColumn("service_state", F.lit(1))


def join_driver(d: DataFrame, driver: DataFrame, **kw) -> DataFrame:
    keys = ["dept_id", "driver_id"]
    return lookup(_drop_existing(d, driver, keys), driver, keys, "left", **kw)


def join_enterprise(d: DataFrame, enterprise: DataFrame, **kw) -> DataFrame:
    keys = ["dept_id", "enterprise_id"]
    dim = enterprise.withColumnsRenamed({"lng": "enterprise_lng", "lat": "enterprise_lat"})
    return lookup(_drop_existing(d, dim, keys), dim, keys, "inner", **kw)


def _flag(d: DataFrame, valid: DataFrame, name: str, **kw) -> DataFrame:
    keys = ["dept_id", "vehicle_id"]
    dim = valid.select(*keys).distinct().withColumn(name, F.lit(1))
    return lookup(d.drop(name), dim, keys, "left", **kw).withColumn(name, F.coalesce(name, F.lit(0)))


def flag_transport_card(d: DataFrame, card: DataFrame, **kw) -> DataFrame:
    """``transport_card_state`` is 1 for vehicles with an approved card (state 1), else 0."""
    return _flag(d, card.filter("state = 1"), "transport_card_state", **kw)


def flag_register_card(d: DataFrame, card: DataFrame, **kw) -> DataFrame:
    """``register_card_state`` is 1 for vehicles with a valid register card (state 0), else 0."""
    return _flag(d, card.filter("state = 0"), "register_card_state", **kw)


def active_fence_rules(rule: DataFrame, fence: DataFrame, **kw) -> DataFrame:
    """Valid rules (state 0) with the polygon text of their fence."""
    dim = fence.withColumnRenamed("id", "condition_id").select("condition_id", "coords")
    return lookup(rule.filter("state = 0").drop("coords"), dim, ["condition_id"], "inner", **kw)


def valid_sites(site: DataFrame, dept_id: int | None = None) -> DataFrame:
    """Audited, undeleted disposal sites; columns absent from the table do not restrict."""
    for name, keep in (("is_delete", F.col("is_delete") == 0), ("audit_state", F.col("audit_state") == "1")):
        if name in site.columns:
            site = site.filter(keep)
    return site if dept_id is None else site.filter(F.col("dept_id") == dept_id)


def permitted_sites(card: DataFrame, site: DataFrame, dept_id: int | None = None, **kw) -> DataFrame:
    """Valid register cards with the disposal site they allow."""
    dim = valid_sites(site, dept_id).select(
        "disposal_site_id", F.col("dept_id").alias("site_dept_id"), "disposal_site_name", "lng", "lat"
    )
    cards = card.filter("state = 0").select("dept_id", "vehicle_id", "disposal_site_id")
    return lookup(cards, dim, ["disposal_site_id"], "inner", **kw)


def permit_routes(card: DataFrame, build: DataFrame, disposal: DataFrame, **kw) -> DataFrame:
    """One row per valid permit: its route text, build site and disposal site position."""
    b = build.select("build_site_id", F.col("lng").alias("build_lng"), F.col("lat").alias("build_lat"))
    s = disposal.select("disposal_site_id", F.col("lng").alias("disposal_lng"), F.col("lat").alias("disposal_lat"))
    cards = lookup(card.filter("state = 0"), b, ["build_site_id"], "left", **kw)
    return lookup(cards, s, ["disposal_site_id"], "left", **kw)


def supervised(d: DataFrame) -> DataFrame:
    """Vehicles under supervision; a missing state counts as not supervised."""
    return d.filter((F.col("audit_state") == "1") & (F.col("manage_state") == "1"))


def sanitize_positions(
    p: DataFrame,
    lat: tuple[float, float] = (20.0, 40.0),
    lng: tuple[float, float] = (100.0, 120.0),
    speed: tuple[float, float] = (0.0, 100.0),
    as_of_date: ColumnLike | None = None,
) -> DataFrame:
    """Drop implausible reports and convert the rest from WGS-84 to BD-09.

    Latitude and longitude bounds are open, the speed range is half-open. ``as_of_date`` keeps one report date.
    """
    from haulwatch.functions.geo import wgs2bd

    kept = p.filter(_strictly("lat", lat) & _strictly("lng", lng)).filter(
        (F.col("speed") >= speed[0]) & (F.col("speed") < speed[1])
    )
    if as_of_date is not None:
        day = F.lit(as_of_date) if isinstance(as_of_date, str) else as_of_date
        kept = kept.filter(F.to_date("time") == day.cast("date"))
    bd_lat, bd_lng = wgs2bd("lat", "lng")
    return kept.withColumns({"lat": bd_lat, "lng": bd_lng})


def _strictly(name: str, bounds: tuple[float, float]) -> Column:
    return (col(name) > bounds[0]) & (col(name) < bounds[1])

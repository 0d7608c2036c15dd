"""Ordered scans over a vehicle's positions that stay balanced when one vehicle holds most rows.

A vehicle below ``TARGET_ROWS`` is one window group. A vehicle above it is cut into time slices of about that
many rows (and a second that alone holds more, by ``row_key``); each slice is scanned by its own task and starts from a copy of the last row, and the last mark, of
the slice before it. The result equals the scan over the whole vehicle.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulwatch.functions.timefn import epoch

VEHICLE = ("dept_id", "vehicle_id")
TARGET_ROWS = 4_000_000
DAY = 86400
# A slice never crosses this many seconds.
SLICE_S = 3600
ORDER = ("epoch_s", "row_key")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's checkpoint folder; only a local session may fall back to a folder of its own."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder: a vehicle needs slicing")
        folder = tempfile.mkdtemp(prefix="haulwatch-checkpoint-")
    sc.setCheckpointDir(folder)


def prepare(d: DataFrame, key: Sequence[str] = VEHICLE, target_rows: int | None = TARGET_ROWS) -> DataFrame:
    """Add ``epoch_s`` (whole epoch seconds); where some vehicle exceeds ``target_rows``, also ``hot`` and ``slice``.

    One count over the key columns decides which of the two plans is built. ``target_rows=None`` skips it and keeps
    what an earlier ``prepare`` added, so several detectors can share one count.
    """
    d = d.filter(F.col(key[-1]).isNotNull())
    if "epoch_s" not in d.columns:
        d = d.withColumn("epoch_s", epoch("time"))
    if target_rows is None or "slice" in d.columns:
        return d
    totals = d.groupBy(*key).agg(F.count(F.lit(1)).alias("_total")).filter(F.col("_total") > target_rows)
    if totals.isEmpty():
        return d
    ensure_checkpoint_dir(d.sparkSession)
    # At most (all rows / target_rows) keys are hot, and as many hours are busy: both stay small at any input size.
    totals = totals.select(*key, F.lit(True).alias("hot")).checkpoint()
    period = F.floor(F.col("epoch_s") / SLICE_S)
    d = d.withColumn("_period", period).join(F.broadcast(totals), list(key), "left")
    d = d.withColumn("hot", F.coalesce("hot", F.lit(False)))
    busy = _busy_hours(d.filter("hot"), key, target_rows).checkpoint()
    d = d.join(F.broadcast(busy), [*key, "_period"], "left")

    zero = F.lit(0).cast("long")
    width = F.coalesce("_width", F.lit(SLICE_S).cast("long"))
    now = F.try_element_at(F.filter("_crowd", lambda c: c["at"] == F.col("epoch_s")), F.lit(1))
    passed = F.size(F.filter("_crowd", lambda c: c["at"] < F.col("epoch_s")))
    parts = {
        "start": F.col("epoch_s") - F.pmod(F.col("epoch_s") - F.col("_period") * SLICE_S, width),
        # Odd while inside a crowded second, even between two of them.
        "turn": F.coalesce(passed * 2 + now.isNotNull().cast("int"), F.lit(0)).cast("long"),
        "share": F.coalesce(F.floor((F.col("row_key") - now["low"]) / now["step"]), zero),
    }
    here = F.struct(*[c.alias(n) for n, c in parts.items()])
    nowhere = F.struct(*[zero.alias(n) for n in parts])
    return d.withColumn("slice", F.when(F.col("hot"), here).otherwise(nowhere)).drop("_period", "_width", "_crowd")


def _busy_hours(hot: DataFrame, key: Sequence[str], target_rows: int) -> DataFrame:
    """Hours of hot keys above ``target_rows``: their slice width, and the seconds that alone exceed it.

    Such a second (a stuck clock) is to be cut by ``row_key``.
    """
    group = [*key, "_period"]
    seconds = hot.groupBy(*group, "epoch_s").agg(
        F.count(F.lit(1)).alias("_n"), F.min("row_key").alias("_low"), F.max("row_key").alias("_high")
    )
    step = F.greatest(F.lit(1), F.ceil((F.col("_high") - F.col("_low") + 1) * target_rows / F.col("_n")))
    cut = F.struct(F.col("epoch_s").alias("at"), F.col("_low").alias("low"), step.alias("step"))
    hours = seconds.groupBy(*group).agg(
        F.sum("_n").alias("_n"), F.collect_list(F.when(F.col("_n") > target_rows, cut)).alias("_crowd")
    )
    width = F.greatest(F.lit(1), F.floor(F.lit(SLICE_S * target_rows) / F.col("_n"))).cast("long")
    return hours.filter(F.col("_n") > target_rows).select(*group, width.alias("_width"), "_crowd")


def group_columns(df: DataFrame, key: Sequence[str]) -> list[str]:
    """Columns that bound one task's group: the key, and the slice where one exists."""
    return [*key, "hot", "slice"] if "slice" in df.columns else list(key)


def ordered_scan(
    df: DataFrame,
    key: Sequence[str],
    payload: Sequence[str] = (),
    mark: Callable[[Column], Column] | None = None,
    before: bool = False,
    following: bool = False,
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """Add ``prev`` (and ``next``): the neighbouring rows of the key, as structs of ``order`` and ``payload``.

    ``mark(prev)`` gives a value or null for each row; ``mark`` then holds the latest value up to the row, or
    up to the row before it when ``before`` is set.
    """
    row = F.struct(*order, *payload)

    def scan(rows: DataFrame, part: Sequence[str], sliced: bool) -> DataFrame:
        window = Window.partitionBy(*part).orderBy(*order)
        out = rows.withColumn("prev", F.lag(row).over(window))
        if following:
            out = out.withColumn("next", F.lead(row).over(window))
        if mark is not None:
            own = mark(F.col("prev"))
            own = F.when(F.col("_ghost"), F.col("_carry")).otherwise(own) if sliced else own
            frame = window.rowsBetween(Window.unboundedPreceding, -1 if before else 0)
            out = out.withColumn("_own", own).withColumn("mark", F.last("_own", ignorenulls=True).over(frame))
        return out.drop("_own")

    if "slice" not in df.columns:
        return scan(df, key, False)

    # The literals let the optimizer drop the other branch when a later scan filters on ``hot`` again.
    cold = scan(df.filter(~F.col("hot")), key, False).withColumn("hot", F.lit(False))
    # Several branches read the hot rows; the checkpoint computes them once.
    ensure_checkpoint_dir(df.sparkSession)
    hot = df.filter("hot").checkpoint()
    part = [*key, "slice"]
    real = hot.withColumn("_ghost", F.lit(False))
    slices = Window.partitionBy(*key).orderBy("slice")
    ends = hot.groupBy(*part).agg(F.min(row).alias("_first"), F.max(row).alias("_last"))
    ends = ends.withColumns({"_before": F.lag("_last").over(slices), "_after": F.lead("_first").over(slices)})

    def ghosts(edges: DataFrame, name: str, *more: Column) -> DataFrame:
        return edges.filter(F.col(name).isNotNull()).select(*part, f"{name}.*", F.lit(True).alias("_ghost"), *more)

    if mark is None:
        rows = real.unionByName(ghosts(ends, "_before"), allowMissingColumns=True)
    else:
        # Exact marks first, then for each slice the latest mark of all earlier ones.
        exact = real.unionByName(ghosts(ends, "_before"), allowMissingColumns=True)
        exact = exact.withColumn("prev", F.lag(row).over(Window.partitionBy(*part).orderBy(*order)))
        exact = exact.filter(~F.col("_ghost")).withColumn("_own", mark(F.col("prev")))
        marks = exact.groupBy(*part).agg(
            F.max(F.when(F.col("_own").isNotNull(), F.struct(*order, "_own"))).alias("_mark")
        )
        earlier = slices.rowsBetween(Window.unboundedPreceding, -1)
        marks = marks.withColumn("_carry", F.last("_mark._own", ignorenulls=True).over(earlier))
        carried = ends.join(marks.select(*part, "_carry"), part, "left")
        rows = real.unionByName(ghosts(carried, "_before", F.col("_carry")), allowMissingColumns=True)
    if following:
        rows = rows.unionByName(ghosts(ends, "_after"), allowMissingColumns=True)
    warm = scan(rows, part, True).filter(~F.col("_ghost")).drop("_ghost", "_carry")
    return cold.unionByName(warm.withColumn("hot", F.lit(True)))

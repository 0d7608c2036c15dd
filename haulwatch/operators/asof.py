"""Dimensions as they were when a position was reported, so that a replayed day gives what the running query gave.

A history has one row for each change of a key: the columns valid from ``valid_from`` until the next change. ``changes`` makes
one of snapshots, ``as_of`` joins positions with it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulwatch.operators.lookups import salted_join


def changes(snapshots: DataFrame, keys: Sequence[str], taken: str = "taken_at") -> DataFrame:
    """The history of a dimension from snapshots of it: ``keys``, its other columns, ``valid_from`` and ``gone``.

    ``taken`` is when a row's snapshot was taken. What equals the row of the snapshot before is no change; a key that the next
    snapshot lacks is ``gone`` from then on (other columns null). Of several rows of a key in one snapshot the greatest counts.
    """
    others = [c for c in snapshots.columns if c not in (*keys, taken)]
    one = snapshots.dropna(subset=list(keys)).groupBy(*keys, taken).agg(F.max(F.struct(*others)).alias("_row"))
    times = snapshots.select(taken).distinct()  # one row for each snapshot
    following = times.select(taken, F.lead(taken).over(Window.orderBy(taken)).alias("_next_taken"))
    of_key = Window.partitionBy(*keys).orderBy(taken)
    rows = one.join(F.broadcast(following), taken).withColumns({"_after": F.lead(taken).over(of_key), "_before": F.lag("_row").over(of_key), "_last_next": F.lag("_next_taken").over(of_key)})
    same = F.col("_row").eqNullSafe(F.col("_before")) & (F.col("_last_next") == F.col(taken))
    there = rows.filter(~F.coalesce(same, F.lit(False))).select(*keys, F.col(taken).alias("valid_from"), "_row.*", F.lit(False).alias("gone"))
    missed = F.col("_next_taken").isNotNull() & (F.col("_after").isNull() | (F.col("_after") != F.col("_next_taken")))
    nothing = [F.lit(None).cast(snapshots.schema[c].dataType).alias(c) for c in others]
    gone = rows.filter(missed).select(*keys, F.col("_next_taken").alias("valid_from"), *nothing, F.lit(True).alias("gone"))
    return there.unionByName(gone)


def as_of(d: DataFrame, history: DataFrame, keys: Sequence[str], name: str, time: str = "time", max_broadcast: int | None = None) -> DataFrame:
    """Positions with the row of the history that held at their time in the struct ``name``; null before the first change and
    while a key is ``gone``.

    A key's changes are one array, as long as it has changed (of those at one time the greatest counts), so each position stays
    one row and meets one; the array is broadcast or joined with a salt like any dimension.
    """
    others = [c for c in history.columns if c not in (*keys, "valid_from", "gone")]
    gone = F.col("gone") if "gone" in history.columns else F.lit(False)
    version = F.struct(F.col("valid_from").alias("since"), gone.alias("gone"), F.struct(*others).alias("row"))
    held = history.dropna(subset=["valid_from"]).groupBy(*keys).agg(F.sort_array(F.collect_list(version)).alias("_versions"))
    joined = salted_join(d, held, keys, "left", max_broadcast)
    last = F.try_element_at(F.filter("_versions", lambda v: v["since"] <= F.col(time)), F.lit(-1))
    joined = joined.withColumn("_held", last)
    return joined.select(*[c for c in d.columns if c != name], F.when(~F.col("_held.gone"), F.col("_held.row")).alias(name))

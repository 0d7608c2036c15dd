"""Building blocks of the violation rules: sustain, cooldown, once a day, latest row."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulwatch.operators.sequence import DAY, ordered_scan

# A slice of candidate times spans at least this many cooldowns and this many seconds.
COOLDOWNS_PER_SLICE = 12
SLICE_SECONDS = DAY


def sustained(df: DataFrame, key: Sequence[str], violating: Column, minutes: Column | int) -> DataFrame:
    """Violating rows whose unbroken run of violations began more than ``minutes`` ago; adds ``active_t``.

    A run starts at the first violating row after a clean one. Rows that are not in ``df`` do not break it.
    """
    df = df.withColumn("_bad", F.coalesce(violating, F.lit(False)))
    run_start = F.when(F.col("_bad") & ~F.coalesce(F.col("prev._bad"), F.lit(False)), F.col("epoch_s"))
    out = ordered_scan(df, key, ["_bad"], mark=lambda prev: run_start)
    wait = (F.lit(minutes) if isinstance(minutes, int) else minutes) * 60
    return (
        out.filter(F.col("_bad") & (F.col("epoch_s") - F.col("mark") > wait))
        .withColumnRenamed("mark", "active_t")
        .drop("_bad", "prev")
    )


def first_per_day(df: DataFrame, key: Sequence[str], day: Column | None = None) -> DataFrame:
    """The first row of each key and day, by ``epoch_s`` then ``row_key``; combined before the shuffle."""
    rest = [c for c in df.columns if c not in key]
    day = F.floor(F.col("epoch_s") / DAY) if day is None else day
    return (
        df.groupBy(*key, day.alias("_day"))
        .agg(F.min_by(F.struct(*rest), F.struct("epoch_s", "row_key")).alias("_row"))
        .select(*key, "_row.*")
    )


def latest_position(df: DataFrame, key: Sequence[str], order: Sequence[str] = ("epoch_s", "row_key")) -> DataFrame:
    """The last row of each key; combined before the shuffle."""
    rest = [c for c in df.columns if c not in key]
    return (
        df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")).select(*key, "_row.*")
    )


STAIRS = T.ArrayType(T.StructType([T.StructField("entry", T.LongType()), T.StructField("exit", T.LongType())]))
ENTRIES = T.ArrayType(T.StructType([T.StructField("_slice", T.LongType()), T.StructField("_entry", T.LongType())]))
NEVER = -(1 << 60)


@F.pandas_udf(STAIRS)
def _stairs(times: pd.Series, reach: pd.Series, cooldown: pd.Series) -> pd.Series:
    """Per slice: for every time the first firing may have, the time of the slice's last firing.

    Entries that lead to the same last firing are merged into the latest of them. Nothing before the slice reaches
    its candidates from ``reach`` on.
    """

    def one(ts, limit, gap):
        ts = np.asarray(ts, dtype=np.int64)
        entries = np.arange(min(np.searchsorted(ts, limit) + 1, len(ts)))
        after = np.searchsorted(ts, ts + gap, side="right")
        at = entries
        while (moving := after[at] < len(ts)).any():
            at = np.where(moving, after[np.minimum(at, len(ts) - 1)], at)
        keep = np.append(at[1:] != at[:-1], True)
        return [{"entry": int(ts[e]), "exit": int(ts[x])} for e, x in zip(entries[keep], at[keep], strict=True)]

    return pd.Series([one(*args) for args in zip(times, reach, cooldown, strict=True)])


@F.pandas_udf(ENTRIES)
def _entries(summaries: pd.Series, cooldown: pd.Series) -> pd.Series:
    """Per key: the last firing before each of its slices, from the slices' stairs."""

    def one(slices, gap):
        last, out = NEVER, []
        for s in sorted(slices, key=lambda s: s["_slice"]):
            out.append({"_slice": s["_slice"], "_entry": last})
            last = next((x["exit"] for x in s["_stairs"] if x["entry"] > last + gap), last)
        return out

    return pd.Series([one(*args) for args in zip(summaries, cooldown, strict=True)])


@F.pandas_udf(T.ArrayType(T.LongType()))
def _firings(times: pd.Series, entry: pd.Series, cooldown: pd.Series) -> pd.Series:
    """Per slice: the candidates that fire after the last firing before it."""

    def one(ts, last, gap):
        ts, out = np.asarray(ts, dtype=np.int64), []
        while (at := np.searchsorted(ts, last + gap, side="right")) < len(ts):
            last = ts[at]
            out.append(int(last))
        return out

    return pd.Series([one(*args) for args in zip(times, entry, cooldown, strict=True)])


def cooldown(
    df: DataFrame, key: Sequence[str], seconds: int, tie: Sequence[str] = ("row_key",), slice_s: int = SLICE_SECONDS,
) -> DataFrame:
    """Candidates that fire: the first of a key, then each more than ``seconds`` after the last one fired.

    Which candidate fires depends on the one before, so a key is a chain. The chain is run over times alone: a key's
    distinct candidate seconds are grouped into time slices, and a slice is summarised by how it maps the last firing
    before it to its own last firing. Only these summaries of a key meet in one task; slices then fire independently.
    The few fired seconds are joined back to the candidates, whose other columns are never gathered.
    """
    df = df.drop("hot", "slice")
    rest = [c for c in df.columns if c not in (*key, "epoch_s")]
    span = max(seconds * COOLDOWNS_PER_SLICE, slice_s)
    gap = F.lit(seconds).cast("long")
    at = (F.col("epoch_s") - F.pmod(F.col("epoch_s"), F.lit(span))).alias("_slice")
    # At most one long for each second of a slice.
    slices = df.groupBy(*key, at).agg(F.sort_array(F.collect_set("epoch_s")).alias("_times"))
    stairs = slices.select(*key, "_slice", _stairs("_times", F.col("_slice") + gap, gap).alias("_stairs"))
    chains = stairs.groupBy(*key).agg(F.collect_list(F.struct("_slice", "_stairs")).alias("_all"))
    starts = chains.select(*key, F.inline(_entries("_all", gap)))
    fired = _same_key(slices, starts, [*key, "_slice"]).select(*key, F.explode(_firings("_times", "_entry", gap)).alias("epoch_s"))
    return (
        _same_key(df, fired, [*key, "epoch_s"])
        .groupBy(*key, "epoch_s")
        .agg(F.min_by(F.struct(*rest), F.struct(*tie)).alias("_row"))
        .select(*key, "epoch_s", "_row.*")
    )


def _same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on keys of which null is a value like any other."""
    right = right.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    on = [left[k].eqNullSafe(right[f"_of_{k}"]) for k in keys]
    return left.join(right, on, "inner").drop(*[f"_of_{k}" for k in keys])

"""Visits of vehicles to the sites of a cell, found in arrays: a task gets the sites of a cell and, vehicle by vehicle in time
order, the reports around it. Pairs of a report and a site exist in blocks of a bounded number only.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulwatch.functions.geo import EARTH_RADIUS_M
from haulwatch.operators.lookups import salted_join
from haulwatch.operators.sequence import VEHICLE
from haulwatch.operators.spatial import in_home_cells

# Pairs of a report and a site of its cell that one task compares.
TASK_PAIRS = 20_000_000
# Reports of one vehicle around one cell that a worker holds.
HOME_ROWS = 1_000_000
# Pairs compared at once, and reports that are enough for such a block.
BLOCK, BLOCK_REPORTS = 1 << 18, 256
# Bytes of a cell's counts, for the broadcast size check.
COUNT_BYTES = 96
# Stands for a missing second: added to or taken from any other it stays far off.
NEVER = 1 << 62
# Cosines of angles are right to much less than this.
COSINE_ERROR = 1e-14

CELL = ["dept_id", "_cx", "_cy"]
GROUP = [*CELL, "_share", "_site_share"]
VISIT = [*VEHICLE, "disposal_site_id", "enter_time", "exit_time"]


class Counted(NamedTuple):
    """Cells that have sites and reports around them, with the numbers of both and of the reports of one vehicle at most (``_n``, ``_m``,
    ``_most``); the number of such cells, of all pairs, and the greatest ``_most``."""

    counts: DataFrame
    cells: int
    pairs: int
    most: int


def counted_homes(d: DataFrame, sites: DataFrame, radius_m: float) -> Counted:
    copies, homes = in_home_cells(d.select(*VEHICLE, "lng", "lat"), sites, radius_m)
    reports = copies.groupBy(*VEHICLE, "_cx", "_cy").agg(F.count("*").alias("_n"))
    reports = reports.groupBy(*CELL).agg(F.sum("_n").alias("_n"), F.max("_n").alias("_most"))
    counts = reports.join(homes.groupBy(*CELL).agg(F.count("*").alias("_m")), CELL)
    cells, pairs, most = counts.agg(F.count("*"), F.sum(F.col("_n") * F.col("_m")), F.max("_most")).first()
    return Counted(counts, cells, pairs or 0, most or 0)


def visits_by_home(
    whole: DataFrame, sites: DataFrame, radius_m: float, dwell_s: int, counted: Counted, time: Callable[[Column], Column] = F.timestamp_seconds,
    max_broadcast: int | None = None,
) -> DataFrame:
    """Visits (``VISIT``) from reports ``whole`` with their neighbours ``_from`` and ``_to`` and the vehicle's last second ``_seen``; a site id
    lies in one cell. ``plans.vehicles.site_visits`` says what a visit is. ``time`` is made of each report's seconds, not of each visit's.

    Reports and sites are dealt by cell. A cell with many pairs is shared out by vehicle, and one with many pairs of one vehicle by site, too,
    so that there are as many tasks as the pairs are worth.
    """
    tasks = max(int(whole.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-counted.pairs // TASK_PAIRS))
    by_site = F.ceil(F.col("_most") * F.col("_m") / TASK_PAIRS)
    by_vehicle = F.ceil(F.col("_n") * F.col("_m") / TASK_PAIRS / F.col("_site_shares"))
    shares = counted.counts.withColumn("_site_shares", by_site.cast("int")).withColumn("_shares", by_vehicle.cast("int"))
    shares = shares.select(*CELL, "_shares", "_site_shares")
    copies, homes = in_home_cells(whole, sites, radius_m)
    copies, homes = (salted_join(side, shares, CELL, "inner", max_broadcast, size=counted.cells * COUNT_BYTES) for side in (copies, homes))

    def one_of(name: str, total: str):
        return F.pmod(F.xxhash64(name), F.col(total)).cast("int")

    def each_of(total: str):
        return F.explode(F.sequence(F.lit(0), F.col(total) - 1))

    copies = copies.withColumn("_share", one_of("vehicle_id", "_shares")).withColumn("_site_share", each_of("_site_shares"))
    homes = homes.withColumn("_site_share", one_of("disposal_site_id", "_site_shares")).withColumn("_share", each_of("_shares"))
    reports = copies.select(
        *GROUP, "vehicle_id", "epoch_s", "row_key", "lng", "lat", F.col("_to.epoch_s").alias("_exit"),
        # A missing key is no other key: it ends no stay.
        F.when(F.col("row_key").isNotNull(), F.col("_to.epoch_s")).alias("_after"),
        F.when(F.col("_from.row_key").isNotNull(), F.col("_from.epoch_s")).alias("_before"),
        F.col("_from.row_key").alias("_before_key"), "_seen", F.lit(False).alias("_is_site"),
    )
    places = homes.select(*GROUP, "disposal_site_id", F.col("site_lng").alias("lng"), F.col("site_lat").alias("lat"), F.lit(True).alias("_is_site"))
    dealt = places.unionByName(reports, allowMissingColumns=True).repartition(tasks, *GROUP)
    dealt = dealt.sortWithinPartitions(*GROUP, F.desc("_is_site"), "disposal_site_id", "vehicle_id", "epoch_s", "row_key", "_exit")
    dealt = dealt.withColumns({"_enter_time": time(F.col("epoch_s")), "_exit_time": time(F.col("_exit"))})
    kinds = zip(VISIT, (*VEHICLE, "disposal_site_id", "_enter_time", "_exit_time"), strict=True)
    visits = T.StructType([T.StructField(name, dealt.schema[c].dataType) for name, c in kinds])
    return dealt.mapInArrow(lambda batches: visits_of_task(batches, radius_m, dwell_s), visits)


def codes(column: pa.ChunkedArray) -> np.ndarray:
    """Numbers that differ where values differ, a missing one being a value."""
    encoded = column.combine_chunks().dictionary_encode()
    return encoded.indices.fill_null(-1).to_numpy(zero_copy_only=False)


def run_starts(rows: pa.Table, names: Sequence[str]) -> np.ndarray:
    """Where values of the named columns begin to differ from those of the row before."""
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for name in names:
        of = codes(rows[name])
        new[1:] |= of[1:] != of[:-1]
    return np.flatnonzero(new)


def whole_runs(batches: Iterator[pa.RecordBatch], names: Sequence[str]) -> Iterator[pa.Table]:
    """The rows of sorted batches in tables that hold all rows of each value of the named columns."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        edge = rows if not held else pa.concat_tables([held[-1].slice(held[-1].num_rows - 1), rows])
        starts = run_starts(edge, names)[1:] - (edge.num_rows - rows.num_rows)
        if len(starts):
            at = int(starts[-1])
            yield pa.concat_tables([*held, rows.slice(0, at)])
            held = []
            rows = rows.slice(at)
        held.append(rows)
    if held:
        yield pa.concat_tables(held)


def on_sphere(lng: np.ndarray, lat: np.ndarray) -> np.ndarray:
    x, y = np.radians(lng), np.radians(lat)
    return np.stack((np.cos(y) * np.cos(x), np.cos(y) * np.sin(x), np.sin(y)), axis=1)


class Reports(NamedTuple):
    """Reports of whole vehicles, each in time order."""

    vehicle: np.ndarray
    lng: np.ndarray
    lat: np.ndarray
    at: np.ndarray
    epoch: np.ndarray
    before: np.ndarray
    after: np.ndarray
    exit: np.ndarray
    seen: np.ndarray
    key: np.ndarray
    before_key: np.ndarray

    def part(self, a: int, b: int) -> Reports:
        return Reports(*(values[a:b] for values in self))


def reports_of(rows: pa.Table, vehicle: np.ndarray) -> Reports:
    def numbers(name: str, missing: int) -> np.ndarray:
        return rows[name].combine_chunks().fill_null(missing).to_numpy(zero_copy_only=False)

    lng, lat = (rows[c].to_numpy() for c in ("lng", "lat"))
    return Reports(
        vehicle, lng, lat, on_sphere(lng, lat), epoch=numbers("epoch_s", -NEVER), before=numbers("_before", -NEVER),
        after=numbers("_after", NEVER), exit=numbers("_exit", NEVER), seen=numbers("_seen", -NEVER),
        key=numbers("row_key", 0), before_key=numbers("_before_key", 0),
    )


class Places:
    """Sites of a cell, by id; one id may have several places."""

    def __init__(self, rows: pa.Table):
        self.group = rows.select(GROUP).slice(0, 1).to_pylist()
        self.first = run_starts(rows, ["disposal_site_id"])
        self.ids = rows["disposal_site_id"].combine_chunks().take(pa.array(self.first))
        self.lng, self.lat = (rows[c].to_numpy() for c in ("lng", "lat"))
        self.at = on_sphere(self.lng, self.lat)
        self.end = np.append(self.first[1:], len(self.lng))

    def near(self, a: int, b: int, r: Reports, radius_m: float) -> np.ndarray:
        """Which reports lie nearer than the radius to places a to b. The cosine decides but where it is too close to the radius's."""
        cosine = self.at[a:b] @ r.at.T
        least = math.cos(min(radius_m / EARTH_RADIUS_M, math.pi))
        inside, near = cosine > least + COSINE_ERROR, cosine > least - COSINE_ERROR
        if np.count_nonzero(near) > np.count_nonzero(inside):
            i, j = np.nonzero(near & ~inside)
            y1, y2 = np.radians(r.lat[j]), np.radians(self.lat[a + i])
            half_chord = np.sin((y2 - y1) / 2) ** 2 + np.cos(y1) * np.cos(y2) * np.sin(np.radians(self.lng[a + i] - r.lng[j]) / 2) ** 2
            inside[i, j] = np.arcsin(np.sqrt(np.minimum(half_chord, 1.0))) * (2.0 * EARTH_RADIUS_M) < radius_m
        return inside

    def blocks(self, r: Reports, radius_m: float) -> Iterator[tuple[int, np.ndarray]]:
        """For sites from a number on, which reports are inside: one row for each site."""
        step = max(1, BLOCK // len(r.lng))
        plain = len(self.first) == len(self.lng)
        for a in range(0, len(self.first), step):
            b = min(a + step, len(self.first))
            if plain:
                yield a, self.near(a, b, r, radius_m)
                continue
            low, high = self.first[a], self.end[b - 1]
            if high - low <= 4 * step:
                yield a, np.logical_or.reduceat(self.near(low, high, r, radius_m), self.first[a:b] - low, axis=0)
                continue
            inside = np.zeros((b - a, len(r.lng)), bool)
            for k in range(a, b):
                for p in range(self.first[k], self.end[k], step):
                    inside[k - a] |= self.near(p, min(p + step, self.end[k]), r, radius_m).any(axis=0)
            yield a, inside


def visits_in(inside: np.ndarray, r: Reports, dwell_s: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Visits from which reports are inside which site: the number of the site, of the report that enters and of the last one inside."""
    n = len(r.lng)
    hits = np.flatnonzero(inside)
    if not len(hits):
        return hits, hits, hits
    site = hits // n
    at = hits - site * n
    whose = r.vehicle[at] + site * n
    first = np.ones(len(hits), bool)
    np.not_equal(whose[1:], whose[:-1], out=first[1:])
    # The vehicle was outside from the report after the one before inside to the report before this one.
    outside = r.before[at[1:]] - r.after[at[:-1]]
    split = first.copy()
    split[1:] |= (outside > dwell_s) & (r.before_key[at[1:]] != r.key[at[:-1]])

    begin = np.flatnonzero(split)
    enter, last = at[begin], at[np.append(begin[1:], len(hits)) - 1]
    start, fresh = r.epoch[enter], first[begin]
    long = (r.epoch[last] - start > dwell_s) & (start != -NEVER)
    # Stays since the last long one of the vehicle at the site, or since its first.
    k = np.arange(len(begin))
    anchor = fresh.copy()
    anchor[1:] |= long[:-1]
    since = k - np.maximum.accumulate(np.where(anchor, k, 0))
    pending = (since & 1).astype(bool)
    closed = np.append(~fresh[1:], False)
    chosen = np.flatnonzero((long | pending) & (closed | (r.seen[last] - r.exit[last] > dwell_s)))
    return site[begin[chosen]], enter[chosen - pending[chosen]], last[chosen]


def visits_of_task(batches: Iterator[pa.RecordBatch], radius_m: float, dwell_s: int) -> Iterator[pa.RecordBatch]:
    """Batches sorted by group: first the sites, then the reports by vehicle, time, key and exit."""
    places = None
    for rows in whole_runs(batches, [*GROUP, "vehicle_id"]):
        starts = run_starts(rows, [*GROUP, "_is_site"])
        for a, b in zip(starts, [*starts[1:], rows.num_rows], strict=True):
            run = rows.slice(a, b - a)
            if run["_is_site"][0].as_py():
                places = Places(run)
            elif places is not None and places.group == run.select(GROUP).slice(0, 1).to_pylist():
                yield from visits_of_run(run, places, radius_m, dwell_s)


def visits_of_run(run: pa.Table, places: Places, radius_m: float, dwell_s: int) -> Iterator[pa.RecordBatch]:
    starts = run_starts(run, ["vehicle_id"])
    ends = np.append(starts[1:], run.num_rows)
    reports = reports_of(run, np.repeat(np.arange(len(starts)), ends - starts))
    dept, vehicle, enter_time, exit_time = (run[c].combine_chunks() for c in (*VEHICLE, "_enter_time", "_exit_time"))
    a = 0
    while a < run.num_rows:  # as many vehicles as make a block
        b = int(ends[np.searchsorted(ends, min(a + BLOCK_REPORTS, run.num_rows))])
        part = reports.part(a, b)
        part = part._replace(vehicle=part.vehicle - part.vehicle[0])
        for site, inside in places.blocks(part, radius_m):
            of, enter, last = visits_in(inside, part, dwell_s)
            if len(of):
                enter, last = pa.array(enter + a), pa.array(last + a)
                taken = [dept.take(last), vehicle.take(last), places.ids.take(pa.array(of + site)), enter_time.take(enter), exit_time.take(last)]
                yield pa.RecordBatch.from_arrays(taken, VISIT)
        a = b

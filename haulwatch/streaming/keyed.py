"""Keyed state of the streaming detectors: typed, folded in time order, with a buffer for reports that arrive out of order.

A transition (``transitions``) takes a state and a report. Its state is a struct of typed columns in one value of the state
store, read and written once per key and batch.

Without ``delay_s``, reports are folded as they arrive, each batch in time order; one older than the last one of its key is
late. With ``delay_s``, reports wait in a list in the state store until no report up to their time is expected any more, i.e.
until the largest time seen by the query is ``delay_s`` ahead, and are then folded in order; an event-time timer releases
those of a key that reports no more. Late is what is older than the last folded one of its key.

Late reports change no state. They are counted in the query's progress (``observedMetrics``, ``late_reports``), and with
``late=True`` come out as rows of the result with ``late_t``, their time, set; ``sinks.split_late`` hands them to a writer of
their own. Spark itself drops (and counts, ``numRowsDroppedByWatermark``) what is more than ``KEEP_S`` behind.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The watermark stays so far behind the largest time, so that late reports reach the fold.
KEEP_S = 366 * 86400
EVENT_TIME = "event_time"
LAST = [T.StructField("t", T.LongType()), T.StructField("row_key", T.LongType())]


def packed(kind: T.DataType, value: Any) -> Any:
    """Nested dicts as the tuples of a typed state."""
    if value is None:
        return None
    if isinstance(kind, T.StructType):
        return tuple(packed(f.dataType, value.get(f.name)) for f in kind.fields)
    if isinstance(kind, T.MapType):
        return {k: packed(kind.valueType, v) for k, v in value.items()}
    if isinstance(kind, T.ArrayType):
        return [packed(kind.elementType, v) for v in value]
    return value


def unpacked(kind: T.DataType, value: Any) -> Any:
    if value is None:
        return None
    if isinstance(kind, T.StructType):
        return {f.name: unpacked(f.dataType, v) for f, v in zip(kind.fields, value, strict=True)}
    if isinstance(kind, T.MapType):
        return {k: unpacked(kind.valueType, v) for k, v in value.items()}
    if isinstance(kind, T.ArrayType):
        return [unpacked(kind.elementType, v) for v in value]
    return value


class OrderedStep(StatefulProcessor):
    """Applies a transition to a key's reports in time order and keeps its state between batches."""

    def __init__(
        self, step: Callable, state: str, rows: T.StructType, out: Sequence[str], keys: Sequence[str], last_only: bool = False,
        order: Sequence[str] = ("t", "row_key"), expire_s: int | None = None, delay_s: int | None = None,
    ):
        self.step, self.state, self.rows, self.out, self.keys = step, T.StructType.fromDDL(state), rows, list(out), list(keys)
        self.last_only, self.order, self.expire_s, self.delay_s = last_only, list(order), expire_s, delay_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        ttl = {} if self.expire_s is None else {"ttlDurationMs": self.expire_s * 1000}
        self.held = handle.getValueState("held", T.StructType([*LAST, *self.state.fields]), **ttl)
        self.waiting = None if self.delay_s is None else handle.getListState("waiting", self.rows)

    def load(self) -> tuple[tuple[int, int] | None, dict]:
        held = self.held.get()
        return (None, {}) if held is None else (tuple(held[:2]), unpacked(self.state, held[2:]))

    def keep(self, last: tuple[int, int] | None, state: dict) -> None:
        if last is not None:
            self.held.update((*last, *packed(self.state, state)))

    def clock(self, timer_values) -> int:
        """The time up to which all reports should be there."""
        return timer_values.getCurrentWatermarkInMs() // 1000 + KEEP_S - (self.delay_s or 0)

    def wake(self, t: int) -> None:
        """Be called once the clock has reached t."""
        self.handle.registerTimer((t + (self.delay_s or 0) - KEEP_S) * 1000)

    def released(self, batch: list[dict], clock: int) -> list[dict]:
        """What may be folded of the new and the waiting reports; the others wait."""
        batch += [unpacked(self.rows, r) for r in self.waiting.get()]
        ready = [r for r in batch if r["t"] <= clock]
        if len(ready) < len(batch):
            rest = [r for r in batch if r["t"] > clock]
            self.waiting.put([packed(self.rows, r) for r in rest])
            self.wake(min(r["t"] for r in rest))
        else:
            self.waiting.clear()
        return ready

    def fold(self, key, batch: list[dict]) -> Iterator[Row]:
        last, state = self.load()
        emitted, late = [], []
        for r in sorted(batch, key=lambda r: [r[c] for c in self.order]):
            at = (r["t"], r["row_key"])
            if last is not None and at < last:
                late.append({"late_t": r["t"], "row_key": r["row_key"], "report": r.get("report")})
                continue
            state, out = self.step(state, r)
            emitted += out
            last = at
        self.keep(last, state)
        self.after(last)
        yield from self.told(key, (emitted[-1:] if self.last_only else emitted) + late)

    def told(self, key, rows: list[dict]) -> Iterator[Row]:
        named = Row(*self.keys, *self.out)
        for r in rows:
            yield named(*key, *(r.get(c) for c in self.out))

    def after(self, last: tuple[int, int] | None) -> None:
        """Called once per key and batch."""

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        batch = [r.asDict() for r in rows]  # event_time goes along, but not into the state
        if self.delay_s is not None:
            self._forget_timers()
            batch = self.released(batch, self.clock(timerValues))
        yield from self.fold(key, batch)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.delay_s is not None:
            yield from self.fold(key, self.released([], self.clock(timerValues)))

    def _forget_timers(self) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)

    def close(self) -> None:
        pass


class StatusStep(OrderedStep):
    """Vehicle status with an event-time timer that reports a silent vehicle as offline."""

    def __init__(self, *args, offline_s: int = 180, grace_s: int = 30, **kw):
        super().__init__(*args, **kw)
        self.offline_s, self.grace_s = offline_s, grace_s

    def _due(self, last: tuple[int, int]) -> int:
        return last[0] + self.offline_s + 1 + (self.grace_s if self.delay_s is None else 0)

    def after(self, last) -> None:
        if self.delay_s is None:
            self._forget_timers()
        if last is not None:
            self.wake(self._due(last))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        clock = self.clock(timerValues)
        if self.delay_s is not None and (ready := self.released([], clock)):
            yield from self.fold(key, ready)
        last, state = self.load()
        if last is None or state.get("offline") or clock < self._due(last):
            return
        state["offline"] = True
        self.keep(last, state)
        moving = state["moving"] if state["moving"] is not None else 1
        yield from self.told(key, [{"t": last[0], "row_key": last[1], "vehicle_status": 1, "online_time": state["online"], "online_status": moving}])

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        seed = initialState.asDict()
        self.keep((seed["t"], -1), {"seen": seed["t"], "online": seed["online_time"], "offline": False})
        self.after((seed["t"], -1))


def timed(d: DataFrame) -> DataFrame:
    """Rows with ``t`` and the clock of the query: it goes by all of them, also by those that no fence or site keeps."""
    return d.withColumn(EVENT_TIME, F.timestamp_seconds("t")).withWatermark(EVENT_TIME, f"{KEEP_S} seconds")


def keyed(
    d: DataFrame, keys: Sequence[str], step: Callable, state: str, fields: dict[str, str], expire_s: int | None = None,
    delay_s: int | None = None, late: bool = False, seed: DataFrame | None = None, processor: type[OrderedStep] = OrderedStep, **kw,
) -> DataFrame:
    """Run a transition per key; ``d``, the result of ``timed`` at first, already holds only the columns that the transition
    needs, ``t``, ``row_key`` and ``event_time`` among them.

    ``state`` is the transition's state as DDL. With ``expire_s``, the state of a key that has been silent for so many seconds
    (of the clock) is removed; it can't be used together with ``delay_s``, which runs by event time.
    """
    if expire_s is not None and (delay_s is not None or processor is not OrderedStep):
        raise ValueError("expire_s goes by the clock, delay_s and timers by event time")
    rows = T.StructType([T.StructField(f.name, f.dataType) for f in d.schema.fields if f.name not in (*keys, EVENT_TIME)])
    given = T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in {**fields, "late_t": "bigint"}.items()))
    schema = T.StructType([T.StructField(k, d.schema[k].dataType) for k in keys] + given.fields)
    mode = "None" if expire_s is None else "ProcessingTime"
    if delay_s is not None or processor is not OrderedStep:
        mode = "EventTime"
    else:
        d = d.drop(EVENT_TIME)
    run = processor(step, state, rows, given.names, keys, expire_s=expire_s, delay_s=delay_s, **kw)
    out = d.groupBy(*keys).transformWithState(run, schema, outputMode="Update", timeMode=mode, initialState=seed)
    out = out.observe("late_reports", F.count_if(F.col("late_t").isNotNull()).alias("n"))
    return out if late else out.filter("late_t is null").drop("late_t")

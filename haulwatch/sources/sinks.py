"""Sinks: JSON records, partitioned tables and the status table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulwatch.schemas import TIME_FORMAT

PARTITIONS = ("month_id", "day_id", "hour_id")


def to_json_value(df: DataFrame, key_col: str | None = None) -> DataFrame:
    """One JSON text per row in ``value``, null fields written; optionally a ``key`` for keyed topics."""
    options = {"ignoreNullFields": "false", "timestampFormat": TIME_FORMAT}
    columns = [F.to_json(F.struct(*df.columns), options).alias("value")]
    if key_col is not None:
        columns.insert(0, F.col(key_col).cast("string").alias("key"))
    return df.select(*columns)


def query_run(batch: DataFrame) -> str:
    """The id of the streaming query that a batch belongs to. Spark keeps it in the checkpoint: a restart has the same one, a
    query with a new checkpoint, whose batches count from 0 again, another. Outside of a query: ``none``."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def append_partitioned(path: str, batch_col: str = "batch_id", run_col: str = "run_id", run: str | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer of a table partitioned by month, day and hour.

    Each batch of each run of a query (``query_run`` unless given) owns one folder below ``path`` (partitions ``run_col`` and
    ``batch_col``), so a batch that is run again replaces its rows instead of adding them twice, and a query with a new
    checkpoint replaces nothing. Spark sizes the files: small hours share tasks, a large one is split.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.hint("rebalance", *PARTITIONS)
        rows.write.mode("overwrite").partitionBy(*PARTITIONS).parquet(f"{path}/{run_col}={run or query_run(batch)}/{batch_col}={batch_id}")

    return write


def write_json(path: str, run: str | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer of JSON records, one folder per batch and run so that only a repeat replaces it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        to_json_value(batch).write.mode("overwrite").text(f"{path}/batch={run or query_run(batch)}-{batch_id}")

    return write


def split_late(write: Callable[[DataFrame, int], None], write_late: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer for results with ``late=True``: late reports go to a writer of their own, results without ``late_t``."""

    def both(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        write(batch.filter("late_t is null").drop("late_t"), batch_id)
        write_late(batch.filter("late_t is not null"), batch_id)
        batch.unpersist()

    return both


def stream_out(df: DataFrame, fmt: str, checkpoint: str, options: dict[str, str] | None = None,
               interval: str | None = "5 seconds", key_col: str | None = None):
    """Start a checkpointed query that writes JSON records to any connector; ``interval=None`` drains what is there."""
    writer = to_json_value(df, key_col).writeStream.format(fmt).options(**(options or {}))
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def stream_batches(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                   interval: str | None = "5 seconds", mode: str = "append"):
    """Start a checkpointed query that hands every micro-batch to ``write``."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()

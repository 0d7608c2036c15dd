"""From detector results to the records and tables the next job reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulwatch import schemas
from haulwatch.functions.timefn import epoch
from haulwatch.operators.blocks import latest_position
from haulwatch.plans.vehicles import STATUS_COLUMNS, STATUS_NAMES, merge_status
from haulwatch.sources.sinks import query_run


def with_report(df: DataFrame) -> DataFrame:
    """Add the columns of the enriched position held as JSON in ``report``; columns of ``df`` win."""
    fields = [f for f in schemas.DATA_BUS.fields if f.name not in df.columns]
    parsed = F.from_json("report", T.StructType(fields))
    return df.select(*[c for c in df.columns if c != "report"], F.inline(F.array(parsed)))


def alarm_records(alarms: DataFrame) -> DataFrame:
    """Streamed alarms in the full alarm layout, ready for ``to_json_value``."""
    return schemas.conform(with_report(alarms), schemas.ALARM)


def initial_status(snapshot: DataFrame, dept_id: int | None = None) -> DataFrame:
    """Online vehicles of a status table, as the ``seed`` of the streaming status."""
    online = snapshot.filter(F.col("vehicle_status").cast("int") == 0)
    if dept_id is not None:
        online = online.filter(F.col("dept_id") == dept_id)
    seen = epoch(F.col("time").cast("timestamp"))
    return online.select("dept_id", "vehicle_id", seen.alias("t"), F.col("online_time").cast("long")).dropna()


KEYS = ["vehicle_id", "dept_id"]
# Parts of the status table by a hash of the key; a micro-batch reads and writes only those it touches.
BUCKETS = 64


def _bucketed(df: DataFrame) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64(*[F.col(k).cast("long") for k in KEYS]), F.lit(BUCKETS)).cast("int"))


COMMITS = "version bigint, run string, batch bigint, whole boolean"
# Versions after which the writer makes one of all; readers that have begun may go on with those before.
COMPACT_AFTER = 64


def _commits(spark: SparkSession, path: str) -> list[Row]:
    """What has been written, by version; compaction leaves about 2 * COMPACT_AFTER records."""
    return sorted(spark.read.schema(COMMITS).json(f"{path}/_commits").collect())


def _commit(spark: SparkSession, path: str, version: int, run: str, batch: int, whole: bool) -> None:
    record = spark.createDataFrame([(version, run, batch, whole)], COMMITS)
    record.coalesce(1).write.mode("overwrite").json(f"{path}/_commits/at={version}")


def _remove(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        at = spark._jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def create_status(snapshot: DataFrame, path: str) -> None:
    """Write the status table that ``upsert_status`` keeps."""
    _bucketed(snapshot).write.partitionBy("bucket").parquet(f"{path}/version=0")
    _commit(snapshot.sparkSession, path, 0, "", -1, True)


def read_status(spark: SparkSession, path: str, before: int | None = None, buckets: list[int] | None = None) -> DataFrame:
    """The status table: of each vehicle the row of its last committed version (below ``before``)."""
    commits = [c for c in _commits(spark, path) if before is None or c.version < before]
    base = max(c.version for c in commits if c.whole)
    rows = spark.read.option("basePath", path).parquet(*[f"{path}/version={c.version}" for c in commits if c.version >= base])
    if buckets is not None:
        rows = rows.filter(F.col("bucket").isin(buckets))
    return latest_position(rows.drop("bucket"), KEYS, ("version",)).drop("version")


def compact_status(spark: SparkSession, path: str) -> None:
    """Make one version of all, and drop those that the one before it had made one of."""
    commits = _commits(spark, path)
    version = commits[-1].version + 1
    _bucketed(read_status(spark, path)).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/version={version}")
    _commit(spark, path, version, "", -1, True)
    last_base = max(c.version for c in commits if c.whole)
    _remove(spark, [f"{path}/{name}={c.version}" for c in commits if c.version < last_base for name in ("version", "_commits/at")])


def upsert_status(path: str, run: str | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer that keeps a status table in versions; ``read_status`` reads it.

    ``create_status`` writes the table before the first batch. A batch writes the rows of the vehicles it touches as the next
    version, made of their rows in the versions before, and then commits it under the query's run and its own id. A batch that is
    run again finds its commit and writes the same version anew; one of a query with a new checkpoint has another run and
    comes after all others. Vehicles absent from the table are not added. A report updates all its columns; falling silent
    updates ``vehicle_status`` only. Every COMPACT_AFTER versions, the writer makes one of all. One query writes a table at a time.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, this_run = batch.sparkSession, run or query_run(batch)
        commits = _commits(spark, path)
        done = [c.version for c in commits if (c.run, c.batch) == (this_run, batch_id)]
        if done and done[-1] != commits[-1].version:
            return  # later versions are made of it
        version = done[-1] if done else commits[-1].version + 1
        touched = batch.select(*KEYS).distinct()
        buckets = [r.bucket for r in _bucketed(touched).select("bucket").distinct().collect()]  # BUCKETS at most
        snapshot = read_status(spark, path, version, buckets).join(touched, KEYS, "left_semi")
        reports = with_report(latest_position(batch.filter("report is not null"), KEYS, ("time", "row_key")))
        figures = ["vehicle_status", "online_time", "online_status"]
        time = F.date_format("time", schemas.TIME_FORMAT).alias("time")
        reports = reports.select(*KEYS, time, *figures, *[c for c in STATUS_COLUMNS if c in reports.columns])
        reports = reports.withColumnsRenamed({c: n for c, n in STATUS_NAMES.items() if c in reports.columns})
        reports = reports.select(*[c for c in reports.columns if c in snapshot.columns])
        # A silent row follows the report it stands for, hence the status in the order.
        last = latest_position(batch, KEYS, ("time", "vehicle_status")).select(*KEYS, "vehicle_status")
        merged = _bucketed(merge_status(merge_status(snapshot, reports), last))
        merged.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/version={version}")
        _commit(spark, path, version, this_run, batch_id, False)
        if version - max(c.version for c in commits if c.whole) >= COMPACT_AFTER:
            compact_status(spark, path)

    return write

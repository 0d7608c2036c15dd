"""Cutting lineage in the cluster's shared folder."""

from __future__ import annotations

import tempfile

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir; a session on one machine without one gets its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="haulwatch-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpointed(rows: DataFrame, files: int | None = None) -> DataFrame:
    """The rows, written to the shared folder and read from there, so that a lost executor costs a read; in at most so many files."""
    shared_folder(rows.sparkSession)
    return (rows.coalesce(files) if files else rows).checkpoint()


def under_plain_names(rows: DataFrame, used: Sequence[str], operate: Callable[..., DataFrame], into: str, without: str | None = None) -> DataFrame:
    """operate(rows, *used), which adds a column "found", on rows whose columns are called c0, c1, ...: no name of theirs can meet one
    that the operator makes up. They come back under their own names (but for without), with found as into, replaced if there."""
    plain = {c: f"c{k}" for k, c in enumerate(rows.columns)}
    found = operate(rows.toDF(*plain.values()), *(plain[c] for c in used))
    return found.select(*(F.col(p).alias(c) for c, p in plain.items() if c not in (into, without)), F.col("found").alias(into))

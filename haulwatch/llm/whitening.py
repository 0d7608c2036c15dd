"""Whitened vectors by distributed block matrices: centred rows, their scatter, its eigenvectors, and the rows on them.

A component c is x = floor(SCALE * c) + SHIFT. One scan gives the number of rows and the sums, least and largest values of each
dimension. Rows get indexes from their place in the checkpointed table, counted on task by task and filled up to whole blocks, so a
task cuts its rows into blocks of BLOCK_VALUES values without a shuffle. The scatter is the product of the block matrix's
transpose and itself, dealt out by splits of the rows (of SPLIT_BLOCKS blocks), each of which sends one square matrix. The
driver holds this matrix (dimensions squared), takes its eigenvectors, and sends the whitening matrix back as a block
matrix, by which the rows are multiplied.

Rows without a usable vector are dropped. Shorter vectors are filled up to the longest one with components of 0; vectors without
components have no row in the result, nor has an empty table. Components beyond 2^45 / SCALE count as that. Repeated rows count
each time. Null keys and labels stay as they are. A deviation beyond the range of a long is null. A component whose eigenvalue is
0 within rounding has null as whitened value and does not count in identity_error (null if all are so).
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml.functions import vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulwatch.llm.arrays import lists
from haulwatch.llm.storage import checkpointed
from haulwatch.llm.vectors import matrix, padded, usable, whole

COMPONENTS, SCALE, SHIFT = 8, 1024, 100_000
#: Values of a block (2 MB), and blocks that a task multiplies at once.
BLOCK_VALUES, SPLIT_BLOCKS = 1 << 18, 16
#: Columns of a block; a longer vector has several.
BLOCK_COLUMNS = 1024
#: What MatrixUDT holds, as Arrow sees it.
BLOCK = pa.schema([
    ("at", pa.struct([("i", pa.int64()), ("j", pa.int64())])),
    ("block", pa.struct([
        ("type", pa.int8()), ("numRows", pa.int32()), ("numCols", pa.int32()), ("colPtrs", pa.list_(pa.int32())),
        ("rowIndices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64())), ("isTransposed", pa.bool_()),
    ])),
])
#: Share of the trace below which an eigenvalue is 0.
NOTHING = 1e-12


class Totals(NamedTuple):
    """Of all rows: their number, and of each dimension the sum and how far n * x is from it at most."""

    n: int
    sums: list[int]
    farthest: int


def dimension_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total, least, most = 0, None, None, None
    for batch in batches:
        column = batch.column(0)
        if not len(column):
            continue
        x = matrix(column, len(column[0]))
        n += len(x)
        now = x.sum(axis=0).astype(object), x.min(axis=0), x.max(axis=0)
        total, least, most = now if total is None else (total + now[0], np.minimum(least, now[1]), np.maximum(most, now[2]))
    if total is not None:
        sums = pa.array([Decimal(int(v)) for v in total], pa.decimal128(38))
        columns = [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(np.full(len(total), n)), sums, pa.array(least), pa.array(most)]
        yield pa.RecordBatch.from_arrays(columns, names=["place", "n", "total", "least", "most"])


def totals(rows: DataFrame) -> Totals:
    found = rows.select("x").mapInArrow(dimension_sums, "place int, n bigint, total decimal(38,0), least bigint, most bigint")
    found = found.groupBy("place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("most").alias("most"))
    places = found.orderBy("place").collect()  # one row for each dimension
    farthest = max((max(abs(p.n * p.most - int(p.total)), abs(p.n * p.least - int(p.total))) for p in places), default=0)
    return Totals(places[0].n if places else 0, [int(p.total) for p in places], farthest)


def indexed(rows: DataFrame, block: int) -> tuple[DataFrame, int]:
    """Rows of a checkpoint with the index of each, and how many indexes there are; each task's begin at a multiple of block."""
    place = F.monotonically_increasing_id()  # the number of the task, then 33 bits for that of the row
    rows = rows.withColumns({"task": F.shiftright(place, 33).cast("int"), "nth": place.bitwiseAND(F.lit((1 << 33) - 1))})
    counts = rows.groupBy("task").agg((F.ceil(F.count("*") / block) * block).cast("long").alias("size"))
    before = F.sum("size").over(Window.orderBy("task")) - F.col("size")  # one row for each task
    counts = checkpointed(counts.select(F.col("task").alias("of"), before.alias("before"), "size"))
    last = counts.agg(F.sum("size")).first()[0] or 0
    rows = rows.join(F.broadcast(counts), F.col("task") == F.col("of"))
    return rows.withColumn("index", F.col("before") + F.col("nth")).drop("task", "nth", "of", "before", "size"), last


def centred(x: np.ndarray, of: Totals) -> np.ndarray:
    """x - S/n: whole part and rest of the mean apart, so that nothing is lost on large numbers."""
    whole_part = np.array([s // of.n for s in of.sums], np.int64)
    rest = np.array([(s % of.n) / of.n for s in of.sums])
    return (x - whole_part).astype(np.float64) - rest


def block_matrix(rows: DataFrame, of: Totals, block: int, last: int) -> BlockMatrix:
    """The centred rows (index, x), in order of index within each task, as blocks; they go to the JVM as Arrow columns of matrices."""
    width = len(of.sums)

    def told(number: int, values: np.ndarray) -> pa.RecordBatch:
        starts = range(0, width, BLOCK_COLUMNS)
        parts = [values[:, c : c + BLOCK_COLUMNS] for c in starts]
        numbers = pa.StructArray.from_arrays([pa.array([number] * len(parts), pa.int64()), pa.array(range(len(parts)), pa.int64())], fields=list(BLOCK.field(0).type))
        ints = lambda v: pa.array(v, pa.int32())
        held = lists(np.concatenate([p.ravel("F") for p in parts]), np.array([p.size for p in parts]))
        none = pa.nulls(len(parts), pa.list_(pa.int32()))
        dense = [pa.array([1] * len(parts), pa.int8()), ints([block] * len(parts)), ints([p.shape[1] for p in parts]), none, none, held, pa.array([False] * len(parts))]
        return pa.RecordBatch.from_arrays([numbers, pa.StructArray.from_arrays(dense, fields=list(BLOCK.field(1).type))], schema=BLOCK)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, values = None, None
        for batch in batches:
            index, x = batch.column(0).to_numpy(), centred(matrix(batch.column(1), width), of)
            for k in np.unique(index // block).tolist():
                if k != number:
                    if number is not None:
                        yield told(number, values)
                    number, values = k, np.zeros((block, width))
                here = index // block == k
                values[index[here] % block] = x[here]
        if number is not None:
            yield told(number, values)

    at = T.StructType([T.StructField("i", T.LongType()), T.StructField("j", T.LongType())])
    blocks = rows.select("index", "x").mapInArrow(cut, T.StructType([T.StructField("at", at), T.StructField("block", MatrixUDT())]))
    side = min(width, BLOCK_COLUMNS)
    return BlockMatrix(callMLlibFunc("createBlockMatrix", blocks, block, side, last, width), block, side)


def scatter(x: BlockMatrix, n_splits: int) -> np.ndarray:
    """The transpose times x. Without splits of the dimension that goes, all rows would meet in one task; they are an argument
    of the JVM's method only."""
    left = x.transpose()
    product = left._java_matrix_wrapper.call("multiply", x._java_matrix_wrapper._java_model, n_splits)
    return BlockMatrix(product, left.rowsPerBlock, x.colsPerBlock).toLocalMatrix().toArray()


def on_axes(x: BlockMatrix, axes: np.ndarray) -> DataFrame:
    """(index, w): the rows multiplied by the axes."""
    context = SparkContext.getOrCreate()
    side = x.colsPerBlock
    parts = [((k, 0), DenseMatrix(len(p), p.shape[1], p.ravel("F"))) for k in range(-(-len(axes) // side)) for p in [axes[k * side : (k + 1) * side]]]
    right = BlockMatrix(context.parallelize(parts, 1), side, axes.shape[1], len(axes), axes.shape[1])
    product = x.multiply(right).toIndexedRowMatrix()
    found = MLUtils.convertVectorColumnsToML(callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model), "vector")
    return found.select("index", vector_to_array("vector").alias("w"))


def deviation(x: Column, of: Totals) -> Column:
    """Sum over the dimensions of (n*x-S)^2."""
    kind = np.int64 if len(of.sums) * of.farthest**2 < 1 << 63 and max(map(abs, of.sums)) + of.farthest < 1 << 63 else object

    @F.arrow_udf(T.LongType())
    def squares(column: pa.Array) -> pa.Array:
        away = matrix(column, len(of.sums)).astype(kind) * of.n - np.array(of.sums, kind)
        return pa.array([v if v < 1 << 63 else None for v in (away * away).sum(axis=1).tolist()], pa.int64())

    return squares(x)


def identity_error(rows: DataFrame, kept: list[int]) -> float | None:
    """The largest entry of the covariance of w (of the components kept) less the identity."""
    if not kept:
        return None
    means = rows.agg(*(F.avg(F.col("w")[k]).alias(f"m{k}") for k in kept)).first()
    apart = {k: F.col("w")[k] - F.lit(means[f"m{k}"]) for k in kept}
    pairs = [(a, b) for a in kept for b in kept if a <= b]
    found = rows.agg(*(F.avg(apart[a] * apart[b]).alias(f"c{a}_{b}") for a, b in pairs)).first()
    return max(abs(found[f"c{a}_{b}"] - (a == b)) for a, b in pairs)


def whiten(vectors: DataFrame, vector: str = "embedding", into: str = "whitened") -> DataFrame:
    """The rows with a usable vector, their columns and into (replaced if there): an array of one struct for each component, with
    component, n, deviation, whitened, explained and identity_error."""
    kept = vectors.where(usable(vectors[vector]) & (F.size(vectors[vector]) > 0))
    names = [F.col(f"`{c}`") for c in vectors.columns if c != into]
    shifted = F.transform(whole(kept[vector], SCALE), lambda v: v + F.lit(SHIFT))
    rows = checkpointed(kept.select(F.struct(*names).alias("row"), shifted.alias("x")))
    width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    rows = rows.withColumn("x", padded(F.col("x"), width, SHIFT))
    of = totals(rows)
    if not of.n:
        kind = "array<struct<component:int,n:bigint,deviation:bigint,whitened:double,explained:double,identity_error:double>>"
        return rows.select("row.*", F.lit(None).cast(kind).alias(into))
    block = max(16, BLOCK_VALUES // width)
    rows, last = indexed(rows, block)
    x = block_matrix(rows, of, block, last)
    covariance = scatter(x, max(1, last // block // SPLIT_BLOCKS)) / of.n
    values, axes = np.linalg.eigh(covariance)
    values, axes, trace = values[::-1][:COMPONENTS], axes[:, ::-1][:, :COMPONENTS], float(np.trace(covariance))
    good = values > NOTHING * trace
    projected = on_axes(x, axes * np.where(good, 1 / np.sqrt(np.where(good, values, 1)), 0))
    rows = rows.select("row", "index", deviation(F.col("x"), of).alias("deviation")).join(projected, "index")
    rows = checkpointed(rows.select("row", "deviation", "w"))
    error = F.lit(identity_error(rows, np.flatnonzero(good).tolist())).cast("double").alias("identity_error")
    found = [
        F.struct(
            F.lit(k + 1).alias("component"), F.lit(of.n).cast("long").alias("n"), "deviation",
            (F.col("w")[k] if good[k] else F.lit(None).cast("double")).alias("whitened"),
            F.lit(float(value) / trace if trace else 0.0).alias("explained"), error,
        )
        for k, value in enumerate(values)
    ]
    return rows.select("row.*", F.array(*found).alias(into))

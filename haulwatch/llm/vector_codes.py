"""Codes of vectors: each is cut into PARTS parts, and a part's code is the nearest entry of its position's codebook.

All arithmetic is on whole numbers. A component c is floor(SCALE * c). A codebook starts as the parts of the ENTRIES smallest keys
and is improved ROUNDS times: each entry becomes the floor of the mean of its parts, place by place; an unused one stays.

The nearest entry is looked for among Walsh-Hadamard coefficients: parts and entries are filled up with zeros to a power of two P
and transformed by additions and subtractions, which makes squared distances P times as large. They are summed up by sequency,
slow waves first, where the differences are largest; an entry goes as soon as its sum exceeds the distance of the entry that looked
best after the first coefficients. What is left at the end has its whole distance; ties go to the lower index.

A round is one scan of the integers (a checkpoint): each task sends the sums of its parts, ENTRIES * width numbers, and the driver
gets as many of all. Rows without a usable vector (null, or with null, NaN or infinite components) are dropped. Vectors are as long
as the longest one, filled up to a multiple of PARTS with zeros; shorter ones are filled up, too. Of a repeated key the least vector
starts an entry, null keys are larger than any other, and fewer keys than ENTRIES make fewer entries. Components beyond
2^45 / SCALE count as that; large ones take exact Python numbers. An error beyond the range of a long is null. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulwatch.llm.storage import checkpointed
from haulwatch.llm.vectors import matrix, padded, usable, whole

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Labels whose sums are sent to all tasks; more are joined by a shuffle, each spread over SALTS tasks.
LABELS, SALTS = 200_000, 16
SUMS = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("place", pa.int32()), ("total", pa.decimal128(38)), ("uses", pa.int64())])


def waves(values: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients by rising sequency of rows of whole numbers, filled up with zeros to a power of two."""
    n, length = values.shape
    size = 1 << max(0, length - 1).bit_length()
    out = np.zeros((n, size), values.dtype)
    out[:, :length] = values
    step = 1
    while step < size:
        pairs = out.reshape(n, size // (2 * step), 2, step)
        out = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(n, size)
        step *= 2
    bits = size.bit_length() - 1
    gray = [s ^ (s >> 1) for s in range(size)]  # the wave with s changes of sign stands where this number, read backwards, says
    return out[:, [int(format(g, f"0{bits}b")[::-1], 2) if bits else 0 for g in gray]]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each part's nearest entry, and the squared distance."""
    largest = max((int(np.abs(a).max()) for a in (parts, entries) if a.size), default=0)
    size = 1 << max(0, parts.shape[1] - 1).bit_length()
    if largest * size >= 1 << 30:  # squares would not fit 64 bits
        parts, entries = parts.astype(object), entries.astype(object)
    a, b = waves(parts), waves(entries)
    lead = max(1, size // 4)
    sums = sum((a[:, k, None] - b[None, :, k]) ** 2 for k in range(lead))
    guess = sums.argmin(axis=1)
    bound = ((a - b[guess]) ** 2).sum(axis=1)
    row, entry = np.nonzero(sums <= bound[:, None])
    sums = sums[row, entry]
    for k in range(lead, size):
        sums = sums + (a[row, k] - b[entry, k]) ** 2
        left = sums <= bound[row]
        row, entry, sums = row[left], entry[left], sums[left]
    starts = np.searchsorted(row, np.arange(len(parts)))
    least = np.minimum.reduceat(sums, starts) if len(parts) else sums
    at = np.flatnonzero(sums == least[row])
    first = at[np.searchsorted(row[at], np.arange(len(parts)))]
    return entry[first], least // size


def parts_of(column: pa.Array, books: np.ndarray) -> Iterator[np.ndarray]:
    """Part by part, the rows' values."""
    n_parts, _, length = books.shape
    rows = matrix(column, n_parts * length)
    for part in range(n_parts):
        yield rows[:, part * length : (part + 1) * length]


def part_sums(books: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each entry the sums of its parts in this task."""
    totals, uses = np.zeros(books.shape, object), np.zeros(books.shape[:2], np.int64)
    for batch in batches:
        for part, values in enumerate(parts_of(batch.column(0), books)):
            index, _ = nearest(values, books[part])
            sums = np.zeros(books.shape[1:], np.int64)
            np.add.at(sums, index, values)
            totals[part] += sums
            uses[part] += np.bincount(index, minlength=books.shape[1])
    part, entry, place = (k.astype(np.int32) for k in np.nonzero(np.broadcast_to(uses[:, :, None] > 0, books.shape)))
    total = pa.array([Decimal(int(v)) for v in totals[part, entry, place]], SUMS.field("total").type)
    yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(entry), pa.array(place), total, pa.array(uses[part, entry])], schema=SUMS)


def improved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round over the rows' x."""
    found = rows.select("x").mapInArrow(lambda batches: part_sums(books, batches), "part int, entry int, place int, total decimal(38,0), uses bigint")
    found = found.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("uses").alias("uses"))
    books = books.copy()
    for r in found.collect():  # ENTRIES * width rows at most
        books[r.part, r.entry, r.place] = int(r.total) // r.uses
    return books


def first_books(rows: DataFrame, width: int) -> np.ndarray:
    """The parts of the vectors with the smallest keys."""
    keys = rows.select(F.col("key").alias("first")).distinct().orderBy(F.asc_nulls_last("first")).limit(ENTRIES)
    found = rows.join(F.broadcast(keys), F.col("key").eqNullSafe(F.col("first")), "left_semi").groupBy("key").agg(F.min("x").alias("x"))
    vectors = [r.x for r in found.orderBy(F.asc_nulls_last("key")).collect()]
    return np.array(vectors, np.int64).reshape(len(vectors), PARTS, width // PARTS).transpose(1, 0, 2).copy()


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def coded(x: Column, books: np.ndarray) -> Column:
    """The code of x, two hex digits a part, and its error."""

    @F.arrow_udf(T.StructType([T.StructField("code", T.StringType()), T.StructField("error", T.DecimalType(38, 0))]))
    def code(column: pa.Array) -> pa.Array:
        found = [nearest(values, books[part]) for part, values in enumerate(parts_of(column, books))]
        indexes = np.stack([index for index, _ in found], axis=1).astype(np.uint8)
        errors = sum(distance.astype(object) for _, distance in found)
        codes = pa.array([r.tobytes().hex() for r in indexes], pa.string())
        return pa.StructArray.from_arrays([codes, pa.array([Decimal(int(e)) for e in errors], pa.decimal128(38))], names=["code", "error"])

    return code(x)


def with_label_error(rows: DataFrame) -> DataFrame:
    """The rows (label, error, ...) with the sum over their label's errors."""
    sums = checkpointed(rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")))
    if sums.count() <= LABELS:
        return rows.join(F.broadcast(sums), F.col("label").eqNullSafe(F.col("of"))).drop("of")
    sums = sums.withColumn("of_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    return rows.join(sums, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("of_salt"))).drop("of", "of_salt", "salt")


def compress(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label", into: str = "codes") -> DataFrame:
    """The rows with a usable vector, their columns and into (replaced if there): code, error, label_error, codebooks_sha256."""
    kept = vectors.where(usable(vectors[vector]))
    names = [F.col(f"`{c}`") for c in vectors.columns if c != into]
    rows = kept.select(F.struct(*names).alias("row"), kept[key].alias("key"), kept[label].alias("label"), whole(kept[vector], SCALE).alias("x"))
    rows = checkpointed(rows)
    longest = rows.agg(F.max(F.size("x"))).first()[0] or 0
    width = PARTS * max(1, -(-longest // PARTS))
    rows = rows.withColumn("x", padded(F.col("x"), width))
    books = first_books(rows, width)
    for _ in range(ROUNDS if books.size else 0):
        books = improved(rows, books)
    rows = checkpointed(rows.select("row", "label", coded(F.col("x"), books).alias("c")).select("row", "label", "c.*"))
    fits = lambda name: F.when(F.col(name) < Decimal(1 << 63), F.col(name)).cast("long").alias(name)
    found = F.struct("code", fits("error"), fits("label_error"), F.lit(digest(books)).alias("codebooks_sha256"))
    return with_label_error(rows).select("row.*", found.alias(into))

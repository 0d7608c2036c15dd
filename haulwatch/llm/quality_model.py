"""Quality classifier: random-indexing word vectors pooled per document, and a small network with calibrated probabilities.

Words are runs of letters and digits, or of other characters, between blanks, case kept. Each has a fixed index vector:
NONZERO of DIM places, +1 or -1, by its hash. Over the whole corpus, a word's context vector adds up the index vectors of the
words up to REACH places away in the same text. Words share BUCKETS rows by their hash, so that the table has one size at any
scale; tasks add up their own tables, and tables are added in two steps, so that no task has to read all of them. A text is
the mean and the spread of its words' vectors (context direction beside the index vector itself).

The network (one hidden layer, then one output) is fitted on the driver, on at most TRAINED labelled rows, those of the least
hash of their id; one in five of them is held back to set the temperature that the output is divided by. Only the text is an
input of the score.

Null and empty texts have a zero vector and a score like any other. Without usable labels of both kinds every score is the
share of good labels (0.5 without any). Rows of the same text have the same score; repeated labels each count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwatch.llm.arrays import BLANK, Texts, Words, blocks, mix, randoms, span_hashes

DIM, BUCKETS, NONZERO, REACH = 32, 1 << 15, 4, 2
TRAINED = 20_000
HIDDEN, EPOCHS, RATE, DECAY = 24, 60, 0.01, 1e-4
THRESHOLD = 0.3
INPUTS = 4 * DIM + 4
#: Rows of the table that travel together, and how many partial sums of them there are in the first step.
ROWS, PARTS = 256, 64
LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the index vector of each bucket."""
    raw = np.stack([mix(np.arange(BUCKETS, dtype=np.uint64) + r) for r in randoms(NONZERO, 11)], axis=1)
    return (raw % np.uint64(DIM)).astype(np.int64), np.where(raw >> np.uint64(63), 1.0, -1.0)


def word_buckets(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each word, and its row."""
    kinds = [Words(texts, LETTERS), Words(texts, ~LETTERS & ~BLANK)]
    start, end, row = (np.concatenate([getattr(w, name) for w in kinds]) for name in ("start", "end", "row"))
    order = np.argsort(start, kind="stable")
    hashes = span_hashes(texts.data, start[order], end[order])
    return (hashes >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64), row[order]


def contexts(texts: Texts, places: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Sums of the index vectors around each word of a block, by bucket."""
    bucket, row = word_buckets(texts)
    total = np.zeros(BUCKETS * DIM)
    for d in range(1, REACH + 1):
        near = np.flatnonzero(row[d:] == row[:-d])
        for a, b in ((bucket[near], bucket[near + d]), (bucket[near + d], bucket[near])):
            for k in range(NONZERO):
                total += np.bincount(a * DIM + places[b, k], signs[b, k], BUCKETS * DIM)
    return total.reshape(BUCKETS, DIM)


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The table of context vectors of the whole corpus: BUCKETS x DIM, whatever the corpus' size."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        total = np.zeros((BUCKETS, DIM))
        for batch in batches:
            for texts in blocks(batch.column(0)):
                total += contexts(texts, places, signs)
        filled = [k for k in range(BUCKETS // ROWS) if total[k * ROWS : (k + 1) * ROWS].any()]
        rows = [total[k * ROWS : (k + 1) * ROWS].tobytes() for k in filled]
        yield pa.record_batch({"part": pa.array([TaskContext.get().partitionId() % PARTS] * len(rows), pa.int32()), "k": pa.array(filled, pa.int32()), "rows": pa.array(rows, pa.binary())})

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column("k").to_pylist(), batch.column("rows"), strict=True):
                values = np.frombuffer(raw.as_buffer())  # whole numbers: their order doesn't matter
                totals[k] = totals[k] + values if k in totals else values
        rows = [v.tobytes() for v in totals.values()]
        yield pa.record_batch({"part": pa.array([0] * len(rows), pa.int32()), "k": pa.array([*totals], pa.int32()), "rows": pa.array(rows, pa.binary())})

    schema = "part int, k int, rows binary"
    tables = docs.select(docs[text]).mapInArrow(added, schema)
    tables = tables.repartition("part", "k").mapInArrow(summed, schema).repartition("k").mapInArrow(summed, schema)
    vectors = np.zeros((BUCKETS, DIM), np.float32)
    for r in tables.collect():  # BUCKETS rows at most
        vectors[r.k * ROWS : (r.k + 1) * ROWS] = np.frombuffer(r.rows).reshape(ROWS, DIM)
    return vectors


def directions(vectors: np.ndarray) -> np.ndarray:
    """What texts are pooled from: the context vector's direction, without what all words share, beside the index vector."""
    size = np.linalg.norm(vectors, axis=1, keepdims=True)
    unit = vectors / np.maximum(size, 1e-9)
    unit -= unit[size[:, 0] > 0].mean(axis=0) if (size > 0).any() else 0
    places, signs = index_vectors()
    own = np.zeros((BUCKETS, DIM))
    for k in range(NONZERO):
        np.add.at(own, (np.arange(BUCKETS), places[:, k]), signs[:, k] / np.sqrt(NONZERO))
    return np.hstack([unit, own]).astype(np.float32)


def pooled(texts: Texts, table: np.ndarray) -> np.ndarray:
    """Mean and spread of the word vectors of each row, the length of the mean's two halves, and how often two words of the
    row are the same."""
    bucket, row = word_buckets(texts)
    n, width = len(texts), table.shape[1]
    size = np.maximum(np.bincount(row, minlength=n), 1)[:, None]
    # words of a row with their counts, so that each is looked up once
    keys, times = np.unique(row * BUCKETS + bucket, return_counts=True)
    r, b = keys // BUCKETS, keys % BUCKETS
    mean, spread = np.zeros((n, width), np.float32), np.zeros((n, width), np.float32)
    edges = np.searchsorted(r, np.arange(n + 1))
    for k in range(n):
        values, weight = table[b[edges[k] : edges[k + 1]]], times[edges[k] : edges[k + 1]].astype(np.float32)
        mean[k] = weight @ values
        spread[k] = weight @ (values * values)
    mean /= size
    spread = np.sqrt(np.maximum(spread / size - mean * mean, 0))
    halves = np.stack([np.linalg.norm(mean[:, :DIM], axis=1), np.linalg.norm(mean[:, DIM:], axis=1)], axis=1)
    same = np.bincount(r, times.astype(float) ** 2, n)[:, None] / size**2
    return np.hstack([mean, spread, halves, np.sqrt(same), np.log(size)]).astype(np.float32)


class Network:
    """Inputs are standardised, then one hidden layer of tanh and one output; the logit is divided by the temperature."""

    def __init__(self, prior: float):
        self.layers, self.prior = None, prior

    def logits(self, x: np.ndarray) -> np.ndarray:
        centre, scale, w1, b1, w2, b2 = self.layers
        return np.tanh((x - centre) / scale @ w1 + b1) @ w2 + b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.layers is None:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.logits(x.astype(np.float64)) / self.temperature, -40, 40)))


def fitted(x: np.ndarray, y: np.ndarray, held_back: np.ndarray) -> Network:
    """Adam on the cross-entropy in batches, in a fixed order; then the temperature on the rows held back."""
    net = Network(float(y.mean()) if len(y) else 0.5)
    train, rest = x[~held_back].astype(np.float64), x[held_back].astype(np.float64)
    target = y[~held_back].astype(np.float64)
    if len(target) < 2 or target.min() == target.max():
        return net
    rng = np.random.default_rng(5)
    centre, scale = train.mean(axis=0), train.std(axis=0) + 1e-3
    w = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
    scaled = (train - centre) / scale
    step = 0
    size = 64 if len(target) < 4000 else 256
    for epoch in range(EPOCHS):
        order = rng.permutation(len(target))
        rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / EPOCHS))
        for at in range(0, len(order), size):
            some = order[at : at + size]
            hidden = np.tanh(scaled[some] @ w[0] + w[1])
            off = (1 / (1 + np.exp(-(hidden @ w[2] + w[3]))) - target[some]) / len(some)
            back = np.outer(off, w[2]) * (1 - hidden * hidden)
            slopes = [scaled[some].T @ back + DECAY * w[0], back.sum(axis=0), hidden.T @ off + DECAY * w[2], np.array([off.sum()])]
            step += 1
            for p, g, m, v in zip(w, slopes, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.layers, net.temperature = (centre, scale, *w), 1.0
    if len(rest):
        logits, known = net.logits(rest), y[held_back]
        loss = lambda t: np.logaddexp(0, np.where(known == 1, -logits, logits) / t).mean()
        net.temperature = float(min(np.geomspace(0.25, 8, 71), key=loss))
    return net


def train(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, text: str = "text", key: str = "doc_id", label: str = "quality") -> Network:
    """Fits the network on at most TRAINED of the labelled rows given, which hold (key, label)."""
    usable = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).select(F.col(key).alias("__key"), F.col(label).cast("int").alias("__label"))
    sample = usable.orderBy(F.xxhash64("__key"), "__key", "__label").limit(TRAINED)
    chosen = docs.select(docs[key].alias("__key"), docs[text].alias("__text")).join(F.broadcast(sample), "__key")  # TRAINED rows of two numbers
    table = docs.sparkSession.sparkContext.broadcast(directions(vectors))

    @F.arrow_udf("binary")
    def inputs(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([row.tobytes() for texts in blocks(batch) for row in pooled(texts, table.value)], pa.binary())

    rows = chosen.select("__key", "__label", inputs("__text").alias("x")).collect()
    rows.sort(key=lambda r: (r["__key"], r["__label"], r.x))
    x = np.array([np.frombuffer(r.x, np.float32) for r in rows]).reshape(len(rows), INPUTS)
    y = np.array([r["__label"] for r in rows], np.int64)
    return fitted(x, y, np.arange(len(rows)) % 5 == 4)


def score(text: Column, vectors: np.ndarray, network: Network, spark) -> Column:
    """Calibrated probability that a text is of label 1."""
    table = spark.sparkContext.broadcast(directions(vectors))

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [network.scores(pooled(texts, table.value)) for texts in blocks(batch)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return scored(text)


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality", into: str = "score") -> DataFrame:
    """The rows with a column into (replaced if there is one): the score. labels holds the rows that may be learned from."""
    vectors = word_vectors(docs, text)
    network = train(docs, labels, vectors, text, key, label)
    return docs.withColumn(into, score(docs[text], vectors, network, docs.sparkSession))

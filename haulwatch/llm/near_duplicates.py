"""Near-duplicates by an LSH forest: sorted signature orders, neighbours of the longest common prefix, exact confirmation.

Words are runs of anything but blanks (x20, x09-x0D), A-Z lower-cased. A document's set is its distinct WIDTH-word shingles;
fewer words are one shingle; no words, no set and no links. Documents are linked if 100 * intersection >= 75 * union.

1. One scan gives each row the size and digest of its set and a MinHash signature. Rows of one set are one class: exact copies
   are linked without a comparison.
2. The classes' signatures are sorted in TREES orders, each a rotation of the signature, by a distributed range sort; a run of
   equal prefixes, however long, is spread over tasks. A region is a run that shares at least DEPTHS[0] values. A class meets
   its next NEIGHBOURS in the order; in a larger region, the depth goes on by DEPTHS, and at each depth every class also meets
   the REPRESENTATIVES of its run: those whose signatures agree most with the run's commonest values, since many copies may
   have nothing in common but what they were copied from. The first and last rows of each task meet those of the next ones,
   and of a run that tasks share, the commonest values are added up over its pieces and its representatives meet all of it.
   Pairs whose signatures agree in too few places are dropped (a link has a chance of about 1e-6 of being one of these).
3. Pairs are confirmed on the full sets. A large group has far more pairs than it takes to connect it: first every class is
   compared with one partner, the most central one, then all pairs that lead from one component to another are compared.
   A pair inside a component cannot change it. The number of rounds is fixed; no pair across components is left out.
4. In a region of more than NEIGHBOURS + 1 classes not all of them have met, so its classes are compared once more by their
   rare shingles: ordered by how many of these classes have them, a link's sets share one among the first quarter of each, with
   as much left behind it as the link needs. All pairs of different components with such a shingle are compared.
5. Components are found by alternating star contractions of the edge table.

A component has the smallest id of its documents. Null texts and texts without words have size 0 and stand alone. Null ids
are not smaller than any id; a row is kept if its id equals that of its component (both null: kept). Repeated rows are
members of one class, and all rows with the component's id and text are marked kept; `dedupe` leaves one of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from haulwatch.llm.arrays import BLANK, Texts, Words, blocks, give_back, mix, randoms, shingle_hashes, span_hashes, struct_array
from haulwatch.llm.storage import checkpointed

WIDTH = 5
#: A link: PERCENT * union <= 100 * intersection.
PERCENT = 75
VALUES = 32  # of a signature, 16 bits each
TREES = 16
DEPTHS = (2, 4, 8, 16)
NEIGHBOURS = 4
REPRESENTATIVES = 3
#: Agreeing values of a candidate pair; of a link, 24 agree on average, with a standard deviation of 2.4.
AGREEING, CLOSE = 12, 26
SHINGLE_BYTES = 6
#: Rows of the sorted orders that one task reads.
TASK_ROWS = 200_000
#: Bytes of packed sets in a file.
TASK_BYTES = 1 << 25
#: Commonest values of each place that a task tells of its piece of a run.
TOP = 8
#: What a task finds: candidate pairs; rows (a) in regions where not all meet; its first and last rows (key, a); its pieces of runs that may go on in other tasks (key, weight, top).
PAIR, CROWDED, EDGE, PIECE = range(4)
FOUND = pa.schema([
    ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("agreeing", pa.int32()), ("weight", pa.int32()), ("key", pa.binary()),
    ("top", pa.list_(pa.struct([("place", pa.int32()), ("value", pa.int32()), ("times", pa.int64())]))),
])


class Sets:
    """Distinct shingle hashes of each row of a block: row numbers and values, in order."""

    def __init__(self, texts: Texts):
        words = Words(texts, ~BLANK)
        hashes = span_hashes(texts.data, words.start, words.end, fold=True)
        values, first = shingle_hashes(hashes, words.row, WIDTH)
        rows = words.row[first]
        n_words = words.per_row()
        few = np.flatnonzero((n_words > 0) & (n_words < WIDTH))
        if len(few):  # the whole sequence is one shingle
            at = np.searchsorted(words.row, few)
            whole = np.zeros(len(few), np.uint64)
            for k, odd in enumerate(randoms(WIDTH, 23)):
                inside = k < n_words[few]
                whole[inside] += mix(hashes[at[inside] + k] + odd) * odd
            values, rows = np.concatenate((values, mix(whole))), np.concatenate((rows, few))
        order = np.lexsort((values, rows))
        values, rows = values[order], rows[order]
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
        self.values, self.rows = values[new], rows[new]
        self.sizes = np.bincount(self.rows, minlength=len(texts)).astype(np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes

    def digests(self) -> pa.Array:
        """16 bytes for each set, null for the empty one."""
        filled = self.sizes > 0
        halves = np.zeros((len(filled), 2), np.uint64)
        if filled.any():
            for k, r in enumerate(randoms(2, 31)):
                halves[filled, k] = mix(np.add.reduceat(mix(self.values ^ r), self.begins[filled]) + self.sizes[filled].astype(np.uint64))
        return pa.array([h.tobytes() if f else None for h, f in zip(halves, filled, strict=True)], pa.binary())

    def signatures(self) -> pa.Array:
        """VALUES minima of 16 bits, big-endian, null for the empty set."""
        filled = self.sizes > 0
        found = np.zeros((len(filled), VALUES), ">u2")
        if filled.any():
            for k, odd in enumerate(randoms(VALUES, 41)):
                least = np.minimum.reduceat((self.values ^ (self.values >> np.uint64(29))) * odd ^ odd, self.begins[filled])
                found[filled, k] = (mix(least) >> np.uint64(48)).astype(np.uint16)
        return pa.array([h.tobytes() if f else None for h, f in zip(found, filled, strict=True)], pa.binary())

    def packed(self) -> pa.Array:
        """The first SHINGLE_BYTES bytes of each value, in order, one after another."""
        raw = self.values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :SHINGLE_BYTES].tobytes()
        ends = (self.begins + self.sizes) * SHINGLE_BYTES
        return pa.array([raw[a * SHINGLE_BYTES : b] for a, b in zip(self.begins.tolist(), ends.tolist(), strict=True)], pa.large_binary())


@F.arrow_udf(T.StructType([T.StructField("n", T.LongType()), T.StructField("node", T.BinaryType()), T.StructField("signature", T.BinaryType())]))
def marked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    kind = pa.struct([("n", pa.int64()), ("node", pa.binary()), ("signature", pa.binary())])
    for batch in batches:
        for texts in blocks(batch):
            sets = Sets(texts)
            yield struct_array({"n": sets.sizes, "node": sets.digests(), "signature": sets.signatures()}).cast(kind)
    give_back()


@F.arrow_udf(T.BinaryType())
def digested(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        for texts in blocks(batch):
            yield Sets(texts).digests()
    give_back()


@F.arrow_udf(T.BinaryType())
def packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        for texts in blocks(batch):
            yield Sets(texts).packed().cast(pa.binary())
    give_back()


@F.arrow_udf(T.BooleanType())
def linked(pairs: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    def values(raw: bytes) -> np.ndarray:
        wide = np.zeros((len(raw) // SHINGLE_BYTES, 8), np.uint8)
        wide[:, 8 - SHINGLE_BYTES :] = np.frombuffer(raw, np.uint8).reshape(-1, SHINGLE_BYTES)
        return wide.view(">u8").ravel().astype(np.uint64)

    def similar(a: bytes, b: bytes) -> bool:
        if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
            return False
        both = np.sort(np.concatenate((values(a), values(b))), kind="stable")
        common = int((both[1:] == both[:-1]).sum())
        return 100 * common >= PERCENT * (len(both) - common)

    for left, right in pairs:
        yield pa.array([similar(a.as_py(), b.as_py()) for a, b in zip(left, right, strict=True)], pa.bool_())


@F.arrow_udf(T.IntegerType())
def agreement(pairs: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Agreeing values of two keys (or signatures: a key is one with the number of its tree before it)."""

    def values(column: pa.Array) -> np.ndarray:
        raw = b"".join(x[-2 * VALUES :] for x in column.to_pylist())
        return np.frombuffer(raw, np.uint16).reshape(-1, VALUES)

    for left, right in pairs:
        yield pa.array((values(left) == values(right)).sum(axis=1).astype(np.int32), pa.int32())


def shared_values(keys: np.ndarray, trees: np.ndarray) -> np.ndarray:
    """Length of the prefix that each row shares with the next one."""
    same = keys[1:] == keys[:-1]
    shared = np.where(same.all(axis=1), VALUES, same.argmin(axis=1))
    shared[trees[1:] != trees[:-1]] = 0
    return shared


def runs_of(shared: np.ndarray, depth: int) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.concatenate(([True], shared < depth, [True]))).tolist()
    return [*zip(edges[:-1], edges[1:], strict=True)]


def candidates(keys: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pairs (row, partner, agreeing values, size of the run the partner stands for) of rows sorted by tree and signature."""
    n = len(keys)
    if n < 2:
        return (np.zeros(0, np.int64),) * 4
    a, b, weight = [], [], []
    near = shared.copy()
    for w in range(1, NEIGHBOURS + 1):
        if w > 1:
            near = np.minimum(near[:-1], shared[w - 1 :])
        i = np.flatnonzero(near >= DEPTHS[0])
        for x, y in ((i, i + w), (i + w, i)):
            a.append(x), b.append(y), weight.append(np.ones(len(i), np.int64))
    for depth in DEPTHS:
        for lo, hi in runs_of(shared, depth):
            if hi - lo <= NEIGHBOURS + 1:  # all of them have met
                continue
            run = keys[lo:hi]
            central = np.zeros(hi - lo, np.int64)
            for column in range(VALUES):
                _, back, times = np.unique(run[:, column], return_inverse=True, return_counts=True)
                central += back == times.argmax()
            for rep in np.argsort(-central, kind="stable")[:REPRESENTATIVES]:
                others = np.delete(np.arange(lo, hi), rep)
                a.append(others), b.append(np.full(len(others), lo + rep)), weight.append(np.full(len(others), hi - lo))
    a, b, weight = np.concatenate(a), np.concatenate(b), np.concatenate(weight)
    agreeing = (keys[a] == keys[b]).sum(axis=1)
    good = agreeing >= AGREEING
    return a[good], b[good], agreeing[good], weight[good]


def commonest(run: np.ndarray) -> list[dict[str, int]]:
    """The TOP commonest values of each place."""
    found = []
    for place in range(VALUES):
        values, times = np.unique(run[:, place], return_counts=True)
        for k in np.argsort(-times, kind="stable")[:TOP].tolist():
            found.append({"place": place, "value": int(values[k]), "times": int(times[k])})
    return found


def found_rows(kind: int, n: int, **columns: pa.Array) -> pa.RecordBatch:
    full = {"kind": pa.array(np.full(n, kind, np.int32)), **columns}
    return pa.RecordBatch.from_arrays([full[f.name].cast(f.type) if f.name in full else pa.nulls(n, f.type) for f in FOUND], schema=FOUND)


def pairs_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sorted partition of (key, node): its candidate pairs, and what other tasks have to know of it."""
    raw, names = [], []
    for batch in batches:
        raw += batch.column(0).to_pylist()
        names += batch.column(1).to_pylist()
    n = len(raw)
    if not n:
        return
    rows = np.frombuffer(b"".join(raw), np.uint8).reshape(n, 1 + 2 * VALUES)
    keys = np.ascontiguousarray(rows[:, 1:]).view(">u2").astype(np.uint16)
    shared = shared_values(keys, rows[:, 0])
    a, b, agreeing, weight = candidates(keys, shared)
    nodes = pa.array(names, pa.binary())
    yield found_rows(PAIR, len(a), a=nodes.take(pa.array(a)), b=nodes.take(pa.array(b)), agreeing=pa.array(agreeing), weight=pa.array(weight))
    crowded = [np.arange(lo, hi) for lo, hi in runs_of(shared, DEPTHS[0]) if hi - lo > NEIGHBOURS + 1]
    if crowded:
        crowded = nodes.take(pa.array(np.concatenate(crowded)))
        yield found_rows(CROWDED, len(crowded), a=crowded)
    ends = sorted({*range(min(n, NEIGHBOURS)), *range(max(0, n - NEIGHBOURS), n)})
    yield found_rows(EDGE, len(ends), a=nodes.take(pa.array(ends)), key=pa.array([raw[k] for k in ends], pa.binary()))
    pieces = []
    for depth in DEPTHS:
        runs = runs_of(shared, depth)
        pieces += [(raw[lo][: 1 + 2 * depth], hi - lo, commonest(keys[lo:hi])) for lo, hi in sorted({runs[0], runs[-1]})]
    prefixes, sizes, top = zip(*pieces, strict=True)
    del rows, keys, names
    give_back()
    yield found_rows(PIECE, len(pieces), key=pa.array(prefixes, pa.binary()), weight=pa.array(sizes), top=pa.array(top, FOUND.field("top").type))


def prefix(depth: int) -> Column:
    return F.substring("key", 1, 1 + 2 * depth)


def pairs_at_cuts(edges: DataFrame) -> DataFrame:
    """Candidate pairs among the first and last rows (key, a) of the tasks: whatever lies within NEIGHBOURS across a cut, or
    across some short tasks, lies as near in the order of these rows."""
    order = Window.partitionBy(F.substring("key", 1, 1)).orderBy("key", "a")
    following = F.array(*(F.struct(F.lead("key", w).over(order).alias("key"), F.lead("a", w).over(order).alias("b")) for w in range(1, NEIGHBOURS + 1)))
    rows = edges.withColumn("following", following).select("key", "a", F.explode("following").alias("f"))
    rows = rows.where(F.substring("f.key", 1, 1 + 2 * DEPTHS[0]) == prefix(DEPTHS[0]))
    rows = rows.select("a", "f.b", agreement("key", "f.key").alias("agreeing"), F.lit(1).alias("weight")).where(F.col("agreeing") >= AGREEING)
    return rows.union(rows.select(F.col("b"), F.col("a"), "agreeing", "weight"))


def members_of_cut_runs(rows: DataFrame, pieces: DataFrame, n_files: int | None = None) -> DataFrame:
    """(run, size, node, key, central) of the rows (key, node) in runs of several pieces (key, weight, top): the size of the
    whole run, and in how many places the row has the run's commonest value."""
    whole = pieces.groupBy("key").agg(F.sum("weight").cast("int").alias("size"), F.count("*").alias("n")).where(f"n > 1 and size > {NEIGHBOURS + 1}").drop("n")
    times = pieces.join(F.broadcast(whole), "key").select("key", "size", F.explode("top").alias("t"))
    times = times.groupBy("key", "size", "t.place", "t.value").agg(F.sum("t.times").alias("times"))
    modes = times.groupBy("key", "size", "place").agg(F.max(F.struct("times", "value"))["value"].alias("value"))
    modes = modes.groupBy("key", "size").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("modes"))
    packed_modes = F.unhex(F.array_join(F.transform("modes", lambda m: F.lpad(F.hex(m["value"]), 4, "0")), ""))
    runs = F.broadcast(checkpointed(modes.select(F.col("key").alias("run"), "size", packed_modes.alias("modes")), n_files))  # a few per task
    regions = runs.select(F.col("run").alias("region"))  # a run that is cut lies in a region that is cut
    rows = rows.join(F.broadcast(regions), prefix(DEPTHS[0]) == F.col("region"), "left_semi")
    rows = rows.select("node", "key", F.explode(F.array(*map(prefix, DEPTHS))).alias("run")).join(runs, "run")
    return rows.select("run", "size", "node", "key", agreement("key", "modes").alias("central"))


def pairs_of_cut_runs(members: DataFrame, n_files: int | None = None) -> DataFrame:
    """Each member with the representatives of its whole run."""
    order = Window.partitionBy("run").orderBy(F.desc("central"), "node")
    central = members.withColumn("k", F.row_number().over(order)).where(F.col("k") <= REPRESENTATIVES)  # each task sends so many
    central = checkpointed(central.select("run", F.col("node").alias("b"), F.col("key").alias("key_b")), n_files)
    pairs = members.join(F.broadcast(central), "run").where("node != b")
    pairs = pairs.select(F.col("node").alias("a"), "b", agreement("key", "key_b").alias("agreeing"), F.col("size").alias("weight"))
    return pairs.where(F.col("agreeing") >= AGREEING)


def forest_pairs(classes: DataFrame, n_files: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs (a, b, agreeing, weight), in both directions where neither stands for a run; and the nodes that stand in
    regions where not all meet."""
    n_tasks = max(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-classes.count() * TREES // TASK_ROWS))
    twice = F.concat("signature", "signature")
    step = 2 * VALUES // TREES
    orders = F.array(*(F.concat(F.lit(bytes([t])), F.substring(twice, t * step + 1, 2 * VALUES)) for t in range(TREES)))
    rows = classes.select(F.explode(orders).alias("key"), "node")
    ordered = rows.repartitionByRange(n_tasks, "key", "node").sortWithinPartitions("key", "node")
    found = checkpointed(ordered.mapInArrow(pairs_of_task, from_arrow_schema(FOUND)), n_files)
    of = lambda kind: found.where(F.col("kind") == kind)
    members = checkpointed(members_of_cut_runs(rows, of(PIECE).select("key", "weight", "top"), n_files), n_files)
    pairs = of(PAIR).select("a", "b", "agreeing", "weight").union(pairs_at_cuts(of(EDGE).select("key", "a"))).union(pairs_of_cut_runs(members, n_files))
    crowded = of(CROWDED).select(F.col("a").alias("node")).union(members.select("node")).distinct()
    return pairs.groupBy("a", "b").agg(F.max("agreeing").alias("agreeing"), F.max("weight").alias("weight")), crowded


@F.arrow_udf(T.ArrayType(T.LongType()))
def shingles_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The values of packed sets."""
    for batch in batches:
        raw = batch.to_pylist()
        wide = np.zeros((sum(map(len, raw)) // SHINGLE_BYTES, 8), np.uint8)
        wide[:, 8 - SHINGLE_BYTES :] = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, SHINGLE_BYTES)
        values = wide.view(">u8").ravel().astype(np.int64)
        bounds = np.concatenate(([0], np.cumsum([len(x) // SHINGLE_BYTES for x in raw]))).astype(np.int32)
        yield pa.ListArray.from_arrays(pa.array(bounds), pa.array(values))


def crowded_pairs(sets: DataFrame, found: DataFrame, n_files: int | None = None) -> DataFrame:
    """All pairs (a, b) of the sets (node, set) that can be links between two components (node, root).

    A pair of n and m shingles is a link if they share PERCENT / (100 + PERCENT) * (n + m) at least. Shingles are ordered by the
    number of sets that have them; pos is the place of a shingle in its set, from 1. Of the first shingle that two sets share,
    at most 1 + min(n - pos, m - pos') are shared. Of a shingle's sets, those of its commonest component need not meet."""
    rows = sets.join(found, "node", "left").withColumn("root", F.xxhash64(F.coalesce("root", "node")))
    size = F.floor(F.octet_length("set") / SHINGLE_BYTES).cast("int")
    tokens = rows.select("node", "root", size.alias("size"), F.explode(shingles_of("set")).alias("shingle"))
    uses = tokens.groupBy("shingle").agg(F.count("*").alias("uses"), (F.min("root") != F.max("root")).alias("mixed")).where("uses > 1")
    own = Window.partitionBy("node")
    ranked = tokens.join(uses, "shingle").withColumns({"k": F.row_number().over(own.orderBy("uses", "shingle")), "common": F.count("*").over(own)})
    ranked = ranked.withColumn("pos", (F.col("size") - F.col("common") + F.col("k")).cast("int"))  # those of no other set come first
    first = ranked.where(F.col("mixed") & (100 * (F.col("pos") - 1) <= (100 - PERCENT) * F.col("size")))
    first = checkpointed(first.select("shingle", "node", "root", "size", "pos"), n_files)
    main = first.groupBy("shingle", "root").count().groupBy("shingle").agg(F.max(F.struct("count", "root"))["root"].alias("main"))
    left = first.join(main, "shingle").where("root != main").drop("main").withColumnsRenamed({"node": "a", "root": "root_a", "size": "n", "pos": "pos_a"})
    right = first.withColumnsRenamed({"node": "b", "root": "root_b", "size": "m", "pos": "pos_b"})
    most = 1 + F.least(F.col("n") - F.col("pos_a"), F.col("m") - F.col("pos_b"))
    near = (F.col("root_a") != F.col("root_b")) & ((100 + PERCENT) * most >= PERCENT * (F.col("n") + F.col("m")))
    sized = 100 * F.least("n", "m") >= PERCENT * F.greatest("n", "m")
    return left.join(right, "shingle").where(near & sized).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b, ...) that are links."""
    left, right = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a")), sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
    return pairs.join(left, "a").join(right, "b").where(linked("set_a", "set_b")).select(*pairs.columns)


def components(edges: DataFrame, n_files: int | None = None) -> DataFrame:
    """(node, root) of every node of the edges (a, b), the root being the least node that it is connected with."""
    edges = checkpointed(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u != v").distinct(), n_files)
    n_tasks = 1 + edges.count() // TASK_ROWS  # for a table that gets no longer
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        edges = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(n_tasks)
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        edges = checkpointed(moved.union(least.select("u", F.col("m").alias("v"))).distinct().coalesce(n_tasks))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v"), F.col("v")).distinct())
        before = now


def across(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs whose nodes are not in one component, one way round, with their roots."""
    of = lambda name: found.select(F.col("node").alias(name), F.col("root").alias(f"root_{name}"))
    rows = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    rows = rows.join(of("a"), "a", "left").join(of("b"), "b", "left")
    rows = rows.withColumns({"root_a": F.coalesce("root_a", "a"), "root_b": F.coalesce("root_b", "b")})
    return rows.where("root_a != root_b")


def raised(found: DataFrame, between: DataFrame, n_files: int | None = None) -> DataFrame:
    """The components (node, root) after links (a, b) between their roots."""
    above = components(between, n_files).select(F.col("node").alias("root"), F.col("root").alias("top"))
    lone = above.join(found, above["root"] == found["node"], "left_anti").select(F.col("root").alias("node"), "root")
    return found.union(lone).join(above, "root", "left").select("node", F.coalesce("top", "root").alias("root"))


def files_for(rows: DataFrame) -> int:
    """How many files the tables made of these rows (n) are worth: TASK_ROWS of the sorted orders and TASK_BYTES of sets in each."""
    n, shingles = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    return max(2 * rows.sparkSession.sparkContext.defaultParallelism, n * TREES // TASK_ROWS, shingles * SHINGLE_BYTES // TASK_BYTES)


def find_components(docs: DataFrame, text: str, key: str) -> tuple[DataFrame, DataFrame]:
    """Of each row (key, n, node); and of each node that is linked with another (node, root)."""
    rows = checkpointed(docs.select(docs[key].alias("key"), marked(docs[text]).alias("m")).select("key", "m.*"))
    files = files_for(rows)
    classes = checkpointed(rows.where("node is not null").groupBy("node").agg(F.min("signature").alias("signature")), files)
    pairs, crowded = (checkpointed(x, files) for x in forest_pairs(classes, files))
    met = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(crowded).distinct()
    texts = docs.select(docs[text].alias("text")).where("text is not null")
    texts = texts.withColumn("node", digested("text")).where("node is not null")
    texts = texts.join(met, "node", "left_semi").dropDuplicates(["node"])
    sets = checkpointed(texts.select("node", packed("text").alias("set")), files)
    # first one partner each: the most central of the close ones, else the closest
    rank = F.struct((F.col("agreeing") >= CLOSE).alias("close"), F.when(F.col("agreeing") >= CLOSE, F.col("weight")).otherwise(0).alias("weight"), "agreeing", "b")
    first = pairs.groupBy("a").agg(F.max(rank)["b"].alias("b"))
    found = checkpointed(components(confirmed(first, sets), files), files)
    # a link between two components joins their roots
    roots = lambda links: links.select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    whole = raised(found, roots(confirmed(across(pairs, found), sets)), files)
    if not crowded.isEmpty():
        whole = checkpointed(whole, files)
        rest = checkpointed(crowded_pairs(sets.join(crowded, "node", "left_semi"), whole, files), files)
        whole = raised(whole, roots(confirmed(across(rest, whole), sets)), files)
    return rows.select("key", "n", "node"), whole


def mark_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of docs: key, n_shingles, node (the class; null without words), root (the component), component_id, kept."""
    rows, found = find_components(docs, text, key)
    rows = rows.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rows.where("root is not null").groupBy("root").agg(F.min("key").alias("least"))
    rows = rows.join(least, "root", "left").withColumn("component_id", F.when(F.col("root").isNull(), F.col("key")).otherwise(F.col("least")))
    return rows.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "node", "root", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))


def dedupe(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows that stay, with their own columns: one of each component (that of the least key; of rows with one key, any
    one of the least class), and every row without words."""
    rows = checkpointed(mark_duplicates(docs, text, key).select(F.col(key).alias("__key"), F.col("node").alias("__node"), "root", "kept"))
    if rows.groupBy("__key").count().where("count > 1 or __key is null").isEmpty():  # then the key says which row is meant
        kept = rows.where("kept").select("__key")
        return docs.join(kept, docs[key] == kept["__key"], "left_semi")
    least = rows.where("kept and root is not null").groupBy("root").agg(F.min("__node").alias("__node")).select("__node")
    chosen = rows.where("kept").join(least, "__node", "left_semi").select("__key", "__node").distinct()
    named = docs.withColumn("__node", digested(docs[text]))
    on = (named["__node"] == chosen["__node"]) & named[key].eqNullSafe(chosen["__key"])
    with_words = named.where("__node is not null").join(chosen, on, "left_semi").dropDuplicates(["__node"])
    return named.where("__node is null").select(*docs.columns).unionByName(with_words.select(*docs.columns))

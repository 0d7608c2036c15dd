"""Documents with similar sets of word shingles, by the pigeonhole principle over a partition of all shingles.

Words are runs of anything but blanks (x20, x09-x0D), A-Z lower-cased. A document's set is its distinct WIDTH-word shingles; fewer
words are one shingle; no words, no set and no links. Documents link if 100 * intersection >= PERCENT * union.

Sets of l <= s shingles that link differ in at most (100-PERCENT)*(l+s)/(100+PERCENT) of them. Sizes of a power of two and up to the
next one are a band. In a band's scheme all shingles are dealt by hash to segments, some more than the differences its largest set can
have. A set is indexed in the scheme of its band, and in the one below if a partner can be there; the smaller set of a pair probes.

1. A set's segments have keys (a hash of scheme, segment and the shingles in it). As a set looks at one segment for each difference
   that it can have, one more, and a further one for each SLACK of them, links agree on several segments. One shuffle by key counts
   the sets of each; sets that share too few keys go. Only the others are looked at from here on.
2. Each set pays for as many differences, and one, as cheaply as it can: a segment that must be equal pays one and costs the sets that
   have the same key. One that may lack a single shingle on either side pays two and costs, besides, the matches of its one-deletion
   neighbourhood. Neighbourhoods are made where a set's equal segments alone cost more than its neighbourhood has members, and of the
   sets that share a key with such a set.
3. First each set is compared with the sets that stand for its keys, those that share most with others. Whatever is connected then
   need not meet again: of each key paid for, only sets of different components meet, none with its like in the key's commonest
   component. Most pairs are no links; a parity sketch of 512 bits, whose difference is never larger than that of the sets,
   tells so inside the join. Large keys are spread over tasks.
4. All pairs left are confirmed on the words of their texts, and components are found from the links.

Rows of one set are one class and meet once. A component has the smallest id of its documents. Null texts and texts without words have
size 0 and stand alone. Null ids are not smaller than any id. Repeated rows are members of one class. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulwatch.llm.arrays import BLANK, Texts, Words, blocks, joined, lists, mix, randoms, shingle_hashes, span_hashes, struct_array
from haulwatch.llm.near_duplicates import components, files_for, raised
from haulwatch.llm.storage import checkpointed

WIDTH, PERCENT = 4, 85
#: A set has one spare segment for each so many differences.
SLACK = 4
#: Sets that stand for keys, with which a set is compared first.
PARTNERS = 2
#: Sets of a key that one task compares with others.
TASK_SETS = 8192
SKETCH = 8  # 64-bit words
#: Rows at most of the table of bits by which texts that nothing asks for are left out before a shuffle (sent to all tasks).
BIT_WORDS = 1 << 19


def allowed(size):
    """Shingles in which a set and a link of it, that is not smaller, differ at most; of numbers, arrays and (by SQL) columns."""
    return (100 - PERCENT) * (size + 100 * size // PERCENT) // (100 + PERCENT)


def segments(size):
    return 1 + allowed(size) + allowed(size) // SLACK


def allowed_sql(size: str) -> str:
    return f"({100 - PERCENT} * ({size} + 100 * {size} div {PERCENT}) div {100 + PERCENT})"


#: Keys that a set (n) shares at least with any link of it: what the smallest set that can be one needs.
ENOUGH = f"1 + {allowed_sql(f'(({PERCENT} * n + 99) div 100)')} div {SLACK}"


class ShingleSets:
    """Distinct shingle hashes of each row of a block, in order, and where each row's begin."""

    def __init__(self, texts: Texts):
        words = Words(texts, ~BLANK)
        hashes = span_hashes(texts.data, words.start, words.end, fold=True)
        values, first = shingle_hashes(hashes, words.row, WIDTH)
        rows, n_words = words.row[first], words.per_row()
        few = np.flatnonzero((n_words > 0) & (n_words < WIDTH))
        at = np.searchsorted(words.row, few)
        lone = n_words[few].astype(np.uint64)
        for k in range(WIDTH - 1):
            there = k < n_words[few]
            lone[there] = mix(lone[there] * np.uint64(3) + hashes[at[there] + k])
        values, rows = np.concatenate((values, lone)), np.concatenate((rows, few))
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
            for k, odd in enumerate(randoms(2, 61)):
                halves[filled, k] = mix(np.add.reduceat(mix(self.values ^ odd), self.begins[filled]) + self.sizes[filled].astype(np.uint64))
        return pa.array([h.tobytes() if f else None for h, f in zip(halves, filled, strict=True)], pa.binary())

    def sketches(self) -> pa.Array:
        """SKETCH words of bits, each the parity of the number of shingles that hash to it."""
        words = np.zeros(len(self.sizes) * SKETCH, np.uint64)
        hashes = mix(self.values ^ np.uint64(0x5DEECE66D))
        place = (hashes >> np.uint64(32)) % np.uint64(SKETCH)
        np.bitwise_xor.at(words, self.rows * SKETCH + place.astype(np.int64), np.uint64(1) << (hashes & np.uint64(63)))
        return lists(words.view(np.int64), np.full(len(self.sizes), SKETCH))


class Segments:
    """The sets' segments in the schemes of their bands, or (own: false) of the bands below where partners can be there."""

    def __init__(self, sets: ShingleSets, own: bool):
        band = np.frexp(np.maximum(sets.sizes, 1).astype(np.float64))[1].astype(np.int64) - 1 - (not own)
        top = (np.int64(2) << np.maximum(band, 0)) - 1
        there = (sets.sizes > 0) & (band >= 0) & (allowed(np.where(own, sets.sizes, top)) > 0)
        if not own:
            there &= sets.sizes <= 100 * top // PERCENT
        self.all = np.where(there, segments(top), 0)  # segments of the scheme
        self.used = np.where(there, segments(sets.sizes) if own else self.all, 0)
        self.begins = np.cumsum(self.all) - self.all
        inside = there[sets.rows]
        values, self.row = sets.values[inside], sets.rows[inside]
        self.parts = mix(values ^ np.uint64(0x2545F4914F6CDD1D))
        self.segment = ((mix(values + np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)) % np.maximum(self.all, 1).astype(np.uint64)[self.row]).astype(np.int64)
        self.sums = np.zeros(int(self.all.sum()), np.uint64)
        np.add.at(self.sums, self.begins[self.row] + self.segment, self.parts)
        self.band = band

    def keys_of(self, row: np.ndarray, segment: np.ndarray, sums: np.ndarray) -> np.ndarray:
        scheme = self.band[row].astype(np.uint64) << np.uint64(48) | segment.astype(np.uint64)
        return mix(sums + mix(scheme + np.uint64(0xD1B54A32D192ED03))).view(np.int64)

    def keys(self) -> pa.Array:
        """Of each row the keys of the segments it uses."""
        row = np.repeat(np.arange(len(self.used)), self.used)
        segment = np.arange(len(row)) - np.repeat(np.cumsum(self.used) - self.used, self.used)
        return lists(self.keys_of(row, segment, self.sums[self.begins[row] + segment]), self.used)

    def deletions(self) -> tuple[pa.Array, pa.Array]:
        """Of each row, for each shingle in a segment it uses: the segment, and its key without the shingle."""
        used = self.segment < self.used[self.row]
        row, segment = self.row[used], self.segment[used]
        keys = self.keys_of(row, segment, self.sums[self.begins[row] + segment] - self.parts[used])
        sizes = np.bincount(row, minlength=len(self.used))
        return lists(segment, sizes), lists(keys, sizes)


LONGS = T.ArrayType(T.LongType())


def per_block(make, kind: pa.DataType):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield joined([struct_array(make(ShingleSets(texts))) for texts in blocks(batch)], kind)

    return run


def keyed(sets: ShingleSets) -> dict:
    return {"n": sets.sizes, "node": sets.digests(), "own": Segments(sets, True).keys(), "below": Segments(sets, False).keys()}


def sketched(sets: ShingleSets) -> dict:
    return {"sketch": sets.sketches(), "own": Segments(sets, True).keys(), "below": Segments(sets, False).keys()}


def neighbourhood(sets: ShingleSets) -> dict:
    segment, own = Segments(sets, True).deletions()
    return {"segment": segment, "own": own, "below": Segments(sets, False).deletions()[1]}


def block_udf(make, **fields: T.DataType):
    kinds = {T.LongType(): pa.int64(), T.BinaryType(): pa.binary(), LONGS: pa.list_(pa.int64())}
    kind = pa.struct([(name, kinds[of]) for name, of in fields.items()])
    run = per_block(make, kind)

    def annotated(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return run(batches)

    return F.arrow_udf(annotated, T.StructType([T.StructField(name, of) for name, of in fields.items()]))


def shingles(text: str) -> set:
    words = text.encode().lower().split()  # of bytes: A-Z only, and the blanks above only
    return {*zip(*(words[k:] for k in range(WIDTH)), strict=False)} or {tuple(words)}


@F.arrow_udf(T.BooleanType())
def linked(pairs: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for left, right in pairs:
        found, last, mine = [], None, set()
        for a, b in zip(left, right, strict=True):
            a = a.as_py()
            if a != last:
                last, mine = a, shingles(a)
            other = shingles(b.as_py())
            both = len(mine & other)
            found.append(100 * both >= PERCENT * (len(mine) + len(other) - both))
        yield pa.array(found, pa.bool_())


def exploded(rows: DataFrame, *arrays: str) -> DataFrame:
    """(node, n, key) of all values of the arrays."""
    return rows.select("node", "n", F.explode(F.concat(*arrays)).alias("key"))


def met_often(rows: DataFrame) -> DataFrame:
    """(node, n, tid) of the sets that share enough keys with others, from rows (node, n, tid, own, below)."""
    classes = rows.where("size(own) + size(below) > 0").groupBy("node").agg(F.first("own").alias("own"), F.first("below").alias("below"))
    both = F.explode(F.array(F.struct(F.lit(True).alias("own"), F.col("own").alias("keys")), F.struct(F.lit(False).alias("own"), F.col("below").alias("keys"))))
    keys = classes.select(F.xxhash64("node").alias("nid"), both.alias("s")).select("nid", "s.own", F.explode("s.keys").alias("key"))
    of_key = Window.partitionBy("key")  # as many rows as sets that have the key, a segment's share of all rows at most
    shared = keys.withColumns({"least": F.min("nid").over(of_key), "most": F.max("nid").over(of_key), "probed": F.bool_or("own").over(of_key)})
    shared = shared.where("least != most and probed")
    shared = shared.groupBy("nid").agg(F.count_if("own").alias("n_own"), F.count_if(~F.col("own")).alias("n_below"))
    found = rows.where("node is not null").withColumn("nid", F.xxhash64("node")).join(shared, "nid").where(F.greatest("n_own", "n_below") >= F.expr(ENOUGH))
    return found.groupBy("node").agg(F.first("n").alias("n"), F.min("tid").alias("tid"))


def priced(members: DataFrame, uses: DataFrame) -> DataFrame:
    """By the uses of shared keys, the segments (node, n, segment, key, cost) that must be equal, in order of cost (nth); owed: how many a set has to
    take besides those that nobody shares, which cost nothing."""
    own = members.select("node", "n", F.posexplode("own").alias("segment", "key"))
    rows = own.join(uses, "key").select("node", "n", "segment", "key", (F.col("uses") - 1).alias("cost"))
    mine = Window.partitionBy("node")
    rows = rows.withColumns({"nth": F.row_number().over(mine.orderBy("cost", "segment")), "n_shared": F.count("*").over(mine)})
    return rows.withColumn("owed", F.expr(f"n_shared - {allowed_sql('n')} div {SLACK}")).drop("n_shared")


def dear_probes(members: DataFrame, dear: DataFrame, index: DataFrame, uses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For the sets that pay dearly with equal segments alone, probes (key, alike, node) with neighbourhoods: alike 0 asks for whole
    segments, 1 for the indexed ones with a deletion; and that index (key, node)."""
    files = files_for(members)
    mine = members.join(dear.select("node"), "node", "left_semi").select("node", "n", F.posexplode("own").alias("segment", "key"))
    asked = checkpointed(mine.select("key").distinct(), files)
    near = index.join(asked, "key", "left_semi").groupBy("node").count().join(members.select("node", "n", "text"), "node").where(F.col("count") >= F.expr(ENOUGH))
    made = block_udf(neighbourhood, segment=LONGS, own=LONGS, below=LONGS)
    lacking = exploded(near.select("node", "n", made("text").alias("m")).select("node", "n", "m.*"), "own", "below")
    lacking = checkpointed(lacking.join(asked, "key", "left_semi").select("key", "node").distinct(), files)
    of_mine = members.join(dear.select("node"), "node", "left_semi").select("node", made("text").alias("m")).select("node", "m.*")
    of_mine = of_mine.select("node", F.explode(F.arrays_zip("segment", "own")).alias("d")).select("node", F.col("d.segment").alias("segment"), F.col("d.own").alias("key"))
    of_mine = checkpointed(of_mine.join(uses, "key"), files)  # what nobody has costs nothing
    first = mine.join(uses, "key").withColumn("cost", F.col("uses") - 1).drop("uses")
    second = first.join(lacking.groupBy("key").agg(F.count("*").alias("others")), "key", "left")
    second = second.join(of_mine.groupBy("node", "segment").agg(F.sum("uses").alias("mine")), ["node", "segment"], "left")
    second = second.withColumn("more", F.coalesce("others", F.lit(0)) + F.coalesce("mine", F.lit(0)))
    steps = F.array(F.struct(F.lit(1).alias("step"), F.col("cost").alias("price")), F.struct(F.lit(2).alias("step"), F.greatest("cost", "more").alias("price")))
    order = Window.partitionBy("node").orderBy("s.price", "segment", "s.step")
    taken = second.select("node", "n", "segment", "key", "cost", F.explode(steps).alias("s")).withColumn("nth", F.row_number().over(order))
    taken = checkpointed(taken.where(F.expr(f"nth <= 1 + {allowed_sql('n')}")).select("node", "segment", "key", "cost", "s.step"), files)
    probes = taken.where("step = 2 or cost > 0").select("key", (F.col("step") - 1).alias("alike"), "node")
    deleted = of_mine.join(taken.where("step = 2").select("node", "segment"), ["node", "segment"], "left_semi")
    return probes.union(deleted.select("key", F.lit(0), "node").distinct()), lacking


def confirmed(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs (a, b, ...) that are links."""
    of = lambda name: members.select(F.col("node").alias(name), F.col("text").alias(f"text_{name}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").where(linked("text_a", "text_b")).select(*pairs.columns)


def can_link(of_a: Column, of_b: Column) -> Column:
    """Whether two sets (n, sketch), a not larger than b, can be a link."""
    apart = sum((F.bit_count(of_a["sketch"][k].bitwiseXOR(of_b["sketch"][k])) for k in range(SKETCH)), F.lit(0))
    sized = 100 * of_a["n"] >= PERCENT * of_b["n"]
    return sized & ((100 + PERCENT) * apart <= (100 - PERCENT) * (of_a["n"] + of_b["n"]))


def first_links(members: DataFrame, probes: DataFrame, index: DataFrame, weight: DataFrame) -> DataFrame:
    """Links (a, b) of each probing set with those of most weight among the sets of its keys."""
    central = index.join(weight, "node").groupBy("key").agg(F.max(F.struct("weight", "node"))["node"].alias("b"))
    pairs = probes.where("alike = 0").join(central, "key").where("node != b").groupBy(F.col("node").alias("a"), "b").count()
    best = Window.partitionBy("a").orderBy(F.desc("count"), "b")
    pairs = pairs.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= PARTNERS).select("a", "b")
    return confirmed(pairs, members)


def pairs_across(members: DataFrame, probes: DataFrame, index: DataFrame, found: DataFrame, files: int) -> DataFrame:
    """Pairs (a, b) of sets of different components that can be links: probes (key, alike, node) with the index (key, alike, node)."""
    rooted = lambda rows: rows.join(found, "node", "left").withColumn("root", F.xxhash64(F.coalesce("root", "node")))
    probes, index = rooted(probes), rooted(index)
    roots = index.groupBy("key", "alike", "root").count()
    main = roots.groupBy("key", "alike").agg(F.max(F.struct("count", "root"))["root"].alias("main"), F.sum("count").alias("n_sets"), F.min("root").alias("least"), F.max("root").alias("most"))
    asked = probes.groupBy("key", "alike").agg(F.min("root").alias("p_least"), F.max("root").alias("p_most"))
    mixed = main.join(asked, ["key", "alike"]).where("least != most or p_least != p_most or least != p_least")
    mixed = checkpointed(mixed.select("key", "alike", "main", F.ceil(F.col("n_sets") / TASK_SETS).cast("int").alias("salts")), files)
    told = members.select("node", F.struct("n", "sketch").alias("of"))
    left = probes.join(mixed, ["key", "alike"]).join(told, "node").withColumn("salt", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int"))
    right = index.join(mixed, ["key", "alike"]).join(told, "node").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    # side 0 of the index are the sets that are not of the key's main component, side 1 those that are: these meet no set of it
    main = F.col("root") == F.col("main")
    left = left.withColumn("side", F.explode(F.when(main, F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))))
    right = right.withColumn("side", main.cast("int"))
    of = lambda rows, name: rows.select("key", "alike", "salt", "side", *(F.col(c).alias(f"{c}_{name}") for c in ("node", "root", "of")))
    a, b = F.col("of_a"), F.col("of_b")
    ordered = (a["n"] < b["n"]) | ((a["n"] == b["n"]) & (F.col("node_a") < F.col("node_b")))
    met = of(left, "a").join(of(right, "b"), ["key", "alike", "salt", "side"]).where((F.col("root_a") != F.col("root_b")) & ordered & can_link(a, b))
    return met.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def asked_for(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose tid is in wanted, and others with the same bit; where there are very many tids, that may be most of them."""
    bit = lambda: F.pmod(F.xxhash64("tid"), F.lit(64 * BIT_WORDS))
    bits = wanted.select((bit() % 64).cast("int").alias("place"), F.floor(bit() / 64).alias("word"))
    bits = bits.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, place)")).alias("bits"))
    rows = rows.withColumns({"place": (bit() % 64).cast("int"), "word": F.floor(bit() / 64)}).join(F.broadcast(bits), "word")
    return rows.where(F.expr("shiftright(bits, place) & 1 = 1")).drop("word", "bits", "place")


def joined_sets(rows: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """(node, root) of each set that links with another, from rows (node, n, tid, own, below)."""
    alive = checkpointed(met_often(rows), files_for(rows))
    files = files_for(alive)  # small tables would else be a file, and a task of each later step, for every shuffle partition
    texts = docs.select(docs[text].alias("text"), F.unhex(F.md5(docs[text])).alias("tid"))
    texts = asked_for(texts, alive).join(alive, "tid").groupBy("node", "n").agg(F.first("text").alias("text"))
    detail = block_udf(sketched, sketch=LONGS, own=LONGS, below=LONGS)
    number = F.monotonically_increasing_id()  # shorter than a digest
    members = checkpointed(texts.select(number.alias("node"), F.col("node").alias("class"), "n", "text", detail("text").alias("m")).select("node", "class", "n", "text", "m.*"), files)
    index = checkpointed(exploded(members, "own", "below").select("key", "node"), files)
    uses = checkpointed(index.groupBy("key").agg(F.count("*").alias("uses")), files)
    costs = checkpointed(priced(members, uses.where("uses > 1")), files)
    plain = costs.where("nth <= owed")
    dear = checkpointed(plain.groupBy("node", "n").agg(F.sum("cost").alias("total")).where("total > n"), files)
    probes = plain.join(dear, "node", "left_anti").select("key", F.lit(0).alias("alike"), "node")
    index = index.withColumn("alike", F.lit(0))
    if not dear.isEmpty():
        more, lacking = dear_probes(members, dear, index, uses)
        probes, index = probes.union(more), index.union(lacking.select("key", "node", F.lit(1)))
    probes = checkpointed(probes, files)
    index = checkpointed(index.join(probes.select("key", "alike").distinct(), ["key", "alike"], "left_semi").select("key", "alike", "node"), files)
    weight = costs.groupBy("node").agg(F.sum("cost").alias("weight"))
    found = checkpointed(components(first_links(members, probes, index.where("alike = 0").select("key", "node"), weight), files), files)
    rest = checkpointed(pairs_across(members, probes, index, found, files), files)
    rooted = lambda side: found.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
    links = confirmed(rest, members).join(rooted("a"), "a", "left").join(rooted("b"), "b", "left")
    found = raised(found, links.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")), files)
    named = lambda side: members.select(F.col("node").alias(side), F.col("class").alias(f"{side}_class"))
    found = found.join(named("node"), "node").join(named("root"), "root")
    return found.select(F.col("node_class").alias("node"), F.col("root_class").alias("root"))


def join_similar(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of docs: key, n_shingles, node (the class; null without words), root (the component's class) and component_id."""
    made = block_udf(keyed, n=T.LongType(), node=T.BinaryType(), own=LONGS, below=LONGS)
    rows = docs.select(docs[key].alias("key"), F.unhex(F.md5(docs[text])).alias("tid"), made(docs[text]).alias("m"))
    rows = checkpointed(rows.select("key", "tid", "m.*"))
    found = joined_sets(rows, docs, text)
    classes = rows.where("node is not null").groupBy("node").agg(F.min("key").alias("least")).join(found, "node", "left")
    classes = classes.withColumn("root", F.coalesce("root", "node"))
    roots = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = classes.join(roots, "root").select("node", "root", "component_id")
    rows = rows.select("key", "n", "node").join(classes, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return rows.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "node", "root", component.alias("component_id"))

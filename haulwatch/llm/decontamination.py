"""Benchmark decontamination with suffix arrays of the training text.

The documents are cut into shards (blocks of rows inside a task); the words of a shard that the benchmark also uses make its
text, and a suffix array over it is built by prefix doubling. Every suffix of every benchmark item is binary-searched in it,
all suffixes side by side and a word deeper each time, which gives the longest verbatim match and all its places, and on the
way the places of each window. Only runs of shared words that are long enough for the shortest window enter the array, so it
is small where the training text is clean.

Words are runs of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]` after lower-casing A-Z. A window is WINDOW consecutive words of an item,
or the whole item if it has fewer words (an item without words has none). A document word inside any occurrence of a window
is hit. A document is contaminated if at least one in HIT_SHARE of its words is hit.

The benchmark is the query set. It is measured first and goes to the tasks in blocks of about BLOCK_CHARS characters, by
item; each block is one more pass over the words of a document, and the hits of all blocks are put together. An item with a
null text has no windows; a null id counts as an empty one. Items of one id count once. Null or empty documents have no
words and are not contaminated; repeated documents get the same verdict each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwatch.llm.arrays import BLANK, Texts, Words, blocks, folded, give_back, lists, span_hashes, struct_array
from haulwatch.llm.storage import under_plain_names

WINDOW = 13
HIT_SHARE = 20
BLOCK_CHARS = 1 << 24
IS_WORD = np.zeros(256, bool)
IS_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x41, 0x5B), *range(0x80, 0x100)]] = True

FOUND = "n_words bigint, hits array<struct<start:bigint,end:bigint>>, items array<string>, matches array<struct<item_id:string,item_word:bigint,doc_word:bigint,n_words:bigint>>"


def suffix_array(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The starts in the order of their suffixes. Word 0 ends a suffix; texts end with it."""
    n = len(text)
    rank = text.astype(np.int64)
    step = 1
    while step < n:
        key = rank * (int(rank.max()) + 1)
        key[: n - step] += rank[step:]
        key[text == 0] = 0  # a word that ends the suffix hides what follows
        distinct, following = np.unique(key, return_inverse=True)
        if len(distinct) == len(np.unique(rank)):
            break
        rank, step = following, step * 2
    return starts[np.argsort(rank[starts], kind="stable")]


class Benchmark:
    """Words of the items of a block: numbers from 1, items one after another, and where each suffix's item ends."""

    def __init__(self, ids: list[str], texts: list[str]):
        block = next(blocks(pa.array(texts, pa.string()), 1 << 62), Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64)))
        words = Words(block, IS_WORD)
        self.vocabulary, numbers = np.unique(span_hashes(block.data, words.start, words.end, fold=True), return_inverse=True)
        self.words = numbers + 1
        self.item = words.row
        size = words.per_row()
        past = np.cumsum(size)
        self.end = past[self.item]  # of the item that a suffix belongs to
        self.begin = (past - size)[self.item]
        self.ids = np.array(ids, object)
        window = np.minimum(size, WINDOW)[self.item]
        self.window = np.where(np.arange(len(numbers)) + window <= self.end, window, 0)  # 0: too near the item's end
        self.shortest = int(window.min()) if len(window) else WINDOW


class Shard:
    """Suffix array over the words that a block of documents shares with a benchmark."""

    def __init__(self, bench: Benchmark, texts: Texts):
        words = Words(texts, IS_WORD)
        self.n_words, self.row = words.per_row(), words.row
        hashes = span_hashes(texts.data, words.start, words.end, fold=True)
        at = np.searchsorted(bench.vocabulary, hashes)
        at[at == len(bench.vocabulary)] = 0
        known = bench.vocabulary[at] == hashes if len(bench.vocabulary) else np.zeros(len(hashes), bool)
        numbers = np.where(known, at + 1, 0)
        # runs of shared words within a document
        breaks = np.ones(len(words) + 1, bool)
        breaks[1:-1] = ~(known[1:] & known[:-1] & (words.row[1:] == words.row[:-1]))
        edges = np.flatnonzero(breaks)
        size, first = np.diff(edges), edges[:-1]
        good = (size >= bench.shortest) & known[first] if len(first) else np.zeros(0, bool)
        size, first = size[good], first[good]
        self.place = np.zeros(0, np.int64)  # in the documents, of each word of the text
        self.text, self.order = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(size):
            began = np.cumsum(size + 1) - size - 1
            inside = np.arange(int(size.sum() + len(size))) - np.repeat(began, size + 1)
            self.place = np.minimum(np.repeat(first, size + 1) + inside, len(words) - 1)
            self.text = np.where(inside == np.repeat(size, size + 1), 0, numbers[self.place])
            left = np.repeat(size, size + 1) - inside
            self.order = suffix_array(self.text, np.flatnonzero(left >= bench.shortest))


def bound(text: np.ndarray, order: np.ndarray, depth: int, lo: np.ndarray, hi: np.ndarray, word: np.ndarray, right: bool) -> np.ndarray:
    """Binary search for a word at a depth, within the part of the order that shares the words before it."""
    lo, hi = lo.copy(), hi.copy()
    last = len(text) - 1
    while (open_ := lo < hi).any():
        middle = (lo + hi) >> 1
        there = text[np.minimum(order[np.minimum(middle, len(order) - 1)] + depth, last)]
        up = open_ & ((there <= word) if right else (there < word))
        lo = np.where(up, middle + 1, lo)
        hi = np.where(open_ & ~up, middle, hi)
    return lo


def search(bench: Benchmark, shard: Shard) -> tuple[np.ndarray, ...]:
    """Every benchmark suffix in the shard: places of windows (suffix, shard word), and places of the longest matches
    (suffix, shard word, words)."""
    n = len(bench.words)
    suffix = np.arange(n)
    lo, hi = np.zeros(n, np.int64), np.full(n, len(shard.order), np.int64)
    windows, longest = [], []

    def places(suffix: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = hi - lo
        inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        return np.repeat(suffix, size), shard.order[np.repeat(lo, size) + inside]

    depth = 0
    while len(suffix) and len(shard.order):
        more = suffix + depth < bench.end[suffix]
        word = bench.words[np.minimum(suffix + depth, n - 1)]
        low = bound(shard.text, shard.order, depth, lo, hi, word, False)
        high = bound(shard.text, shard.order, depth, low, hi, word, True)
        goes_on = more & (low < high)
        if depth:
            done = ~goes_on & (depth >= bench.window[suffix]) & (bench.window[suffix] > 0)
            who, at = places(suffix[done], lo[done], hi[done])
            longest.append((who, at, np.full(len(who), depth)))
        suffix, lo, hi = suffix[goes_on], low[goes_on], high[goes_on]
        depth += 1
        full = bench.window[suffix] == depth
        windows.append(places(suffix[full], lo[full], hi[full]))
    put = lambda parts, k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64)
    return put(windows, 0), put(windows, 1), put(longest, 0), put(longest, 1), put(longest, 2)


def findings(bench: Benchmark, texts: Texts) -> pa.Array:
    """FOUND for each row of a block."""
    shard, n = Shard(bench, texts), len(texts)
    suffix, at, long_suffix, long_at, long_size = search(bench, shard)
    first = shard.place[at]
    row = shard.row[first]
    begin_of_row = np.cumsum(shard.n_words) - shard.n_words
    # hit words, as spans
    step = np.zeros(len(shard.row) + 1, np.int64)
    np.add.at(step, first, 1)
    np.add.at(step, first + bench.window[suffix], -1)
    hit = np.cumsum(step)[:-1] > 0
    before, after = np.zeros(len(hit), bool), np.zeros(len(hit), bool)
    if len(hit):
        same = shard.row[1:] == shard.row[:-1]
        before[1:] = hit[:-1] & same
        after[:-1] = hit[1:] & same
    spans = np.flatnonzero(hit & ~before), np.flatnonzero(hit & ~after) + 1
    span_row = shard.row[spans[0]]
    hits = struct_array({"start": spans[0] - begin_of_row[span_row], "end": spans[1] - begin_of_row[span_row]})
    # items, as the sorted distinct ids of a row
    pairs = pd.DataFrame({"row": row, "id": bench.ids[bench.item[suffix]].astype(object)}).drop_duplicates().sort_values(["row", "id"])
    # longest matches: those that don't only continue a match of the suffix before
    far = shard.place[long_at] if len(long_at) else long_at
    key = pd.DataFrame({"row": shard.row[far], "item": bench.item[long_suffix], "shift": far - long_suffix, "end": far + long_size, "far": far, "suffix": long_suffix, "size": long_size})
    key = key.sort_values(["row", "item", "shift", "far"], kind="stable").drop_duplicates(["row", "item", "shift", "end"])
    matches = struct_array({
        "item_id": pa.array(bench.ids[key["item"]], pa.string()),
        "item_word": (key["suffix"] - bench.begin[key["suffix"]]).to_numpy(np.int64),
        "doc_word": (key["far"] - begin_of_row[key["row"]]).to_numpy(np.int64),
        "n_words": key["size"].to_numpy(np.int64),
    })
    return struct_array({
        "n_words": shard.n_words,
        "hits": lists(hits, np.bincount(span_row, minlength=n)),
        "items": lists(pa.array(pairs["id"], pa.string()), np.bincount(pairs["row"].to_numpy(np.int64), minlength=n)),
        "matches": lists(matches, np.bincount(key["row"].to_numpy(np.int64), minlength=n)),
    })


def finder(ids: list[str], texts: list[str], text: Column) -> Column:
    @F.arrow_udf(FOUND)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bench = Benchmark(ids, texts)
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        match = pa.struct([("item_id", pa.string()), ("item_word", pa.int64()), ("doc_word", pa.int64()), ("n_words", pa.int64())])
        kind = pa.struct([("n_words", pa.int64()), ("hits", pa.list_(span)), ("items", pa.list_(pa.string())), ("matches", pa.list_(match))])
        for batch in batches:
            for block in blocks(batch):
                yield findings(bench, block).cast(kind)
        del bench
        give_back()

    return find(text)


def n_inside(spans: Column) -> Column:
    """Words covered by spans that may overlap."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    step = lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], a["end"]))).alias("n"), F.greatest(a["end"], s["end"]).alias("end"))
    return F.aggregate(F.array_sort(spans), start, step, lambda a: a["n"])


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", into: str = "found", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows with a struct column into (replaced if there is one): n_words, hits (spans of words), items (sorted distinct
    ids), matches (longest verbatim matches and their places), n_hit, n_items, contaminated."""
    items = benchmark.select(F.coalesce(benchmark[item_id].cast("string"), F.lit("")).alias("id"), benchmark[item_text].alias("text")).where("text is not null")
    n_chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = 1 + n_chars // block_chars
    parts = []
    for k in range(n_blocks):
        block = items if n_blocks == 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)) == k)
        rows = block.collect()  # of a bounded size
        parts.append(partial(finder, [r.id for r in rows], [r.text for r in rows]))
    found = lambda rows, text: found_in(rows, [find(rows[text]) for find in parts])
    return under_plain_names(docs, [text], found, into)


def found_in(docs: DataFrame, parts: list[Column]) -> DataFrame:
    """The rows with the column found, from the findings of each block."""
    n_blocks, into = len(parts), "found"
    names = [f"__found_{k}" for k in range(n_blocks)]
    rows = docs.withColumns(dict(zip(names, parts, strict=True)))
    of = lambda field: [F.col(name)[field] for name in names]
    hits = F.concat(*of("hits")) if n_blocks > 1 else of("hits")[0]
    found = F.struct(
        of("n_words")[0].alias("n_words"),
        hits.alias("hits"),
        (F.array_sort(F.array_distinct(F.concat(*of("items")))) if n_blocks > 1 else of("items")[0]).alias("items"),
        (F.concat(*of("matches")) if n_blocks > 1 else of("matches")[0]).alias("matches"),
        n_inside(hits).alias("n_hit"),
    )
    rows = rows.withColumn(into, found).drop(*names)
    f = F.col(into)
    rows = rows.withColumn(into, f.withField("n_items", F.size(f["items"]).cast("long")))
    return rows.withColumn(into, f.withField("contaminated", (f["n_hit"] > 0) & (HIT_SHARE * f["n_hit"] >= f["n_words"])))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """The rows that are not contaminated, with their own columns."""
    into = "found"
    while into in docs.columns:
        into += "_"
    return find_contamination(docs, benchmark, into=into, **names).where(~F.col(into)["contaminated"]).select(*docs.columns)

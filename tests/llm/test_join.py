from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from tests.llm.corpus import DOCS, ODD, clashing, empty, odd, prose  # noqa: F401

from haulwatch.llm import shingle_join
from haulwatch.llm.arrays import blocks
from haulwatch.llm.queries import ORACLES, QUERIES


def sets_of(texts):
    return [shingle_join.shingles(t) if t and t.split() else set() for t in texts]


def plain_components(texts):
    """The smallest row that each row is connected with, by comparing all pairs."""
    sets, of = sets_of(texts), list(range(len(texts)))

    def root(k):
        while of[k] != k:
            k = of[k]
        return k

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                of[y] = x
    return [root(k) for k in range(len(texts))]


def corpus(seed, groups, size, passage=0, edits=(0, 1, 2, 3, 5, 8)):
    """Groups of copies with independent edits, whose texts begin with a passage that all share."""
    rng, shared = random.Random(seed), prose(seed, passage).split()
    texts = []
    for g in range(groups):
        source = prose(1000 * seed + g, rng.randint(*size)).split()
        for _ in range(rng.choice([1, 2, 4])):
            words = source[:]
            for _ in range(rng.choice(edits)):
                at = rng.randrange(len(words))
                words[at : at + rng.choice([0, 1, 1])] = [rng.choice(["new", "", "Other", "more words"])]
            texts.append(" ".join(shared + [w for w in words if w]))
    rng.shuffle(texts)
    return texts


def cluster(seed, n, words, share):
    """Copies of one text, each with its own part of the words changed."""
    rng, source = random.Random(seed), [f"w{k}" for k in range(words)]
    texts = []
    for k in range(n):
        edited = source[:]
        for _ in range(rng.randrange(int(words * share))):
            edited[rng.randrange(words)] = f"e{k}_{rng.randrange(99)}"
        texts.append(" ".join(edited))
    return texts


CORPORA = {
    "short": corpus(1, 120, (1, 14), edits=(0, 0, 1)),
    "medium": corpus(2, 60, (40, 160)),
    "long": corpus(3, 12, (900, 1100), edits=(0, 10, 20, 30, 40)),
    "passage": corpus(4, 60, (30, 60), passage=60),
    "cluster": cluster(5, 160, 120, 0.08),
    "borders": [" ".join(f"w{k}" for k in range(n)) for n in range(1, 140)] + [" ".join(f"w{k}" for k in range(3, n)) for n in range(20, 90, 7)],
}


@pytest.mark.parametrize("name", CORPORA)
def test_components_equal_all_pairs(spark, name):
    texts = CORPORA[name]
    got = shingle_join.join_similar(spark.createDataFrame([(k, t, "en", "s", 1) for k, t in enumerate(texts)], DOCS)).collect()
    assert sorted((r.doc_id, r.component_id, r.n_shingles) for r in got) == [(k, c, len(s)) for k, (c, s) in enumerate(zip(plain_components(texts), sets_of(texts), strict=True))]


@pytest.mark.parametrize("name", ["medium", "cluster", "passage"])
def test_neighbourhoods_lose_nothing(spark, name, monkeypatch):
    """All sets pay with neighbourhoods where those are cheaper, no spare segments, tiny tasks."""
    made = []
    plain = shingle_join.dear_probes

    def watched(members, dear, index, uses):
        made.append(1)
        return plain(members, members.select("node", "n"), index, uses)

    monkeypatch.setattr(shingle_join, "dear_probes", watched)
    monkeypatch.setattr(shingle_join, "TASK_SETS", 3)
    texts = CORPORA[name] + cluster(6, 60, 40, 0.1)
    got = shingle_join.join_similar(spark.createDataFrame([(k, t, "en", "s", 1) for k, t in enumerate(texts)], DOCS)).collect()
    assert made and [r.component_id for r in sorted(got)] == plain_components(texts)


def test_links_agree_on_segments():
    """Sets that may link have as many keys in common as the filter asks for, whatever their bands."""
    rng = np.random.default_rng(1)
    for n in (6, 7, 15, 16, 31, 33, 64, 100, 127, 128, 300):
        words = [f"w{k}" for k in range(n + 3)]
        for cut in range(0, 1 + int(0.15 * n)):
            other = words[: len(words) - cut]
            small, large = sorted((n, n - cut))
            if 100 * small < 85 * large:
                continue
            if rng.random() < 0.3 and cut == 0:
                other = [*other[:-1], "x"]
            sets = shingle_join.ShingleSets(next(blocks(pa.array([" ".join(words), " ".join(other)]))))
            both = len(np.intersect1d(*(sets.values[sets.rows == k] for k in (0, 1))))
            if 100 * both < 85 * (int(sets.sizes.sum()) - both):
                continue
            own, below = (shingle_join.Segments(sets, side).keys().to_pylist() for side in (True, False))
            probe, index = (0, 1) if sets.sizes[0] < sets.sizes[1] else (1, 0)
            common = set(own[probe]) & {*own[index], *below[index]}
            assert len(common) >= 1 + shingle_join.allowed(small) // shingle_join.SLACK or shingle_join.allowed(small) == 0


def test_sketches_bound_differences():
    texts = [prose(k, 200) for k in range(6)] + [prose(0, 190)]
    sets = shingle_join.ShingleSets(next(blocks(pa.array(texts))))
    words = [[v & (1 << 64) - 1 for v in s] for s in sets.sketches().to_pylist()]
    full = [set(sets.values[sets.rows == k].tolist()) for k in range(7)]
    for a in range(7):
        for b in range(7):
            assert sum((x ^ y).bit_count() for x, y in zip(words[a], words[b], strict=True)) <= len(full[a] ^ full[b])


def test_odd_rows(spark, odd, empty):
    got = shingle_join.join_similar(clashing(odd, "key", "node", "n", "tid", "own", "below", "m", "root", "least", "component_id", "sketch", "alike")).collect()
    assert len(got) == len(ODD) and {r.doc_id for r in got if r.n_shingles == 0} == {1, 2, 3}
    assert all(r.component_id == r.doc_id for r in got)
    assert shingle_join.join_similar(empty).count() == 0
    same = spark.createDataFrame([(k % 3, prose(4, 90), "en", "s", 1) for k in range(6)] + [(None, prose(4, 90).upper(), "en", "s", 1)], DOCS)
    assert {(r.doc_id, r.component_id) for r in shingle_join.join_similar(same).collect()} == {(0, 0), (1, 0), (2, 0), (None, 0)}


def test_join_equals_sql(spark):
    from fixtures.compare import compare, duck

    path = "/root/testdata/sf0.001"
    got, want, diff = compare(spark, duck(path), path, QUERIES["op11_ngram_join"], ORACLES["op11_ngram_join"])
    assert got == want > 0 and not diff


def test_small_tables_are_few_files(spark, monkeypatch):
    """Beside many shuffle partitions that nobody joins together, what is made from few sets is written in few files."""
    files, plain = [], shingle_join.checkpointed

    def watched(rows, *args):
        made = plain(rows, *args)
        files.append(made.rdd.getNumPartitions())
        return made

    monkeypatch.setattr(shingle_join, "checkpointed", watched)
    held = {"spark.sql.shuffle.partitions": "31", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in held}
    texts = CORPORA["cluster"]
    try:
        for name, value in held.items():
            spark.conf.set(name, value)
        got = shingle_join.join_similar(spark.createDataFrame([(k, t, "en", "s", 1) for k, t in enumerate(texts)], DOCS)).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(files) > 8 and max(files) <= 2 * spark.sparkContext.defaultParallelism
    assert [r.component_id for r in sorted(got)] == plain_components(texts)

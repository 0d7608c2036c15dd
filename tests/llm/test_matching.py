"""Decontamination, near-duplicates and license scans against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa

from haulwatch.llm import decontamination, licenses, near_duplicates
from haulwatch.llm.arrays import blocks
from tests.llm.corpus import DOCS, ODD, clashing, empty, odd, prose  # noqa: F401

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def windows_by_hand(docs, items):
    def words(text):
        return BENCH_WORD.findall((text or "").translate(FOLD))

    windows = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(item or "")
    found = []
    for text in docs:
        w, ids = words(text), set()
        hit = [False] * len(w)
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (s := windows.get(tuple(w[k : k + n]))) is not None:
                    ids |= s
                    hit[k : k + n] = [True] * n
        found.append((len(w), sum(hit), sorted(ids)))
    return found


def small_world(seed: int):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "Cé", "D1", "the"][: rng.randrange(1, 6)] + ["zz"] * (seed % 2)
    make = lambda n: rng.choice([" ", ". "]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(str(i), make(rng.choice([0, 1, 3, 12, 13, 14, 30]))) for i in range(6)] + [("2", make(20)), (None, make(13)), ("9", None)]
    docs = [make(rng.randrange(0, 60)) for _ in range(25)] + ["", None, items[0][1], f"q q {items[1][1]} q"]
    return docs, items


def test_windows_against_brute_force():
    for seed in range(40):
        docs, items = small_world(seed)
        usable = [(i or "", t) for i, t in items if t is not None]
        bench = decontamination.Benchmark([i for i, _ in usable], [t for _, t in usable])
        for limit in (40, 1 << 21):
            got = [r for b in blocks(pa.array(docs, pa.string()), limit) for r in decontamination.findings(bench, b).to_pylist()]
            assert [(r["n_words"], sum(h["end"] - h["start"] for h in r["hits"]), r["items"]) for r in got] == windows_by_hand(docs, items)


def test_benchmark_in_blocks(spark, odd, empty):
    docs, items = small_world(8)
    rows = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in enumerate(docs)], DOCS)
    bench = spark.createDataFrame(items, "item_id string, text string")
    want = windows_by_hand(docs, items)
    for block_chars in (60, 1 << 24):
        got = decontamination.find_contamination(clashing(rows, "found", "n_hit", "__found_0", "__found_1", "__found", "c0"), bench, block_chars=block_chars).collect()
        assert {r.doc_id: (r.found.n_words, r.found.n_hit, r.found["items"]) for r in got} == dict(enumerate(want))
        assert all(r.found.contaminated == (n > 0 and 20 * n >= m) for r in got for m, n, _ in [want[r.doc_id]])
    nothing = spark.createDataFrame([], "item_id string, text string")
    assert decontamination.remove_contaminated(odd, nothing).count() == len(ODD)
    assert decontamination.remove_contaminated(empty, bench).count() == 0


def test_longest_matches_and_places(spark):
    passage = prose(11, 40)
    docs = spark.createDataFrame([(1, f"zq zr {passage} zs", "en", "s", 1), (2, prose(12, 200), "en", "s", 1)], DOCS)
    bench = spark.createDataFrame([("i", f"xa xb {passage} xc")], "item_id string, text string")
    got = {r.doc_id: r.found for r in decontamination.find_contamination(docs, bench).collect()}
    assert [m.asDict() for m in got[1].matches] == [{"item_id": "i", "item_word": 2, "doc_word": 2, "n_words": 40}]
    assert got[1].contaminated and not got[2].contaminated and not got[2].matches
    assert [r.doc_id for r in decontamination.remove_contaminated(docs, bench).collect()] == [2]


def components_by_hand(rows):
    def shingles(text):
        w = WORD.findall((text or "").translate(FOLD))
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[find(i)] = min(key, least.get(find(i), key))
    return {(key, len(sets[i])): least[find(i)] for i, (key, _) in enumerate(rows)}


def copies(seed: int):
    """Copies of some texts, edited to a different degree, in random order of ids; and unrelated texts that share passages."""
    rng = random.Random(seed)
    shared, texts = prose(900, 60), []
    for group in range(8):
        words = prose(group, rng.choice([3, 12, 60, 200, 500])).split()
        for _ in range(rng.choice([1, 2, 5, 40])):
            edited = words[:]
            for _ in range(int(len(words) * rng.choice([0, 0, 0.005, 0.02, 0.05]))):
                edited[rng.randrange(len(edited))] = f"w{rng.randrange(10**9)}"
            texts.append(rng.choice([" ", "\n", "  "]).join(edited).replace("the", rng.choice(["the", "THE"])))
    texts += [f"{shared} {prose(k + 50, 40)}" for k in range(40)] + ["a b", "A  b", "a", "", " "]
    rng.shuffle(texts)
    return [*enumerate(texts)]


def test_components_against_brute_force(spark):
    for seed in (1, 2):
        rows = copies(seed)
        docs = clashing(spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], DOCS), "node", "kept", "n", "key")
        got = near_duplicates.mark_duplicates(docs).collect()
        assert {(r.doc_id, r.n_shingles): r.component_id for r in got} == components_by_hand(rows)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)
        kept = near_duplicates.dedupe(docs)
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.kept)


def test_a_group_around_one_text(spark):
    """Copies that are linked with their source only, which has neither the first nor the last id."""
    words = [f"v{k}" for k in range(400)]
    texts = []
    for k in range(300):
        edited = words[:]
        at = random.Random(k).randrange(0, 350)
        edited[at : at + 48] = [f"x{k}_{j}" for j in range(48)]
        texts.append(" ".join(edited))
    texts.insert(137, " ".join(words))
    rows = [*enumerate(texts)]
    got = near_duplicates.mark_duplicates(spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], DOCS)).collect()
    assert {(r.doc_id, r.n_shingles): r.component_id for r in got} == components_by_hand(rows)


def star(n: int):
    """A text, and copies of it that are linked with it only."""
    words = [f"v{k}" for k in range(400)]
    texts = [" ".join(words)]
    for k in range(n):
        edited = words[:]
        for at in random.Random(k).sample(range(5, 395, 8), 10):
            edited[at] = f"x{k}_{at}"
        texts.append(" ".join(edited))
    return [*enumerate(texts)]


def test_a_group_that_many_tasks_share(spark):
    rows = star(300)
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], DOCS)
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "150")
    try:
        classes = docs.select(near_duplicates.marked("text").alias("m")).select("m.node", "m.signature").cache()
        pairs = near_duplicates.forest_pairs(classes)[0].select("a", "b").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    source = bytes(docs.where("doc_id = 0").select(near_duplicates.digested("text")).first()[0])
    # all copies have met their source, however many tasks the group is cut into
    assert len({bytes(r.a) for r in pairs if bytes(r.b) == source}) == 300


def test_near_copies_in_a_crowded_region(spark):
    """Pairs of near copies among many documents that share 72 % of their words with all others."""
    rng, rows = random.Random(7), []
    shared = [f"s{k}" for k in range(288)]
    for k in range(700):
        own = [f"d{k}_{j}" for j in range(112)]
        for copy in range(2):
            edited = own[:]
            at, size = 40 * copy, rng.choice([16, 20, 24, 40])
            edited[at : at + size] = [f"e{k}_{copy}_{j}" for j in range(size)]
            rows.append(" ".join(shared + edited))
    rng.shuffle(rows)
    rows = [*enumerate(rows)]
    got = near_duplicates.mark_duplicates(spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], DOCS)).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.component_id, set()).add(r.doc_id)
    name = lambda text: text.split()[-1].split("_")[0]
    sets = [{*zip(*(t.split()[i:] for i in range(5)), strict=False)} for _, t in rows]
    pairs = {}
    for k, t in rows:
        pairs.setdefault(name(t), []).append(k)
    want = {frozenset(p) for p in pairs.values() if 100 * len(sets[p[0]] & sets[p[1]]) >= 75 * len(sets[p[0]] | sets[p[1]])}
    assert len(want) > 300 and {frozenset(g) for g in groups.values() if len(g) > 1} == want


def test_neighbours_across_cuts(spark):
    """Rows of short tasks meet as if the order had no cuts."""
    rng = np.random.default_rng(3)
    keys = sorted(bytes([k // 20]) + bytes(4) + rng.integers(0, 2, 60, np.uint8).tobytes() for k in range(40))
    rows = spark.createDataFrame([(key, bytes([k])) for k, key in enumerate(keys)], "key binary, a binary")
    got = {(r.a[0], r.b[0]) for r in near_duplicates.pairs_at_cuts(rows).collect()}
    values = [np.frombuffer(k[1:], ">u2") for k in keys]
    near = [(i, j) for i in range(40) for j in range(40) if 0 < abs(i - j) <= near_duplicates.NEIGHBOURS and i // 20 == j // 20]
    assert got == {(i, j) for i, j in near if (values[i] == values[j]).sum() >= near_duplicates.AGREEING}


def test_odd_rows(spark, odd, empty):
    got = near_duplicates.mark_duplicates(odd).collect()
    assert len(got) == len(ODD)
    assert {r.doc_id for r in got if r.n_shingles == 0} == {1, 2, 3} and all(r.kept for r in got)
    kept = near_duplicates.dedupe(odd).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 1, 2, 3, 4, 5, 6, 7]
    assert near_duplicates.dedupe(empty).count() == 0 and near_duplicates.mark_duplicates(empty).count() == 0
    same = spark.createDataFrame([(k % 2, prose(4, 90), "en", "s", 1) for k in range(6)], DOCS)
    assert [r.doc_id for r in near_duplicates.dedupe(same).collect()] == [0]
    assert {r.component_id for r in near_duplicates.mark_duplicates(same).collect()} == {0}


def test_stars_join_long_chains(spark):
    edges = [(f"n{k:03}".encode(), f"n{k + 1:03}".encode()) for k in range(60)] + [(b"z1", b"z0"), (b"z1", b"z2"), (b"y", b"y")]
    found = {bytes(r.node): bytes(r.root) for r in near_duplicates.components(spark.createDataFrame(edges, "a binary, b binary")).collect()}
    assert {found[f"n{k:03}".encode()] for k in range(61)} == {b"n000"} and {found[k] for k in (b"z0", b"z1", b"z2")} == {b"z0"}
    assert near_duplicates.components(spark.createDataFrame([], "a binary, b binary")).count() == 0


def test_longest_increasing_subsequence():
    def by_hand(values):
        best = [1] * len(values)
        for i in range(len(values)):
            best[i] = 1 + max((best[j] for j in range(i) if values[j] < values[i]), default=0)
        return max(best, default=0)

    for seed in range(200):
        values = np.random.default_rng(seed).permutation(seed % 12).tolist()
        chain = [values[i] for i in licenses.increasing(values)]
        assert chain == sorted(chain) and len(chain) == by_hand(values)


def test_alignment_keeps_order():
    rng = random.Random(5)
    for _ in range(300):
        a, b = [rng.randrange(9) for _ in range(rng.randrange(14))], [rng.randrange(9) for _ in range(rng.randrange(14))]
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
        if a == b:
            assert len(pairs) == len(a)


def test_license_spans(spark, odd, empty):
    mit = licenses.TEMPLATES["MIT-text"]
    edited = mit.replace("merge, publish", "MERGE & print").replace("\n", " ")
    texts = [
        f"{prose(1, 100)}\nReleased under the MIT License.\n{prose(2, 30)}\nReleased under the MIT License.",
        f"// {mit}\n{prose(3, 40)}",
        f"# {edited} {prose(4, 3000)}",
        prose(5, 3000),
        "Lizenz: é Licensed under CC BY-NC 4.0.",
        " ".join(mit.split()[::-1]),
    ]
    rows = clashing(spark.createDataFrame([(k, t, "en", "s", 1) for k, t in enumerate(texts)], DOCS), "licenses", "license")
    got = {r.doc_id: [(s.license, r.text[s.start : s.end], s.coverage) for s in r.licenses] for r in licenses.scan_licenses(rows).collect()}
    assert got[0] == [("MIT", "Released under the MIT License", 1.0)] * 2
    assert [(n, c) for n, _, c in got[1] if n == "MIT-text"] == [("MIT-text", 1.0)] and got[1][0][1].startswith("Permission is hereby")
    assert [n for n, _, c in got[2] if c > 0.9] == ["MIT-text"]
    assert got[3] == [] and got[5] == []
    assert [(n, t) for n, t, _ in got[4]] == [("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0")]
    assert all(not r.licenses for r in licenses.scan_licenses(odd).collect())
    assert licenses.scan_licenses(empty).count() == 0
    assert all(not r.licenses for r in licenses.scan_licenses(rows, templates={"none": "", "dash": "--"}).collect())


def scanned(text: str, name: str):
    found = licenses.Scanner(licenses.TEMPLATES)(next(blocks(pa.array([text], pa.string())))).to_pylist()[0]
    return [(s["start"], s["end"], s["coverage"]) for s in found if s["license"] == name]


def test_adjacent_copies():
    """Each of 2 to 50 copies in a row, in the middle of a text, is a span of its own."""
    for name, template in licenses.TEMPLATES.items():
        words = template.rstrip(".")
        for n in (2, 3, 4, 7, 50):
            text = f"{prose(1, 60)}\n" + f"{template}\n" * n + prose(2, 60)
            starts = [m.start() for m in re.finditer(re.escape(words), text)]
            assert scanned(text, name) == [(k, k + len(words), 1.0) for k in starts] and len(starts) == n, (name, n)


def test_quotes_that_lack_the_rarest_words():
    mit = licenses.TEMPLATES["MIT-text"].split()
    part = " ".join(mit[len(mit) * 15 // 100 :])
    got = scanned(f"{prose(1, 90)} {' '.join(mit)} {prose(2, 300)} {part} {prose(3, 90)}", "MIT-text")
    assert len(got) == 2 and got[0][2] == 1.0 and 0.8 <= got[1][2] < 0.9
    # one quote, and the words that it lacks once elsewhere
    got = scanned(f"{' '.join(mit[:20])} {prose(4, 900)} {part} {prose(5, 90)}", "MIT-text")
    assert len(got) == 1 and 0.8 <= got[0][2] < 0.9

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.corpus import clashing

from haulwatch.llm import vector_codes, whitening
from haulwatch.llm.queries import ORACLES, QUERIES

VECTORS = "vec_id bigint, embedding array<float>, label int"


def plain_codes(rows):
    """Codes by the definition, one number after another."""
    kept = [r for r in rows if r[1] is not None and all(c is not None and np.isfinite(c) for c in r[1])]
    length = max((len(r[1]) for r in kept), default=0)
    length = max(1, -(-length // 8))
    whole = lambda r: [int(np.floor(4096 * float(np.float32(c)))) for c in r[1]] + [0] * (8 * length - len(r[1]))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, whole(r)))
    x = [whole(r) for r in kept]
    parts = [[v[p * length : (p + 1) * length] for p in range(8)] for v in x]
    first = {}
    for r, v in zip(kept, parts, strict=True):
        first.setdefault(r[0], v)
    books = [[v[p] for v in list(first.values())[:16]] for p in range(8)]
    far = lambda a, b: sum((i - j) ** 2 for i, j in zip(a, b, strict=True))
    near = lambda: [[min((far(v[p], e), k) for k, e in enumerate(books[p])) for p in range(8)] for v in parts]
    for _ in range(6):
        found = near()
        for p in range(8):
            for k in range(len(books[p])):
                mine = [v[p] for v, f in zip(parts, found, strict=True) if f[p][1] == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    out, by_label = [], {}
    for r, f in zip(kept, near(), strict=True):
        out.append((r[0], "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), r[2]))
        by_label[r[2]] = by_label.get(r[2], 0) + out[-1][2]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    fits = lambda v: v if v < 1 << 63 else None
    return sorted(((k, c, fits(e), fits(by_label[label]), digest) for k, c, e, label in out), key=str)


def vectors(seed, n, width, scale=0.2):
    rng = np.random.default_rng(seed)
    values = (rng.normal(size=(n, width)) * scale).astype(np.float32)
    return [(k, v.tolist(), random.Random(k).choice([None, 1, 2, 3])) for k, v in enumerate(values)]


ODD = [
    (3, [0.5] * 16, 1), (3, [0.25] * 16, 1), (3, [0.25] * 16, None), (None, [0.1] * 16, 2), (None, [0.3] * 16, 2), (7, None, 1),
    (8, [0.1, None] * 8, 1), (9, [float("nan")] + [0.1] * 15, 1), (10, [float("inf")] + [0.1] * 15, 1), (11, [0.75] * 5, 1), (12, [], 2),
    (13, [-0.0001] * 16, 1),
]


@pytest.mark.parametrize("rows", [vectors(1, 300, 64), vectors(2, 40, 24, 900.0), vectors(3, 9, 8), ODD, ODD * 3 + vectors(4, 60, 13), vectors(5, 30, 16, 1e7)])
def test_codes_equal_plain_python(spark, rows):
    got = vector_codes.compress(spark.createDataFrame(rows, VECTORS)).select("vec_id", "codes.*").collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_codes(rows)


def test_codes_keep_columns(spark):
    rows = clashing(spark.createDataFrame(ODD, VECTORS), "row", "x", "key", "codes", "code", "error", "of", "salt", "of_salt", "first", "label_error")
    got = vector_codes.compress(rows)
    assert set(got.columns) == {*rows.columns, "codes"} and got.count() == 8
    assert {r.x for r in got.collect()} == {7}
    none = vector_codes.compress(spark.createDataFrame([], VECTORS))
    assert none.count() == 0 and none.columns == ["vec_id", "embedding", "label", "codes"]


def test_many_labels_are_joined_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "LABELS", 1)
    test_codes_equal_plain_python(spark, vectors(6, 80, 16))


def test_huge_components(spark):
    rows = [(k, [float(3e38 if k % 2 else -2e30)] * 8 + [float(k)] * 8, 1) for k in range(40)]
    got = vector_codes.compress(spark.createDataFrame(rows, VECTORS)).select("codes.*").collect()
    assert len(got) == 40 and all(len(r.code) == 16 for r in got)


def test_waves_are_walsh_functions():
    w = vector_codes.waves(np.eye(16, dtype=np.int64)).T
    assert (w @ w.T == 16 * np.eye(16)).all() and ((w[:, 1:] != w[:, :-1]).sum(axis=1) == range(16)).all()


def test_nearest_is_exact():
    rng = np.random.default_rng(0)
    for length in (1, 2, 5, 8, 13):
        for scale in (2, 5000, 1 << 44):
            parts, entries = rng.integers(-scale, scale, (60, length)), rng.integers(-scale, scale, (7, length))
            entries[5], parts[3] = entries[2], entries[2]
            index, distance = vector_codes.nearest(parts, entries)
            want = ((parts[:, None].astype(object) - entries[None].astype(object)) ** 2).sum(axis=2)
            assert (distance == want.min(axis=1)).all() and index.tolist() == [w.tolist().index(min(w)) for w in want]


def check_whitened(rows, got):
    kept = [r for r in rows if r[1] and all(c is not None and np.isfinite(c) for c in r[1])]
    width = max(len(r[1]) for r in kept)
    x = np.array([[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in r[1]] + [100_000] * (width - len(r[1])) for r in kept], object)
    n, sums = len(x), x.sum(axis=0)
    away = ((n * x - sums) ** 2).sum(axis=1)
    centred = (n * x - sums).astype(float) / n
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:8], axes[:, ::-1][:, :8]
    assert len(got) == n * len(values) and {r.n for r in got} == {n}
    assert sorted(r.deviation for r in got) == sorted(int(a) for a in away for _ in values)
    for k, value in enumerate(values):
        mine = [r for r in got if r.component == k + 1]
        assert all(abs(r.explained - value / np.trace(covariance)) < 1e-9 for r in mine)
        if value < 1e-9:
            assert all(r.whitened is None for r in mine)
            continue
        want = sorted((str(r[0]), w) for r, w in zip(kept, centred @ axes[:, k] / np.sqrt(value), strict=True))
        have, turned = (sorted((str(r.vec_id), s * r.whitened) for r in mine) for s in (1, -1))
        off = min(max(abs(a[1] - b[1]) for a, b in zip(h, want, strict=True)) for h in (have, turned))
        assert off < 1e-6
    assert all(r.identity_error is not None and r.identity_error < 1e-4 for r in got)


@pytest.mark.parametrize("rows", [vectors(1, 700, 64), vectors(2, 50, 3), vectors(7, 90, 9, 500.0), ODD * 2 + vectors(4, 60, 13), vectors(8, 5, 16)])
def test_whitening_equals_numpy(spark, rows, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_VALUES", 640)
    monkeypatch.setattr(whitening, "SPLIT_BLOCKS", 3)
    frame = spark.createDataFrame(rows, VECTORS).repartition(3)
    check_whitened(rows, whitening.whiten(frame).select("vec_id", F.inline("whitened")).collect())


def test_blocks_of_columns(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_VALUES", 640)
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 7)
    rows = vectors(9, 200, 20)
    check_whitened(rows, whitening.whiten(spark.createDataFrame(rows, VECTORS)).select("vec_id", F.inline("whitened")).collect())


def test_whitening_of_odd_tables(spark):
    none = whitening.whiten(spark.createDataFrame([], VECTORS))
    assert none.count() == 0 and none.columns == ["vec_id", "embedding", "label", "whitened"]
    for rows in ([(1, None, 1)], [(1, [], 1)]):
        assert whitening.whiten(spark.createDataFrame(rows, VECTORS)).count() == 0
    alike = spark.createDataFrame([(k, [0.5] * 4, 1) for k in range(3)], VECTORS)
    got = whitening.whiten(clashing(alike, "row", "x", "index", "w", "whitened", "deviation", "task", "nth", "of", "before", "size"))
    assert [c for c in got.columns if c != "whitened"][:4] == ["vec_id", "embedding", "label", "row"]
    parts = got.select(F.inline("whitened")).collect()
    assert len(parts) == 12 and all(p.whitened is None and p.deviation == 0 and p.explained == 0 and p.identity_error is None for p in parts)
    far = spark.createDataFrame([(k, [1e30 * (k - 1), float(k)], 1) for k in range(3)], VECTORS)
    parts = whitening.whiten(far).select("vec_id", F.inline("whitened")).collect()
    assert {p.deviation for p in parts if p.vec_id != 1} == {None} and len(parts) == 6


def test_codes_equal_sql(spark):
    from fixtures.compare import compare, duck

    con = duck(path := "/root/testdata/sf0.001")
    got, want, diff = compare(spark, con, path, QUERIES["op12_vector_codes"], ORACLES["op12_vector_codes"])
    assert got == want > 0 and not diff

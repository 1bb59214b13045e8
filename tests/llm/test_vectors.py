"""Vector codes and whitening against numpy on all rows."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rootsweep.llm import vector_codes, whitening
from rootsweep.llm.common import ship

VECTORS = "vec_id bigint, embedding array<float>, label int"


@pytest.fixture(scope="module")
def vectors(spark):
    """Clusters with copies, ties, and rows that are left out."""
    ship(spark)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + 0.05 * rng.normal(size=16)).tolist(), i % 3 if i % 7 else None) for i in range(3000)]
    rows += [(3000 + i, rows[0][1], 1) for i in range(500)]
    rows += [(3500, [0.0] * 16, 2), (3501, [-0.0] * 16, 2), (None, rows[5][1], None), (7, rows[9][1], 0)]
    rows += [(4000, None, 1), (4001, [float("nan")] + [0.0] * 15, 1), (4002, [None] + [0.0] * 15, 1), (4003, [float("inf")] * 16, 1),
             (4004, [], 1), (4005, [1.0, 2.0], 1)]
    return spark.createDataFrame(rows, VECTORS).repartition(5)


def usable(df) -> list:
    return [(r.vec_id, r.embedding, r.label) for r in df.collect()
            if r.embedding is not None and len(r.embedding) == 16 and all(v is not None and np.isfinite(v) for v in r.embedding)]


def test_codes_equal_plain_lloyd(vectors):
    rows = usable(vectors)
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, np.floor(4096 * np.array(r[1], float)).astype("<i4").tobytes()))
    x = np.floor(4096 * np.array([r[1] for r in rows], float)).astype(np.int64).reshape(len(rows), 8, 2)
    books = x[:16].transpose(1, 0, 2).copy()

    def nearest():
        return np.stack([np.square(x[:, p, None] - books[p]).sum(2).argmin(1) for p in range(8)], 1)

    for _ in range(6):
        codes = nearest()
        for p in range(8):
            for e in range(16):
                if (mine := codes[:, p] == e).any():
                    books[p, e] = x[mine, p].sum(0) // mine.sum()
    codes = nearest()
    error = sum(np.square(x[:, p] - books[p][codes[:, p]]).sum(1) for p in range(8))
    total: dict = {}
    for r, e in zip(rows, error, strict=True):
        total[r[2]] = total.get(r[2], 0) + int(e)
    digest = hashlib.sha256(",".join(map(str, books.ravel())).encode()).hexdigest()
    want = sorted(((r[0] is None, r[0], "".join(f"{c:02x}" for c in cs), int(e), total[r[2]], digest)
                   for r, cs, e in zip(rows, codes, error, strict=True)), key=str)
    got = vector_codes.vector_codes(vectors.withColumn("x", F.lit("x")).withColumn("code", F.lit(1))).collect()
    assert sorted(((r[0] is None, *r) for r in got), key=str) == want


def test_bounds_assign_whole_nodes():
    """On clustered parts most rows go with their node; all go to the nearest entry."""
    rng = np.random.default_rng(1)
    centres = rng.integers(-4000, 4000, size=(16, 4))
    x = (centres[rng.integers(0, 16, 4000)] + rng.integers(-20, 20, size=(4000, 4))).astype(np.int64)
    x = x[vector_codes.grow(x, vector_codes.LEAF)]
    tree = vector_codes.boxes(len(x), vector_codes.leaves(x, vector_codes.LEAF))
    for entries in (centres, centres[:11], np.vstack([centres[:5], centres[:5]]), centres[:1]):
        want = np.square(x[:, None] - entries).sum(2).argmin(1)
        whole, rows, codes = vector_codes.assign(x, tree, entries.astype(np.int64))
        got = np.full(len(x), -1)
        got[rows] = codes
        for level, nodes, entry in whole:
            at = vector_codes.cuts(len(x), level)
            for n, e in zip(nodes, entry, strict=True):
                assert (got[at[n]:at[n + 1]] == -1).all()
                got[at[n]:at[n + 1]] = e
        assert (got == want).all()
        if len(entries) in (1, 16):
            assert len(rows) < len(x) / 2


def test_codes_of_wide_short_and_few_vectors(spark):
    ship(spark)
    few = spark.createDataFrame([(1, [1e9, 2.0, 3.0], 1), (2, [1e9, 2.0, 4.0], 1), (3, [-1e15, 0.5, 0.25], None)],
                                "vec_id bigint, embedding array<double>, label int")
    got = {r.vec_id: r for r in vector_codes.vector_codes(few).collect()}
    assert {k: (r.code, r.error, r.label_error) for k, r in got.items()} == {
        1: ("0000000000000000", 0, 0), 2: ("0000010000000000", 0, 0), 3: ("0202020000000000", 0, 0)}
    assert vector_codes.vector_codes(few.limit(0)).count() == 0
    assert vector_codes.vector_codes(few.withColumn("embedding", F.lit(None).cast("array<double>"))).count() == 0


def eigen(rows, k=4):
    x = np.floor(256 * np.array(rows, float)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(0)
    c = fit - total / n
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    return x, n, total, e[::-1][:k], u[:, ::-1][:, :k], np.trace(v)


def test_whitening_equals_eigenvectors(vectors):
    rows = sorted(usable(vectors), key=str)
    x, n, total, e, u, trace = eigen([r[1] for r in rows])
    got = whitening.whiten(vectors.withColumn("component", F.lit(9)).withColumn("x", F.lit("x"))).collect()
    assert len(got) == 4 * len(rows)
    by_id: dict = {}
    for r in got:
        by_id.setdefault((r.vec_id, r.deviation), {})[r.component] = r
    want = (x - total / n) @ u / np.sqrt(e)
    signs = np.sign([by_id[(1, int(np.square(n * x[i] - total).sum()))][c + 1].whitened * want[i, c]
                     for i in [next(i for i, r in enumerate(rows) if r[0] == 1)] for c in range(4)])
    for r, xi, w in zip(rows, x, want, strict=True):
        mine = by_id[(r[0], int(np.square(n * xi - total).sum()))]
        for c in range(4):
            assert mine[c + 1].n == n
            assert mine[c + 1].whitened == pytest.approx(signs[c] * w[c], abs=1e-8)
            assert mine[c + 1].explained == pytest.approx(e[c] / trace, rel=1e-9)
            assert mine[c + 1].identity_error < 1e-9


def lead(a, k=4):
    a = a - a.mean(0)
    return whitening.leading(lambda q: (float((w := a @ q) @ w), a.T @ w), a.shape[1], min(a.shape[1], len(a) - 1), k)


def test_repeated_and_missing_eigenvalues():
    rng = np.random.default_rng(2)
    cube = np.array([[(i >> j & 1) * 2 - 1 for j in range(6)] for i in range(64)], float)  # six equal ones
    values, vectors = lead(cube)
    assert values == pytest.approx([8.0] * 4) and np.allclose(vectors @ vectors.T, np.eye(4))
    # two equal large ones among 40, far apart from the rest: found early, the twin too
    base, _ = np.linalg.qr(rng.normal(size=(300, 40)) - 0)
    base = np.linalg.qr(base - base.mean(0))[0]
    scale = np.array([100.0, 100.0, 50.0, 20.0, *np.linspace(1, 0.1, 36)])
    values, _ = lead(base * scale)
    assert values == pytest.approx([100, 100, 50, 20], rel=1e-9)
    # rank two in ten dimensions
    flat = rng.normal(size=(50, 2)) @ rng.normal(size=(2, 10))
    values, vectors = lead(flat)
    want = np.linalg.svd(flat - flat.mean(0))[1]
    assert values[:2] == pytest.approx(want[:2], rel=1e-9) and (values[2:] < 1e-10 * values[0]).all()


def test_whitening_without_variance_and_empty(spark):
    ship(spark)
    one = spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0), (3, None, 0)], VECTORS)
    assert whitening.whiten(one).count() == 0
    assert whitening.whiten(one.limit(0)).count() == 0
    two = spark.createDataFrame([(1, [1e12, 2.0], 0), (2, [-1e12, 2.0], 0), (None, [1e12, 2.0], 0)], "vec_id bigint, embedding array<double>, label int")
    got = whitening.whiten(two).collect()
    assert [(r.component, r.n, r.deviation) for r in got] == [(1, 2, None)] * 3 and {abs(r.whitened) for r in got} == {1.0}

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from tidemart.llm import whitening

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("component", T.IntegerType()), T.StructField("n", T.StringType())])


def make(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "n") for i, v in vectors], SCHEMA)


def check(spark, vectors, components=8):
    got = whitening.whiten(make(spark, vectors), components).collect()
    used = [(i, v) for i, v in vectors if v and all(
        c is not None and math.isfinite(c) for c in v)]
    as_float = np.array([v for _, v in used], dtype=np.float32).astype(float)
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in as_float.tolist()]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = {}
    for (i, _), row in zip(used, x):
        deviation[i] = sum((n * a - s) ** 2 for a, s in zip(row, sums))
    z = np.array(x, dtype=float) - np.array(sums) / n
    cov = z.T @ z / n
    values, vecs = np.linalg.eigh(cov)
    values, vecs = values[::-1], vecs[:, ::-1]
    k = min(components, int((values > len(values) * 1e-13 * values.sum()).sum()))
    assert len(got) == n * k
    rank = {}
    for r in got:
        rank.setdefault(r.vec_id, {})[r.component] = r
        assert r.n == n and r.deviation == deviation[r.vec_id]
        assert abs(r.explained * values.sum() / values[r.component - 1] - 1) < 1e-6
        assert r.identity_error < 1e-6
    for j in range(k):
        want = z @ vecs[:, j] / np.sqrt(values[j])
        have = np.array([rank[i][j + 1].whitened for i, _ in used])
        gap = min(abs(values[j] - v) for m, v in enumerate(values) if m != j) / values[0]
        if gap > 1e-3:
            assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-7
    return got


def test_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    check(spark, [(r.vec_id, r.embedding) for r in rows])


def test_unusable_rows_and_low_rank(spark):
    r = random.Random(2)
    base = [[r.gauss(0, 1) for _ in range(6)] for _ in range(3)]
    vectors = []
    for i in range(80):
        a = [r.gauss(0, s) for s in (3, 1, .2)]
        vectors.append((i, [sum(w * b[d] for w, b in zip(a, base)) for d in range(6)]))
    vectors += [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (102, [float("nan")] * 6),
                (103, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0]), (105, [])]
    check(spark, vectors)
    check(spark, vectors, components=2)
    # another length than most
    got = whitening.whiten(make(spark, [*vectors, (106, [1.0, 2.0])])).collect()
    assert {r.vec_id for r in got} == set(range(80))


def test_nothing_to_whiten(spark):
    assert whitening.whiten(make(spark, [])).count() == 0
    assert whitening.whiten(make(spark, [(1, None), (2, [])])).count() == 0
    assert whitening.whiten(make(spark, [(1, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(make(spark, [(i, [1.0, 2.0]) for i in range(5)])).count() == 0
    # one direction only
    got = whitening.whiten(make(spark, [(None, [1.0, 2.0]), (2, [3.0, 2.0])])).collect()
    assert sorted(round(abs(r.whitened), 9) for r in got) == [1.0, 1.0]


def test_deviation_beyond_a_long(spark):
    got = whitening.whiten(make(spark, [(1, [1e15, 0.0]), (2, [-1e15, 0.5])])).collect()
    assert [r.deviation for r in got] == [None, None]


@pytest.mark.parametrize("kind", ["random", "clustered", "equal", "zero", "far", "diagonal"])
def test_eigen(kind):
    rng = np.random.default_rng(7)
    for n in (1, 2, 3, 7, 40):
        q = np.linalg.qr(rng.normal(size=(n, n)))[0]
        values = {
            "random": rng.uniform(0, 1, n), "clustered": 1 + 1e-9 * rng.normal(size=n),
            "equal": np.repeat([5.0, 2.0], [n // 2, n - n // 2]), "zero": np.zeros(n),
            "far": 10.0 ** -rng.uniform(0, 14, n), "diagonal": rng.uniform(0, 1, n)}[kind]
        a = np.diag(values) if kind == "diagonal" else (q * values) @ q.T
        a = (a + a.T) / 2
        got, vectors = whitening.eigen(a)
        scale = max(np.linalg.norm(a), 1e-300)
        assert np.abs(got - np.sort(values)[::-1]).max() <= 1e-13 * n * scale
        assert np.linalg.norm(a @ vectors - vectors * got) <= 1e-12 * n * scale
        assert np.abs(vectors.T @ vectors - np.eye(n)).max() < 1e-12
        some, _ = whitening.eigen(a, 2)
        assert np.allclose(some, got[:2], atol=1e-13 * n * scale)

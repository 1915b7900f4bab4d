from __future__ import annotations

import numpy as np
import pytest

from tidemark.llm import whitening, workload

SCHEMA = "vec_id long, embedding array<float>"


def brute_force(rows, k=32):
    """(x of the usable rows, eigenvalues, components, trace) with the library's own eigenvalues."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) and all(e is not None and np.isfinite(e) for e in v)]
    x = np.array([[int(np.floor(64 * float(np.float32(e)))) + 1_000_000 for e in v] for _, v in kept])
    y = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(y.T @ y / len(x))
    return [i for i, _ in kept], x, values[::-1][:k], vectors[:, ::-1].T[:k], values.sum()


def check(rows, found, k=32, gaps=True):
    ids, x, values, components, trace = brute_force(rows, k)
    n, sums = len(x), x.sum(axis=0)
    got = {}
    for r in found:
        assert r.n == n and abs(r.explained / (values[r.component - 1] / trace) - 1) < 1e-9
        assert r.identity_error < 1e-8
        got.setdefault(r.vec_id, {})[r.component] = (r.whitened, r.deviation)
    assert sorted(got) == sorted(ids) and all(len(c) == len(values) for c in got.values())
    for i, row in zip(ids, x, strict=True):
        assert {d for _, d in got[i].values()} == {sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True))}
    made = np.array([[got[i][c + 1][0] for c in range(len(values))] for i in ids])
    assert np.abs(made.T @ made / n - np.eye(len(values))).max() < 1e-8
    if gaps:
        want = (x - x.mean(axis=0)) @ components.T / np.sqrt(values)
        signs = np.sign((made * want).sum(axis=0))
        assert np.abs(made - want * signs).max() < 1e-6


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    found = workload.op12_whitening(spark, folder)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(rows, found.collect())


def test_odd_vectors_and_clashing_columns(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(e) for e in rng.normal(size=5) * [9, 5, 3, 2, 1]]) for i in range(300)]
    nan, inf = float("nan"), float("inf")
    odd = [(300, None), (301, [1.0, None, 2.0, 3.0, 4.0]), (302, [nan, 0, 0, 0, 0]), (303, [inf, 0, 0, 0, 0]), (304, []), (305, [3e38] * 5)]
    given = [(i, v and [None if e is None else float(e) for e in v], 1.0) for i, v in rows + odd + [(306, [1.0, 2.0])]]
    df = spark.createDataFrame(given, SCHEMA + ", EMBEDDING double").repartition(4)
    model = whitening.fit(df, 32)
    check(rows, whitening.report(df, model).collect())
    assert model.n == 300 and len(model.values) == 5


def test_repeated_rows_null_ids_and_few_directions(spark):
    # Two directions with variance, one of them three times in the table; a third of all rows is one row.
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 2)) @ rng.normal(size=(2, 6)) * 20
    rows = [(i, [float(round(e)) for e in v]) for i, v in enumerate(base @ np.zeros((6, 6)) + np.outer(rng.normal(size=40), np.arange(6)))]
    rows += [(None, [0.0] * 5 + [1.0])] * 20
    df = spark.createDataFrame(rows, SCHEMA)
    model = whitening.fit(df)
    found = whitening.report(df, model).collect()
    assert len(found) == 60 * len(model.values) and sum(r.vec_id is None for r in found) == 20 * len(model.values)
    x = np.array([v for _, v in rows]) * 64
    assert len(model.values) == np.linalg.matrix_rank(x - x.mean(axis=0))
    assert model.identity_error < 1e-8


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [2.0, 2.0]), (2, [2.0, 2.0])]])
def test_nothing_to_whiten(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    found = whitening.report(df, whitening.fit(df))
    assert found.columns[0] == "vec_id" and found.count() == 0


def test_whole_numbers_beyond_64_bits():
    n = 4 * 10**11
    x = np.array([[1_000_000, 3_000_000_000], [1_000_064, 5]])
    sums = [n * 1_000_001 + 17, -n * 7 - 5]
    centre = whitening.Centre(n, sums)
    assert centre.deviations(x) == [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    assert np.allclose(centre.centred(x), [[float(a) - s / n for a, s in zip(row, sums, strict=True)] for row in x])


@pytest.mark.parametrize("kind", ["random", "equal", "diagonal", "blocks", "graded", "one"])
def test_eigenvectors(kind):
    rng = np.random.default_rng(5)
    n = 1 if kind == "one" else 60
    q, _ = np.linalg.qr(rng.normal(size=(n, n)))
    spectrum = {
        "random": rng.random(n), "equal": np.array([3.0] * 40 + [1.0] * 20)[:n], "graded": 10.0 ** -np.linspace(0, 12, n), "one": np.array([2.0]),
    }.get(kind)
    if kind == "diagonal":
        a = np.diag(np.arange(n, dtype=float))
    elif kind == "blocks":
        a = np.kron(np.eye(n // 2), np.array([[2.0, 1.0], [1.0, 2.0]]))
    else:
        a = q @ np.diag(spectrum) @ q.T
        a = (a + a.T) / 2
    values, vectors = whitening.eigen(a, 32)
    k, norm = min(32, n), np.abs(a).max()
    want = np.linalg.eigvalsh(a)[::-1][:k]
    assert np.abs(values - want).max() < 1e-13 * n * norm
    assert np.abs(vectors @ vectors.T - np.eye(k)).max() < 1e-12
    assert np.abs(a @ vectors.T - vectors.T * values).max() < 1e-12 * n * norm

"""Whitening against a plain eigendecomposition."""

import math

import numpy as np
import pytest

from sensorlab.llm import whitening

SHAPE = "vec_id long, embedding array<float>, n int, component string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "x") for i, v in rows], SHAPE).repartition(parts)


def plain(rows, components=32):
    """Per row: deviation and whitened values up to sign, and the shares of the trace."""
    x = [[math.floor(64.0 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in x])
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    k = min(components, int((e > 1e-10 * e[0]).sum()))
    return deviation, centred @ u[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def check(spark, rows, got, components=32):
    deviation, whitened, explained = plain(rows, components)
    found = {(r["vec_id"], r["component"]): r for r in got}
    assert len(found) == len(got) == len(rows) * len(explained)
    table = np.array([[found[i, c + 1]["whitened"] for c in range(len(explained))] for i, _ in rows])
    signs = np.sign((table * whitened).sum(axis=0))
    assert np.allclose(table, whitened * signs, atol=1e-6)
    for k, (i, _) in enumerate(rows):
        assert found[i, 1]["deviation"] == deviation[k] and found[i, 1]["n"] == len(rows)
    assert [found[rows[0][0], c + 1]["explained"] for c in range(len(explained))] == pytest.approx(list(explained), rel=1e-6)
    assert max(r["identity_error"] for r in got) < 1e-9


def test_more_dimensions_than_the_block(spark):
    rng = np.random.default_rng(1)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(300, 70)) * np.linspace(3, 0.4, 70))]
    odd = [(900, None), (901, []), (902, [1.0] * 69 + [None]), (903, [float("nan")] * 70), (904, [float("inf")] + [0.0] * 69), (905, [1.0, 2.0])]
    check(spark, rows, whitening.whiten(frame(spark, rows + odd)).collect())


def test_close_eigenvalues_and_few_directions(spark):
    rng = np.random.default_rng(2)
    flat = [(i, v) for i, v in enumerate(rng.normal(size=(2000, 64)))]
    check(spark, flat, whitening.whiten(frame(spark, flat)).collect())
    basis = rng.integers(-3, 4, size=(5, 60))
    few = [(i, v / 64 * 4) for i, v in enumerate(rng.integers(-4, 5, size=(80, 5)) @ basis)]
    check(spark, few, whitening.whiten(frame(spark, few)).collect())
    narrow = [(i, v) for i, v in enumerate(rng.normal(size=(50, 3)))]
    check(spark, narrow, whitening.whiten(frame(spark, narrow)).collect())
    check(spark, narrow, whitening.whiten(frame(spark, narrow), components=2).collect(), 2)


def test_odd_tables(spark):
    assert whitening.whiten(frame(spark, []).limit(0)).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0])] * 4)).count() == 0
    assert whitening.whiten(frame(spark, [(1, None), (2, [])])).count() == 0
    rows = whitening.whiten(frame(spark, [(None, [0.0, 1.0]), (1, [2.0, 1.0]), (1, [2.0, 1.0])])).collect()
    assert len(rows) == 3 and sorted(str(r["vec_id"]) for r in rows) == ["1", "1", "None"]
    large = whitening.whiten(frame(spark, [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 5.0])])).collect()
    assert len(large) >= 3 and all(r["deviation"] == 2**63 - 1 for r in large if r["vec_id"] != 3)


def test_iteration_finds_what_it_started_without():
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.normal(size=(90, 90)))[0]
    e = np.concatenate([np.full(30, 7.0), 6.9 - 0.001 * np.arange(10), np.linspace(5, 4.9, 50)])
    v = (q * e) @ q.T
    values, u = whitening.leading(lambda x: v @ x, 90, 32)
    assert np.allclose(values, e[:32], atol=1e-10)
    assert np.allclose(u.T @ u, np.eye(32), atol=1e-12) and np.abs(v @ u - u * values).max() < 1e-9
    assert whitening.lowest(lambda x: v @ x, 90, rng) <= 4.9 + 1e-9


def test_exact_sums_and_deviations_of_large_numbers():
    x = np.array([[2**61, 5], [2**61, -7], [2**60, 0]])
    assert whitening.whole_sum(x) == [2**62 + 2**60, -2]
    centre = whitening.Centred(3, whitening.whole_sum(x))
    want = [sum((3 * int(c) - s) ** 2 for c, s in zip(row, whitening.whole_sum(x))) for row in x]
    assert centre.deviation(x).tolist() == [min(w, 2**63 - 1) for w in want]

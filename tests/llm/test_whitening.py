"""Whitening against the eigenvectors of the exact covariance matrix."""

import math
from fractions import Fraction

import numpy as np
import pytest

from sortwell.llm import whitening as W

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id bigint, embedding array<float>, key string, x string, component string, n string, whitened string"


def usable(v):
    return v and all(c is not None and math.isfinite(c) for c in v)


def by_hand(rows):
    """n, deviations by row number, eigenvalues and vectors (falling), centred rows."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    whole = [[n * a - s for a, s in zip(row, sums)] for row in x]
    y = np.array([[float(Fraction(a, n)) for a in row] for row in whole])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    return n, [sum(a * a for a in row) for row in whole], values[::-1], vectors[:, ::-1], y


def check(df, rows, components=8, tolerance=1e-7):
    n, far, values, vectors, y = by_hand([v for _, v in rows])
    found = df.collect()
    k = min(components, vectors.shape[1])
    assert len(found) == len(rows) * k
    z = y @ vectors[:, :k] / np.sqrt(values[:k])
    got = {(r.vec_id, r.component): r for r in found}
    table = np.array([[got[(i, c + 1)].whitened for c in range(k)] for i, _ in rows])
    signs = np.sign((table * z).sum(axis=0))
    assert np.abs(table * signs - z).max() < tolerance
    assert {r.n for r in found} == {n}
    assert [got[(i, 1)].deviation for i, _ in rows] == far
    for c in range(k):
        assert abs(got[(rows[0][0], c + 1)].explained / (values[c] / values.sum()) - 1) < 1e-9
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-9


def test_whole_table(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    check(W.whitening_report(table), [(r.vec_id, r.embedding) for r in table.collect()])


def test_odd_rows_are_left_out(spark):
    draw = np.random.default_rng(3)
    good = [(i, [float(c) for c in draw.standard_normal(5)]) for i in range(60)]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0, 4.0]), (103, [1.0, NAN, 2.0, 3.0, 4.0]),
           (104, [1.0, 2.0, 3.0, 4.0, -INF]), (105, [1.0, 2.0]), (106, [1e30, 0.0, 0.0, 0.0, 0.0])]
    rows = [(i, v, "k", "x", "c", "n", "w") for i, v in good + bad]
    check(W.whitening_report(spark.createDataFrame(rows, SCHEMA)), good)


def test_empty_single_and_equal_rows(spark):
    assert W.whitening_report(spark.createDataFrame([], SCHEMA)).count() == 0
    one = [(1, [0.5, 0.25], "", "", "", "", "")]
    found = W.whitening_report(spark.createDataFrame(one, SCHEMA))
    assert found.count() == 0
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert W.whitening_report(spark.createDataFrame(one * 50, SCHEMA)).count() == 0


def test_repeated_rows_and_missing_rank(spark):
    """Repeated rows without an id count as often as they come; three rows have two components."""
    rows = [(None, [0.5, 0.25, 0.0], "", "", "", "", "")] * 30 + [(2, [1.5, 0.25, 4.0], "", "", "", "", ""), (3, [0.0, 9.25, 0.0], "", "", "", "", "")]
    found = W.whitening_report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.n for r in found} == {32} and {r.component for r in found} == {1, 2}
    assert len(found) == 64


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(2**50 + i * 2**30), float(i % 3) * 2.0**40, -float(2**45)]) for i in range(9)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = W.whitened(table).collect()
    x = [[math.floor(1024 * c) + 100000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    want = {i: sum((9 * a - s) ** 2 for a, s in zip(row, sums)) for i, row in enumerate(x)}
    assert {r.key: int(r.deviation) for r in found} == want
    assert {r.component for r in found} == {1, 2}


def covariance(values, seed=1):
    draw = np.random.default_rng(seed)
    q, _ = np.linalg.qr(draw.standard_normal((len(values), len(values))))
    return (q * values) @ q.T


SPECTRA = {
    "flat": np.linspace(1.3, 0.9, 200),
    "steep": 10.0 ** -np.arange(0, 10, 0.1),
    "rank 3": np.array([5.0, 3.0, 1.0] + [0.0] * 97),
    "one large": np.array([1e6] + list(np.linspace(1.2, 0.8, 149))),
    "small": np.array([3.0, 2.0]),
    "equal": np.ones(80),
}


@pytest.mark.parametrize("name", sorted(SPECTRA))
def test_pairs_of_spectra(name):
    values = SPECTRA[name]
    v = covariance(values)
    passes = []

    def times(block):
        passes.append(block.shape[1])
        return v @ block

    found, axes = W.leading_pairs(times, len(values), 8)
    want = values[: min(8, len(values))]
    want = want[want > 0]
    assert np.abs(found - want).max() < 1e-10 * values[0]
    assert np.abs(axes.T @ axes - np.eye(len(found))).max() < 1e-12
    assert np.linalg.norm(v @ axes - axes * found, axis=0).max() < 1e-10 * values[0]
    assert len(passes) < 400

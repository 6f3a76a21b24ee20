"""Whitening: against a decomposition of the whole covariance matrix."""

import numpy as np
import pytest

from listmill.llm import whitening
from listmill.llm.whitening import Spectrum, secular_roots, whiten


def scatter(x):
    return (x - x.mean(0)).T @ (x - x.mean(0))


def held(spectrum, x):
    rebuilt = spectrum.basis @ np.diag(spectrum.values) @ spectrum.basis.T
    scale = max(1.0, np.abs(scatter(x)).max())
    assert np.abs(rebuilt - scatter(x)).max() < 1e-10 * scale
    assert np.abs(spectrum.basis.T @ spectrum.basis - np.eye(x.shape[1])).max() < 1e-11
    assert (np.diff(spectrum.values) >= 0).all()
    assert spectrum.n == len(x) and np.allclose(spectrum.mean, x.mean(0))


def spectrum_of(x):
    spectrum = Spectrum.empty(x.shape[1])
    for row in x:
        spectrum.add(row)
    return spectrum


def cases():
    rng = np.random.default_rng(0)
    x = np.floor(rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12)) * 20)
    equal_columns = x.copy()
    equal_columns[:, 3], equal_columns[:, 7] = x[:, 4], 5
    return {
        "random": x, "one column": x[:, :1], "two columns": x[:, :2], "one row": x[:1], "equal rows": np.repeat(x[:1], 40, 0),
        "copies": np.repeat(x[:20], 9, 0), "equal columns": equal_columns, "axes": np.eye(12)[rng.integers(0, 12, 200)] * 7,
        "fewer rows than columns": x[:7], "far from zero": 1e6 + np.floor(x * 0.05), "far apart": x * np.logspace(0, 6, 12),
    }


@pytest.mark.parametrize("name", cases())
def test_updates_keep_the_spectrum(name):
    held(spectrum_of(cases()[name]), cases()[name])


@pytest.mark.parametrize("name", cases())
def test_spectra_combine(name):
    x = cases()[name]
    for at in (0, len(x) // 3, len(x)):
        one, other = spectrum_of(x[:at]), spectrum_of(x[at:])
        one.combine(other)
        held(one, x)


def test_roots_interlace_and_solve():
    rng = np.random.default_rng(1)
    for k in (2, 5, 40):
        d, z2 = np.sort(rng.random(k) * 10.0 ** rng.integers(0, 6, k)), rng.random(k) * 10.0 ** rng.integers(-8, 3, k)
        delta = secular_roots(d, z2)
        assert (np.tril(delta, -1) > 0)[np.tril_indices(k, -1)].all() and (delta[np.triu_indices(k)] < 0).all()
        want = np.linalg.eigvalsh(np.diag(d) + np.sqrt(np.outer(z2, z2)))
        assert np.allclose(d - np.diag(delta), want, rtol=1e-10, atol=1e-10 * want[-1])


def integers_of(rows):
    return [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in rows]


def check(out, ids, x, components=32):
    """Rows of the operator against numpy on the exact integers."""
    n, sums = len(x), [sum(c) for c in zip(*x)]
    away = [[n * c - s for c, s in zip(v, sums)] for v in x]
    y = np.array([[a / n for a in v] for v in away])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int((values > 1e-12 * values[0]).sum()))
    assert len(out) == n * k
    got = {(r.vec_id, r.component): r for r in out}
    for i, v in zip(ids, away):
        assert {got[i, c].deviation for c in range(1, k + 1)} == {sum(a * a for a in v)}
        assert {got[i, c].n for c in range(1, k + 1)} == {n}
    for c in range(1, k + 1):
        have = np.array([got[i, c].whitened for i in ids])
        want = y @ vectors[:, c - 1] / np.sqrt(values[c - 1])
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-8
        assert got[ids[0], c].explained == pytest.approx(values[c - 1] / values.sum(), rel=1e-10)
    assert max(r.identity_error for r in out) < 1e-9


def test_equals_a_whole_decomposition(spark):
    rng = np.random.default_rng(2)
    rows = (rng.normal(size=(900, 10)) * np.linspace(1, 3, 10) + rng.normal(size=10)).astype(np.float32)
    rows[300:600] = rows[0]  # a third of all rows is one vector
    df = spark.createDataFrame([(i, v.tolist(), "x") for i, v in enumerate(rows)], "vec_id bigint, embedding array<float>, whitened string")
    out = whiten(df.repartition(40)).collect()
    check(out, list(range(900)), integers_of(rows))
    check(whiten(df.repartition(1), components=4).collect(), list(range(900)), integers_of(rows), 4)


def test_rows_that_go(spark):
    nan, inf = float("nan"), float("inf")
    good = [[0.5, 1.0], [2.0, -1.0], [0.25, 0.125], [1.5, 3.0]]
    bad = [None, [], [nan, 1.0], [inf, 1.0], [1.0, -inf], [None, 1.0], [1.0], [1.0, 2.0, 3.0], [1e300, 0.0]]
    df = spark.createDataFrame(list(enumerate([*good, *bad])), "vec_id int, embedding array<double>")
    out = whiten(df).collect()
    check(out, [0, 1, 2, 3], integers_of(good))


def test_tables_without_spread(spark):
    schema = "vec_id string, embedding array<float>"
    for rows in ([], [("a", None)], [("a", [])], [("a", [1.0, 2.0])], [("a", [1.0, 2.0])] * 5):
        out = whiten(spark.createDataFrame(rows, schema))
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and out.collect() == []


def test_equal_columns_and_null_ids(spark):
    rows = [(None, [float(i), float(i), 7.0]) for i in range(20)]
    out = whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect()
    assert len(out) == 20 and {r.component for r in out} == {1} and {r.vec_id for r in out} == {None}
    assert out[0].explained == pytest.approx(1)


def test_integers_beyond_64_bits():
    model = whitening.Whitening(2, 64, 0, 3_000_000_000, [3, -3], np.ones(2), 2.0, np.eye(2))
    x = np.array([[0, 0], [1 << 50, 5]])
    assert model.deviations(x) == [18, None]
    assert model.away(x)[1].tolist() == [3_000_000_000 * (1 << 50) - 3, 15_000_000_003]
    assert whitening._exact_sums(np.array([[1 << 52, -5], [1 << 52, -(1 << 40)]])) == [1 << 53, -5 - (1 << 40)]

import numpy as np
import pytest

from ledgerloom.llm.whitening import jacobi_columns, learn_whitening, pivoted_cholesky, squared_deviation, whitening_report


def brute(vectors):
    """The contract on a list of vectors, by numpy's own eigenvectors and Python's integers."""
    x = [[int(np.floor(1024 * float(c))) + 100000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    centred = np.array([[(n * a - s) / n for a, s in zip(v, sums)] for v in x])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values)
    return n, deviation, centred @ vectors[:, order] / np.sqrt(values[order]), values[order] / values.sum()


@pytest.mark.parametrize("size,rank", [(1, 1), (2, 2), (7, 7), (16, 5), (33, 33)])
def test_factor_and_rotations(size, rank):
    rng = np.random.default_rng(size)
    spread = rng.normal(size=(size, rank)) * np.logspace(0, -6, rank)
    matrix = spread @ spread.T
    factor = pivoted_cholesky(matrix)
    assert factor.shape == (size, rank)
    assert np.allclose(factor @ factor.T, matrix, atol=1e-14 * np.trace(matrix))
    zeros = (factor == 0).sum(axis=1)
    assert sorted(zeros, reverse=True)[:rank] == list(range(rank - 1, -1, -1))  # triangular, rows in order of pivots
    values, vectors = jacobi_columns(factor)
    assert np.allclose(vectors.T @ vectors, np.eye(rank), atol=1e-13)
    assert np.allclose(vectors * values @ vectors.T, matrix, atol=1e-13 * np.trace(matrix))
    assert (np.diff(values) <= 0).all()


def test_small_eigenvalues_keep_their_digits():
    rng = np.random.default_rng(3)
    factor = np.tril(rng.normal(size=(12, 12))) * np.logspace(0, -10, 12)
    values, _ = jacobi_columns(factor)
    assert np.allclose(np.sqrt(values), np.linalg.svd(factor, compute_uv=False), rtol=1e-9)


def test_no_spread():
    assert pivoted_cholesky(np.zeros((4, 4))).shape == (4, 0)
    values, vectors = jacobi_columns(np.zeros((4, 0)))
    assert len(values) == 0 and vectors.shape == (4, 0)


def test_deviation_is_exact_beyond_doubles():
    n, off, rest = 3_000_017, np.array([[812, -5], [1 << 20, 7]]), np.array([5, 2_999_999])
    wanted = [sum((n * int(o) - int(r)) ** 2 for o, r in zip(row, rest)) for row in off]
    assert squared_deviation(off, n, rest) == [wanted[0], None]
    assert wanted[0] > 2**53 and wanted[1] >= 2**63


def test_report_against_brute_force(spark):
    rng = np.random.default_rng(5)
    mixed = rng.normal(size=(12, 12))
    vectors = (rng.normal(size=(400, 12)) @ mixed).astype(np.float32)
    rows = [(i, [float(c) for c in v], "x") for i, v in enumerate(vectors)] + [(7, [float(c) for c in vectors[7]], "again"), (None, [float(c) for c in vectors[8]], None)]
    bad = [(900, None, "n"), (901, [None] + [1.0] * 11, "n"), (902, [float("nan")] * 12, "n"), (903, [float("inf")] + [1.0] * 11, "n"), (904, [1.0, 2.0], "short"), (905, [], "e"), (906, [1e30] + [0.0] * 11, "n")]
    frame = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<float>, vector string").repartition(5)
    found = whitening_report(frame).collect()
    kept = [r[1] for r in rows]
    n, deviation, whitened, explained = brute(kept)
    assert len(found) == 8 * len(kept)
    assert {r["vec_id"] for r in found} == {r[0] for r in rows}
    place = {r[0]: k for k, r in enumerate(rows)}  # equal ids have equal vectors here
    signs = {}
    for r in found:
        k, c = place[r["vec_id"]], r["component"] - 1
        assert (r["n"], r["deviation"]) == (n, deviation[k])
        assert r["explained"] == pytest.approx(explained[c], rel=1e-9) and 0 <= r["identity_error"] < 1e-9
        if abs(whitened[k][c]) > 1e-3:
            signs.setdefault(c, set()).add(bool(r["whitened"] * whitened[k][c] > 0))
        assert abs(r["whitened"]) == pytest.approx(abs(whitened[k][c]), rel=1e-7, abs=1e-9)
    assert all(len(s) == 1 for s in signs.values())


def test_edge_tables(spark):
    schema = "vec_id bigint, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        found = whitening_report(spark.createDataFrame(rows, schema))
        assert found.count() == 0
        assert [c for c, _ in found.dtypes] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    two = whitening_report(spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 4.0])], schema)).collect()  # one direction only
    assert sorted(abs(r["whitened"]) for r in two) == pytest.approx([1.0, 1.0]) and {r["component"] for r in two} == {1}
    assert two[0]["explained"] == pytest.approx(1.0)


def test_two_dimensions_keep_the_commoner(spark):
    rows = [(1, [1.0, 2.0]), (2, [2.0, 5.0]), (3, [0.0, 1.0]), (4, [1.0, 2.0, 3.0])]
    assert learn_whitening(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).n == 3

import numpy as np
import pytest
from conftest import rows

from kerbside.llm import whitening
from kerbside.llm.catalog import QUERIES


def brute(table, scale=256, components=4):
    """By NumPy's own decomposition of the covariance of all distinct grid vectors in memory."""
    clean = [(i, [int(np.floor(scale * float(c))) for c in v]) for i, v in table if v and all(c is not None and np.isfinite(c) for c in v)]
    sizes = [len(x) for x in {tuple(x) for _, x in clean}]
    if not sizes:
        return []
    size = max(set(sizes), key=lambda s: (sizes.count(s), s))
    clean = [(i, x) for i, x in clean if len(x) == size]
    fitted = [list(x) for x in {tuple(x) for _, x in clean}]
    n, sums = len(fitted), [sum(x[k] for x in fitted) for k in range(size)]
    centred = (np.array(fitted, object) * n - np.array(sums, object)).astype(float) / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    order = [k for k in np.argsort(-values)[:components] if values[k] > 1e-12 * np.trace(covariance)]
    out = []
    for i, x in clean:
        y = np.array([n * c - s for c, s in zip(x, sums, strict=True)], object)
        for number, k in enumerate(order, 1):
            v = vectors[:, k] * np.sign(vectors[np.argmax(np.abs(vectors[:, k])), k])
            out.append((i, number, n, int((y * y).sum()), float(y.astype(float) / n @ v / np.sqrt(values[k])), values[k] / np.trace(covariance)))
    return out


def agree(got, want, tolerance=1e-9):
    got, want = sorted(got, key=lambda r: (str(r[0]), r[1], r[3], r[4])), sorted(want, key=lambda r: (str(r[0]), r[1], r[3], r[4]))
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert np.allclose([r[4:6] for r in got], [r[4:] for r in want], rtol=tolerance, atol=tolerance)
    assert all(r[6] < 1e-10 for r in got)


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.01"
    out = QUERIES["op11_whitening"](spark, sf_dir)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    table = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    agree([tuple(r) for r in out.collect()], brute(table), 1e-8)


def test_bad_rows_ties_and_clashing_names(spark):
    rng = np.random.default_rng(11)
    good = [(i, [float(c) for c in rng.normal(size=5) * [5, 3, 2, 1, 0.5]]) for i in range(200)]
    table = good + [good[0]] * 90 + [(None, good[3][1]), (7, [9.0, -9.0, 300.0, 0.0, 1e4])]
    bad = [(500, None), (501, []), (502, [1.0, None, 1.0, 1.0, 1.0]), (503, [float("nan")] * 5), (504, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (505, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, i, "a") for i, v in table + bad], "key long, vector array<double>, vec_id long, n string").repartition(5)
    agree(rows(whitening.whitened(df, vector="vector", vec_id="key")), brute(table))


def test_few_distinct_vectors_and_no_rows(spark):
    schema = "vec_id string, embedding array<float>"
    line = spark.createDataFrame([("a", [1.0, 2.0, 3.0]), ("b", [2.0, 4.0, 6.0]), ("b", [2.0, 4.0, 6.0]), ("c", [4.0, 8.0, 12.0])], schema)
    got = rows(whitening.whitened(line))
    assert [(r[0], r[1], r[2]) for r in got] == [("a", 1, 3), ("b", 1, 3), ("b", 1, 3), ("c", 1, 3)]  # variance in one direction only
    assert all(r[5] == pytest.approx(1) for r in got)
    assert whitening.whitened(line.limit(1)).count() == 0
    assert whitening.whitened(line.limit(0)).count() == 0
    assert rows(whitening.whitened(spark.createDataFrame([("a", [1.0]), ("b", [3.0])], schema)))[0][4] == -1.0


def test_deviation_is_exact_or_null():
    model = whitening.Fit(3, [10**9, -1], np.ones(1), np.ones((1, 2)), 1.0)
    assert whitening.deviations(np.array([[10**9, 1]]), model) == [4 * 10**18 + 16]
    assert whitening.deviations(np.array([[10**10, 1]]), model) == [None]


def test_eigenpairs_against_numpy():
    rng = np.random.default_rng(0)
    for size, spectrum in [(1, [3]), (2, [3, 1]), (6, [5, 5, 5, 1, 1, 0]), (40, list(range(40))), (30, [1 + 1e-9 * k for k in range(30)]), (5, [0] * 5)]:
        basis = np.linalg.qr(rng.normal(size=(size, size)))[0]
        matrix = basis @ np.diag(np.array(spectrum, float)) @ basis.T
        values, vectors = whitening.leading_eigenpairs((matrix + matrix.T) / 2, size)
        assert np.allclose(values, sorted(spectrum, reverse=True), atol=1e-13 * max(1, *spectrum) if size > 1 else 1e-13)
        assert np.allclose(vectors @ vectors.T, np.eye(size), atol=1e-12)
        assert np.allclose(vectors @ matrix, values[:, None] * vectors, atol=1e-12 * max(1, *spectrum) if size > 1 else 1e-12)


def test_sturm_counts():
    rng = np.random.default_rng(5)
    diagonal, off = rng.normal(size=12), rng.normal(size=11)
    off[4] = 0  # falls apart into two blocks
    values = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1))
    for bound in np.linspace(-4, 4, 33):
        assert whitening.sturm_count(diagonal, off, bound) == (values < bound).sum()


def test_fit_does_not_depend_on_partitions(spark):
    embeddings = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    models = [whitening.fit(whitening.distinct_vectors(embeddings.repartition(p)), 4) for p in (1, 7)]
    assert np.array_equal(models[0].components, models[1].components)
    assert models[0].sums == models[1].sums

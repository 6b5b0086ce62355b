"""Whitening against a dense eigendecomposition."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from contrail.llm import queries, whitening

SMALL = "/root/testdata/sf0.01"


def plain(x, count):
    n, sums = len(x), x.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(x.T.astype(float), bias=True))
    values, vectors = values[::-1][:count], vectors[:, ::-1][:, :count]
    return ((n * x - sums) / n) @ vectors / np.sqrt(values), values, ((n * x - sums) ** 2).sum(axis=1)


def rows_of(x):
    return [(i, [float(v) for v in row], 1, "z") for i, row in enumerate(x)]


SCHEMA = "id int, v array<double>, n int, x string"


@pytest.fixture(scope="module")
def found(spark):
    return queries.op12_embedding_whitening(spark, SMALL).toPandas().sort_values(["vec_id", "component"])


def test_registered_query_like_a_dense_one(spark, found):
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet").orderBy("vec_id").toPandas()
    x = np.floor(64 * np.stack(vectors["embedding"]).astype(float)).astype(np.int64) + 1_000_000
    z, values, deviation = plain(x, 32)
    ours = found["whitened"].to_numpy().reshape(len(x), 32)
    sign = np.sign((ours * z).sum(axis=0))
    assert np.abs(ours * sign - z).max() < 1e-9
    assert (found["deviation"].to_numpy().reshape(len(x), 32) == deviation[:, None]).all()
    trace = np.cov(x.T.astype(float), bias=True).trace()
    assert np.allclose(found["explained"].to_numpy()[:32], values / trace, rtol=1e-10)
    assert found["identity_error"].nunique() == 1 and found["identity_error"].iloc[0] < 1e-9
    assert (found["n"] == len(x)).all() and list(found["component"][:32]) == list(range(1, 33))


def test_passes_do_not_form_the_covariance_and_are_certified(spark):
    x = np.random.default_rng(3).integers(-900, 900, (400, 30)) * np.arange(1, 31)
    rows = whitening.packed(spark.createDataFrame([(i, [int(v) for v in r]) for i, r in enumerate(x)],
                                                  "id int, x array<long>")).cache()
    at = whitening.moments(rows)
    assert at.n == 400 and at.sums == tuple(int(v) for v in x.sum(axis=0))
    block = np.random.default_rng(4).standard_normal((30, 3))
    assert np.allclose(whitening.covariance_times(rows, at, block), np.cov(x.T.astype(float), bias=True) @ block)
    best = whitening.leading_components(rows, at, 5)
    values = np.linalg.eigvalsh(np.cov(x.T.astype(float), bias=True))[::-1]
    assert np.allclose(best.values, values[:5], rtol=1e-12) and best.residuals.max() <= 2e-12 * best.trace
    # Without room beside the wanted ones it still gets there.
    tight = whitening.leading_components(rows, at, 5, guard=0, degree=4)
    assert np.allclose(tight.values, values[:5], rtol=1e-12)
    rows.unpersist()


def test_odd_vectors(spark):
    good = np.random.default_rng(5).standard_normal((40, 3))
    odd = [(100, None, 1, "z"), (101, [], 1, "z"), (102, [1.0, None, 2.0], 1, "z"), (103, [1.0, float("nan"), 0.0], 1, "z"),
           (104, [float("inf"), 0.0, 0.0], 1, "z"), (105, [1.0, 2.0], 1, "z"), (106, [1e300, 0.0, 0.0], 1, "z")]
    again = [(None, *rows_of(good)[0][1:]), rows_of(good)[1]]
    df = spark.createDataFrame(rows_of(good) + odd + again, SCHEMA)
    out = whitening.whiten(df, "id", "v", 32).toPandas()
    x = np.floor(64 * np.vstack([good, good[:2]])).astype(np.int64) + 1_000_000
    z, _, _ = plain(x, 3)
    assert len(out) == 42 * 3 and out["id"].isna().sum() == 3 and (out["n"] == 42).all()
    first = out[out["id"] == 7].sort_values("component")["whitened"].to_numpy()
    assert np.allclose(np.abs(first), np.abs(z[7]), atol=1e-9)


def test_no_variance_no_components(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0], 1, "z")], SCHEMA)
    assert whitening.whiten(one, "id", "v").count() == 0
    assert whitening.whiten(one.unionByName(one), "id", "v").count() == 0
    assert whitening.whiten(one.limit(0), "id", "v").count() == 0
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0], 1, "z") for i in range(9)], SCHEMA)
    assert whitening.whiten(flat, "id", "v").agg(F.max("component")).first()[0] == 1  # of rank one


def test_numbers_beyond_64_bits_stay_exact():
    at = whitening.Moments(3, (2 ** 61 * 3, 3))
    deviations = whitening._deviations(np.array([[2 ** 61 + 2, 0], [2 ** 61, 3]]), at)
    assert [[int(v) for v in r] for r in deviations] == [[6, -3], [0, 6]]
    assert whitening._squares(np.array([[2 ** 40, 3]])) == [2 ** 80 + 9]

"""Logistic regression behind a linear map: the same optimum as Spark's, on short rows."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from turnfold.operators import linear as LI
from turnfold.operators import models as MD
from turnfold.operators import transform as TR
from turnfold.plans import catalogue


def frame(spark, n=3000, width=12, seed=1, label=None):
    rng = np.random.default_rng(seed)
    x = rng.normal(1e3, 5.0, (n, width)) * (rng.random((n, width)) < 0.3)
    y = (x[:, 0] + x[:, 1] - x[:, 2] > rng.normal(300, 400, n)).astype(float)
    rows = [(i, float(y[i]) if label is None else label, Vectors.sparse(width, [(int(j), float(x[i, j])) for j in np.flatnonzero(x[i])]))
            for i in range(n)]
    return spark.createDataFrame(rows, ["key", "label", "features"])


def test_same_optimum_as_the_dense_learner(spark):
    df = frame(spark)
    sc = TR.fit_exact_scaler(df, "features", "scaled")
    pca = TR.fit_pca(sc.transform(df), "scaled", 9, output_col="pca")
    lr = MD.logistic(df.count(), features_col="pca", tol=1e-9)
    mapped = pca.transform(sc.transform(df)).persist()
    want = lr.fit(mapped)
    got = LI.fit_on_map(lr, df, LI.LinearMap.of(sc, pca))
    assert got.coefficients == pytest.approx(want.coefficients.toArray(), abs=1e-4)
    assert got.intercept == pytest.approx(want.intercept, abs=1e-4)
    a = {r["key"]: (r["lr_probability"][1], r["lr_prediction"]) for r in want.transform(mapped).collect()}
    b = {r["key"]: (r["lr_probability"][1], r["lr_prediction"]) for r in got.transform(mapped).collect()}
    mapped.unpersist()
    assert all(a[k][0] == pytest.approx(b[k][0], abs=1e-4) for k in a)
    assert sum(a[k][1] != b[k][1] for k in a) < 3


def test_packed_rows_hold_what_is_not_zero(spark):
    df = frame(spark, n=500)
    got = LI.packed_rows(df, "features", "label").toArrow()
    x = np.concatenate([LI.unpacked(b.slice(lo, 7), 12) for b in got.to_batches() for lo in range(0, b.num_rows, 7)])
    want = np.array([r["features"].toArray() for r in df.collect()])
    order = lambda m: m[np.lexsort(m.T)]
    assert (order(x) == order(want)).all()
    assert sum(len(v) for v in got["numbers"].to_pylist()) == 8 * np.count_nonzero(want)


def test_one_label_and_null_labels(spark):
    df = frame(spark, n=50, label=1.0)
    sc = TR.fit_exact_scaler(df, "features", "scaled")
    pca = TR.fit_pca(sc.transform(df), "scaled", 3, output_col="pca")
    got = LI.fit_on_map(MD.logistic(50, features_col="pca"), df, LI.LinearMap.of(sc, pca))
    assert {r["lr_probability"][1] for r in got.transform(pca.transform(sc.transform(df))).collect()} == {1.0}
    with pytest.raises(ValueError):
        LI.fit_on_map(MD.logistic(50, features_col="pca"), df.selectExpr("key", "CAST(NULL AS DOUBLE) AS label", "features"),
                      LI.LinearMap.of(sc, pca))


def test_linear_query_keeps_no_rows_in_executors(spark, monkeypatch):
    """The solver's rows are read from the shared folder: nothing is persisted
    while it runs, neither the vectors nor 200 components a row."""
    kept, sums = [], LI.loss_sums

    def watched(*args):
        kept.append(len(spark.sparkContext._jsc.getPersistentRDDs()))
        return sums(*args)

    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    monkeypatch.setattr(LI, "loss_sums", watched)
    out = catalogue.QUERIES["orders_linear_scores"](spark, "/root/testdata/sf0.001")
    assert out.count() and kept and max(kept) <= before

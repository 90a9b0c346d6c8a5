"""Exact scaler, PCA tables, split, learners and the vote."""

import threading

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from turnfold.operators import flattrees as FL
from turnfold.operators import histtrees as HT
from turnfold.operators import models as MD
from turnfold.operators import split as SP
from turnfold.operators import transform as TR


def _matrix(spark, X, y=None):
    rows = [(i, float(y[i]) if y is not None else 0.0, [float(v) for v in X[i]])
            for i in range(len(X))]
    df = spark.createDataFrame(rows, "id int, label double, x array<double>")
    return df.select("id", "label", array_to_vector("x").alias("features"))


def test_exact_scaler_population_sd_and_constant_column(spark):
    X = np.array([[1.0, 5.0, 2.0], [2.0, 5.0, 4.0], [3.0, 5.0, 9.0], [6.0, 5.0, 1.0]])
    df = _matrix(spark, X)
    m = TR.fit_exact_scaler(df, "features", "z")
    got = np.array([r.z for r in m.transform(df).select(vector_to_array("z").alias("z"))
                    .orderBy(F.lit(1)).collect()])
    sd = X.std(axis=0)
    want = (X - X.mean(axis=0)) / np.where(sd > 0, sd, 1.0)
    assert np.allclose(np.sort(got, axis=0), np.sort(want, axis=0))
    new = _matrix(spark, np.array([[0.0, 7.0, 0.0]]))
    z = m.transform(new).select(vector_to_array("z")).first()[0]
    assert z[1] == pytest.approx(7.0 - 5.0)          # constant column: v - mean


def test_pca_ratio_and_tables(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(80, 6)) @ rng.normal(size=(6, 6))
    df = _matrix(spark, X)
    z = TR.fit_exact_scaler(df, "features", "z").transform(df)
    m = TR.fit_pca(z, "z", 6)
    ratio = np.array([r.ratio for r in TR.variance_table(spark, m).collect()])
    assert ratio.sum() == pytest.approx(1.0)
    Xs = (X - X.mean(0)) / X.std(0)
    ev = np.sort(np.linalg.eigvalsh(np.cov(Xs.T)))[::-1]
    assert ratio == pytest.approx(ev / ev.sum(), rel=1e-6)
    assert TR.fit_pca(z, "z", 50).getK() == 6         # clamped to the column count
    names = [f"f{i}" for i in range(6)]
    assert TR.top_contributors(spark, m, names, top=3).count() > 0


def test_logistic_matches_newton(spark):
    rng = np.random.default_rng(1)
    X = rng.normal(size=(200, 3))
    y = (X @ np.array([1.5, -2.0, 0.5]) + rng.normal(size=200) > 0).astype(float)
    df = _matrix(spark, X, y)
    m = MD.logistic(len(y), C=1.0).fit(df)
    # Newton solve of 0.5*||w||^2 + C*sum(logloss), intercept unpenalised
    A = np.hstack([X, np.ones((200, 1))])
    w = np.zeros(4)
    for _ in range(50):
        p = 1 / (1 + np.exp(-A @ w))
        g = A.T @ (p - y) + np.r_[w[:3], 0.0]
        H = A.T @ (A * (p * (1 - p))[:, None]) + np.diag([1, 1, 1, 0.0])
        w -= np.linalg.solve(H, g)
    assert np.allclose(m.coefficients.toArray(), w[:3], atol=1e-5)
    assert m.intercept == pytest.approx(w[3], abs=1e-5)


def test_splits(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    ex = SP.exact_split(df, ["k"], 0.15)
    assert ex.where("is_test").count() == 150
    hs = SP.hash_split(df, ["k"], 0.15)
    assert 90 < hs.where("is_test").count() < 210
    assert SP.hash_split(df, ["k"], 0.0).where("is_test").count() == 0
    assert SP.top_feature_indices([0.1, 0.5, 0.5, 0.0], 3) == [1, 2, 0]
    assert SP.top_feature_indices([0.1, 0.2], 10) == [1, 0]


def test_soft_vote_is_member_mean(spark):
    rng = np.random.default_rng(2)
    X = rng.normal(size=(150, 4))
    y = (X[:, 0] + X[:, 1] > 0).astype(float)
    df = _matrix(spark, X, y)
    vote = MD.fit_soft_vote(df, [("rf", MD.random_forest(num_trees=5, max_depth=3)),
                                 ("gbt", MD.gbt(max_iter=3)),
                                 ("et", MD.RandomCutForest(num_trees=4, groups=2, prefix="et"))],
                            threshold=0.45)
    out = vote.transform(df).collect()
    for r in out:
        assert 0.0 <= r.probability <= 1.0
        assert r.probability == pytest.approx((r.rf_p1 + r.gbt_p1 + r.et_p1) / 3)
        assert r.prediction == int(r.probability >= 0.45)


def test_boosting_lowers_the_loss_round_by_round(spark):
    """Each round lowers the training log-loss from that of the prior; leaf
    values of the first tree are -G/(H+lambda) of the rows reaching them."""
    rng = np.random.default_rng(5)
    X = rng.normal(size=(300, 4))
    y = (X[:, 0] - X[:, 2] + 0.3 * rng.normal(size=300) > 0.4).astype(float)
    df = _matrix(spark, X, y)
    own = HT.Criterion(alpha=0.0, lam=1.0, gamma=0.0, min_child_weight=1.0)
    m = HT.HistogramBooster(3, max_depth=3, eta=0.3, subsample=1.0, criterion=own).fit(df)
    p0 = y.mean()
    assert m.base == pytest.approx(np.log(p0 / (1 - p0)))
    losses = []
    for k in range(4):
        sub = FL.FlatModel(m.trees.part(0, k), m.width, m.base)
        p = np.array([r.xgb_p1 for r in sub.transform(df).orderBy("id").collect()])
        losses.append(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))
    assert losses[0] == pytest.approx(-(p0 * np.log(p0) + (1 - p0) * np.log(1 - p0)))
    assert losses[3] < losses[2] < losses[1] < losses[0]
    one = m.trees.part(0, 1)
    g, h = p0 - y, np.full(300, p0 * (1 - p0))
    leaf_of = one.leaves(X)[:, 0]
    for k in np.unique(leaf_of):
        sel = leaf_of == k
        assert one.value[k] == pytest.approx(-0.3 * g[sel].sum() / (h[sel].sum() + 1.0))


def test_drop_constant_keeps_pca(spark):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(60, 5))
    X[:, 1] = 4.0
    X[:, 3] = 0.0
    df = _matrix(spark, X)
    slicer, kept = TR.fit_drop_constant(df, "features", "v")
    assert kept == [0, 2, 4]
    full = TR.fit_exact_scaler(df, "features", "z").transform(df)
    red = slicer.transform(df)
    red = TR.fit_exact_scaler(red, "v", "z").transform(red)
    r1 = np.array([r.ratio for r in TR.variance_table(spark, TR.fit_pca(full, "z", 3)).collect()])
    r2 = np.array([r.ratio for r in TR.variance_table(spark, TR.fit_pca(red, "z", 3)).collect()])
    assert r1 == pytest.approx(r2)


def test_a_forest_in_parts_grows_all_trees_side_by_side(spark, monkeypatch):
    rng = np.random.default_rng(4)
    X = rng.normal(size=(120, 4))
    df = _matrix(spark, X, (X[:, 0] > 0).astype(float))
    waiting = threading.Barrier(3, timeout=60)  # each fit waits until three have begun
    fit = MD.RandomForestClassifier._fit

    def met(self, data):
        waiting.wait()
        return fit(self, data)

    monkeypatch.setattr(MD.RandomForestClassifier, "_fit", met)
    m = MD.fit_forest_parts(df, num_trees=7, parts=3, max_depth=4, min_instances=2)
    assert [x.getNumTrees for x in m.models] == [3, 2, 2]
    voices = [t.transform(df).select("id", vector_to_array("rf_probability")[1].alias("p")).toPandas().set_index("id").p
              for x in m.models for t in x.trees]
    got = m.transform(df)
    assert got.columns == [*df.columns, "rf_p1"]
    got = got.toPandas().set_index("id").rf_p1
    assert np.allclose(got, sum(voices) / 7)
    assert len({t.toDebugString for x in m.models for t in x.trees}) == 7


def test_forest_parts_leave_the_driver_when_trees_are_large(spark, monkeypatch):
    """Beyond ``HELD_NODES`` parts are saved as they are grown, few at a time; they vote like the held ones."""
    from pyspark.ml.classification import RandomForestClassificationModel
    from pyspark.ml.linalg import Vectors
    rows = [(i % 150, float(i % 7 < 3), Vectors.dense([float(i % 7), float(i % 11), float(i % 5)])) for i in range(200)]
    df = spark.createDataFrame(rows, ["id", "label", "features"])
    monkeypatch.setattr(MD, "HELD_NODES", 70)  # two trees of at most 31 nodes
    m = MD.fit_forest_parts(df, num_trees=5, parts=12, max_depth=4, min_instances=2)
    assert all(isinstance(p, str) for p in m.models) and sum(m.trees) == 5 and m.at_once * max(m.trees) * 32 <= 70
    got = sorted((r["id"], tuple(r["features"]), r["rf_p1"]) for r in m.transform(df).collect())
    held = MD.ForestPartsModel([RandomForestClassificationModel.load(p) for p in m.models])
    want = sorted((r["id"], tuple(r["features"]), r["rf_p1"]) for r in held.transform(df).collect())
    assert len(got) == 200 and [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want])

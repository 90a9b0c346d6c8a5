"""Train, save, load, score, diff and stream over generated match logs."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from matchlogs import random_matches, write_jsonl
from turnfold.plans import jobs as J
from turnfold.session import scratch_path
from turnfold.sources import sinks as SK
from turnfold.streaming import scoring_stream as ST


@pytest.fixture(scope="module")
def logs(tmp_path_factory):
    d = tmp_path_factory.mktemp("matches")
    train = write_jsonl(str(d / "train" / "part0.jsonl"), random_matches(300, seed=1))
    test = write_jsonl(str(d / "test" / "part0.jsonl"), random_matches(80, seed=2, start_id=1000))
    return os.path.dirname(train), os.path.dirname(test)


def test_linear_train_and_score(spark, logs):
    train, test = logs
    root = scratch_path(spark, "models")
    r1 = J.train_linear(spark, train, n_components=20, max_iter=100, models_root=root)
    r2 = J.train_linear(spark, train, n_components=20, max_iter=100, test_size=0.2, models_root=root)
    assert (r1.run, r2.run) == (1, 2) and r2.n_test > 0
    assert 0.5 <= r1.train_accuracy <= 1.0
    out1 = scratch_path(spark, "pred")
    info1 = J.score_linear(spark, test, root, out1)
    assert info1["rows"] == 80 and info1["run"] == 2
    out2 = scratch_path(spark, "pred")
    info2 = J.score_linear(spark, test, root, out2, threshold=0.3, previous_csv=out1)
    assert info2["compared"] == 80 and 0.0 <= info2["diff_pct"] <= 100.0
    preds = SK.read_predictions(spark, out2)
    assert preds.count() == 80 and set(r.player_won for r in preds.collect()) <= {0, 1}
    runs = SK.read_runs(spark, root).where(F.col("prefix") == "model").select("run").distinct()
    assert sorted(r.run for r in runs.collect()) == [1, 2]


def test_streaming_scoring(spark, logs):
    train, test = logs
    root = scratch_path(spark, "models")
    J.train_linear(spark, train, n_components=10, max_iter=50, models_root=root)
    _, model = SK.load_latest(spark, root)
    out = scratch_path(spark, "stream-out")
    q = ST.start_scoring(spark, test, model, out, once=True)
    q.awaitTermination(120)
    rows = spark.read.option("header", True).csv(out + "/batch=*").count()
    assert rows == 80


def test_ensemble_train_save_score(spark, logs):
    train, test = logs
    root = scratch_path(spark, "ens")
    res = J.train_ensemble(spark, train, n_top_features=40, num_trees=8, gbt_rounds=5,
                           xgb_rounds=5, models_root=root)
    assert res.n_test > 0 and 0.0 <= res.test_accuracy <= 1.0
    assert 0.5 <= res.train_accuracy <= 1.0 and res.run == 1
    out = scratch_path(spark, "ens-pred")
    info = J.score_ensemble(spark, test, root, out)
    assert info["rows"] == 80 and info["run"] == 1
    # the loaded vote reproduces the in-memory one
    prep, vote = res.model
    feats, _ = J.match_feature_table(spark, test, is_train=False)
    a = {r.battle_id: r.probability for r in vote.transform(prep.transform(feats)).collect()}
    b = {r.battle_id: r.player_won for r in SK.read_predictions(spark, out).collect()}
    assert {int(k): int(v >= vote.threshold) for k, v in a.items()} == {int(k): v for k, v in b.items()}

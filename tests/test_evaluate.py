"""Evaluation tables against hand values and numpy brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnfold.operators import evaluate as EV
from turnfold.operators import scoring as SC


def _df(spark, ys, ps):
    return spark.createDataFrame(list(zip(ys, ps)), "y int, p double")


def test_average_precision_and_auc(spark):
    df = _df(spark, [1, 0, 1], [0.9, 0.8, 0.7])
    assert EV.average_precision(df, "y", "p").first()[0] == pytest.approx(0.8333333333)
    assert EV.roc_auc(df, "y", "p").first()[0] == pytest.approx(0.5)


def test_threshold_tie_predicts_positive(spark):
    df = spark.createDataFrame([(0.485,)], "p double")
    assert df.select(EV.predict_at(F.col("p"), 0.485)).first()[0] == 1


def test_histogram_matches_numpy(spark):
    rnd = random.Random(1)
    ys = [rnd.randint(0, 1) for _ in range(600)]
    ps = [round(rnd.random(), 3) for _ in range(600)]
    out = EV.score_histogram(_df(spark, ys, ps), "y", "p").collect()
    for cls in (0, 1):
        vals = np.array([p for y, p in zip(ys, ps) if y == cls])
        counts, edges = np.histogram(vals, bins=50)
        dens, _ = np.histogram(vals, bins=50, density=True)
        got = {r.bin: r for r in out if r.y == cls}
        for b in range(50):
            if counts[b]:
                assert got[b]["count"] == counts[b]
                assert got[b].density == pytest.approx(dens[b])
            else:
                assert got[b]["count"] == 0 and got[b].density == 0.0
    top = max(p for y, p in zip(ys, ps) if y == 1)
    assert max(r.bin for r in out if r.y == 1) == 49 and top > 0


def test_sweep_and_best_against_brute_force(spark):
    rnd = random.Random(2)
    ys = [rnd.randint(0, 1) for _ in range(300)]
    ps = [rnd.randint(0, 100) / 100.0 for _ in range(300)]
    sweep = {r.i: r for r in EV.threshold_sweep(_df(spark, ys, ps), "y", "p").collect()}
    y, p = np.array(ys), np.array(ps)
    grid = np.linspace(0, 1, 100)
    accs = []
    for i, t in enumerate(grid):
        yh = (p >= t).astype(int)
        tp = int(((y == 1) & (yh == 1)).sum()); fp = int(((y == 0) & (yh == 1)).sum())
        fn = int(((y == 1) & (yh == 0)).sum())
        acc = float((y == yh).mean())
        prec = tp / (tp + fp) if tp + fp else 0.0
        rec = tp / (tp + fn) if tp + fn else 0.0
        accs.append(acc)
        assert sweep[i].accuracy == pytest.approx(acc)
        assert sweep[i].precision == pytest.approx(prec)
        assert sweep[i].recall == pytest.approx(rec)
    best = EV.best_threshold(EV.threshold_sweep(_df(spark, ys, ps), "y", "p")).first()
    assert best.threshold == pytest.approx(grid[int(np.argmax(accs))])
    assert sweep[0].recall == 1.0


def test_roc_points_brute_force(spark):
    rnd = random.Random(4)
    ys = [rnd.randint(0, 1) for _ in range(200)]
    ps = [rnd.randint(0, 20) / 20.0 for _ in range(200)]
    pts = EV.roc_points(_df(spark, ys, ps), "y", "p", drop_intermediate=False).collect()
    P, N = sum(ys), len(ys) - sum(ys)
    want = [(float("inf"), 0.0, 0.0)]
    for t in sorted(set(ps), reverse=True):
        tp = sum(1 for y, p in zip(ys, ps) if p >= t and y == 1)
        fp = sum(1 for y, p in zip(ys, ps) if p >= t and y == 0)
        want.append((t, fp / N, tp / P))
    got = sorted(((r.threshold, r.fpr, r.tpr) for r in pts), key=lambda x: -x[0])
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[0] == w[0] and g[1] == pytest.approx(w[1]) and g[2] == pytest.approx(w[2])
    fpr = [w[1] for w in want]; tpr = [w[2] for w in want]
    auc = EV.roc_auc(_df(spark, ys, ps), "y", "p").first()[0]
    assert auc == pytest.approx(np.trapezoid(tpr, fpr))


def test_confusion_grid_and_accuracy(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 0)], "y int, yhat int")
    rows = {(r.y, r.yhat): r for r in EV.confusion_matrix(df, "y", "yhat").collect()}
    assert len(rows) == 4 and rows[(1, 1)].n == 2 and rows[(0, 0)].row_pct is None
    acc = EV.accuracy(df, "y", "yhat").first()
    assert acc.accuracy == pytest.approx(2 / 3)


def test_run_diff(spark):
    prev = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "battle_id int, player_won int")
    cur = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "battle_id int, player_won int")
    r = SC.prediction_diff(prev, cur).first()
    assert r.compared == 3 and r.diff_pct == pytest.approx(33.3333333)
    none = spark.createDataFrame([(9, 1)], "battle_id int, player_won int")
    assert SC.prediction_diff(prev, none).first().diff_pct is None


def test_evaluation_suite_tables(spark):
    rnd = random.Random(9)
    tr = _df(spark, [rnd.randint(0, 1) for _ in range(120)], [rnd.randint(0, 50) / 50 for _ in range(120)])
    te = _df(spark, [rnd.randint(0, 1) for _ in range(40)], [rnd.randint(0, 50) / 50 for _ in range(40)])
    out = EV.evaluation_suite(tr, te, "y", "p", 0.45)
    assert set(out) == {f"{s}/{m}" for s in ("train", "test") for m in
                        ("confusion", "roc", "pr", "histogram")} | {"train/sweep"}
    assert out["test/confusion"].agg(F.sum("n")).first()[0] == 40
    assert out["train/sweep"].count() == 100
    only_train = EV.evaluation_suite(tr, None, "y", "p", 0.45)
    assert not any(k.startswith("test/") for k in only_train)


def test_scale_conf():
    from turnfold.session import scale_conf
    c = scale_conf(100 * 1024 ** 4, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert scale_conf(1024, 8)["spark.sql.shuffle.partitions"] == "16"

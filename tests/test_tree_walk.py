"""Walking trees by flat look-ups: the same nodes as row by row."""

import numpy as np
import pytest

from turnfold.operators import histtrees
from turnfold.operators.flattrees import FlatTrees
from turnfold.operators.histtrees import walk
from turnfold.plans import catalogue


def some_tree(rng, width, splits):
    """Feature, cut and left child of each node; the right child is next to it."""
    feature, cut, child, leaves = [-1], [0.0], [0], [0]
    for _ in range(splits):
        node = leaves.pop(rng.integers(len(leaves)))
        feature[node], cut[node], child[node] = int(rng.integers(width)), float(rng.random()), len(feature)
        leaves += [len(feature), len(feature) + 1]
        feature += [-1, -1]
        cut += [0.0, 0.0]
        child += [0, 0]
    return feature, cut, child


def node_of(x, feature, cut, child):
    at = 0
    while feature[at] >= 0:
        at = child[at] + (0 if x[feature[at]] <= cut[at] else 1)
    return at


@pytest.mark.parametrize("splits", [0, 1, 40])
def test_walks_agree_with_single_rows(splits):
    rng = np.random.default_rng(splits)
    x = rng.random((200, 5))
    x[rng.random(x.shape) < 0.1] = np.nan
    trees = [some_tree(rng, 5, splits) for _ in range(3)]
    flat = FlatTrees()
    for feature, cut, child in trees:
        want = [node_of(row, feature, cut, child) for row in x]
        assert walk(x.T.copy(), np.array(feature), np.array(cut), np.array(child)).tolist() == want
        assert walk(x.T, np.array(feature), np.array(cut), np.array(child)).tolist() == want
        flat.add([{"feature": f, "threshold": c, "left": k, "right": k + 1, "value": 0.0, "gain": 0.0, "weight": 0.0}
                  for f, c, k in zip(feature, cut, child, strict=True)])
    got = flat.leaves(x) - np.array(flat.first)
    assert got.T.tolist() == [[node_of(row, *t) for row in x] for t in trees]


def test_ensemble_joins_its_vectors_once(spark, monkeypatch):
    """Scoring reads the written vectors: no join of orders, lines and parts in its plan."""
    class Small:
        def __init__(self, est):
            self.est = est

        def fit(self, df):
            for name, n in (("num_trees", 2), ("rounds", 2)):
                if hasattr(self.est, name):
                    setattr(self.est, name, n)
            return (self.est.setNumTrees(2) if hasattr(self.est, "setNumTrees") else self.est).fit(df)

    whole = catalogue.MD.fit_soft_vote
    monkeypatch.setattr(catalogue.MD, "fit_soft_vote", lambda df, members, **kw: whole(df, [(n, Small(e)) for n, e in members], **kw))
    out = catalogue.QUERIES["orders_ensemble_scores"](spark, "/root/testdata/sf0.001")
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.count() == spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()


def test_tasks_do_not_grow_with_small_parts(spark):
    """What a pass sends grows with its tasks: two a core until each has much to read."""
    cores = spark.sparkContext.defaultParallelism
    assert histtrees.task_count(spark, 1, 4 << 20) == 1
    assert histtrees.task_count(spark, 1 << 30, 4 << 20) == max(2 * cores, 16)
    assert histtrees.task_count(spark, 64 << 30, 4 << 20) == max(2 * cores, 1024)

"""Exact places by digit counts."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnfold.functions import selection as SEL
from turnfold.operators import split as SP


def longs(spark, values, parts=3):
    return spark.createDataFrame([(None if v is None else int(v),) for v in values], "v long").repartition(parts)


@pytest.mark.parametrize("few", [4096, 1])
def test_values_at_equal_a_sort(spark, few, monkeypatch):
    monkeypatch.setattr(SEL, "FEW", few)
    rng = np.random.default_rng(3)
    for values in (rng.integers(-2**63, 2**63 - 1, 300), rng.integers(-5, 5, 200), np.full(40, 7),
                   np.array([-2**63, 2**63 - 1, 0, -1, 1] * 3), rng.integers(0, 2**40, 100)):
        df, want = longs(spark, values), np.sort(values)
        places = [0, 1, len(values) // 3, len(values) - 1]
        for p, (u, below, equal) in zip(places, SEL.values_at(df, F.col("v"), places), strict=True):
            assert u - 2**63 == want[p]
            assert below == int((values < want[p]).sum())
            assert few > 1 or equal == int((values == want[p]).sum())


def test_split_and_folds_are_exact_with_ties_and_repeats(spark):
    rows = [(i % 7, f"k{i % 3}", i % 2) for i in range(103)] + [(None, None, 1)] * 5
    df = spark.createDataFrame(rows, "a long, b string, c int").repartition(4)
    for share in (0.0, 0.15, 0.5, 0.99, 1.0):
        out = SP.exact_split(df, ["a", "b"], share, hash_col=F.lit(3))
        assert out.where("is_test").count() == int(np.ceil(108 * share))
        assert out.count() == 108
    folds = collections.Counter(r.fold for r in SP.exact_folds(df, ["a", "b"], 5).collect())
    assert sorted(folds.values()) == [21, 21, 22, 22, 22] and [folds[i] for i in range(3)] == [22, 22, 22]
    assert SP.exact_folds(df.limit(0), ["a"], 3).count() == 0


def test_no_record_is_moved(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    for out in (SP.exact_split(df, ["k"], 0.15), SP.exact_folds(df, ["k"], 5)):
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()

"""Train/test split and importance-based feature selection."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorSlicer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import selection as SEL

SPLIT_SEED = 42
_SCALE = 1_000_000


def key_hash(key_cols: Sequence[str | Column], seed: int = SPLIT_SEED) -> Column:
    cs = [F.col(c) if isinstance(c, str) else c for c in key_cols]
    return F.xxhash64(F.lit(seed), *cs)


def hash_split(df: DataFrame, key_cols: Sequence[str | Column], test_fraction: float,
               seed: int = SPLIT_SEED, hash_col: Column | None = None,
               scale: int = _SCALE) -> DataFrame:
    """``is_test`` from a seeded hash of the key -- a narrow
    projection, no shuffle, stable under retries and repartitioning; the
    test share is approximately ``test_fraction``.  ``test_fraction = 0``
    is the no-split mode (no test rows)."""
    h = hash_col if hash_col is not None else key_hash(key_cols, seed)
    cut = int(round(test_fraction * scale))
    return df.withColumn("is_test", F.pmod(h, F.lit(scale)) < F.lit(cut))


def exact_split(df: DataFrame, key_cols: Sequence[str], test_fraction: float,
                seed: int = SPLIT_SEED, hash_col: Column | None = None) -> DataFrame:
    """G1 with the exact test size ``ceil(n * p)``: the rows with the
    smallest (hash, key) are the test part.  The last of them is found by
    distributed selection (``functions.selection``): no record is moved."""
    h = hash_col if hash_col is not None else key_hash(key_cols, seed)
    place = math.ceil(df.count() * test_fraction)
    return _placed(df, h, key_cols, lambda d, order: d.withColumn("is_test", SEL.below_place(d, order, place)))


def _placed(df: DataFrame, h: Column, key_cols: Sequence[str], mark) -> DataFrame:
    """``mark(frame, order)`` in the order of hash, key and whole row; only
    where equal rows lie across a border are rows written and numbered."""
    order = [h.cast("long"), *[SEL.order_value(df, c) for c in key_cols], SEL.whole_row(df)]
    try:
        return mark(df, order)
    except SEL.Tied:
        return mark(SEL.numbered(df), [*order, F.col(SEL.NUMBER)]).drop(SEL.NUMBER)


def exact_folds(df: DataFrame, key_cols: Sequence[str], k: int, seed: int = SPLIT_SEED,
                hash_col: Column | None = None, name: str = "fold") -> DataFrame:
    """``k`` shuffled folds whose sizes differ by one row at most, the
    first ones larger: consecutive parts of the (hash, key) order, found by
    distributed selection."""
    h = hash_col if hash_col is not None else key_hash(key_cols, seed)
    return _placed(df, h, key_cols, lambda d, order: d.withColumn(name, SEL.fold_of(d, order, k)))


def top_feature_indices(importances: Sequence[float], n_features: int) -> list[int]:
    """Indices by importance descending (ties by index); n larger than
    the width keeps everything.  The order of the kept columns is the
    importance order, as in the reference."""
    imp = np.asarray(importances, dtype=float)
    order = sorted(range(len(imp)), key=lambda i: (-imp[i], i))
    return order[:min(n_features, len(order))]


def select_top_features(train: DataFrame, features_col: str = "features", label_col: str = "label",
                        n_features: int = 300, num_trees: int = 50, max_depth: int = 10,
                        seed: int = 42, output_col: str = "selected", max_bins: int = 256):
    """A forest on the training part ranks the features; returns
    ``(VectorSlicer, indices, forest model)``.  The slicer is applied at
    scoring time after scaling."""
    rf = RandomForestClassifier(featuresCol=features_col, labelCol=label_col, numTrees=num_trees,
                                maxDepth=max_depth, seed=seed, maxBins=max_bins)
    model = rf.fit(train)
    idx = top_feature_indices(model.featureImportances.toArray(), n_features)
    slicer = VectorSlicer(inputCol=features_col, outputCol=output_col, indices=idx)
    return slicer, idx, model

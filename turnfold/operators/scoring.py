"""Batch scoring, row-count guard and run-to-run diff."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def score(model, features: DataFrame, prob: str | None, threshold: float,
          id_col: str = "battle_id") -> DataFrame:
    """``battle_id, probability, prediction`` with ``p >= t``.
    ``prob`` names a probability-vector column of a fitted Spark model, or
    None when the model already outputs a scalar ``probability``."""
    from .evaluate import predict_at
    from .models import positive_probability
    out = model.transform(features)
    p = positive_probability(prob) if prob else F.col("probability")
    return out.select(id_col, p.alias("probability"), predict_at(p, threshold).alias("prediction"))


def row_count_guard(expected: int, got: int) -> None:
    """The scored row count must equal the input row count."""
    if expected != got:
        raise ValueError(f"prediction count {got} differs from input count {expected}")


def prediction_diff(previous: DataFrame, current: DataFrame, id_col: str = "battle_id",
                    label_col: str = "player_won") -> DataFrame:
    """Inner match on the id with the previous run; differing / compared
    x 100.  No overlap gives a null percentage.  (One shuffle join on the
    key; both sides are one row per id.)"""
    p = previous.select(F.col(id_col).cast("string").alias("_id"), F.col(label_col).alias("_prev"))
    c = current.select(F.col(id_col).cast("string").alias("_id"), F.col(label_col).alias("_cur"))
    j = p.join(c, "_id")
    return j.agg(F.count(F.lit(1)).cast("long").alias("compared"),
                 F.count_if(F.col("_prev") != F.col("_cur")).cast("long").alias("differing")) \
            .withColumn("diff_pct", F.when(F.col("compared") > 0,
                                           F.col("differing") * 100.0 / F.col("compared")))

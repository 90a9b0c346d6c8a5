"""Evaluation tables (I1-I13).  Only the tables are built; drawing is not.

Curves are computed from a pre-aggregation by distinct score (partial
aggregation), then running sums in descending score order that are
distributed across range partitions (``functions.ordering.running_sums``):
no window without a partition key ever sees the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ordering import ordered_pass, running_sums

HIST_BINS = 50
SWEEP_POINTS = 100


def predict_at(p: Column, threshold: float) -> Column:
    """H8: ``p >= t`` (Spark's own ``setThreshold`` uses ``>``)."""
    return F.when(p >= F.lit(threshold), F.lit(1)).otherwise(F.lit(0)).cast("int")


def accuracy(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Accuracy and the positive rate."""
    return df.agg(F.avg((F.col(y) == F.col(yhat)).cast("double")).alias("accuracy"),
                  F.avg(F.col(y).cast("double")).alias("positive_rate"),
                  F.count(F.lit(1)).cast("long").alias("n"))


def confusion_matrix(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Counts on the full 2x2 grid plus the row percentage (null when a
    true class is empty; the original gives NaN)."""
    spark = df.sparkSession
    grid = spark.createDataFrame([(a, b) for a in (0, 1) for b in (0, 1)], "y int, yhat int")
    counts = df.groupBy(F.col(y).cast("int").alias("y"), F.col(yhat).cast("int").alias("yhat")) \
               .agg(F.count(F.lit(1)).alias("n"))
    # at most four rows on each side
    j = grid.join(F.broadcast(counts), ["y", "yhat"], "left") \
            .withColumn("n", F.coalesce(F.col("n"), F.lit(0)).cast("long"))
    rows = j.groupBy("y").agg(F.sum("n").alias("_row"))
    return j.join(rows, "y").select(
        "y", "yhat", "n", (F.try_divide(F.col("n") * F.lit(100.0), F.col("_row"))).alias("row_pct"))


def score_table(df: DataFrame, y: str, p: str) -> DataFrame:
    """Positives and negatives per distinct score (partial aggregation)."""
    yy = F.col(y).cast("long")
    return df.groupBy(F.col(p).cast("double").alias("score")).agg(
        F.sum(yy).alias("pos"), F.sum(F.lit(1) - yy).alias("neg"))


def cumulative_curve(df: DataFrame, y: str, p: str) -> tuple[DataFrame, float, float]:
    """Distinct scores in descending order with cumulative true and false
    positives ``tps``, ``fps``; also the totals P and N."""
    st = score_table(df, y, p)
    tot = st.agg(F.sum("pos"), F.sum("neg")).first()
    P, N = float(tot[0] or 0), float(tot[1] or 0)
    cum = running_sums(st, [F.col("score").desc()], ["pos", "neg"])
    cum = cum.withColumnRenamed("pos_cum", "tps").withColumnRenamed("neg_cum", "fps")
    return cum, P, N


def roc_points(df: DataFrame, y: str, p: str, drop_intermediate: bool = True) -> DataFrame:
    """``(point, threshold, fpr, tpr)`` with a leading (0, 0) point at an
    infinite threshold; collinear inner points are dropped as the
    reference estimator does (second differences of both counts zero)."""
    st = score_table(df, y, p)
    # scores rising: the row before is the next point of the curve, and the
    # sums up to a row are what lies behind it
    up = ordered_pass(st, ["score"], sums=["pos", "neg"], lags=["pos", "neg"])
    ends = up.agg(F.max("pos_cum"), F.max("neg_cum"), F.max("score")).first()
    P, N = float(ends[0] or 0), float(ends[1] or 0)
    idx = up.select("score", "pos", "neg", (F.lit(int(P)) - F.col("pos_cum") + F.col("pos")).alias("tps"),
                    (F.lit(int(N)) - F.col("neg_cum") + F.col("neg")).alias("fps"), "prev_pos", "prev_neg")
    if drop_intermediate:
        idx = idx.where(F.col("prev_pos").isNull() | (F.col("score") == F.lit(ends[2]))
                        | (F.col("prev_pos") != F.col("pos")) | (F.col("prev_neg") != F.col("neg")))
    pts = idx.select(F.col("score").alias("threshold"),
                     (F.col("fps") / F.lit(N)).alias("fpr") if N else F.lit(float("nan")).alias("fpr"),
                     (F.col("tps") / F.lit(P)).alias("tpr") if P else F.lit(float("nan")).alias("tpr"))
    origin = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)],
                                             "threshold double, fpr double, tpr double")
    return origin.unionByName(pts)


def roc_auc(df: DataFrame, y: str, p: str) -> DataFrame:
    """I4: exact trapezoid area: sum over scores of
    ``neg * (tps + tps_prev) / 2`` divided by ``P * N`` (no lag needed:
    ``tps_prev = tps - pos``)."""
    cum, P, N = cumulative_curve(df, y, p)
    area = cum.agg(F.sum(F.col("neg").cast("double") * (F.col("tps") - F.col("pos") / 2.0)).alias("a"))
    return area.select((F.col("a") / F.lit(float(P) * float(N)) if P * N else F.lit(float("nan")))
                       .alias("roc_auc"))


def pr_points(df: DataFrame, y: str, p: str) -> DataFrame:
    """``(threshold, precision, recall)`` per distinct score, plus the
    final point recall 0 / precision 1 (threshold null)."""
    cum, P, N = cumulative_curve(df, y, p)
    pts = cum.select(F.col("score").alias("threshold"),
                     F.try_divide(F.col("tps").cast("double"), F.col("tps") + F.col("fps"))
                     .alias("precision"),
                     ((F.col("tps") / F.lit(P)) if P else F.lit(1.0)).alias("recall"))
    end = df.sparkSession.createDataFrame([(None, 1.0, 0.0)],
                                          "threshold double, precision double, recall double")
    return pts.unionByName(end)


def average_precision(df: DataFrame, y: str, p: str) -> DataFrame:
    """Step sum ``sum((R_n - R_{n-1}) * P_n)`` = ``sum(pos/P * precision)``.
    (Spark's ``areaUnderPR`` is a trapezoid, a different number.)"""
    cum, P, N = cumulative_curve(df, y, p)
    ap = cum.agg(F.sum(F.col("pos") / F.lit(P if P else float("nan"))
                       * (F.col("tps") / (F.col("tps") + F.col("fps")))).alias("average_precision"))
    return ap


def histogram_bin(x: Column, lo: Column, hi: Column, bins: int = HIST_BINS) -> Column:
    """Bin of ``x`` on ``bins`` equal bins over ``[lo, hi]`` exactly as the
    reference histogram places it (last bin closed; edges ``lo + i*step``)."""
    step = (hi - lo) / F.lit(float(bins))
    f = (x - lo) * (F.lit(float(bins)) / (hi - lo))
    i0 = F.least(F.floor(f).cast("int"), F.lit(bins - 1))

    def edge(i):
        return F.when(i >= F.lit(bins), hi).otherwise(i.cast("double") * step + lo)
    i1 = F.when(x < edge(i0), i0 - 1).otherwise(i0)
    return F.when((i1 != F.lit(bins - 1)) & (x >= edge(i1 + 1)), i1 + 1).otherwise(i1)


def score_histogram(df: DataFrame, y: str, p: str, bins: int = HIST_BINS) -> DataFrame:
    """I8: per class, all ``bins`` equal bins over that class's own min..max,
    density-normalised (count / (n * width)).  A class whose scores are all
    equal gets the range (v - 0.5, v + 0.5) as the reference does."""
    s = df.select(F.col(y).cast("int").alias("y"), F.col(p).cast("double").alias("p"))
    rng = s.groupBy("y").agg(F.min("p").alias("_lo"), F.max("p").alias("_hi"),
                             F.count(F.lit(1)).alias("_n"))
    rng = rng.select("y", "_n",
                     F.when(F.col("_lo") == F.col("_hi"), F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
                     F.when(F.col("_lo") == F.col("_hi"), F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"))
    # one row per class: a proven bound
    b = s.join(F.broadcast(rng), "y").withColumn(
        "bin", histogram_bin(F.col("p"), F.col("_lo"), F.col("_hi"), bins))
    filled = b.groupBy("y", "bin").agg(F.count(F.lit(1)).cast("long").alias("count"))
    # bins x classes rows, empty bins with count 0
    grid = rng.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    out = grid.join(filled, ["y", "bin"], "left").withColumn("count", F.coalesce("count", F.lit(0).cast("long")))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    return out.select("y", F.col("bin").cast("int").alias("bin"), "count",
                      (F.col("_lo") + F.col("bin") * width).alias("bin_start"),
                      (F.col("count") / (F.col("_n") * width)).alias("density"))


def sweep_grid(points: int = SWEEP_POINTS) -> list[float]:
    """``i * (1/(points-1))``, last point exactly 1.0 (as linspace)."""
    g = [i * (1.0 / (points - 1)) for i in range(points)]
    g[-1] = 1.0
    return g


def _grid_index(p: Column, points: int) -> Column:
    """Largest i with ``grid[i] <= p`` (-1 below the grid)."""
    step = 1.0 / (points - 1)

    def t(i):
        return F.when(i >= F.lit(points - 1), F.lit(1.0)).otherwise(i.cast("double") * F.lit(step))
    c = F.least(F.greatest(F.floor(p * F.lit(float(points - 1))).cast("int"), F.lit(0)),
                F.lit(points - 1))
    c = F.when(t(c) > p, c - 1).otherwise(c)
    return F.when((c < F.lit(points - 1)) & (t(c + 1) <= p), c + 1).otherwise(c)


def threshold_sweep(df: DataFrame, y: str, p: str, points: int = SWEEP_POINTS) -> DataFrame:
    """Accuracy, precision, recall and F1 at every grid threshold with
    ``p >= t``; 0 where a denominator is 0.

    Rows are first reduced to counts per grid bucket (at most ``points + 1``
    rows, partial aggregation); each threshold then sums the buckets at or
    above it.  Never ``rows x points``."""
    spark = df.sparkSession
    yy = F.col(y).cast("long")
    buckets = df.groupBy(_grid_index(F.col(p).cast("double"), points).alias("b")).agg(
        F.sum(yy).alias("pos"), F.sum(F.lit(1) - yy).alias("neg"))
    tot = buckets.agg(F.sum("pos"), F.sum("neg")).first()
    P, N = int(tot[0] or 0), int(tot[1] or 0)
    grid = spark.createDataFrame(list(enumerate(sweep_grid(points))), "i int, threshold double")
    j = grid.join(F.broadcast(buckets), F.col("b") >= F.col("i"), "left")
    c = j.groupBy("i", "threshold").agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("tp"),
                                        F.coalesce(F.sum("neg"), F.lit(0)).alias("fp"))
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    fn, tn = F.lit(float(P)) - tp, F.lit(float(N)) - fp
    n = float(P + N)
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    out = c.select("i", "threshold",
                   ((tp + tn) / F.lit(n) if n else F.lit(0.0)).alias("accuracy"),
                   prec.alias("precision"), rec.alias("recall"))
    return out.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                       2 * F.col("precision") * F.col("recall")
                                       / (F.col("precision") + F.col("recall")))
                          .otherwise(F.lit(0.0)))


def best_threshold(sweep: DataFrame, metric: str = "accuracy") -> DataFrame:
    """First (lowest) threshold with the maximum metric (the original
    picks by accuracy although its comment says F1)."""
    key = F.struct(F.col(metric), F.negative(F.col("i")))
    return sweep.agg(F.max_by("threshold", key).alias("threshold"),
                     F.max(metric).alias(metric))


def importance_table(spark: SparkSession, importances: Sequence[float],
                     names: Sequence[str] | None = None, top_n: int = 20) -> DataFrame:
    """Top ``top_n`` features by importance (a model attribute, bounded
    by the feature count); unnamed features are labelled ``Feature i``."""
    imp = np.asarray(importances, dtype=float)
    order = sorted(range(len(imp)), key=lambda i: (-imp[i], i))[:top_n]
    rows = [(r + 1, int(i), names[i] if names else f"Feature {i}", float(imp[i]))
            for r, i in enumerate(order)]
    return spark.createDataFrame(rows, "rank int, index int, feature string, importance double")


def mean_importance(members: Sequence[Sequence[float] | None],
                    selected: Sequence[int] | None = None,
                    names: Sequence[str] | None = None,
                    semantics: str = "corrected") -> tuple[np.ndarray, list[str]]:
    """Mean importance over the members that expose one.  ``observed``
    labels positions after selection (Q13); ``corrected`` maps them back
    through the kept indices to the original feature names."""
    have = [np.asarray(m, dtype=float) for m in members if m is not None]
    if not have:
        return np.zeros(0), []
    mean = np.mean(np.vstack(have), axis=0)
    if semantics == "observed" or selected is None:
        labels = [f"Feature {i}" for i in range(len(mean))]
    else:
        labels = [names[j] if names else f"Feature {j}" for j in selected]
    return mean, labels


def evaluation_suite(train: DataFrame, test: DataFrame | None, y: str, p: str,
                     threshold: float) -> dict[str, DataFrame]:
    """Tables keyed by ``split/metric``: confusion, ROC, PR and
    histogram for train and (if any) test; the sweep on train only."""
    out: dict[str, DataFrame] = {}
    for split, d in (("train", train), ("test", test)):
        if d is None:
            continue
        scored = d.withColumn("_yhat", predict_at(F.col(p), threshold))
        out[f"{split}/confusion"] = confusion_matrix(scored, y, "_yhat")
        out[f"{split}/roc"] = roc_points(d, y, p)
        out[f"{split}/pr"] = pr_points(d, y, p)
        out[f"{split}/histogram"] = score_histogram(d, y, p)
    out["train/sweep"] = threshold_sweep(train, y, p)
    return out

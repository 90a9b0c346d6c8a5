"""Classifiers and soft voting (H1-H9).

Logistic regression, the forest (H2) and ``regularised_gbt`` are
``pyspark.ml`` learners; extremely randomised trees (H3) are in
``randomtrees``, boosting from the log-odds prior (H4) and regularised
boosting (H5) in ``histtrees``, and their scoring in ``flattrees``.
Reference parameters are the function defaults.  Spark bins continuous
features (``maxBins``).  ``RandomCutForest`` is a lighter form of H3 that
shares cuts among the trees of a group.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .evaluate import predict_at
from .flattrees import FlatModel

HELD_NODES = 1 << 22  # tree nodes that the driver may hold at a time
MAX_BINS = 256  # histogram bins of a feature, for every tree learner


def positive_probability(prob_col: str) -> Column:
    """H7: P(class 1) out of a probability vector."""
    return vector_to_array(prob_col)[1]


def logistic(n_train: int, C: float = 1.0, max_iter: int = 1000, features_col: str = "features",
             label_col: str = "label", prefix: str = "lr", weight_col: str | None = None,
             tol: float = 1e-6) -> LogisticRegression:
    """H1: L2 logistic regression with the reference's objective
    ``0.5*||w||^2 + C * sum(loss)``; dividing by ``C*n`` gives Spark's
    ``regParam = 1 / (C * n)`` on unstandardised coefficients (the intercept
    is not penalised in either)."""
    lr = LogisticRegression(featuresCol=features_col, labelCol=label_col, maxIter=max_iter,
                            regParam=1.0 / (C * max(n_train, 1)), elasticNetParam=0.0,
                            standardization=False, tol=tol,
                            probabilityCol=f"{prefix}_probability",
                            rawPredictionCol=f"{prefix}_raw", predictionCol=f"{prefix}_prediction")
    if weight_col:
        lr.setWeightCol(weight_col)
    return lr


def random_forest(num_trees: int = 200, max_depth: int = 10, min_instances: int = 8,
                  seed: int = 42, features_col: str = "features", label_col: str = "label",
                  prefix: str = "rf", weight_col: str | None = None, max_bins: int = MAX_BINS
                  ) -> RandomForestClassifier:
    """H2: 200 trees, depth 10, leaf >= 8 (which implies split >= 15),
    sqrt features, seed 42.  K14 is the same learner with depth 20 / leaf 2."""
    rf = RandomForestClassifier(featuresCol=features_col, labelCol=label_col, numTrees=num_trees,
                                maxDepth=max_depth, minInstancesPerNode=min_instances,
                                featureSubsetStrategy="sqrt", seed=seed, maxBins=max_bins,
                                probabilityCol=f"{prefix}_probability",
                                rawPredictionCol=f"{prefix}_raw", predictionCol=f"{prefix}_prediction")
    if weight_col:
        rf.setWeightCol(weight_col)
    return rf


def gbt(max_iter: int = 100, max_depth: int = 4, step: float = 0.03, subsample: float = 0.65,
        min_instances: int = 8, seed: int = 42, features_col: str = "features",
        label_col: str = "label", prefix: str = "gbt", feature_subset: str = "all",
        min_info_gain: float = 0.0, weight_col: str | None = None,
        max_bins: int = MAX_BINS) -> GBTClassifier:
    """Spark's own boosting: ``sigmoid(2F)`` with the first tree at weight 1;
    column sampling is per node.  H4 itself is ``histtrees.gradient_booster``."""
    g = GBTClassifier(featuresCol=features_col, labelCol=label_col, maxIter=max_iter,
                      maxDepth=max_depth, stepSize=step, subsamplingRate=subsample,
                      minInstancesPerNode=min_instances, seed=seed,
                      featureSubsetStrategy=feature_subset, minInfoGain=min_info_gain, maxBins=max_bins,
                      predictionCol=f"{prefix}_prediction")
    g.setProbabilityCol(f"{prefix}_probability").setRawPredictionCol(f"{prefix}_raw")
    if weight_col:
        g.setWeightCol(weight_col)
    return g


def regularised_gbt(**kw) -> GBTClassifier:
    """H5 approximation: 150 rounds, depth 4, rate 0.03, subsample 0.65,
    column sample 0.7, leaf >= 8, gamma 0.2 as minimum gain."""
    args = dict(max_iter=150, max_depth=4, step=0.03, subsample=0.65, min_instances=8,
                feature_subset="0.7", min_info_gain=0.2, prefix="xgb")
    args.update(kw)
    return gbt(**args)


@dataclass
class RandomCutForestModel:
    groups: list = field(default_factory=list)   # (cut matrix, forest model, trees)
    features_col: str = "features"
    prefix: str = "et"

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        total = sum(t for _, _, t in self.groups)
        parts = []
        for g, (cuts, model, trees) in enumerate(self.groups):
            out = _quantise_df(out, self.features_col, cuts, f"_{self.prefix}_q")
            out = model.transform(out).drop(f"_{self.prefix}_q", f"_{self.prefix}_raw{g}",
                                            f"_{self.prefix}_pred{g}")
            parts.append(positive_probability(f"_{self.prefix}_prob{g}") * F.lit(trees / total))
        p = parts[0]
        for x in parts[1:]:
            p = p + x
        drop = [f"_{self.prefix}_prob{g}" for g in range(len(self.groups))]
        return out.withColumn(f"{self.prefix}_p1", p).drop(*drop)


def quantiser(features_col: str, cuts: np.ndarray, output_col: str):
    """Feature value -> number of (sorted) random cuts at or below it, as
    built-in stages: vector to columns, a multi-column ``Bucketizer``
    (binary search over the splits, JVM-side) and a ``VectorAssembler``."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
    d = cuts.shape[0]
    names = [f"_q_in{i}" for i in range(d)]
    outs = [f"_q_out{i}" for i in range(d)]
    split = SQLTransformer(statement="SELECT *, " + ", ".join(
        f"_q_arr[{i}] AS {n}" for i, n in enumerate(names)) + " FROM __THIS__")
    splits = [[float("-inf")] + sorted(set(float(c) for c in row)) + [float("inf")] for row in cuts]
    bucket = Bucketizer(inputCols=names, outputCols=outs, splitsArray=splits, handleInvalid="keep")
    assemble = VectorAssembler(inputCols=outs, outputCol=output_col)
    return PipelineModel(stages=[split, bucket, assemble]), names + outs


def _quantise_df(df: DataFrame, features_col: str, cuts: np.ndarray, output_col: str) -> DataFrame:
    stages, tmp = quantiser(features_col, cuts, output_col)
    out = stages.transform(df.withColumn("_q_arr", vector_to_array(features_col)))
    return out.drop("_q_arr", *tmp)


class RandomCutForest:
    """H3 approximation of extremely randomised trees: no bootstrap, and
    split candidates restricted to seeded uniform random cut points per
    feature (a fresh set for every group of trees), sqrt features."""

    def __init__(self, num_trees: int = 200, groups: int = 4, cuts: int = 16,
                 max_depth: int = 10, min_instances: int = 8, seed: int = 42,
                 features_col: str = "features", label_col: str = "label", prefix: str = "et"):
        self.num_trees, self.groups, self.cuts = num_trees, groups, cuts
        self.max_depth, self.min_instances, self.seed = max_depth, min_instances, seed
        self.features_col, self.label_col, self.prefix = features_col, label_col, prefix

    def fit(self, df: DataFrame) -> RandomCutForestModel:
        s = df.select(Summarizer.metrics("min", "max").summary(F.col(self.features_col))
                      .alias("s")).first()["s"]
        lo, hi = s["min"].toArray(), s["max"].toArray()
        rng = np.random.default_rng(self.seed)
        # as many trees as asked for: the first groups take the remainder
        groups = min(self.groups, self.num_trees)
        sizes = [self.num_trees // groups + (g < self.num_trees % groups) for g in range(groups)]
        out = RandomCutForestModel(features_col=self.features_col, prefix=self.prefix)
        for g, per in enumerate(sizes):
            cuts = np.sort(rng.uniform(lo[:, None], np.maximum(hi, lo)[:, None],
                                       size=(len(lo), self.cuts)), axis=1)
            q = _quantise_df(df, self.features_col, cuts, f"_{self.prefix}_q")
            rf = RandomForestClassifier(
                featuresCol=f"_{self.prefix}_q", labelCol=self.label_col, numTrees=per,
                maxDepth=self.max_depth, minInstancesPerNode=self.min_instances,
                featureSubsetStrategy="sqrt", bootstrap=False, subsamplingRate=1.0,
                seed=self.seed + g, maxBins=max(32, self.cuts + 1),
                probabilityCol=f"_{self.prefix}_prob{g}", rawPredictionCol=f"_{self.prefix}_raw{g}",
                predictionCol=f"_{self.prefix}_pred{g}")
            out.groups.append((cuts, rf.fit(q), per))
        return out


def vote(df: DataFrame, scores: Sequence[str | Column], threshold: float, digits: int | None = None) -> DataFrame:
    """H6, H8: ``probability``, the mean of the members' scores, and
    ``prediction`` from it (rounded to ``digits`` before the bound, if given)."""
    cols = [F.col(c) if isinstance(c, str) else c for c in scores]
    mean = cols[0]
    for c in cols[1:]:
        mean = mean + c
    df = df.withColumn("probability", mean / F.lit(float(len(cols))))
    p = F.col("probability") if digits is None else F.round("probability", digits)
    return df.withColumn("prediction", predict_at(p, threshold))


@dataclass
class SoftVoteModel:
    members: list          # (name, fitted model)
    threshold: float = 0.5

    def member_p1(self, name: str) -> str:
        return f"{name}_p1"

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Adds ``<member>_p1`` per member, ``probability`` (their mean, H6)
        and ``prediction`` (``probability >= threshold``, H8)."""
        out = df
        cols = []
        for name, model in self.members:
            out = model.transform(out)
            if isinstance(model, (RandomCutForestModel, FlatModel)):
                p = F.col(f"{model.prefix}_p1")
            else:
                p = positive_probability(f"{name}_probability")
                out = out.withColumn(self.member_p1(name), p) \
                         .drop(f"{name}_probability", f"{name}_raw", f"{name}_prediction")
                p = F.col(self.member_p1(name))
            cols.append(p)
        return vote(out, cols, self.threshold)


def fit_soft_vote(train: DataFrame, estimators: Sequence[tuple[str, object]],
                  threshold: float = 0.5, parallel: int = 4) -> SoftVoteModel:
    """H6: fit every member on the same (cached) training frame; the member
    fits are independent Spark jobs submitted from a small thread pool,
    each distributing its own work."""
    train = train.persist()
    try:
        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            fitted = list(pool.map(lambda ne: (ne[0], ne[1].fit(train)), estimators))
    finally:
        train.unpersist()
    return SoftVoteModel(members=fitted, threshold=threshold)


def fit_all(fits: Sequence[tuple[object, DataFrame]], parallel: int = 8) -> list:
    """Models of ``(estimator, frame)`` pairs, in order.  The fits do not wait
    for one another; each works on its own copy of the estimator."""
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return list(pool.map(lambda own: own[0].copy().fit(own[1]), fits))


@dataclass
class ForestPartsModel:
    """``<prefix>_p1`` is the vote of all trees: each tree has one voice, so the
    parts' probabilities are weighed by their trees.  Parts that were saved
    (folder instead of model) are read and vote ``at_once`` at a time."""

    models: list         # fitted models, or folders of them
    prefix: str = "rf"
    trees: list = field(default_factory=list)  # of the saved parts
    at_once: int = 12

    def transform(self, df: DataFrame) -> DataFrame:
        if self.trees:
            return self._saved_votes(df)
        trees = sum(m.getNumTrees for m in self.models)
        return self._voted(df, self.models).withColumn(f"{self.prefix}_p1", F.col("_votes") / F.lit(trees)).drop("_votes")

    def _voted(self, df: DataFrame, models: list) -> DataFrame:
        """``_votes``: sum of the trees' probabilities."""
        out, columns, vote = df, df.columns, F.lit(0.0)
        for g, m in enumerate(models):
            out = m.transform(out).withColumnRenamed(f"{self.prefix}_probability", f"_part{g}").drop(
                f"{self.prefix}_raw", f"{self.prefix}_prediction")
            vote = vote + positive_probability(f"_part{g}") * F.lit(m.getNumTrees)
        return out.select(*columns, vote.alias("_votes"))

    def _saved_votes(self, df: DataFrame) -> DataFrame:
        """Rows are written with a number, then the votes of some parts after
        the other: the driver holds these parts only."""
        spark = df.sparkSession

        def kept(frame: DataFrame, path: str) -> DataFrame:
            frame.write.mode("append").parquet(path)
            return spark.read.schema(frame.schema).parquet(path)

        rows = kept(df.withColumn("_row", F.monotonically_increasing_id()), scratch_path(spark, "forest-rows"))
        path = scratch_path(spark, "forest-votes")
        for lo in range(0, len(self.models), self.at_once):
            some = [RandomForestClassificationModel.load(p) for p in self.models[lo:lo + self.at_once]]
            votes = kept(self._voted(rows.select("_row", some[0].getFeaturesCol()), some).select("_row", "_votes"), path)
        total = votes.groupBy("_row").agg(F.sum("_votes").alias("_votes"))
        return rows.join(total, "_row").select(*df.columns, (F.col("_votes") / F.lit(sum(self.trees))).alias(f"{self.prefix}_p1"))


def fit_forest_parts(train: DataFrame, num_trees: int = 200, parts: int = 12, seed: int = 42, prefix: str = "rf",
                     **options) -> ForestPartsModel:
    """The forest of ``random_forest``, grown in ``parts`` that do not wait for
    one another.

    A pass of Spark's learner fills the histograms of as many nodes as its
    memory holds, in a task for each partition of the rows; deep trees have
    many small nodes, so the passes of a forest are many and a short table
    keeps one core busy.  Trees do not depend on each other: the passes of
    different parts run side by side.  Seeds are far apart, as the learner adds
    the partition's number to its seed.

    A tree has up to a node for each two rows of a leaf's least size, and the
    learner keeps its trees on the driver.  Where the whole forest may have more
    than ``HELD_NODES`` nodes, parts are smaller, fewer of them grow at a time
    and each goes to the shared folder when it is grown."""
    train = train.persist()
    try:
        most = min(2 ** (options.get("max_depth", 10) + 1), 2 * train.count() // options.get("min_instances", 8) + 1)
        together = max(1, HELD_NODES // most)  # trees that the driver may hold
        at_once = max(1, min(parts, num_trees, together))
        parts = at_once if together >= num_trees else -(-num_trees // (together // at_once))
        sizes = [num_trees // parts + (g < num_trees % parts) for g in range(parts)]
        forests = [random_forest(num_trees=n, seed=seed + 1_000_003 * g, prefix=prefix, **options) for g, n in enumerate(sizes)]
        if together >= num_trees:
            return ForestPartsModel(fit_all([(f, train) for f in forests], parallel=parts), prefix)

        def grown(forest: RandomForestClassifier) -> str:
            path = scratch_path(train.sparkSession, "forest-part")
            forest.fit(train).write().save(path)
            return path

        with ThreadPoolExecutor(max_workers=at_once) as pool:
            return ForestPartsModel(list(pool.map(grown, forests)), prefix, sizes, at_once)
    finally:
        train.unpersist()


def stacked_scores(df: DataFrame, members: Sequence[tuple[str, object]], fold: Column, k: int,
                   id_col: str, label_col: str = "label") -> DataFrame:
    """Stacking.  Out-of-fold member scores (each member fitted k times
    on the other folds) train a logistic meta-learner; the members are then
    refitted on all rows and the meta-learner combines their scores."""
    base = df.withColumn("_fold", fold).persist()
    try:
        parts = [base.where(F.col("_fold") != f) for f in range(k)] + [base]
        fitted = iter(fit_all([(est, part) for part in parts for _, est in members]))
        scored = []
        for f in range(k + 1):
            out = base if f == k else base.where(F.col("_fold") == f).select(id_col, label_col, "features", "_fold")
            for name, _ in members:
                out = next(fitted).transform(out).withColumn(f"{name}_p1", positive_probability(
                    f"{name}_probability")).drop(f"{name}_probability", f"{name}_raw", f"{name}_prediction")
            scored.append(out)
        *tested, full = scored
        oof = tested[0]
        for more in tested[1:]:
            oof = oof.unionByName(more)
        names = [n for n, _ in members]
        meta_in = oof.withColumn("meta_features", array_to_vector(F.array(*[f"{n}_p1" for n in names])))
        meta = logistic(meta_in.count(), features_col="meta_features", prefix="meta").fit(meta_in)
        full = full.withColumn("meta_features", array_to_vector(F.array(*[f"{n}_p1" for n in names])))
        out = meta.transform(full)
        return out.select(id_col, *[f"{n}_p1" for n in names],
                          positive_probability("meta_probability").alias("probability"))
    finally:
        base.unpersist()


def tuned_logistic(df: DataFrame, fold_col: str, grid_reg: Sequence[float], max_iter: int = 100,
                   label_col: str = "label"):
    """Grid search with cross-validation over ``regParam`` using a
    deterministic fold column (hash of the key), area under ROC."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    lr = LogisticRegression(featuresCol="features", labelCol=label_col, maxIter=max_iter,
                            standardization=False, probabilityCol="lr_probability",
                            rawPredictionCol="lr_raw", predictionCol="lr_prediction")
    grid = ParamGridBuilder().addGrid(lr.regParam, list(grid_reg)).build()
    ev = BinaryClassificationEvaluator(rawPredictionCol="lr_raw", labelCol=label_col)
    cv = CrossValidator(estimator=lr, estimatorParamMaps=grid, evaluator=ev, foldCol=fold_col,
                        parallelism=2)
    return cv.fit(df)


def save_soft_vote(spark, vote: SoftVoteModel, path: str) -> None:
    """A8 for the ensemble: every member under ``path/<name>``; random-cut
    members as their cut matrices (parquet) plus one forest per group; a
    one-row manifest with member kinds and the threshold."""
    import json
    manifest = {"threshold": vote.threshold, "members": []}
    for name, model in vote.members:
        if isinstance(model, RandomCutForestModel):
            groups = []
            for g, (cuts, rf, trees) in enumerate(model.groups):
                rows = [(i, [float(c) for c in row]) for i, row in enumerate(cuts)]
                spark.createDataFrame(rows, "feature int, cuts array<double>") \
                     .write.mode("overwrite").parquet(f"{path}/{name}/cuts_{g}")
                rf.write().overwrite().save(f"{path}/{name}/forest_{g}")
                groups.append(trees)
            manifest["members"].append({"name": name, "kind": "random_cut", "groups": groups,
                                        "features_col": model.features_col, "prefix": model.prefix})
        elif isinstance(model, FlatModel):
            manifest["members"].append({"name": name, "kind": "flat", "kept": model.save(spark, f"{path}/{name}")})
        else:
            model.write().overwrite().save(f"{path}/{name}")
            manifest["members"].append({"name": name, "kind": type(model).__name__})
    spark.createDataFrame([(json.dumps(manifest),)], "manifest string") \
         .write.mode("overwrite").json(f"{path}/_manifest")


def load_soft_vote(spark, path: str) -> SoftVoteModel:
    import json

    from pyspark.ml import classification as C
    manifest = json.loads(spark.read.json(f"{path}/_manifest").first()["manifest"])
    members = []
    for m in manifest["members"]:
        if m["kind"] == "random_cut":
            model = RandomCutForestModel(features_col=m["features_col"], prefix=m["prefix"])
            for g, trees in enumerate(m["groups"]):
                rows = spark.read.parquet(f"{path}/{m['name']}/cuts_{g}").orderBy("feature").collect()
                cuts = np.array([r.cuts for r in rows])
                rf = C.RandomForestClassificationModel.load(f"{path}/{m['name']}/forest_{g}")
                model.groups.append((cuts, rf, trees))
        elif m["kind"] == "flat":
            model = FlatModel.load(spark, f"{path}/{m['name']}", m["kept"])
        else:
            model = getattr(C, m["kind"]).load(f"{path}/{m['name']}")
        members.append((m["name"], model))
    return SoftVoteModel(members=members, threshold=manifest["threshold"])

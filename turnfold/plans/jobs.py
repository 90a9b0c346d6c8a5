"""End-to-end jobs over match logs: train (linear / ensemble) and score.

Each job is one Spark plan per stage: scan -> fold (narrow) -> features
(narrow) -> fit (distributed aggregations inside pyspark.ml) -> save.  The
feature frame is written once to the shared checkpoint folder and re-read,
so model fitting does not re-run the JSON scan and fold for every
iteration, and lost executors recompute from that table only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators import evaluate as EV
from ..operators import features as FT
from ..operators import histtrees as HT
from ..operators import models as MD
from ..operators import randomtrees as RT
from ..operators import scoring as SC
from ..operators import split as SP
from ..operators import timeline as TL
from ..operators import transform as TR
from ..session import scratch_path
from ..sources import logs as LG
from ..sources import sinks as SK


def match_feature_table(spark: SparkSession, path: str, is_train: bool = True,
                        semantics: str = "observed") -> tuple[DataFrame, DataFrame]:
    """Scan -> fold -> 984-wide vectors, written to the shared checkpoint
    folder.  Returns ``(features, rejects)``."""
    logs = LG.with_position_id(LG.read_match_logs(spark, path))
    state = TL.fold_match_logs(logs, is_train=is_train, semantics=semantics)
    ok, rejects = TL.split_rejects(state)
    feats = FT.match_features(ok, semantics=semantics)
    out = scratch_path(spark, "features")
    feats.write.parquet(out)
    return spark.read.parquet(out), rejects


@dataclass
class TrainResult:
    model: object
    train_accuracy: float
    test_accuracy: float | None
    n_train: int
    n_test: int
    run: int | None = None


def train_linear(spark: SparkSession, path: str, n_components: int = 200, C: float = 1.0,
                 max_iter: int = 1000, test_size: float = 0.0,
                 threshold: float = S.LINEAR_THRESHOLD, models_root: str | None = None,
                 prefix: str = "model") -> TrainResult:
    """J1's training side (H1 with F1, F4, G1/G2, I1): exact scaler -> PCA
    (k clamped) -> logistic regression; optional hash hold-out."""
    feats, _ = match_feature_table(spark, path)
    split = SP.hash_split(feats, ["battle_id"], test_size)
    train = split.where(~F.col("is_test")).drop("is_test")
    test = split.where(F.col("is_test")).drop("is_test")
    n_train = train.count()
    n_test = test.count()
    # constant columns (at least the 159 never filled) carry no variance:
    # dropping them first leaves PCA and the fit unchanged and shrinks both
    drop, _ = TR.fit_drop_constant(train, "features", "varying")
    varying = drop.transform(train)
    scaler = TR.fit_exact_scaler(varying, "varying", "scaled")
    z = scaler.transform(varying)
    pca = TR.fit_pca(z, "scaled", n_components, output_col="pca", rows=n_train)
    lr = MD.logistic(n_train, C=C, max_iter=max_iter, features_col="pca")
    model = Pipeline(stages=[drop, scaler, pca, lr]).fit(train)

    def acc(df):
        s = SC.score(model, df, "lr_probability", threshold)
        j = s.join(df.select("battle_id", "label"), "battle_id")
        return j.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    res = TrainResult(model, acc(train), acc(test) if n_test else None, n_train, n_test)
    if models_root:
        res.run, _ = SK.save_run(spark, model, models_root, prefix, {
            "n_components": pca.getK(), "C": C, "max_iter": max_iter, "test_size": test_size,
            "threshold": threshold, "train_accuracy": res.train_accuracy,
            "test_accuracy": res.test_accuracy, "n_train": n_train})
    return res


def train_ensemble(spark: SparkSession, path: str, test_size: float = 0.15,
                   threshold: float = S.ENSEMBLE_THRESHOLD, use_scaling: bool = True,
                   use_feature_selection: bool = True, n_top_features: int = 300,
                   num_trees: int = 200, gbt_rounds: int = 100, xgb_rounds: int = 150,
                   with_regularised: bool = True, models_root: str | None = None,
                   prefix: str = "ensemble") -> TrainResult:
    """J2's training side (H2-H6 with F1, G1, G3): scaler (fitted on the
    training part, Q12 corrected) -> top-n selection -> soft vote of the
    forest, extremely randomised trees, boosting and (optional) regularised
    boosting."""
    feats, _ = match_feature_table(spark, path)
    split = SP.hash_split(feats, ["battle_id"], test_size)
    train = split.where(~F.col("is_test")).drop("is_test")
    test = split.where(F.col("is_test")).drop("is_test")
    drop, _ = TR.fit_drop_constant(train, "features", "varying")
    stages = [drop]
    col = "varying"
    if use_scaling:
        scaler = TR.fit_exact_scaler(drop.transform(train), "varying", "scaled")
        stages.append(scaler)
        col = "scaled"
    prep = PipelineModel(stages=stages)
    tr = prep.transform(train)
    if use_feature_selection:
        slicer, idx, _ = SP.select_top_features(tr, col, n_features=n_top_features)
        stages.append(slicer)
        col = "selected"
        tr = slicer.transform(tr)
    members = [("rf", MD.random_forest(num_trees=num_trees, features_col=col)),
               ("et", RT.ExtraTrees(num_trees=num_trees, features_col=col)),
               ("gbt", HT.gradient_booster(gbt_rounds, features_col=col))]
    if with_regularised:
        members.append(("xgb", HT.regularised_booster(xgb_rounds, features_col=col)))
    vote = MD.fit_soft_vote(tr, members, threshold)
    prep_model = PipelineModel(stages=stages)

    def acc(df):
        out = vote.transform(prep_model.transform(df))
        return out.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    n_test = test.count()
    res = TrainResult((prep_model, vote), acc(train), acc(test) if n_test else None,
                      train.count(), n_test)
    if models_root:
        n = (max(SK.run_numbers(spark, models_root, prefix)) + 1
             if SK.run_numbers(spark, models_root, prefix) else 1)
        path = f"{models_root.rstrip('/')}/{prefix}_{n}"
        prep_model.write().overwrite().save(f"{path}/prep")
        MD.save_soft_vote(spark, vote, f"{path}/vote")
        SK.append_run_record(spark, models_root, prefix, n, {
            "test_size": test_size, "threshold": threshold, "n_top_features": n_top_features,
            "num_trees": num_trees, "train_accuracy": res.train_accuracy,
            "test_accuracy": res.test_accuracy, "members": len(members)})
        res.run = n
    return res


def score_ensemble(spark: SparkSession, path: str, models_root: str, out_csv: str,
                   prefix: str = "ensemble", threshold: float | None = None) -> dict:
    """Latest ensemble run -> fold -> features -> scaler -> selection ->
    soft vote -> ``p >= t`` -> CSV, with the row-count guard."""
    run, run_path = SK.latest_run(spark, models_root, prefix)
    prep = PipelineModel.load(f"{run_path}/prep")
    vote = MD.load_soft_vote(spark, f"{run_path}/vote")
    if threshold is not None:
        vote.threshold = threshold
    feats, rejects = match_feature_table(spark, path, is_train=False)
    scored = vote.transform(prep.transform(feats)).select("battle_id", "probability", "prediction")
    n_out, n_rejected = scored.count(), rejects.count()
    SC.row_count_guard(LG.read_match_logs(spark, path).count(), n_out + n_rejected)
    SK.write_predictions(scored, out_csv)
    info = {"run": run, "rows": n_out, "rejected": n_rejected, "threshold": vote.threshold}
    SK.append_run_record(spark, models_root, prefix + "_predict", run, info)
    return info


def score_linear(spark: SparkSession, path: str, models_root: str, out_csv: str,
                 prefix: str = "model", threshold: float = S.LINEAR_THRESHOLD,
                 previous_csv: str | None = None) -> dict:
    """J1 scoring job: latest run -> fold (unlabelled) -> features ->
    probabilities -> ``p >= t`` -> CSV; row-count guard (J3), diff with the
    previous prediction file (J4) and a run record (J5)."""
    run, model = SK.load_latest(spark, models_root, prefix)
    from pyspark.ml.classification import LogisticRegressionModel
    from pyspark.ml.feature import PCAModel
    SK.check_package(model, {"pca": PCAModel, "model": LogisticRegressionModel})
    feats, rejects = match_feature_table(spark, path, is_train=False)
    scored = SC.score(model, feats, "lr_probability", threshold)
    n_out, n_rejected = scored.count(), rejects.count()
    SC.row_count_guard(LG.read_match_logs(spark, path).count(), n_out + n_rejected)
    SK.write_predictions(scored, out_csv)
    info = {"run": run, "rows": n_out, "rejected": n_rejected, "threshold": threshold}
    if previous_csv:
        d = SC.prediction_diff(SK.read_predictions(spark, previous_csv),
                               SK.read_predictions(spark, out_csv)).first()
        info.update(diff_pct=d["diff_pct"], compared=d["compared"])
    SK.append_run_record(spark, models_root, prefix + "_predict", run, info)
    return info


def evaluate_run(train_scored: DataFrame, test_scored: DataFrame | None, threshold: float
                 ) -> dict[str, DataFrame]:
    """I13 on scored frames with columns ``label`` and ``probability``."""
    return EV.evaluation_suite(train_scored, test_scored, "label", "probability", threshold)

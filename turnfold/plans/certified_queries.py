"""Queries whose learnt results SQL can state: closed forms on two features,
optimality certificates, and the match-log jobs over written JSON lines.

A certificate is a figure that is 0 (or 1) if and only if the fitted model
solves its problem: the residual of an eigenvector, the gradient of a
penalised loss.  Spark computes it from the fitted coefficients and the data.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import models as MD
from ..operators import scoring as SC
from ..operators import transform as TR
from ..operators import weights as WT
from ..session import scratch_path
from ..sources import logs as LG
from ..sources import sinks as SK
from ..sources.tables import table
from . import jobs as JB
from .catalogue import _r, embedding_frame, json_lines, register
from .nested_queries import _REASON, match_records
from .oracle import ORACLE

PAIR_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _pair(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(*PAIR_KEY, array_to_vector(F.array(F.col("l_quantity").cast("double"), F.col("l_extendedprice").cast("double")))
                     .alias("features"))


def _pair_model(df: DataFrame):
    scaler = TR.fit_exact_scaler(df, "features", "scaled")
    z = scaler.transform(df)
    return z, TR.fit_pca(z, "scaled", 2)


@register("pca_pair_components")
def q_pair_components(spark, sf_dir):
    """two standardised features have components (1, +-1)/sqrt(2)
    with the ratios (1 +- |r|)/2."""
    _, m = _pair_model(_pair(spark, sf_dir))
    ratios = TR.variance_table(spark, m)
    loads = TR.loadings_table(spark, m, ["a", "b"]).groupBy("component").agg(
        F.sum(F.col("loading") ** 2).alias("square"), F.max(F.abs("loading")).alias("greatest"))
    return ratios.join(loads, "component").select("component", _r("ratio").alias("ratio"), _r("cumulative").alias("cumulative"),
                                                  _r("square").alias("square"), _r("greatest").alias("greatest"))


@register("pca_pair_projection")
def q_pair_projection(spark, sf_dir):
    """coordinates but for their sign."""
    z, m = _pair_model(_pair(spark, sf_dir))
    out = TR.projection_2d(m, z.withColumn("_id", F.struct(*PAIR_KEY)), "_id", "l_linenumber")
    return out.select("_id.*", _r(F.abs("pc1"), 5).alias("pc1"), _r(F.abs("pc2"), 5).alias("pc2"))


@register("pca_certificates")
def q_pca_certificates(spark, sf_dir):
    """F4, F6, F7 on 64 features: eigenvector residual, length, greatest
    product with another component, and relative difference of the projected
    variance from its eigenvalue."""
    e = embedding_frame(spark, sf_dir)
    scaler = TR.fit_exact_scaler(e, "features", "scaled")
    z = scaler.transform(e)
    m = TR.fit_pca(z, "scaled", 10)
    corr = Correlation.corr(z, "scaled").first()[0].toArray()
    pc, ratio = m.pc.toArray(), np.asarray(m.explainedVariance.toArray())
    eigen = ratio * np.trace(corr)
    arr = vector_to_array("pca")
    spread = m.transform(z).agg(*[F.var_pop(arr[j]).alias(f"v{j}") for j in range(10)]).first()
    cross = np.abs(pc.T @ pc) - np.diag(np.ones(10))
    rows = [(j + 1, float(np.abs(corr @ pc[:, j] - eigen[j] * pc[:, j]).max()), float(np.linalg.norm(pc[:, j])),
             float(np.delete(cross[j], j).max()), float(spread[j] / eigen[j] - 1.0)) for j in range(10)]
    out = spark.createDataFrame(rows, "component int, residual double, length double, product double, excess double")
    return out.select("component", *[F.abs(F.round(c, 6)).alias(c) for c in ("residual", "length", "product", "excess")])


@register("logistic_certificate")
def q_logistic_certificate(spark, sf_dir):
    """H1: the gradient of the penalised loss a row at the fitted point is 0
    in every coefficient and the intercept, and the loss is no greater than at
    no coefficients."""
    e = embedding_frame(spark, sf_dir)
    n = e.count()
    m = MD.logistic(n, tol=1e-10).fit(e)
    w = m.coefficients.toArray()
    p = MD.positive_probability("lr_probability")
    x = vector_to_array("features")
    scored = m.transform(e).select("label", p.alias("p"), x.alias("x"))
    grads = scored.select(F.posexplode("x").alias("j", "v"), "label", "p").groupBy("j").agg(F.sum((F.col("p") - F.col("label")) * F.col("v")).alias("g"))
    coefficients = spark.createDataFrame([(j, float(v)) for j, v in enumerate(w)], "j int, w double")
    term = grads.join(F.broadcast(coefficients), "j").select(F.col("j").cast("int").alias("term"), ((F.col("g") + F.col("w")) / n).alias("gradient"))
    free = scored.agg(F.lit(-1).alias("term"), (F.sum(F.col("p") - F.col("label")) / n).alias("gradient"))
    return term.unionByName(free).select("term", F.abs(F.round("gradient", 4)).alias("gradient"))


@register("roster_member_counts")
def q_roster_member_counts(spark, sf_dir):
    """E20 on array rosters: lines gathered by order."""
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_partkey").alias("team"))
    return WT.roster_counts(li, "team")


@register("predictions_csv")
def q_predictions_csv(spark, sf_dir):
    """Written and read back; of keys that repeat the last line counts."""
    s = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("battle_id"), (F.col("n_chars") % 1000 >= 485).cast("int").alias("prediction"))
    path = scratch_path(spark, "predictions")
    SK.write_predictions(s, path)
    return SK.read_predictions(spark, path)


@register("match_log_linear_job")
def q_match_log_linear_job(spark, sf_dir):
    """J1, J3, J4, J5 (with A1, A5-A11): train twice on written JSON lines,
    score with the latest run, score again with another bound, compare."""
    records = match_records(spark, sf_dir).where(F.col("player_won").isNotNull())
    path = json_lines(records, F.to_json(F.struct(*records.columns)), "match-lines")
    root, one, two = (scratch_path(spark, x) for x in ("models", "scores", "scores"))
    JB.train_linear(spark, path, models_root=root)
    JB.train_linear(spark, path, models_root=root, test_size=0.2)
    first = JB.score_linear(spark, path, root, one)
    second = JB.score_linear(spark, path, root, two, threshold=0.0, previous_csv=one)
    differing = SC.prediction_diff(SK.read_predictions(spark, one), SK.read_predictions(spark, two)).first()
    zeros = SK.read_predictions(spark, one).where(F.col("player_won") == 0).count()
    runs = SK.read_runs(spark, root).groupBy("prefix").agg(F.max("run").alias("run"), F.count_distinct("run").alias("runs"))
    told = SK.latest_run_record(spark, root, "model_predict").where(F.col("key") == "rows").groupBy("prefix").agg(F.max(F.col("value").cast("long")).alias("told"))
    read = LG.read_strict(spark, path).count()
    return runs.join(told, "prefix", "left").select(
        "prefix", "run", "runs", F.coalesce("told", F.lit(first["rows"])).alias("rows"), F.lit(read).cast("long").alias("records"),
        F.lit(first["rejected"] + second["rejected"]).cast("long").alias("rejected_twice"), F.lit(second["compared"]).cast("long").alias("compared"),
        (F.lit(differing["differing"]) == F.lit(zeros)).alias("bound_0_turns_all_losses"))


_Z = """s AS (SELECT avg(l_quantity) mq, stddev_pop(CAST(l_quantity AS DOUBLE)) sq, avg(l_extendedprice) mp, stddev_pop(CAST(l_extendedprice AS DOUBLE)) sp,
             corr(CAST(l_quantity AS DOUBLE), CAST(l_extendedprice AS DOUBLE)) r FROM lineitem)"""

ORACLE["pca_pair_components"] = f"""
WITH {_Z}, c AS (SELECT unnest([1, 2]) AS component)
SELECT CAST(component AS INTEGER) AS component, ROUND(CASE component WHEN 1 THEN (1 + abs(r)) / 2 ELSE (1 - abs(r)) / 2 END, 6) AS ratio,
       ROUND(CASE component WHEN 1 THEN (1 + abs(r)) / 2 ELSE 1.0 END, 6) AS cumulative,
       ROUND(CASE component WHEN 1 THEN (1 + abs(r)) / 2 ELSE (1 - abs(r)) / 2 END, 6) AS square,
       ROUND(sqrt(CASE component WHEN 1 THEN (1 + abs(r)) / 4 ELSE (1 - abs(r)) / 4 END), 6) AS greatest
FROM c, s"""

ORACLE["pca_pair_projection"] = f"""
WITH {_Z}, z AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_quantity - mq) / sq AS a, (l_extendedprice - mp) / sp AS b, sign(r) AS d
                 FROM lineitem, s)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ROUND(abs(a + d * b) / sqrt(2), 5) AS pc1, ROUND(abs(a - d * b) / sqrt(2), 5) AS pc2 FROM z"""

ORACLE["pca_certificates"] = """
SELECT CAST(unnest(range(1, 11)) AS INTEGER) AS component, 0.0::DOUBLE AS residual, 1.0::DOUBLE AS length, 0.0::DOUBLE AS product,
       0.0::DOUBLE AS excess"""

ORACLE["logistic_certificate"] = """
SELECT CAST(unnest(range(-1, (SELECT max(len(embedding)) FROM embeddings))) AS INTEGER) AS term, 0.0::DOUBLE AS gradient"""

ORACLE["roster_member_counts"] = """
SELECT CAST(COUNT(*) AS BIGINT) AS members, CAST(COUNT(DISTINCT l_orderkey) AS BIGINT) AS matches FROM lineitem"""

_CSV = """
SELECT CAST({key} AS VARCHAR) AS battle_id, CAST(CASE WHEN n_chars % 1000 >= 485 THEN 1 ELSE 0 END AS INTEGER) AS player_won FROM {rows}"""

ORACLE["predictions_csv"] = _CSV.format(key="doc_id", rows="documents")
ORACLE["csv_roundtrip"] = _CSV.format(key="l.doc_id", rows="labels l JOIN documents d ON d.doc_id = l.doc_id")

ORACLE["match_log_linear_job"] = f"""
WITH m AS (SELECT *, {_REASON} AS reason FROM embeddings WHERE vec_id % 13 <> 0),
n AS (SELECT COUNT(*) AS records, COUNT(*) FILTER (WHERE reason IS NULL) AS scored, COUNT(*) FILTER (WHERE reason IS NOT NULL) AS rejected FROM m)
SELECT prefix, 2 AS run, CAST(runs AS BIGINT) AS runs, CAST(scored AS BIGINT) AS rows, CAST(records AS BIGINT) AS records,
       CAST(2 * rejected AS BIGINT) AS rejected_twice, CAST(scored AS BIGINT) AS compared, true AS bound_0_turns_all_losses
FROM n, (VALUES ('model', 2), ('model_predict', 1)) AS p(prefix, runs)"""

"""Query catalogue over the driver tables.

Each entry is ``fn(spark, sf_dir) -> DataFrame`` and reads whole tables.
Analogies used to run the match-log operators on relational data:

* ``events`` is a timeline: match = ``user_id``, turn order = ``(ts,
  event_id)``, active member = ``event_type``, HP = ``value``, move = the
  ``k`` field of ``props`` (``view`` turns carry no move), a fainting turn =
  ``event_type = 'error'``, opponent name = ``k``.
* ``conversations`` is a timeline: match = ``conv_id``, turn = ``turn``,
  member = ``role``.
* ``orders`` x ``lineitem`` x ``part`` is match x roster x member
  attributes; label ``o_orderstatus = 'F'``.
* ``labels`` x ``documents`` is label and score, the score being
  ``(n_chars % 1000) / 1000``; ``embeddings`` is a ready feature matrix
  with label ``label < 5``.

Doubles are rounded to 6 places where the SQL oracle compares them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import nested as NS
from ..functions.ordering import with_row_index
from ..operators import evaluate as EV
from ..operators import features as FT
from ..operators import histtrees as HT
from ..operators import linear as LI
from ..operators import models as MD
from ..operators import randomtrees as RT
from ..operators import scoring as SC
from ..operators import split as SP
from ..operators import timeline as TL
from ..operators import transform as TR
from ..operators import weights as WT
from ..session import scratch_path
from ..sources import logs as LG
from ..sources import sinks as SK
from ..sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# fixed parameters of the driver-table analogies
EVENT_ROSTER = ["click", "view", "purchase", "signup", "error"]
EVENT_ORDER = ["ts", "event_id"]
NO_MOVE_TYPE = "view"
FAINT_TYPE = "error"
SCORE_MODULUS = 1000


def _r(c: Column | str, n: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, n)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def event_move() -> Column:
    """Move of an event turn: ``props.k``, null on turns without a move."""
    k = F.get_json_object("props", "$.k").cast("long")
    return F.when(F.col("event_type") != NO_MOVE_TYPE, k)


def has_move() -> Column:
    """Same rows as ``event_move().isNotNull()``, spelled so the event-type
    test is pushed into the parquet scan."""
    return (F.col("event_type") != NO_MOVE_TYPE) & \
        F.get_json_object("props", "$.k").cast("long").isNotNull()


def event_opponent() -> Column:
    return F.get_json_object("props", "$.k").cast("long")


def event_fainted() -> Column:
    return F.col("event_type") == FAINT_TYPE


# --- C: timeline fold ------------------------------------------------------

@register("match_state_summary")
def q_match_state_summary(spark, sf_dir):
    ev = events(spark, sf_dir)
    out = TL.match_state_summary(ev, "user_id", EVENT_ORDER, "event_type", "value",
                                 EVENT_ROSTER, event_fainted(), event_move())
    return out.select("user_id", "turns", "revealed", "alive", "discovered_alive",
                      _r("leader_value").alias("leader_value"),
                      *[_r(f"hp_{m}").alias(f"hp_{m}") for m in EVENT_ROSTER],
                      "distinct_moves")


@register("timeline_last_value_by_member")
def q_last_value(spark, sf_dir):
    out = TL.last_value_by_member(events(spark, sf_dir), "user_id", EVENT_ORDER,
                                  "event_type", "value", EVENT_ROSTER)
    return out.select("user_id", F.col("slot").cast("int").alias("slot"), "member",
                      _r("hp").alias("hp"), "active")


@register("timeline_revealed_count")
def q_revealed_events(spark, sf_dir):
    return TL.revealed_count(events(spark, sf_dir), "user_id", "event_type")


@register("timeline_revealed_count_conversations")
def q_revealed_conv(spark, sf_dir):
    return TL.revealed_count(table(spark, sf_dir, "conversations"), "conv_id", "role")


@register("timeline_alive_counters")
def q_alive_observed(spark, sf_dir):
    return TL.alive_counters(events(spark, sf_dir), "user_id", event_fainted())


@register("timeline_alive_counters_corrected")
def q_alive_corrected(spark, sf_dir):
    return TL.alive_counters(events(spark, sf_dir), "user_id", event_fainted(),
                             event_opponent(), semantics="corrected")


@register("timeline_first_use_moves")
def q_first_use(spark, sf_dir):
    out = TL.first_use_moves(events(spark, sf_dir), "user_id", EVENT_ORDER, "event_type",
                             event_move(), per="match")
    return out.select("user_id", "move", "event_type", "first_event_id", "use_order")


@register("timeline_first_use_moves_per_member")
def q_first_use_member(spark, sf_dir):
    out = TL.first_use_moves(events(spark, sf_dir), "user_id", EVENT_ORDER, "event_type",
                             event_move(), per="member")
    return out.select("user_id", "move", "event_type", "first_event_id", "use_order")


@register("move_slots_padded")
def q_move_slots(spark, sf_dir):
    ev = events(spark, sf_dir)
    first = TL.first_use_moves(ev, "user_id", EVENT_ORDER, "event_type", event_move(),
                               use_order=False)
    rosters = ev.select("user_id").distinct().withColumn(
        "event_type", F.explode(F.array(*[F.lit(m) for m in EVENT_ROSTER])))
    slots = TL.move_slots(first, "user_id", "event_type", EVENT_ORDER, members=rosters)
    # D8 move numerics: power = k, accuracy = value of the first use, cat by
    # a case-sensitive category test; padding slots are zeros
    acc = ev.select(F.col("event_id").alias("first_event_id"), F.col("value").alias("_acc"))
    slots = slots.join(acc, "first_event_id", "left")
    return slots.select(
        "user_id", "event_type", F.col("move_slot").cast("int").alias("move_slot"),
        F.coalesce(F.col("move"), F.lit(0)).cast("long").alias("move"),
        F.coalesce(F.col("move").cast("double"), F.lit(0.0)).alias("power"),
        _r(F.coalesce(F.col("_acc"), F.lit(0.0))).alias("accuracy"),
        F.when(F.col("move").isNull(), F.lit(0))
         .otherwise(TL.category_indicator(F.col("event_type"), "purchase")).alias("cat"))


@register("timeline_final_leader")
def q_final_leader(spark, sf_dir):
    out = TL.final_value(events(spark, sf_dir), "user_id", EVENT_ORDER,
                         ["value", "event_type", "event_id"])
    return out.select("user_id", _r("last_value").alias("leader_hp"),
                      F.col("last_event_type").alias("leader"),
                      F.col("last_event_id").alias("last_event_id"))


@register("timeline_final_leader_conversations")
def q_final_leader_conv(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations").withColumn("text_len",
                                                            F.length("text").cast("long"))
    out = TL.final_value(conv, "conv_id", ["turn"], ["role", "text_len", "turn"])
    return out.select("conv_id", F.col("last_role").alias("last_role"),
                      F.col("last_text_len").alias("last_text_len"),
                      F.col("last_turn").alias("last_turn"))


# full sort key of a lineitem: (l_orderkey, l_linenumber) alone is not unique
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def roster(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    return li.join(part, li.l_partkey == part.p_partkey)


@register("timeline_name_slot")
def q_name_slot(spark, sf_dir):
    return TL.name_slot(roster(spark, sf_dir), "l_orderkey", LINE_ORDER, "p_name")


@register("match_label")
def q_match_label(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    won = F.col("o_orderstatus") == "F"
    return o.select("o_orderkey",
                    TL.label_column(won, True).alias("win"),
                    TL.label_column(won, False).alias("win_unlabelled"),
                    TL.category_indicator(F.col("o_orderpriority"), "1-URGENT").alias("cat"),
                    TL.category_indicator(F.col("o_orderpriority"), "1-urgent",
                                          case_sensitive=False).alias("cat_ci"))


@register("status_nullif")
def q_status_nullif(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", TL.status_value(F.col("o_orderpriority"), "5-LOW")
                    .alias("status"))


# --- D: feature flattening -------------------------------------------------


def orders_t(spark, sf_dir):
    return table(spark, sf_dir, "orders")


def _safe(v: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in v)


@register("roster_slots_padded")
def q_roster_slots(spark, sf_dir):
    ranked = FT.ranked_roster(roster(spark, sf_dir), "l_orderkey", LINE_ORDER)
    slots = orders_t(spark, sf_dir).select(
        "o_orderkey", F.explode(F.sequence(F.lit(1), F.lit(6))).alias("slot"))
    r = ranked.select(F.col("l_orderkey").alias("o_orderkey"), "slot",
                      (F.lit(1.0) - F.col("l_discount")).alias("hp"), *FT.STAT_COLS)
    j = slots.join(r, ["o_orderkey", "slot"], "left")
    return j.select("o_orderkey", F.col("slot").cast("int").alias("slot"),
                    F.col("hp").isNotNull().cast("int").alias("present"),
                    *[_r(F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias(c)
                      for c in ["hp"] + FT.STAT_COLS])


@register("roster_stat_boost_block")
def q_adversary_block(spark, sf_dir):
    adv = FT.relational_adversary(orders_t(spark, sf_dir), roster(spark, sf_dir),
                                  "l_orderkey", LINE_ORDER)
    return adv.select("o_orderkey",
                      _r(F.col("adv")[0]).alias("adv_alive"),
                      _r(F.col("adv")[1]).alias("adv_discovered_alive"),
                      _r(F.col("adv")[2]).alias("adv_leader"),
                      F.lit(0.0).alias("boost_total"))


@register("one_hot_status")
def q_one_hot_status(spark, sf_dir):
    from ..functions.onehot import one_hot
    o = orders_t(spark, sf_dir)
    cols = one_hot(F.col("o_orderpriority"), FT.PRIORITY_VOCAB)
    return o.select("o_orderkey", *[c.alias("status_" + _safe(v))
                                    for c, v in zip(cols, FT.PRIORITY_VOCAB)])


@register("multi_hot_effects")
def q_multi_hot(spark, sf_dir):
    from ..functions.onehot import multi_hot
    # a set of at most as many entries as there are event types
    seen = events(spark, sf_dir).groupBy("user_id").agg(F.collect_set("event_type").alias("effects"))
    hot = multi_hot(F.col("effects"), EVENT_ROSTER)
    return seen.select("user_id", *[c.alias("effect_" + v) for c, v in zip(hot, EVENT_ROSTER, strict=True)])


@register("dual_type_one_hot")
def q_dual_type(spark, sf_dir):
    from ..functions.onehot import one_hot, substring_hot
    p = table(spark, sf_dir, "part")
    t1 = substring_hot(F.col("p_type"), FT.PART_TYPE_VOCAB)
    t2 = substring_hot(F.col("p_brand"), FT.BRAND_VOCAB)
    exact = one_hot(F.col("p_brand"), FT.BRAND_VOCAB)
    return p.select("p_partkey",
                    *[c.alias("type1_" + _safe(v)) for c, v in zip(t1, FT.PART_TYPE_VOCAB)],
                    *[c.alias("type2_" + _safe(v)) for c, v in zip(t2, FT.BRAND_VOCAB)],
                    sum(exact, F.lit(0.0)).alias("type2_exact_hits"))


@register("adversary_presence")
def q_adversary_presence(spark, sf_dir):
    ev = events(spark, sf_dir).where(has_move())
    return ev.groupBy("user_id").agg(
        *[F.lit(0.0).alias("adv_type_obs_" + v) for v in EVENT_ROSTER],
        *[F.max((F.col("event_type") == v).cast("double")).alias("adv_type_" + v)
          for v in EVENT_ROSTER])


@register("feature_vector_long")
def q_feature_long(spark, sf_dir):
    out = FT.sparse_feature_long(orders_t(spark, sf_dir), roster(spark, sf_dir),
                                 "l_orderkey", LINE_ORDER)
    return out.select("o_orderkey", "position", _r("value").alias("value"))


# --- K: team summaries ------------------------------------------------------

@register("team_means")
def q_team_means(spark, sf_dir):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "p_size"]
    out = FT.team_means(roster(spark, sf_dir), "l_orderkey", cols)
    return out.select("l_orderkey", *[_r("mean_" + c).alias("mean_" + c) for c in cols])


@register("type_coverage")
def q_type_coverage(spark, sf_dir):
    return FT.type_coverage(roster(spark, sf_dir), "l_orderkey", ["p_type", "p_brand"])


@register("mean_power")
def q_mean_power(spark, sf_dir):
    mv = events(spark, sf_dir).where(has_move()).select("user_id", event_move().alias("power"))
    out = FT.mean_power(mv, "user_id", "power")
    return out.select("user_id", _r("mean_power").alias("mean_power"))


@register("status_member_count")
def q_status_members(spark, sf_dir):
    return FT.status_member_count(roster(spark, sf_dir), "l_orderkey", "p_name",
                                  F.col("l_returnflag") == "R")


@register("team_difference")
def q_team_difference(spark, sf_dir):
    r = roster(spark, sf_dir)
    cols = ["l_quantity", "l_extendedprice"]
    a = FT.team_means(r.where(F.col("l_linestatus") == "O"), "l_orderkey", cols)
    b = FT.team_means(r.where(F.col("l_linestatus") == "F"), "l_orderkey", cols)
    out = FT.team_difference(a, b, "l_orderkey", ["mean_" + c for c in cols])
    return out.select("l_orderkey", *[_r("diff_mean_" + c).alias("diff_" + c) for c in cols])


@register("extreme_member")
def q_extreme_member(spark, sf_dir):
    return FT.extreme_member(roster(spark, sf_dir), "l_orderkey", "p_name", "p_size", LINE_ORDER)


# --- E: counts, weights, encodings -----------------------------------------


CONTENT_FIELDS = ["p_brand", "p_type"]


def part_counts(spark, sf_dir) -> DataFrame:
    return WT.content_count(table(spark, sf_dir, "part"), CONTENT_FIELDS, position="p_partkey")


@register("content_count")
def q_content_count(spark, sf_dir):
    return part_counts(spark, sf_dir).select("key", "count")


@register("first_seen_record")
def q_first_seen(spark, sf_dir):
    return WT.first_seen(table(spark, sf_dir, "part"), CONTENT_FIELDS, "p_partkey",
                         ["p_name", "p_size", "p_retailprice"])


@register("attribute_table")
def q_attribute_table(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(
        "p_brand", "p_type", "p_partkey", F.col("p_size").alias("base_size"),
        F.col("p_retailprice").alias("retailprice"), F.array("p_type").alias("types"))
    first = WT.first_seen(p, CONTENT_FIELDS, "p_partkey", ["base_size", "retailprice", "types"])
    return WT.attribute_table(first, ["size", "retailprice", "type_SMALL", "type_PROMO", "colour"],
                              types_col="types")


@register("class_frequency")
def q_class_frequency(spark, sf_dir):
    counts = WT.content_count(table(spark, sf_dir, "part"), ["p_brand"])
    out = WT.normalise_counts(counts, "inverse_frequency")
    return out.select("key", "count", _r("freq").alias("freq"))


@register("class_counts")
def q_class_counts(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return WT.class_counts(o, F.col("o_orderstatus") == "F")


@register("roster_counts")
def q_roster_counts(spark, sf_dir):
    r = roster(spark, sf_dir)
    return r.agg(F.count(F.lit(1)).cast("long").alias("members"),
                 F.count_distinct("l_orderkey").cast("long").alias("matches"))


def _weights_query(method):
    def q(spark, sf_dir):
        out = WT.normalise_counts(part_counts(spark, sf_dir), method)
        return out.select("key", "count", _r("weight").alias("weight"), _r("freq").alias("freq"))
    return q


for _m, _name in [("inverse_frequency", "weights_inverse"), ("sqrt_inverse", "weights_sqrt"),
                  ("log_inverse", "weights_log"), ("min_max", "weights_minmax"),
                  ("z_score", "weights_zscore")]:
    register(_name)(_weights_query(_m))


@register("attach_weights")
def q_attach_weights(spark, sf_dir):
    w = WT.normalise_counts(part_counts(spark, sf_dir), "sqrt_inverse")
    members = roster(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", *CONTENT_FIELDS)
    out = WT.attach_weights(members, w, CONTENT_FIELDS)
    return out.select("l_orderkey", "l_linenumber", "l_partkey",
                      _r("sample_weight").alias("sample_weight"))


@register("weight_method_comparison")
def q_weight_comparison(spark, sf_dir):
    out = WT.method_comparison(part_counts(spark, sf_dir))
    return out.select("method", "most_key", "least_key", _r("most_weight").alias("most_weight"),
                      _r("least_weight").alias("least_weight"), _r("ratio").alias("ratio"))


def encoding_rows(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                               "o_orderstatus")
    return roster(spark, sf_dir).join(o, "l_orderkey")


def modular_fold(k: int = 5) -> Column:
    """Fold from an integer key, so SQL can state it too."""
    return F.pmod(F.col("l_orderkey") * 31 + F.col("l_linenumber"), F.lit(k)).cast("int")


def target_codes(spark, sf_dir) -> DataFrame:
    return WT.kfold_target_encoding(encoding_rows(spark, sf_dir), "p_name",
                                    F.col("o_orderstatus") == "F", modular_fold())


@register("kfold_target_encoding")
def q_kfold(spark, sf_dir):
    return target_codes(spark, sf_dir).select("name", _r("encoding").alias("encoding"), "n")


@register("member_code_mean")
def q_member_code_mean(spark, sf_dir):
    codes = target_codes(spark, sf_dir).select(F.col("name").alias("p_name"), "encoding")
    out = FT.member_code_mean(roster(spark, sf_dir), codes, "l_orderkey", "p_name")
    return out.select("l_orderkey", _r("member_code_mean").alias("member_code_mean"))


@register("distinct_field_values")
def q_distinct_fields(spark, sf_dir):
    ev = events(spark, sf_dir).select(
        F.struct(F.col("event_type").alias("kind"), F.col("value").alias("hp")).alias("p1_state"),
        F.from_json("props", "k bigint").alias("p2_state"))
    return WT.distinct_field_values(ev, ["p1_state", "p2_state"], "k")


# --- H8 / I / J: thresholds, evaluation tables, run diff --------------------


def scored_docs(spark, sf_dir) -> DataFrame:
    """``doc_id, y, p``: quality label and a score with exact decimal steps."""
    lab = table(spark, sf_dir, "labels")
    doc = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return lab.join(doc, "doc_id").select(
        "doc_id", F.col("quality").cast("int").alias("y"),
        (F.pmod(F.col("n_chars"), F.lit(SCORE_MODULUS)) / F.lit(float(SCORE_MODULUS))).alias("p"))


@register("threshold_predictions")
def q_threshold_predictions(spark, sf_dir):
    s = scored_docs(spark, sf_dir)
    return s.select("doc_id", _r("p").alias("p"), EV.predict_at(F.col("p"), 0.485).alias("yhat"))


@register("accuracy")
def q_accuracy(spark, sf_dir):
    s = scored_docs(spark, sf_dir).withColumn("yhat", EV.predict_at(F.col("p"), 0.485))
    out = EV.accuracy(s, "y", "yhat")
    return out.select(_r("accuracy").alias("accuracy"), _r("positive_rate").alias("positive_rate"), "n")


@register("confusion_matrix")
def q_confusion(spark, sf_dir):
    s = scored_docs(spark, sf_dir).withColumn("yhat", EV.predict_at(F.col("p"), 0.485))
    out = EV.confusion_matrix(s, "y", "yhat")
    return out.select("y", "yhat", "n", _r("row_pct").alias("row_pct"))


@register("roc_points")
def q_roc_points(spark, sf_dir):
    out = EV.roc_points(scored_docs(spark, sf_dir), "y", "p")
    return out.select(_r("threshold").alias("threshold"), _r("fpr").alias("fpr"), _r("tpr").alias("tpr"))


@register("roc_auc")
def q_roc_auc(spark, sf_dir):
    return EV.roc_auc(scored_docs(spark, sf_dir), "y", "p").select(_r("roc_auc").alias("roc_auc"))


@register("pr_points")
def q_pr_points(spark, sf_dir):
    out = EV.pr_points(scored_docs(spark, sf_dir), "y", "p")
    return out.select(_r("threshold").alias("threshold"), _r("precision").alias("precision"),
                      _r("recall").alias("recall"))


@register("average_precision")
def q_average_precision(spark, sf_dir):
    out = EV.average_precision(scored_docs(spark, sf_dir), "y", "p")
    return out.select(_r("average_precision").alias("average_precision"))


@register("score_histogram")
def q_histogram(spark, sf_dir):
    out = EV.score_histogram(scored_docs(spark, sf_dir), "y", "p")
    return out.select("y", "bin", "count", _r("bin_start").alias("bin_start"),
                      _r("density").alias("density"))


@register("threshold_sweep")
def q_sweep(spark, sf_dir):
    out = EV.threshold_sweep(scored_docs(spark, sf_dir), "y", "p")
    return out.select("i", _r("threshold").alias("threshold"), _r("accuracy").alias("accuracy"),
                      _r("precision").alias("precision"), _r("recall").alias("recall"),
                      _r("f1").alias("f1"))


@register("best_threshold")
def q_best_threshold(spark, sf_dir):
    out = EV.best_threshold(EV.threshold_sweep(scored_docs(spark, sf_dir), "y", "p"))
    return out.select(_r("threshold").alias("threshold"), _r("accuracy").alias("accuracy"))


# --- F / G / H: transforms, split, selection, learners ---------------------


LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def embedding_frame(spark, sf_dir) -> DataFrame:
    """``vec_id, label, features`` (label = ``label < 5``; floats widened)."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", (F.col("label") < 5).cast("double").alias("label"),
                    array_to_vector(F.transform("embedding", lambda x: x.cast("double")))
                    .alias("features"))


def lineitem_frame(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     (F.col("l_returnflag") == "R").cast("double").alias("label"),
                     array_to_vector(F.array(*[F.col(c).cast("double") for c in LINE_FEATURES]))
                     .alias("features"))


def _long(df, id_cols, col, name):
    return df.select(*id_cols, F.posexplode(vector_to_array(col)).alias("dim", name)) \
             .select(*id_cols, F.col("dim").cast("int").alias("dim"), _r(name).alias(name))


@register("standardise_exact")
def q_standardise(spark, sf_dir):
    e = embedding_frame(spark, sf_dir)
    m = TR.fit_exact_scaler(e, "features", "scaled")
    return _long(m.transform(e), ["vec_id"], "scaled", "z")


@register("mean_centre")
def q_mean_centre(spark, sf_dir):
    e = embedding_frame(spark, sf_dir)
    m = TR.fit_exact_scaler(e, "features", "centred", with_std=False)
    return _long(m.transform(e), ["vec_id"], "centred", "c")


@register("standardise_exact_lineitem")
def q_standardise_lineitem(spark, sf_dir):
    li = lineitem_frame(spark, sf_dir)
    m = TR.fit_exact_scaler(li, "features", "scaled")
    return _long(m.transform(li), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
                 "scaled", "z")


EMB_NAMES = [f"emb_{i}" for i in range(64)]


def _pca(spark, sf_dir, k=10):
    e = embedding_frame(spark, sf_dir)
    sc = TR.fit_exact_scaler(e, "features", "scaled")
    z = sc.transform(e)
    return z, TR.fit_pca(z, "scaled", k)


@register("pca_variance_ratio")
def q_pca_ratio(spark, sf_dir):
    _, m = _pca(spark, sf_dir)
    return TR.variance_table(spark, m)


@register("pca_projection")
def q_pca_projection(spark, sf_dir):
    z, m = _pca(spark, sf_dir)
    return TR.projection_2d(m, z, "vec_id", "label")


@register("pca_top_loadings")
def q_pca_top(spark, sf_dir):
    _, m = _pca(spark, sf_dir)
    return TR.top_contributors(spark, m, EMB_NAMES)


@register("pca_loadings")
def q_pca_loadings(spark, sf_dir):
    _, m = _pca(spark, sf_dir)
    return TR.loadings_table(spark, m, EMB_NAMES)


def modular_hash(col: str, mult: int, mod: int) -> Column:
    """An integer hash SQL can state as well (keeps values small, no overflow)."""
    return F.pmod(F.col(col) * F.lit(mult), F.lit(mod))


@register("hash_split")
def q_hash_split(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    out = SP.hash_split(o, ["o_orderkey"], 0.15, hash_col=modular_hash("o_orderkey", 7919, 1_000_000))
    return out.select("o_orderkey", "is_test")


@register("exact_split")
def q_exact_split(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    out = SP.exact_split(o, ["o_orderkey"], 0.15, hash_col=modular_hash("o_orderkey", 7919, 1000))
    return out.select("o_orderkey", "is_test")


LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _line_hash() -> Column:
    return F.pmod(F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729 + F.col("l_partkey") * 31, F.lit(100003))


@register("exact_folds")
def q_exact_folds(spark, sf_dir):
    """E17 over the exploded rows: equal folds of all lines."""
    return SP.exact_folds(table(spark, sf_dir, "lineitem").select(*LINE_KEY), LINE_KEY, 5, hash_col=_line_hash())


@register("exact_fold_encoding")
def q_exact_fold_encoding(spark, sf_dir):
    """E14 with the equal folds; names that one fold holds alone get the
    global mean (E15)."""
    rows = SP.exact_folds(table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_linestatus"), LINE_KEY, 5, hash_col=_line_hash())
    rows = rows.withColumn("name", F.concat_ws("/", "l_partkey", "l_suppkey"))
    out = WT.kfold_target_encoding(rows, "name", F.col("l_linestatus") == "F", F.col("fold"))
    return out.select("name", _r("encoding").alias("encoding"), "n")


def _train_part(df: DataFrame, key: str, fraction: float = 0.15) -> tuple[DataFrame, DataFrame]:
    s = SP.hash_split(df, [key], fraction)
    return s.where(~F.col("is_test")).drop("is_test"), s.where(F.col("is_test")).drop("is_test")


@register("feature_selection")
def q_feature_selection(spark, sf_dir):
    train, _ = _train_part(embedding_frame(spark, sf_dir), "vec_id")
    slicer, idx, model = SP.select_top_features(train)
    imp = model.featureImportances.toArray()
    rows = [(r + 1, int(i), EMB_NAMES[i], float(imp[i])) for r, i in enumerate(idx)]
    return spark.createDataFrame(rows, "rank int, index int, feature string, importance double")


def _score(model_out: DataFrame, prob: Column, threshold: float, id_col: str = "vec_id"):
    return model_out.select(id_col, prob.alias("probability"),
                            EV.predict_at(prob, threshold).alias("prediction"))


@register("logreg_scores")
def q_logreg(spark, sf_dir):
    e = embedding_frame(spark, sf_dir)
    train, _ = _train_part(e, "vec_id")
    n = train.count()
    m = MD.logistic(n).fit(train)
    return _score(m.transform(e), MD.positive_probability("lr_probability"), 0.485)


@register("logreg_scores_lineitem")
def q_logreg_lineitem(spark, sf_dir):
    li = lineitem_frame(spark, sf_dir)
    # several passes (scaler statistics, solver iterations) read the same
    # assembled vectors: keep them for the fitting section only
    cached = li.persist()
    try:
        sc = TR.fit_exact_scaler(cached, "features", "scaled")
        train, _ = _train_part(sc.transform(cached), "l_orderkey")
        n = train.count()
        m = MD.logistic(n, features_col="scaled").fit(train)
    finally:
        cached.unpersist()
    out = m.transform(sc.transform(li))
    p = MD.positive_probability("lr_probability")
    return out.select("l_orderkey", "l_linenumber", p.alias("probability"),
                      EV.predict_at(p, 0.485).alias("prediction"))


@register("forest_scores")
def q_forest(spark, sf_dir):
    e = embedding_frame(spark, sf_dir)
    train, _ = _train_part(e, "vec_id")
    m = MD.random_forest().fit(train)
    return _score(m.transform(e), MD.positive_probability("rf_probability"), 0.45)


@register("single_forest_scores")
def q_single_forest(spark, sf_dir):
    e = embedding_frame(spark, sf_dir)
    train, _ = _train_part(e, "vec_id")
    m = MD.fit_forest_parts(train, max_depth=20, min_instances=2)
    return _score(m.transform(e), F.col("rf_p1"), 0.5)


@register("random_cut_scores")
def q_random_cut(spark, sf_dir):
    e = embedding_frame(spark, sf_dir)
    train, _ = _train_part(e, "vec_id")
    m = MD.RandomCutForest().fit(train)
    return _score(m.transform(e), F.col("et_p1"), 0.45)


@register("gbt_scores")
def q_gbt(spark, sf_dir):
    e = embedding_frame(spark, sf_dir)
    train, _ = _train_part(e, "vec_id")
    m = HT.gradient_booster().fit(train)
    return _score(m.transform(e), F.col("gbt_p1"), 0.45)


@register("regularised_boost_scores")
def q_xgb(spark, sf_dir):
    e = embedding_frame(spark, sf_dir)
    train, _ = _train_part(e, "vec_id")
    m = HT.regularised_booster().fit(train)
    return _score(m.transform(e), F.col("xgb_p1"), 0.45)


@register("extra_trees_scores")
def q_extra_trees(spark, sf_dir):
    e = embedding_frame(spark, sf_dir)
    train, _ = _train_part(e, "vec_id")
    m = RT.ExtraTrees().fit(train)
    return _score(m.transform(e), F.col("et_p1"), 0.45)


def _line_steps(spark, sf_dir) -> DataFrame:
    """Line features with few distinct values: every value is a bin."""
    li = table(spark, sf_dir, "lineitem")
    return li.select((F.col("l_returnflag") == "R").cast("double").alias("label"), array_to_vector(F.array(
        *[F.col(c).cast("double") for c in ("l_quantity", "l_discount", "l_tax", "l_linenumber")])).alias("features"))


@register("boost_split_gains")
def q_boost_split_gains(spark, sf_dir):
    out = HT.root_gains(_line_steps(spark, sf_dir), HT.Criterion())
    return out.select("feature", _r("border").alias("border"), _r("gl", 4).alias("gl"), _r("hl", 4).alias("hl"), "nl", _r("gain", 4).alias("gain"))


@register("gradient_split_gains")
def q_gradient_split_gains(spark, sf_dir):
    out = HT.root_gains(_line_steps(spark, sf_dir), HT.Criterion("friedman"))
    return out.select("feature", _r("border").alias("border"), _r("gl", 4).alias("gl"), "nl", _r("gain", 4).alias("gain"))


@register("extra_tree_splits")
def q_extra_tree_splits(spark, sf_dir):
    out = RT.root_candidates(_line_steps(spark, sf_dir), trees=24)
    return out.select("tree", "feature", "low", "high", _r("threshold").alias("threshold"), "n_left", "pos_left", _r("gain", 4).alias("gain"))


@register("regularised_gbt_scores")
def q_xgb_gbt(spark, sf_dir):
    e = embedding_frame(spark, sf_dir)
    train, _ = _train_part(e, "vec_id")
    m = MD.regularised_gbt().fit(train)
    return _score(m.transform(e), MD.positive_probability("xgb_probability"), 0.45)


def _ensemble(spark, sf_dir):
    e = embedding_frame(spark, sf_dir)
    train, _ = _train_part(e, "vec_id")
    members = [("rf", MD.random_forest()),
               ("et", RT.ExtraTrees()),
               ("gbt", HT.gradient_booster()),
               ("xgb", HT.regularised_booster())]
    return e, MD.fit_soft_vote(train, members, threshold=0.45)


@register("soft_vote_scores")
def q_soft_vote(spark, sf_dir):
    e, vote = _ensemble(spark, sf_dir)
    out = vote.transform(e)
    return out.select("vec_id", "rf_p1", "et_p1", "gbt_p1", "xgb_p1", "probability", "prediction")


@register("soft_vote_mean")
def q_soft_vote_mean(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    p = {"a": F.col("l_discount") * 10.0, "b": F.col("l_tax") * 12.5, "c": F.col("l_quantity") / 50.0}
    li = li.select("l_orderkey", "l_linenumber", "l_partkey", *[c.alias(f"{n}_p1") for n, c in p.items()])
    out = MD.vote(li, [f"{n}_p1" for n in p], 0.45, digits=9)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", _r("probability").alias("probability"), "prediction")


@register("importance_topn")
def q_importance_topn(spark, sf_dir):
    train, _ = _train_part(embedding_frame(spark, sf_dir), "vec_id")
    m = MD.random_forest().fit(train)
    return EV.importance_table(spark, m.featureImportances.toArray(), EMB_NAMES, top_n=20)


@register("importance_mean")
def q_importance_mean(spark, sf_dir):
    train, _ = _train_part(embedding_frame(spark, sf_dir), "vec_id")
    slicer, idx, _ = SP.select_top_features(train)
    sel = slicer.transform(train)
    members = [MD.random_forest(features_col="selected", prefix="a").fit(sel),
               MD.gbt(features_col="selected", prefix="b").fit(sel)]
    mean, labels = EV.mean_importance([m.featureImportances.toArray() for m in members],
                                      idx, EMB_NAMES)
    return EV.importance_table(spark, mean, labels, top_n=20)


# --- A / B / J: sources, nested projection, scoring, runs -------------------


@register("json_field_project")
def q_json_field(spark, sf_dir):
    ev = events(spark, sf_dir)
    parsed = ev.select("event_id", F.from_json("props", "k bigint").alias("rec"))
    return parsed.select("event_id", F.col("rec.k").alias("k"))


@register("nested_path_explode")
def q_nested_explode(spark, sf_dir):
    ev = events(spark, sf_dir).select("event_id", F.map_entries(F.from_json("props", "map<string,bigint>")).alias("m"))
    return NS.unnest(ev, "m", keep=["event_id"]).select("event_id", "member.key", "member.value")


@register("default_weight_projection")
def q_default_weight(spark, sf_dir):
    r = roster(spark, sf_dir).withColumn("types", F.array("p_type", "p_brand"))
    r = NS.non_empty_names(r, "p_name")
    return NS.named_projection(r, ["l_orderkey", "l_linenumber", "l_quantity", "p_size",
                                   "type_SMALL", "type_Brand#13"])


@register("numeric_projection")
def q_numeric_projection(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return NS.numeric_projection(li, ["l_orderkey", "l_partkey", "l_suppkey"])


def json_lines(df, line: Column, name: str) -> str:
    """Writes ``line`` as text files below the shared folder; their path."""
    path = scratch_path(df.sparkSession, name)
    df.select(line.alias("value")).write.text(path)
    return path


def _event_lines(spark, sf_dir) -> tuple[DataFrame, T.StructType]:
    """Lines of the events in order: signups come without the field, errors
    as log lines that are no JSON, and each view is followed by a blank line."""
    k = F.get_json_object("props", "$.k").cast("long")
    line = (F.when(F.col("event_type") == "error", F.concat(F.lit("error in event "), F.col("event_id").cast("string")))
             .when(F.col("event_type") == "signup", F.to_json(F.struct("event_id")))
             .when(F.col("event_type") == "view", F.concat(F.to_json(F.struct("event_id", k.alias("k"))), F.lit("\n")))
             .otherwise(F.to_json(F.struct("event_id", k.alias("k")))))
    ordered = events(spark, sf_dir).repartitionByRange("event_id").sortWithinPartitions("event_id")
    return json_lines(ordered, line, "event-lines"), T.StructType([T.StructField("event_id", T.LongType()), T.StructField("k", T.LongType())])


@register("malformed_record_report")
def q_malformed(spark, sf_dir):
    """A3 and A12 over real lines."""
    path, schema = _event_lines(spark, sf_dir)
    good, bad = LG.read_with_rejects(spark, path, schema)
    _, lacking = LG.require_fields(good, ["k"], id_col="event_id")
    damaged = bad.select(F.regexp_extract("record", "([0-9]+)$", 1).cast("long").alias("event_id"),
                         F.lit("malformed record").alias("reason"))
    return damaged.unionByName(lacking)


@register("malformed_line_numbers")
def q_malformed_lines(spark, sf_dir):
    """A3: the line of each malformed record, counted through the files in
    order (each file's lines follow those of the files before)."""
    path, schema = _event_lines(spark, sf_dir)
    _, bad = LG.read_with_rejects(spark, path, schema)
    sizes = LG.numbered_lines(spark, path).groupBy("_file").agg(F.max("line").alias("lines"))
    before = sizes.select("_file", F.coalesce(F.sum("lines").over(
        Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))  # one row a file
    return bad.join(F.broadcast(before), "_file").select(
        F.regexp_extract("record", "([0-9]+)$", 1).cast("long").alias("event_id"), (F.col("before") + F.col("line")).alias("line"))


@register("position_identity")
def q_position_identity(spark, sf_dir):
    """A5 over lines without keys: files in order of the order key."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    o = o.repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey")
    path = json_lines(o, F.to_json(F.struct("o_orderkey")), "order-lines")
    schema = T.StructType([T.StructField("battle_id", T.LongType()), T.StructField("o_orderkey", T.LongType())])
    return LG.with_position_id(LG.read_match_logs(spark, path, schema)).select("o_orderkey", "battle_id")


@register("row_identity")
def q_row_identity(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    out = with_row_index(o, ["o_orderdate", "o_orderkey"], "battle_id")
    return out.select("o_orderkey", "battle_id")


@register("prediction_diff")
def q_prediction_diff(spark, sf_dir):
    s = scored_docs(spark, sf_dir)
    prev = s.select(F.col("doc_id").alias("battle_id"),
                    EV.predict_at(F.col("p"), 0.5).alias("player_won"))
    cur = s.select(F.col("doc_id").alias("battle_id"),
                   EV.predict_at(F.col("p"), 0.485).alias("player_won"))
    out = SC.prediction_diff(prev, cur)
    return out.select("compared", "differing", _r("diff_pct").alias("diff_pct"))


@register("csv_roundtrip")
def q_csv_roundtrip(spark, sf_dir):
    s = scored_docs(spark, sf_dir).select(F.col("doc_id").alias("battle_id"),
                                          EV.predict_at(F.col("p"), 0.485).alias("prediction"))
    path = scratch_path(spark, "predictions")
    SK.write_predictions(s, path)
    return SK.read_predictions(spark, path)


@register("model_roundtrip")
def q_model_roundtrip(spark, sf_dir):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegressionModel
    from pyspark.ml.feature import PCAModel
    e = embedding_frame(spark, sf_dir)
    scaler = TR.fit_exact_scaler(e, "features", "scaled")
    z = scaler.transform(e)
    pca = TR.fit_pca(z, "scaled", 10)
    lr = MD.logistic(z.count(), features_col="pca")
    model = Pipeline(stages=[scaler, pca, lr]).fit(e)
    root = scratch_path(spark, "models")
    SK.save_run(spark, model, root, "model", {"n_components": 10, "C": 1.0})
    SK.save_run(spark, model, root, "model", {"n_components": 10, "C": 1.0})
    n, loaded = SK.load_latest(spark, root, "model")
    SK.check_package(loaded, {"pca": PCAModel, "model": LogisticRegressionModel})
    return SC.score(loaded, e, "lr_probability", 0.485, id_col="vec_id") \
             .withColumn("run", F.lit(n))


@register("runs_latest")
def q_runs_latest(spark, sf_dir):
    acc = q_accuracy(spark, sf_dir).first()
    root = scratch_path(spark, "runs")
    SK.append_run_record(spark, root, "model", 1, {"accuracy": acc["accuracy"], "n": acc["n"]})
    SK.append_run_record(spark, root, "model", 2, {"accuracy": acc["accuracy"], "n": acc["n"],
                                                   "diff_pct": 0.0, "previous_run": 1})
    return SK.latest_run_record(spark, root, "model")


# --- K6-K8, K12, K13, K16, K17 ---------------------------------------------

def event_status() -> Column:
    """Status analogue of an event turn: 'psn' when value >= 100."""
    return F.when(F.col("value") >= 100.0, F.lit("psn")).otherwise(F.lit("nostatus"))


@register("damage_total")
def q_damage(spark, sf_dir):
    out = TL.damage_total(events(spark, sf_dir), "user_id", "event_type", EVENT_ORDER, "value")
    return out.select("user_id", _r("damage").alias("damage"))


@register("switch_and_ko")
def q_switch_ko(spark, sf_dir):
    return TL.switches_and_knockouts(events(spark, sf_dir), "user_id", EVENT_ORDER,
                                     "event_type", event_fainted())


@register("status_inflictions")
def q_inflictions(spark, sf_dir):
    return TL.status_inflictions(events(spark, sf_dir), "user_id", EVENT_ORDER, event_status())


@register("matchup_join")
def q_matchup(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    sup = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"),
                                                  F.col("s_nationkey").alias("n_nationkey"))
    chart = table(spark, sf_dir, "nation").select(
        "n_nationkey", ((F.col("n_regionkey") + 1) / 5.0).alias("multiplier"))
    members = li.join(sup, "l_suppkey")
    out = FT.matchup_join(members, chart, "l_orderkey", "n_nationkey", "multiplier")
    return out.select("l_orderkey", _r("mean_multiplier").alias("mean_multiplier"), "charted_members")


@register("stacked_scores")
def q_stacked(spark, sf_dir):
    e = embedding_frame(spark, sf_dir)
    members = [("rf", MD.random_forest()), ("gbt", MD.gbt())]
    from ..operators.weights import hash_fold
    return MD.stacked_scores(e, members, hash_fold(["vec_id"], 3), 3, "vec_id")


@register("tuned_scores")
def q_tuned(spark, sf_dir):
    from ..operators.weights import hash_fold
    e = embedding_frame(spark, sf_dir).withColumn("fold", hash_fold(["vec_id"], 3))
    cv = MD.tuned_logistic(e, "fold", [0.001, 0.01, 0.1])
    out = cv.bestModel.transform(e)
    p = MD.positive_probability("lr_probability")
    return out.select("vec_id", p.alias("probability"), EV.predict_at(p, 0.485).alias("prediction"))


@register("booster_trials")
def q_booster_trials(spark, sf_dir):
    """Depth and rate of the regularised booster by successive halving."""
    train, valid = _train_part(embedding_frame(spark, sf_dir), "vec_id")
    boosters = [HT.regularised_booster(max_depth=d, eta=e) for d in (2, 4) for e in (0.03, 0.1)]
    trials, _ = HT.halving(train, valid, boosters, first=4, rungs=3)
    return trials


@register("weighted_scores")
def q_weighted(spark, sf_dir):
    e = embedding_frame(spark, sf_dir)
    counts = WT.content_count(e, ["label"])
    w = WT.normalise_counts(counts, "sqrt_inverse")
    e = WT.attach_weights(e, w, ["label"], weight_col="w")
    m = MD.logistic(e.count(), weight_col="w").fit(e)
    p = MD.positive_probability("lr_probability")
    return m.transform(e).select("vec_id", "w", p.alias("probability"),
                                 EV.predict_at(p, 0.485).alias("prediction"))


# --- full pipelines on the relational match vectors (J1/J2 analogues) ------

def order_vectors(spark, sf_dir) -> DataFrame:
    """D12 dense form: one fixed-width vector per order (label = status F)."""
    return FT.relational_feature_vectors(orders_t(spark, sf_dir), roster(spark, sf_dir),
                                         "l_orderkey", LINE_ORDER,
                                         F.col("o_orderstatus") == "F")


@register("order_feature_vectors")
def q_order_vectors(spark, sf_dir):
    v = order_vectors(spark, sf_dir)
    arr = vector_to_array("features")
    return v.select("o_orderkey", "label", F.size(arr).alias("width"),
                    F.size(F.filter(arr, lambda x: x != 0.0)).alias("nonzero"),
                    F.round(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x), 3).alias("total"))


def written_order_vectors(spark, sf_dir) -> DataFrame:
    """``order_vectors``, sparse where that is shorter, written to the shared
    folder once: fitting and scoring read them there, the joins behind them
    run once.  Most of a vector is zeros of one-hot blocks and empty slots."""
    from pyspark.ml.feature import VectorAssembler
    short = VectorAssembler(inputCols=["features"], outputCol="_short", handleInvalid="keep")
    v = short.transform(order_vectors(spark, sf_dir)).select("o_orderkey", "label", F.col("_short").alias("features"))
    path = scratch_path(spark, "order-vectors")
    v.write.parquet(path)
    return spark.read.schema(v.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """At least two parts a core."""
    want = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= want else df.repartition(want)


@register("orders_linear_scores")
def q_orders_linear(spark, sf_dir):
    """J1 shape: hold-out split -> exact scaler -> PCA -> logistic -> p >= t."""
    v = written_order_vectors(spark, sf_dir)
    cached, _ = _train_part(v, "o_orderkey")  # in the shared folder, not in memory
    n = cached.count()
    sc = TR.fit_exact_scaler(cached, "features", "scaled")
    pca = TR.fit_pca(sc.transform(cached), "scaled", 200, output_col="pca", rows=n)
    # the solver reads the short vectors: rows of 200 components are not kept
    lr = LI.fit_on_map(MD.logistic(n, features_col="pca"), cached, LI.LinearMap.of(sc, pca))
    model = lr.transform(pca.transform(sc.transform(v)))
    p = MD.positive_probability("lr_probability")
    return model.select("o_orderkey", "label", p.alias("probability"),
                                     EV.predict_at(p, 0.485).alias("prediction"))


@register("orders_ensemble_scores")
def q_orders_ensemble(spark, sf_dir):
    """J2 shape: scaler -> top-n selection -> soft vote of four members."""
    from pyspark.ml import PipelineModel
    v = written_order_vectors(spark, sf_dir)
    train, _ = _train_part(v, "o_orderkey")
    # short vectors are few splits; the members' passes keep every core busy
    cached = spread(train).persist()
    try:
        sc = TR.fit_exact_scaler(cached, "features", "scaled")
        z = sc.transform(cached)
        slicer, idx, _ = SP.select_top_features(z, "scaled")
        prep = PipelineModel(stages=[sc, slicer])
        members = [("rf", MD.random_forest(features_col="selected")),
                   ("et", RT.ExtraTrees(features_col="selected")),
                   ("gbt", HT.gradient_booster(features_col="selected")),
                   ("xgb", HT.regularised_booster(features_col="selected"))]
        vote = MD.fit_soft_vote(prep.transform(cached).select("label", "selected"), members, threshold=0.45)
    finally:
        cached.unpersist()
    out = vote.transform(prep.transform(v))
    return out.select("o_orderkey", "label", "probability", "prediction")


# --- streaming form of the flat fold ------------------------------------------

@register("streaming_state_fold")
def q_streaming_state_fold(spark, sf_dir):
    from ..streaming.state_fold import run_state_fold
    out = run_state_fold(spark, sf_dir, "events.parquet", "user_id", EVENT_ORDER,
                         "event_type", "value", EVENT_ROSTER, event_fainted())
    return out.select("user_id", "turns", "alive", "discovered_alive",
                      _r("leader_value").alias("leader_value"),
                      *[_r(f"hp_{m}").alias(f"hp_{m}") for m in EVENT_ROSTER])


from . import certified_queries, nested_queries  # noqa: E402,F401  (register their queries)

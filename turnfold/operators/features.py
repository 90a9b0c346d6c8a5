"""Feature flattening: match state -> fixed-width vector (D1-D13), and the
team-level summaries the original only describes (K1-K5, K10, K11).

Nested form: the 984 values are one expression (``flatten`` of a
``transform`` over the six slots), never 984 ``withColumn`` calls.
Flat form: members are ranked rows; the vector is a sparse long table
``(match, position, value)`` or, per match, a bounded ``collect_list`` of
at most ``roster_size`` member blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.onehot import as_double, multi_hot, one_hot, substring_hot


# ---------------------------------------------------------------------------
# nested form
# ---------------------------------------------------------------------------

def member_block(m: Column, semantics: str = "observed",
                 max_moves: int = S.MAX_MOVES) -> Column:
    """D2-D8 for one member struct (null member -> 159 zeros, D1)."""
    type_hot = substring_hot if semantics == "observed" else one_hot
    vals = [m["hps"]]
    vals += [m["base_stats"][s] for s in S.STAT_ORDER]
    vals += [m["boosts"][s] for s in S.STAT_ORDER]
    vals += one_hot(m["status"], S.STATUS_VOCAB)
    vals += multi_hot(m["effects"], S.EFFECTS_VOCAB)
    vals += type_hot(m["type1"], S.TYPE_VOCAB)
    vals += type_hot(m["type2"], S.TYPE_VOCAB)
    for j in range(1, max_moves + 1):
        mv = F.try_element_at(m["moves"], F.lit(j))
        vals += [mv["base_pwr"], mv["accuracy"], mv["priority"], mv["cat"]]
        vals += one_hot(mv["type"], S.TYPE_VOCAB)
    return F.array(*[as_double(v) for v in vals])


def adversary_block(a: Column) -> Column:
    """Counters, then type and status presence."""
    vals = [a["pkmn_alive"], a["pkmn_dscvrd_alive"], a["hp_leader"]]
    vals += multi_hot(a["types"], S.TYPE_VOCAB)
    vals += multi_hot(a["statuses"], S.STATUS_VOCAB)
    return F.array(*[as_double(v) for v in vals])


def feature_array(team1: str = "team1", team2: str = "team2", semantics: str = "observed",
                  roster_size: int = S.ROSTER_SIZE, max_moves: int = S.MAX_MOVES) -> Column:
    """The ordered 984 doubles of a folded match (extra members dropped,
    missing ones zero-padded)."""
    team = F.col(team1)
    slots = F.transform(F.sequence(F.lit(1), F.lit(roster_size)),
                        lambda s: member_block(F.try_element_at(team, s), semantics, max_moves))
    return F.concat(F.flatten(slots), adversary_block(F.col(team2)))


def feature_metadata(names: Sequence[str]) -> dict:
    """ML attribute metadata so names travel with the vector column."""
    return {"ml_attr": {"attrs": {"numeric": [{"idx": i, "name": n} for i, n in enumerate(names)]},
                        "num_attrs": len(names)}}


def match_features(state: DataFrame, semantics: str = "observed",
                   output: str = "features") -> DataFrame:
    """Folded match states -> ``battle_id, label, features`` (dense vector
    with the 984 feature names attached as column metadata)."""
    names = S.feature_names()
    vec = array_to_vector(feature_array(semantics=semantics))
    return state.select("battle_id", F.col("win").cast("double").alias("label"),
                        vec.alias(output, metadata=feature_metadata(names)))


# ---------------------------------------------------------------------------
# flat form (driver tables): orders x lineitem x part
# ---------------------------------------------------------------------------

# Fixed parameters of the relational layout: member vocabularies
LINE_STATUS_VOCAB = ["O", "F"]
RETURN_FLAG_VOCAB = ["A", "N", "R"]
PART_TYPE_VOCAB = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
BRAND_VOCAB = [f"Brand#{i}" for i in range(1, 10)]      # substring test: Brand#1 is in Brand#12
PRIORITY_VOCAB = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
STAT_COLS = ["l_quantity", "l_extendedprice", "l_tax", "p_size", "p_retailprice", "l_discount"]


def ranked_roster(roster: DataFrame, match: str, order: Sequence[str],
                  roster_size: int = S.ROSTER_SIZE) -> DataFrame:
    """Slot numbers 1..roster_size by the member order; extra members
    dropped.  ``row_number() <= k`` becomes a group limit applied before the
    shuffle, so a huge match contributes only k rows per map task."""
    w = Window.partitionBy(match).orderBy(*[F.col(o) for o in order])
    return roster.withColumn("slot", F.row_number().over(w)).where(F.col("slot") <= roster_size)


def relational_member_block() -> Column:
    """Member block for a lineitem x part row: HP, 6 stats, 6 zero boosts,
    status one-hot, flag multi-hot, substring type one-hot for type and brand."""
    vals = [F.lit(1.0) - F.col("l_discount")]
    vals += [F.col(c) for c in STAT_COLS]
    vals += [F.lit(0.0)] * 6
    vals += one_hot(F.col("l_linestatus"), LINE_STATUS_VOCAB)
    vals += multi_hot(F.array(F.col("l_returnflag")), RETURN_FLAG_VOCAB)
    vals += substring_hot(F.col("p_type"), PART_TYPE_VOCAB)
    vals += substring_hot(F.col("p_brand"), BRAND_VOCAB)
    return F.array(*[as_double(v) for v in vals])


RELATIONAL_MEMBER_WIDTH = 1 + 6 + 6 + len(LINE_STATUS_VOCAB) + len(RETURN_FLAG_VOCAB) \
    + len(PART_TYPE_VOCAB) + len(BRAND_VOCAB)
RELATIONAL_ADVERSARY_WIDTH = 3 + len(PRIORITY_VOCAB)


def relational_adversary(orders: DataFrame, roster: DataFrame, match: str,
                         order: Sequence[str], keep: Sequence[str | Column] = ()) -> DataFrame:
    """Per-match counters (D9 analogue): alive = 6 - #lines, discovered =
    1 + #lines - #returned lines, leader = discount of the last line, then
    priority presence.  Partial aggregation; skew-safe."""
    per = roster.groupBy(F.col(match).alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("l_returnflag") == "R").alias("_r"),
        F.max_by(F.col("l_discount"), F.struct(*[F.col(o) for o in order])).alias("_lead"))
    j = orders.join(per, "o_orderkey", "left")
    n = F.coalesce(F.col("_n"), F.lit(0))
    vals = [F.lit(S.START_ALIVE) - n, F.lit(S.START_DISCOVERED_ALIVE) + n - F.coalesce(F.col("_r"), F.lit(0)),
            F.col("_lead")]
    vals += one_hot(F.col("o_orderpriority"), PRIORITY_VOCAB)
    return j.select("o_orderkey", *keep, F.array(*[as_double(v) for v in vals]).alias("adv"))


def relational_feature_names(roster_size: int = S.ROSTER_SIZE) -> list[str]:
    names = []
    for s in range(1, roster_size + 1):
        p = f"m{s}_"
        names.append(p + "hp")
        names += [p + c for c in STAT_COLS]
        names += [p + "boost" + str(i) for i in range(6)]
        names += [p + "status_" + v for v in LINE_STATUS_VOCAB]
        names += [p + "flag_" + v for v in RETURN_FLAG_VOCAB]
        names += [p + "type_" + v for v in PART_TYPE_VOCAB]
        names += [p + "brand_" + v for v in BRAND_VOCAB]
    names += ["adv_alive", "adv_discovered_alive", "adv_leader"]
    names += ["adv_priority_" + v for v in PRIORITY_VOCAB]
    return names


def sparse_feature_long(orders: DataFrame, roster: DataFrame, match: str,
                        order: Sequence[str], roster_size: int = S.ROSTER_SIZE) -> DataFrame:
    """D12/D13 in long sparse form: ``(o_orderkey, position, value)`` for
    every non-zero entry of the fixed-width vector."""
    ranked = ranked_roster(roster, match, order, roster_size)
    mem = ranked.select(F.col(match).alias("o_orderkey"), "slot",
                        F.posexplode(relational_member_block()).alias("pos", "value"))
    mem = mem.select("o_orderkey",
                     ((F.col("slot") - 1) * RELATIONAL_MEMBER_WIDTH + F.col("pos"))
                     .cast("int").alias("position"), "value")
    adv = relational_adversary(orders, roster, match, order)
    adv = adv.select("o_orderkey", F.posexplode("adv").alias("pos", "value"))
    adv = adv.select("o_orderkey",
                     (F.lit(roster_size * RELATIONAL_MEMBER_WIDTH) + F.col("pos"))
                     .cast("int").alias("position"), "value")
    return mem.unionByName(adv).where(F.col("value") != 0.0)


def relational_feature_vectors(orders: DataFrame, roster: DataFrame, match: str,
                               order: Sequence[str], label: Column,
                               roster_size: int = S.ROSTER_SIZE) -> DataFrame:
    """Dense per-match vectors ``(o_orderkey, label, features)``.

    The per-match ``collect_list`` holds at most ``roster_size`` member
    blocks (the group limit runs first), so no group is unbounded."""
    ranked = ranked_roster(roster, match, order, roster_size)
    blocks = ranked.groupBy(F.col(match).alias("o_orderkey")).agg(
        F.collect_list(F.struct("slot", relational_member_block().alias("b"))).alias("_blocks"))
    adv = relational_adversary(orders, roster, match, order,
                               keep=[label.cast("double").alias("label")])
    zeros = F.array_repeat(F.lit(0.0), RELATIONAL_MEMBER_WIDTH)
    blocks_col = F.coalesce(F.col("_blocks"), F.array().cast("array<struct<slot:int,b:array<double>>>"))
    arr = F.concat(
        F.flatten(F.transform(
            F.sequence(F.lit(1), F.lit(roster_size)),
            lambda s: F.coalesce(
                F.try_element_at(F.filter(blocks_col, lambda x: x["slot"] == s), F.lit(1))["b"],
                zeros))),
        F.col("adv"))
    names = relational_feature_names(roster_size)
    return (adv.join(blocks, "o_orderkey", "left")
            .select("o_orderkey", "label",
                    array_to_vector(arr).alias("features", metadata=feature_metadata(names))))


# ---------------------------------------------------------------------------
# Team summaries described by the original
# ---------------------------------------------------------------------------

def team_means(roster: DataFrame, match: str, stat_cols: Sequence[str]) -> DataFrame:
    """K1: mean of each stat over the team."""
    return roster.groupBy(match).agg(*[F.avg(c).alias("mean_" + c) for c in stat_cols])


def type_coverage(roster: DataFrame, match: str, type_cols: Sequence[str]) -> DataFrame:
    """K2: number of distinct types over all members (type1 and type2)."""
    stacked = roster.select(match, F.explode(F.array(*[F.col(c) for c in type_cols])).alias("_t"))
    return stacked.groupBy(match).agg(F.count_distinct("_t").cast("long").alias("type_coverage"))


def mean_power(moves: DataFrame, match: str, power: str) -> DataFrame:
    """K3: mean power of the moves used by a team."""
    return moves.groupBy(match).agg(F.avg(power).alias("mean_power"))


def status_member_count(roster: DataFrame, match: str, member: str, flag: Column) -> DataFrame:
    """K4: number of distinct members for which ``flag`` holds."""
    return roster.groupBy(match).agg(
        F.count_distinct(F.when(flag, F.col(member))).cast("long").alias("status_members"))


def team_difference(a: DataFrame, b: DataFrame, match: str, cols: Sequence[str]) -> DataFrame:
    """K5: team A minus team B, per match and per feature (equi-join on the
    match key; both sides are already one row per match)."""
    j = a.join(b, match, "inner")
    return j.select(match, *[(a[c] - b[c]).alias("diff_" + c) for c in cols])


def extreme_member(roster: DataFrame, match: str, member: str, stat: str,
                   tie: Sequence[str]) -> DataFrame:
    """Member with the highest ``stat`` (ties by the ``tie`` key, first
    wins) and that maximum."""
    return roster.groupBy(match).agg(
        F.max(stat).alias("max_" + stat),
        F.min_by(F.col(member), F.struct(F.negative(F.col(stat)), *[F.col(t) for t in tie]))
        .alias("top_member"))


def member_code_mean(roster: DataFrame, codes: DataFrame, match: str, name: str,
                     code: str = "encoding") -> DataFrame:
    """Average of the members' target codes per match.  The code table
    has one row per distinct name; the join shuffles or broadcasts by the
    planner's size estimate."""
    return (roster.join(codes, name, "left").groupBy(match)
            .agg(F.avg(code).alias("member_code_mean")))


def matchup_join(roster: DataFrame, chart: DataFrame, match: str, key: str, multiplier: str) -> DataFrame:
    """Look every member up in an effectiveness chart and average the
    multiplier per match; the planner picks the join from the chart's size."""
    return (roster.join(chart.select(key, multiplier), key, "left").groupBy(match)
            .agg(F.avg(multiplier).alias("mean_multiplier"),
                 F.count(multiplier).cast("long").alias("charted_members")))

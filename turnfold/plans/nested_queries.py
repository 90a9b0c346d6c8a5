"""Queries over nested match records: the fold as one expression, its 984
features and its rejects, with their SQL.

The records are built row by row from ``embeddings``: component i of a vector
is turn i, and everything of the turn follows from the integer
``k = floor(10000 |e_i|)``.  Some records are left incomplete by their key, so
that every reject reason occurs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import nested as NS
from ..operators import features as FT
from ..operators import timeline as TL
from ..sources.tables import table
from .catalogue import register
from .oracle import ORACLE

TURNS = 64


def _pick(words: list[str], at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), (at + 1).cast("int"))


def _move(k: Column, name: Column, kind: Column, absent: Column) -> Column:
    move = F.struct(name.alias("name"), F.when(k % 2 == 1, S.PHYSICAL).otherwise("special").alias("category"),
                    _pick(S.TYPE_VOCAB, kind).alias("type"), (k % 120).cast("double").alias("base_power"),
                    ((k % 100) / 100.0).alias("accuracy"), (k % 3 - 1).cast("double").alias("priority"))
    return F.when(~absent, move)


def _turn(e: Column, i: Column) -> Column:
    k = F.floor(F.abs(e.cast("double")) * 10000.0).cast("long")
    own = F.concat(F.lit("m"), ((k + i) % 6).cast("string"))
    effects = F.when(k % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(_pick(S.EFFECTS_VOCAB, k % 8)))
    one = F.struct(F.when((F.col("vec_id") % 17 == 0) & (i == 0), F.lit("zz")).otherwise(own).alias("name"),
                   ((k % 1000) / 1000.0).alias("hp_pct"), _pick(S.STATUS_VOCAB, k % 8).alias("status"),
                   effects.alias("effects"))
    two = F.struct(F.concat(F.lit("x"), (k % 7).cast("string")).alias("name"),
                   F.when(k % 5 == 0, 0.0).otherwise((k % 997 + 1) / 1000.0).alias("hp_pct"),
                   F.when(k % 6 != 0, _pick(S.STATUS_VOCAB, F.floor(k / 8) % 8)).alias("status"),
                   F.array().cast("array<string>").alias("effects"))
    return F.struct(one.alias("p1_pokemon_state"), two.alias("p2_pokemon_state"),
                    _move(k, F.concat(F.lit("v"), (k % 9).cast("string")), k % 19, k % 4 == 0).alias("p1_move_details"),
                    _move(k, F.concat(F.lit("w"), (k % 10).cast("string")), F.floor(k / 3) % 19, k % 3 == 1)
                    .alias("p2_move_details"))


def _member(j: int) -> Column:
    b = F.col("vec_id")
    second = F.lit("notype") if j % 2 == 0 else _pick(S.TYPE_VOCAB, (b + 3 * j) % 19)
    types = F.array(_pick(S.TYPE_VOCAB, (b + j) % 19), second)
    if j == 0:
        types = F.when(b % 23 == 0, F.slice(types, 1, 1)).otherwise(types)
    return F.struct(F.lit(f"m{j}").alias("name"), types.alias("types"), (b % 7 + 50 + j).cast("double").alias("base_hp"),
                    *[F.lit(float(x + j)).alias(n) for n, x in (("base_atk", 60), ("base_def", 70), ("base_spa", 80),
                                                                 ("base_spd", 90))],
                    (b % 3 + 100 + j).cast("double").alias("base_spe"))


def match_records(spark, sf_dir: str) -> DataFrame:
    """``embeddings`` as records of the match-log schema."""
    b = F.col("vec_id")
    turns = F.transform(F.slice("embedding", 1, TURNS), lambda e, i: _turn(e, i))
    return table(spark, sf_dir, "embeddings").select(
        b.alias("battle_id"), F.when(b % 13 != 0, F.col("label") % 2 == 1).alias("player_won"),
        F.when(b % 11 != 0, F.array(*[_member(j) for j in range(S.ROSTER_SIZE)])).alias("p1_team_details"),
        F.when(b % 29 != 0, F.struct(F.lit("x0").alias("name"))).alias("p2_lead_details"),
        F.when(b % 19 != 0, turns).otherwise(F.slice(turns, 1, 0)).alias("battle_timeline"))


def _states(spark, sf_dir: str, semantics: str) -> DataFrame:
    return TL.split_rejects(TL.fold_match_logs(match_records(spark, sf_dir), semantics=semantics))[0]


def _summary(spark, sf_dir: str, semantics: str) -> DataFrame:
    st = _states(spark, sf_dir, semantics)
    names = lambda moves: F.array_join(F.transform(moves, lambda m: m["name"]), " ")
    return st.select(
        "battle_id", "win", "revealed", F.col("team2.pkmn_alive").alias("alive"),
        F.col("team2.pkmn_dscvrd_alive").alias("discovered_alive"), F.round("team2.hp_leader", 6).alias("leader_hp"),
        names(F.col("team2.moves")).alias("adversary_moves"),
        *[F.round(F.col("team1")[j]["hps"], 6).alias(f"hp_{j}") for j in range(S.ROSTER_SIZE)],
        F.concat_ws("|", *[names(F.col("team1")[j]["moves"]) for j in range(S.ROSTER_SIZE)]).alias("own_moves"))


@register("nested_state_fold")
def q_fold(spark, sf_dir):
    return _summary(spark, sf_dir, "observed")


@register("nested_state_fold_corrected")
def q_fold_corrected(spark, sf_dir):
    return _summary(spark, sf_dir, "corrected")


@register("nested_features_long")
def q_features(spark, sf_dir):
    """The 984 features that are not 0, by position."""
    st = _states(spark, sf_dir, "corrected")
    one = st.select("battle_id", F.posexplode(FT.feature_array(semantics="corrected")).alias("position", "value"))
    return one.where(F.col("value") != 0.0).select("battle_id", "position", F.round("value", 6).alias("value"))


@register("nested_feature_names")
def q_names(spark, sf_dir):
    """Mean of every named feature over the valid records."""
    st = _states(spark, sf_dir, "corrected")
    one = st.select(F.posexplode(FT.feature_array(semantics="corrected")).alias("position", "value"))
    name = F.element_at(F.array(*[F.lit(n) for n in S.feature_names()]), F.col("position") + 1)
    return (one.groupBy("position").agg(F.avg("value").alias("mean"))
            .select("position", name.alias("feature"), F.round("mean", 6).alias("mean")))


@register("nested_rejects")
def q_rejects(spark, sf_dir):
    return TL.split_rejects(TL.fold_match_logs(match_records(spark, sf_dir)))[1].select("battle_id", "reject_reason")


@register("nested_path_walk")
def q_path_walk(spark, sf_dir):
    """B1: the field of the first list element that has it; B2 leaves out
    records without the path."""
    df = match_records(spark, sf_dir)
    walked = df.withColumn("first_move", NS.path_walk(df, ["battle_timeline", "p1_move_details", "name"]))
    return NS.skip_missing(walked, "first_move").select("battle_id", "first_move")


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_REASON = """CASE WHEN vec_id % 11 = 0 OR vec_id % 13 = 0 OR vec_id % 29 = 0 THEN 'missing field'
     WHEN vec_id % 19 = 0 THEN 'empty timeline' WHEN vec_id % 17 = 0 THEN 'unknown active member'
     WHEN vec_id % 23 = 0 THEN 'member with fewer than two types' END"""
_TURNS = f"""
v AS (SELECT vec_id, label, embedding FROM embeddings WHERE {_REASON} IS NULL),
k AS (SELECT vec_id, label, i, CAST(FLOOR(ABS(CAST(embedding[i + 1] AS DOUBLE)) * 10000.0) AS BIGINT) k
      FROM v, range({TURNS}) r(i)),
t AS (SELECT vec_id, label, i, k, (k + i) % 6 j, (k % 1000) / 1000.0 hp1, ({_list(S.STATUS_VOCAB)})[k % 8 + 1] s1,
             CASE WHEN k % 3 <> 0 THEN ({_list(S.EFFECTS_VOCAB)})[k % 8 + 1] END e1, k % 7 x,
             CASE WHEN k % 5 = 0 THEN 0.0 ELSE (k % 997 + 1) / 1000.0 END hp2,
             CASE WHEN k % 6 <> 0 THEN ({_list(S.STATUS_VOCAB)})[(k // 8) % 8 + 1] END s2,
             CASE WHEN k % 4 <> 0 THEN 'v' || (k % 9) END m1, CASE WHEN k % 3 <> 1 THEN 'w' || (k % 10) END m2 FROM k),
last1 AS (SELECT * FROM t QUALIFY ROW_NUMBER() OVER (PARTITION BY vec_id, j ORDER BY i DESC) = 1),
own_observed AS (SELECT * FROM t WHERE m1 IS NOT NULL
                 QUALIFY ROW_NUMBER() OVER (PARTITION BY vec_id, m1 ORDER BY i) = 1),
own_corrected AS (SELECT * FROM t WHERE m1 IS NOT NULL
                  QUALIFY ROW_NUMBER() OVER (PARTITION BY vec_id, j, m1 ORDER BY i) = 1),
adv AS (SELECT * FROM t WHERE m2 IS NOT NULL QUALIFY ROW_NUMBER() OVER (PARTITION BY vec_id, m2 ORDER BY i) = 1),
s AS (SELECT vec_id, any_value(label) % 2 win, count(DISTINCT j) revealed, count(*) turns, count(*) FILTER (WHERE hp2 = 0) fallen,
             count(DISTINCT x) seen, count(DISTINCT x) FILTER (WHERE hp2 = 0) dead, max(CASE WHEN i = {TURNS - 1} THEN hp2 END) leader
      FROM t GROUP BY vec_id)"""


def _summary_sql(semantics: str) -> str:
    alive, found = (("6 - fallen", "1 + turns - fallen") if semantics == "observed"
                    else ("greatest(6 - dead, 0)", "seen - dead"))
    hps = ", ".join(f"ROUND(COALESCE((SELECT hp1 FROM last1 l WHERE l.vec_id = s.vec_id AND l.j = {j}), 1.0), 6) hp_{j}"
                    for j in range(S.ROSTER_SIZE))
    own = " || '|' || ".join(
        f"COALESCE((SELECT string_agg(m1, ' ' ORDER BY i) FROM own_{semantics} o WHERE o.vec_id = s.vec_id AND o.j = {j}), '')"
        for j in range(S.ROSTER_SIZE))
    return f"""WITH {_TURNS}
SELECT vec_id battle_id, CAST(win AS INTEGER) win, CAST(revealed AS BIGINT) revealed, CAST({alive} AS BIGINT) alive,
       CAST({found} AS BIGINT) discovered_alive, ROUND(CAST(leader AS DOUBLE), 6) leader_hp,
       COALESCE((SELECT string_agg(m2, ' ' ORDER BY i) FROM adv a WHERE a.vec_id = s.vec_id), '') adversary_moves,
       {hps}, {own} own_moves
FROM s"""


_MOVE_TYPES = len(S.TYPE_VOCAB)
_FEATURES = f"""{_TURNS},
m AS (SELECT v.vec_id, j, {S.MEMBER_WIDTH} * j base FROM v, range({S.ROSTER_SIZE}) r(j)),
mv AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY vec_id, j ORDER BY i) slot FROM own_corrected
       QUALIFY ROW_NUMBER() OVER (PARTITION BY vec_id, j ORDER BY i) <= {S.MAX_MOVES}),
p AS (SELECT vec_id, j * {S.MEMBER_WIDTH} + 67 + (slot - 1) * 23 base, k FROM mv),
f AS (
  SELECT m.vec_id, m.base position, COALESCE(l.hp1, 1.0) AS val FROM m LEFT JOIN last1 l ON l.vec_id = m.vec_id AND l.j = m.j
  UNION ALL SELECT vec_id, base + 1 + i, [60 + j, 70 + j, 80 + j, 90 + j, 100 + j + vec_id % 3, 50 + j + vec_id % 7][i + 1]
            FROM m, range(6) r(i)
  UNION ALL SELECT vec_id, {S.MEMBER_WIDTH} * j + 13 + list_position({_list(S.STATUS_VOCAB)}, s1) - 1, 1 FROM last1
  UNION ALL SELECT vec_id, {S.MEMBER_WIDTH} * j + 21 + list_position({_list(S.EFFECTS_VOCAB)}, e1) - 1, 1 FROM last1 WHERE e1 IS NOT NULL
  UNION ALL SELECT vec_id, base + 29 + (vec_id + j) % {_MOVE_TYPES}, 1 FROM m
  UNION ALL SELECT vec_id, base + 48 + CASE WHEN j % 2 = 0 THEN {_MOVE_TYPES - 1} ELSE (vec_id + 3 * j) % {_MOVE_TYPES} END, 1 FROM m
  UNION ALL SELECT vec_id, base, k % 120 FROM p
  UNION ALL SELECT vec_id, base + 1, (k % 100) / 100.0 FROM p
  UNION ALL SELECT vec_id, base + 2, k % 3 - 1 FROM p
  UNION ALL SELECT vec_id, base + 3, k % 2 FROM p
  UNION ALL SELECT vec_id, base + 4 + k % {_MOVE_TYPES}, 1 FROM p
  UNION ALL SELECT vec_id, 954, greatest(6 - dead, 0) FROM s
  UNION ALL SELECT vec_id, 955, seen - dead FROM s
  UNION ALL SELECT vec_id, 956, leader FROM s
  UNION ALL SELECT DISTINCT vec_id, 957 + (k // 3) % {_MOVE_TYPES}, 1 FROM adv
  UNION ALL SELECT DISTINCT vec_id, 976 + list_position({_list(S.STATUS_VOCAB)}, s2) - 1, 1 FROM t WHERE s2 IS NOT NULL)"""

ORACLE["nested_state_fold"] = _summary_sql("observed")
ORACLE["nested_state_fold_corrected"] = _summary_sql("corrected")
ORACLE["nested_features_long"] = f"""WITH {_FEATURES}
SELECT vec_id battle_id, CAST(position AS INTEGER) position, ROUND(CAST(val AS DOUBLE), 6) AS value FROM f WHERE val <> 0"""
ORACLE["nested_feature_names"] = f"""WITH {_FEATURES},
names AS (SELECT unnest({_list(S.feature_names())}) feature, unnest(range({S.FEATURE_WIDTH})) position)
SELECT CAST(n.position AS INTEGER) position, n.feature,
       ROUND(CAST(COALESCE(SUM(CAST(val AS DOUBLE)), 0) AS DOUBLE) / (SELECT count(*) FROM v), 6) AS mean
FROM names n LEFT JOIN f ON f.position = n.position GROUP BY n.position, n.feature"""
ORACLE["nested_path_walk"] = f"""
WITH k AS (SELECT vec_id, i, CAST(FLOOR(ABS(CAST(embedding[i + 1] AS DOUBLE)) * 10000.0) AS BIGINT) k
           FROM embeddings, range({TURNS}) r(i) WHERE vec_id % 19 <> 0)
SELECT vec_id battle_id, 'v' || (k % 9) first_move FROM k WHERE k % 4 <> 0
QUALIFY ROW_NUMBER() OVER (PARTITION BY vec_id ORDER BY i) = 1"""
ORACLE["nested_rejects"] = f"""
SELECT vec_id battle_id, {_REASON} reject_reason FROM embeddings WHERE {_REASON} IS NOT NULL"""

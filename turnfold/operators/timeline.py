"""Timeline fold: an ordered turn list folded into an end-of-match state.

Two forms of the same operators:

* **flat** -- one row per turn (e.g. an event table).  Every operator is a
  ``groupBy`` with partial aggregation (``max_by``/``min_by``/``count_if``),
  so a match that holds a third of all turns is still combined map-side
  and never lands whole in one task.
* **nested** -- one row per match with the timeline as an array (the match
  log schema).  The fold is a single projection of higher-order functions;
  it needs no shuffle at all.

``semantics='observed'`` reproduces the original counters exactly
(quirks Q1-Q3, Q7); ``'corrected'`` gives the evident intent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _order_struct(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(o) for o in order])


# ---------------------------------------------------------------------------
# flat form
# ---------------------------------------------------------------------------

def last_value_by_member(df: DataFrame, match: str, order: Sequence[str], member: str,
                         value: str, roster: Sequence[str], default: float = 1.0) -> DataFrame:
    """C1 + C3: value on each roster member's last active turn, ``default``
    when the member was never active.  One row per (match, roster slot).

    One grouped pass: per roster member a ``max_by`` whose ordering is null
    on other members' turns."""
    aggs = []
    for i, name in enumerate(roster):
        on = F.col(member) == F.lit(name)
        aggs.append(F.max_by(F.col(value), F.when(on, _order_struct(order))).alias(f"_v{i}"))
        aggs.append(F.count_if(on).alias(f"_n{i}"))
    folded = df.groupBy(match).agg(*aggs)
    # first slot wins for duplicate roster names (C4)
    first_slot = {}
    for i, name in enumerate(roster):
        first_slot.setdefault(name, i)
    rows = F.array(*[
        F.struct(F.lit(i + 1).alias("slot"), F.lit(name).alias("member"),
                 (F.coalesce(F.col(f"_v{first_slot[name]}"), F.lit(default))
                  if first_slot[name] == i else F.lit(default)).cast("double").alias("hp"),
                 ((F.col(f"_n{i}") > 0) & F.lit(first_slot[name] == i)).alias("active"))
        for i, name in enumerate(roster)])
    return folded.select(match, F.inline(rows))


def revealed_count(df: DataFrame, match: str, member: str) -> DataFrame:
    """Number of distinct active members, and number of turns."""
    return df.groupBy(match).agg(F.count_distinct(member).cast("long").alias("revealed"),
                                 F.count(F.lit(1)).cast("long").alias("turns"))


def alive_counters(df: DataFrame, match: str, fainted: Column, opponent: Column | None = None,
                   semantics: str = "observed") -> DataFrame:
    """C2, C6, C7.

    observed: ``alive = 6 - #fainted turns`` (may go negative) and
    ``discovered_alive = 1 + #turns - #fainted turns``.
    corrected: counts distinct opponent names instead, floor 0."""
    if semantics == "observed":
        return df.groupBy(match).agg(
            (F.lit(S.START_ALIVE) - F.count_if(fainted)).cast("long").alias("alive"),
            (F.lit(S.START_DISCOVERED_ALIVE) + F.count(F.lit(1)) - F.count_if(fainted))
            .cast("long").alias("discovered_alive"))
    if opponent is None:
        raise ValueError("corrected counters need the opponent name column")
    dead = F.count_distinct(F.when(fainted, opponent))
    return df.groupBy(match).agg(
        F.greatest(F.lit(S.START_ALIVE) - dead, F.lit(0)).cast("long").alias("alive"),
        (F.count_distinct(opponent) - dead).cast("long").alias("discovered_alive"))


def first_use_moves(df: DataFrame, match: str, order: Sequence[str], member: str,
                    move: str | Column, per: str = "match", use_order: bool = True) -> DataFrame:
    """C8/C9 with B9: each move is kept once -- per match (observed, Q7) or
    per (match, member) (corrected) -- credited to the member active at its
    first use.  Turns whose move is null contribute nothing.

    The dedup is a grouped ``min`` (partial aggregation, skew-safe); the
    use order is the skew-safe ``group_row_number`` over the deduplicated
    rows, so a match with very many distinct moves is still numbered by
    several tasks."""
    mv = _c(move).alias("move")
    base = df.select(match, member, mv, *order).where(F.col("move").isNotNull())
    keys = [match, "move"] if per == "match" else [match, member, "move"]
    first = F.min(F.struct(*[F.col(o) for o in order],
                           *([F.col(member)] if per == "match" else [])))
    out = base.groupBy(*keys).agg(first.alias("_f"))
    cols = [F.col(match), F.col("move")]
    cols.append(F.col("_f." + member).alias(member) if per == "match" else F.col(member))
    cols += [F.col("_f." + o).alias("first_" + o) for o in order]
    out = out.select(*cols)
    if not use_order:
        return out
    from ..functions.ordering import group_row_number
    numbered = group_row_number(out, [match], [*["first_" + o for o in order], "move"], "use_order")
    return numbered.withColumn("use_order", F.col("use_order").cast("long"))


def move_slots(first_uses: DataFrame, match: str, member: str, order: Sequence[str],
               max_moves: int = S.MAX_MOVES, members: DataFrame | None = None) -> DataFrame:
    """The first ``max_moves`` moves of each member by first use, as slots
    1..max_moves; absent slots are padded (``move`` null).  ``members`` names
    the (match, member) pairs of the rosters, so a member without a move gets
    its padding too; without it only members with a move are known.

    ``row_number() <= k`` is planned by Spark as a group limit, so each map
    task already keeps only k rows per member."""
    w = Window.partitionBy(match, member).orderBy(*[F.col("first_" + o) for o in order],
                                                  F.col("move"))
    ranked = (first_uses.withColumn("move_slot", F.row_number().over(w))
              .where(F.col("move_slot") <= max_moves))
    if members is None:
        members = first_uses.select(match, member).distinct()
    slots = members.select(match, member,
                           F.explode(F.sequence(F.lit(1), F.lit(max_moves))).alias("move_slot"))
    return slots.join(ranked, [match, member, "move_slot"], "left")


def final_value(df: DataFrame, match: str, order: Sequence[str],
                value_cols: Sequence[str | Column], prefix: str = "last_") -> DataFrame:
    """C11: values on the last turn (``max_by`` over the turn order)."""
    o = _order_struct(order)
    aggs = []
    for v in value_cols:
        col = _c(v)
        name = v if isinstance(v, str) else col._jc.toString()
        aggs.append(F.max_by(col, o).alias(prefix + name))
    return df.groupBy(match).agg(*aggs)


def name_slot(df: DataFrame, match: str, order: Sequence[str], name: str) -> DataFrame:
    """C4: the first (1-based) roster slot holding each name, with the
    number of slots sharing the name.  Slots come from the skew-safe
    ``group_row_number`` (no window over a possibly hot match)."""
    from ..functions.ordering import group_row_number
    slotted = group_row_number(df.select(match, name, *order), [match], list(order), "slot")
    return slotted.groupBy(match, name).agg(F.min("slot").cast("long").alias("first_slot"),
                                            F.count(F.lit(1)).cast("long").alias("n_slots"))


def label_column(won: Column, is_train: bool = True) -> Column:
    """1/0 label in training (null where it is absent), -1 (unknown)
    when scoring."""
    return (won.cast("int") if is_train else F.lit(-1).cast("int"))


def category_indicator(category: Column, value: str = S.PHYSICAL,
                       case_sensitive: bool = True) -> Column:
    """1 when the category equals ``value``; case-sensitive by default."""
    c = category if case_sensitive else F.lower(category)
    v = value if case_sensitive else value.lower()
    return F.coalesce((c == F.lit(v)).cast("int"), F.lit(0))


def status_value(status: Column, no_status: str = S.NO_STATUS) -> Column:
    """The 'no status' marker becomes null."""
    return F.nullif(status, F.lit(no_status))


def match_state_summary(df: DataFrame, match: str, order: Sequence[str], member: str,
                        value: str, roster: Sequence[str], fainted: Column,
                        move: Column | None = None) -> DataFrame:
    """The whole flat fold in one grouped pass: turns, revealed members,
    observed alive counters, final leader value, last value per roster
    member (default 1.0) and the number of distinct moves."""
    o = _order_struct(order)
    aggs = [
        F.count(F.lit(1)).cast("long").alias("turns"),
        F.count_distinct(member).cast("long").alias("revealed"),
        (F.lit(S.START_ALIVE) - F.count_if(fainted)).cast("long").alias("alive"),
        (F.lit(S.START_DISCOVERED_ALIVE) + F.count(F.lit(1)) - F.count_if(fainted))
        .cast("long").alias("discovered_alive"),
        F.max_by(F.col(value), o).alias("leader_value"),
    ]
    for name in dict.fromkeys(roster):
        aggs.append(F.coalesce(F.max_by(F.col(value), F.when(F.col(member) == name, o)),
                               F.lit(1.0)).alias(f"hp_{name}"))
    if move is not None:
        aggs.append(F.count_distinct(move).cast("long").alias("distinct_moves"))
    return df.groupBy(match).agg(*aggs)


# ---------------------------------------------------------------------------
# nested form (match log records)
# ---------------------------------------------------------------------------

def _move_struct(m: Column) -> Column:
    return F.struct(m["name"].alias("name"),
                    category_indicator(m["category"]).alias("cat"),
                    m["type"].alias("type"),
                    m["base_power"].alias("base_pwr"),
                    m["accuracy"].alias("accuracy"),
                    m["priority"].alias("priority"))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _first_use(items: Column, key) -> Column:
    """Keep the first element for every key value (array order = turn order;
    elements without a key go).  Keys are sorted with their places, so the
    work grows as n log n with the turns of a record."""
    placed = F.array_sort(F.filter(F.transform(items, lambda x, j: F.struct(key(x).alias("k"), j.alias("j"))),
                                   lambda x: x["k"].isNotNull()))
    first = _let(placed, lambda s: F.filter(s, lambda x, i: (i == 0) | ~F.get(s, i - 1)["k"].eqNullSafe(x["k"])))
    places = F.array_sort(F.transform(first, lambda x: x["j"]))
    return _let(F.struct(items.alias("items"), places.alias("places")),
                lambda b: F.transform(b["places"], lambda j: F.get(b["items"], j)))


def fold_match_logs(df: DataFrame, is_train: bool = True, semantics: str = "observed",
                    id_col: str = "battle_id") -> DataFrame:
    """C1-C12 on match records: one projection, no shuffle.

    Returns ``battle_id, win, team1 (array of member structs), revealed,
    adversary struct, reject_reason``.  Records the original would crash on
    (empty timeline, unknown active member, member with fewer than two
    types) carry a ``reject_reason`` instead; use :func:`split_rejects`."""
    team = F.col("p1_team_details")
    names = F.transform(team, lambda p: p["name"])
    turns = F.transform(
        F.col("battle_timeline"),
        lambda t: F.struct(
            F.coalesce(F.array_position(names, t["p1_pokemon_state"]["name"]), F.lit(0))
            .alias("slot"),
            t["p1_pokemon_state"]["name"].alias("name1"),
            t["p1_pokemon_state"]["hp_pct"].alias("hp1"),
            t["p1_pokemon_state"]["status"].alias("status1"),
            t["p1_pokemon_state"]["effects"].alias("effects1"),
            t["p2_pokemon_state"]["name"].alias("name2"),
            t["p2_pokemon_state"]["hp_pct"].alias("hp2"),
            t["p2_pokemon_state"]["status"].alias("status2"),
            t["p1_move_details"].alias("m1"),
            t["p2_move_details"].alias("m2")))
    staged = df.withColumn("_turns", turns)
    tl = F.col("_turns")

    moved1 = F.filter(tl, lambda t: t["m1"].isNotNull())
    if semantics == "observed":
        dedup1 = _first_use(moved1, lambda t: t["m1"]["name"])
    else:
        dedup1 = _first_use(moved1, lambda t: F.struct(t["slot"], t["m1"]["name"]))
    staged = staged.withColumn("_moves1", dedup1)

    def member(p, i):
        own = F.filter(tl, lambda t: t["slot"] == i + 1)
        last = F.try_element_at(own, F.lit(-1))
        if semantics == "observed":
            status = F.lit(None).cast("string")          # Q6: never updated
            effects = F.array().cast("array<string>")
        else:
            status = last["status1"]
            effects = F.coalesce(last["effects1"], F.array().cast("array<string>"))
        return F.struct(
            p["name"].alias("name"),
            F.coalesce(last["hp1"], F.lit(1.0)).alias("hps"),
            F.try_element_at(p["types"], F.lit(1)).alias("type1"),
            F.try_element_at(p["types"], F.lit(2)).alias("type2"),
            F.struct(p["base_atk"].alias("atk"), p["base_def"].alias("def"),
                     p["base_spa"].alias("spa"), p["base_spd"].alias("spd"),
                     p["base_spe"].alias("spe"), p["base_hp"].alias("hp")).alias("base_stats"),
            F.transform(F.filter(F.col("_moves1"), lambda t: t["slot"] == i + 1),
                        lambda t: _move_struct(t["m1"])).alias("moves"),
            status.alias("status"),
            effects.alias("effects"),
            F.struct(*[F.lit(0.0).alias(s) for s in S.STAT_ORDER]).alias("boosts"))

    zero_hp = F.filter(tl, lambda t: t["hp2"] == 0.0)
    moves2 = F.transform(_first_use(F.filter(tl, lambda t: t["m2"].isNotNull()),
                                    lambda t: t["m2"]["name"]),
                         lambda t: _move_struct(t["m2"]))
    if semantics == "observed":
        alive = F.lit(S.START_ALIVE) - F.size(zero_hp)
        discovered = F.lit(S.START_DISCOVERED_ALIVE) + F.size(tl) - F.size(zero_hp)
        adv_types = F.array().cast("array<string>")     # Q4: list holds moves
        adv_status = F.array().cast("array<string>")    # Q5: never filled
    else:
        seen = F.array_distinct(F.transform(tl, lambda t: t["name2"]))
        dead = F.array_distinct(F.transform(zero_hp, lambda t: t["name2"]))
        alive = F.greatest(F.lit(S.START_ALIVE) - F.size(dead), F.lit(0))
        discovered = F.size(seen) - F.size(dead)
        adv_types = F.array_distinct(F.transform(moves2, lambda m: m["type"]))
        adv_status = F.array_distinct(F.filter(F.transform(tl, lambda t: t["status2"]),
                                               lambda s: s.isNotNull()))
    adversary = F.struct(
        alive.cast("long").alias("pkmn_alive"),
        discovered.cast("long").alias("pkmn_dscvrd_alive"),
        moves2.alias("moves"),
        adv_types.alias("types"),
        adv_status.alias("statuses"),
        F.try_element_at(tl, F.lit(-1))["hp2"].alias("hp_leader"))

    absent = (F.col("p1_team_details").isNull() | F.col("battle_timeline").isNull()
              | F.col("p2_lead_details").isNull())
    if is_train:
        absent = absent | F.col("player_won").isNull()
    reason = (F.when(absent, F.lit("missing field"))
              .when(F.size("battle_timeline") == 0, F.lit("empty timeline"))
              .when(F.exists(tl, lambda t: t["slot"] == 0), F.lit("unknown active member"))
              .when(F.exists(team, lambda p: F.coalesce(F.size(p["types"]), F.lit(0)) < 2),
                    F.lit("member with fewer than two types")))
    win = (label_column(F.col("player_won"), True) if is_train else F.lit(-1).cast("int"))
    return staged.select(
        F.col(id_col).alias("battle_id"),
        win.alias("win"),
        F.transform(team, member).alias("team1"),
        F.size(F.array_distinct(F.transform(tl, lambda t: t["name1"]))).cast("long")
        .alias("revealed"),
        adversary.alias("team2"),
        reason.alias("reject_reason"))


def split_rejects(state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid match states, rejected records with their reason)."""
    ok = state.where(F.col("reject_reason").isNull()).drop("reject_reason")
    bad = state.where(F.col("reject_reason").isNotNull()).select("battle_id", "reject_reason")
    return ok, bad


# ---------------------------------------------------------------------------
# K6-K8: turn-to-turn changes (described by the original, not built there)
# ---------------------------------------------------------------------------

def damage_total(df: DataFrame, match: str, member: str, order: Sequence[str], hp: str
                 ) -> DataFrame:
    """K6: per match, sum of HP drops between consecutive turns of the same
    member: ``sum(greatest(prev_hp - hp, 0))``.  The lag is skew-safe
    (range partitions on the full key; see ``functions.ordering.with_lag``)."""
    from ..functions.ordering import with_lag
    lagged = with_lag(df.select(match, member, hp, *order), [match, member], list(order), [hp])
    return lagged.groupBy(match).agg(
        F.coalesce(F.sum(F.greatest(F.col("prev_" + hp) - F.col(hp), F.lit(0.0))), F.lit(0.0))
        .alias("damage"))


def switches_and_knockouts(df: DataFrame, match: str, order: Sequence[str], member: str,
                           fainted: Column) -> DataFrame:
    """K7: switch-ins (active member differs from the previous turn's) and
    knockouts (a fainting turn after a non-fainting one)."""
    from ..functions.ordering import with_lag
    base = df.select(match, member, *order, fainted.alias("_faint"))
    lagged = with_lag(base, [match], list(order), [member, "_faint"])
    return lagged.groupBy(match).agg(
        F.count_if(F.col("prev_" + member).isNotNull()
                   & (F.col(member) != F.col("prev_" + member))).cast("long").alias("switches"),
        F.count_if(F.col("_faint") & (F.col("prev__faint") == F.lit(False)))
        .cast("long").alias("knockouts"))


def status_inflictions(df: DataFrame, match: str, order: Sequence[str], status: Column,
                       no_status: str = S.NO_STATUS) -> DataFrame:
    """K8: turns whose status differs from the previous turn's and is a
    real status."""
    from ..functions.ordering import with_lag
    base = df.select(match, *order, status.alias("_status"))
    lagged = with_lag(base, [match], list(order), ["_status"])
    return lagged.groupBy(match).agg(
        F.count_if(F.col("prev__status").isNotNull()
                   & (F.col("_status") != F.col("prev__status"))
                   & (F.col("_status") != F.lit(no_status))).cast("long").alias("inflictions"))

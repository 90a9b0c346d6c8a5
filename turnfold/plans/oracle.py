"""DuckDB SQL that computes the same result as each catalogue query.

Column names equal the Spark side; doubles are rounded to 6 places and
counts cast to BIGINT on both sides.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_ROSTER = "(VALUES (1,'click'),(2,'view'),(3,'purchase'),(4,'signup'),(5,'error')) r(slot, member)"
_MOVE = "CASE WHEN event_type <> 'view' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END"
_OPP = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

ORACLE["match_state_summary"] = f"""
WITH last_ev AS (
  SELECT user_id, value, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn
  FROM events),
last_m AS (
  SELECT user_id, event_type, value,
         ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) rn
  FROM events),
agg AS (
  SELECT user_id, CAST(COUNT(*) AS BIGINT) turns, CAST(COUNT(DISTINCT event_type) AS BIGINT) revealed,
         CAST(6 - COUNT(*) FILTER (WHERE event_type = 'error') AS BIGINT) alive,
         CAST(1 + COUNT(*) - COUNT(*) FILTER (WHERE event_type = 'error') AS BIGINT) discovered_alive,
         CAST(COUNT(DISTINCT {_MOVE}) AS BIGINT) distinct_moves
  FROM events GROUP BY user_id)
SELECT a.user_id, a.turns, a.revealed, a.alive, a.discovered_alive,
       ROUND(l.value, 6) leader_value,
       ROUND(COALESCE((SELECT value FROM last_m m WHERE m.user_id = a.user_id AND m.event_type = 'click' AND rn = 1), 1.0), 6) hp_click,
       ROUND(COALESCE((SELECT value FROM last_m m WHERE m.user_id = a.user_id AND m.event_type = 'view' AND rn = 1), 1.0), 6) hp_view,
       ROUND(COALESCE((SELECT value FROM last_m m WHERE m.user_id = a.user_id AND m.event_type = 'purchase' AND rn = 1), 1.0), 6) hp_purchase,
       ROUND(COALESCE((SELECT value FROM last_m m WHERE m.user_id = a.user_id AND m.event_type = 'signup' AND rn = 1), 1.0), 6) hp_signup,
       ROUND(COALESCE((SELECT value FROM last_m m WHERE m.user_id = a.user_id AND m.event_type = 'error' AND rn = 1), 1.0), 6) hp_error,
       a.distinct_moves
FROM agg a JOIN last_ev l ON l.user_id = a.user_id AND l.rn = 1
"""

ORACLE["timeline_last_value_by_member"] = f"""
WITH u AS (SELECT DISTINCT user_id FROM events),
lm AS (SELECT user_id, event_type, value,
              ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) rn
       FROM events)
SELECT u.user_id, CAST(r.slot AS INTEGER) slot, r.member,
       ROUND(COALESCE(lm.value, 1.0), 6) hp, lm.value IS NOT NULL active
FROM u CROSS JOIN {_ROSTER}
LEFT JOIN lm ON lm.user_id = u.user_id AND lm.event_type = r.member AND lm.rn = 1
"""

ORACLE["timeline_revealed_count"] = """
SELECT user_id, CAST(COUNT(DISTINCT event_type) AS BIGINT) revealed, CAST(COUNT(*) AS BIGINT) turns
FROM events GROUP BY user_id
"""

ORACLE["timeline_revealed_count_conversations"] = """
SELECT conv_id, CAST(COUNT(DISTINCT role) AS BIGINT) revealed, CAST(COUNT(*) AS BIGINT) turns
FROM conversations GROUP BY conv_id
"""

ORACLE["timeline_alive_counters"] = """
SELECT user_id,
       CAST(6 - COUNT(*) FILTER (WHERE event_type = 'error') AS BIGINT) alive,
       CAST(1 + COUNT(*) - COUNT(*) FILTER (WHERE event_type = 'error') AS BIGINT) discovered_alive
FROM events GROUP BY user_id
"""

ORACLE["timeline_alive_counters_corrected"] = f"""
SELECT user_id,
       CAST(GREATEST(6 - COUNT(DISTINCT CASE WHEN event_type = 'error' THEN {_OPP} END), 0) AS BIGINT) alive,
       CAST(COUNT(DISTINCT {_OPP}) - COUNT(DISTINCT CASE WHEN event_type = 'error' THEN {_OPP} END) AS BIGINT) discovered_alive
FROM events GROUP BY user_id
"""

_FIRST_USE = """
WITH mv AS (SELECT user_id, event_type, ts, event_id, {move} AS move FROM events),
f AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, {key}move ORDER BY ts, event_id) rn
      FROM mv WHERE move IS NOT NULL)
SELECT user_id, move, event_type, event_id AS first_event_id,
       CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id, move) AS BIGINT) use_order
FROM f WHERE rn = 1
"""
ORACLE["timeline_first_use_moves"] = _FIRST_USE.format(move=_MOVE, key="")
ORACLE["timeline_first_use_moves_per_member"] = _FIRST_USE.format(move=_MOVE, key="event_type, ")

ORACLE["move_slots_padded"] = f"""
WITH mv AS (SELECT user_id, event_type, ts, event_id, value, {_MOVE} AS move FROM events),
f AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, move ORDER BY ts, event_id) rn
      FROM mv WHERE move IS NOT NULL),
firsts AS (SELECT * FROM f WHERE rn = 1),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id, move) move_slot
           FROM firsts),
members AS (SELECT u.user_id, r.member AS event_type FROM (SELECT DISTINCT user_id FROM events) u
            CROSS JOIN {_ROSTER}),
slots AS (SELECT m.user_id, m.event_type, s.move_slot FROM members m
          CROSS JOIN (VALUES (1),(2),(3),(4)) s(move_slot))
SELECT s.user_id, s.event_type, CAST(s.move_slot AS INTEGER) move_slot,
       CAST(COALESCE(r.move, 0) AS BIGINT) move,
       COALESCE(CAST(r.move AS DOUBLE), 0.0) power,
       ROUND(COALESCE(r.value, 0.0), 6) accuracy,
       CAST(CASE WHEN r.move IS NULL THEN 0 WHEN s.event_type = 'purchase' THEN 1 ELSE 0 END AS INTEGER) cat
FROM slots s LEFT JOIN ranked r
  ON r.user_id = s.user_id AND r.event_type = s.event_type AND r.move_slot = s.move_slot
"""

ORACLE["timeline_final_leader"] = """
SELECT user_id, ROUND(value, 6) leader_hp, event_type leader, event_id last_event_id
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM events)
WHERE rn = 1
"""

ORACLE["timeline_final_leader_conversations"] = """
SELECT conv_id, role last_role, CAST(LENGTH(text) AS BIGINT) last_text_len, turn last_turn
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn DESC) rn FROM conversations)
WHERE rn = 1
"""

_LINE_ORDER = ("l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, "
               "l_tax, l_returnflag, l_linestatus, l_shipdate")

ORACLE["timeline_name_slot"] = f"""
WITH s AS (SELECT l.l_orderkey, p.p_name,
                  ROW_NUMBER() OVER (PARTITION BY l.l_orderkey ORDER BY {_LINE_ORDER}) slot
           FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)
SELECT l_orderkey, p_name, CAST(MIN(slot) AS BIGINT) first_slot, CAST(COUNT(*) AS BIGINT) n_slots
FROM s GROUP BY l_orderkey, p_name
"""

ORACLE["match_label"] = """
SELECT o_orderkey,
       CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS INTEGER) win,
       CAST(-1 AS INTEGER) win_unlabelled,
       CAST(COALESCE(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END, 0) AS INTEGER) cat,
       CAST(COALESCE(CASE WHEN LOWER(o_orderpriority) = '1-urgent' THEN 1 ELSE 0 END, 0) AS INTEGER) cat_ci
FROM orders
"""

ORACLE["status_nullif"] = """
SELECT o_orderkey, NULLIF(o_orderpriority, '5-LOW') status FROM orders
"""

_RANKED = f"""
ranked AS (SELECT l.*, p.*, ROW_NUMBER() OVER (PARTITION BY l.l_orderkey ORDER BY {_LINE_ORDER}) slot
           FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""

ORACLE["roster_slots_padded"] = f"""
WITH {_RANKED},
slots AS (SELECT o_orderkey, s.slot FROM orders CROSS JOIN (VALUES (1),(2),(3),(4),(5),(6)) s(slot))
SELECT s.o_orderkey, CAST(s.slot AS INTEGER) slot,
       CAST(CASE WHEN r.l_orderkey IS NULL THEN 0 ELSE 1 END AS INTEGER) present,
       ROUND(COALESCE(1.0 - r.l_discount, 0.0), 6) hp,
       ROUND(COALESCE(r.l_quantity, 0.0), 6) l_quantity,
       ROUND(COALESCE(r.l_extendedprice, 0.0), 6) l_extendedprice,
       ROUND(COALESCE(r.l_tax, 0.0), 6) l_tax,
       ROUND(COALESCE(CAST(r.p_size AS DOUBLE), 0.0), 6) p_size,
       ROUND(COALESCE(r.p_retailprice, 0.0), 6) p_retailprice,
       ROUND(COALESCE(r.l_discount, 0.0), 6) l_discount
FROM slots s LEFT JOIN ranked r ON r.l_orderkey = s.o_orderkey AND r.slot = s.slot
"""

_ADV = f"""
per AS (SELECT l_orderkey, COUNT(*) n, COUNT(*) FILTER (WHERE l_returnflag = 'R') r,
               arg_max(l_discount, slot) lead
        FROM (SELECT l.*, ROW_NUMBER() OVER (PARTITION BY l.l_orderkey ORDER BY {_LINE_ORDER}) slot
              FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey) GROUP BY l_orderkey),
adv AS (SELECT o.o_orderkey, o.o_orderpriority,
               CAST(6 - COALESCE(per.n, 0) AS DOUBLE) a0,
               CAST(1 + COALESCE(per.n, 0) - COALESCE(per.r, 0) AS DOUBLE) a1,
               COALESCE(per.lead, 0.0) a2
        FROM orders o LEFT JOIN per ON per.l_orderkey = o.o_orderkey)"""

ORACLE["roster_stat_boost_block"] = f"""
WITH {_ADV}
SELECT o_orderkey, ROUND(a0, 6) adv_alive, ROUND(a1, 6) adv_discovered_alive,
       ROUND(a2, 6) adv_leader, CAST(0.0 AS DOUBLE) boost_total FROM adv
"""

_PRIO = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _safe(v):
    return "".join(ch if ch.isalnum() else "_" for ch in v)


ORACLE["one_hot_status"] = "SELECT o_orderkey, " + ", ".join(
    f"CASE WHEN o_orderpriority = '{v}' THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END status_{_safe(v)}" for v in _PRIO
) + " FROM orders"

_EV = ["click", "view", "purchase", "signup", "error"]
ORACLE["multi_hot_effects"] = "SELECT user_id, " + ", ".join(
    f"MAX(CASE WHEN event_type = '{v}' THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END) effect_{v}" for v in _EV
) + " FROM events GROUP BY user_id"

_PT = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
_BR = [f"Brand#{i}" for i in range(1, 10)]
ORACLE["dual_type_one_hot"] = "SELECT p_partkey, " + ", ".join(
    [f"CASE WHEN contains(p_type, '{v}') THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END type1_{_safe(v)}" for v in _PT]
    + [f"CASE WHEN contains(p_brand, '{v}') THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END type2_{_safe(v)}" for v in _BR]
    + ["CAST(" + " + ".join(f"CASE WHEN p_brand = '{v}' THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END" for v in _BR)
       + " AS DOUBLE) type2_exact_hits"]
) + " FROM part"

ORACLE["adversary_presence"] = "SELECT user_id, " + ", ".join(
    [f"CAST(0.0 AS DOUBLE) adv_type_obs_{v}" for v in _EV]
    + [f"MAX(CASE WHEN event_type = '{v}' THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END) adv_type_{v}" for v in _EV]
) + f" FROM events WHERE ({_MOVE}) IS NOT NULL GROUP BY user_id"

_MEMBER_ARR = ("[1.0 - l_discount, l_quantity, l_extendedprice, l_tax, CAST(p_size AS DOUBLE), "
               "p_retailprice, l_discount, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, "
               + ", ".join(f"CASE WHEN l_linestatus = '{v}' THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END" for v in ["O", "F"]) + ", "
               + ", ".join(f"CASE WHEN l_returnflag = '{v}' THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END" for v in ["A", "N", "R"]) + ", "
               + ", ".join(f"CASE WHEN contains(p_type, '{v}') THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END" for v in _PT) + ", "
               + ", ".join(f"CASE WHEN contains(p_brand, '{v}') THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END" for v in _BR)
               + "]")
ORACLE["feature_vector_long"] = f"""
WITH {_RANKED}, {_ADV[1:]},
mem AS (SELECT l_orderkey o_orderkey, slot, UNNEST({_MEMBER_ARR}) v, UNNEST(generate_series(0, 32)) pos
        FROM ranked WHERE slot <= 6),
advl AS (SELECT o_orderkey, UNNEST([a0, a1, a2, {", ".join(f"CASE WHEN o_orderpriority = '{v}' THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END" for v in _PRIO)}]) v,
                UNNEST(generate_series(0, 7)) pos FROM adv)
SELECT o_orderkey, CAST((slot - 1) * 33 + pos AS INTEGER) position, ROUND(v, 6) value FROM mem WHERE v <> 0
UNION ALL
SELECT o_orderkey, CAST(198 + pos AS INTEGER) position, ROUND(v, 6) value FROM advl WHERE v <> 0
"""

_ROSTER_J = "lineitem l JOIN part p ON l.l_partkey = p.p_partkey"
ORACLE["team_means"] = f"""
SELECT l_orderkey, ROUND(AVG(l_quantity), 6) mean_l_quantity, ROUND(AVG(l_extendedprice), 6) mean_l_extendedprice,
       ROUND(AVG(l_discount), 6) mean_l_discount, ROUND(AVG(p_size), 6) mean_p_size
FROM {_ROSTER_J} GROUP BY l_orderkey
"""
ORACLE["type_coverage"] = f"""
SELECT l_orderkey, CAST(COUNT(DISTINCT t) AS BIGINT) type_coverage
FROM (SELECT l_orderkey, p_type t FROM {_ROSTER_J} UNION ALL SELECT l_orderkey, p_brand t FROM {_ROSTER_J})
GROUP BY l_orderkey
"""
ORACLE["mean_power"] = f"""
SELECT user_id, ROUND(AVG(power), 6) mean_power
FROM (SELECT user_id, {_MOVE} power FROM events) WHERE power IS NOT NULL GROUP BY user_id
"""
ORACLE["status_member_count"] = f"""
SELECT l_orderkey, CAST(COUNT(DISTINCT CASE WHEN l_returnflag = 'R' THEN p_name END) AS BIGINT) status_members
FROM {_ROSTER_J} GROUP BY l_orderkey
"""
ORACLE["team_difference"] = f"""
WITH a AS (SELECT l_orderkey, AVG(l_quantity) q, AVG(l_extendedprice) e FROM {_ROSTER_J} WHERE l_linestatus = 'O' GROUP BY 1),
b AS (SELECT l_orderkey, AVG(l_quantity) q, AVG(l_extendedprice) e FROM {_ROSTER_J} WHERE l_linestatus = 'F' GROUP BY 1)
SELECT a.l_orderkey, ROUND(a.q - b.q, 6) diff_l_quantity, ROUND(a.e - b.e, 6) diff_l_extendedprice
FROM a JOIN b ON a.l_orderkey = b.l_orderkey
"""
ORACLE["extreme_member"] = f"""
SELECT l_orderkey, MAX(p_size) max_p_size,
       arg_min(p_name, (-p_size, {_LINE_ORDER})) top_member
FROM {_ROSTER_J} GROUP BY l_orderkey
"""

_PC = "SELECT p_brand || p_type AS key, CAST(COUNT(*) AS BIGINT) count, MIN(p_partkey) first_pos FROM part GROUP BY 1"

ORACLE["content_count"] = "SELECT p_brand || p_type AS key, CAST(COUNT(*) AS BIGINT) count FROM part GROUP BY 1"

ORACLE["first_seen_record"] = """
SELECT p_brand || p_type AS key, CAST(COUNT(*) AS BIGINT) count, MIN(p_partkey) first_pos,
       arg_min(p_name, p_partkey) p_name, arg_min(p_size, p_partkey) p_size,
       arg_min(p_retailprice, p_partkey) p_retailprice
FROM part GROUP BY 1
"""

ORACLE["attribute_table"] = """
SELECT p_brand || p_type AS key, CAST(COUNT(*) AS BIGINT) count,
       CAST(CAST(arg_min(p_retailprice, p_partkey) AS VARCHAR) AS VARCHAR) retailprice,
       CAST(arg_min(p_size, p_partkey) AS VARCHAR) size,
       CAST(NULL AS VARCHAR) colour,
       CAST(arg_min(p_type, p_partkey) = 'PROMO' AS INTEGER) type_PROMO,
       CAST(arg_min(p_type, p_partkey) = 'SMALL' AS INTEGER) type_SMALL
FROM part GROUP BY 1
"""

ORACLE["class_frequency"] = """
SELECT p_brand AS key, CAST(COUNT(*) AS BIGINT) count,
       ROUND(COUNT(*) / SUM(COUNT(*)) OVER (), 6) freq
FROM part GROUP BY 1
"""

ORACLE["class_counts"] = """
SELECT (SELECT CAST(COUNT(*) AS BIGINT) FROM orders) total,
       (SELECT CAST(COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) FROM orders) wins,
       (SELECT CAST(COUNT(*) FILTER (WHERE o_orderstatus <> 'F') AS BIGINT) FROM orders) losses
"""

ORACLE["roster_counts"] = """
SELECT CAST(COUNT(*) AS BIGINT) members, CAST(COUNT(DISTINCT l_orderkey) AS BIGINT) matches
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
"""

_W = {
    "weights_inverse": "(1.0 / count) / SUM(1.0 / count) OVER () * COUNT(*) OVER ()",
    "weights_sqrt": "(1.0 / SQRT(count)) / SUM(1.0 / SQRT(count)) OVER () * COUNT(*) OVER ()",
    "weights_log": "(1.0 / LN(count + 1.0)) / SUM(1.0 / LN(count + 1.0)) OVER () * COUNT(*) OVER ()",
    "weights_minmax": "CASE WHEN MAX(count) OVER () = MIN(count) OVER () THEN 1.0 ELSE "
                      "(count - MIN(count) OVER ()) / (MAX(count) OVER () - MIN(count) OVER ()) END",
    "weights_zscore": "CASE WHEN STDDEV_POP(count) OVER () = 0 THEN 0.0 ELSE "
                      "(count - AVG(count) OVER ()) / STDDEV_POP(count) OVER () END",
}
for _k, _e in _W.items():
    ORACLE[_k] = f"""
SELECT key, count, ROUND({_e}, 6) weight, ROUND(count / SUM(count) OVER (), 6) freq FROM ({_PC})
"""

ORACLE["attach_weights"] = f"""
WITH w AS (SELECT key, (1.0 / SQRT(count)) / SUM(1.0 / SQRT(count)) OVER () * COUNT(*) OVER () weight FROM ({_PC}))
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, ROUND(COALESCE(w.weight, 1.0), 6) sample_weight
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
LEFT JOIN w ON w.key = p.p_brand || p.p_type
"""

_CMP = """
SELECT '{m}' AS method,
       arg_max(key, (count, -first_pos)) most_key, arg_min(key, (count, -first_pos)) least_key,
       ROUND(arg_max(w, (count, -first_pos)), 6) most_weight,
       ROUND(arg_min(w, (count, -first_pos)), 6) least_weight,
       ROUND(CASE WHEN arg_max(w, (count, -first_pos)) > 0
                  THEN arg_min(w, (count, -first_pos)) / arg_max(w, (count, -first_pos)) ELSE 0.0 END, 6) ratio
FROM (SELECT *, {e} w FROM ({pc}))
"""
ORACLE["weight_method_comparison"] = " UNION ALL ".join(
    _CMP.format(m=m, e=_W[q], pc=_PC) for m, q in
    [("inverse_frequency", "weights_inverse"), ("sqrt_inverse", "weights_sqrt"),
     ("log_inverse", "weights_log")])

_ENC = """
rows AS (SELECT p.p_name AS name, CASE WHEN o.o_orderstatus = 'F' THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END y,
                (l.l_orderkey * 31 + l.l_linenumber) % 5 fold
         FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
         JOIN orders o ON o.o_orderkey = l.l_orderkey
         WHERE p.p_name IS NOT NULL AND LENGTH(p.p_name) >= 1),
gm AS (SELECT AVG(y) g FROM rows),
per AS (SELECT name, fold, SUM(y) s, COUNT(*) n FROM rows GROUP BY 1, 2),
tot AS (SELECT name, SUM(s) S, SUM(n) N FROM per GROUP BY 1),
codes AS (SELECT per.name, AVG(CASE WHEN tot.N > per.n THEN (tot.S - per.s) / (tot.N - per.n) ELSE gm.g END) encoding,
                 CAST(MAX(tot.N) AS BIGINT) n
          FROM per JOIN tot ON per.name = tot.name CROSS JOIN gm GROUP BY per.name)"""

ORACLE["kfold_target_encoding"] = f"WITH {_ENC} SELECT name, ROUND(encoding, 6) encoding, n FROM codes"

ORACLE["member_code_mean"] = f"""
WITH {_ENC}
SELECT l.l_orderkey, ROUND(AVG(c.encoding), 6) member_code_mean
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey LEFT JOIN codes c ON c.name = p.p_name
GROUP BY l.l_orderkey
"""

ORACLE["distinct_field_values"] = """
SELECT DISTINCT json_extract_string(props, '$.k') AS value FROM events
WHERE json_extract_string(props, '$.k') IS NOT NULL
"""

_SD = """s AS (SELECT l.doc_id, CAST(l.quality AS INTEGER) y, (d.n_chars % 1000) / 1000.0 p
          FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"""

ORACLE["threshold_predictions"] = f"""
WITH {_SD} SELECT doc_id, ROUND(p, 6) p, CAST(CASE WHEN p >= 0.485 THEN 1 ELSE 0 END AS INTEGER) yhat FROM s
"""

ORACLE["accuracy"] = f"""
WITH {_SD}
SELECT ROUND(AVG(CASE WHEN y = CASE WHEN p >= 0.485 THEN 1 ELSE 0 END THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END), 6) accuracy,
       ROUND(AVG(CAST(y AS DOUBLE)), 6) positive_rate, CAST(COUNT(*) AS BIGINT) n FROM s
"""

ORACLE["confusion_matrix"] = f"""
WITH {_SD},
c AS (SELECT y, CASE WHEN p >= 0.485 THEN 1 ELSE 0 END yhat, COUNT(*) n FROM s GROUP BY 1, 2),
g AS (SELECT a.y, b.yhat FROM (VALUES (0),(1)) a(y) CROSS JOIN (VALUES (0),(1)) b(yhat)),
j AS (SELECT g.y, g.yhat, CAST(COALESCE(c.n, 0) AS BIGINT) n FROM g LEFT JOIN c ON c.y = g.y AND c.yhat = g.yhat)
SELECT CAST(y AS INTEGER) y, CAST(yhat AS INTEGER) yhat, n,
       ROUND(CASE WHEN SUM(n) OVER (PARTITION BY y) = 0 THEN NULL
                  ELSE n * 100.0 / SUM(n) OVER (PARTITION BY y) END, 6) row_pct
FROM j
"""

_CUM = f"""{_SD},
g AS (SELECT p score, SUM(y) pos, SUM(1 - y) neg FROM s GROUP BY 1),
c AS (SELECT score, pos, neg,
             SUM(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) tps,
             SUM(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) fps,
             ROW_NUMBER() OVER (ORDER BY score DESC) i FROM g),
t AS (SELECT SUM(pos) P, SUM(neg) N FROM g)"""

ORACLE["roc_points"] = f"""
WITH {_CUM},
k AS (SELECT c.*, LAG(tps) OVER w ptp, LEAD(tps) OVER w ntp, LAG(fps) OVER w pfp, LEAD(fps) OVER w nfp
      FROM c WINDOW w AS (ORDER BY i))
SELECT ROUND(score, 6) threshold, ROUND(fps / t.N, 6) fpr, ROUND(tps / t.P, 6) tpr
FROM k CROSS JOIN t
WHERE ptp IS NULL OR ntp IS NULL OR (pfp - 2 * fps + nfp) <> 0 OR (ptp - 2 * tps + ntp) <> 0
UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0
"""

ORACLE["roc_auc"] = f"""
WITH {_CUM}
SELECT ROUND(SUM(neg * (2 * tps - pos) / 2.0) / (MAX(t.P) * MAX(t.N)), 6) roc_auc FROM c CROSS JOIN t
"""

ORACLE["pr_points"] = f"""
WITH {_CUM}
SELECT ROUND(score, 6) threshold, ROUND(CAST(tps AS DOUBLE) / (tps + fps), 6) AS "precision",
       ROUND(tps / t.P, 6) recall FROM c CROSS JOIN t
UNION ALL SELECT CAST(NULL AS DOUBLE), 1.0, 0.0
"""

ORACLE["average_precision"] = f"""
WITH {_CUM}
SELECT ROUND(SUM(pos / t.P * (tps / (tps + fps))), 6) average_precision FROM c CROSS JOIN t
"""

ORACLE["score_histogram"] = f"""
WITH {_SD},
r AS (SELECT y, CASE WHEN MIN(p) = MAX(p) THEN MIN(p) - 0.5 ELSE MIN(p) END lo,
             CASE WHEN MIN(p) = MAX(p) THEN MAX(p) + 0.5 ELSE MAX(p) END hi, COUNT(*) n FROM s GROUP BY y),
b0 AS (SELECT s.y, s.p, r.lo, r.hi, r.n, (r.hi - r.lo) / 50.0 step,
              LEAST(CAST(FLOOR((s.p - r.lo) * (50.0 / (r.hi - r.lo))) AS INTEGER), 49) i0
       FROM s JOIN r ON r.y = s.y),
b1 AS (SELECT *, CASE WHEN p < (CASE WHEN i0 >= 50 THEN hi ELSE i0 * step + lo END) THEN i0 - 1 ELSE i0 END i1 FROM b0),
b2 AS (SELECT *, CASE WHEN i1 <> 49 AND p >= (CASE WHEN i1 + 1 >= 50 THEN hi ELSE (i1 + 1) * step + lo END)
                      THEN i1 + 1 ELSE i1 END bin FROM b1)
SELECT r.y, CAST(g.i AS INTEGER) bin, CAST(COUNT(b2.y) AS BIGINT) count,
       ROUND(r.lo + g.i * ((r.hi - r.lo) / 50.0), 6) bin_start,
       ROUND(COUNT(b2.y) / (r.n * ((r.hi - r.lo) / 50.0)), 6) density
FROM r CROSS JOIN range(50) g(i) LEFT JOIN b2 ON b2.y = r.y AND b2.bin = g.i
GROUP BY r.y, r.lo, r.hi, r.n, g.i
"""

_SWEEP = f"""{_SD},
grid AS (SELECT CAST(i AS INTEGER) i, CASE WHEN i = 99 THEN 1.0 ELSE i * (1.0 / 99.0) END threshold
         FROM range(100) t(i)),
c AS (SELECT g.i, g.threshold,
             CAST(SUM(CASE WHEN s.p >= g.threshold AND s.y = 1 THEN 1 ELSE 0 END) AS DOUBLE) tp,
             CAST(SUM(CASE WHEN s.p >= g.threshold AND s.y = 0 THEN 1 ELSE 0 END) AS DOUBLE) fp,
             CAST(SUM(CASE WHEN s.p < g.threshold AND s.y = 1 THEN 1 ELSE 0 END) AS DOUBLE) fn,
             CAST(SUM(CASE WHEN s.p < g.threshold AND s.y = 0 THEN 1 ELSE 0 END) AS DOUBLE) tn,
             CAST(COUNT(*) AS DOUBLE) n
      FROM grid g CROSS JOIN s GROUP BY g.i, g.threshold),
m AS (SELECT i, threshold, (tp + tn) / n accuracy,
             CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS "precision",
             CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END recall FROM c),
f AS (SELECT *, CASE WHEN "precision" + recall > 0 THEN 2 * "precision" * recall / ("precision" + recall) ELSE 0.0 END f1 FROM m)"""

ORACLE["threshold_sweep"] = f"""
WITH {_SWEEP}
SELECT i, ROUND(threshold, 6) threshold, ROUND(accuracy, 6) accuracy, ROUND("precision", 6) AS "precision",
       ROUND(recall, 6) recall, ROUND(f1, 6) f1 FROM f
"""

ORACLE["best_threshold"] = f"""
WITH {_SWEEP}
SELECT ROUND(arg_max(threshold, (accuracy, -i)), 6) threshold, ROUND(MAX(accuracy), 6) accuracy FROM f
"""

_EMB = """e AS (SELECT vec_id, CAST(UNNEST(embedding) AS DOUBLE) x, UNNEST(generate_series(0, len(embedding) - 1)) dim
           FROM embeddings),
st AS (SELECT dim, AVG(x) mu, STDDEV_POP(x) sd FROM e GROUP BY dim)"""

ORACLE["standardise_exact"] = f"""
WITH {_EMB}
SELECT e.vec_id, CAST(e.dim AS INTEGER) dim, ROUND((e.x - st.mu) / CASE WHEN st.sd > 0 THEN st.sd ELSE 1.0 END, 6) z
FROM e JOIN st ON st.dim = e.dim
"""

ORACLE["mean_centre"] = f"""
WITH {_EMB}
SELECT e.vec_id, CAST(e.dim AS INTEGER) dim, ROUND(e.x - st.mu, 6) c FROM e JOIN st ON st.dim = e.dim
"""

ORACLE["standardise_exact_lineitem"] = """
WITH e AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
                  UNNEST([l_quantity, l_extendedprice, l_discount, l_tax, CAST(l_linenumber AS DOUBLE)]) x,
                  UNNEST([0, 1, 2, 3, 4]) dim FROM lineitem),
st AS (SELECT dim, AVG(x) mu, STDDEV_POP(x) sd FROM e GROUP BY dim)
SELECT e.l_orderkey, e.l_linenumber, e.l_partkey, e.l_suppkey, CAST(e.dim AS INTEGER) dim,
       ROUND((e.x - st.mu) / CASE WHEN st.sd > 0 THEN st.sd ELSE 1.0 END, 6) z
FROM e JOIN st ON st.dim = e.dim
"""

ORACLE["hash_split"] = """
SELECT o_orderkey, ((o_orderkey * 7919) % 1000000) < 150000 is_test FROM orders
"""

ORACLE["exact_split"] = """
SELECT o_orderkey,
       ROW_NUMBER() OVER (ORDER BY (o_orderkey * 7919) % 1000, o_orderkey) - 1
         < CEIL((SELECT COUNT(*) FROM orders) * 0.15) is_test
FROM orders
"""

ORACLE["soft_vote_mean"] = """
SELECT l_orderkey, l_linenumber, l_partkey,
       ROUND((l_discount * 10.0 + l_tax * 12.5 + l_quantity / 50.0) / 3.0, 6) probability,
       CAST(CASE WHEN ROUND((l_discount * 10.0 + l_tax * 12.5 + l_quantity / 50.0) / 3.0, 9) >= 0.45
                 THEN 1 ELSE 0 END AS INTEGER) prediction
FROM lineitem
"""

ORACLE["json_field_project"] = """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) k FROM events
"""

ORACLE["nested_path_explode"] = """
SELECT event_id, key, CAST(json_extract_string(props, '$.' || key) AS BIGINT) value
FROM (SELECT event_id, props, UNNEST(json_keys(props)) key FROM events)
"""

ORACLE["default_weight_projection"] = """
SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, p.p_size,
       CAST(p.p_type = 'SMALL' OR p.p_brand = 'SMALL' AS INTEGER) type_SMALL,
       CAST(p.p_type = 'Brand#13' OR p.p_brand = 'Brand#13' AS INTEGER) "type_Brand#13",
       CAST(1.0 AS DOUBLE) sample_weight
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
WHERE p.p_name IS NOT NULL AND p.p_name <> ''
"""

ORACLE["numeric_projection"] = """
SELECT l_discount, l_extendedprice, l_linenumber, l_quantity, l_tax FROM lineitem
"""

ORACLE["malformed_record_report"] = """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'malformed record' ELSE 'missing field k' END reason
FROM events WHERE event_type IN ('error', 'signup') OR json_extract(props, '$.k') IS NULL
"""

ORACLE["position_identity"] = """
SELECT o_orderkey, CAST(ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) battle_id FROM orders
"""

ORACLE["row_identity"] = """
SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) - 1 battle_id FROM orders
"""

ORACLE["prediction_diff"] = f"""
WITH {_SD}
SELECT CAST(COUNT(*) AS BIGINT) compared,
       CAST(COUNT(*) FILTER (WHERE (p >= 0.5) <> (p >= 0.485)) AS BIGINT) differing,
       ROUND(COUNT(*) FILTER (WHERE (p >= 0.5) <> (p >= 0.485)) * 100.0 / COUNT(*), 6) diff_pct
FROM s
"""

ORACLE["damage_total"] = """
WITH l AS (SELECT user_id, value,
                  LAG(value) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) prev FROM events)
SELECT user_id, ROUND(COALESCE(SUM(GREATEST(prev - value, 0.0)), 0.0), 6) damage FROM l GROUP BY user_id
"""

ORACLE["switch_and_ko"] = """
WITH l AS (SELECT user_id, event_type,
                  LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) prev FROM events)
SELECT user_id,
       CAST(COUNT(*) FILTER (WHERE prev IS NOT NULL AND event_type <> prev) AS BIGINT) switches,
       CAST(COUNT(*) FILTER (WHERE event_type = 'error' AND prev IS NOT NULL AND prev <> 'error') AS BIGINT) knockouts
FROM l GROUP BY user_id
"""

ORACLE["status_inflictions"] = """
WITH s AS (SELECT user_id, ts, event_id, CASE WHEN value >= 100.0 THEN 'psn' ELSE 'nostatus' END st FROM events),
l AS (SELECT user_id, st, LAG(st) OVER (PARTITION BY user_id ORDER BY ts, event_id) prev FROM s)
SELECT user_id, CAST(COUNT(*) FILTER (WHERE prev IS NOT NULL AND st <> prev AND st <> 'nostatus') AS BIGINT) inflictions
FROM l GROUP BY user_id
"""

ORACLE["matchup_join"] = """
SELECT l.l_orderkey, ROUND(AVG((n.n_regionkey + 1) / 5.0), 6) mean_multiplier,
       CAST(COUNT((n.n_regionkey + 1) / 5.0) AS BIGINT) charted_members
FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey
LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey
GROUP BY l.l_orderkey
"""

ORACLE["order_feature_vectors"] = f"""
WITH {_RANKED}, {_ADV[1:]},
mem AS (SELECT l_orderkey o_orderkey, UNNEST({_MEMBER_ARR}) v FROM ranked WHERE slot <= 6),
advl AS (SELECT o_orderkey, UNNEST([a0, a1, a2, {", ".join(f"CASE WHEN o_orderpriority = '{v}' THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END" for v in _PRIO)}]) v FROM adv),
allv AS (SELECT * FROM mem UNION ALL SELECT * FROM advl)
SELECT o.o_orderkey, CASE WHEN o.o_orderstatus = 'F' THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END label, 206 width,
       CAST(COUNT(*) FILTER (WHERE a.v <> 0) AS INTEGER) nonzero, ROUND(SUM(a.v), 3) total
FROM orders o JOIN allv a ON a.o_orderkey = o.o_orderkey
GROUP BY o.o_orderkey, o.o_orderstatus
"""

ORACLE["streaming_state_fold"] = """
WITH last_ev AS (SELECT user_id, value, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM events),
last_m AS (SELECT user_id, event_type, value,
                  ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) rn FROM events),
agg AS (SELECT user_id, CAST(COUNT(*) AS BIGINT) turns,
               CAST(6 - COUNT(*) FILTER (WHERE event_type = 'error') AS BIGINT) alive,
               CAST(1 + COUNT(*) - COUNT(*) FILTER (WHERE event_type = 'error') AS BIGINT) discovered_alive
        FROM events GROUP BY user_id),
hp AS (SELECT user_id,
              MAX(CASE WHEN event_type = 'click' THEN value END) hc, MAX(CASE WHEN event_type = 'view' THEN value END) hv,
              MAX(CASE WHEN event_type = 'purchase' THEN value END) hpu, MAX(CASE WHEN event_type = 'signup' THEN value END) hs,
              MAX(CASE WHEN event_type = 'error' THEN value END) he
       FROM last_m WHERE rn = 1 GROUP BY user_id)
SELECT a.user_id, a.turns, a.alive, a.discovered_alive, ROUND(l.value, 6) leader_value,
       ROUND(COALESCE(hp.hc, 1.0), 6) hp_click, ROUND(COALESCE(hp.hv, 1.0), 6) hp_view,
       ROUND(COALESCE(hp.hpu, 1.0), 6) hp_purchase, ROUND(COALESCE(hp.hs, 1.0), 6) hp_signup,
       ROUND(COALESCE(hp.he, 1.0), 6) hp_error
FROM agg a JOIN last_ev l ON l.user_id = a.user_id AND l.rn = 1 LEFT JOIN hp ON hp.user_id = a.user_id
"""

_STEPS = """steps AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS y, unnest([0, 1, 2, 3]) AS feature,
         unnest([CAST(l_quantity AS DOUBLE), CAST(l_discount AS DOUBLE), CAST(l_tax AS DOUBLE), CAST(l_linenumber AS DOUBLE)]) AS x
  FROM lineitem)"""

_BORDERS = f"""{_STEPS},
prior AS (SELECT avg(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS p, count(*) AS n FROM lineitem),
per AS (SELECT feature, x, count(*) AS n, sum(y::DOUBLE) AS pos FROM steps GROUP BY feature, x),
below AS (SELECT feature, (x + lead(x) OVER w) / 2.0 AS border, sum(n) OVER w AS nl, sum(pos) OVER w AS pl FROM per
          WINDOW w AS (PARTITION BY feature ORDER BY x)),
sums AS (SELECT feature, border, CAST(nl AS BIGINT) AS nl, nl * p.p - pl AS gl, nl * p.p * (1 - p.p) AS hl, 0.0::DOUBLE AS g,
                p.n * p.p * (1 - p.p) AS h, p.n AS n FROM below, prior p WHERE border IS NOT NULL)"""

_SOFT = "power(greatest(abs({g}) - 0.3, 0.0), 2) / ({h} + 2.0)"

ORACLE["boost_split_gains"] = f"""
WITH {_BORDERS}
SELECT CAST(feature AS INTEGER) AS feature, ROUND(border, 6) AS border, ROUND(gl, 4) AS gl, ROUND(hl, 4) AS hl, nl,
       CASE WHEN hl >= 8 AND h - hl >= 8 THEN ROUND({_SOFT.format(g='gl', h='hl')} + {_SOFT.format(g='(g - gl)', h='(h - hl)')}
            - {_SOFT.format(g='g', h='h')}, 4) END AS gain
FROM sums"""

ORACLE["gradient_split_gains"] = f"""
WITH {_BORDERS}
SELECT CAST(feature AS INTEGER) AS feature, ROUND(border, 6) AS border, ROUND(gl, 4) AS gl, nl,
       CASE WHEN nl >= 8 AND n - nl >= 8 THEN ROUND(nl * (n - nl) / n::DOUBLE * power(gl / nl - (g - gl) / (n - nl), 2), 4) END AS gain
FROM sums"""

ORACLE["extra_tree_splits"] = f"""
WITH {_STEPS},
z0 AS (SELECT unnest(range(24)) AS tree), z1 AS (SELECT tree, (42 + tree) % 2147483647 AS z FROM z0),
z2 AS (SELECT tree, (z * z + 48271 * z + 12345) % 2147483647 AS z FROM z1),
z3 AS (SELECT tree, (z * z + 48271 * z + 12345) % 2147483647 AS z FROM z2),
z4 AS (SELECT tree, feature, (z + feature) % 2147483647 AS z FROM z3, (SELECT unnest([0, 1, 2, 3]) AS feature) f),
drawn AS (SELECT tree, feature, ((z * z + 48271 * z + 12345) % 2147483647) / 2147483647.0::DOUBLE AS u FROM z4),
span AS (SELECT feature, min(x) AS low, max(x) AS high, count(*) AS n, sum(y::DOUBLE) AS pos FROM steps GROUP BY feature),
cuts AS (SELECT d.tree, s.*, s.low + d.u * (s.high - s.low) AS threshold FROM drawn d JOIN span s USING (feature)),
counted AS (SELECT c.tree, c.feature, c.low, c.high, c.threshold, c.n, c.pos, sum(CASE WHEN t.x <= c.threshold THEN t.k ELSE 0 END) AS nl,
                   sum(CASE WHEN t.x <= c.threshold THEN t.pos ELSE 0 END) AS pl
            FROM cuts c JOIN (SELECT feature, x, count(*) AS k, sum(y::DOUBLE) AS pos FROM steps GROUP BY feature, x) t USING (feature)
            GROUP BY ALL)
SELECT CAST(tree AS INTEGER) AS tree, CAST(feature AS INTEGER) AS feature, low, high, ROUND(threshold, 6) AS threshold,
       CAST(nl AS BIGINT) AS n_left, CAST(pl AS BIGINT) AS pos_left,
       ROUND(2.0 * pos * (n - pos) / n - CASE WHEN nl > 0 THEN 2.0 * pl * (nl - pl) / nl ELSE 0.0 END
             - CASE WHEN n > nl THEN 2.0 * (pos - pl) * (n - nl - pos + pl) / (n - nl) ELSE 0.0 END, 4) AS gain
FROM counted"""

_FOLDS = """placed AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY (l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31) % 100003,
                               l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS i FROM lineitem),
total AS (SELECT COUNT(*) AS n FROM lineitem),
folded AS (SELECT placed.*, CASE WHEN i < (n % 5) * (n // 5 + 1) THEN i // (n // 5 + 1)
                                 ELSE n % 5 + (i - (n % 5) * (n // 5 + 1)) // (n // 5) END AS fold FROM placed, total)"""

ORACLE["exact_folds"] = f"""
WITH {_FOLDS} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(fold AS INTEGER) AS fold FROM folded"""

ORACLE["exact_fold_encoding"] = f"""
WITH {_FOLDS},
rows AS (SELECT l_partkey || '/' || l_suppkey AS name, CASE WHEN l_linestatus = 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y, fold FROM folded),
gm AS (SELECT AVG(y) AS g FROM rows),
per AS (SELECT name, fold, SUM(y) AS s, COUNT(*) AS n FROM rows GROUP BY 1, 2),
tot AS (SELECT name, SUM(s) AS S, SUM(n) AS N FROM per GROUP BY 1)
SELECT per.name, ROUND(AVG(CASE WHEN tot.N > per.n THEN (tot.S - per.s) / (tot.N - per.n) ELSE gm.g END), 6) AS encoding,
       CAST(MAX(tot.N) AS BIGINT) AS n
FROM per JOIN tot ON per.name = tot.name CROSS JOIN gm GROUP BY per.name"""

ORACLE["malformed_line_numbers"] = """
WITH placed AS (SELECT event_id, event_type, CAST(SUM(CASE WHEN event_type = 'view' THEN 2 ELSE 1 END) OVER (ORDER BY event_id) AS BIGINT) AS line
                FROM events)
SELECT event_id, line FROM placed WHERE event_type = 'error'
"""

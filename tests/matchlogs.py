"""Synthetic match-log records (one per trap listed in FIXTURES.md) and a
writer to JSONL."""

from __future__ import annotations

import json
import os


def member(name, types=("normal", "notype"), hp=100.0, atk=50.0):
    return {"name": name, "types": list(types), "base_hp": hp, "base_atk": atk, "base_def": 40.0,
            "base_spa": 30.0, "base_spd": 20.0, "base_spe": 10.0}


def state(name, hp, status="nostatus", effects=None):
    return {"name": name, "hp_pct": hp, "status": status, "effects": effects or ["noeffect"]}


def move(name, category="physical", mtype="normal", power=80.0, acc=100.0, prio=0.0):
    return {"name": name, "category": category, "type": mtype, "base_power": power,
            "accuracy": acc, "priority": prio}


def turn(p1, hp1, p2, hp2, m1=None, m2=None, status1="nostatus"):
    return {"p1_pokemon_state": state(p1, hp1, status1), "p2_pokemon_state": state(p2, hp2),
            "p1_move_details": m1, "p2_move_details": m2}


def record(bid, team, timeline, won=True):
    return {"battle_id": bid, "player_won": won, "p1_team_details": team,
            "p2_lead_details": {"name": "opp"}, "battle_timeline": timeline}


def write_jsonl(path, records, extra_lines=()):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        for r in records:
            fh.write(json.dumps(r) + "\n")
        for line in extra_lines:
            fh.write(line + "\n")
    return path


def random_matches(n, seed=0, start_id=0):
    """``n`` random matches; player 1 tends to win when its members keep HP."""
    import random
    from turnfold.schema import STATUS_VOCAB, TYPE_VOCAB
    rnd = random.Random(seed)
    names = [f"mon{i}" for i in range(30)]
    moves = [(f"mv{i}", rnd.choice(["physical", "special", "status"]), rnd.choice(TYPE_VOCAB[:-1]))
             for i in range(40)]
    out = []
    for b in range(n):
        team_names = rnd.sample(names, 6)
        team = [member(t, (rnd.choice(TYPE_VOCAB[:-1]), rnd.choice(TYPE_VOCAB)),
                       hp=float(rnd.randint(40, 120)), atk=float(rnd.randint(40, 120)))
                for t in team_names]
        tl = []
        hp_sum = 0.0
        for t in range(rnd.randint(3, 20)):
            active = rnd.choice(team_names[:4])
            hp1 = round(rnd.random(), 2)
            hp_sum += hp1
            mv = rnd.choice(moves)
            m1 = move(mv[0], mv[1], mv[2], float(rnd.randint(0, 120))) if rnd.random() < 0.8 else None
            mv2 = rnd.choice(moves)
            m2 = move(mv2[0], mv2[1], mv2[2]) if rnd.random() < 0.8 else None
            tl.append(turn(active, hp1, f"opp{rnd.randint(0, 5)}", rnd.choice([0.0, 0.3, 0.7, 1.0]),
                           m1, m2, status1=rnd.choice(STATUS_VOCAB)))
        won = hp_sum / len(tl) + rnd.random() * 0.3 > 0.6
        out.append(record(start_id + b, team, tl, won))
    return out

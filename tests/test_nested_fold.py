"""Match-log fold and the 984-wide vector on hand-built records (FIXTURES §3)."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from matchlogs import member, move, record, state, turn, write_jsonl  # noqa: F401
from turnfold import schema as S
from turnfold.operators import features as FT
from turnfold.operators import timeline as TL
from turnfold.sources import logs as LG


def _records():
    A, B, C = member("a", ("fire", "notype")), member("b", ("water", "psychic")), member("c")
    recs = [
        record(1, [A, B, C], [turn("a", 0.9, "x", 1.0), turn("b", 0.7, "x", 0.8),
                              turn("a", 0.4, "y", 0.6)]),
        record(2, [A, B], [turn("a", 1.0, "x", 0.5), turn("a", 1.0, "x", 0.0),
                           turn("a", 1.0, "y", 0.0)]),
        record(3, [A], [turn("a", 1.0, "x", 0.0)] * 7, won=False),
        record(4, [A, B], [turn("a", 1.0, "x", 1.0, m1=move("m")),
                           turn("b", 1.0, "x", 1.0, m1=move("m"))]),
        record(5, [A], [turn("a", 1.0, "x", 1.0, m1=move(f"m{i}", power=10.0 * (i + 1)))
                        for i in range(5)]),
        record(6, [A], [turn("a", 1.0, "x", 1.0, m1=None, m2=None)]),
        record(7, [A, B, C], [turn("a", 1.0, "x", 1.0, m1=move("p", category="physical")),
                              turn("b", 1.0, "x", 1.0, m1=move("q", category="PHYSICAL")),
                              turn("c", 1.0, "x", 1.0, m1=move("r", category="special"))]),
        record(8, [A, member("a")], [turn("a", 0.3, "x", 1.0)]),
        record(9, [A], [turn("zzz", 0.3, "x", 1.0)]),
        record(10, [A], []),
        record(11, [A, member("d", ("firewater", "notype"))], [turn("d", 0.5, "x", 0.9)]),
    ]
    return recs


@pytest.fixture(scope="module")
def folded(spark, tmp_path_factory):
    path = write_jsonl(str(tmp_path_factory.mktemp("logs") / "train.jsonl"), _records())
    df = LG.read_match_logs(spark, path)
    state_df = TL.fold_match_logs(df)
    ok, bad = TL.split_rejects(state_df)
    feats = FT.match_features(ok).select("battle_id", vector_to_array("features").alias("v"))
    return ({r.battle_id: r for r in ok.collect()},
            {r.battle_id: r.reject_reason for r in bad.collect()},
            {r.battle_id: r.v for r in feats.collect()})


def test_width_and_layout():
    assert S.FEATURE_WIDTH == 984 and S.MEMBER_WIDTH == 159 and len(S.feature_names()) == 984
    assert S.feature_names()[954] == "team2_pkmn_alive"


def test_last_hp(folded):
    ok, _, v = folded
    assert [m.hps for m in ok[1].team1] == [0.4, 0.7, 1.0]
    assert v[1][0] == 0.4 and v[1][159] == 0.7 and v[1][318] == 1.0
    assert v[1][956] == 0.6                       # leader HP = last turn's opponent HP


def test_alive_counters(folded):
    ok, _, v = folded
    assert ok[2].team2.pkmn_alive == 4 and ok[2].team2.pkmn_dscvrd_alive == 2
    assert ok[3].team2.pkmn_alive == -1
    assert v[2][954] == 4 and v[2][955] == 2


def test_move_dedup_per_match(folded):
    ok, _, _ = folded
    assert [m.name for m in ok[4].team1[0].moves] == ["m"]
    assert ok[4].team1[1].moves == []


def test_move_truncation(folded):
    ok, _, v = folded
    assert len(ok[5].team1[0].moves) == 5            # list unbounded
    powers = [v[5][67 + 23 * j] for j in range(4)]   # features keep the first 4
    assert powers == [10.0, 20.0, 30.0, 40.0]


def test_null_move(folded):
    ok, _, _ = folded
    assert ok[6].team1[0].moves == [] and ok[6].team2.moves == []


def test_category_case(folded):
    ok, _, _ = folded
    cats = [ok[7].team1[i].moves[0].cat for i in range(3)]
    assert cats == [1, 0, 0]


def test_duplicate_roster_name(folded):
    ok, _, _ = folded
    assert [m.hps for m in ok[8].team1] == [0.3, 1.0]


def test_rejects(folded):
    _, bad, _ = folded
    assert bad == {9: "unknown active member", 10: "empty timeline"}


def test_short_roster_and_substring_types(folded):
    _, _, v = folded
    row = v[11]
    assert len(row) == 984
    assert all(x == 0.0 for x in row[318:954])
    t1 = 159 + 29
    hot = [S.TYPE_VOCAB[i] for i in range(19) if row[t1 + i] == 1.0]
    assert hot == ["fire", "water"]                  # 'in' is a substring test (Q11)
    assert row[159] == 0.5


def test_corrected_semantics(spark, tmp_path):
    recs = [record(1, [member("a"), member("b")],
                   [turn("a", 1.0, "x", 0.0, m1=move("m")), turn("b", 1.0, "x", 0.0, m1=move("m")),
                    turn("a", 1.0, "y", 0.5, status1="par")])]
    path = write_jsonl(str(tmp_path / "c.jsonl"), recs)
    st = TL.fold_match_logs(LG.read_match_logs(spark, path), semantics="corrected").first()
    assert st.team2.pkmn_alive == 5 and st.team2.pkmn_dscvrd_alive == 1
    assert [m.name for m in st.team1[1].moves] == ["m"]
    assert st.team1[0].status == "par"


def test_blank_and_malformed_lines(spark, tmp_path):
    recs = [record(1, [member("a")], [turn("a", 1.0, "x", 1.0)])]
    p1 = write_jsonl(str(tmp_path / "blank.jsonl"), recs, extra_lines=["", "   "])
    assert LG.read_match_logs(spark, p1).count() == 1
    p2 = write_jsonl(str(tmp_path / "bad.jsonl"), recs, extra_lines=["{bad"])
    with pytest.raises(Exception):
        LG.read_match_logs(spark, p2).collect()
    good, bad = LG.read_with_rejects(spark, p2)
    assert good.count() == 1 and bad.count() == 1


def test_position_ids_and_required_fields(spark, tmp_path):
    recs = [record(None, [member("a")], [turn("a", 1.0, "x", 1.0)]) for _ in range(5)]
    recs[2]["p2_lead_details"] = None
    path = write_jsonl(str(tmp_path / "ids.jsonl"), recs)
    df = LG.with_position_id(LG.read_match_logs(spark, path))
    assert sorted(r.battle_id for r in df.collect()) == [0, 1, 2, 3, 4]
    ok, rej = LG.require_fields(df)
    assert ok.count() == 4 and [r.reason for r in rej.collect()] == ["missing field p2_lead_details"]


def test_unlabelled_fold(spark, tmp_path):
    path = write_jsonl(str(tmp_path / "t.jsonl"), [record(7, [member("a")], [turn("a", 1.0, "x", 1.0)])])
    st = TL.fold_match_logs(LG.read_match_logs(spark, path), is_train=False).first()
    assert st.win == -1


def test_fold_plan_has_no_shuffle(spark, tmp_path):
    path = write_jsonl(str(tmp_path / "p.jsonl"), _records())
    df = FT.match_features(TL.split_rejects(TL.fold_match_logs(LG.read_match_logs(spark, path)))[0])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan

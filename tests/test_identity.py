"""Record identity, rejects and null groups."""

import json

import pytest
from pyspark.sql import functions as F

from matchlogs import member, record, turn, write_jsonl
from turnfold.functions import ordering as OR
from turnfold.operators import timeline as TL
from turnfold.sources import logs as LG


def rows(ids):
    return [record(i, [member("a")], [turn("a", 1.0, "x", 1.0)]) for i in ids]


def test_mixed_keys_give_positions_to_all(spark, tmp_path):
    df = LG.read_match_logs(spark, write_jsonl(str(tmp_path / "a.jsonl"), rows([1, None, 7])))
    assert sorted(r.battle_id for r in LG.with_position_id(df).collect()) == [0, 1, 2]


def test_full_keys_stay_and_must_be_unique(spark, tmp_path):
    df = LG.read_match_logs(spark, write_jsonl(str(tmp_path / "a.jsonl"), rows([5, 9])))
    assert sorted(r.battle_id for r in LG.with_position_id(df).collect()) == [5, 9]
    df = LG.read_match_logs(spark, write_jsonl(str(tmp_path / "b.jsonl"), rows([5, 5])))
    with pytest.raises(ValueError):
        LG.with_position_id(df)


def test_damaged_line_stops_the_plain_reader(spark, tmp_path):
    path = tmp_path / "bad.jsonl"
    path.write_text(json.dumps(rows([1])[0]) + "\n{broken\n")
    with pytest.raises(Exception):
        LG.read_match_logs(spark, str(path)).collect()


def test_absent_label_or_lead_is_rejected(spark, tmp_path):
    recs = rows([1, 2, 3])
    del recs[0]["player_won"]
    recs[1]["p2_lead_details"] = None
    df = LG.read_match_logs(spark, write_jsonl(str(tmp_path / "a.jsonl"), recs))
    got = {r.battle_id: (r.win, r.reject_reason) for r in TL.fold_match_logs(df).collect()}
    assert got[1][1] == got[2][1] == "missing field" and got[1][0] is None and got[3][1] is None
    scored = {r.battle_id: r.reject_reason for r in TL.fold_match_logs(df, is_train=False).collect()}
    assert scored[1] is None and scored[2] == "missing field"


def test_null_groups_are_groups(spark):
    df = spark.createDataFrame([(None, 1, 10), (None, 2, 20), ("a", 1, 30), ("a", 2, 40)], "g string, o int, v int")
    lag = {(r.g, r.o): r.prev_v for r in OR.with_lag(df, ["g"], ["o"], ["v"], num_partitions=3).collect()}
    assert lag == {(None, 1): None, (None, 2): 10, ("a", 1): None, ("a", 2): 30}
    rn = {(r.g, r.o): r.rn for r in OR.group_row_number(df, ["g"], ["o"], num_partitions=3).collect()}
    assert rn == {(None, 1): 1, (None, 2): 2, ("a", 1): 1, ("a", 2): 2}
    assert df.where(F.col("g").isNull()).count() == 2


def test_line_numbers_count_blank_lines_and_splits(spark, tmp_path):
    good = [json.dumps(r) for r in rows(range(400))]
    lines = []
    for i, x in enumerate(good):
        lines += [x] + (["", "  \t "] if i % 7 == 0 else []) + (["{broken %d" % i] if i % 50 == 3 else [])
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.jsonl").write_text("\n".join(lines) + "\n")
    (tmp_path / "d" / "b.jsonl").write_text("\r\n".join(["[1, 2", *lines[:40]]))
    want = [("a.jsonl", n, x) for n, x in enumerate(lines, 1) if x.startswith("{broken")]
    want += [("b.jsonl", 1, "[1, 2")] + [("b.jsonl", n + 1, x) for n, x in enumerate(lines[:40], 1) if x.startswith("{broken")]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (before, "3000"):  # the second cuts a file into many splits
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            ok, bad = LG.read_with_rejects(spark, str(tmp_path / "d"))
            got = sorted((r["_file"].rsplit("/", 1)[1], r["line"], r["record"]) for r in bad.collect())
            assert got == sorted(want)
            assert ok.count() == 400 + sum(x.startswith('{"') for x in lines[:40])
            ids = LG.with_position_id(spark.read.schema(ok.schema).json(str(tmp_path / "d" / "a.jsonl")))
            plan = ids._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning" not in plan and "rangepartitioning" not in plan
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    with pytest.raises(LG.BadRecord, match="a.jsonl, line 7:"):
        LG.read_strict(spark, str(tmp_path / "d"))
    (tmp_path / "d" / "a.jsonl").write_text("\n".join(good))
    (tmp_path / "d" / "b.jsonl").write_text("")
    assert LG.read_strict(spark, str(tmp_path / "d")).count() == 400


def test_positions_follow_file_order_over_splits(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for f, lo in (("a", 0), ("b", 300), ("c", 450)):
        hi = {"a": 300, "b": 450, "c": 500}[f]
        (tmp_path / "d" / f"{f}.jsonl").write_text("\n".join(json.dumps({"v": i}) + ("\n" if i % 9 == 0 else "") for i in range(lo, hi)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
        df = LG.with_position_id(spark.read.schema("v long").json(str(tmp_path / "d")))
        assert sorted((r.battle_id, r.v) for r in df.collect()) == [(i, i) for i in range(500)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)

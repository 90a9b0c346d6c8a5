"""Weights, encodings and content keys (FIXTURES §3 cases)."""

import pytest
from pyspark.sql import functions as F

from turnfold.operators import weights as WT


def _counts(spark, counts):
    return spark.createDataFrame([(f"k{i}", c, i) for i, c in enumerate(counts)],
                                 "key string, count long, first_pos long")


def test_inverse_frequency_renormalised(spark):
    out = {r.key: r.weight for r in WT.normalise_counts(_counts(spark, [1, 4])).collect()}
    assert out["k0"] == pytest.approx(1.6) and out["k1"] == pytest.approx(0.4)
    assert sum(out.values()) == pytest.approx(2.0)


def test_equal_counts(spark):
    mm = [r.weight for r in WT.normalise_counts(_counts(spark, [3, 3]), "min_max").collect()]
    zs = [r.weight for r in WT.normalise_counts(_counts(spark, [3, 3]), "z_score").collect()]
    assert mm == [1.0, 1.0] and zs == [0.0, 0.0]


def test_frequency_sums_to_one_and_unknown_method(spark):
    out = WT.normalise_counts(_counts(spark, [2, 5, 9]), "log_inverse")
    assert out.agg(F.sum("freq")).first()[0] == pytest.approx(1.0)
    with pytest.raises(ValueError):
        WT.normalise_counts(_counts(spark, [2]), "bogus")
    empty = spark.createDataFrame([], "key string, count long")
    assert WT.normalise_counts(empty, "bogus").count() == 0


def test_method_comparison_ties(spark):
    c = _counts(spark, [5, 1, 5, 1])
    rows = WT.method_comparison(c).collect()
    assert {r.most_key for r in rows} == {"k0"} and {r.least_key for r in rows} == {"k3"}
    r = [x for x in rows if x.method == "inverse_frequency"][0]
    assert r.ratio == pytest.approx(5.0)


def test_target_encoding_single_fold_name(spark):
    rows = [("a", 1, 0), ("a", 0, 1), ("b", 1, 0), ("b", 1, 1), ("c", 0, 2), ("c", 0, 2)]
    df = spark.createDataFrame(rows, "name string, y int, fold int")
    enc = {r.name: r.encoding for r in
           WT.kfold_target_encoding(df, "name", F.col("y"), F.col("fold")).collect()}
    gm = 3 / 6
    assert enc["c"] == pytest.approx(gm)            # all rows in one fold -> global mean
    assert enc["a"] == pytest.approx((0 + 1) / 2)   # fold0 sees a's fold1 mean 0, fold1 sees 1
    assert enc["b"] == pytest.approx(1.0)


def test_target_encoding_matches_loop(spark):
    import random
    rnd = random.Random(3)
    rows = [(rnd.choice("abcdefg"), rnd.randint(0, 1), rnd.randint(0, 4)) for _ in range(400)]
    df = spark.createDataFrame(rows, "name string, y int, fold int")
    got = {r.name: r.encoding for r in
           WT.kfold_target_encoding(df, "name", F.col("y"), F.col("fold")).collect()}
    gm = sum(r[1] for r in rows) / len(rows)
    want = {}
    for f in range(5):
        train = [r for r in rows if r[2] != f]
        val = {r[0] for r in rows if r[2] == f}
        for n in val:
            ys = [r[1] for r in train if r[0] == n]
            want.setdefault(n, []).append(sum(ys) / len(ys) if ys else gm)
    for n, v in want.items():
        assert got[n] == pytest.approx(sum(v) / len(v))


def test_content_key_python_spelling(spark):
    df = spark.createDataFrame([("x", 1.0, True, ["a", "b"], 12)],
                               "s string, d double, b boolean, t array<string>, i int")
    key = df.select(WT.content_key(df, ["s", "d", "b", "t", "i"]).alias("k")).first().k
    assert key == "x1.0True['a', 'b']12"


def test_attach_weights_default(spark):
    members = spark.createDataFrame([("a", 1), ("b", 2), ("z", 3)], "name string, id int")
    w = spark.createDataFrame([("a", 0.5), ("b", 2.0)], "key string, weight double")
    out = {r.id: r.sample_weight for r in WT.attach_weights(members, w, ["name"]).collect()}
    assert out == {1: 0.5, 2: 2.0, 3: 1.0}


def test_doubles_are_spelled_as_python_does(spark):
    values = [0.0, -0.0, 1.0, -1.5, 0.001, 0.0001, 0.00012, -0.00099, 1e-5, 1.5e-7, 12345678.0, -98765432.25, 1e7, 1e15, 123456789012345.6,
              1e16, -1.25e17, 1e22, 1e100, 1.5e-300, 9999999.0, 0.1, 100.0, float("nan"), float("inf"), float("-inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.s for r in df.select(WT.py_str(F.col("v"), df.schema["v"].dataType).alias("s")).collect()]
    assert got == [str(v) for v in values]


def test_target_encoding_tasks_grow_with_the_rows(spark, monkeypatch):
    """What a task holds stays the same however few shuffle partitions the
    session asks for, and a frequent name is dealt to several tasks."""
    monkeypatch.setattr(WT, "TASK_ROWS", 100)
    df = spark.range(6000).select(F.when(F.col("id") < 3000, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("name"),
                                  (F.col("id") % 3 == 0).alias("y"), (F.col("id") % 5).alias("fold"))
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        out = WT.kfold_target_encoding(df, "name", F.col("y"), F.col("fold"))
        assert out.rdd.getNumPartitions() == 60
        got = {r["name"]: (r["encoding"], r["n"]) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    assert len(got) == 3001 and got["hot"][1] == 3000 and abs(got["hot"][0] - 1 / 3) < 1e-3
    assert got["3001"] == (pytest.approx(1 / 3), 1)

"""Distributed ordering helpers against brute force, with one key holding a
third of all rows."""

import random

from pyspark.sql import functions as F

from turnfold.functions.ordering import running_sums, with_lag, with_row_index


def _skewed(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = 0 if i % 3 == 0 else rnd.randint(1, 40)
        rows.append((g, rnd.randint(0, 10_000), i, float(rnd.randint(0, 50))))
    return rows, spark.createDataFrame(rows, "g int, t int, id int, v double")


def test_row_index_matches_sort(spark):
    rows, df = _skewed(spark)
    got = {r.id: r.ix for r in with_row_index(df, ["t", "id"], "ix", num_partitions=7).collect()}
    want = {r[2]: i for i, r in enumerate(sorted(rows, key=lambda r: (r[1], r[2])))}
    assert got == want


def test_running_sums(spark):
    rows, df = _skewed(spark)
    out = running_sums(df, [F.col("t").desc(), F.col("id").desc()], ["v"], num_partitions=5)
    got = {r.id: r.v_cum for r in out.collect()}
    acc, want = 0.0, {}
    for r in sorted(rows, key=lambda r: (-r[1], -r[2])):
        acc += r[3]
        want[r[2]] = acc
    assert got == want


def test_lag_on_hot_key(spark):
    rows, df = _skewed(spark)
    out = with_lag(df, ["g"], ["t", "id"], ["v"], num_partitions=9)
    got = {r.id: r.prev_v for r in out.collect()}
    want = {}
    by = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        want[r[2]] = by.get(r[0])
        by[r[0]] = r[3]
    assert got == want


def test_group_row_number_on_hot_key(spark):
    from turnfold.functions.ordering import group_row_number
    rows, df = _skewed(spark)
    got = {r.id: r.rn for r in group_row_number(df, ["g"], ["t", "id"], num_partitions=6).collect()}
    want, seen = {}, {}
    for r in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        seen[r[0]] = seen.get(r[0], 0) + 1
        want[r[2]] = seen[r[0]]
    assert got == want

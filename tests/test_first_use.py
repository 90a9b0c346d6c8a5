"""First uses inside a record: results and cost."""

import time

from pyspark.sql import functions as F

from turnfold.operators.timeline import _first_use


def test_first_use_keeps_order_and_drops_keyless(spark):
    df = spark.createDataFrame([([("b", 1), ("a", 2), (None, 3), ("b", 4), ("c", 5), ("a", 6)],), ([],), (None,)],
                               "xs array<struct<k:string,v:int>>")
    got = [r.out for r in df.select(_first_use(F.col("xs"), lambda x: x["k"]).alias("out")).collect()]
    assert [(x.k, x.v) for x in got[0]] == [("b", 1), ("a", 2), ("c", 5)]
    assert got[1] == [] and not got[2]


def test_cost_of_long_records_is_near_linear(spark):
    def seconds(turns, rows):
        df = spark.range(rows).select(F.transform(F.sequence(F.lit(1), F.lit(turns)), lambda j: F.struct(
            (j * 7919 % turns).alias("k"), j.alias("v"))).alias("xs")).persist()
        df.count()
        best = []
        for _ in range(3):
            t = time.perf_counter()
            df.select(F.size(_first_use(F.col("xs"), lambda x: x["k"])).alias("n")).agg(F.sum("n")).collect()
            best.append(time.perf_counter() - t)
        return min(best)

    seconds(500, 4)
    few, many = seconds(2_000, 8), seconds(40_000, 8)
    assert many < 20 * 6 * max(few, 0.05)  # a quadratic cost would be 400 times

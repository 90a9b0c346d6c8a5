"""Fits of a stack that do not depend on one another run side by side."""

import threading

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from turnfold.operators import models as MD


class Meets:
    """A learner whose fits go on when all of them have begun."""

    def __init__(self, est, barrier):
        self.est, self.barrier = est, barrier

    def copy(self):
        return Meets(self.est.copy(), self.barrier)

    def fit(self, df):
        self.barrier.wait(60)
        return self.est.fit(df)


def test_stack_fits_side_by_side(spark):
    df = spark.range(60).select(F.col("id").alias("vec_id"), (F.col("id") % 7 < 3).cast("double").alias("label"),
                                array_to_vector(F.array(*[(F.col("id") * m % 11).cast("double") for m in (1, 3)])).alias("features"))
    members = [(n, MD.logistic(60, prefix=n)) for n in ("a", "b")]
    barrier = threading.Barrier(6)
    fold = F.pmod("vec_id", F.lit(2))
    got = MD.stacked_scores(df, [(n, Meets(e, barrier)) for n, e in members], fold, 2, "vec_id").orderBy("vec_id").collect()
    full = {n: e.fit(df).transform(df) for n, e in members}
    want = {n: {r[0]: r[1] for r in x.select("vec_id", MD.positive_probability(f"{n}_probability")).collect()} for n, x in full.items()}
    assert len(got) == 60
    for r in got:
        assert abs(r["a_p1"] - want["a"][r["vec_id"]]) < 1e-9 and abs(r["b_p1"] - want["b"][r["vec_id"]]) < 1e-9

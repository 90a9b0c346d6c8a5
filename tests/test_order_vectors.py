"""Vectors of orders, written once for fitting and scoring."""

import random

import numpy as np
import pytest
from pyspark.ml.linalg import SparseVector

from turnfold.plans import catalogue


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """120 orders of none to eight lines, over ten parts."""
    draw, d = random.Random(5), str(tmp_path_factory.mktemp("orders"))
    orders = [(o, draw.choice("FOP"), draw.choice(["1-URGENT", "5-LOW"])) for o in range(120)]
    parts = [(p, draw.choice(["PROMO TIN", "SMALL BRASS"]), f"Brand#{1 + p % 5}{1 + p % 3}", p, 900.0 + p) for p in range(10)]
    lines = [(o, draw.randrange(10), draw.randrange(5), n, float(draw.randrange(50)), draw.random() * 1000, draw.random() / 10,
              draw.random() / 10, draw.choice("ARN"), draw.choice("OF"), "1995-01-01") for o in range(120) for n in range(o % 9)]
    for name, rows, schema in (
            ("orders", orders, "o_orderkey long, o_orderstatus string, o_orderpriority string"),
            ("part", parts, "p_partkey long, p_type string, p_brand string, p_size int, p_retailprice double"),
            ("lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                                "l_linestatus string, l_shipdate string")):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{d}/{name}.parquet")
    return d


def test_written_vectors_hold_the_same_values_in_short_form(spark, tables):
    want = {r.o_orderkey: (r.label, r.features) for r in catalogue.order_vectors(spark, tables).collect()}
    got = {r.o_orderkey: (r.label, r.features) for r in catalogue.written_order_vectors(spark, tables).collect()}
    assert len(want) == 120 and got.keys() == want.keys()
    for k, (label, x) in want.items():
        assert got[k][0] == label and np.array_equal(got[k][1].toArray(), x.toArray(), equal_nan=True)
    assert isinstance(got[0][1], SparseVector)


def test_linear_scores_join_the_lines_once(spark, tables):
    out = catalogue.QUERIES["orders_linear_scores"](spark, tables)
    assert out.count() == 120 and all(0 <= r.probability <= 1 for r in out.collect())
    assert not [f for f in out.inputFiles() if "order-vectors" not in f]

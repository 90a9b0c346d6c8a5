"""Physical plans keep scans pruned, filters pushed and shuffles few."""

import re

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
Q = E.queries()


def _plan(spark, name):
    df = Q[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_single_scan_two_exchanges(spark):
    plan = _plan(spark, "match_state_summary")
    assert plan.count("FileScan parquet") == 1
    assert plan.count("Exchange") <= 2


def test_projection_is_pruned(spark):
    df = Q["hash_split"](spark, SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "o_orderkey" in text and "o_totalprice" not in text and "o_orderpriority" not in text
    text = Q["threshold_predictions"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schemas and all("text:" not in s for s in schemas)      # documents.text never read


def test_filters_pushed_to_scan(spark):
    text = Q["adversary_presence"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*event_type", text)
    text = Q["team_difference"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_linestatus,O)" in text and "EqualTo(l_linestatus,F)" in text


def test_group_limit_before_shuffle(spark):
    text = Q["feature_vector_long"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text


def test_sweep_has_no_row_by_grid_product(spark):
    text = Q["threshold_sweep"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    # the only non-equi join is grid (100 rows) x buckets (<= 101 rows), both broadcast-sized
    assert "CartesianProduct" not in text


def test_border_carry_moves_no_record_twice(spark):
    """The written ranges are read back and only joined with one row a
    partition; the grouped result is the one exchange left."""
    for name, exchanges in (("roc_points", 0), ("pr_points", 0), ("row_identity", 0), ("damage_total", 1)):
        plan = _plan(spark, name)
        assert len(re.findall(r"(?<!Broadcast)Exchange (?:hash|range|Single)", plan)) <= exchanges, name

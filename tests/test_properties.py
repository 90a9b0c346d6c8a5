"""Property tests: the distributed ordering helpers equal their one-machine
definitions for random data, random hot-key shares and partition counts."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from turnfold.functions.ordering import group_row_number, running_sums, with_lag

rows_st = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 50), st.integers(-5, 5)),
                   min_size=1, max_size=60)
SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _frame(spark, rows):
    data = [(g, t, i, float(v)) for i, (g, t, v) in enumerate(rows)]
    return data, spark.createDataFrame(data, "g int, t int, id int, v double")


@SETTINGS
@given(rows=rows_st, parts=st.integers(1, 5))
def test_running_sums_property(spark, rows, parts):
    data, df = _frame(spark, rows)
    got = {r.id: r.v_cum for r in running_sums(df, ["t", "id"], ["v"], num_partitions=parts).collect()}
    acc, want = 0.0, {}
    for r in sorted(data, key=lambda r: (r[1], r[2])):
        acc += r[3]
        want[r[2]] = acc
    assert got == want


@SETTINGS
@given(rows=rows_st, parts=st.integers(1, 5))
def test_lag_and_group_number_property(spark, rows, parts):
    data, df = _frame(spark, rows)
    lag = {r.id: r.prev_v for r in with_lag(df, ["g"], ["t", "id"], ["v"], num_partitions=parts).collect()}
    rn = {r.id: r.rn for r in group_row_number(df, ["g"], ["t", "id"], num_partitions=parts).collect()}
    prev, seen, want_lag, want_rn = {}, {}, {}, {}
    for r in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        want_lag[r[2]] = prev.get(r[0])
        prev[r[0]] = r[3]
        seen[r[0]] = seen.get(r[0], 0) + 1
        want_rn[r[2]] = seen[r[0]]
    assert lag == want_lag and rn == want_rn

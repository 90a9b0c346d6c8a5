"""The lines of position_identity are dealt by the session's partition number."""

from turnfold.plans import catalogue

SF = "/root/testdata/sf0.001"


def test_partition_number_is_the_sessions(spark, monkeypatch):
    seen = []
    plain = catalogue.json_lines

    def spy(df, *args):
        seen.append(df._jdf.queryExecution().optimizedPlan().toString())
        return plain(df, *args)

    monkeypatch.setattr(catalogue, "json_lines", spy)
    got = catalogue.QUERIES["position_identity"](spark, SF).collect()
    assert sorted(r["battle_id"] for r in got) == list(range(len(got)))
    assert [r["o_orderkey"] for r in sorted(got, key=lambda r: r["battle_id"])] == sorted(r["o_orderkey"] for r in got)
    assert len(seen) == 1 and "RepartitionByExpression" in seen[0] and "], 4" not in seen[0]

"""Path walk, unnest, projections and the weighting driver."""

import pytest
from pyspark.sql import functions as F

from turnfold.functions import nested as NS
from turnfold.operators import weights as WT


def test_path_walk_first_element_with_field(spark):
    df = spark.createDataFrame(
        [({"team": [{"name": None, "hp": 1}, {"name": "b", "hp": 2}]},),
         ({"team": [{"name": None, "hp": 1}]},)],
        "rec struct<team: array<struct<name: string, hp: int>>>")
    vals = [r[0] for r in df.select(NS.path_walk(df, ["rec", "team", "name"])).collect()]
    assert vals == ["b", None]
    assert df.select(NS.path_walk(df, ["rec", "missing"])).first()[0] is None


def test_unnest_drops_empty(spark):
    df = spark.createDataFrame([(1, [10, 20]), (2, [])], "id int, m array<int>")
    assert NS.unnest(df, "m", ["id"]).count() == 2
    assert [r.pos for r in NS.unnest(df, "m", ["id"], with_pos=True).collect()] == [0, 1]


def test_named_projection_and_numeric(spark):
    df = spark.createDataFrame([(3.0, ["fire", "water"], "x")], "atk double, types array<string>, n string")
    r = NS.named_projection(df, ["atk", "type_water", "type_ice"]).first()
    assert (r.atk, r.type_water, r.type_ice, r.sample_weight) == (3.0, 1, 0, 1.0)
    with pytest.raises(KeyError):
        NS.named_projection(df, ["nope"])
    k = spark.createDataFrame([(1, 2.0, 3, "s", True)], "battle_id int, z double, a int, s string, player_won boolean")
    assert NS.numeric_projection(k, ["battle_id", "player_won"]).columns == ["a", "z"]


def test_weight_handling_and_require_path(spark):
    members = spark.createDataFrame([("a",), ("a",), ("b",)], "name string")
    counts = WT.content_count(members, ["name"], position=None)
    counts = counts.withColumn("first_pos", F.when(F.col("key") == "a", 0).otherwise(1))
    weighted, report = WT.weight_handling(members, counts, ["name"], "inverse_frequency")
    w = sorted(r.sample_weight for r in weighted.collect())
    assert w == pytest.approx([2 / 3, 2 / 3, 4 / 3])
    assert report.count() == 3
    df = spark.createDataFrame([(1, None)], "id int, team array<string>")
    with pytest.raises(ValueError):
        WT.require_path(df, "team")
    r = WT.roster_counts(spark.createDataFrame([(["a", "b"],), (["c"],)], "t array<string>"), "t").first()
    assert (r.members, r.matches) == (3, 2)

import os

import pytest

from tierline.operators import clean, profile, quality
from tierline.operators.columns import discover_odds_triples
from tierline.plans import gold
from tierline.sources import files

NAN = float("nan")


@pytest.fixture
def holes(spark):
    return spark.createDataFrame([(1, 1.0), (2, NAN), (3, None), (4, 4.0), (5, 4.0)], "id int, x double")


def test_nan_is_missing_like_null(holes):
    assert {r["column_name"]: r["n_null"] for r in profile.null_profile(holes).collect()} == {"id": 0, "x": 2}
    r = profile.rows_with_nulls(holes).first()
    assert (r["n_rows"], r["n_rows_with_null"]) == (5, 2)
    assert holes.count() - clean.drop_null_rows(holes).count() == 2
    assert [r["x"] for r in clean.fill_with_mean(holes, ["x"]).orderBy("id").collect()] == [1.0, 3.0, 3.0, 4.0, 4.0]
    x = {r["column_name"]: r for r in profile.describe_numeric(holes).collect()}["x"].asDict()
    assert 3.0 in x.values() and 4.0 in x.values() and not any(v != v for v in x.values())


def test_relative_dotted_and_trailing_slash_folders(spark, tmp_path, monkeypatch):
    (tmp_path / "csvd").mkdir()
    (tmp_path / "csvd" / "Team.CSV").write_text("id\n1\n")
    spark.range(3).repartition(3).write.option("header", True).csv(str(tmp_path / "csvd" / "league.csv"))
    want = {"team.csv", "league.csv"}
    assert set(files.list_files(spark, str(tmp_path / "csvd"))) == want
    assert set(files.list_files(spark, str(tmp_path / "csvd") + "/")) == want
    relative = os.path.relpath(tmp_path / "csvd", os.getcwd())
    assert set(files.list_files(spark, relative)) == want
    got = files.list_files(spark, "./" + relative)
    assert set(got) == want and files.read_named_csv(spark, got, "league").count() == 3


def test_odds_families_alone_may_not_collide():
    assert discover_odds_triples(["team_id", "teamid", "B365H", "B365 D", "b365_a"]) == [("B365", "B365H", "B365 D", "b365_a")]
    with pytest.raises(ValueError):
        discover_odds_triples(["B365H", "b365_h", "B365D", "B365A"])


def test_player_columns_in_any_case_and_never_none(spark):
    m = spark.createDataFrame([(1, 5, 6)], "id int, HOME_PLAYER_1 int, Away_Player_1 int")
    assert sorted((r["local"], list(r["players"])) for r in gold.lineups_base(m).collect()) == [(0, [6]), (1, [5])]
    with pytest.raises(ValueError):
        gold.lineups_base(m.drop("HOME_PLAYER_1"))


def test_null_keys_match_in_both_checks(spark):
    a = spark.createDataFrame([(1,), (None,), (7,)], "k int")
    b = spark.createDataFrame([(1,), (None,)], "p int")
    assert [tuple(r) for r in quality.orphan_keys(a, "k", b, "p").collect()] == [("fk_orphan", 7)]
    assert quality.key_checks(a, "k", b, "p").first()["n_fk_orphans"] == 1

import pytest

from tierline.operators.columns import columns_by_family, discover_odds_triples, find_column, suffix_columns


def test_discover_triples():
    cols = ["id", "B365H", "B365D", "B365A", "bw_h", "BW D", "bwa", "PSH", "PSD", "date", "league_id"]
    got = sorted(discover_odds_triples(cols))
    assert got == [("B365", "B365H", "B365D", "B365A"), ("BW", "bw_h", "BW D", "bwa")]


def test_discover_triples_collision():
    with pytest.raises(ValueError):
        discover_odds_triples(["B365H", "B365_H", "B365D", "B365A"])


def test_suffix_columns():
    assert suffix_columns(["id", "B365H", "WHA", "BWd", "season"]) == ["B365H", "WHA"]


def test_find_and_families(spark):
    df = spark.createDataFrame([(1, 2.0, "x", True)], "Id int, v double, s string, b boolean")
    assert find_column(df, "id") == "Id"
    assert find_column(df, "missing") is None
    assert columns_by_family(df, "number") == ["Id", "v"]
    assert columns_by_family(df, "object", "bool") == ["s", "b"]

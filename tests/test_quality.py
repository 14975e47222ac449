import pandas as pd
import pytest

from tierline.operators import quality

ROWS = [
    (1, "Alpha FC", "ALP", 10), (1, "Alpha", "ALP", 10),          # id 1: two long names
    (2, "Beta", "BET", 20), (2, "Beta", "bet", None),              # id 2: casing only
    (3, " Gamma", "GAM", 30), (3, " Gamma", "GAX", 31),            # id 3: short + fifa conflict, edge space
    (4, "Beta", "BT ", None), (5, None, "DEL", 50), (5, None, None, 50),
    (None, "Omega", "OMG", 60),
]
COLS = ["team_api_id", "team_long_name", "team_short_name", "team_fifa_api_id"]


@pytest.fixture(scope="module")
def teams(spark):
    return spark.createDataFrame(ROWS, "team_api_id int, team_long_name string, team_short_name string, "
                                       "team_fifa_api_id int")


def _pd():
    return pd.DataFrame(ROWS, columns=COLS)


def _ids(pdf, key, value, dropna_value=False, nulls=True):
    base = pdf[~pdf[value].isna()] if dropna_value else pdf
    g = base.groupby(key)[value].nunique(dropna=not nulls)
    return set(g[g > 1].index)


def test_fd_checks_match_pandas(teams):
    pdf = _pd()
    res = quality.check_consistency(teams)
    expect = {
        "id_to_long_name": ("team_api_id", _ids(pdf, "team_api_id", "team_long_name")),
        "id_to_short_name": ("team_api_id", _ids(pdf, "team_api_id", "team_short_name")),
        "id_to_fifa_id_non_null": ("team_api_id", _ids(pdf, "team_api_id", "team_fifa_api_id", True, False)),
        "long_name_to_id": ("team_long_name", _ids(pdf, "team_long_name", "team_api_id")),
    }
    for name, (key, ids) in expect.items():
        got = res[name].toPandas()
        assert len(got) == pdf[key].isin(ids).sum(), name
        assert set(got[key]) == ids, name
    ws = res["edge_spaces_long_name"].toPandas()
    assert len(ws) == 2
    assert len(res["edge_spaces_short_name"].toPandas()) == 1
    casing = res["short_name_casing"].toPandas()
    up = pdf.assign(u=pdf.team_short_name.str.upper()).groupby("team_api_id")["u"].nunique()
    assert set(casing.team_api_id) == set(up[up > 1].index) == {3}
    summary = {r.check_name: r.n_affected for r in res["summary"].collect()}
    assert summary["id_to_long_name"] == 2 and summary["short_name_casing"] == 2
    assert len(summary) == 7


def test_casing_strict(teams):
    got = quality.casing_rows_strict(teams, "team_api_id", "team_short_name").toPandas()
    assert set(got.team_api_id) == {2}


def test_key_checks_and_orphans(spark):
    dim = spark.createDataFrame([(1,), (2,), (3,), (3,)], "id int")
    fk = spark.createDataFrame([(1,), (1,), (4,)], "ref int")
    r = quality.key_checks(fk, "ref", dim, "id").first()
    assert (r.fk_is_unique, r.pk_is_unique, r.key_sets_equal) == (False, False, False)
    assert (r.n_fk_orphans, r.n_pk_unreferenced) == (1, 3)
    got = sorted((x.side, x.key) for x in quality.orphan_keys(fk, "ref", dim, "id").collect())
    assert got == [("fk_orphan", 4), ("pk_unreferenced", 2), ("pk_unreferenced", 3), ("pk_unreferenced", 3)]


def test_join_one_to_one(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, a string")
    b = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "k int, b int")
    assert quality.join_one_to_one(a, b, "k", "k").count() == 2
    dup = spark.createDataFrame([(1, 10), (1, 11)], "k int, b int")
    with pytest.raises(ValueError):
        quality.join_one_to_one(a, dup, "k", "k")


def test_duplicate_rows_null_safe(spark):
    rows = [(1, None, "a"), (2, None, "a"), (3, "x", "b"), (3, "x", "b"), (4, "y", None)]
    df = spark.createDataFrame(rows, "id int, s string, t string")
    pdf = pd.DataFrame(rows, columns=["id", "s", "t"])
    allcols = quality.duplicate_rows(df).count()
    assert allcols == pdf.duplicated(keep=False).sum() == 2
    rest = quality.duplicate_rows(df, ["s", "t"], sort=True).collect()
    assert len(rest) == pdf.duplicated(subset=["s", "t"], keep=False).sum() == 4


def test_single_check_helpers(teams):
    from tierline.operators import profile
    res = quality.check_consistency(teams)
    one = quality.fd_violation_rows(teams, "team_api_id", "team_long_name")
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, res["id_to_long_name"].collect()), key=str)
    case = quality.casing_rows(teams, "team_api_id", "team_short_name")
    assert sorted(map(tuple, case.collect()), key=str) == sorted(map(tuple, res["short_name_casing"].collect()), key=str)
    cols = {r.column_name: r.n_null for r in profile.columns_with_nulls(teams).collect()}
    assert cols == {"team_api_id": 1, "team_long_name": 2, "team_short_name": 1, "team_fifa_api_id": 2}


def test_checks_accept_dotted_names(spark):
    from tierline.operators import clean
    df = spark.createDataFrame([(1, "a.x", 5), (1, "b", 5), (2, "c", None), (2, "c", 7)], "`t.id` int, `t.name` string, `t.v` int")
    fd = quality.fd_violation_rows(df, "t.id", "t.name").count()
    assert fd == 2
    dup = quality.duplicate_rows(df, ["t.id"]).count()
    assert dup == 4
    assert clean.dedupe_keep_min_id(df, "t.v").count() == 3
    assert [r[0] for r in clean.fill_with_mean(df).select("`t.v`").collect()][2] == 17 / 3
    assert quality.key_checks(df, "t.id", df, "t.id").first().pk_is_unique is False

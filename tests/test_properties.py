"""Property tests: random inputs (with NULLs, repeats and ties) against
pandas / Python brute force."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierline.functions import py_round
from tierline.operators import clean, profile, quality
from tierline.operators.quantiles import exact_quantiles

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

small_int = st.one_of(st.none(), st.integers(0, 4))
rows_strategy = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 30)), small_int, small_int,
                                   st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))),
                         min_size=1, max_size=60)


@SETTINGS
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=200), st.integers(0, 4))
def test_py_round_property(spark, values, digits):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(py_round(F.col("x"), digits)).collect()]
    assert [repr(g) for g in got] == [repr(round(v, digits)) for v in values]


@SETTINGS
@given(rows_strategy)
def test_dedupe_and_duplicates_property(spark, rows):
    df = spark.createDataFrame(rows, "id int, a int, b int, s string")
    pdf = pd.DataFrame(rows, columns=["id", "a", "b", "s"])
    # lowest non-null id per group of the other columns (NULLs group together)
    rest = ["a", "b", "s"]
    key = pdf[rest].astype(object).where(pdf[rest].notna(), "<null>").apply(tuple, axis=1)
    want = pdf.assign(k=key).groupby("k", dropna=False)["id"].min()
    got = clean.dedupe_keep_min_id(df, "id").collect()
    assert len(got) == len(want)
    got_map = {(r.a if r.a is not None else "<null>", r.b if r.b is not None else "<null>",
                r.s if r.s is not None else "<null>"): r.id for r in got}
    for k, v in want.items():
        g = got_map[tuple(x if not isinstance(x, float) else int(x) for x in k)]
        assert (g is None and pd.isna(v)) or g == v
    # members of duplicated groups, all columns and a subset
    assert quality.duplicate_rows(df).count() == pdf.duplicated(keep=False).sum()
    assert quality.duplicate_rows(df, ["a", "s"]).count() == pdf.duplicated(subset=["a", "s"], keep=False).sum()
    assert profile.dup_rows_pct(df).first().n_dup_rows == pdf.duplicated(keep=False).sum()
    dp = {r.column_name: r.n_duplicates for r in profile.dup_profile(df).collect()}
    assert dp == {c: int(pdf[c].duplicated().sum()) for c in pdf.columns}


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5).map(float), st.floats(-100, 100, allow_nan=False)),
                min_size=1, max_size=300))
def test_exact_quantiles_property(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = exact_quantiles(df, ["x"], probs)["x"]
    arr = np.array([v for v in values if v is not None])
    for p in probs:
        if len(arr) == 0:
            assert got[p] is None
        else:
            assert got[p] == pytest.approx(np.percentile(arr, p * 100), abs=1e-9)


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.one_of(st.none(), st.sampled_from(["x", "y", " x"])),
                          st.one_of(st.none(), st.sampled_from(["AB", "ab", "Cd"])), st.one_of(st.none(), st.integers(0, 2))),
                min_size=1, max_size=50))
def test_consistency_property(spark, rows):
    cols = ["team_api_id", "team_long_name", "team_short_name", "team_fifa_api_id"]
    df = spark.createDataFrame(rows, "team_api_id int, team_long_name string, team_short_name string, team_fifa_api_id int")
    pdf = pd.DataFrame(rows, columns=cols)
    res = quality.check_consistency(df)

    def ids(key, value, nulls=True, drop_value_nulls=False):
        base = pdf[pdf[value].notna()] if drop_value_nulls else pdf
        g = base.groupby(key)[value].nunique(dropna=not nulls)
        return pdf[pdf[key].isin(g[g > 1].index)]

    assert res["id_to_long_name"].count() == len(ids("team_api_id", "team_long_name"))
    assert res["id_to_short_name"].count() == len(ids("team_api_id", "team_short_name"))
    assert res["id_to_fifa_id_non_null"].count() == len(ids("team_api_id", "team_fifa_api_id", False, True))
    assert res["long_name_to_id"].count() == len(ids("team_long_name", "team_api_id"))
    edge = pdf["team_long_name"].notna() & (pdf["team_long_name"] != pdf["team_long_name"].str.strip())
    assert res["edge_spaces_long_name"].count() == edge.sum()
    up = pdf.assign(u=pdf.team_short_name.str.upper()).groupby("team_api_id")["u"].nunique()
    assert res["short_name_casing"].count() == pdf.team_api_id.isin(up[up > 1].index).sum()


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 3)), min_size=1, max_size=80),
       st.lists(st.integers(0, 7), max_size=8))
def test_split_join_property(spark, big_rows, lookup_keys):
    from tierline.operators.joins import split_join
    big = spark.createDataFrame(big_rows, "k int, v int")
    lookup = spark.createDataFrame([(k, f"n{k}") for k in lookup_keys], "k int, name string")
    for how in ("left", "inner", "left_semi", "left_anti"):
        want = sorted(map(tuple, big.join(lookup, ["k"], how).collect()), key=str)
        got = sorted(map(tuple, split_join(big, lookup, ["k"], how).collect()), key=str)
        assert got == want, how


@SETTINGS
@given(st.lists(st.lists(st.integers(0, 4), min_size=3, max_size=3), min_size=1, max_size=40),
       st.lists(st.tuples(st.integers(0, 4), st.sampled_from(["A", "B", " ", "C"])), max_size=8))
def test_lineup_names_property(spark, lineups, player_rows):
    import hashlib
    from tierline.plans import gold
    base = spark.createDataFrame([(i // 2, i % 2, p) for i, p in enumerate(lineups)],
                                 "id_match long, local int, players array<int>")
    players = spark.createDataFrame(player_rows, "player_api_id long, player_name string") if player_rows \
        else spark.createDataFrame([], "player_api_id long, player_name string")
    got = {r.id_lineup: list(r.players_names) for r in
           gold.lineup_names(gold.lineup_bridge(gold.lineup_dim(gold.lineup_map(base))),
                             gold.dim_player(players)).collect()}
    # brute force of the reference semantics
    def lid(i, p):
        nz = sorted(x for x in p if x != 0)
        text = "|".join(map(str, nz)) if len(nz) >= 3 else f"{i // 2}|{i % 2}"
        return hashlib.sha256(text.encode()).hexdigest()
    dim = {(lid(i, p), tuple(p)) for i, p in enumerate(lineups)}
    dplayers = set(player_rows)
    if not any(k == 0 for k, _ in dplayers):
        dplayers.add((0, "Unknown / Not Available"))
    want = {}
    for lineup_id, ps in dim:
        for pos, pid in enumerate(ps):
            matches = [n for k, n in dplayers if k == pid] or [None]
            for n in matches:
                nm = "0" if pid == 0 or n is None or n.strip(" ") == "" else n
                want.setdefault(lineup_id, []).append((pos, nm))
    want = {k: [nm for _, nm in sorted(v)] for k, v in want.items()}
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 6), st.one_of(st.none(), st.integers(-1, 3)), st.one_of(st.none(), st.integers(-1, 3)),
                          st.lists(st.integers(0, 3), min_size=6, max_size=6)), min_size=1, max_size=30))
def test_fact_match_property(spark, rows):
    import datetime
    import hashlib
    from tierline.plans import gold
    data = [(mid, 1, datetime.datetime(2012, 1, 1), mid % 5, (mid + 1) % 5, hg, ag, *p) for mid, hg, ag, p in rows]
    match = spark.createDataFrame(data, "id long, league_id int, match_date timestamp, home_team_api_id long, "
                                        "away_team_api_id long, home_team_goal long, away_team_goal long, "
                                        + ", ".join(f"{s}_player_{i} long" for s in ("home", "away") for i in (1, 2, 3)))
    got = sorted(((r.id_match, r.local, r.id_team, r.match_result, r.num_goals_favor, r.num_goals_against, r.id_lineup)
                  for r in gold.fact_match(match, gold.lineup_map(gold.lineups_base(match))).collect()), key=str)

    def lid(mid, local, p):
        nz = sorted(x for x in p if x != 0)
        text = "|".join(map(str, nz)) if len(nz) >= 3 else f"{mid}|{local}"
        return hashlib.sha256(text.encode()).hexdigest()
    lmap = {(mid, 1, lid(mid, 1, p[:3])) for mid, _, _, p in rows} | {(mid, 0, lid(mid, 0, p[3:])) for mid, _, _, p in rows}
    want = []
    for mid, hg, ag, p in rows:
        res = "H" if hg is not None and ag is not None and hg > ag else (
            "A" if hg is not None and ag is not None and hg < ag else "D")
        for local, team, fav, against in ((1, mid % 5, hg, ag), (0, (mid + 1) % 5, ag, hg)):
            if fav is None or against is None or fav < 0 or against < 0:
                continue
            ids = [l for m, lo, l in lmap if m == mid and lo == local] or [None]
            want += [(mid, local, team, res, fav, against, l) for l in ids]
    assert got == sorted(want, key=str)


odds_value = st.one_of(st.none(), st.just(0.0), st.floats(1.01, 15.0, allow_nan=False).map(lambda v: round(v, 2)))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), odds_value, odds_value, odds_value, odds_value, odds_value, odds_value),
                min_size=1, max_size=25))
def test_bookie_pivot_matches_pandas(spark, rows):
    from tierline.plans import odds
    from tierline.plans.reference_data import BOOKMAKER_CODES
    cols = ["match_api_id", "B365H", "B365D", "B365A", "BWH", "BWD", "BWA"]
    df = spark.createDataFrame(rows, "match_api_id long, " + ", ".join(f"{c} double" for c in cols[1:]))
    got = {(r.id_match, r.id_bookmaker): (r.A, r.D, r.H, r.overround) for r in odds.bookie_odds_pivot(df).collect()}
    # the notebook's pandas pipeline
    pdf = pd.DataFrame(rows, columns=cols)
    long = pdf.melt(id_vars=["match_api_id"], value_vars=cols[1:], var_name="bookie_odds_type", value_name="odds")
    long["local"] = long["bookie_odds_type"].str[-1]
    long["bookie"] = long["bookie_odds_type"].str[:-1]
    piv = long.pivot_table(index=["match_api_id", "bookie"], columns="local", values="odds").reset_index()

    def over(h, d, a):
        if h and d and a:
            return round(((1 / h + 1 / d + 1 / a) * 100) - 100, 3)
        return None
    want = {}
    for r in piv.to_dict("records"):
        vals = [r.get(k) for k in ("A", "D", "H")]
        vals = [None if v is None or (isinstance(v, float) and np.isnan(v)) else v for v in vals]
        o = over(vals[2], vals[1], vals[0])
        o = None if o is None or (isinstance(o, float) and np.isnan(o)) else o
        want[(r["match_api_id"], BOOKMAKER_CODES.index(r["bookie"]) + 1)] = (*vals, o)
    assert set(got) == set(want)
    for k, (a, d, h, o) in want.items():
        ga, gd, gh, go = got[k]
        for x, y in ((ga, a), (gd, d), (gh, h)):
            assert (x is None and y is None) or x == pytest.approx(y, abs=1e-12)
        assert go == o

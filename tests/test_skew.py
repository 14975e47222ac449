"""A key holding a large share of the rows: results stay exact, and adaptive
execution splits its partition. (It cannot where the lookup side is an aggregate of
the same plan, which is why the joins save their lookup first.)"""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from tierline.operators import clean, quality
from tierline.plans import gold

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


@contextlib.contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _final_plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture(scope="module")
def hot(spark):
    # 40% of the rows share id 0; the rest spread over 3000 ids
    return (spark.range(20000).select(
        F.when(F.col("id") % 5 < 2, F.lit(0)).otherwise(F.col("id") % 3000).alias("team_api_id"),
        F.concat(F.lit("n"), (F.col("id") % 7).cast("string")).alias("team_long_name"),
        F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("team_short_name"),
        (F.col("id") % 11).alias("team_fifa_api_id")))


def test_hot_key_checks_exact_and_split(spark, hot):
    plain = quality.check_consistency(hot)
    want = {r.check_name: r.n_affected for r in plain["summary"].collect()}
    want_rows = sorted(map(tuple, plain["annotated"].collect()), key=str)
    with conf(spark, SKEW_CONF):
        res = quality.check_consistency(hot)  # id 0 holds 8000 of 20000 rows
        got = {r.check_name: r.n_affected for r in res["summary"].collect()}
        ann = res["annotated"]
        got_rows = sorted(map(tuple, ann.collect()), key=str)
        plan = _final_plan(ann)
    assert got == want
    assert got_rows == want_rows
    assert "skew=true" in plan


def test_hot_player_lineups(spark):
    # most slots are the unknown player 0
    base = spark.range(4000).select(
        F.col("id").alias("id_match"), F.lit(1).alias("local"),
        F.array(*[F.when(F.col("id") % 3 == 0, (F.col("id") + i) % 50).otherwise(F.lit(0)).cast("int")
                  for i in range(6)]).alias("players"))
    players = spark.range(50).select(F.col("id").alias("player_api_id"),
                                     F.concat(F.lit("p"), F.col("id").cast("string")).alias("player_name"))
    build = lambda: gold.lineup_names(gold.lineup_bridge(gold.lineup_dim(gold.lineup_map(base))),
                                      gold.dim_player(players))
    want = sorted((r.id_lineup, tuple(r.players_names)) for r in build().collect())
    with conf(spark, SKEW_CONF):
        got = sorted((r.id_lineup, tuple(r.players_names)) for r in build().collect())
    assert got == want


def test_hot_group_dedupe(spark, hot):
    want = hot.join(hot.groupBy("team_api_id").count().where("count > 1"), "team_api_id", "left_semi")
    with conf(spark, SKEW_CONF):
        got = clean.dedupe_keep_min_id(hot.withColumn("id", F.monotonically_increasing_id()), "id").count()
        dups = sorted(map(tuple, quality.duplicate_rows(hot, ["team_api_id"]).collect()), key=str)
    assert got == hot.distinct().count()
    assert dups == sorted(map(tuple, want.collect()), key=str)


def test_hot_null_keys_left_join(spark):
    from tierline.operators.joins import split_join
    big = spark.createDataFrame([(None, 1)] * 50 + [(1, 2)] * 60 + [(2, 3)] * 5, "k int, v int")
    lookup = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, name string")
    for how in ("left", "inner", "left_semi", "left_anti"):
        want = sorted(map(tuple, big.join(lookup, ["k"], how).collect()), key=str)
        got = sorted(map(tuple, split_join(big, lookup, ["k"], how).collect()), key=str)
        assert got == want, how


def test_many_hot_keys_at_once(spark):
    """100,000 keys of four rows each beside one key with a third of all rows."""
    from tierline.operators.joins import split_join
    big = spark.range(600_000).select(F.when(F.col("id") < 400_000, F.col("id") % 100_000).otherwise(7).alias("k"),
                                      F.xxhash64("id").alias("v"))
    lookup = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    with conf(spark, SKEW_CONF):
        j = split_join(big, lookup, ["k"], "left")
        assert j.agg(F.sum("n")).first()[0] == 99_999 * 4 * 4 + 200_004 ** 2
        j.collect()
        assert "skew=true" in _final_plan(j)


def test_hot_match_id_fact(spark):
    from tierline.plans import silver
    # one match id repeated on half of the rows, with different line-ups
    rows = spark.range(3000).select(
        F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id")).alias("id"),
        F.lit(1).alias("league_id"), F.lit("2012-01-01 00:00:00").alias("date"),
        (F.col("id") % 20).alias("home_team_api_id"), (F.col("id") % 19).alias("away_team_api_id"),
        (F.col("id") % 4).alias("home_team_goal"), (F.col("id") % 3).alias("away_team_goal"),
        *[((F.col("id") + i) % (5 + i)).alias(f"home_player_{i}") for i in range(1, 4)],
        *[((F.col("id") * i) % 6).alias(f"away_player_{i}") for i in range(1, 4)])
    m = silver.silver_match(rows)
    lmap = gold.lineup_map(gold.lineups_base(m))
    want = sorted(map(tuple, gold.fact_match(m, lmap).collect()), key=str)
    with conf(spark, SKEW_CONF):
        fm = gold.fact_match(m, lmap)
        got = sorted(map(tuple, fm.collect()), key=str)
        plan = _final_plan(fm)
    assert got == want
    assert "skew=true" in plan


def test_saved_tables_get_aqe_skew_split(spark, tmp_path, hot):
    """Joins between stored tables (both sides plain shuffle stages) are split
    by AQE's skew join; this is why the layered run joins saved tables."""
    hot.write.parquet(str(tmp_path / "big"))
    spark.range(3000).select(F.col("id").alias("team_api_id"),
                             F.concat(F.lit("t"), F.col("id").cast("string")).alias("name")) \
        .write.parquet(str(tmp_path / "dim"))
    with conf(spark, SKEW_CONF):
        big = spark.read.parquet(str(tmp_path / "big"))
        dim = spark.read.parquet(str(tmp_path / "dim"))
        j = big.join(dim, "team_api_id", "left")
        assert j.count() == 20000
        rows = j.collect()
        plan = _final_plan(j)
    assert len(rows) == 20000
    assert "skew=true" in plan


def test_hot_lineup_view(spark):
    facts = spark.range(3000).select(
        (F.col("id") % 1500).alias("id_match"), (F.col("id") % 2).cast("int").alias("local"),
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("l"), F.col("id").cast("string")))
        .alias("id_lineup"), (F.col("id") % 10).alias("id_team"))
    names = facts.select("id_lineup").distinct().select("id_lineup", F.array(F.col("id_lineup")).alias("players_names"))
    teams = spark.range(10).select(F.col("id").alias("id_team"), F.col("id").cast("string").alias("team_name"))
    want = sorted(map(tuple, gold.v_match_lineup_names(facts, names, teams).collect()), key=str)
    with conf(spark, SKEW_CONF):
        v = gold.v_match_lineup_names(facts, names, teams)
        got = sorted(map(tuple, v.collect()), key=str)
        plan = _final_plan(v)
    assert got == want and "skew=true" in plan


def test_hot_foreign_key(spark):
    """A third of the facts have one key that the other table lacks: still all reported. What stands on the right of an anti join
    is a saved set of keys, never the facts. (Rows of one bare key compress to so little that their partition is no load.)"""
    facts = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit(-7)).when(F.col("id") % 100 == 1, F.lit(None)).otherwise(F.col("id") % 2000).alias("k"),
                                      F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    keys = spark.range(0, 4000, 2).select(F.col("id").alias("p"))
    with conf(spark, SKEW_CONF):
        out = quality.orphan_keys(facts, "k", keys, "p")
        got = {tuple(r) for r in out.groupBy("side", "key").count().collect()}
        hot = facts.select("k").where("k = -7").count()
        assert ("fk_orphan", -7, hot) in got
        assert sum(n for s, _, n in got if s == "fk_orphan") == sum(
            1 for r in facts.select("k").collect() if r.k is None or r.k % 2 or r.k < 0)
        assert sum(n for s, _, n in got if s == "pk_unreferenced") == 2000 - len({r.k for r in facts.collect() if r.k is not None and r.k >= 0 and r.k % 2 == 0})
        unreferenced = quality.orphan_keys(facts, "k", keys, "p").where("side = 'pk_unreferenced'")
        assert unreferenced.count() == sum(n for s, _, n in got if s == "pk_unreferenced") < 2000
        plan = _final_plan(unreferenced)
        assert "LeftAnti" in plan and "tierline-ke" in plan

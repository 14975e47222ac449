import hashlib

from pyspark.sql import functions as F

from tierline.plans import gold, silver


def _match(spark, rows):
    return spark.createDataFrame(rows, "id long, match_api_id long, league_id int, date string, season string, "
                                       "home_team_api_id long, away_team_api_id long, home_team_goal long, "
                                       "away_team_goal long, home_player_1 long, home_player_2 long, "
                                       "home_player_3 long, away_player_1 long, away_player_2 long, "
                                       "away_player_3 long, B365H double, B365D double, B365A double")


ROWS = [
    (1, 101, 7, "2010-08-01 00:00:00", "2010/2011", 10, 20, 2, 1, 5, 3, 9, 0, 0, 4, 2.0, 3.0, 4.0),
    (2, 102, 7, "2010-08-02 00:00:00", "2010/2011", 20, 10, None, 1, 9, 5, 3, 1, 2, 3, 1.5, 4.0, 0.9),
    (3, 103, 8, "bad", "2010", 30, 10, 1, 1, 3, 9, 5, None, None, None, None, None, None),
]


def test_silver_and_events(spark):
    m = silver.silver_match(_match(spark, ROWS))
    got = {r.id: (r.match_date, r.season_start, r.season_end) for r in m.collect()}
    assert got[3] == (None, 2010, None)
    ev = silver.events_long(m)
    assert ev.count() == 3 and ev.where("home_odd IS NULL").count() == 1
    assert silver.events_long(m.drop("B365A")) is None


def test_fact_match_semantics(spark):
    m = silver.silver_match(_match(spark, ROWS))
    lm = gold.lineup_map(gold.lineups_base(m))
    f = gold.fact_match(m, lm).collect()
    # match 2 has a NULL home goal: dropped on both sides; result is the home side's on both rows
    assert {r.id_match for r in f} == {1, 3}
    assert {(r.id_match, r.local): r.match_result for r in f} == {(1, 1): "H", (1, 0): "H", (3, 1): "D", (3, 0): "D"}
    # line-up hash ignores slot order: match 1 home (5,3,9) equals match 2 home (9,5,3)
    ids = {(r.id_match, r.local): r.id_lineup for r in lm.collect()}
    assert ids[(1, 1)] == ids[(2, 1)] == hashlib.sha256(b"3|5|9").hexdigest()
    assert ids[(3, 0)] == hashlib.sha256(b"3|0").hexdigest()


def test_lineup_variants_repeat_positions(spark):
    m = silver.silver_match(_match(spark, ROWS))
    lm = gold.lineup_map(gold.lineups_base(m))
    dim = gold.lineup_dim(lm)
    players = spark.createDataFrame([(3, "C"), (5, "E"), (9, " ")], "player_api_id long, player_name string")
    names = {r.id_lineup: r.players_names for r in
             gold.lineup_names(gold.lineup_bridge(dim), gold.dim_player(players)).collect()}
    h = hashlib.sha256(b"3|5|9").hexdigest()
    # three variants share the hash (5,3,9), (9,5,3), (3,9,5): nine entries, ordered by slot then name
    assert names[h] == ["0", "C", "E", "0", "C", "E", "0", "C", "E"]
    one = gold.lineup_dim(lm, one_variant=True)
    assert one.where(F.col("id_lineup") == h).count() == 1


def test_dim_player_sentinel(spark):
    p = spark.createDataFrame([(3, "C"), (3, "C"), (None, "X")], "player_api_id long, player_name string")
    assert sorted(map(tuple, gold.dim_player(p).collect())) == [(0, "Unknown / Not Available"), (3, "C")]
    p0 = spark.createDataFrame([(0, "Zero")], "player_api_id long, player_name string")
    assert [tuple(r) for r in gold.dim_player(p0).collect()] == [(0, "Zero")]


def test_dim_period_and_fact_events(spark):
    m = silver.silver_match(_match(spark, ROWS))
    ev = silver.events_long(m)
    per = gold.dim_period(m, ev)
    assert per.count() == 3  # two dates and the all-NULL row from the unparsable date
    fe = gold.fact_events(ev, per, gold.dim_betting_office(spark)).collect()
    assert len(fe) == 1 and fe[0].id_betting_office == 3923460405 and fe[0].id_period == "2010-08-01"
    assert abs(fe[0].spread - (1 / 2 + 1 / 3 + 1 / 4 - 1)) < 1e-15


def test_office_ids_are_crc32(spark):
    import zlib
    for r in gold.dim_betting_office(spark).collect():
        assert r.id_betting_office == zlib.crc32(r.abbr.encode())


def test_streaming_matches_batch(spark, tmp_path):
    from tierline.streaming import ingest
    m = _match(spark, ROWS)
    landing = str(tmp_path / "landing")
    m.repartition(3).write.parquet(landing)
    stream = ingest.landing_stream(spark, landing, m.schema, max_files_per_trigger=1)
    ingest.run_available_now(ingest.events_long_stream(stream), str(tmp_path / "out"), str(tmp_path / "ck"))
    got = spark.read.parquet(str(tmp_path / "out"))
    want = silver.events_long(silver.silver_match(m))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    # a second run over the same landing folder adds nothing (checkpointed progress)
    stream2 = ingest.landing_stream(spark, landing, m.schema)
    ingest.run_available_now(ingest.events_long_stream(stream2), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == want.count()
    stream3 = ingest.landing_stream(spark, landing, m.schema, max_files_per_trigger=1)
    ingest.dim_period_stream(stream3, str(tmp_path / "per"), str(tmp_path / "ck2"))
    assert spark.read.parquet(str(tmp_path / "per")).count() == 3  # two days and the NULL day, once each
    # replaying the same files into the same table (fresh checkpoint) adds nothing
    stream4 = ingest.landing_stream(spark, landing, m.schema)
    ingest.dim_period_stream(stream4, str(tmp_path / "per"), str(tmp_path / "ck3"))
    assert spark.read.parquet(str(tmp_path / "per")).count() == 3


def test_events_long_generates_ids_without_id_column(spark):
    m = silver.silver_match(_match(spark, ROWS).drop("id"))
    ev = silver.events_long(m).collect()
    assert len(ev) == 3 and len({r.id_match for r in ev}) == 3 and all(r.id_match is not None for r in ev)


def test_streaming_from_csv_landing(spark, tmp_path):
    from tierline.streaming import ingest
    m = _match(spark, ROWS)
    landing = str(tmp_path / "csv_landing")
    m.repartition(2).write.option("header", True).csv(landing)
    stream = ingest.landing_stream(spark, landing, m.schema, fmt="csv")
    ingest.run_available_now(ingest.events_long_stream(stream), str(tmp_path / "out"), str(tmp_path / "ck"))
    got = spark.read.parquet(str(tmp_path / "out"))
    want = silver.events_long(silver.silver_match(m))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def _shuffles(df):
    """Shuffles by key in the plan of ``df`` (broadcasts are none)."""
    import contextlib
    import io
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        df.explain()
    return plan.getvalue().count("Exchange hashpartitioning")


def test_lineup_names_deals_slots_out_once(spark, tmp_path):
    """Names of a saved bridge: one shuffle, by the packed id."""
    m = silver.silver_match(_match(spark, ROWS))
    gold.lineup_bridge(gold.lineup_dim(gold.lineup_map(gold.lineups_base(m)))).write.parquet(str(tmp_path / "bridge"))
    players = spark.createDataFrame([(3, "C"), (5, "E"), (9, " ")], "id_player long, player_name string")
    names = gold.lineup_names(spark.read.parquet(str(tmp_path / "bridge")), players)
    assert _shuffles(names) == 1
    assert names.schema.simpleString() == "struct<id_lineup:string,players_names:array<string>>"


def test_lineup_names_counts_unknown_and_unnamed_slots_apart(spark):
    bridge = spark.createDataFrame([("x", 0, 0), ("x", 0, 7), ("x", 0, None), ("x", 1, 5), ("x", 1, 5), (None, 0, 0)],
                                   "id_lineup string, position int, id_player int")
    players = spark.createDataFrame([(0, "Zero"), (0, "Nil"), (5, "E"), (5, "F")], "id_player int, player_name string")
    got = {r.id_lineup: r.players_names for r in gold.lineup_names(bridge, players).collect()}
    # player 0 twice for its two rows; a player without a row and a slot without a player once each
    assert got == {"x": ["0"] * 4 + ["E", "E", "F", "F"], None: ["0", "0"]}


def test_packed_ids_are_the_ids_and_shorter(spark):
    from tierline.functions.lineup import pack_id, unpack_id
    ids = [hashlib.sha256(b"1").hexdigest(), hashlib.sha256(b"1").hexdigest().upper(), "ab" * 32, "ab" * 31, "ab" * 32 + "\n", "g" * 64,
           "é" * 32, "hot", "", "\x01", "\x00", None]
    rows = (spark.createDataFrame([(i,) for i in ids], "id_lineup string").select("id_lineup", pack_id())
            .select(F.col("id_lineup").alias("was"), "packed", unpack_id()).collect())
    assert [r.id_lineup for r in rows] == [r.was for r in rows] == ids
    assert len({bytes(r.packed) for r in rows if r.packed is not None}) == len(ids) - 1 and len(rows[0].packed) == 33


def test_fact_match_gives_every_line_up_of_a_side_once(spark, tmp_path):
    """Repeated rows of the map are made distinct, NULL ids find nothing, and the lookup is not written for the join."""
    m = silver.silver_match(_match(spark, [*ROWS, *ROWS[:1]]))
    lmap = gold.lineup_map(gold.lineups_base(m))
    other = lmap.limit(1).withColumn("id_lineup", F.lit("another"))
    lmap = lmap.unionByName(other).unionByName(other).unionByName(other.withColumn("id_match", F.lit(None).cast(other.schema["id_match"].dataType)))
    lmap.write.parquet(str(tmp_path / "lmap"))
    lmap = spark.read.parquet(str(tmp_path / "lmap"))
    plain = gold.fact_match(m, lmap).drop("id_lineup").distinct().join(
        lmap.select("id_match", "local", "id_lineup").distinct(), ["id_match", "local"], "left")
    got = gold.fact_match(m, lmap)
    assert {tuple(r) for r in got.select(plain.columns).collect()} == {tuple(r) for r in plain.collect()}
    per_side = {tuple(r)[:2]: r["count"] for r in got.groupBy("id_match", "local").count().collect()}
    first = other.first()
    assert "tierline-cut" not in got._jdf.queryExecution().executedPlan().toString()
    assert per_side[(first.id_match, first.local)] == 4      # two equal matches, two line-ups
    assert "packed" not in got.columns and got.where("id_lineup = 'another'").count() == 2

import os

import pytest

from tierline.session import shared_scratch
from tierline.sources import catalog, files


def test_csv_listing_and_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 2.5), (2, "b", None)], "k int, s string, x double")
    df.write.option("header", True).csv(str(tmp_path / "One.CSV"))
    (tmp_path / "two.csv").write_text("a;b\n1;x\n2;y\n")
    (tmp_path / "notes.txt").write_text("ignored")
    listing = files.list_files(spark, str(tmp_path), ".csv")
    assert sorted(listing) == ["one.csv", "two.csv"]
    back = files.read_named_csv(spark, listing, "one")
    assert dict(back.dtypes) == {"k": "int", "s": "string", "x": "double"}
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    semi = files.read_named_csv(spark, listing, "TWO", semicolon=True)
    assert semi.columns == ["a", "b"] and semi.count() == 2
    with pytest.raises(FileNotFoundError, match="one.csv"):
        files.read_named_csv(spark, listing, "three")


def test_unlistable_folder(spark, tmp_path):
    with pytest.raises(RuntimeError):
        files.list_files(spark, str(tmp_path / "missing"), ".csv")


def test_bronze_load_reports_and_skips(spark, tmp_path):
    spark.createDataFrame([(1,), (2,)], "k int").write.option("header", True).csv(str(tmp_path / "a.csv"))
    out = catalog.bronze_load(spark, str(tmp_path), ["a", "b"], database="bronze_t",
                              location=shared_scratch(spark, "t-bronze"))
    got = {r.table_name: (r.status, r.n_rows) for r in out.collect()}
    assert got == {"a": ("loaded", 2),
                   "b": ("skipped: FileNotFoundError: b.csv not found; found: ['a.csv']", None)}
    assert spark.catalog.tableExists("bronze_t.a")


def test_save_audit_views_json(spark):
    df = spark.createDataFrame([(1, "x", 1.5)], "k int, s string, v double")
    out = catalog.save_and_audit(spark, {"t1": df}, "gold_t", location=shared_scratch(spark, "t-gold"))
    assert [(r.table_name, r.n_rows) for r in out.collect()] == [("t1", 1)]
    catalog.create_view(df, "v_t1")
    assert spark.sql("SELECT count(*) FROM v_t1").first()[0] == 1
    catalog.create_persistent_view(spark, "gold_t.v_t1p", "SELECT k FROM gold_t.t1")
    assert spark.table("gold_t.v_t1p").count() == 1
    js = catalog.rows_to_json(df, ["k"]).first().json
    assert js == '{"k":1,"s":"x","v":1.5}'
    prof = catalog.scan_profile({"t1": df}).first()
    assert (prof.table_name, prof.n_rows, prof.n_columns) == ("t1", 1, 3)
    inv = [tuple(r) for r in catalog.catalog_inventory(spark, "gold_t").collect()]
    assert inv == [("t1", 1, 3)]  # the view is not a table


@pytest.mark.parametrize("managed", [False, True])
def test_a_failing_save_leaves_the_old_rows(spark, managed):
    path = None if managed else shared_scratch(spark, "t-swap") + "/t"
    db, name = catalog.ensure_database(spark, "swap_t"), f"t_{'managed' if managed else 'path'}"
    save = lambda df: catalog.save_table(df, db, name, path=path)
    rows = lambda: sorted(map(tuple, spark.table(f"{db}.{name}").collect()))
    save(spark.range(3).selectExpr("id", "'old' as s"))
    catalog.create_persistent_view(spark, f"{db}.v_{name}", f"SELECT max(s) AS s FROM {db}.{name}")
    before = spark.table(f"{db}.{name}")
    broken = spark.range(1000).selectExpr("id", "if(id = 999, raise_error('no'), 'new') as s")
    with pytest.raises(Exception, match="no"):
        save(broken)
    assert rows() == [(0, "old"), (1, "old"), (2, "old")]
    save(spark.table(f"{db}.{name}").selectExpr("id + 10 as id", "'new' as s"))        # reads what it replaces
    assert rows() == [(10, "new"), (11, "new"), (12, "new")] and spark.table(f"{db}.v_{name}").first().s == "new"
    assert before.count() == 3                                                       # an older reader is not cut off
    save(spark.range(2).selectExpr("id", "'newer' as s"))
    assert rows() == [(0, "newer"), (1, "newer")]
    save(spark.range(1).selectExpr("cast(id as string) as k"))                        # other columns
    assert rows() == [("0",)] and spark.table(f"{db}.{name}").columns == ["k"]
    save(spark.range(2).selectExpr("cast(id as string) as k"))
    assert rows() == [("0",), ("1",)]
    assert [t.name for t in spark.catalog.listTables(db) if "next" in t.name] == []


def test_shared_scratch_under_checkpoint_dir(spark):
    ckpt = spark.sparkContext.getCheckpointDir()
    assert ckpt and shared_scratch(spark, "x").startswith(ckpt.rstrip("/"))
    assert os.path.basename(shared_scratch(spark, "x")).startswith("tierline-x-")


def test_scale_conf():
    from tierline.session import scale_conf
    c = scale_conf(100 * 2**40, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert c["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    small = scale_conf(10 << 20, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16


def test_layered_run_from_csv(spark, tmp_path):
    """CSV volume -> bronze -> silver -> gold equals the lazily computed facts."""
    import __spark_entry__  # noqa: F401  (package on path)
    from tierline import registry
    from tierline.plans import gold, medallion
    sf = "/root/testdata/sf0.001"
    src = registry.medallion_sources(spark, sf)
    for name in ("match", "team", "player", "league"):
        src[name].write.option("header", True).csv(str(tmp_path / "volume" / f"{name}.csv"))
    layers, report = medallion.run_from_csv(spark, str(tmp_path / "volume"), str(tmp_path / "tables"),
                                            prefix="csvrun_")
    status = {r.table_name: r.status for r in report}
    assert status["match"] == "loaded" and status["country"].startswith("skipped")
    got = layers["gold"].table("fact_events").collect()
    want = registry.RAW_QUERIES["fact_events"](spark, sf).collect()
    key = lambda r: (r.id_match, r.id_betting_office)
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert (g.id_period, g.home_odd, g.spread) == (w.id_period, w.home_odd, w.spread)
    view = spark.table(layers["gold"].qualified("v_match_lineup_names"))
    assert view.count() == registry.RAW_QUERIES["v_match_lineup_names"](spark, sf).count()


def test_layered_run_saves_hashes_at_half_their_length(spark, tmp_path):
    """Saved tables are zstd files; the view joins by packed ids and gives the rows of the plain join."""
    from tierline import registry
    from tierline.plans import medallion
    sf = "/root/testdata/sf0.001"
    src = {k: v for k, v in registry.medallion_sources(spark, sf).items() if k in ("match", "team", "player")}
    layers = medallion.run_all(spark, src, str(tmp_path / "tables"), "zs_", targets=["v_match_lineup_names"])
    gold = layers["gold"]
    assert all(f.endswith(".zstd.parquet") for layer in layers.values() for t in layer.saved for f in layer.table(t).inputFiles())
    view = gold.table("v_match_lineup_names")
    plain = (gold.table("fact_match").join(gold.table("lineup_names"), "id_lineup", "left").join(gold.table("dim_team"), "id_team", "left")
             .select("id_match", "local", "id_lineup", "team_name", "players_names"))
    assert view.schema == plain.schema
    assert sorted(map(str, view.collect())) == sorted(map(str, plain.collect()))
    assert "packed" in view._jdf.queryExecution().executedPlan().toString()


def test_cli(spark, tmp_path, capsys):
    from tierline.__main__ import main
    from tierline import registry
    sf = "/root/testdata/sf0.001"
    registry.medallion_sources(spark, sf)["league"].write.option("header", True) \
        .csv(str(tmp_path / "csv" / "league.csv"))
    assert main(["medallion", "--csv", str(tmp_path / "csv"), "--out", str(tmp_path / "lake"),
                 "--prefix", "cli_"]) == 0
    out = capsys.readouterr().out
    assert "bronze.league: loaded (5 rows)" in out and "bronze.match: skipped" in out
    assert main(["profile", f"{sf}/region.parquet", "--report", "nulls", "--report", "dups"]) == 0
    out = capsys.readouterr().out
    assert "== nulls" in out and "r_regionkey" in out

"""Named queries over the driver's tables: one per operator key of the survey.

Each query takes (spark, sf_dir) and returns a DataFrame. ``finish`` puts the
result in the form the SQL oracle also produces: arrays as ``|``-joined text,
floating values rounded half-even to 6 decimals, dates and timestamps as text.
"""

from __future__ import annotations

import weakref
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.numeric import round_half_even
from .operators import clean, profile, quality
from .operators.columns import columns_by_family, quoted
from .plans import gold, odds, silver, standins
from .plans.reference_data import dim_betting_office
from .session import shared_scratch
from .sources import catalog, files

TEAM = 7                       # team id used by the one-team analyses
CORR_THRESHOLD = 0.8           # strong-correlation threshold
SAMPLE_SIZE = 1000             # repeatable sample size
DUP_SUBSET = ["id", "l_returnflag"]


def finish(df: DataFrame) -> DataFrame:
    """Normalise a result for comparison with the SQL oracle (see module doc)."""
    out = []
    for f in df.schema.fields:
        c = quoted(f.name)
        dt = f.dataType
        if isinstance(dt, T.ArrayType):
            c = F.array_join(F.transform(c, lambda x: x.cast("string")), "|")
        elif isinstance(dt, (T.DoubleType, T.FloatType)):
            c = round_half_even(c.cast("double"), 6)
        elif isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


_TABLES: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


def _t(spark, sf, name):
    """The driver's (read-only) table as a DataFrame, resolved once per session:
    the file listing and footer read are not repeated for every query."""
    per_session = _TABLES.setdefault(spark, {})
    key = (sf.rstrip("/"), name)
    if key not in per_session:
        per_session[key] = files.read_table(spark, sf, name)
    return per_session[key]


# ---- shared inputs -------------------------------------------------------

def _plan(spark, sf, name, build):
    """A derived lazy plan built once per session and shared by the keys that
    start from it (each key still runs it in full)."""
    per_session = _TABLES.setdefault(spark, {})
    key = (sf.rstrip("/"), "plan:" + name)
    if key not in per_session:
        per_session[key] = build()
    return per_session[key]


def bronze_match(spark, sf):
    return _plan(spark, sf, "bronze_match", lambda: standins.m_match(
        _t(spark, sf, "orders"), _t(spark, sf, "customer"), _t(spark, sf, "nation"), _t(spark, sf, "lineitem")))


def silver_match_df(spark, sf):
    return _plan(spark, sf, "silver_match", lambda: silver.silver_match(bronze_match(spark, sf)))


def _events(spark, sf):
    return silver.events_long(silver_match_df(spark, sf))


def _lineup_map(spark, sf, sm=None):
    sm = sm if sm is not None else silver_match_df(spark, sf)
    return gold.lineup_map(gold.lineups_base(sm))


def _dim_player(spark, sf):
    return gold.dim_player(standins.m_player(_t(spark, sf, "part")))


def _dim_period(spark, sf):
    sm = silver_match_df(spark, sf)
    return gold.dim_period(sm, silver.events_long(sm))


def _fact_events(spark, sf):
    sm = silver_match_df(spark, sf)
    ev = silver.events_long(sm)
    return gold.fact_events(ev, gold.dim_period(sm, ev), dim_betting_office(spark))


def _lineup_names(spark, sf, lmap=None):
    lmap = lmap if lmap is not None else _lineup_map(spark, sf)
    return gold.lineup_names(gold.lineup_bridge(gold.lineup_dim(lmap)), _dim_player(spark, sf))


def _fact_match(spark, sf, sm=None, lmap=None):
    sm = sm if sm is not None else silver_match_df(spark, sf)
    lmap = lmap if lmap is not None else _lineup_map(spark, sf, sm)
    return gold.fact_match(sm, lmap)


def _view(spark, sf):
    sm = silver_match_df(spark, sf)
    lmap = _lineup_map(spark, sf, sm)
    return gold.v_match_lineup_names(_fact_match(spark, sf, sm, lmap), _lineup_names(spark, sf, lmap),
                                     gold.dim_team(standins.m_team(_t(spark, sf, "nation"))))


def _m_dups(spark, sf):
    return standins.m_dups(_t(spark, sf, "lineitem"))


def _m_nulls(spark, sf):
    return standins.m_nulls(_t(spark, sf, "lineitem"))


def _m_part(spark, sf):
    return standins.m_part(_t(spark, sf, "part"))


def _m_dates(spark, sf):
    return standins.m_dates(_t(spark, sf, "orders"))


def _order_lines(spark, sf):
    return standins.m_order_lines(_t(spark, sf, "lineitem")).drop("l_orderkey")


def _lineitem_numeric(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.select(*columns_by_family(li, "number"))


# ---- sources and sinks ---------------------------------------------------

def _write_csvs(spark, sf, names):
    """Write tables as CSV (header row) into a fresh shared folder, one
    ``<name>.csv`` entry per table."""
    folder = shared_scratch(spark, "csv")
    for name in names:
        _t(spark, sf, name).write.mode("overwrite").option("header", True).csv(f"{folder}/{name}.csv")
    return folder


def _streamed(spark, sf, build):
    """Land the bronze match rows as files, run ``build`` over them as a
    stream (available-now trigger) into a checkpointed sink, read the sink."""
    from .streaming import ingest
    base = shared_scratch(spark, "stream")
    matches = bronze_match(spark, sf)
    matches.write.mode("overwrite").parquet(f"{base}/landing")
    stream = ingest.landing_stream(spark, f"{base}/landing", matches.schema)
    ingest.run_available_now(build(stream), f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out")


def q_events_long_stream(spark, sf):
    from .streaming import ingest
    return _streamed(spark, sf, ingest.events_long_stream)


def q_dim_period_stream(spark, sf):
    from .streaming import ingest
    base = shared_scratch(spark, "stream")
    matches = bronze_match(spark, sf)
    matches.write.mode("overwrite").parquet(f"{base}/landing")
    stream = ingest.landing_stream(spark, f"{base}/landing", matches.schema, max_files_per_trigger=8)
    ingest.dim_period_stream(stream, f"{base}/dim_period", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/dim_period")


def medallion_sources(spark, sf):
    """The football source tables, as stand-ins on the driver's tables."""
    region = _t(spark, sf, "region")
    return {
        "match": bronze_match(spark, sf),
        "team": standins.m_team(_t(spark, sf, "nation")),
        "player": standins.m_player(_t(spark, sf, "part")),
        "player_attributes": _m_dates(spark, sf),
        "team_attributes": _m_dups(spark, sf),
        "league": standins.m_league(region),
        "country": region.select(region["r_regionkey"].alias("id"), region["r_name"].alias("name")),
    }


def _medallion(spark, sf, sources, target):
    import uuid
    from .plans import medallion
    prefix = f"t{uuid.uuid4().hex[:8]}_"
    wanted = {k: v for k, v in medallion_sources(spark, sf).items() if k in sources}
    layers = medallion.run_all(spark, wanted, shared_scratch(spark, "medallion"), prefix, targets=[target])
    return layers["gold"].table(target)


def q_medallion_fact_events(spark, sf):
    return _medallion(spark, sf, {"match"}, "fact_events")


def q_medallion_view(spark, sf):
    return _medallion(spark, sf, {"match", "team", "player"}, "v_match_lineup_names")


def q_csv_roundtrip(spark, sf):
    folder = _write_csvs(spark, sf, ["supplier"])
    listing = files.list_files(spark, folder, ".csv")
    return files.read_named_csv(spark, listing, "supplier")


def q_bronze_load(spark, sf):
    folder = _write_csvs(spark, sf, ["region", "nation", "supplier"])
    return catalog.bronze_load(spark, folder, ["region", "nation", "supplier", "part"],
                               database="bronze", location=shared_scratch(spark, "bronze"))


def q_save_and_audit(spark, sf):
    frames = {n: _t(spark, sf, n) for n in ("region", "nation", "supplier")}
    return catalog.save_and_audit(spark, frames, "gold", location=shared_scratch(spark, "gold"))


def q_scan_profile(spark, sf):
    return catalog.scan_profile(files.load_tables(spark, sf))


def q_rows_to_json(spark, sf):
    return catalog.rows_to_json(_t(spark, sf, "customer"), ["c_custkey"])


# ---- registry ------------------------------------------------------------

def _build() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable] = {}
    # silver
    q["silver_match"] = silver_match_df
    q["events_long"] = _events
    q["silver_player"] = lambda s, sf: silver.silver_player(standins.m_player_birthdays(_t(s, sf, "orders")))
    q["silver_player_attributes"] = lambda s, sf: silver.silver_player_attributes(_m_dates(s, sf))
    q["parse_dates"] = lambda s, sf: clean.parse_timestamp(_m_dates(s, sf), "date")
    q["dedupe_keep_min_id"] = lambda s, sf: silver.silver_team_attributes(_m_dups(s, sf))
    # gold dimensions
    q["dim_team"] = lambda s, sf: gold.dim_team(standins.m_team(_t(s, sf, "nation")))
    q["dim_player"] = _dim_player
    q["dim_league"] = lambda s, sf: gold.dim_league(standins.m_league(_t(s, sf, "region")))
    q["dim_match"] = lambda s, sf: gold.dim_match(silver_match_df(s, sf))
    q["dim_period"] = _dim_period
    # line-ups
    q["lineups_base"] = lambda s, sf: gold.lineups_base(silver_match_df(s, sf))
    q["lineup_ids"] = _lineup_map
    q["lineup_dim"] = lambda s, sf: gold.lineup_dim(_lineup_map(s, sf))
    q["lineup_bridge"] = lambda s, sf: gold.lineup_bridge(gold.lineup_dim(_lineup_map(s, sf)))
    q["lineup_names"] = _lineup_names
    # facts and view
    q["fact_match"] = _fact_match
    q["fact_events"] = _fact_events
    q["v_match_lineup_names"] = _view
    # odds analytics
    q["odds_offices"] = lambda s, sf: odds.odds_offices(bronze_match(s, sf))
    q["odds_melt"] = lambda s, sf: odds.odds_melt(bronze_match(s, sf))
    q["bookie_odds_pivot"] = lambda s, sf: odds.bookie_odds_pivot(bronze_match(s, sf))
    q["spread_describe"] = lambda s, sf: odds.spread_describe(bronze_match(s, sf), TEAM)
    q["top_spread_matches"] = lambda s, sf: odds.top_spread_matches(bronze_match(s, sf))
    q["league_spread_rank"] = lambda s, sf: odds.league_spread_rank(
        bronze_match(s, sf), standins.m_league(_t(s, sf, "region")))
    q["team_matches"] = lambda s, sf: odds.team_matches(bronze_match(s, sf), TEAM)
    q["hash_sample"] = lambda s, sf: odds.hash_sample(bronze_match(s, sf), TEAM, SAMPLE_SIZE)
    # completeness
    q["null_profile"] = lambda s, sf: profile.null_profile(_m_nulls(s, sf))
    q["row_null_histogram"] = lambda s, sf: profile.row_null_histogram(_m_nulls(s, sf))
    q["rows_with_nulls"] = lambda s, sf: profile.rows_with_nulls(_m_nulls(s, sf))
    q["clean_dropna"] = lambda s, sf: clean.drop_null_rows(_m_nulls(s, sf))
    q["clean_dropna_subset"] = lambda s, sf: clean.drop_null_rows(
        _m_nulls(s, sf), columns_by_family(_m_nulls(s, sf), "object", "bool", "datetime"))
    q["clean_fill_mean"] = lambda s, sf: clean.fill_with_mean(_m_nulls(s, sf))
    q["row_value_counts"] = lambda s, sf: profile.row_value_counts(_m_nulls(s, sf))
    # uniqueness
    q["clean_dedupe"] = lambda s, sf: clean.drop_duplicate_rows(_m_dups(s, sf))
    q["dup_rows"] = lambda s, sf: quality.duplicate_rows(_m_dups(s, sf))
    q["dup_rows_ignoring_id"] = lambda s, sf: quality.duplicate_rows(
        _m_dups(s, sf), [c for c in _m_dups(s, sf).columns if c != "id"], sort=True)
    q["dup_rows_subset"] = lambda s, sf: quality.duplicate_rows(_m_dups(s, sf), DUP_SUBSET)
    q["dup_rows_pct"] = lambda s, sf: profile.dup_rows_pct(_m_dups(s, sf))
    q["dup_profile"] = lambda s, sf: profile.dup_profile(_m_dups(s, sf))
    # summaries and correlation
    q["describe_numeric"] = lambda s, sf: profile.describe_numeric(_lineitem_numeric(s, sf))
    q["corr_matrix"] = lambda s, sf: profile.corr_long(_lineitem_numeric(s, sf)).select("var1", "var2", "r")
    q["corr_pairs"] = lambda s, sf: profile.corr_pairs(_lineitem_numeric(s, sf), CORR_THRESHOLD)
    q["corr_strong_matrix"] = lambda s, sf: profile.corr_strong_matrix(_lineitem_numeric(s, sf), CORR_THRESHOLD)
    q["corr_pairs_orders"] = lambda s, sf: profile.corr_pairs(_order_lines(s, sf), CORR_THRESHOLD, materialize=True)
    q["corr_strong_matrix_orders"] = lambda s, sf: profile.corr_strong_matrix(_order_lines(s, sf), CORR_THRESHOLD, materialize=True)
    q["group_size_topk"] = lambda s, sf: profile.group_size_topk(_t(s, sf, "part"), "p_name", 5)
    q["value_counts"] = lambda s, sf: profile.value_counts(_t(s, sf, "orders"))
    # consistency
    q["fd_violations"] = lambda s, sf: quality.fd_violations(_m_part(s, sf))
    q["whitespace_check"] = lambda s, sf: quality.whitespace_check(_m_part(s, sf))
    q["casing_check"] = lambda s, sf: quality.check_consistency(_m_part(s, sf), checks=["short_name_casing"])["short_name_casing"]
    q["casing_check_strict"] = lambda s, sf: quality.casing_rows_strict(
        _m_part(s, sf), "team_api_id", "team_short_name")
    q["consistency_summary"] = lambda s, sf: quality.check_consistency(_m_part(s, sf))["summary"]
    # key relationships
    q["key_checks"] = lambda s, sf: quality.key_checks(standins.m_labels(_t(s, sf, "labels")), "doc_id", _t(s, sf, "documents"), "doc_id")
    q["orphan_keys"] = lambda s, sf: quality.orphan_keys(standins.m_labels(_t(s, sf, "labels")), "doc_id", _t(s, sf, "documents"), "doc_id")
    q["join_one_to_one"] = lambda s, sf: quality.join_one_to_one(
        _t(s, sf, "documents"), _t(s, sf, "labels"), "doc_id", "doc_id")
    # layered run into saved tables; read back from the gold layer
    q["medallion_fact_events"] = q_medallion_fact_events
    q["medallion_view"] = q_medallion_view
    # incremental (streaming) variants
    q["events_long_stream"] = q_events_long_stream
    q["dim_period_stream"] = q_dim_period_stream
    # sources and sinks
    q["scan_profile"] = q_scan_profile
    q["rows_to_json"] = q_rows_to_json
    q["csv_roundtrip"] = q_csv_roundtrip
    q["bronze_load"] = q_bronze_load
    q["save_and_audit"] = q_save_and_audit
    return q


RAW_QUERIES = _build()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda fn: (lambda spark, sf: finish(fn(spark, sf))))(fn)
            for name, fn in RAW_QUERIES.items()}

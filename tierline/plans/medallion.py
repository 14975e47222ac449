"""The layered run: bronze tables -> silver tables -> gold tables and view.

Each layer reads the previous layer's saved tables, so every step starts from
storage (short lineage, restartable per table) rather than from one long plan.
The line-up map, needed by both the line-up tables and the match fact, is
saved once instead of being recomputed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.lineup import pack_sql, unpack_sql
from ..sources.catalog import create_persistent_view, ensure_database, save_table
from . import gold, silver


# Line-up ids are hash digits, which zstd halves and snappy, Spark's default, leaves as they are.
CODECS = {"parquet": {"compression": "zstd"}, "orc": {"compression": "zstd"}}


class Layer:
    """A database at a shared location; ``save`` writes and returns the table re-read."""

    def __init__(self, spark: SparkSession, name: str, location: str, fmt: str = "parquet"):
        self.spark, self.name, self.location, self.fmt = spark, name, location.rstrip("/"), fmt
        ensure_database(spark, name, self.location)
        self.saved: list[str] = []

    def qualified(self, table: str) -> str:
        return f"`{self.name}`.`{table}`"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.name}.{table}")

    def save(self, table: str, df: DataFrame) -> DataFrame:
        save_table(df, self.name, table, self.fmt, f"{self.location}/{table}", CODECS.get(self.fmt.lower()))
        self.saved.append(table)
        return self.table(table)

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.qualified(table))


def run_bronze(bronze: Layer, sources: dict[str, DataFrame]) -> None:
    """Raw inputs saved unchanged (CSV inputs: see ``sources.catalog.bronze_load``)."""
    for name, df in sources.items():
        bronze.save(name, df)


def run_silver(bronze: Layer, silver_layer: Layer, with_events: bool = True) -> None:
    """Typing and cleaning; each step runs only when its bronze table exists
    (``events_long`` only when ``with_events``)."""
    steps = {
        "match": silver.silver_match,
        "team": lambda df: df,
        "player": silver.silver_player,
        "player_attributes": silver.silver_player_attributes,
        "team_attributes": silver.silver_team_attributes,
        "league": lambda df: df,
        "country": lambda df: df,
    }
    for name, step in steps.items():
        if bronze.exists(name):
            silver_layer.save(name, step(bronze.table(name)))
    if with_events and silver_layer.exists("match"):
        ev = silver.events_long(silver_layer.table("match"))
        if ev is not None:
            silver_layer.save("events_long", ev)


# gold objects and what they are built from (gold names, or silver tables as "silver.<t>")
GOLD_INPUTS = {
    "dim_team": ["silver.team"],
    "dim_player": ["silver.player"],
    "league": ["silver.league"],
    "dim_betting_office": [],
    "dim_event": [],
    "dim_match": ["silver.match"],
    "dim_period": ["silver.match", "silver.events_long"],
    "fact_events": ["silver.events_long", "dim_period", "dim_betting_office"],
    "lineups_map": ["silver.match"],
    "id_lineup": ["lineups_map"],
    "id_bridge_lineup": ["id_lineup"],
    "lineup_names": ["id_bridge_lineup", "dim_player"],
    "fact_match": ["silver.match", "lineups_map"],
    "v_match_lineup_names": ["fact_match", "lineup_names", "dim_team"],
}


def view_sql(facts: str, names: str, teams: str) -> str:
    """The serving view: match sides with what each lookup knows of them; line-up ids travel packed."""
    return (f"SELECT id_match, local, {unpack_sql('packed')} AS id_lineup, team_name, players_names "
            f"FROM (SELECT id_match, local, {pack_sql('id_lineup')} AS packed, id_team FROM {facts}) "
            f"LEFT JOIN (SELECT {pack_sql('id_lineup')} AS packed, players_names FROM {names}) USING (packed) "
            f"LEFT JOIN {teams} USING (id_team)")


def gold_closure(targets) -> set[str]:
    """Gold objects needed to build ``targets`` (all of them when None)."""
    if targets is None:
        return set(GOLD_INPUTS)
    out: set[str] = set()

    def add(name):
        if name in out or name.startswith("silver."):
            return
        out.add(name)
        for dep in GOLD_INPUTS[name]:
            add(dep)

    for t in targets:
        add(t)
    return out


def run_gold(silver_layer: Layer, gold_layer: Layer, targets=None) -> None:
    """Dimensions, line-up tables, facts and the serving view (only those
    ``targets`` depend on, when given); a step runs when its inputs exist."""
    s, g = silver_layer, gold_layer
    spark = g.spark
    want = gold_closure(targets)
    if "dim_team" in want and s.exists("team"):
        g.save("dim_team", gold.dim_team(s.table("team")))
    if "dim_player" in want and s.exists("player"):
        g.save("dim_player", gold.dim_player(s.table("player")))
    if "league" in want and s.exists("league"):
        g.save("league", gold.dim_league(s.table("league")))
    if "dim_betting_office" in want:
        g.save("dim_betting_office", gold.dim_betting_office(spark))
    if "dim_event" in want:
        g.save("dim_event", gold.dim_event(spark))
    if not s.exists("match"):
        return
    match = s.table("match")
    if "dim_match" in want:
        g.save("dim_match", gold.dim_match(match))
    if "dim_period" in want and s.exists("events_long"):
        periods = g.save("dim_period", gold.dim_period(match, s.table("events_long")))
        if "fact_events" in want:
            g.save("fact_events", gold.fact_events(s.table("events_long"), periods,
                                                   g.table("dim_betting_office")))
    if "lineups_map" in want:
        lmap = g.save("lineups_map", gold.lineup_map(gold.lineups_base(match)))
        if "id_lineup" in want:
            dim = g.save("id_lineup", gold.lineup_dim(lmap))
            bridge = g.save("id_bridge_lineup", gold.lineup_bridge(dim))
            if "lineup_names" in want and g.exists("dim_player"):
                g.save("lineup_names", gold.lineup_names(bridge, g.table("dim_player")))
        if "fact_match" in want:
            g.save("fact_match", gold.fact_match(match, lmap))
    if "v_match_lineup_names" in want and g.exists("lineup_names") and g.exists("dim_team"):
        create_persistent_view(spark, g.qualified("v_match_lineup_names"),
                               view_sql(*map(g.qualified, ("fact_match", "lineup_names", "dim_team"))))


def run_all(spark: SparkSession, sources: dict[str, DataFrame], location: str,
            prefix: str = "", fmt: str = "parquet", targets=None) -> dict[str, Layer]:
    """Bronze, silver and gold in order under ``location``; returns the layers.
    ``targets`` limits the gold layer to those objects and their inputs."""
    layers = {n: Layer(spark, f"{prefix}{n}", f"{location.rstrip('/')}/{n}", fmt)
              for n in ("bronze", "silver", "gold")}
    run_bronze(layers["bronze"], sources)
    gold_needs = gold_closure(targets)
    run_silver(layers["bronze"], layers["silver"],
               with_events=bool(gold_needs & {"dim_period", "fact_events"}))
    run_gold(layers["silver"], layers["gold"], targets)
    return layers


# The source tables of the workload, as named in the CSV volume.
SOURCE_TABLES = ["match", "team", "player", "player_attributes", "team_attributes", "league", "country"]


def run_from_csv(spark: SparkSession, folder: str, location: str, prefix: str = "",
                 fmt: str = "parquet", semicolon: bool = False, targets=None):
    """CSV volume -> bronze (guarded load: a missing or unreadable table is
    reported and skipped) -> silver -> gold. Returns (layers, load report)."""
    from ..sources.catalog import bronze_load
    base = location.rstrip("/")
    layers = {n: Layer(spark, f"{prefix}{n}", f"{base}/{n}", fmt) for n in ("bronze", "silver", "gold")}
    report = bronze_load(spark, folder, SOURCE_TABLES, database=layers["bronze"].name, fmt=fmt,
                         location=layers["bronze"].location, semicolon=semicolon)
    report = report.collect()  # one row per source table: the load outcome
    gold_needs = gold_closure(targets)
    run_silver(layers["bronze"], layers["silver"],
               with_events=bool(gold_needs & {"dim_period", "fact_events"}))
    run_gold(layers["silver"], layers["gold"], targets)
    return layers, report

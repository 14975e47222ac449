"""Silver -> gold star schema: dimensions, line-up hashing and bridge, facts, view."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.lineup import lineup_hash, pack_id, unpack_id
from ..functions.odds import spread_fraction
from ..functions.text import extract_player_id
from ..operators.joins import split_join
from ..session import cut_lineage
from . import reference_data

SENTINEL_PLAYER = (0, "Unknown / Not Available")


def dim_team(team: DataFrame) -> DataFrame:
    return (team.where(F.col("team_api_id").isNotNull())
            .select(F.col("team_api_id").alias("id_team"),
                    F.coalesce("team_long_name", "team_short_name").alias("team_name"))
            .distinct())


def dim_player(player: DataFrame) -> DataFrame:
    """Distinct (id, name) plus the 'unknown' row 0 when no player has id 0."""
    dim = (player.where(F.col("player_api_id").isNotNull())
           .select(F.col("player_api_id").alias("id_player"), "player_name").distinct())
    id_type = dim.schema["id_player"].dataType
    sentinel = reference_data.literal_rows(dim.sparkSession, [SENTINEL_PLAYER], T.StructType([
        T.StructField("id_player", id_type), T.StructField("player_name", T.StringType())]))
    missing = sentinel.join(dim.where(F.col("id_player") == SENTINEL_PLAYER[0]).select("id_player"),
                            "id_player", "left_anti")
    return dim.unionByName(missing)


def dim_league(league: DataFrame) -> DataFrame:
    return league.select(F.col("id").alias("id_league"), "name",
                         F.col("country_id").alias("country")).distinct()


def dim_match(match: DataFrame) -> DataFrame:
    return match.select(F.col("id").alias("id_match"), F.col("match_api_id").alias("match"),
                        "season").distinct()


def dim_period(match: DataFrame, events: DataFrame) -> DataFrame:
    """Calendar rows for every match date and odds date (UNION: distinct).
    Odds rows without a date contribute one all-NULL row."""
    dates_m = match.where(F.col("match_date").isNotNull()).select(F.to_date("match_date").alias("date"))
    dates_e = events.select(F.col("date_key").alias("date"))
    dates = dates_m.unionByName(dates_e).distinct()
    return period_rows(dates)


def period_rows(dates: DataFrame) -> DataFrame:
    """Calendar columns for a frame of distinct ``date`` values."""
    return dates.select(F.col("date").cast("string").alias("id_period"),
                        F.year("date").alias("year"), F.month("date").alias("month"),
                        F.dayofmonth("date").alias("day"), "date",
                        F.lit(None).cast("int").alias("minute"), F.lit(None).cast("int").alias("seconds"),
                        F.col("date").cast("timestamp").alias("timestamp"))


def dim_betting_office(spark) -> DataFrame:
    return reference_data.dim_betting_office(spark)


def dim_event(spark) -> DataFrame:
    return reference_data.dim_event(spark)


def _slots(columns: list[str], side: str) -> list[str]:
    """The side's player columns by slot number, names in any case; none is an error."""
    numbered = {}
    for c in columns:
        if m := re.fullmatch(rf"{side}_player_(\d+)", c, re.IGNORECASE):
            numbered[int(m.group(1))] = c
    if not numbered:
        raise ValueError(f"the match table has no {side}_player_<n> column")
    return [numbered[n] for n in sorted(numbered)]


def lineups_base(match: DataFrame) -> DataFrame:
    """(id_match, local, players): one array of player ids per side, 0 for an
    unknown slot. One scan emits both sides (home local=1, away local=0)."""
    sides = []
    for side, local in (("home", 1), ("away", 0)):
        slots = _slots(match.columns, side)
        players = F.array(*[extract_player_id(F.col(c), match.schema[c].dataType) for c in slots])
        sides.append(F.struct(F.lit(local).alias("local"), players.alias("players")))
    return (match.select(F.col("id").alias("id_match"), F.explode(F.array(*sides)).alias("s"))
            .select("id_match", "s.local", "s.players"))


def lineup_map(base: DataFrame) -> DataFrame:
    """Adds ``id_lineup`` (see :func:`tierline.functions.lineup.lineup_hash`)."""
    return base.withColumn("id_lineup", lineup_hash(F.col("players"), F.col("id_match"), F.col("local")))


def lineup_dim(lmap: DataFrame, one_variant: bool = False) -> DataFrame:
    """Distinct (id_lineup, players). The hash ignores slot order, so one id can
    carry several ``players`` arrays; ``one_variant`` keeps only the lowest."""
    dim = (lmap.select(pack_id(), "players").distinct()
           .select(unpack_id(), "players"))
    if one_variant:
        dim = dim.groupBy("id_lineup").agg(F.min("players").alias("players"))
    return dim


def lineup_bridge(dim: DataFrame) -> DataFrame:
    """(id_lineup, position from 0, id_player) for every slot."""
    return dim.select("id_lineup", F.posexplode("players").alias("position", "id_player"))


def lineup_names(bridge: DataFrame, players: DataFrame) -> DataFrame:
    """(id_lineup, players_names): names ordered by slot then name; '0' for an
    unknown or blank player.

    The named slots are dealt out once, by line-up; there equal (position, name) entries
    are counted before they are collected, so the collected list is bounded by distinct
    slot/name pairs, not by how many variants share a hash; the counts are expanded again
    in the final array. The unknown player 0 needs no join: its name is '0' whatever
    the player table says, once per row that table has for it.
    """
    known = cut_lineage(players.select("id_player", "player_name"))
    unknown = F.col("id_player") == 0
    n_unknown = max(known.where(unknown).count(), 1)
    slots = bridge.select(pack_id(), "position", "id_player")
    # no name at all: player 0
    named = (split_join(slots, known.where(~unknown), ["id_player"], "left")
             .select("packed", "position", F.when(unknown, F.lit(None))
                     .otherwise(F.when(F.trim("player_name") != "", F.col("player_name")).otherwise(F.lit("0"))).alias("nm")))
    counted = named.repartition("packed").groupBy("packed", "position", "nm").agg(F.count(F.lit(1)).alias("n"))
    times = F.when(F.col("nm").isNull(), F.col("n") * n_unknown).otherwise(F.col("n"))
    entry = F.struct(F.col("position").alias("pos"), F.coalesce("nm", F.lit("0")).alias("nm"), times.alias("c"))
    entries = F.array_sort(F.collect_list(entry))
    expanded = F.flatten(F.transform(entries, lambda e: F.array_repeat(e["nm"], e["c"].cast("int"))))
    return (counted.groupBy("packed").agg(expanded.alias("players_names"))
            .select(unpack_id(), "players_names"))


def _match_result(home_goals, away_goals):
    return (F.when(home_goals > away_goals, F.lit("H"))
            .when(home_goals < away_goals, F.lit("A")).otherwise(F.lit("D")))


def fact_match(match: DataFrame, lmap: DataFrame) -> DataFrame:
    """Two rows per match (home local=1, away local=0) with the home-side
    result H/D/A, goals for/against, and the side's line-up; rows with a
    missing or negative goal count are dropped."""
    hg, ag = F.col("home_team_goal"), F.col("away_team_goal")
    result = _match_result(hg, ag)
    sides = [F.struct(F.lit(1).alias("local"), F.col("home_team_api_id").alias("id_team"),
                      hg.alias("num_goals_favor"), ag.alias("num_goals_against")),
             F.struct(F.lit(0).alias("local"), F.col("away_team_api_id").alias("id_team"),
                      ag.alias("num_goals_favor"), hg.alias("num_goals_against"))]
    base = (match.select(F.col("league_id").alias("id_league"),
                         F.to_date("match_date").cast("string").alias("id_period"),
                         F.col("id").alias("id_match"), result.alias("match_result"),
                         F.explode(F.array(*sides)).alias("s"))
            .select("id_league", "id_period", "id_match", "s.local", "s.id_team", "match_result",
                    "s.num_goals_favor", "s.num_goals_against")
            .where((F.col("num_goals_favor") >= 0) & (F.col("num_goals_against") >= 0)))
    # distinct by more than the join's keys, so the join shuffles the lookup for itself: nothing to save
    lookup = lmap.select("id_match", "local", pack_id()).distinct()
    joined = split_join(base, lookup, ["id_match", "local"], "left", save=False)
    return joined.select(
        "id_league", "id_period", "id_match", "local", "id_team", "match_result",
        "num_goals_favor", "num_goals_against", unpack_id())


def fact_events(events: DataFrame, periods: DataFrame, offices: DataFrame,
                id_event: int = 10001) -> DataFrame:
    """Odds facts keyed to period and office, with the spread as a fraction;
    only rows whose three odds all exceed 1."""
    # the calendar has one row a day and is saved, so that the planner knows its
    # size before it would deal the facts out by day. Offices are literal rows.
    per = periods.select(F.col("date").alias("date_key"), "id_period")
    off = F.broadcast(offices.select(F.col("abbr").alias("betting_office"), "id_betting_office"))
    h, d, a = F.col("home_odd"), F.col("draw_odd"), F.col("visitor_odd")
    return (split_join(events.where((h > 1) & (d > 1) & (a > 1)), per, ["date_key"], "left")
            .join(off, "betting_office", "left")
            .select("id_league", "id_period", "id_match", "id_betting_office",
                    F.lit(id_event).alias("id_event"), "home_odd", "draw_odd", "visitor_odd",
                    spread_fraction(h, d, a).alias("spread")))


def v_match_lineup_names(facts: DataFrame, names: DataFrame, teams: DataFrame) -> DataFrame:
    """Match sides with their team name and line-up names; names and teams are
    saved once and joined with :func:`split_join`."""
    sides = facts.select("id_match", "local", pack_id(), "id_team")
    named = split_join(split_join(sides, names.select(pack_id(), "players_names"), ["packed"], "left"), teams, ["id_team"], "left")
    return named.select("id_match", "local", unpack_id(), "team_name", "players_names")

"""Odds analytics: melt/pivot of office columns, margins, rankings, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.odds import overround_pct3, spread_pct2
from ..operators.clean import hash_sample as _hash_sample
from ..operators.columns import suffix_columns
from ..operators.joins import join_with_suffixes
from ..operators.profile import describe_numeric
from ..operators.reshape import melt, pivot_mean, split_last_char
from . import reference_data


def odds_melt(match: DataFrame, id_col: str = "match_api_id", sort: bool = True) -> DataFrame:
    """(id, bookie_odds_type, odds, local, bookie) for every column ending in
    A/D/H; NULL odds kept; ``local`` is the last letter, ``bookie`` the rest."""
    cols = suffix_columns([c for c in match.columns if c != id_col])
    long = melt(match.select(id_col, *cols), [id_col], cols, "bookie_odds_type", "odds")
    bookie, local = split_last_char(F.col("bookie_odds_type"))
    out = long.withColumn("local", local).withColumn("bookie", bookie)
    if not sort:
        return out
    # ties (repeated ids) are broken by a deterministic row hash so the range
    # partitioner can split a hot id across tasks
    return out.orderBy(id_col, "bookie_odds_type", F.xxhash64(*out.columns))


def odds_offices(match: DataFrame) -> DataFrame:
    """Offices found from odds column names, with how many odds cells they have
    and how many are filled."""
    long = odds_melt(match, sort=False)
    return long.groupBy("bookie").agg(F.count(F.lit(1)).alias("n_values"),
                                      F.count("odds").alias("n_odds"))


def bookie_odds_pivot(match: DataFrame, id_col: str = "match_api_id") -> DataFrame:
    """Melt -> pivot (mean per match, office and side) -> overround (percent,
    3 decimals) -> office id from the bookmaker catalogue."""
    long = odds_melt(match, id_col, sort=False)
    wide = pivot_mean(long, [id_col, "bookie"], "local", "odds", ["A", "D", "H"])
    books = F.broadcast(reference_data.bookmakers(match.sparkSession))  # literal rows
    out = (wide.withColumn("id_match_event", F.lit(1))
           .withColumn("overround", overround_pct3(F.col("H"), F.col("D"), F.col("A")))
           .join(books, wide["bookie"] == books["code"], "left").drop("code")
           .withColumnRenamed("id", "id_bookmaker")
           .drop("bookie").withColumnRenamed(id_col, "id_match"))
    return out


def with_spread(match: DataFrame, office: str = "B365") -> DataFrame:
    """Adds ``spread`` = margin in percent (2 decimals) of one office's odds."""
    return match.withColumn("spread", spread_pct2(F.col(f"{office}H"), F.col(f"{office}D"),
                                                  F.col(f"{office}A")))


def team_filter(team: int):
    return (F.col("home_team_api_id") == team) | (F.col("away_team_api_id") == team)


def team_matches(match: DataFrame, team: int) -> DataFrame:
    """Matches where ``team`` plays at home or away."""
    return match.where(team_filter(team))


def spread_describe(match: DataFrame, team: int, office: str = "B365") -> DataFrame:
    """Summary (count, mean, std, min, quartiles, max) of the spread over all
    matches and over one team's matches, in one pass."""
    s = with_spread(match, office)
    both = s.select(F.col("spread").alias("all_matches"),
                    F.when(team_filter(team), F.col("spread")).alias(f"team_{team}"))
    # the spread comes from joined stand-in tables: materialise the two
    # columns once instead of recomputing the joins in every pass
    return describe_numeric(both, ["all_matches", f"team_{team}"], materialize=True)


def top_spread_matches(match: DataFrame, k: int = 10, office: str = "B365") -> DataFrame:
    """The ``k`` matches with the largest spread (NULL last, ties by id): a top-k, not a sort."""
    return (with_spread(match, office)
            .select("match_api_id", "date", "season", "home_team_api_id", "away_team_api_id", "spread")
            .orderBy(F.desc_nulls_last("spread"), "match_api_id").limit(k))


def league_spread_rank(match: DataFrame, league: DataFrame, k: int = 10,
                       office: str = "B365") -> DataFrame:
    """Leagues by mean spread, highest first (NULL spreads skipped)."""
    joined = join_with_suffixes(with_spread(match, office), league, "league_id", "id",
                                "inner", ("_match", "_league"))
    return (joined.groupBy("name").agg(F.avg("spread").alias("spread"))
            .orderBy(F.desc_nulls_last("spread"), "name").limit(k))


def hash_sample(match: DataFrame, team: int, n: int = 1000) -> DataFrame:
    """Up to ``n`` of the team's matches, chosen repeatably by md5 of the id."""
    return _hash_sample(team_matches(match, team), "match_api_id", n)

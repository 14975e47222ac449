"""Stand-in inputs of the football workload, derived from the driver's tables.

Each builder mirrors a statement of FIXTURES.md (which runs unchanged in Spark
SQL and DuckDB); they are DataFrame plans so Catalyst prunes the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


N_SLOTS = 6
# Offices of the stand-in odds and the line number feeding each.
STANDIN_OFFICES = [("B365", 1), ("BW", 2), ("WH", 3)]


def m_lines(lineitem: DataFrame) -> DataFrame:
    """Per order: player slots (home from open lines, as numbers; away from filled ones,
    as text) and odds. Player 5 holds at least a third of the slots."""
    ln, ls = F.col("l_linenumber"), F.col("l_linestatus")
    player = F.when(F.col("l_partkey") % 3 == 0, F.lit(5).cast("bigint")).otherwise(F.col("l_partkey") % 12)
    aggs = []
    for side, status in (("home", "O"), ("away", "F")):
        for i in range(1, N_SLOTS + 1):
            slot = F.min(F.when((ln == i) & (ls == status), player))
            slot = F.concat(F.lit("p"), slot.cast("string")) if side == "away" else slot
            aggs.append(slot.alias(f"{side}_player_{i}"))
    for office, line in STANDIN_OFFICES:
        aggs += [F.min(F.when(ln == line, 1 + F.col("l_quantity") / 10)).alias(f"{office}H"),
                 F.min(F.when(ln == line, 1 + F.col("l_discount") * 40)).alias(f"{office}D"),
                 F.min(F.when(ln == line, 1 + F.col("l_tax") * 50)).alias(f"{office}A")]
    return lineitem.groupBy(F.col("l_orderkey").alias("lk")).agg(*aggs)


def m_match(orders: DataFrame, customer: DataFrame, nation: DataFrame,
            lineitem: DataFrame) -> DataFrame:
    """One match per order: league from the customer's region, teams and goals
    from keys, players and odds from the order's lines. Some dates and seasons are
    malformed or missing, and one day holds a third of the matches."""
    od = F.col("o_orderdate")
    year, month = F.year(od), F.month(od)
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    none = F.lit(None).cast("string")
    season = F.when(ok % 71 == 0, "unknown").when(ok % 73 == 0, none).when(ok % 67 == 0, "2014").when(month >= 7, F.concat(year.cast("string"), F.lit("/"), (year + 1).cast("string"))) \
        .otherwise(F.concat((year - 1).cast("string"), F.lit("/"), year.cast("string")))
    date = (F.when(ok % 83 == 0, "bad").when(ok % 79 == 0, none).when(ok % 3 == 0, "1995-06-17 00:00:00")
            .otherwise(od.cast("string")))
    home_goal = (F.when(ok % 97 == 0, F.lit(None).cast("bigint"))
                 .when(ok % 89 == 0, F.lit(-1).cast("bigint")).otherwise(ok % 5))
    # nation is a small file: the planner broadcasts it from its size statistics
    nat = nation.select("n_nationkey", "n_regionkey")
    base = (orders.join(customer.select("c_custkey", "c_nationkey"), ck == F.col("c_custkey"))
            .join(nat, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(ok.alias("id"), (ok + 480000).alias("match_api_id"),
                    F.col("n_regionkey").alias("league_id"), F.col("n_regionkey").alias("country_id"),
                    date.alias("date"), season.alias("season"),
                    (ck % 25).alias("home_team_api_id"), ((ck * 7 + 3) % 25).alias("away_team_api_id"),
                    home_goal.alias("home_team_goal"), ((ok * 3 + ck) % 4).alias("away_team_goal")))
    lines = m_lines(lineitem)
    return base.join(lines, base["id"] == lines["lk"], "left")


def m_dates(orders: DataFrame) -> DataFrame:
    ok = F.col("o_orderkey")
    date = (F.when(ok % 50 == 0, F.lit("bad")).when(ok % 41 == 0, F.lit(None).cast("string"))
            .otherwise(F.col("o_orderdate").cast("string")))
    return orders.select(ok.alias("id"), date.alias("date"), F.col("o_totalprice").alias("rating"))


def m_dups(lineitem: DataFrame) -> DataFrame:
    return lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
                           "l_linenumber", "l_returnflag",
                           F.nullif(F.col("l_linestatus"), F.lit("F")).alias("l_linestatus"),
                           (F.col("l_partkey") % 40).alias("grp"))


def m_nulls(lineitem: DataFrame) -> DataFrame:
    return lineitem.select("l_orderkey", "l_linenumber",
                           F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount"),
                           F.nullif(F.col("l_tax"), F.lit(0.0)).alias("l_tax"),
                           F.nullif(F.col("l_returnflag"), F.lit("N")).alias("l_returnflag"),
                           "l_quantity")


def m_part(part: DataFrame) -> DataFrame:
    pk = F.col("p_partkey")
    return part.select(
        (pk % 500).alias("team_api_id"),
        F.when(pk % 10 == 0, F.concat(F.lit(" "), F.col("p_name"))).otherwise(F.col("p_name"))
        .alias("team_long_name"),
        F.when(pk % 7 == 0, F.upper("p_brand")).otherwise(F.col("p_brand")).alias("team_short_name"),
        F.when(pk % 3 == 0, F.lit(None).cast("int")).otherwise(F.col("p_size")).alias("team_fifa_api_id"))


def m_team(nation: DataFrame) -> DataFrame:
    """Teams 0..24 (the ids the stand-in matches use); long name missing in one region."""
    return nation.select(F.col("n_nationkey").alias("team_api_id"),
                         F.when(F.col("n_regionkey") == 1, F.lit(None).cast("string"))
                         .otherwise(F.col("n_name")).alias("team_long_name"),
                         F.upper(F.substring("n_name", 1, 3)).alias("team_short_name"))


def m_league(region: DataFrame) -> DataFrame:
    return region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"),
                         F.col("r_regionkey").alias("country_id"))


def m_player(part: DataFrame) -> DataFrame:
    """Players from id 1 on, so the 'unknown' player 0 is not among them."""
    return part.select((F.col("p_partkey") + 1).alias("player_api_id"), F.col("p_name").alias("player_name"))


def m_labels(labels: DataFrame) -> DataFrame:
    """Labels of which some name a document that does not exist."""
    i = F.col("doc_id")
    return labels.withColumn("doc_id", F.when(i % 9 == 4, i + 1_000_000_000_000).otherwise(i))


def m_player_birthdays(orders: DataFrame) -> DataFrame:
    """Players with a text birthday (some malformed or missing), from ``m_dates``."""
    d = m_dates(orders)
    return d.select(F.col("id").alias("player_api_id"), F.col("date").alias("birthday"), "rating")


def m_order_lines(lineitem: DataFrame) -> DataFrame:
    """Order-level summary of the lines (numeric, with real correlations)."""
    return lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("total_quantity"),
        F.sum("l_extendedprice").alias("total_price"), F.avg("l_discount").alias("avg_discount"))

"""Scans, sinks, projection, filters, sorting, stacking."""

import uuid

from pyspark.sql import functions as F

from touchline.catalog.base import appearances, clubs, competitions, games, players, query, rounded, table
from touchline.operators.profile import explicit_order
from touchline.operators.relational import (
    columns_of_kind,
    count_above,
    fold_roles,
    not_below,
    outcome,
    project_renamed,
    rows_missing,
    sample_fraction,
    stable_draw,
    stack_roles,
    suffixed,
    with_constants,
    with_row_order,
)
from touchline.operators.stats import global_statistic, group_percentiles
from touchline.session import checkpoint_dir, stage
from touchline.sources import infer_csv, load_table, write_csv, write_parquet


@query(
    "scan_project_filter",
    """
SELECT o_orderkey AS game_id, o_custkey AS home_id, year(o_orderdate)::INTEGER AS season FROM orders
WHERE o_orderstatus = 'F'
""",
    linked_tables=False,
)
def scan_project_filter(spark, sf):
    df = load_table(spark, sf, "orders").where("o_orderstatus = 'F'").withColumn("season", F.year("o_orderdate"))
    return project_renamed(df, {"o_orderkey": "game_id", "o_custkey": "home_id", "season": "season"})


@query("csv_round_trip", "SELECT club_id, average_age, stadium_name, stadium_seats, net_transfer_record FROM clubs")
def csv_round_trip(spark, sf):
    path = f"{checkpoint_dir(spark)}/clubs-{uuid.uuid4().hex}.csv"
    write_csv(clubs(spark, sf), path)
    back = infer_csv(spark, path).withColumn("club_id", F.col("club_id").cast("bigint"))
    return back.select("club_id", "average_age", "stadium_name", "stadium_seats", "net_transfer_record")


@query("csv_declared_schema", "SELECT competition_id, name, type, country_name FROM competitions")
def csv_declared_schema(spark, sf):
    root = f"{checkpoint_dir(spark)}/inputs-{uuid.uuid4().hex}"
    write_csv(competitions(spark, sf), f"{root}/competitions.csv")
    return load_table(spark, root, "competitions", "csv")


@query(
    "csv_of_floats",
    "SELECT game_id, season::BIGINT AS season, attendance, home_club_position::BIGINT AS home_club_position, home_club_goals::BIGINT AS home_club_goals, home_club_formation FROM games",
)
def csv_of_floats(spark, sf):
    """Games read back from a CSV whose whole numbers are written as `52000.0` and whose gaps are empty, as data frames write them."""
    root = f"{checkpoint_dir(spark)}/inputs-{uuid.uuid4().hex}"
    numbers = ["season", "attendance", "home_club_position", "home_club_goals"]
    g = games(spark, sf).select("game_id", *[F.col(c).cast("double").alias(c) for c in numbers], "home_club_formation")
    write_csv(g, f"{root}/games.csv")
    back = load_table(spark, root, "games", "csv")
    return back.select("game_id", *[F.col(c).cast("bigint").alias(c) for c in numbers], "home_club_formation")


@query("parquet_partitioned", "SELECT season, count(*) AS n FROM games GROUP BY season")
def parquet_partitioned(spark, sf):
    path = f"{checkpoint_dir(spark)}/games-{uuid.uuid4().hex}"
    write_parquet(games(spark, sf).select("game_id", "season"), path, ("season",))
    return spark.read.parquet(path).groupBy("season").agg(F.count("*").alias("n"))


@query("stage_checkpoint", "SELECT competition_id, count(*) AS n FROM games GROUP BY competition_id")
def stage_checkpoint(spark, sf):
    kept = stage(games(spark, sf).select("game_id", "season", "competition_id"), "games")
    return kept.groupBy("competition_id").agg(F.count("*").alias("n"))


@query(
    "suffix_and_constants",
    """
SELECT club_id AS club_id_home, stadium_seats AS stadium_seats_home, 0 AS red_cards, 0 AS yellow_cards FROM clubs
""",
)
def suffix_and_constants(spark, sf):
    side = suffixed(clubs(spark, sf).select("club_id", "stadium_seats"), "_home")
    return with_constants(side, ["red_cards", "yellow_cards"])


@query(
    "numeric_columns_without_id",
    """
SELECT season, home_club_goals, away_club_goals, home_club_position, away_club_position, attendance FROM games
""",
)
def numeric_columns_without_id(spark, sf):
    g = games(spark, sf)
    return g.select(*columns_of_kind(g, "number", without="id"))


@query("drop_columns", "SELECT * EXCLUDE (stadium, home_club_name) FROM games")
def drop_columns(spark, sf):
    return games(spark, sf).drop("stadium", "home_club_name")


@query(
    "outcome_label",
    """
SELECT game_id, CASE WHEN home_club_goals > away_club_goals THEN 'home'
                     WHEN home_club_goals < away_club_goals THEN 'away' ELSE 'draw' END AS outcome FROM games
""",
)
def outcome_label(spark, sf):
    return games(spark, sf).select("game_id", outcome(F.col("home_club_goals"), F.col("away_club_goals")).alias("outcome"))


@query("select_expr", "SELECT game_id, home_club_goals AS label, home_club_goals + away_club_goals AS goals FROM games")
def select_expr(spark, sf):
    return games(spark, sf).selectExpr("game_id", "home_club_goals as label", "home_club_goals + away_club_goals as goals")


@query("row_order", "SELECT p_partkey, p_size FROM part ORDER BY p_partkey", linked_tables=False)
def row_order(spark, sf):
    marked = with_row_order(table(spark, sf, "part").select("p_partkey", "p_size"))
    return marked.orderBy("original_order").drop("original_order")


@query("complete_cases", "SELECT game_id, attendance, stadium, home_club_formation FROM games WHERE attendance IS NOT NULL "
       "AND stadium IS NOT NULL AND home_club_formation IS NOT NULL")
def complete_cases(spark, sf):
    return games(spark, sf).select("game_id", "attendance", "stadium", "home_club_formation").na.drop("any")


@query("drop_null_subset", "SELECT game_id, home_club_position, away_club_position, attendance FROM games "
       "WHERE home_club_position IS NOT NULL AND away_club_position IS NOT NULL")
def drop_null_subset(spark, sf):
    g = games(spark, sf).select("game_id", "home_club_position", "away_club_position", "attendance")
    return g.na.drop(subset=["home_club_position", "away_club_position"])


@query("null_rows", "SELECT game_id, season FROM games WHERE attendance IS NULL AND stadium IS NULL")
def null_rows(spark, sf):
    return rows_missing(games(spark, sf), "attendance", "stadium").select("game_id", "season")


@query("outlier_filter", "SELECT player_id, height_in_cm FROM players WHERE height_in_cm >= 25 OR height_in_cm IS NULL")
def outlier_filter(spark, sf):
    return not_below(players(spark, sf), "height_in_cm", 25).select("player_id", "height_in_cm")


@query(
    "threshold_counts",
    """
SELECT count(*) FILTER (attendance > 40000) AS crowds, count(*) FILTER (home_club_goals > 2) AS scorers,
       count(*) FILTER (attendance > (SELECT quantile_cont(attendance, 0.75) FROM games)) AS above_q3 FROM games
""",
)
def threshold_counts(spark, sf):
    g = games(spark, sf)
    q3 = group_percentiles(g, [], "attendance", {"q3": 0.75}).scalar()
    flagged = g.withColumn("over", F.col("attendance") - q3)
    return count_above(flagged, {"crowds": ("attendance", 40000), "scorers": ("home_club_goals", 2), "above_q3": ("over", 0)})


@query("dedupe", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem", linked_tables=False)
def dedupe(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").dropDuplicates()


@query(
    "stable_sample",
    """
SELECT o_orderkey FROM orders
WHERE ('0x' || substr(md5(o_orderkey || ':42'), 1, 8))::BIGINT / 4294967296.0::DOUBLE < 0.1
""",
    linked_tables=False,
)
def stable_sample(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey").where(stable_draw(42, F.col("o_orderkey")) < 0.1)


@query("random_sample")
def random_sample(spark, sf):
    return sample_fraction(games(spark, sf), 0.1, 42)


@query("distinct_values", "SELECT DISTINCT sub_position, foot FROM players")
def distinct_values(spark, sf):
    return players(spark, sf).select("sub_position", "foot").distinct()


@query(
    "top_games",
    "SELECT game_id, attendance FROM games WHERE attendance IS NOT NULL ORDER BY attendance DESC, game_id LIMIT 10",
)
def top_games(spark, sf):
    g = games(spark, sf).where("attendance is not null").select("game_id", "attendance")
    return g.orderBy(F.desc("attendance"), "game_id").limit(10)


@query(
    "explicit_order",
    """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 END::BIGINT AS rank
FROM orders
""",
    linked_tables=False,
)
def explicit_rank(spark, sf):
    rank = explicit_order("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])
    return table(spark, sf, "orders").select("o_orderkey", rank.cast("bigint").alias("rank"))


ROLES = {
    "home": {"club_id": "home_club_id", "formation": "home_club_formation",
             "goals_scored": "home_club_goals", "goals_conceded": "away_club_goals"},
    "away": {"club_id": "away_club_id", "formation": "away_club_formation",
             "goals_scored": "away_club_goals", "goals_conceded": "home_club_goals"},
}
STACK_SQL = """
SELECT game_id, 'home' AS team_type, home_club_id AS club_id, home_club_formation AS formation,
       home_club_goals AS goals_scored, away_club_goals AS goals_conceded FROM games
UNION ALL
SELECT game_id, 'away', away_club_id, away_club_formation, away_club_goals, home_club_goals FROM games
"""


@query("stack_roles", STACK_SQL)
def stacked(spark, sf):
    return stack_roles(games(spark, sf), "game_id", ROLES, "team_type")


@query(
    "fold_roles",
    "SELECT game_id, home_club_id, home_club_formation AS home_formation, away_club_id, away_club_formation AS away_formation FROM games",
)
def folded(spark, sf):
    long = stack_roles(games(spark, sf), "game_id", ROLES, "team_type")
    return fold_roles(long, "game_id", "team_type", ["home", "away"], ["club_id", "formation"])


@query(
    "union_columns",
    """
SELECT formation, count(*) AS n FROM (SELECT home_club_formation AS formation FROM games UNION ALL
SELECT away_club_formation FROM games) GROUP BY formation
""",
)
def union_columns(spark, sf):
    both = games(spark, sf).select(F.explode(F.array("home_club_formation", "away_club_formation")).alias("formation"))
    return both.groupBy("formation").agg(F.count("*").alias("n"))


@query(
    "global_stats",
    """
SELECT round(avg(height_in_cm), 6) AS mean, round(median(height_in_cm), 6) AS median, min(height_in_cm) AS min,
       max(height_in_cm) AS max, round(stddev_samp(height_in_cm), 6) AS stddev,
       (SELECT height_in_cm FROM players WHERE height_in_cm IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS mode
FROM players
""",
)
def global_stats(spark, sf):
    p = players(spark, sf)
    one = p.agg(
        F.avg("height_in_cm").alias("mean"), F.min("height_in_cm").alias("min"), F.max("height_in_cm").alias("max"),
        F.stddev_samp("height_in_cm").alias("stddev"),
    )
    for method in ("median", "mode"):
        one = one.withColumn(method, global_statistic(p, "height_in_cm", method).scalar())
    return rounded(one, "mean", "median", "stddev")


@query("assists_by_game", "SELECT game_id, sum(assists)::BIGINT AS assists FROM appearances GROUP BY game_id")
def assists_by_game(spark, sf):
    return appearances(spark, sf).groupBy("game_id").agg(F.sum("assists").alias("assists"))

"""Grouped aggregates and window-shaped statistics."""

from pyspark.sql import functions as F

from touchline.catalog.base import appearances, game_events, games, players, query, rounded
from touchline.functions import parse_date, rule_strategy
from touchline.operators.aggregates import first_known, mean_by, text_counts, totals
from touchline.operators.impute import backward_fill, forward_fill
from touchline.operators.profile import agreement
from touchline.operators.stats import min_max_scaled, with_group_statistic
from touchline.functions.formation import strategy_table


@query(
    "card_counts",
    """
SELECT game_id, club_id, count(*) FILTER (lower(description) LIKE '%red card%') AS red,
       count(*) FILTER (lower(description) LIKE '%yellow card%') AS yellow
FROM game_events GROUP BY game_id, club_id
""",
)
def card_counts(spark, sf):
    return text_counts(game_events(spark, sf), ["game_id", "club_id"], "description", {"red": "red card", "yellow": "yellow card"})


@query(
    "game_totals",
    "SELECT game_id, sum(assists)::BIGINT AS total_assists, sum(goals)::BIGINT AS total_goals FROM appearances GROUP BY game_id",
)
def game_totals(spark, sf):
    return totals(appearances(spark, sf), "game_id", {"total_assists": "assists", "total_goals": "goals"})


@query(
    "club_means",
    """
SELECT current_club_id, round(avg(height_in_cm), 6) AS mean_height_in_cm,
       round(avg(market_value_in_eur), 6) AS mean_market_value_in_eur
FROM players GROUP BY current_club_id
""",
)
def club_means(spark, sf):
    m = mean_by(players(spark, sf), "current_club_id", ["height_in_cm", "market_value_in_eur"])
    return rounded(m, "mean_height_in_cm", "mean_market_value_in_eur")


@query(
    "team_season",
    """
SELECT a.player_club_id AS club_id, g.season, round(avg(g.season - year(p.born)), 6) AS average_age,
       round(avg(p.height_in_cm), 6) AS average_height_in_cm, round(avg(p.market_value_in_eur), 6) AS average_market_value_in_eur
FROM games g JOIN appearances a ON g.game_id = a.game_id LEFT JOIN players p ON a.player_id = p.player_id
GROUP BY a.player_club_id, g.season
""",
)
def team_season(spark, sf):
    p = players(spark, sf).select("player_id", parse_date(F.col("date_of_birth")).alias("born"), "height_in_cm", "market_value_in_eur")
    rows = games(spark, sf).select("game_id", "season").join(appearances(spark, sf), "game_id").join(p, "player_id", "left")
    rows = rows.withColumn("age", F.col("season") - F.year("born"))
    out = rows.groupBy(F.col("player_club_id").alias("club_id"), "season").agg(
        F.avg("age").alias("average_age"), F.avg("height_in_cm").alias("average_height_in_cm"),
        F.avg("market_value_in_eur").alias("average_market_value_in_eur"),
    )
    return rounded(out, "average_age", "average_height_in_cm", "average_market_value_in_eur")


@query(
    "first_known",
    """
WITH e AS (SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY minute, number, club_id, player_id, description) AS rn,
  row_number() OVER (PARTITION BY game_id, description IS NULL ORDER BY minute, number, club_id, player_id, description) AS rd FROM game_events)
SELECT game_id, max(minute) FILTER (rn = 1) AS minute, max(description) FILTER (description IS NOT NULL AND rd = 1) AS description
FROM e GROUP BY game_id
""",
)
def first_event(spark, sf):
    return first_known(game_events(spark, sf), ["game_id"], ["minute", "number", "club_id", "player_id"], ["minute", "description"])


@query(
    "last_known",
    """
WITH e AS (SELECT *, row_number() OVER (PARTITION BY home_club_id, attendance IS NULL ORDER BY date DESC, game_id DESC) AS rn
           FROM games WHERE home_club_id IS NOT NULL)
SELECT home_club_id, max(attendance) FILTER (attendance IS NOT NULL AND rn = 1) AS attendance FROM e GROUP BY home_club_id
""",
)
def last_attendance(spark, sf):
    return first_known(games(spark, sf), ["home_club_id"], ["date", "game_id"], ["attendance"], last=True)


def _case(side: str, col: str) -> str:
    whens = " ".join(f"WHEN '{f}' THEN '{s}'" for f, s in strategy_table(side).items())
    return f"CASE {col} {whens} ELSE 'Unknown' END"


@query("rule_strategy", f"SELECT game_id, {_case('home', 'home_club_formation')} AS home_strategy, "
       f"{_case('away', 'away_club_formation')} AS away_strategy FROM games")
def strategies(spark, sf):
    return games(spark, sf).select(
        "game_id", rule_strategy(F.col("home_club_formation"), "home").alias("home_strategy"),
        rule_strategy(F.col("away_club_formation"), "away").alias("away_strategy"),
    )


@query(
    "mean_by_strategy",
    f"""
SELECT strategy, round(avg(home_club_goals), 6) AS mean_home_club_goals, round(avg(away_club_goals), 6) AS mean_away_club_goals
FROM (SELECT *, {_case('home', 'home_club_formation')} AS strategy FROM games) GROUP BY strategy
""",
)
def mean_by_strategy(spark, sf):
    g = games(spark, sf).withColumn("strategy", rule_strategy(F.col("home_club_formation"), "home"))
    return rounded(mean_by(g, "strategy", ["home_club_goals", "away_club_goals"]), "mean_home_club_goals", "mean_away_club_goals")


@query(
    "label_agreement",
    f"""
WITH s AS (SELECT {_case('home', 'home_club_formation')} AS home_strategy, {_case('away', 'away_club_formation')} AS away_strategy FROM games)
SELECT home_strategy, away_strategy, count(*) AS n, home_strategy = away_strategy AS same FROM s GROUP BY ALL
""",
)
def label_agreement(spark, sf):
    return agreement(strategies(spark, sf), "home_strategy", "away_strategy")


@query(
    "group_mean_attached",
    """
SELECT game_id, attendance, CASE WHEN home_club_id IS NOT NULL THEN
  round(avg(attendance) OVER (PARTITION BY competition_id, home_club_id), 6) END AS mean_attendance FROM games
""",
)
def group_mean_attached(spark, sf):
    g = games(spark, sf).select("game_id", "competition_id", "home_club_id", "attendance")
    out = with_group_statistic(g, ["competition_id", "home_club_id"], {"mean_attendance": "attendance"}, "mean")
    return rounded(out, "mean_attendance").select("game_id", "attendance", "mean_attendance")


@query(
    "group_median_attached",
    """
SELECT game_id, season, competition_id, round(median(home_club_position) OVER (PARTITION BY season, competition_id), 6) AS median_position
FROM games
""",
)
def group_median_attached(spark, sf):
    g = games(spark, sf).select("game_id", "season", "competition_id", "home_club_position")
    out = with_group_statistic(g, ["season", "competition_id"], {"median_position": "home_club_position"}, "median")
    return rounded(out.drop("home_club_position"), "median_position")


@query(
    "group_mode_attached",
    """
WITH c AS (SELECT home_club_id, home_club_formation, count(*) AS n FROM games
           WHERE home_club_id IS NOT NULL AND home_club_formation IS NOT NULL GROUP BY ALL),
m AS (SELECT home_club_id, home_club_formation AS usual FROM c
      QUALIFY row_number() OVER (PARTITION BY home_club_id ORDER BY n DESC, home_club_formation) = 1)
SELECT g.game_id, g.home_club_id, m.usual FROM games g LEFT JOIN m ON g.home_club_id = m.home_club_id
""",
)
def group_mode_attached(spark, sf):
    g = games(spark, sf).select("game_id", "home_club_id", "home_club_formation")
    out = with_group_statistic(g, ["home_club_id"], {"usual": "home_club_formation"}, "mode")
    return out.drop("home_club_formation")


ORDER_WINDOW = "PARTITION BY home_club_id ORDER BY season, game_id"


@query(
    "forward_fill",
    f"""
SELECT game_id, home_club_id, season, CASE WHEN home_club_id IS NULL THEN attendance
  ELSE last_value(attendance IGNORE NULLS) OVER ({ORDER_WINDOW} ROWS UNBOUNDED PRECEDING) END AS attendance FROM games
""",
)
def ffill(spark, sf):
    g = games(spark, sf).select("game_id", "home_club_id", "season", "attendance")
    return forward_fill(g, ["home_club_id"], ["season", "game_id"], ["attendance"])


@query(
    "backward_fill",
    f"""
SELECT game_id, home_club_id, season, CASE WHEN home_club_id IS NULL THEN attendance
  ELSE first_value(attendance IGNORE NULLS) OVER ({ORDER_WINDOW} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) END AS attendance
FROM games
""",
)
def bfill(spark, sf):
    g = games(spark, sf).select("game_id", "home_club_id", "season", "attendance")
    return backward_fill(g, ["home_club_id"], ["season", "game_id"], ["attendance"])


@query(
    "min_max_in_group",
    """
SELECT game_id, season, round((attendance - min(attendance) OVER w)::DOUBLE / nullif(max(attendance) OVER w - min(attendance) OVER w, 0), 6) AS scaled
FROM games WINDOW w AS (PARTITION BY season)
""",
)
def min_max(spark, sf):
    g = games(spark, sf).select("game_id", "season", "attendance")
    return rounded(min_max_scaled(g, ["season"], "attendance", "scaled"), "scaled").drop("attendance")

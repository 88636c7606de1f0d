"""Semi-join cascade, role joins, as-of joins."""

from pyspark.sql import functions as F

from touchline.catalog.base import appearances, clubs, game_lineups, games, linked, player_valuations, players, query, rounded
from touchline.functions import calendar_features, lookup, parse_date
from touchline.operators.aggregates import lineup_profile
from touchline.operators.asof import asof_backward, latest_prior_in_bucket
from touchline.operators.relational import keep_known_either, semi_cascade, side_join

CASCADE_SQL = """
WITH g AS (SELECT * FROM games WHERE competition_type = 'domestic_league'),
a AS (SELECT * FROM appearances WHERE game_id IN (SELECT game_id FROM g))
"""


@query(
    "semi_cascade",
    CASCADE_SQL
    + """
SELECT 'games' AS name, count(*) AS n FROM g WHERE game_id IN (SELECT game_id FROM a)
UNION ALL SELECT 'appearances', count(*) FROM a
UNION ALL SELECT 'competitions', count(*) FROM competitions WHERE competition_id IN (SELECT competition_id FROM g)
UNION ALL SELECT 'game_events', count(*) FROM game_events WHERE game_id IN (SELECT game_id FROM g)
UNION ALL SELECT 'clubs', count(*) FROM clubs
          WHERE club_id IN (SELECT home_club_id FROM g) OR club_id IN (SELECT away_club_id FROM g)
UNION ALL SELECT 'players', count(*) FROM players WHERE player_id IN (SELECT player_id FROM a)
UNION ALL SELECT 'player_valuations', count(*) FROM player_valuations WHERE player_id IN (SELECT player_id FROM a)
""",
)
def semi_cascade_counts(spark, sf):
    t = linked(spark, sf)
    del t["game_lineups"]
    out = None
    for name, df in semi_cascade(t).items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "or_semi",
    """
SELECT club_id, name FROM clubs WHERE club_id IN (SELECT home_club_id FROM games WHERE competition_type = 'domestic_league')
   OR club_id IN (SELECT away_club_id FROM games WHERE competition_type = 'domestic_league')
""",
)
def or_semi(spark, sf):
    g = games(spark, sf).where("competition_type = 'domestic_league'")
    return keep_known_either(clubs(spark, sf), "club_id", g, ["home_club_id", "away_club_id"]).select("club_id", "name")


@query(
    "left_join_players",
    """
SELECT a.game_id, a.player_id, a.date, p.height_in_cm, count(*) AS n
FROM appearances a LEFT JOIN players p ON a.player_id = p.player_id
GROUP BY ALL
""",
)
def left_join_players(spark, sf):
    heights = players(spark, sf).select("player_id", "height_in_cm")
    joined = appearances(spark, sf).join(heights, "player_id", "left")
    return joined.groupBy("game_id", "player_id", "date", "height_in_cm").agg(F.count("*").alias("n"))


@query(
    "side_join",
    """
SELECT g.game_id, g.home_club_id, g.away_club_id, h.stadium_seats AS stadium_seats_home,
       h.name AS name_home, a.stadium_seats AS stadium_seats_away, a.name AS name_away
FROM games g LEFT JOIN clubs h ON g.home_club_id = h.club_id LEFT JOIN clubs a ON g.away_club_id = a.club_id
""",
)
def side_join_clubs(spark, sf):
    g = games(spark, sf).select("game_id", "home_club_id", "away_club_id")
    c = clubs(spark, sf).select("club_id", "stadium_seats", "name")
    return side_join(g, c, ["club_id"], {"home": {"club_id": "home_club_id"}, "away": {"club_id": "away_club_id"}})


@query(
    "composite_left",
    """
WITH per AS (SELECT game_id, player_club_id AS club_id, sum(assists)::BIGINT AS assists FROM appearances GROUP BY ALL)
SELECT g.game_id, h.assists AS assists_home, a.assists AS assists_away
FROM games g LEFT JOIN per h ON g.game_id = h.game_id AND g.home_club_id = h.club_id
LEFT JOIN per a ON g.game_id = a.game_id AND g.away_club_id = a.club_id
""",
)
def composite_left(spark, sf):
    per = appearances(spark, sf).groupBy("game_id", F.col("player_club_id").alias("club_id")).agg(F.sum("assists").alias("assists"))
    g = games(spark, sf).select("game_id", "home_club_id", "away_club_id")
    out = side_join(g, per, ["game_id", "club_id"], {"home": {"club_id": "home_club_id"}, "away": {"club_id": "away_club_id"}})
    return out.select("game_id", "assists_home", "assists_away")


@query(
    "asof_backward",
    """
WITH v AS (SELECT player_id, date, market_value_in_eur FROM player_valuations
           QUALIFY row_number() OVER (PARTITION BY player_id, date ORDER BY valuation_id DESC) = 1)
SELECT a.game_id, a.player_id, a.date, a.player_club_id, v.market_value_in_eur
FROM appearances a ASOF LEFT JOIN v ON a.player_id = v.player_id AND a.date >= v.date
""",
)
def asof(spark, sf):
    left = appearances(spark, sf).select("game_id", "player_id", "date", "player_club_id")
    return asof_backward(left, player_valuations(spark, sf), ["player_id"], "date", ["market_value_in_eur"], ["valuation_id"])


@query(
    "asof_event_stream",
    """
WITH v AS (SELECT user_id, ts, value AS last_value FROM events WHERE event_type = 'view'),
p AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase')
SELECT p.event_id, p.user_id, p.ts, p.value, v.last_value
FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.ts
""",
    linked_tables=False,
)
def asof_event_stream(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    left = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
    right = e.where("event_type = 'view'").select("user_id", "ts", F.col("value").alias("last_value"), "event_id")
    return asof_backward(left, right, ["user_id"], "ts", ["last_value"], ["event_id"])


@query(
    "latest_prior_bucket",
    """
WITH probes AS (SELECT DISTINCT player_id, year(date)::INTEGER AS season, date FROM appearances),
pairs AS (
  SELECT p.player_id, p.season, p.date, v.market_value_in_eur,
         row_number() OVER (PARTITION BY p.player_id, p.date ORDER BY v.date DESC, v.market_value_in_eur DESC) AS rn
  FROM probes p JOIN player_valuations v
    ON p.player_id = v.player_id AND p.season = year(v.date) AND v.date <= p.date
  WHERE v.market_value_in_eur IS NOT NULL)
SELECT player_id, season, date, market_value_in_eur FROM pairs WHERE rn = 1
""",
)
def latest_prior(spark, sf):
    left = appearances(spark, sf).select("player_id", F.year("date").alias("season"), "date")
    right = player_valuations(spark, sf).withColumn("season", F.year("date")).withColumnRenamed("date", "valued_on")
    return latest_prior_in_bucket(left, right, ["player_id"], "season", "date", "valued_on", "market_value_in_eur")


@query(
    "games_lineups",
    """
SELECT g.season, l.club_id, count(*) AS players, count(DISTINCT l.player_id) AS distinct_players
FROM games g JOIN game_lineups l ON g.game_id = l.game_id GROUP BY g.season, l.club_id
""",
)
def games_lineups(spark, sf):
    joined = games(spark, sf).select("game_id", "season").join(game_lineups(spark, sf), "game_id")
    return joined.groupBy("season", "club_id").agg(
        F.count("*").alias("players"), F.count_distinct("player_id").alias("distinct_players")
    )


CALENDAR_SQL = """
WITH ends AS (SELECT min(date) AS lo, max(date) AS hi FROM games),
days AS (SELECT unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 DAY))::DATE AS date FROM ends),
wk AS (SELECT date, year(date)::INTEGER AS year, week(date)::INTEGER AS week FROM days),
norm AS (SELECT *, (week - min(week) OVER (PARTITION BY year))::DOUBLE
            / nullif(max(week) OVER (PARTITION BY year) - min(week) OVER (PARTITION BY year), 0) AS week_normalized FROM wk)
"""


@query(
    "calendar_cyclic",
    CALENDAR_SQL
    + """
SELECT date, year, week, round(week_normalized, 6) + 0.0 AS week_normalized,
       round(sin(week_normalized * 2 * pi()), 6) + 0.0 AS week_sin,
       round(cos(week_normalized * 2 * pi()), 6) + 0.0 AS week_cos
FROM norm
""",
)
def calendar_cyclic(spark, sf):
    return rounded(calendar_features(games(spark, sf), "date"), "week_normalized", "week_sin", "week_cos")


@query(
    "calendar_join",
    CALENDAR_SQL
    + """
SELECT g.game_id, g.date, round(sin(week_normalized * 2 * pi()), 6) + 0.0 AS week_sin,
       round(cos(week_normalized * 2 * pi()), 6) + 0.0 AS week_cos
FROM games g LEFT JOIN norm ON g.date = norm.date
""",
)
def calendar_join(spark, sf):
    g = games(spark, sf).select("game_id", "date")
    cal = calendar_features(g, "date").select("date", "week_sin", "week_cos")
    return rounded(g.join(cal, "date", "left"), "week_sin", "week_cos").select("game_id", "date", "week_sin", "week_cos")


@query(
    "map_lookup",
    """
SELECT player_id, CASE foot WHEN 'right' THEN 'R' WHEN 'left' THEN 'L' ELSE 'Unknown' END AS foot_code FROM players
""",
)
def map_lookup(spark, sf):
    return players(spark, sf).select("player_id", lookup(F.col("foot"), {"right": "R", "left": "L"}, "Unknown").alias("foot_code"))


@query(
    "yearly_mean_value",
    """
WITH y AS (SELECT player_id, year(date)::INTEGER AS val_year, avg(market_value_in_eur) AS v FROM player_valuations GROUP BY ALL)
SELECT a.game_id, a.player_id, a.date, round(y.v, 6) + 0.0 AS mean_value
FROM appearances a LEFT JOIN y ON a.player_id = y.player_id AND year(a.date) = y.val_year
""",
)
def yearly_mean_value(spark, sf):
    yearly = player_valuations(spark, sf).groupBy("player_id", F.year("date").alias("val_year")).agg(F.avg("market_value_in_eur").alias("mean_value"))
    apps = appearances(spark, sf).withColumn("val_year", F.year("date"))
    joined = apps.join(yearly, ["player_id", "val_year"], "left")
    return rounded(joined.select("game_id", "player_id", "date", "mean_value"), "mean_value")


@query(
    "lineup_profile",
    """
SELECT a.game_id, a.player_club_id AS club_id, round(avg(date_diff('day', p.born, a.date) // 365), 6) + 0.0 AS age,
       round(avg(p.height_in_cm), 6) + 0.0 AS height_in_cm, round(avg(p.market_value_in_eur), 6) + 0.0 AS market_value_in_eur,
       coalesce(sum(a.assists), 0)::BIGINT AS assists
FROM appearances a LEFT JOIN players p ON a.player_id = p.player_id GROUP BY a.game_id, a.player_club_id
""",
)
def lineup(spark, sf):
    from touchline.functions import age_at

    p = players(spark, sf).select("player_id", parse_date(F.col("date_of_birth")).alias("born"), "height_in_cm", "market_value_in_eur")
    apps = appearances(spark, sf).withColumnRenamed("player_club_id", "club_id").join(p, "player_id", "left")
    apps = apps.withColumn("age", age_at(F.col("date"), F.col("born")))
    return rounded(lineup_profile(apps, ["game_id", "club_id"]), "age", "height_in_cm", "market_value_in_eur")

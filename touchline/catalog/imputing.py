"""Imputation queries."""

from pyspark.ml.feature import Imputer
from pyspark.sql import functions as F

from touchline.catalog.base import clubs, competitions, games, players, query, rounded
from touchline.operators.impute import (
    fill_by_key,
    fill_by_type,
    fill_draw_from,
    fill_mean_truncated,
    fill_one_draw,
    fill_where,
    impute,
    impute_mode_then_global,
    override_where,
)
from touchline.operators.knn import knn_impute

G = "SELECT game_id, competition_id, season, home_club_id, attendance, home_club_position, home_club_formation FROM games"


def _games(spark, sf):
    return games(spark, sf).select("game_id", "competition_id", "season", "home_club_id", "attendance", "home_club_position", "home_club_formation")


@query("impute_constant", "SELECT game_id, coalesce(attendance, 0) AS attendance, coalesce(home_club_formation, 'Unknown') AS home_club_formation FROM games")
def constant(spark, sf):
    df = impute(games(spark, sf), ["attendance"], "constant", value=0)
    return impute(df, ["home_club_formation"], "constant", value="Unknown").select("game_id", "attendance", "home_club_formation")


@query(
    "impute_conditional",
    """
SELECT game_id, CASE WHEN country_name = 'ASIA' AND season >= 2000 THEN 0
                     WHEN season = 1998 AND attendance IS NULL THEN 0 ELSE attendance END AS attendance
FROM games LEFT JOIN competitions ON games.competition_id = competitions.competition_id
""",
)
def conditional(spark, sf):
    g = games(spark, sf).join(competitions(spark, sf).select("competition_id", "country_name"), "competition_id", "left")
    g = fill_where(g, "attendance", F.col("season") == 1998, 0)
    g = override_where(g, "attendance", (F.col("country_name") == "ASIA") & (F.col("season") >= 2000), 0)
    return g.select("game_id", "attendance")


@query(
    "impute_by_key",
    """
SELECT game_id, coalesce(stadium, CASE home_club_name WHEN 'Club 0' THEN 'North End' WHEN 'Club 1' THEN 'Riverside' END) AS stadium FROM games
""",
)
def by_key(spark, sf):
    g = fill_by_key(games(spark, sf), "stadium", "home_club_name", {"Club 0": "North End", "Club 1": "Riverside"})
    return g.select("game_id", "stadium")


@query(
    "impute_mean_fill",
    """
SELECT game_id, round(coalesce(attendance, CASE WHEN home_club_id IS NOT NULL THEN avg(attendance) OVER (PARTITION BY competition_id, home_club_id) END), 6) AS attendance
FROM games
""",
)
def mean_fill(spark, sf):
    df = impute(_games(spark, sf), ["attendance"], "mean", ["competition_id", "home_club_id"])
    return rounded(df, "attendance").select("game_id", "attendance")


@query(
    "impute_mean_replace",
    """
SELECT game_id, round(coalesce(CASE WHEN home_club_id IS NOT NULL THEN avg(attendance) OVER (PARTITION BY competition_id, home_club_id) END, attendance), 6) AS attendance
FROM games
""",
)
def mean_replace(spark, sf):
    df = impute(_games(spark, sf), ["attendance"], "mean", ["competition_id", "home_club_id"], mode="replace")
    return rounded(df, "attendance").select("game_id", "attendance")


@query(
    "impute_median_fill",
    """
SELECT game_id, round(coalesce(home_club_position, median(home_club_position) OVER (PARTITION BY season, competition_id)), 6) AS home_club_position FROM games
""",
)
def median_fill(spark, sf):
    df = impute(_games(spark, sf), ["home_club_position"], "median", ["season", "competition_id"])
    return rounded(df, "home_club_position").select("game_id", "home_club_position")


@query(
    "impute_median_replace",
    """
SELECT player_id, round(coalesce(median(height_in_cm) OVER (PARTITION BY current_club_id), height_in_cm), 6) AS height_in_cm FROM players
""",
)
def median_replace(spark, sf):
    df = impute(players(spark, sf), ["height_in_cm"], "median", ["current_club_id"], mode="replace")
    return rounded(df, "height_in_cm").select("player_id", "height_in_cm")


MODE_SQL = """
WITH c AS (SELECT season, home_club_id, home_club_formation, count(*) AS n FROM games
           WHERE home_club_formation IS NOT NULL AND home_club_id IS NOT NULL GROUP BY ALL),
m AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY season, home_club_id ORDER BY n DESC, home_club_formation) = 1),
f AS (SELECT g.game_id, coalesce(g.home_club_formation, m.home_club_formation) AS home_club_formation
      FROM games g LEFT JOIN m ON g.season = m.season AND g.home_club_id = m.home_club_id)
"""


@query(
    "impute_mode",
    MODE_SQL
    + """
SELECT game_id, coalesce(home_club_formation, (SELECT home_club_formation FROM f WHERE home_club_formation IS NOT NULL
       GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS home_club_formation FROM f
""",
)
def mode(spark, sf):
    df = impute_mode_then_global(_games(spark, sf), ["home_club_formation"], ["season", "home_club_id"])
    return df.select("game_id", "home_club_formation")


@query(
    "impute_mean_truncated",
    "SELECT player_id, coalesce(height_in_cm, (SELECT trunc(avg(height_in_cm)) FROM players)) AS height_in_cm FROM players",
)
def mean_truncated(spark, sf):
    return fill_mean_truncated(players(spark, sf), ["height_in_cm"]).select("player_id", "height_in_cm")


@query(
    "impute_one_draw",
    """
SELECT club_id, coalesce(average_age, (SELECT average_age FROM clubs WHERE average_age IS NOT NULL
       ORDER BY md5(club_id || ':42'), club_id LIMIT 1)) AS average_age FROM clubs
""",
)
def one_draw(spark, sf):
    return fill_one_draw(clubs(spark, sf), "average_age", "club_id").select("club_id", "average_age")


@query(
    "impute_draw_from_list",
    """
SELECT player_id, coalesce(foot, ['right', 'left', 'both'][('0x' || substr(md5(player_id || ':42'), 1, 8))::BIGINT % 3 + 1]) AS foot FROM players
""",
)
def draw_from_list(spark, sf):
    return fill_draw_from(players(spark, sf), "foot", "player_id", ["right", "left", "both"]).select("player_id", "foot")


@query(
    "impute_by_type",
    """
SELECT game_id, coalesce(attendance, 0) AS attendance, coalesce(home_club_position, 0) AS home_club_position,
       coalesce(stadium, 'Unknown') AS stadium, coalesce(away_club_formation, 'Unknown') AS away_club_formation FROM games
""",
)
def by_type(spark, sf):
    g = games(spark, sf).select("game_id", "attendance", "home_club_position", "stadium", "away_club_formation")
    return fill_by_type(g)


@query(
    "impute_global",
    """
SELECT player_id, round(coalesce(height_in_cm, (SELECT avg(height_in_cm) FROM players)), 6) AS height_in_cm,
       round(coalesce(market_value_in_eur, (SELECT median(market_value_in_eur) FROM players)), 6) AS market_value_in_eur FROM players
""",
)
def global_fill(spark, sf):
    df = impute(players(spark, sf), ["height_in_cm"], "mean")
    df = impute(df, ["market_value_in_eur"], "median")
    return rounded(df, "height_in_cm", "market_value_in_eur").select("player_id", "height_in_cm", "market_value_in_eur")


@query("impute_mllib_median")
def mllib_median(spark, sf):
    p = players(spark, sf).select("player_id", "height_in_cm", "market_value_in_eur")
    cols = ["height_in_cm", "market_value_in_eur"]
    return Imputer(strategy="median", inputCols=cols, outputCols=cols).fit(p).transform(p)


KNN_COLS = ["height_in_cm", "value", "age_days"]


def knn_input(spark, sf):
    from touchline.functions import parse_date

    born = F.datediff(F.lit("2000-01-01").cast("date"), parse_date(F.col("date_of_birth")))
    return players(spark, sf).select(
        "player_id", "height_in_cm", F.floor(F.col("market_value_in_eur") / 10000).cast("double").alias("value"), born.cast("double").alias("age_days")
    )


@query(
    "knn_impute",
    """
WITH x AS (SELECT player_id, height_in_cm AS a, floor(market_value_in_eur / 10000)::DOUBLE AS b, date_diff('day', born, DATE '2000-01-01')::DOUBLE AS c FROM players),
q AS (SELECT * FROM x WHERE a IS NULL OR b IS NULL OR c IS NULL),
p AS (SELECT q.player_id, q.a AS qa, q.b AS qb, q.c AS qc, x.a, x.b, x.c,
        (coalesce((q.a - x.a) * (q.a - x.a), 0) + coalesce((q.b - x.b) * (q.b - x.b), 0) + coalesce((q.c - x.c) * (q.c - x.c), 0)) * 3
        / nullif((q.a - x.a IS NOT NULL)::INTEGER + (q.b - x.b IS NOT NULL)::INTEGER + (q.c - x.c IS NOT NULL)::INTEGER, 0) AS dist
      FROM q, x),
fa AS (SELECT player_id, avg(a) AS v FROM (SELECT player_id, a, row_number() OVER (PARTITION BY player_id ORDER BY dist, a) AS rn
       FROM p WHERE qa IS NULL AND a IS NOT NULL AND dist IS NOT NULL) WHERE rn <= 5 GROUP BY 1),
fb AS (SELECT player_id, avg(b) AS v FROM (SELECT player_id, b, row_number() OVER (PARTITION BY player_id ORDER BY dist, b) AS rn
       FROM p WHERE qb IS NULL AND b IS NOT NULL AND dist IS NOT NULL) WHERE rn <= 5 GROUP BY 1),
fc AS (SELECT player_id, avg(c) AS v FROM (SELECT player_id, c, row_number() OVER (PARTITION BY player_id ORDER BY dist, c) AS rn
       FROM p WHERE qc IS NULL AND c IS NOT NULL AND dist IS NOT NULL) WHERE rn <= 5 GROUP BY 1)
SELECT x.player_id, round(coalesce(x.a, fa.v, (SELECT avg(a) FROM x)), 6) AS height_in_cm,
       round(coalesce(x.b, fb.v, (SELECT avg(b) FROM x)), 6) AS value, round(coalesce(x.c, fc.v, (SELECT avg(c) FROM x)), 6) AS age_days
FROM x LEFT JOIN fa ON x.player_id = fa.player_id LEFT JOIN fb ON x.player_id = fb.player_id LEFT JOIN fc ON x.player_id = fc.player_id
""",
)
def knn(spark, sf):
    return rounded(knn_impute(knn_input(spark, sf), KNN_COLS, 5), *KNN_COLS)

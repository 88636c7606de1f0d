"""The preparation plan end to end."""


from touchline.catalog.base import linked, query, rounded
from touchline.catalog.cleaning import MONEY_SQL
from touchline.learning.train import metrics_table, stable_split, train_regressors
from touchline.plans.preparation import Preparation, clean, features, master_table, model_columns
from touchline.session import stage

SETTINGS = Preparation(closed_season=1998, empty_countries=("ASIA", "EUROPE"), empty_from=2000)
FILL_SETTINGS = Preparation(closed_season=1998, empty_countries=("ASIA", "EUROPE"), empty_from=2000, mode="fill")

MEANS = ["age_home", "age_away", "height_home", "height_away", "val_home", "val_away"]

MASTER_SQL = """
WITH g AS (SELECT * FROM games WHERE competition_type = 'domestic_league' AND game_id IN (SELECT game_id FROM appearances)),
v AS (SELECT player_id, date, market_value_in_eur FROM player_valuations
      QUALIFY row_number() OVER (PARTITION BY player_id, date ORDER BY valuation_id DESC) = 1),
valued AS (SELECT a.*, v.market_value_in_eur FROM appearances a ASOF LEFT JOIN v ON a.player_id = v.player_id AND a.date >= v.date),
per AS (SELECT x.game_id, x.player_club_id AS club_id, avg(date_diff('day', p.born, x.date) // 365) AS age, avg(p.height_in_cm) AS height,
          avg(x.market_value_in_eur) AS val, coalesce(sum(x.assists), 0)::BIGINT AS assists
        FROM valued x LEFT JOIN players p ON x.player_id = p.player_id GROUP BY ALL),
cards AS (SELECT game_id, club_id, count(*) FILTER (lower(description) LIKE '%red card%') AS red,
            count(*) FILTER (lower(description) LIKE '%yellow card%') AS yellow FROM game_events GROUP BY ALL),
master AS (
  SELECT g.season AS year, g.date, g.home_club_id AS home_id, g.away_club_id AS away_id, g.home_club_position AS pos_home,
    g.away_club_position AS pos_away, g.home_club_formation AS formation_home, g.away_club_formation AS formation_away,
    h.age AS age_home, a.age AS age_away, h.height AS height_home, a.height AS height_away, h.val AS val_home, a.val AS val_away,
    h.assists AS assists_home, a.assists AS assists_away, g.attendance, ch.red AS red_home, ca.red AS red_away,
    ch.yellow AS yellow_home, ca.yellow AS yellow_away, c.name AS league, c.country_name AS country,
    kh.net_transfer_record AS ntr_home, ka.net_transfer_record AS ntr_away, kh.stadium_seats AS seats,
    g.home_club_goals AS goals_home, g.away_club_goals AS goals_away
  FROM g LEFT JOIN per h ON g.game_id = h.game_id AND g.home_club_id = h.club_id
    LEFT JOIN per a ON g.game_id = a.game_id AND g.away_club_id = a.club_id
    LEFT JOIN cards ch ON g.game_id = ch.game_id AND g.home_club_id = ch.club_id
    LEFT JOIN cards ca ON g.game_id = ca.game_id AND g.away_club_id = ca.club_id
    LEFT JOIN competitions c ON g.competition_id = c.competition_id
    LEFT JOIN clubs kh ON g.home_club_id = kh.club_id LEFT JOIN clubs ka ON g.away_club_id = ka.club_id)
"""


def _rounded_columns(alias: str = "") -> str:
    return ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in MEANS)


@query("master_table", MASTER_SQL + f"SELECT * EXCLUDE ({', '.join(MEANS)}), {_rounded_columns()} FROM master")
def master(spark, sf):
    return rounded(master_table(linked(spark, sf), SETTINGS), *MEANS)


def _money(side: str) -> str:
    return MONEY_SQL.replace("net_transfer_record", f"ntr_{side}")


CLEAN_BASE = MASTER_SQL + f""",
d AS (SELECT DISTINCT * FROM master),
t AS (SELECT * EXCLUDE (pos_home, pos_away, ntr_home, ntr_away, seats, attendance, red_home, red_away, yellow_home, yellow_away, assists_home, assists_away),
  pos_home::DOUBLE AS pos_home, pos_away::DOUBLE AS pos_away, {_money('home')} AS ntr_home, {_money('away')} AS ntr_away, seats::DOUBLE AS seats,
  CASE WHEN country IN ('ASIA', 'EUROPE') AND year >= 2000 THEN 0 WHEN year = 1998 AND attendance IS NULL THEN 0 ELSE attendance END::DOUBLE AS attendance,
  coalesce(red_home, 0) AS red_home, coalesce(red_away, 0) AS red_away, coalesce(yellow_home, 0) AS yellow_home, coalesce(yellow_away, 0) AS yellow_away,
  coalesce(assists_home, 0) AS assists_home, coalesce(assists_away, 0) AS assists_away, row_number() OVER () AS rid FROM d),
aged AS (SELECT * FROM t WHERE age_home IS NOT NULL AND age_away IS NOT NULL),
s1 AS (SELECT league, home_id, avg(attendance) AS attendance, avg(val_home) AS val_home, avg(val_away) AS val_away FROM t GROUP BY ALL),
s2 AS (SELECT year, league, median(pos_home) AS pos_home, median(pos_away) AS pos_away FROM t GROUP BY ALL),
s3 AS (SELECT home_id, median(height_home) AS height_home, median(height_away) AS height_away FROM aged GROUP BY ALL),
s4 AS (SELECT home_id, formation_home FROM aged WHERE formation_home IS NOT NULL GROUP BY home_id, formation_home
       QUALIFY row_number() OVER (PARTITION BY home_id ORDER BY count(*) DESC, formation_home) = 1),
s5 AS (SELECT away_id, formation_away FROM aged WHERE formation_away IS NOT NULL GROUP BY away_id, formation_away
       QUALIFY row_number() OVER (PARTITION BY away_id ORDER BY count(*) DESC, formation_away) = 1)
"""
FILLED = ["attendance", "val_home", "val_away", "pos_home", "pos_away", "height_home", "height_away"]
PLACE = {"attendance": "s1", "val_home": "s1", "val_away": "s1", "pos_home": "s2", "pos_away": "s2", "height_home": "s3", "height_away": "s3"}


def _clean_sql(mode: str) -> str:
    first = (lambda c: f"{PLACE[c]}.{c}, aged.{c}") if mode == "replace" else (lambda c: f"aged.{c}, {PLACE[c]}.{c}")
    filled = ", ".join(f"round(coalesce({first(c)}), 6) + 0.0 AS {c}" for c in FILLED)
    out = [*FILLED, "age_home", "age_away", "formation_home", "formation_away", "rid"]
    return CLEAN_BASE + f"""
SELECT aged.* EXCLUDE ({', '.join(out)}), {filled}, round(age_home, 6) AS age_home, round(age_away, 6) AS age_away,
  coalesce(aged.formation_home, s4.formation_home) AS formation_home, coalesce(aged.formation_away, s5.formation_away) AS formation_away
FROM aged LEFT JOIN s1 ON aged.league = s1.league AND aged.home_id = s1.home_id
  LEFT JOIN s2 ON aged.year = s2.year AND aged.league = s2.league LEFT JOIN s3 ON aged.home_id = s3.home_id
  LEFT JOIN s4 ON aged.home_id = s4.home_id LEFT JOIN s5 ON aged.away_id = s5.away_id
"""


def _cleaned(spark, sf, settings):
    return clean(master_table(linked(spark, sf), settings), settings)


@query("clean_master", _clean_sql("replace"))
def clean_master(spark, sf):
    return rounded(_cleaned(spark, sf, SETTINGS), *FILLED, "age_home", "age_away", "ntr_home", "ntr_away")


@query("clean_master_fill", _clean_sql("fill"))
def clean_master_fill(spark, sf):
    return rounded(_cleaned(spark, sf, FILL_SETTINGS), *FILLED, "age_home", "age_away", "ntr_home", "ntr_away")


@query("feature_table")
def feature_table(spark, sf):
    return features(_cleaned(spark, sf, SETTINGS))


@query("match_models")
def match_models(spark, sf):
    """Preparation, features and the tuned models of both targets, end to end."""
    table = stage(features(_cleaned(spark, sf, SETTINGS)), "features")
    train, test = stable_split(table, ["date", "home_id", "away_id", "goals_home", "goals_away"])
    results = {}
    for target in ("goals_home", "goals_away"):
        numeric, categorical = model_columns(table, target)
        results[target] = train_regressors(train, test, target, numeric, categorical, impute=True)
    return metrics_table(spark, results)

"""Scalar expressions on text, dates and numbers."""

from pyspark.sql import functions as F

from touchline.catalog.base import clubs, game_events, games, players, query, r6, table
from touchline.functions import (
    age_at,
    age_in_season,
    clip_upper,
    contains_flag,
    contains_ignoring_case,
    exact_age,
    fold_accents,
    formation_digits,
    formation_lenient,
    formation_strict,
    is_missing,
    money,
    parse_date,
    ratio,
    replace_value,
    to_number,
)
from touchline.operators.relational import side_join
from touchline.learning.rules import basket

MONEY_SQL = """round((CASE WHEN contains(net_transfer_record, '-') OR contains(net_transfer_record, '−') THEN -1 ELSE 1 END)
  * regexp_replace(regexp_replace(regexp_replace(net_transfer_record, '[€+−-]', '', 'g'), 'm', 'e6'), 'k', 'e3')::DOUBLE, 6) + 0.0"""


@query("currency_parse", f"SELECT club_id, net_transfer_record, {MONEY_SQL} AS amount FROM clubs")
def currency_parse(spark, sf):
    return clubs(spark, sf).select("club_id", "net_transfer_record", r6(money(F.col("net_transfer_record"))).alias("amount"))


@query(
    "text_flags",
    """
SELECT game_id, club_id, player_id, number, coalesce(contains(lower(description), 'red card'), false) AS red,
       coalesce(contains(description, 'Yellow card'), false)::INTEGER AS yellow FROM game_events
""",
)
def text_flags(spark, sf):
    d = F.col("description")
    return game_events(spark, sf).select(
        "game_id", "club_id", "player_id", "number", contains_ignoring_case(d, "red card").alias("red"), contains_flag(d, "Yellow card").alias("yellow")
    )


@query(
    "document_flags",
    """
SELECT doc_id, contains(lower(text), 'the of') AS any_case, contains(text, 'The')::INTEGER AS exact FROM documents
""",
    linked_tables=False,
)
def document_flags(spark, sf):
    t = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id", contains_ignoring_case(t, "the of").alias("any_case"), contains_flag(t, "The").alias("exact")
    )


@query(
    "formation_digits",
    "SELECT game_id, nullif(regexp_extract(home_club_formation, '(\\d+(?:-\\d+)+)', 1), '') AS digits FROM games",
)
def digits(spark, sf):
    return games(spark, sf).select("game_id", formation_digits(F.col("home_club_formation")).alias("digits"))


def _lines(c):
    return [c[i].alias(n) for i, n in enumerate(("defenders", "midfielders", "attackers"))]


@query(
    "formation_strict",
    """
WITH p AS (SELECT game_id, string_split(nullif(regexp_extract(home_club_formation, '(\\d+(?:-\\d+)+)', 1), ''), '-') AS s FROM games)
SELECT game_id, CASE WHEN len(s) IN (3, 4) THEN s[1]::INTEGER END AS defenders,
       CASE len(s) WHEN 3 THEN s[2]::INTEGER WHEN 4 THEN s[2]::INTEGER + s[3]::INTEGER END AS midfielders,
       CASE len(s) WHEN 3 THEN s[3]::INTEGER WHEN 4 THEN s[4]::INTEGER END AS attackers FROM p
""",
)
def strict(spark, sf):
    return games(spark, sf).select("game_id", *_lines(formation_strict(formation_digits(F.col("home_club_formation")))))


@query(
    "formation_lenient",
    """
WITH p AS (SELECT game_id, coalesce(list_filter(string_split(home_club_formation, '-'), lambda x: regexp_full_match(x, '[0-9]+')), []) AS s FROM games)
SELECT game_id, CASE WHEN len(s) IN (3, 4) THEN s[1]::INTEGER ELSE 4 END AS defenders,
       CASE len(s) WHEN 3 THEN s[2]::INTEGER WHEN 4 THEN s[2]::INTEGER + s[3]::INTEGER ELSE 4 END AS midfielders,
       CASE len(s) WHEN 3 THEN s[3]::INTEGER WHEN 4 THEN s[4]::INTEGER ELSE 2 END AS attackers FROM p
""",
)
def lenient(spark, sf):
    return games(spark, sf).select("game_id", *_lines(formation_lenient(F.col("home_club_formation"))))


@query("parse_dates", "SELECT player_id, born FROM players")
def parse_dates(spark, sf):
    return players(spark, sf).select("player_id", parse_date(F.col("date_of_birth")).alias("born"))


@query(
    "ages",
    """
SELECT a.game_id, a.player_id, a.date, (date_diff('day', p.born, a.date) // 365)::INTEGER AS age_floor,
       (year(a.date) - year(p.born))::INTEGER AS age_season,
       (year(a.date) - year(p.born) - (strftime(a.date, '%m%d') < strftime(p.born, '%m%d'))::INTEGER)::INTEGER AS age_exact
FROM appearances a LEFT JOIN players p ON a.player_id = p.player_id
""",
)
def ages(spark, sf):
    from touchline.catalog.base import appearances

    p = players(spark, sf).select("player_id", parse_date(F.col("date_of_birth")).alias("born"))
    day, born = F.col("date"), F.col("born")
    return appearances(spark, sf).join(p, "player_id", "left").select(
        "game_id", "player_id", "date", age_at(day, born).alias("age_floor"),
        age_in_season(F.year(day), born).alias("age_season"), exact_age(day, born).alias("age_exact"),
    )


@query(
    "occupancy",
    """
WITH o AS (SELECT game_id, attendance::DOUBLE / nullif(stadium_seats, 0) AS r FROM games LEFT JOIN clubs ON home_club_id = club_id)
SELECT game_id, round(r, 6) AS occupancy, round(r * 100, 6) AS percentage, round(CASE WHEN r > 1 THEN 1 ELSE r END, 6) AS clipped FROM o
""",
)
def occupancy(spark, sf):
    g = games(spark, sf).select("game_id", "home_club_id", "attendance")
    seats = clubs(spark, sf).select("club_id", "stadium_seats")
    rows = side_join(g, seats, ["club_id"], {"home": {"club_id": "home_club_id"}})
    r = ratio(F.col("attendance"), F.col("stadium_seats_home"))
    pct = ratio(F.col("attendance"), F.col("stadium_seats_home"), 100.0)
    return rows.select("game_id", r6(r).alias("occupancy"), r6(pct).alias("percentage"), r6(clip_upper(r, 1.0)).alias("clipped"))


@query(
    "casts_and_replace",
    """
SELECT game_id, club_id, player_id, number, CASE WHEN minute = -1 THEN 1 ELSE minute END AS minute,
       try_cast(description AS DOUBLE) AS as_number, try_cast(number::VARCHAR AS DOUBLE) AS read_back, description IS NULL AS missing
FROM game_events
""",
)
def casts_and_replace(spark, sf):
    d = F.col("description")
    return game_events(spark, sf).select(
        "game_id", "club_id", "player_id", "number", replace_value(F.col("minute"), -1, 1).alias("minute"), to_number(d).alias("as_number"),
        to_number(F.col("number").cast("string")).alias("read_back"), is_missing(d).alias("missing"),
    )


def _plain_sql(col: str) -> str:
    """Letters with marks of Western European languages, and those without a base letter."""
    return f"replace(replace(replace(translate(strip_accents({col}), 'ıłŁøØđĐ', 'ilLoOdD'), 'ß', 'ss'), 'æ', 'ae'), 'Æ', 'Ae')"


@query("fold_accents", f"SELECT player_id, {_plain_sql('country_of_citizenship')} AS country FROM players")
def accents(spark, sf):
    return players(spark, sf).select("player_id", fold_accents(F.col("country_of_citizenship")).alias("country"))


NAMES = ("Москва – ‘Łódź’", "Ολυμπιακός", "Αθήνα", "Щукин", "Ђоковић", "Šibenik", "Müller & Søn", "«Зенит»…", "東京")


@query(
    "transliterate",
    """
SELECT p_partkey AS player_id, ['Moskva - \'\'Lodz\'\'', 'Olybiakos', 'Athina', 'Shchukin', 'Djokovic', 'Sibenik', 'Muller & Son', '"Zenit"...', '東京'][p_partkey % 9 + 1]
  || ' ' || p_name AS name FROM part
""",
    linked_tables=False,
)
def transliterated_names(spark, sf):
    """Names of players behind those of clubs in several alphabets."""
    club = F.element_at(F.array(*[F.lit(n) for n in NAMES]), (F.col("p_partkey") % len(NAMES) + 1).cast("int"))
    parts = table(spark, sf, "part")
    return parts.select(F.col("p_partkey").alias("player_id"), fold_accents(F.concat(club, F.lit(" "), F.col("p_name"))).alias("name"))


@query("fold_accents_documents", f"SELECT doc_id, {_plain_sql('text')} AS plain FROM documents", linked_tables=False)
def accents_documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", fold_accents(F.col("text")).alias("plain"))


@query(
    "baskets",
    """
SELECT game_id, concat_ws('|', regexp_extract(home_club_formation, '(\\d+(?:-\\d+)+)', 1), home_club_goals::VARCHAR) AS items
FROM games WHERE home_club_formation IS NOT NULL AND home_club_goals IS NOT NULL
""",
)
def baskets(spark, sf):
    g = games(spark, sf).where("home_club_formation is not null and home_club_goals is not null")
    items = basket(formation_digits(F.col("home_club_formation")), F.col("home_club_goals"))
    return g.select("game_id", F.array_join(items, "|").alias("items"))

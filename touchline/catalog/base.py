"""The linked match tables, derived from the given star-schema tables.

Orders stand for games: their lowest and highest supplier are the two clubs and
their line items the appearances and match events. Parts are players, suppliers
clubs, nations leagues, and the event stream holds the dated valuations. Gaps are
put in by fixed rules on the keys, as the given tables have none. ``linked``
builds the tables in Spark and ``LINKED_SQL`` states the same in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# The formation texts given to the stand-in games.
FORMATIONS = (
    "4-3-3 Attacking", "4-2-3-1", "4-4-2 double 6", "3-5-2 flat", "5-3-2", "3-4-3",
    "4-1-4-1", "4-5-1 flat", "3-4-2-1", "4-3-3 Defending", "5-4-1", "4-4-2",
)


def query(name: str, sql: str | None = None, linked_tables: bool = True):
    """Register a query; SQL over the linked tables gets their definitions in front."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            body = sql.strip()
            if linked_tables:
                body = LINKED_SQL + (", " + body[5:] if body.upper().startswith("WITH ") else body)
            ORACLE[name] = body
        return fn

    return add


def r6(c: Column | str) -> Column:
    """Six decimals, without a negative zero."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6) + F.lit(0.0)


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in cols})


_KNOWN_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One given table; its schema is looked up in the file only once."""
    path = f"{sf}/{name}.parquet"
    if path not in _KNOWN_SCHEMAS:
        _KNOWN_SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_KNOWN_SCHEMAS[path]).parquet(path)


def _pick(index: Column, values) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _unless(gap: Column, value: Column) -> Column:
    return F.when(~gap, value)


def games(spark, sf) -> DataFrame:
    k, cust = F.col("o_orderkey"), F.col("o_custkey")
    sides = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("home_club_id"), F.max("l_suppkey").alias("away_club_id"),
        F.count_if(F.col("l_returnflag") == "R").cast("int").alias("home_club_goals"),
        F.count_if(F.col("l_returnflag") == "A").cast("int").alias("away_club_goals"),
    )
    base = table(spark, sf, "orders").join(table(spark, sf, "customer"), cust == F.col("c_custkey"), "left")
    return base.join(sides, k == F.col("l_orderkey"), "left").select(
        k.alias("game_id"),
        F.concat(F.lit("L"), F.col("c_nationkey").cast("string")).alias("competition_id"),
        F.year("o_orderdate").alias("season"),
        F.col("o_orderdate").cast("date").alias("date"),
        "home_club_id", "away_club_id", "home_club_goals", "away_club_goals",
        _unless(k % 97 == 0, (cust % 20 + 1).cast("int")).alias("home_club_position"),
        _unless(k % 89 == 0, (k % 20 + 1).cast("int")).alias("away_club_position"),
        _unless(k % 8 == 0, F.floor(F.col("o_totalprice") / 10)).alias("attendance"),
        _unless(k % 16 == 3, _pick(cust % len(FORMATIONS), FORMATIONS)).alias("home_club_formation"),
        _unless(k % 16 == 5, _pick(k % len(FORMATIONS), FORMATIONS)).alias("away_club_formation"),
        F.when(F.col("o_orderstatus") == "P", "domestic_cup").otherwise("domestic_league").alias("competition_type"),
        _unless(k % 11 == 0, F.concat(F.lit("Stadium "), F.col("home_club_id").cast("string"))).alias("stadium"),
        F.concat(F.lit("Club "), F.col("home_club_id").cast("string")).alias("home_club_name"),
    )


def clubs(spark, sf) -> DataFrame:
    k = F.col("s_suppkey")
    size = F.concat((k % 90 + 1).cast("string"), F.lit("."), F.lpad((k * 37 % 100).cast("string"), 2, "0"))
    record = (
        F.when(k % 17 == 0, "+-0")
        .when(k % 4 == 0, F.concat(F.lit("€-"), size, F.lit("k")))
        .when(k % 4 == 1, F.concat(F.lit("+€"), size, F.lit("m")))
        .when(k % 4 == 2, F.concat(F.lit("€"), size, F.lit("m")))
        .otherwise(F.concat(F.lit("−€"), size, F.lit("k")))
    )
    return table(spark, sf, "supplier").select(
        k.alias("club_id"), F.col("s_name").alias("name"),
        F.concat(F.lit("L"), F.col("s_nationkey").cast("string")).alias("domestic_competition_id"),
        _unless(k % 11 == 0, (200 + k * 7 % 100) / 10).alias("average_age"),
        F.concat(F.col("s_name"), F.lit(" Aréna")).alias("stadium_name"),
        F.when(k % 13 == 0, 0).otherwise(5000 + k * 977 % 60000).cast("int").alias("stadium_seats"),
        record.alias("net_transfer_record"),
    )


def competitions(spark, sf) -> DataFrame:
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    kind = F.when(F.col("n_nationkey") % 5 == 4, "domestic_cup").otherwise("domestic_league")
    return n.select(
        F.concat(F.lit("L"), F.col("n_nationkey").cast("string")).alias("competition_id"),
        F.lower("n_name").alias("name"), kind.alias("type"), F.col("r_name").alias("country_name"),
    )


def game_events(spark, sf) -> DataFrame:
    flag, line = F.col("l_returnflag"), F.col("l_linestatus")
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("game_id"), F.col("l_suppkey").alias("club_id"), F.col("l_partkey").alias("player_id"),
        F.col("l_linenumber").alias("number"),
        F.when(F.col("l_quantity") == 50, -1).otherwise(F.col("l_quantity").cast("int")).alias("minute"),
        F.when(flag == "R", "Cards").when(flag == "A", "Substitutions").otherwise("Goals").alias("type"),
        F.when((flag == "R") & (line == "F"), "Foul, Yellow card")
        .when((flag == "R") & (line == "O"), "Violence, RED CARD")
        .when(flag == "A", F.lit(None).cast("string"))
        .otherwise("Header, 1. Goal").alias("description"),
    )


def players(spark, sf) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    born = F.date_add(F.lit("1965-01-01").cast("date"), (size * 180 + k % 180).cast("int"))
    text = F.when(k % 2 == 0, F.date_format(born, "yyyy-MM-dd")).otherwise(F.date_format(born, "MM/dd/yyyy"))
    height = F.when(k % 101 == 7, F.lit(18.0)).otherwise((160 + (k * 7 + size) % 40).cast("double"))
    return table(spark, sf, "part").select(
        k.alias("player_id"), F.col("p_name").alias("name"), (k * 13 % 97).alias("current_club_id"),
        _unless(k % 53 == 0, text).alias("date_of_birth"),
        _unless(k % 31 == 0, height).alias("height_in_cm"),
        F.col("p_type").alias("sub_position"),
        _unless(k % 5 == 0, _pick(k % 3, ("right", "left", "both"))).alias("foot"),
        _unless(k % 23 == 0, F.round(F.col("p_retailprice") * 1000)).alias("market_value_in_eur"),
        _pick(k % 4, ("Türkiye", "Österreich", "Côte d'Ivoire", "Elazığ")).alias("country_of_citizenship"),
    )


def appearances(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("game_id"), F.col("l_partkey").alias("player_id"), F.col("l_suppkey").alias("player_club_id"),
        F.col("l_shipdate").cast("date").alias("date"), (F.col("l_linenumber") % 3).alias("assists"),
        F.when(F.col("l_returnflag") == "N", 1).otherwise(0).alias("goals"),
    )


def player_valuations(spark, sf) -> DataFrame:
    k = F.col("event_id")
    return table(spark, sf, "events").select(
        k.alias("valuation_id"), F.col("user_id").alias("player_id"),
        F.date_add(F.lit("1995-01-01").cast("date"), (k * 37 % 2550).cast("int")).alias("date"),
        _unless(k % 29 == 0, F.round(F.col("value") * 100000)).alias("market_value_in_eur"),
    )


def game_lineups(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("game_id"), F.col("l_suppkey").alias("club_id"), F.col("l_partkey").alias("player_id")
    )


LINKED = {
    "games": games, "clubs": clubs, "competitions": competitions, "game_events": game_events,
    "players": players, "appearances": appearances, "player_valuations": player_valuations,
    "game_lineups": game_lineups,
}


def linked(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """All linked tables by name."""
    return {name: build(spark, sf) for name, build in LINKED.items()}


_FORMATION_LIST = "[" + ", ".join(f"'{f}'" for f in FORMATIONS) + "]"

LINKED_SQL = f"""
WITH sides AS (
  SELECT l_orderkey, min(l_suppkey) AS home_club_id, max(l_suppkey) AS away_club_id,
         (count(*) FILTER (WHERE l_returnflag = 'R'))::INTEGER AS home_club_goals,
         (count(*) FILTER (WHERE l_returnflag = 'A'))::INTEGER AS away_club_goals
  FROM lineitem GROUP BY l_orderkey),
games AS (
  SELECT o_orderkey AS game_id, 'L' || c_nationkey AS competition_id,
         year(o_orderdate)::INTEGER AS season, o_orderdate::DATE AS date,
         home_club_id, away_club_id, home_club_goals, away_club_goals,
         CASE WHEN o_orderkey % 97 <> 0 THEN (o_custkey % 20 + 1)::INTEGER END AS home_club_position,
         CASE WHEN o_orderkey % 89 <> 0 THEN (o_orderkey % 20 + 1)::INTEGER END AS away_club_position,
         CASE WHEN o_orderkey % 8 <> 0 THEN floor(o_totalprice / 10)::BIGINT END AS attendance,
         CASE WHEN o_orderkey % 16 <> 3 THEN {_FORMATION_LIST}[o_custkey % 12 + 1] END AS home_club_formation,
         CASE WHEN o_orderkey % 16 <> 5 THEN {_FORMATION_LIST}[o_orderkey % 12 + 1] END AS away_club_formation,
         CASE WHEN o_orderstatus = 'P' THEN 'domestic_cup' ELSE 'domestic_league' END AS competition_type,
         CASE WHEN o_orderkey % 11 <> 0 THEN 'Stadium ' || home_club_id END AS stadium,
         'Club ' || home_club_id AS home_club_name
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN sides ON o_orderkey = l_orderkey),
club_sizes AS (
  SELECT *, (s_suppkey % 90 + 1)::VARCHAR || '.' || lpad((s_suppkey * 37 % 100)::VARCHAR, 2, '0') AS size
  FROM supplier),
clubs AS (
  SELECT s_suppkey AS club_id, s_name AS name, 'L' || s_nationkey AS domestic_competition_id,
         CASE WHEN s_suppkey % 11 <> 0 THEN (200 + s_suppkey * 7 % 100)::DOUBLE / 10 END AS average_age,
         s_name || ' Aréna' AS stadium_name,
         (CASE WHEN s_suppkey % 13 = 0 THEN 0 ELSE 5000 + s_suppkey * 977 % 60000 END)::INTEGER AS stadium_seats,
         CASE WHEN s_suppkey % 17 = 0 THEN '+-0'
              WHEN s_suppkey % 4 = 0 THEN '€-' || size || 'k'
              WHEN s_suppkey % 4 = 1 THEN '+€' || size || 'm'
              WHEN s_suppkey % 4 = 2 THEN '€' || size || 'm'
              ELSE '−€' || size || 'k' END AS net_transfer_record
  FROM club_sizes),
competitions AS (
  SELECT 'L' || n_nationkey AS competition_id, lower(n_name) AS name,
         CASE WHEN n_nationkey % 5 = 4 THEN 'domestic_cup' ELSE 'domestic_league' END AS type,
         r_name AS country_name
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey),
game_events AS (
  SELECT l_orderkey AS game_id, l_suppkey AS club_id, l_partkey AS player_id, l_linenumber AS number,
         CASE WHEN l_quantity = 50 THEN -1 ELSE l_quantity::INTEGER END AS minute,
         CASE l_returnflag WHEN 'R' THEN 'Cards' WHEN 'A' THEN 'Substitutions' ELSE 'Goals' END AS type,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'Foul, Yellow card'
              WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'Violence, RED CARD'
              WHEN l_returnflag = 'A' THEN NULL ELSE 'Header, 1. Goal' END AS description
  FROM lineitem),
births AS (SELECT *, DATE '1965-01-01' + (p_size * 180 + p_partkey % 180)::INTEGER AS born FROM part),
players AS (
  SELECT p_partkey AS player_id, p_name AS name, p_partkey * 13 % 97 AS current_club_id,
         CASE WHEN p_partkey % 53 = 0 THEN NULL WHEN p_partkey % 2 = 0 THEN strftime(born, '%Y-%m-%d')
              ELSE strftime(born, '%m/%d/%Y') END AS date_of_birth,
         CASE WHEN p_partkey % 53 <> 0 THEN born END AS born,
         CASE WHEN p_partkey % 31 = 0 THEN NULL WHEN p_partkey % 101 = 7 THEN 18.0
              ELSE 160 + (p_partkey * 7 + p_size) % 40 END::DOUBLE AS height_in_cm,
         p_type AS sub_position,
         CASE WHEN p_partkey % 5 <> 0 THEN ['right', 'left', 'both'][p_partkey % 3 + 1] END AS foot,
         CASE WHEN p_partkey % 23 <> 0 THEN round(p_retailprice * 1000) END AS market_value_in_eur,
         ['Türkiye', 'Österreich', 'Côte d''Ivoire', 'Elazığ'][p_partkey % 4 + 1] AS country_of_citizenship
  FROM births),
appearances AS (
  SELECT l_orderkey AS game_id, l_partkey AS player_id, l_suppkey AS player_club_id,
         l_shipdate::DATE AS date, l_linenumber % 3 AS assists,
         CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END AS goals
  FROM lineitem),
player_valuations AS (
  SELECT event_id AS valuation_id, user_id AS player_id,
         DATE '1995-01-01' + (event_id * 37 % 2550)::INTEGER AS date,
         CASE WHEN event_id % 29 <> 0 THEN round(value * 100000) END AS market_value_in_eur
  FROM events),
game_lineups AS (
  SELECT l_orderkey AS game_id, l_suppkey AS club_id, l_partkey AS player_id FROM lineitem)
"""

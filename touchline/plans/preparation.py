"""From the seven linked input tables to one clean row per game, and to features."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.dates import age_at, parse_date
from touchline.functions.values import money, ratio
from touchline.learning.cluster import STRATEGIES, with_strategies
from touchline.operators.aggregates import lineup_profile, text_counts
from touchline.operators.asof import asof_backward
from touchline.operators.impute import GroupFill, fill_where, group_fills, override_where
from touchline.operators.relational import keep_known, side_join
from touchline.session import stage

# The master columns in order, with the input names they come from.
MASTER_COLUMNS = {
    "season": "year", "date": "date", "home_club_id": "home_id", "away_club_id": "away_id",
    "home_club_position": "pos_home", "away_club_position": "pos_away",
    "home_club_formation": "formation_home", "away_club_formation": "formation_away",
    "age_home": "age_home", "age_away": "age_away",
    "height_in_cm_home": "height_home", "height_in_cm_away": "height_away",
    "market_value_in_eur_home": "val_home", "market_value_in_eur_away": "val_away",
    "assists_home": "assists_home", "assists_away": "assists_away", "attendance": "attendance",
    "red_home": "red_home", "red_away": "red_away", "yellow_home": "yellow_home",
    "yellow_away": "yellow_away", "name": "league", "country_name": "country",
    "net_transfer_record_home": "ntr_home", "net_transfer_record_away": "ntr_away",
    "stadium_seats_home": "seats", "home_club_goals": "goals_home", "away_club_goals": "goals_away",
}
GAME_COLUMNS = (
    "game_id", "competition_id", "season", "date", "home_club_id", "away_club_id", "home_club_position", "away_club_position",
    "home_club_formation", "away_club_formation", "attendance", "home_club_goals", "away_club_goals",
)
CARDS = {"red": "red card", "yellow": "yellow card"}
LABELS = ("goals_home", "goals_away")
NOT_FEATURES = ("date", "home_id", "away_id", "league", "assists_home", "assists_away")


@dataclass(frozen=True)
class Preparation:
    """Settings of the preparation plan.

    ``mode`` decides whether group imputation fills NULLs only or, as in the
    published results, replaces every value by its group's statistic.
    """

    kind: str = "domestic_league"
    closed_season: int = 2020
    empty_countries: tuple[str, ...] = ("Ukraine", "Russia")
    empty_from: int = 2022
    mode: str = "replace"


def fold_sides(games: DataFrame, per_club: DataFrame, how: str = "left") -> DataFrame:
    """``{col}_home``/``{col}_away`` columns per game from a (game, club) table.

    The club table meets the games once, on the game alone, and folds to one row
    per game; two joins on (game, club) would shuffle the games twice more.
    """
    ids = games.select("game_id", "home_club_id", "away_club_id")
    cols = [c for c in per_club.columns if c not in ("game_id", "club_id")]
    sides = {"home": F.col("club_id") == F.col("home_club_id"), "away": F.col("club_id") == F.col("away_club_id")}
    folded = (
        per_club.join(ids, "game_id")
        .groupBy("game_id")
        .agg(*[F.max(F.when(at, F.col(c))).alias(f"{c}_{side}") for side, at in sides.items() for c in cols])
    )
    return games.join(folded, "game_id", how)


def master_table(tables: Mapping[str, DataFrame], settings: Preparation = Preparation()) -> DataFrame:
    """One row per game of the chosen type that has appearances, 28 columns.

    Only the reductions that pay are kept as semi-joins: appearances and events
    before their aggregates. Clubs, competitions, players and valuations are only
    looked up, so cutting them first would not change a row. The games are staged,
    as both reductions and both folds of sides read them.
    """
    games = stage(tables["games"].where(F.col("competition_type") == settings.kind).select(*GAME_COLUMNS), "games")
    apps = keep_known(tables["appearances"], "game_id", games).select(
        "game_id", "player_id", F.col("player_club_id").alias("club_id"), "assists", F.col("date").cast("date").alias("date")
    )
    players = tables["players"].select("player_id", parse_date(F.col("date_of_birth").cast("string")).alias("born"), "height_in_cm")
    valuations = tables["player_valuations"].withColumn("date", F.col("date").cast("date"))

    apps = asof_backward(
        apps, valuations, ["player_id"], "date", ["market_value_in_eur"],
        [c for c in ("valuation_id",) if c in valuations.columns],
    )
    apps = apps.join(players, "player_id", "left").withColumn("age", age_at(F.col("date"), F.col("born")))
    per_club = lineup_profile(apps, ["game_id", "club_id"])

    events = keep_known(tables["game_events"], "game_id", games)
    cards = text_counts(events, ["game_id", "club_id"], "description", CARDS)

    wide = fold_sides(games, per_club, "inner")  # inner: games with appearances only
    wide = fold_sides(wide, cards)
    wide = wide.join(tables["competitions"].select("competition_id", "name", "country_name"), "competition_id", "left")
    clubs = tables["clubs"].select("club_id", "net_transfer_record", "stadium_seats")
    wide = side_join(wide, clubs, ["club_id"], {"home": {"club_id": "home_club_id"}, "away": {"club_id": "away_club_id"}})
    return wide.select(*[F.col(a).alias(b) for a, b in MASTER_COLUMNS.items()])


def clean(master: DataFrame, settings: Preparation = Preparation()) -> DataFrame:
    """Typed, filled rows. The deduplicated table is staged, as each statistic reads it."""
    df = master.dropDuplicates()
    df = df.withColumns({c: money(F.col(c)) for c in ("ntr_home", "ntr_away")})
    df = df.withColumn("seats", F.col("seats").try_cast("double"))
    df = fill_where(df, "attendance", F.col("year") == settings.closed_season, 0)
    unplayed = F.col("country").isin(*settings.empty_countries) & (F.col("year") >= settings.empty_from)
    df = override_where(df, "attendance", unplayed, 0).withColumn("attendance", F.col("attendance").cast("double"))
    df = df.withColumns({c: F.col(c).cast("double") for c in ("pos_home", "pos_away")})
    df = df.na.fill(0, ["red_home", "red_away", "yellow_home", "yellow_away", "assists_home", "assists_away"])
    df = stage(df, "master")

    aged = "age_home is not null and age_away is not null"
    mode = settings.mode
    fills = [
        GroupFill(("attendance", "val_home", "val_away"), ("league", "home_id"), "mean", mode),
        GroupFill(("pos_home", "pos_away"), ("year", "league"), "median", mode),
        GroupFill(("height_home", "height_away"), ("home_id",), "median", mode, among=aged),
        GroupFill(("formation_home",), ("home_id",), "mode", "fill", among=aged),
        GroupFill(("formation_away",), ("away_id",), "mode", "fill", among=aged),
    ]
    return group_fills(df, fills).where(aged)


def features(df: DataFrame, names=STRATEGIES) -> DataFrame:
    """Occupancy and k-means strategies in place of attendance, seats and formations.

    The clean table is staged first: fitting and labelling both read it.
    """
    df = stage(df, "clean")
    df = df.withColumn("occupancy", ratio(F.col("attendance"), F.col("seats"))).drop("attendance", "seats")
    df = with_strategies(df, {"formation_home": "strategy_home", "formation_away": "strategy_away"}, names)
    return df.drop("formation_home", "formation_away")


def prepare(tables: Mapping[str, DataFrame], settings: Preparation = Preparation()) -> DataFrame:
    return clean(master_table(tables, settings), settings)


def model_columns(df: DataFrame, target: str) -> tuple[list[str], list[str]]:
    """Numeric and categorical inputs of the model of one target."""
    side = target.split("_")[-1]
    skip = {*NOT_FEATURES, *LABELS, "country", "strategy_home", "strategy_away"}
    return [c for c in df.columns if c not in skip], ["country", f"strategy_{side}"]

"""Declared schemas of the input tables, so that no scan has to infer types."""

from pyspark.sql import types as T


KINDS = {
    "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "string": T.StringType(), "date": T.DateType(),
}


def _schema(columns: str) -> T.StructType:
    """Schema from ``name type, ...``; parsed here, as no session exists on import."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, KINDS[kind]) for name, kind in pairs])


SCHEMAS: dict[str, T.StructType] = {
    "games": _schema(
        "game_id bigint, competition_id string, season int, round string, date date, "
        "home_club_id bigint, away_club_id bigint, home_club_goals int, away_club_goals int, "
        "home_club_position int, away_club_position int, home_club_manager_name string, "
        "away_club_manager_name string, stadium string, attendance bigint, referee string, "
        "url string, home_club_formation string, away_club_formation string, "
        "home_club_name string, away_club_name string, competition_type string"
    ),
    "clubs": _schema(
        "club_id bigint, club_code string, name string, domestic_competition_id string, "
        "total_market_value double, squad_size int, average_age double, foreigners_number int, "
        "foreigners_percentage double, national_team_players int, stadium_name string, "
        "stadium_seats int, net_transfer_record string, coach_name string, last_season int, "
        "filename string, url string"
    ),
    "competitions": _schema(
        "competition_id string, competition_code string, name string, sub_type string, "
        "type string, country_id int, country_name string, domestic_league_code string, "
        "confederation string, url string"
    ),
    "game_events": _schema(
        "game_event_id string, date date, game_id bigint, minute int, type string, "
        "club_id bigint, player_id bigint, description string, player_in_id bigint, "
        "player_assist_id bigint"
    ),
    "players": _schema(
        "player_id bigint, first_name string, last_name string, name string, last_season int, "
        "current_club_id bigint, player_code string, country_of_birth string, "
        "city_of_birth string, country_of_citizenship string, date_of_birth string, "
        "sub_position string, position string, foot string, height_in_cm double, "
        "contract_expiration_date string, agent_name string, image_url string, url string, "
        "current_club_domestic_competition_id string, current_club_name string, "
        "market_value_in_eur double, highest_market_value_in_eur double"
    ),
    "appearances": _schema(
        "appearance_id string, game_id bigint, player_id bigint, player_club_id bigint, "
        "player_current_club_id bigint, date date, player_name string, competition_id string, "
        "yellow_cards int, red_cards int, goals int, assists int, minutes_played int"
    ),
    "player_valuations": _schema(
        "player_id bigint, date date, market_value_in_eur double, current_club_id bigint, "
        "player_club_domestic_competition_id string"
    ),
    "game_lineups": _schema(
        "game_lineups_id string, date date, game_id bigint, player_id bigint, club_id bigint, "
        "player_name string, type string, position string, number string, team_captain int"
    ),
}

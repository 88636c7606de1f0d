"""The whole plan on hand-made CSV files, checked by hand."""

import pytest

from touchline.plans.preparation import MASTER_COLUMNS, Preparation, features, master_table, model_columns, prepare
from touchline.sources import load_inputs

FILES = {
    "games": """game_id,competition_id,season,date,home_club_id,away_club_id,home_club_goals,away_club_goals,home_club_position,away_club_position,attendance,home_club_formation,away_club_formation,competition_type
1,L1,2019,2019-08-10,10,20,2,1,1,4,1000,4-3-3 Attacking,5-4-1,domestic_league
2,L1,2020,2020-08-10,10,20,0,0,3,,,4-3-3,,domestic_league
3,L1,2020,2020-09-10,20,10,1,3,2,1,600,,4-2-3-1,domestic_league
4,CUP,2020,2020-09-12,20,10,1,3,2,1,600,4-4-2,4-4-2,domestic_cup
5,L1,2020,2020-09-13,10,20,1,1,2,1,900,4-4-2,4-4-2,domestic_league
""",
    "clubs": """club_id,stadium_seats,net_transfer_record
10,2000,€1.5m
20,500,€-250k
30,9,+-0
""",
    "competitions": """competition_id,name,country_name
L1,first,Spain
CUP,cup,Spain
""",
    "game_events": """game_id,club_id,type,description
1,10,Cards,"1. Yellow card, Foul"
1,10,Cards,Red card
1,20,Substitutions,
3,10,Cards,YELLOW CARD
""",
    "players": """player_id,date_of_birth,height_in_cm
100,1990-08-10,180
101,1995-01-01,
102,01/01/2000,190
""",
    "appearances": """game_id,player_id,player_club_id,date,assists
1,100,10,2019-08-10,1
1,101,10,2019-08-10,0
1,102,20,2019-08-10,
2,100,10,2020-08-10,2
2,102,20,2020-08-10,0
3,102,20,2020-09-10,1
3,100,10,2020-09-10,0
""",
    "player_valuations": """player_id,date,market_value_in_eur
100,2019-08-10,100
100,2020-08-09,300
100,2021-01-01,999
101,2019-09-01,50
102,2018-01-01,40
""",
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("csv")
    for name, text in FILES.items():
        (root / f"{name}.csv").write_text(text)
    return load_inputs(spark, str(root))


def test_master(tables):
    df = master_table(tables)
    assert df.columns == list(MASTER_COLUMNS.values())
    got = {str(r["date"]): r.asDict() for r in df.collect()}
    assert set(got) == {"2019-08-10", "2020-08-10", "2020-09-10"}  # no cup game, none without appearances
    g = got["2019-08-10"]
    assert (g["val_home"], g["val_away"]) == (100.0, 40.0)  # the second player has no earlier value
    assert (g["age_home"], g["height_home"], g["height_away"]) == ((29 + 24) / 2, 180.0, 190.0)
    assert (g["assists_home"], g["assists_away"]) == (1, 0)
    assert (g["red_home"], g["yellow_home"], g["red_away"]) == (1, 1, 0)
    assert (g["seats"], g["league"], g["country"], g["ntr_away"]) == (2000, "first", "Spain", "€-250k")
    assert got["2020-08-10"]["val_home"] == 300.0 and got["2020-08-10"]["red_home"] is None
    assert got["2020-09-10"]["yellow_away"] == 1 and got["2020-09-10"]["yellow_home"] is None


def test_clean_fill_and_replace(tables):
    fill = {str(r["date"]): r for r in prepare(tables, Preparation(mode="fill")).collect()}
    g = fill["2020-08-10"]
    assert (g["attendance"], g["red_home"], g["ntr_home"], g["ntr_away"]) == (0.0, 0, 1.5e6, -250e3)
    assert g["pos_away"] == 1.0  # median of the league's other game that year
    assert g["formation_away"] == "5-4-1" and fill["2020-09-10"]["formation_home"] is None  # its club has none at home
    assert fill["2019-08-10"]["attendance"] == 1000.0
    swap = {str(r["date"]): r for r in prepare(tables).collect()}
    assert swap["2019-08-10"]["attendance"] == swap["2020-08-10"]["attendance"] == 500.0
    assert swap["2019-08-10"]["val_home"] == 200.0 and swap["2020-09-10"]["attendance"] == 600.0


def test_features(tables):
    df = features(prepare(tables))
    rows = {str(r["date"]): r for r in df.collect()}
    assert rows["2019-08-10"]["occupancy"] == 0.25 and rows["2020-09-10"]["occupancy"] == 1.2
    assert not {"attendance", "seats", "formation_home"} & set(df.columns)
    numeric, categorical = model_columns(df, "goals_away")
    assert categorical == ["country", "strategy_away"] and "goals_home" not in numeric and "occupancy" in numeric

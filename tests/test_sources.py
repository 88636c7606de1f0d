import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from touchline.functions import money
from touchline.session import CHECKPOINT_DIR, checkpoint_dir, stage
from touchline.sources import SCHEMAS, infer_csv, load_inputs, load_table, write_csv, write_parquet

# Published rows of the input and output tables.
COMPETITIONS = [
    ("CIT", "italy-cup", "domestic_cup", "Italy"), ("DK1", "superligaen", "domestic_league", "Denmark"),
    ("ES1", "laliga", "domestic_league", "Spain"), ("FR1", "ligue-1", "domestic_league", "France"),
]
RECORDS = [(105, "-1.48m", -1480000.0), (11127, "-770k", -770000.0), (114, "-14.50m", -14500000.0)]


def test_declared_csv(spark, tmp_path):
    (tmp_path / "games.csv").write_text(
        "date,game_id,attendance,season,extra,home_club_formation\n2020-01-02,7,,2019,z,4-3-3\n2020-01-03,8,nan,2019,z,\n")
    df = load_table(spark, str(tmp_path), "games", "csv").orderBy("game_id")
    assert df.columns == ["date", "game_id", "attendance", "season", "home_club_formation"]
    assert dict(df.dtypes)["attendance"] == "bigint"
    assert [tuple(r) for r in df.collect()] == [
        (dt.date(2020, 1, 2), 7, None, 2019, "4-3-3"), (dt.date(2020, 1, 3), 8, None, 2019, None)]


def test_nan_text_becomes_null(spark, tmp_path):
    (tmp_path / "players.csv").write_text("player_id,height_in_cm\n1,NaN\n2,180\n")
    assert [tuple(r) for r in load_table(spark, str(tmp_path), "players", "csv").orderBy("player_id").collect()] == [(1, None), (2, 180.0)]


def test_cells_that_a_type_cannot_hold(spark, tmp_path):
    (tmp_path / "games.csv").write_text("game_id,attendance\n1,52000.0\n2,None\n3,7.5\n")
    read = lambda strict: load_table(spark, str(tmp_path), "games", "csv", strict).orderBy("game_id").collect()
    assert [tuple(r) for r in read(False)] == [(1, 52000), (2, None), (3, None)]
    with pytest.raises(Exception, match="attendance can't hold 7.5"):
        read(True)


def test_round_trips(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 2019), (2, None, 2020)], "id int, s string, year int")
    write_csv(df, str(tmp_path / "c"))
    assert sorted(map(tuple, infer_csv(spark, str(tmp_path / "c")).collect())) == [(1, "a", 2019), (2, None, 2020)]
    write_parquet(df, str(tmp_path / "p.parquet"), ("year",))
    assert load_table(spark, str(tmp_path), "p").where("year = 2019").count() == 1
    assert sorted(stage(df).collect()) == sorted(df.collect())


def test_load_inputs(spark, tmp_path):
    for name in ("clubs", "competitions"):
        cols = SCHEMAS[name].fieldNames()
        (tmp_path / f"{name}.csv").write_text(",".join(cols) + "\n" + ",".join("1" for _ in cols) + "\n")
    t = load_inputs(spark, str(tmp_path), names=("clubs", "competitions"))
    assert set(t) == {"clubs", "competitions"} and t["clubs"].count() == 1


def session_like(master, folder=None, app="app-1"):
    conf = type("Conf", (), {"get": lambda self, key, default=None: folder if key == CHECKPOINT_DIR and folder else default})()
    return type("Session", (), {"conf": conf, "sparkContext": type("C", (), {"master": master, "applicationId": app})()})()


def test_checkpoint_folder_comes_from_the_session(spark):
    assert checkpoint_dir(session_like("spark://host:7077", "hdfs://shared")) == "hdfs://shared"
    own = checkpoint_dir(session_like("local[2]"))
    assert own == checkpoint_dir(session_like("local[2]")) != checkpoint_dir(session_like("local[2]", app="app-2"))
    named = spark.conf.get(CHECKPOINT_DIR, None)
    assert named is None or checkpoint_dir(spark) == named


def test_published_rows(spark):
    comps = spark.createDataFrame(COMPETITIONS, "competition_id string, name string, type string, country_name string")
    kept = comps.where("type = 'domestic_league'").select("competition_id", "name", "country_name")
    assert [tuple(r) for r in kept.collect()] == [("DK1", "superligaen", "Denmark"), ("ES1", "laliga", "Spain"), ("FR1", "ligue-1", "France")]
    clubs = spark.createDataFrame(RECORDS, "club_id int, record string, amount double")
    assert clubs.where(money(F.col("record")) != F.col("amount")).count() == 0


def test_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError):
        checkpoint_dir(session_like("spark://host:7077"))


def test_stages_are_dropped_on_request(spark):
    from touchline import session

    app = spark.sparkContext.applicationId
    held, session._stages[app] = session._stages.pop(app, []), []
    try:
        kept = session.stage(spark.range(5), "dropped")
        (path,) = session._stages[app]
        assert kept.count() == 5 and os.path.isdir(path)
        assert session.drop_stages(spark) == 1 and not os.path.exists(path)
        assert session.drop_stages(spark) == 0
    finally:
        session._stages[app] = held


def test_pointed_cells_skip_the_integer_cast(spark, tmp_path):
    """A failing cast costs ten times a parse (F15), so `52000.0` and gaps must not be handed to one; values stay."""
    cells = {"52000.0": 52000, "+8.0": 8, "-.0": 0, "5.": 5, " 9 ": 9, "9223372036854775808.0": None, "NaN": None, "7": 7}
    (tmp_path / "games.csv").write_text("game_id,attendance\n" + "".join(f'{i},"{c}"\n' for i, c in enumerate(cells)))
    df = load_table(spark, str(tmp_path), "games", "csv", strict=False)
    assert [r["attendance"] for r in df.orderBy("game_id").collect()] == list(cells.values())
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" in plan and plan.index("RLIKE") < plan.index("try_cast")

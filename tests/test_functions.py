import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from touchline.functions import (
    age_at, age_in_season, calendar_features, clip_upper, contains_flag, contains_ignoring_case, exact_age,
    fold_accents, formation_digits, formation_lenient, formation_strict, is_missing, lookup, money, parse_date,
    ratio, replace_value, rule_strategy, to_number,
)


def apply(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_money(spark):
    texts = ["€1.2m", "€-770k", "+€72.25m", "−€3m", "+-0", None, "junk", "-1.48m", "-14.50m", "+72.25m", "-770k"]
    got = apply(spark, texts, money)
    assert got == [1.2e6, -770e3, 72.25e6, -3e6, 0.0, None, None, -1.48e6, -14.5e6, 72.25e6, -770e3]
    assert math.copysign(1, got[4]) == 1


def test_formations(spark):
    texts = ["4-3-3", "4-2-3-1", "4-3-3 Attacking", "3-3-3-1", "", None, "abc", "1-2-3-4-5"]
    assert apply(spark, texts, formation_digits) == ["4-3-3", "4-2-3-1", "4-3-3", "3-3-3-1", None, None, None, "1-2-3-4-5"]
    assert apply(spark, texts, formation_lenient) == [
        [4, 3, 3], [4, 5, 1], [4, 4, 2], [3, 6, 1], [4, 4, 2], [4, 4, 2], [4, 4, 2], [4, 4, 2]]
    assert apply(spark, texts, formation_strict) == [[4, 3, 3], [4, 5, 1], None, [3, 6, 1], None, None, None, None]


def test_rule_strategy_by_side(spark):
    assert apply(spark, ["2-7-1", "5-1-4", "4-4-2", None, "9-9-9"], lambda c: rule_strategy(c, "home")) == [
        "Defensive", "Unknown", "Balanced", "Unknown", "Unknown"]
    assert apply(spark, ["2-7-1", "5-1-4", "2-6-2"], lambda c: rule_strategy(c, "away")) == ["Unknown", "Defensive", "Balanced"]


def test_accents(spark):
    words = ["Beşiktaş", "Elazığ", "Łódź", "Straße", "Ødegaard", "plain", None]
    assert apply(spark, words, fold_accents) == ["Besiktas", "Elazig", "Lodz", "Strasse", "Odegaard", "plain", None]


def test_text_flags(spark):
    texts = ["Foul, Yellow card", "RED CARD", "yellow CARD", None]
    assert apply(spark, texts, lambda c: contains_ignoring_case(c, "yellow card")) == [True, False, True, False]
    assert apply(spark, texts, lambda c: contains_flag(c, "Yellow card")) == [1, 0, 0, 0]


def test_dates(spark):
    texts = ["1990-05-17", "05/17/1990", "17.5.1990", None]
    day = dt.date(1990, 5, 17)
    assert apply(spark, texts, parse_date) == [day, day, None, None]
    df = spark.createDataFrame([(dt.date(2020, 5, 16), day), (dt.date(2020, 5, 17), day), (None, day)], "d date, b date")
    got = df.select(age_at(F.col("d"), F.col("b")), exact_age(F.col("d"), F.col("b")), age_in_season(F.lit(2020), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(30, 29, 30), (30, 30, 30), (None, None, 30)]


def test_calendar(spark):
    df = spark.createDataFrame([(dt.date(2020, 12, 31),), (dt.date(2021, 1, 4),)], "date date")
    cal = {r["date"]: r for r in calendar_features(df, "date").collect()}
    assert len(cal) == 5
    assert (cal[dt.date(2021, 1, 1)]["year"], cal[dt.date(2021, 1, 1)]["week"]) == (2021, 53)
    assert cal[dt.date(2020, 12, 31)]["week_normalized"] is None  # one week only in that year
    assert cal[dt.date(2021, 1, 4)]["week_normalized"] == 0.0
    assert cal[dt.date(2021, 1, 1)]["week_cos"] == pytest.approx(1.0)
    one = calendar_features(df.limit(1), "date").collect()
    assert len(one) == 1


def test_numbers(spark):
    df = spark.createDataFrame([(5, 10), (5, 0), (5, None), (30, 10)], "a int, b int")
    assert [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()] == [0.5, None, None, 3.0]
    assert apply(spark, [0.5, 3.0, None], lambda c: clip_upper(c, 1.0), "double") == [0.5, 1.0, None]
    assert apply(spark, ["1.5", "x", None], to_number) == [1.5, None, None]
    assert apply(spark, [-1, 4, None], lambda c: replace_value(c, -1, 1), "int") == [1, 4, None]
    assert apply(spark, [1.0, float("nan"), None], lambda c: is_missing(c, floating=True), "double") == [False, True, True]
    assert apply(spark, ["a", "b", None], lambda c: lookup(c, {"a": 1}, 0)) == [1, 0, 0]
    assert apply(spark, ["a", "b", None], lambda c: lookup(c, {"a": 1})) == [1, None, None]

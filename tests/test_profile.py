import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.operators import charts
from touchline.operators.aggregates import first_known, lineup_profile, text_counts, totals
from touchline.operators.charts import (
    auto_bins, auto_histogram, bootstrap_interval, box_stats, conditional_density, density_grid, histogram, mean_interval,
)
from touchline.operators.profile import (
    agreement, argmax_abs, correlations, crosstab_wide, describe_numbers, describe_texts, distinct_counts,
    duplicate_rows, explicit_order, null_counts, table_diagnostics, value_counts, variable_kinds,
)


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame(
        [("a", 1, 1.0), ("a", 0, 2.0), ("b", 1, None), (None, 0, 4.0), ("a", 1, 1.0)], "k string, flag int, x double")


def test_counts(small, rows):
    assert {r["column"]: (r["rows"], r["nulls"], r["any_null"]) for r in null_counts(small).collect()} == {
        "k": (5, 1, True), "flag": (5, 0, False), "x": (5, 1, True)}
    assert dict(rows(distinct_counts(small))) == {"k": 2, "flag": 2, "x": 3}
    assert dict(rows(distinct_counts(small, approximate=True))) == {"k": 2, "flag": 2, "x": 3}
    assert rows(duplicate_rows(small)) == [(5, 1)]
    assert rows(value_counts(small, "k")) == [("a", 3), ("b", 1)]
    assert {r["column"]: r["kind"] for r in variable_kinds(small).collect()} == {"k": "categorical", "flag": "binary", "x": "numerical"}
    assert rows(crosstab_wide(small, "k", "flag"), "k") == [("a", 1, 2), ("b", 0, 1)]


def test_describe(small):
    n = {r["column"]: r for r in describe_numbers(small).collect()}["x"]
    assert (n["count"], n["min"], n["max"], n["q25"], n["q50"], n["q75"]) == (4, 1.0, 4.0, 1.0, 1.5, 2.5)
    t = describe_texts(small).collect()[0]
    assert (t["count"], t["unique"], t["top"], t["freq"]) == (4, 2, "a", 3)
    report = table_diagnostics({"small": small}).collect()
    assert {(r["column"], r["type"], r["nulls"]) for r in report} == {("k", "string", 1), ("flag", "int", 0), ("x", "double", 1)}


def test_correlations_are_pairwise_complete(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 4.0, 1.0), (3.0, 6.0, 0.0), (4.0, None, 5.0)], "a double, b double, c double")
    r = {(x["a"], x["b"]): x["r"] for x in correlations(df).collect()}
    assert len(r) == 9 and r["a", "b"] == pytest.approx(1.0) and r["b", "c"] == pytest.approx(-1.0)


def test_agreement_order_argmax(spark, rows):
    df = spark.createDataFrame([("x", "x"), ("x", "y"), (None, "y")], "a string, b string")
    assert sorted(rows(agreement(df, "a", "b")), key=str) == [("x", "x", 1, True), ("x", "y", 1, False), (None, "y", 1, False)]
    assert [r[0] for r in df.select(explicit_order("b", ["y", "x"])).collect()] == [2, 1, 1]
    z = spark.createDataFrame([("p", 0.5), ("q", -0.9), ("r", None)], "n string, z double")
    assert rows(argmax_abs(z, "z", ["n"])) == [("q", -0.9)]


def test_grouped_aggregates(spark, rows):
    apps = spark.createDataFrame(
        [(1, 1, 20, 180.0, None, None), (1, 1, 30, None, 5.0, None), (1, None, 9, 1.0, 1.0, 1)],
        "g int, c int, age int, height_in_cm double, market_value_in_eur double, assists int")
    assert rows(lineup_profile(apps, ["g", "c"])) == [(1, 1, 25.0, 180.0, 5.0, 0)]
    assert rows(totals(apps, "g", {"n": "assists"})) == [(1, 1)]
    ev = spark.createDataFrame([(1, 2, None), (1, 3, "Yellow CARD"), (1, 1, "x"), (2, 1, None)], "g int, minute int, d string")
    assert rows(text_counts(ev, ["g"], "d", {"yellow": "yellow card"}), "g") == [(1, 1), (2, 0)]
    assert rows(first_known(ev, ["g"], ["minute"], ["d", "minute"]), "g") == [(1, "x", 1), (2, None, 1)]
    assert rows(first_known(ev, ["g"], ["minute"], ["d"], last=True), "g") == [(1, "Yellow CARD"), (2, None)]


def test_histogram_and_density(spark, rows):
    df = spark.createDataFrame([(float(i), "ab"[i % 2]) for i in range(11)] + [(None, "a")], "x double, k string")
    h = rows(histogram(df, "x", 5), "bin")
    assert [r[2] for r in h] == [2, 2, 2, 2, 3] and h[1][1] == 2.0
    assert sum(r["share"] for r in conditional_density(df, "x", "k", 5).collect()) == pytest.approx(5.0)
    assert auto_bins(df, "x") == 5
    one = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert rows(histogram(one, "x", 4)) == [(0, 3.0, 2)]


def test_box_and_interval(spark):
    xs = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([("a", x) for x in xs] + [("b", 1.0)], "k string, x double")
    b = {r["k"]: r for r in box_stats(df, ["k"], "x").collect()}
    assert (b["a"]["q1"], b["a"]["median"], b["a"]["q3"], b["a"]["whisker_low"], b["a"]["whisker_high"], b["a"]["outliers"]) == (2.0, 3.0, 4.0, 1.0, 4.0, 1)
    assert b["b"]["outliers"] == 0
    whole = box_stats(df, [], "x").collect()[0]
    assert whole["n"] == 6 and whole["outliers"] == 1
    m = {r["k"]: r for r in mean_interval(df, "k", "x").collect()}
    assert m["a"]["mean"] == 22.0 and m["a"]["high"] == pytest.approx(22 + 1.96 * math.sqrt(sum((x - 22) ** 2 for x in xs) / 4) / math.sqrt(5))
    assert m["b"]["low"] is None
    assert df.where(F.col("k") == "none").transform(lambda d: box_stats(d, ["k"], "x")).count() == 0


def test_bootstrap_covers_the_mean(spark):
    """About 95 of 100 intervals hold the true mean, whatever the partitioning."""
    rnd = random.Random(21)
    data = [(g * 1000 + i, g, rnd.gauss(10, 3)) for g in range(150) for i in range(60)] + [(1, None, 5.0), (2, 3, None)]
    df = spark.createDataFrame(data, "id long, g int, y double")
    got = {r["g"]: r for r in bootstrap_interval(df, "g", "y", "id").collect()}
    assert len(got) == 150 and got[3]["n"] == 60
    assert 0.88 <= sum(r["low"] <= 10 <= r["high"] for r in got.values()) / 150 <= 0.99
    widths = [(r["high"] - r["low"]) / 2 for r in got.values()]
    assert sum(widths) / 150 == pytest.approx(1.96 * 3 / 60**0.5, rel=0.08)
    again = {r["g"]: r for r in bootstrap_interval(df.repartition(7), "g", "y", "id").collect()}
    assert all(again[g]["low"] == pytest.approx(r["low"]) for g, r in got.items())


def test_bootstrap_deals_its_rows_out(spark):
    """Few input partitions must not mean few tasks; numbers that aren't finite spoil only the replicates that drew them."""
    data = [(i, "a" if i % 2 else "b", float(i % 10)) for i in range(400)] + [(1000, "c", float("inf")), (None, "d", 4.0)]
    df = spark.createDataFrame(data, "id long, g string, y double").coalesce(1)
    tasks = []
    original = charts._replicate_sums
    charts._replicate_sums = lambda *args: tasks.append(args) or original(*args)
    try:
        out = bootstrap_interval(df, "g", "y", "id")
    finally:
        charts._replicate_sums = original
    assert tasks == [("g", 200)]
    assert "RoundRobinPartitioning(4)" in out._jdf.queryExecution().toString()
    got = {r["g"]: r for r in out.collect()}
    assert {g: r["n"] for g, r in got.items()} == {"a": 200, "b": 200, "c": 1, "d": 1}
    assert got["c"]["low"] == math.inf and got["d"]["low"] == got["d"]["high"] == 4.0
    assert got["a"]["mean"] == 5.0 and got["a"]["low"] < 5.0 < got["a"]["high"]


def test_grid_density_is_near_the_direct_sum(spark):
    rnd = random.Random(22)
    xs = [rnd.gauss(0, 1) for _ in range(500)] + [rnd.gauss(6, 0.5) for _ in range(300)]
    df = spark.createDataFrame([(x,) for x in [*xs, None]], "x double")
    grid = density_grid(df, "x", 0.4, 300).orderBy("point").collect()
    direct = [sum(math.exp(-(((r["x"] - x) / 0.4) ** 2) / 2) for x in xs) / len(xs) / 0.4 / math.sqrt(2 * math.pi) for r in grid]
    assert len(grid) == 300 and max(abs(r["density"] - d) for r, d in zip(grid, direct)) < 0.002 * max(direct)
    assert sum(r["density"] for r in grid) * (grid[1]["x"] - grid[0]["x"]) == pytest.approx(1, abs=0.01)


def test_automatic_bins(spark):
    rnd = random.Random(23)
    spread, flat = [rnd.gauss(0, 1) for _ in range(700)], [0.0] * 90 + [1.0] * 5 + [3.0]
    for xs, rule in ((spread, "auto"), (flat, "sturges"), ([2.0, 2.0], "auto"), ([float(i) for i in range(100)], "auto")):
        counts, edges = np.histogram(xs, rule)
        got = {r["bin"]: (r["bin_start"], r["n"]) for r in auto_histogram(spark.createDataFrame([(x,) for x in xs], "x double"), "x").collect()}
        assert sum(n for _, n in got.values()) == len(xs)
        if max(xs) > min(xs):
            assert {b: n for b, (_, n) in got.items()} == {i: c for i, c in enumerate(counts) if c}
            assert all(start == pytest.approx(edges[b]) for b, (start, _) in got.items())


def test_most_frequent_of_long_texts(spark):
    same = "x" * 100
    texts = [same + t for t in "bbaacd"] + ["a rare one", None] + [same + "b" * 500_000] * 2
    df = spark.createDataFrame([(t, "k") for t in texts], "t string, k string")
    got = {r["column"]: tuple(r)[1:] for r in describe_texts(df).collect()}
    assert got == {"t": (9, 6, same + "a", 2), "k": (10, 1, "k", 10)}

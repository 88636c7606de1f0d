import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.operators.impute import (
    GroupFill, backward_fill, fill_by_key, fill_by_type, fill_draw_from, fill_mean_truncated, fill_one_draw,
    fill_where, forward_fill, group_fills, impute, impute_mode_then_global, override_where,
)
from touchline.operators.knn import knn_impute
from touchline.operators import ordered
from touchline.operators.ordered import range_slices
from touchline.operators.stats import global_statistic, group_mode, group_percentiles, min_max_scaled


def test_slices_are_monotone_and_even(spark):
    df = spark.range(1000).select((F.col("id") * F.col("id")).alias("x"))
    got = range_slices(df, ["x"], 10).orderBy("x").collect()
    s = [r["_slice"] for r in got]
    assert s == sorted(s) and s[0] == 0 and s[-1] == 9
    assert max(s.count(i) for i in range(10)) < 150


def test_slices_split_a_shared_value(spark):
    rnd = random.Random(9)
    data = sorted((7 if rnd.random() < 0.5 else rnd.randrange(20), i) for i in range(2000))
    df = spark.createDataFrame(data, "season int, id int")
    got = range_slices(df, ["season", "id"], 8).orderBy("season", "id").collect()
    numbers = [r["_slice"] for r in got]
    assert numbers == sorted(numbers)  # the numbers follow the order
    assert max(numbers.count(n) for n in set(numbers)) < 400  # half of the rows share one season


def test_as_many_slices_as_the_rows_need(spark, monkeypatch):
    """A key with a third of the rows, and rows without a key, are cut like all others; the order may be text."""
    monkeypatch.setattr(ordered, "SLICE_ROWS", 500)
    rnd = random.Random(2)
    data = [(rnd.choice(["hot", None, f"k{rnd.randrange(900)}"]), f"{rnd.randrange(10**6):07d}-{i}", i) for i in range(6000)]
    df = spark.createDataFrame(data, "k string, at string, v int")
    spread = F.when(F.col("k").isNull(), F.xxhash64("at")).alias("_spread")
    sizes = [r["count"] for r in range_slices(df.select("*", spread), ["k", "_spread", "at"]).groupBy("_slice").count().collect()]
    assert len(sizes) >= 12 and max(sizes) < 1000
    gaps = df.withColumn("v", F.when(F.col("v") % 50 == 0, F.col("v")))
    got = {(r[0], r[1]): r[2] for r in forward_fill(gaps, ["k"], ["at"], ["v"]).collect()}
    for key in ("hot", "k5"):
        last = None
        for _, at, i in sorted((d for d in data if d[0] == key), key=lambda d: d[1]):
            last = i if i % 50 == 0 else last
            assert got[key, at] == last
    assert all(got[None, at] == (i if i % 50 == 0 else None) for k, at, i in data if k is None)


@pytest.mark.parametrize("backward", [False, True])
def test_a_slice_takes_over_one_row(spark, backward):
    df = spark.createDataFrame([(k, i, i if i % 40 == 0 else None, None if i % 7 else f"t{i}") for k in (1, 2) for i in range(200)], "k int, i int, v int, t string")
    sliced = range_slices(df, ["k", "i"], 16)
    carried = ordered.starts(sliced, ["k"], ["i"], ["v", "t"], backward).collect()
    assert len(carried) == sliced.select("_slice").distinct().count()
    edges = {r["_slice"]: (r["lo"], r["hi"]) for r in sliced.groupBy("_slice").agg(F.min(F.struct("k", "i")).alias("lo"), F.max(F.struct("k", "i")).alias("hi")).collect()}
    for r in carried:
        k, i = edges[r["_slice"]][1 if backward else 0]
        assert r["k"] == k
        outside = [j for j in range(200) if (j > i if backward else j < i)]
        known = [[j for j in outside if j % 40 == 0], [j for j in outside if j % 7 == 0]]
        pick = min if backward else max
        # the rows of the key in earlier slices are those before the slice's first row
        assert r["_c_v"] == (pick(known[0]) if known[0] else None)
        assert r["_c_t"] == (f"t{pick(known[1])}" if known[1] else None)


@pytest.mark.parametrize("backward", [False, True])
def test_fill_along_a_hot_key(spark, rows, backward):
    rnd = random.Random(3)
    data = [(i, rnd.choice([1, 1, 1, 2, None]), rnd.randrange(4), rnd.choice([None, None, None, i])) for i in range(300)]
    df = spark.createDataFrame(data, "id int, k int, season int, v int")
    fn = backward_fill if backward else forward_fill
    got = {r[0]: r[3] for r in rows(fn(df, ["k"], ["season", "id"], ["v"], slices=8))}
    for key in (1, 2):
        last = None
        for i, _, _, v in sorted((d for d in data if d[1] == key), key=lambda d: (d[2], d[0]), reverse=backward):
            last = v if v is not None else last
            assert got[i] == last
    assert all(got[i] == v for i, k, _, v in data if k is None)
    again = fn(fn(df, ["k"], ["season", "id"], ["v"], slices=8), ["k"], ["season", "id"], ["v"], slices=8)
    assert {r[0]: r[3] for r in rows(again)} == got


def test_percentiles_match_numpy(spark):
    rnd = random.Random(5)
    data = [(rnd.choice("aaab"), float(rnd.choice([rnd.randrange(10), rnd.random() * 100]))) for _ in range(500)] + [("c", 7.0), ("d", None), (None, 1.0)]
    df = spark.createDataFrame(data, "k string, x double")
    probs = {"q1": 0.25, "med": 0.5, "q9": 0.9}
    got = {r["k"]: r for r in group_percentiles(df, ["k"], "x", probs).collect()}
    assert set(got) == {"a", "b", "c"}
    for k in "abc":
        xs = [x for g, x in data if g == k and x is not None]
        for name, p in probs.items():
            assert got[k][name] == pytest.approx(np.percentile(xs, p * 100))
    whole = group_percentiles(df, [], "x", {"m": 0.5}).collect()[0][0]
    assert whole == pytest.approx(np.median([x for _, x in data if x is not None]))


def test_percentiles_of_large_groups_by_radix(spark):
    """Groups above the bound are searched in few rounds that read ever fewer rows; hot values and both signs included."""
    rnd = random.Random(6)
    data = [("a", rnd.gauss(0, 1)) for _ in range(3000)] + [("b", rnd.choice([5.0, 5.0, rnd.random()])) for _ in range(1500)] + [("c", float(i)) for i in range(30)]
    data += [("d", v) for v in (float("inf"), -float("inf"), -0.0, 0.0, 5e-324, -5e-324)] * 20 + [("a", None), (None, 3.0)]
    rnd.shuffle(data)
    df = spark.createDataFrame(data, "k string, x double")
    probs = {"lo": 0.0, "q1": 0.25, "med": 0.5, "p9": 0.9, "hi": 1.0}
    trace = []
    got = {r["k"]: r for r in group_percentiles(df, ["k"], "x", probs, direct=50, trace=trace).collect()}
    assert set(got) == {"a", "b", "c", "d"}
    for k in "abc":
        xs = [x for g, x in data if g == k and x is not None]
        for name, p in probs.items():
            assert got[k][name] == pytest.approx(np.percentile(xs, p * 100))
    assert [got["d"][n] for n in ("lo", "med", "hi")] == [-float("inf"), 0.0, float("inf")]
    assert 2 <= len(trace) <= 8
    assert trace[0] == (3, 4620) and all(later[1] < earlier[1] for earlier, later in zip(trace, trace[1:]) if later[1] > 1200)
    whole = group_percentiles(df, [], "x", {"m": 0.5}, direct=50).collect()
    assert whole[0]["m"] == pytest.approx(np.median([x for _, x in data if x is not None]))


def test_percentiles_without_values(spark):
    df = spark.createDataFrame([("a", None)], "k string, x double")
    assert group_percentiles(df, ["k"], "x", {"m": 0.5}).collect() == []
    assert [r["m"] for r in group_percentiles(df, [], "x", {"m": 0.5}).collect()] == [None]


def test_mode_ties_and_gaps(spark, rows):
    df = spark.createDataFrame([("a", "y"), ("a", "x"), ("b", None), ("c", "z"), (None, "q")], "k string, v string")
    assert rows(group_mode(df, ["k"], "v", "m"), "k") == [("a", "x"), ("c", "z")]
    assert global_statistic(df, "v", "mode").collect()[0][0] == "q"


GROUPS = [(1, "a", 1.0), (2, "a", None), (3, "a", 3.0), (4, "b", None), (5, "c", 9.0), (6, None, None)]


def test_group_fill_and_replace(spark, rows):
    df = spark.createDataFrame(GROUPS, "id int, k string, x double")
    fill = dict((r[0], r[2]) for r in rows(impute(df, ["x"], "mean", ["k"])))
    assert fill == {1: 1.0, 2: 2.0, 3: 3.0, 4: None, 5: 9.0, 6: None}
    swap = dict((r[0], r[2]) for r in rows(impute(df, ["x"], "mean", ["k"], mode="replace")))
    assert swap == {1: 2.0, 2: 2.0, 3: 2.0, 4: None, 5: 9.0, 6: None}
    med = dict((r[0], r[2]) for r in rows(impute(df, ["x"], "median")))
    assert med[2] == 3.0 and med[6] == 3.0 and med[1] == 1.0


def test_several_fills_use_the_original_values(spark, rows):
    df = spark.createDataFrame([(1, "a", 1.0, None), (2, "a", None, 4.0), (3, "a", 5.0, 8.0)], "id int, k string, x double, y double")
    out = group_fills(df, [GroupFill(("x", "y"), ("k",), "median", "replace"), GroupFill(("id",), ("k",), "mean", "fill", among="y > 4")])
    assert rows(out, "id") == [(1, "a", 3.0, 6.0), (2, "a", 3.0, 6.0), (3, "a", 3.0, 6.0)]


def test_mode_then_global(spark, rows):
    df = spark.createDataFrame([(1, "a", "p"), (2, "a", None), (3, "b", None), (4, "c", "q"), (5, "c", "q")], "id int, k string, v string")
    assert [r[2] for r in rows(impute_mode_then_global(df, ["v"], ["k"]), "id")] == ["p", "p", "p", "q", "q"]


def test_simple_fills(spark, rows):
    df = spark.createDataFrame([(1, 2019, None, None), (2, 2020, None, "s"), (3, 2020, 7.5, None), (4, 2021, 8.4, "t")], "id int, y int, x double, s string")
    assert [r[2] for r in rows(fill_where(df, "x", F.col("y") == 2020, 0.0), "id")] == [None, 0.0, 7.5, 8.4]
    assert [r[2] for r in rows(override_where(df, "x", F.col("y") == 2020, 0.0), "id")] == [None, 0.0, 0.0, 8.4]
    assert [r[3] for r in rows(fill_by_key(df, "s", "y", {2020: "k"}), "id")] == [None, "s", "k", "t"]
    assert [r[2] for r in rows(fill_mean_truncated(df, ["x"]), "id")] == [7.0, 7.0, 7.5, 8.4]
    assert [r[2:] for r in rows(fill_by_type(df), "id")][0] == (0.0, "Unknown")
    drawn = [r[2] for r in rows(fill_one_draw(df, "x", "id"), "id")]
    assert drawn[0] == drawn[1] and drawn[0] in (7.5, 8.4) and drawn[2:] == [7.5, 8.4]
    picked = [r[3] for r in rows(fill_draw_from(df, "s", "id", ["u", "v"]), "id")]
    assert picked[1] == "s" and picked[3] == "t" and set(picked[::2]) <= {"u", "v"}
    assert [r[2] for r in rows(impute(df, ["x"], "constant", value=1.0), "id")][:2] == [1.0, 1.0]


def test_min_max(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 5), (None, 2)], "k string, x int")
    assert rows(min_max_scaled(df, ["k"], "x", "z"), "k", "x") == [(None, 2, None), ("a", 1, 0.0), ("a", 3, 1.0), ("b", 5, None)]


def brute_knn(data, k):
    x = np.array([[np.nan if v is None else v for v in row] for row in data], dtype=float)
    out = x.copy()
    for i, t in zip(*np.where(np.isnan(x))):
        found = []
        for j in range(len(x)):
            both = ~np.isnan(x[i]) & ~np.isnan(x[j])
            if not np.isnan(x[j, t]) and both.any():
                found.append((((x[i] - x[j])[both] ** 2).sum() * x.shape[1] / both.sum(), x[j, t]))
        near = [v for _, v in sorted(found)[:k]]
        out[i, t] = np.mean(near) if near else np.nanmean(x[:, t])
    return out


@pytest.mark.parametrize("blocks", [(5000, 200000), (3, 10)])
def test_knn_matches_brute_force(spark, blocks):
    rnd = random.Random(11)
    pool = [0.0, 1.0, 2.0, 3.0, 5.0, 8.0]
    data = [tuple(None if rnd.random() < 0.15 else rnd.choice(pool) for _ in range(3)) for _ in range(80)] + [(None, None, None), (1.0, 1.0, 1.0)] * 3
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "id int, a double, b double, c double")
    got = np.array([list(r)[1:] for r in knn_impute(df, ["a", "b", "c"], 5, *blocks).orderBy("id").collect()], dtype=float)
    assert np.allclose(got, brute_knn(data, 5))


def test_knn_leaves_far_cells_unvisited(spark):
    rnd = random.Random(12)
    data = [[rnd.random() * 100 for _ in range(3)] for _ in range(3000)]
    for row in data[:60]:
        row[rnd.randrange(3)] = None
    for row in data[60:90]:
        row[0] = row[1] = None
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "id int, a double, b double, c double")
    trace = {}
    got = np.array([list(r)[1:] for r in knn_impute(df, ["a", "b", "c"], 5, cell_rows=20, trace=trace).orderBy("id").collect()], dtype=float)
    want = brute_knn_some(data, 5, range(90))
    assert np.allclose(got, want)
    assert trace["probes"] == 90 and trace["cells"] > 60
    # most pairs of a probe and a cell are never looked at
    assert trace["visited"] < 0.4 * trace["probes"] * trace["cells"]


def brute_knn_some(data, k, which):
    x = np.array([[np.nan if v is None else v for v in row] for row in data], dtype=float)
    out = x.copy()
    for i in which:
        for t in np.flatnonzero(np.isnan(x[i])):
            both = ~np.isnan(x) & ~np.isnan(x[i])
            ok = ~np.isnan(x[:, t]) & both.any(1)
            dist = np.where(both, (x - x[i]) ** 2, 0).sum(1) * x.shape[1] / np.maximum(both.sum(1), 1)
            near = sorted(zip(dist[ok], x[ok, t]))[:k]
            out[i, t] = np.mean([v for _, v in near]) if near else np.nanmean(x[:, t])
    return out


def test_knn_without_donors(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, 4.0)], "id int, a double, b double")
    assert [tuple(r) for r in knn_impute(df, ["a", "b"]).orderBy("id").collect()] == [(1, None, 4.0), (2, None, 4.0)]
    assert knn_impute(df.where("id > 5"), ["a", "b"]).count() == 0


def test_percentiles_see_each_distinct_value_once(spark, monkeypatch):
    """What is written and searched grows with the distinct values of a group, not with its rows (F12, F13)."""
    from touchline.operators import stats

    kept, write = [], stats.stage
    monkeypatch.setattr(stats, "stage", lambda df, name="stage": kept.append((name, df.count())) or write(df, name))
    df = spark.range(4000).selectExpr("id % 2 as k", "case when id % 5 = 0 then null else double(id % 7) end as x")
    want = {r[0]: r[1] for r in df.groupBy("k").agg(F.percentile("x", 0.5)).collect()}
    for direct in (100_000, 50):
        kept.clear()
        assert {r["k"]: r["m"] for r in group_percentiles(df, ["k"], "x", {"m": 0.5}, direct=direct).collect()} == want
        assert dict(kept)["values"] == 14

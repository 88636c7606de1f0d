import math
import random

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from touchline.learning.cluster import (
    LINES, best_clustering, fit_strategies, formation_lines, pca_plane, silhouette, squared_silhouette, standardised, with_strategies,
)
from touchline.learning.rules import association_rules, basket, most_significant, pair_rules
from touchline.learning.train import (
    class_metrics, evaluate_regression, feature_pipeline, importances, linear_model, regression_grids,
    regression_metrics, runtime_by_fraction, slot_names, stable_split, train_classifiers, train_regressors,
)


def test_standardised_by_weight(spark):
    df = spark.createDataFrame([(1.0, 3), (4.0, 1)], "x double, n int")
    got = sorted(r[0] for r in standardised(df, ["x"], "n").select("x").collect())
    xs = np.array([1.0, 1, 1, 4])
    assert np.allclose(got, sorted({round(v, 9) for v in (xs - xs.mean()) / xs.std()}))
    flat = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert {r[0] for r in standardised(flat, ["x"]).collect()} == {0.0}


FORMATIONS = ["5-4-1"] * 30 + ["5-3-2"] * 20 + ["4-4-2"] * 25 + ["3-4-3"] * 20 + ["4-3-3"] * 30


def test_strategies_follow_the_attackers(spark):
    data = [(i, f, FORMATIONS[-1 - i]) for i, f in enumerate(FORMATIONS)] + [(999, None, "5-4-1")]
    df = spark.createDataFrame(data, "id int, fh string, fa string")
    out = with_strategies(df, {"fh": "sh", "fa": "sa"}, ("low", "mid", "high"))
    by = {(r["fh"], r["sh"]) for r in out.collect()}
    attackers = {}
    for f, name in by:
        if f:
            attackers.setdefault(name, []).extend([int(f[-1])] * (FORMATIONS.count(f)))
    means = [sum(attackers[n]) / len(attackers[n]) for n in ("low", "mid", "high")]
    assert means == sorted(means) and dict(by)["5-4-1"] == "low"
    assert dict(by)[None] == dict(by)["4-4-2"]  # NULL reads as the default line-up
    assert out.count() == len(data) and len(by) == 6
    model, labels = fit_strategies(df, ["fh", "fa"])
    assert labels.agg(F.sum("n")).collect()[0][0] == 2 * len(FORMATIONS) + 1


def brute_silhouette(points, labels):
    x = np.array(points, dtype=float)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    total = 0.0
    for i, c in enumerate(labels):
        own = [j for j, o in enumerate(labels) if o == c and j != i]
        if not own:
            continue
        a = d[i, own].mean()
        b = min(d[i, [j for j, o in enumerate(labels) if o == z]].mean() for z in set(labels) - {c})
        total += (b - a) / max(a, b) if max(a, b) else 0.0
    return total / len(labels)


@pytest.mark.parametrize("block", [5000, 4])
def test_silhouette_matches_brute_force(spark, block):
    rnd = random.Random(2)
    pts = [tuple(float(rnd.randrange(6)) for _ in LINES) for _ in range(60)]
    labels = [rnd.choice("xy") for _ in pts[:-1]] + ["z"]
    df = spark.createDataFrame([(*p, c) for p, c in zip(pts, labels)], "defenders double, midfielders double, attackers double, c string")
    assert silhouette(df, LINES, "c", block).collect()[0][0] == pytest.approx(brute_silhouette(pts, labels))


def test_pca_keeps_most_variance(spark):
    df = formation_lines(spark.createDataFrame([(f,) for f in FORMATIONS], "f string"), "f")
    out = pca_plane(df, LINES).agg(F.var_pop("pc1"), F.var_pop("pc2")).collect()[0]
    assert out[0] >= out[1] and out[0] + out[1] == pytest.approx(3.0, abs=0.2)


def test_rules(spark):
    pairs = [("4-3-3", 4)] * 6 + [("4-3-3", 1)] * 4 + [("5-4-1", 1)] * 9 + [("5-4-1", 4)] * 1 + [(None, 4)]
    df = spark.createDataFrame(pairs, "f string, g int")
    got = {(r["antecedent"], r["consequent"]): r for r in pair_rules(df, "f", "g").collect()}
    r = got["4-3-3", "4"]
    assert (r["support_a"], r["support_c"], r["support"], r["confidence"]) == (0.5, 0.35, 0.3, 0.6)
    assert r["leverage"] == pytest.approx(0.125) and r["zhang"] == pytest.approx(0.125 / max(0.3 * 0.5, 0.5 * 0.05))
    assert r["conviction"] == pytest.approx(0.65 / 0.4) and got["5-4-1", "4"]["zhang"] < 0
    fp = {
        (x["antecedent"], x["consequent"]): x
        for x in association_rules(df.where("f is not null").select(basket(F.col("f"), F.col("g")).alias("items")), "items").collect()
    }
    assert set(fp) == set(got)
    for key, x in fp.items():
        assert all(math.isclose(x[c], got[key][c], abs_tol=1e-9) for c in ("support", "confidence", "lift", "zhang"))
    independent = spark.createDataFrame([(a, b) for a in "pq" for b in (1, 2)] * 5, "f string, g int")
    assert all(abs(x["zhang"]) < 1e-12 for x in pair_rules(independent, "f", "g").collect())
    top = most_significant(pair_rules(df, "f", "g")).collect()[0]
    assert abs(top["zhang"]) == max(abs(x["zhang"]) for x in got.values())


@pytest.fixture(scope="module")
def table(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(400):
        x, c = rnd.random(), rnd.choice(["a", "a", "b"])
        y = 3 * x + (1 if c == "b" else 0) + rnd.gauss(0, 0.1)
        rows.append((i, x, rnd.random(), c, y, "home" if y > 2 else "away" if y < 1 else "draw"))
    return spark.createDataFrame(rows, "id int, x double, noise double, c string, y double, outcome string")


def test_features_and_slots(table):
    out = feature_pipeline(["x", "noise"], ["c"]).fit(table).transform(table)
    names = slot_names(out)
    assert names[:2] == ["x", "noise"] and [n for n in names if n.endswith(("_a", "_b"))] == names[2:4]


def test_unseen_category_and_missing_number(spark, table):
    fitted = feature_pipeline(["x", "noise"], ["c"], impute=True, scale=True).fit(table)
    odd = spark.createDataFrame([(None, 0.5, "zzz")], "x double, noise double, c string")
    assert fitted.transform(odd).count() == 1


def test_training_finds_the_signal(table):
    train, test = stable_split(table, ["id"])
    assert train.count() + test.count() == 400 and 280 < train.count() < 360
    grids = {k: v for k, v in regression_grids().items() if k != "LinearRegression"}
    fitted = {f.name: f for f in train_regressors(train, test, "y", ["x", "noise"], ["c"], grids, folds=2)}
    assert fitted["RandomForest"].metrics["r2"] > 0.8 and fitted["DecisionTree"].metrics["rmse"] < 0.5
    assert fitted["RandomForest"].importances[0][0] == "x"
    linear = LinearRegression(maxIter=5)
    assert importances(linear, ["x"]) == []


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 2.0)], "label double, prediction double")
    ours = regression_metrics(df, "label", "prediction").collect()[0].asDict()
    theirs = evaluate_regression(df)
    assert all(ours[m] == pytest.approx(theirs[m]) for m in theirs) and ours["r2"] == pytest.approx(0.0)
    perfect = df.select("label", F.col("label").alias("prediction"))
    assert regression_metrics(perfect, "label", "prediction").collect()[0]["rmse"] == 0.0
    c = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b")], "y string, p string")
    m = class_metrics(c, "y", "p").collect()[0]
    assert m["accuracy"] == pytest.approx(2 / 3) and m["weighted_precision"] == pytest.approx((1 * 2 + 0.5 * 1) / 3) and m["weighted_recall"] == pytest.approx(2 / 3)


def test_linear_model(table):
    terms, rows = linear_model(table, "y", ["x"], ["c"])
    t = {r["term"]: r for r in terms.collect()}
    assert t["x"]["estimate"] == pytest.approx(3.0, abs=0.1) and t["x"]["p_value"] < 1e-6
    assert len(t) == 3 and abs(rows.agg(F.avg("residual")).collect()[0][0]) < 1e-6


def test_classifiers_and_runtime(table):
    train, test = stable_split(table, ["id"])
    scores = {r["model"]: r["accuracy"] for r in train_classifiers(train, test, "outcome", ["x", "noise"], ["c"]).collect()}
    assert set(scores) == {"NeuralNetwork", "DecisionTree", "RandomForest", "LogisticRegression"} and scores["DecisionTree"] > 0.7
    grids = {"LinearRegression": (LinearRegression(maxIter=5), [{}])}
    report = runtime_by_fraction(table, ["y"], ["x"], ["c"], (0.5, 1.0), grids=grids).collect()
    assert [r["fraction"] for r in report] == [0.5, 1.0] and report[1]["rows"] == 400 and report[0]["rows"] < 400


def test_clustering_finds_the_cheapest_division(spark):
    rnd = random.Random(6)
    for trial in range(4):
        points = sorted({(float(rnd.randrange(5)), float(rnd.randrange(5))) for _ in range(8)})
        weights = [rnd.randrange(1, 9) for _ in points]
        df = spark.createDataFrame([(*p, w) for p, w in zip(points, weights)], "x double, y double, n int")
        got = best_clustering(df, ["x", "y"], "n", 3)
        x, w = np.array(points), np.array(weights, float)

        def cost(own):
            return sum(w[i] * ((x[i] - np.average(x[own == own[i]], axis=0, weights=w[own == own[i]])) ** 2).sum() for i in range(len(x)))

        ways = (np.array([(code // 3**i) % 3 for i in range(len(x))]) for code in range(3 ** len(x)))
        assert got.cost == pytest.approx(min(map(cost, ways)))
        # each centre is the mean of the points nearest to it
        own = ((x[:, None] - np.array(got.centres)[None]) ** 2).sum(2).argmin(1)
        assert all(np.allclose(got.centres[c], np.average(x[own == c], axis=0, weights=w[own == c])) for c in set(own))
    assert best_clustering(df.where("n > 100"), ["x", "y"], "n", 3).cost == 0.0


def test_squared_silhouette_over_rows(spark):
    rnd = random.Random(7)
    pts = [(float(rnd.randrange(4)), float(rnd.randrange(4)), rnd.choice([0, 1, 2]), rnd.randrange(1, 4)) for _ in range(25)] + [(9.0, 9.0, 3, 1)]
    df = spark.createDataFrame(pts, "x double, y double, prediction int, n int").withColumn("features", F.array("x", "y"))
    rows = [(p[:2], p[2]) for p in pts for _ in range(p[3])]
    x, labels = np.array([r[0] for r in rows]), [r[1] for r in rows]
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    total = 0.0
    for i, c in enumerate(labels):
        mine = [j for j, o in enumerate(labels) if o == c and j != i]
        if mine:
            a, b = d[i, mine].mean(), min(d[i, [j for j, o in enumerate(labels) if o == z]].mean() for z in set(labels) - {c})
            total += (b - a) / max(a, b) if max(a, b) else 0.0
    assert squared_silhouette(df, weight="n").first()[0] == pytest.approx(total / len(rows))


def _both(table, grids, folds=3):
    """Our models and MLlib's on the same rows, by name."""
    train, test = stable_split(table, ["id"])
    ours = {f.name: f for f in train_regressors(train, test, "y", ["x", "noise"], ["c"], grids, folds)}
    prepared = feature_pipeline(["x", "noise"], ["c"]).fit(train)
    label = F.col("y").alias("label")
    fit_on, score_on = (prepared.transform(d).select("features", label) for d in (train, test))
    theirs = {}
    for name, (estimator, grid) in grids.items():
        model = estimator.fit(fit_on, grid[0] if grid else {})
        theirs[name] = (evaluate_regression(model.transform(score_on)), importances(model, slot_names(fit_on)))
    return ours, theirs


def test_trees_are_those_of_mllib(table):
    from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor

    dt, deep = DecisionTreeRegressor(seed=1, maxDepth=4), DecisionTreeRegressor(seed=1, maxDepth=9, maxBins=64)
    # no deeper: among few rows splits of equal gain are common, and rounding picks one
    grids = {"tree": (dt, [{}]), "more bins": (deep, [{deep.maxDepth: 3}]), "boosted": (GBTRegressor(seed=1, maxIter=5, maxDepth=3), [])}
    ours, theirs = _both(table, grids)
    for name, (metrics, shares) in theirs.items():
        assert ours[name].metrics == pytest.approx(metrics, rel=1e-6), name
        assert dict(ours[name].importances) == pytest.approx(dict(shares), abs=1e-6), name


def test_the_shallower_trees_of_a_grid_are_those_of_the_deepest(spark):
    from touchline.learning.trees import Column, TreeModel, Trees

    columns = [Column(0, 1, np.array([0.5, 1.5])), Column(1, 2, None)]
    trees = Trees.empty(columns, 1, 2)
    trees.column[0, 1], trees.cut[0, 1], trees.mean[0, 1:4] = 0, 0, [5.0, 1.0, 9.0]
    trees.column[0, 3], trees.cut[0, 3], trees.mean[0, 6:8] = 1, 1, [8.0, 10.0]
    x = np.array([[0, 1, 2, 2], [1, 1, 0, 2]], np.uint8)
    assert [TreeModel(trees, np.ones(1), d, 3, 32).predict(x).tolist() for d in range(3)] == [[5.0] * 4, [1.0, 9.0, 9.0, 9.0], [1.0, 10.0, 8.0, 8.0]]


def test_passes_over_the_rows_do_not_grow_with_the_grid(spark, table):
    """All folds and settings of a forest grow in one job a level: before, each setting of each fold had its own passes."""
    from pyspark.ml.regression import RandomForestRegressor
    from pyspark.ml.tuning import ParamGridBuilder

    from touchline.learning import trees

    rf = RandomForestRegressor(numTrees=3, seed=5)
    grid = ParamGridBuilder().addGrid(rf.maxDepth, [2, 4]).addGrid(rf.maxBins, [8, 16]).build()
    passes, level = [], trees._level
    trees._level = lambda *a: passes.append(a[2]) or level(*a)
    try:
        train, test = stable_split(table, ["id"])
        fitted, = train_regressors(train, test, "y", ["x", "noise"], ["c"], {"RandomForest": (rf, grid)}, folds=2)
    finally:
        trees._level = level
    assert 0 < len(passes) <= 8 and fitted.metrics["r2"] > 0.5


def test_classification_trees_from_counts(spark, monkeypatch):
    # the two tree classifiers aren't fitted by passes over single rows any more
    def refused(self, df, params=None):
        raise AssertionError("fitted row by row")

    monkeypatch.setattr("pyspark.ml.classification.DecisionTreeClassifier.fit", refused)
    monkeypatch.setattr("pyspark.ml.classification.RandomForestClassifier.fit", refused)
    rnd = random.Random(8)
    rows = []
    for _ in range(600):
        x, c = rnd.randrange(8), rnd.choice("uvw")
        rows.append((float(x), c, "win" if c == "u" and x > 3 else "loss" if x > 5 else "draw"))
    train = spark.createDataFrame([*rows, (1.0, "u", None)], "x double, c string, y string")
    test = spark.createDataFrame([*rows[:100], (2.0, None, "draw"), (2.0, "z", "draw"), (2.0, "v", "other")], "x double, c string, y string")
    got = {r["model"]: r for r in train_classifiers(train, test, "y", ["x"], ["c"]).collect()}
    assert got["DecisionTree"]["accuracy"] == pytest.approx(102 / 103) and got["DecisionTree"]["weighted_recall"] == pytest.approx(102 / 103)
    assert got["RandomForest"]["accuracy"] > 0.7


def test_split_by_gini(spark):
    from touchline.learning.trees import Blocks, blocks, columns_of, confusions, fit_classes

    y = [0, 0, 0, 1, 1, 2]
    df = spark.createDataFrame([([float(i), float(i % 2)], float(k), 0) for i, k in enumerate(y)], "x array<double>, label double, fold int").coalesce(1)
    columns = columns_of(np.array([[i, i % 2] for i in range(6)], float), [1], 32, indexed=True)
    data = blocks(df, {32: columns}, 2, 6)
    assert isinstance(data, Blocks)
    model = fit_classes(data, 3, 1, 32, 1, 0)
    t = model.trees
    # the number is cut between 2 and 3: Gini times rows falls from 22/6 to 4/3
    assert t.column[0, 1] == 0 and t.cut[0, 1] == 2 and t.gain[0, 1] == pytest.approx(22 / 6 - 4 / 3)
    assert np.allclose(t.mean[0, 1:4], [[1 / 2, 1 / 3, 1 / 6], [1, 0, 0], [0, 2 / 3, 1 / 3]])
    assert confusions(data, [model]) == [{(0.0, 0.0): 3, (1.0, 1.0): 2, (2.0, 1.0): 1}]


def test_classification_tree_as_mllib(spark):
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import StringIndexer

    from touchline.learning.train import evaluate_classes, feature_pipeline

    rnd = random.Random(11)
    rows = []
    for _ in range(4000):
        a, b, c, d = rnd.random(), rnd.gauss(0, 1), rnd.choice("pqrs"), rnd.choice("uv")
        score = a + (b > 0.3) + (c == "q") * (d == "u") + rnd.gauss(0, 0.5)
        rows.append((a, b, c, d, "win" if score > 1.4 else "draw" if score > 0.7 else "loss"))
    df = spark.createDataFrame(rows, "a double, b double, c string, d string, y string")
    train, test = df.where("a * 10 % 1 < 0.7"), df.where("a * 10 % 1 >= 0.7")
    ours = next(r for r in train_classifiers(train, test, "y", ["a", "b"], ["c", "d"]).collect() if r["model"] == "DecisionTree")
    index = StringIndexer(inputCol="y", outputCol="label").fit(train)
    prepared = feature_pipeline(["a", "b"], ["c", "d"]).fit(train)
    model = DecisionTreeClassifier(seed=42).fit(prepared.transform(index.transform(train)))
    theirs = evaluate_classes(model.transform(prepared.transform(index.transform(test))))
    assert ours["accuracy"] == pytest.approx(theirs["accuracy"]) and ours["weighted_precision"] == pytest.approx(theirs["weightedPrecision"])

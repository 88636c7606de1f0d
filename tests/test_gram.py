import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from touchline.learning import gram


@pytest.fixture(scope="module")
def table(spark):
    rnd = random.Random(8)
    rows = []
    for i in range(900):
        a, b, c = rnd.gauss(2000, 3), rnd.random() * 50000, float(rnd.random() < 0.3)
        rows.append((i, a, b, c, 1.0, 0.4 * (a - 2000) + b / 20000 + 1.5 * c + rnd.gauss(0, 1)))
    rows += [(900, 1.0, 1.0, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, flat double, y double").repartition(3)
    return VectorAssembler(inputCols=["a", "b", "c", "flat"], outputCol="features").transform(df)


GRID = [(r, m) for r in (0.1, 0.01) for m in (0.0, 0.5, 1.0)]


def arrays(df):
    rows = df.where("y is not null").orderBy("id").collect()
    return np.array([r["features"].toArray() for r in rows]), np.array([r["y"] for r in rows]), [r["id"] for r in rows]


def test_one_scan_gives_every_fold(table):
    sums = gram.sums_by_group(table, "y", F.col("id") % 3, 3)
    x, y, ids = arrays(table)
    for fold in range(3):
        keep = np.array([i % 3 == fold for i in ids])
        m = np.hstack([np.ones((keep.sum(), 1)), np.column_stack([x, y])[keep] - sums.origin])
        assert np.allclose(sums.groups[fold], m.T @ m)


def test_least_squares_equals_normal_equations(table):
    sums = gram.sums_by_group(table, "y", F.lit(0), 1)
    fit = gram.solve(sums.total, sums.origin)
    x, y, _ = arrays(table)
    want = np.linalg.lstsq(np.column_stack([x[:, :3], np.ones(len(x))]), y, rcond=None)[0]
    assert np.allclose([*fit.coefficients[:3], fit.intercept], want, rtol=1e-6) and fit.coefficients[3] == 0
    assert fit.rmse(sums.total, sums.origin) == pytest.approx(np.sqrt(np.mean((y - x[:, :3] @ want[:3] - want[3]) ** 2)))


@pytest.mark.parametrize(("penalty", "mixing"), GRID)
def test_elastic_net_equals_mllib(table, penalty, mixing):
    known = table.where("y is not null")
    model = LinearRegression(labelCol="y", regParam=penalty, elasticNetParam=mixing, maxIter=500, tol=1e-12).fit(known)
    sums = gram.sums_by_group(table, "y", F.lit(0), 1)
    fit = gram.solve(sums.total, sums.origin, penalty, mixing)
    assert np.allclose(fit.coefficients, model.coefficients.toArray(), rtol=1e-4, atol=1e-7)
    assert fit.intercept == pytest.approx(model.intercept, rel=1e-4)


def test_search_scores_the_rows_left_out(table):
    scores, fit, best = gram.linear_search(table, "y", F.col("id") % 3, 3, GRID)
    x, y, ids = arrays(table)
    got = {(r.penalty, r.mixing, r.fold): r for r in scores.collect()}
    assert len(got) == 18 and sum(got[0.1, 0.0, f].rows for f in range(3)) == len(y)
    for penalty, mixing in ((0.1, 0.0), (0.01, 1.0)):
        for fold in range(3):
            keep = np.array([i % 3 != fold for i in ids])
            m = np.hstack([np.ones((keep.sum(), 1)), np.column_stack([x, y])[keep]])
            other = gram.solve(m.T @ m, np.zeros(5), penalty, mixing)
            error = y[~keep] - x[~keep] @ other.coefficients - other.intercept
            assert got[penalty, mixing, fold].rmse == pytest.approx(np.sqrt(np.mean(error**2)), rel=1e-6)
    means = {g: np.mean([got[*g, f].rmse for f in range(3)]) for g in GRID}
    assert best == min(means, key=means.get)
    shown = gram.predicted(table, fit).where("y is not null").orderBy("id").collect()
    assert np.allclose([r["prediction"] for r in shown], x @ fit.coefficients + fit.intercept)


def test_curve_over_nested_samples(table):
    draw = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0
    train, test = table.where("id % 5 != 0"), table.where("id % 5 = 0")
    curve = gram.learning_curve(train, "y", draw, (1.0, 0.1, 0.3), gram.fold_of(3, F.col("id")), 3, GRID, test)
    assert [f for f, _, _ in curve] == [0.1, 0.3, 1.0]
    for fraction, rows, rmse in curve:
        part = train.where(draw < fraction)
        assert rows == part.where("y is not null").count()
        _, fit, _ = gram.linear_search(part, "y", gram.fold_of(3, F.col("id")), 3, GRID)
        error = gram.predicted(test.where("y is not null"), fit).agg(F.sqrt(F.avg((F.col("y") - F.col("prediction")) ** 2))).first()[0]
        assert rmse == pytest.approx(error, rel=1e-6)


def test_no_rows(table):
    assert gram.learning_curve(table.where("id < 0"), "y", F.lit(0.0), (1.0,), F.lit(0), 1, GRID, table) == [(1.0, 0, pytest.approx(float("nan"), nan_ok=True))]

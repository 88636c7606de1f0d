import numpy as np
import pytest

from touchline.learning.silhouette import silhouette_within


def brute(x, labels):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    total = 0.0
    kinds = sorted(set(labels))
    of = np.array(labels)
    for i in range(len(x)):
        mine = (of == of[i]).sum()
        if mine > 1:
            a = d[i, of == of[i]].sum() / (mine - 1)
            b = min(d[i, of == c].mean() for c in kinds if c != of[i])
            total += (b - a) / max(a, b) if max(a, b) else 0.0
    return total / len(x)


@pytest.mark.parametrize(("cell_rows", "spread"), [(16, 0.2), (8, 2.0)])
def test_within_the_tolerance_and_below_all_pairs(spark, cell_rows, spread):
    rng = np.random.default_rng(4)
    centres = np.array([[0, 0], [3, 0], [1, 4]])
    labels = rng.integers(0, 3, 3000).tolist()
    x = centres[labels] + rng.normal(size=(3000, 2)) * spread + 1e6
    labels[0] = 9
    df = spark.createDataFrame([(float(a), float(b), c) for (a, b), c in zip(x, labels)] + [(None, 1.0, 1)], "a double, b double, c int")
    trace = {}
    row = silhouette_within(df, ["a", "b"], "c", 0.01, cell_rows, trace).first()
    assert abs(row["silhouette"] - brute(x, labels)) <= row["error"] + 1e-9
    assert row["error"] <= 0.01
    assert trace["points"] == 3000 and trace["worked"] < 0.5 * trace["pairs"]


def test_repeated_points_and_few_clusters(spark):
    rows = [(0.0, 0.0, "x")] * 30 + [(1.0, 0.0, "x")] * 5 + [(5.0, 5.0, "y")] * 40 + [(0.0, 0.0, "y")] * 2
    df = spark.createDataFrame(rows, "a double, b double, c string")
    row = silhouette_within(df, ["a", "b"], "c").first()
    assert row["silhouette"] == pytest.approx(brute(np.array([r[:2] for r in rows]), [r[2] for r in rows]), abs=row["error"] + 1e-9)
    assert tuple(silhouette_within(df.where("c = 'x'"), ["a", "b"], "c").first()) == (0.0, 0.0)
    assert silhouette_within(df.where("c = 'z'"), ["a", "b"], "c").count() == 0


def test_work_grows_with_the_points(spark):
    rng = np.random.default_rng(5)
    worked = []
    for n in (3000, 12000):
        x, labels = rng.normal(size=(n, 2)) * [1, 5], rng.integers(0, 2, n)
        x[: n // 50] *= 40
        trace = {}
        df = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(x, labels)], "a double, b double, c int")
        row = silhouette_within(df, ["a", "b"], "c", 0.01, 8, trace).first()
        assert row["error"] <= 0.01
        worked.append(trace["worked"] / n)
        if n == 3000:
            assert abs(row["silhouette"] - brute(x, labels.tolist())) <= row["error"] + 1e-9
    assert worked[1] < 1000 and worked[1] < 2.5 * worked[0]

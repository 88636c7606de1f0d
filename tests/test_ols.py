import math
import random

import numpy as np
import pytest

from touchline.learning import ols
from touchline.learning.ols import absorbed_least_squares, incomplete_beta, two_sided_p
from touchline.session import stage


def test_p_values():
    # two-sided points of Student's distribution from printed tables
    for t, freedom, p in ((12.706, 1, 0.05), (2.228, 10, 0.05), (3.169, 10, 0.01), (1.960, 10**7, 0.05), (0.0, 5, 1.0)):
        assert two_sided_p(t, freedom) == pytest.approx(p, abs=2e-4)
    assert two_sided_p(1.0, 1) == pytest.approx(0.5) and two_sided_p(-40.0, 30) < 1e-20
    assert incomplete_beta(2, 3, 0.4) == pytest.approx(sum(math.comb(4, k) * 0.4**k * 0.6 ** (4 - k) for k in (2, 3, 4)))


def made(rng, n, clubs):
    rows = []
    for i in range(n):
        h, a = rng.randrange(clubs), rng.randrange(clubs)
        x, z, c = rng.gauss(2000, 2), rng.random() * 1e5, rng.choice("pqr")
        y = 0.3 * x + z / 3e4 + (c == "q") + h * 0.1 - a * 0.2 + rng.gauss(0, 1)
        rows.append((i, h, a, x, z, 2 * x - 1, c, y, rng.gauss(0, 1) + x / 4))
    return rows


def explicit(rows, label, factors):
    one = lambda values: [v for v in sorted(set(values))[1:]]
    cols = [np.array([r[3] for r in rows]), np.array([r[4] for r in rows])]
    cols += [np.array([float(r[6] == v) for r in rows]) for v in one([r[6] for r in rows])]
    for f in factors:
        cols += [np.array([float(r[f] == v) for r in rows]) for v in one([r[f] for r in rows])]
    m = np.column_stack([*cols, np.ones(len(rows))])
    y = np.array([r[label] for r in rows])
    beta, _, rank, _ = np.linalg.lstsq(m / np.abs(m).max(0), y, rcond=1e-11)
    beta = beta / np.abs(m).max(0)
    freedom = len(y) - rank
    error = y - m @ beta
    inverse = np.linalg.pinv((m / np.abs(m).max(0)).T @ (m / np.abs(m).max(0)), rcond=1e-12) / np.outer(np.abs(m).max(0), np.abs(m).max(0))
    return beta[:4], np.sqrt(error @ error / freedom * np.diag(inverse)[:4]), freedom, error


SCHEMA = "id int, h int, a int, x double, z double, twice double, c string, y double, w double"


@pytest.mark.parametrize("absorb", [[], ["h"], ["h", "a"]])
def test_equals_explicit_dummies(spark, absorb):
    rows = made(random.Random(3), 400, 9)
    df = spark.createDataFrame([*rows, (999, None, 1, 1.0, 1.0, 1.0, "p", 1.0, 1.0)], SCHEMA).where("h is not null or id = 999")
    df = df.na.drop("any") if not absorb else df
    out = absorbed_least_squares(df, ["y", "w"], ["x", "z", "twice"], ["c"], absorb, ["id"])
    for label, at in (("y", 7), ("w", 8)):
        beta, se, freedom, error = explicit(rows, at, [SCHEMA.split(", ").index(f"{f} int") for f in absorb])
        got = {r["term"]: r for r in out.terms.where(f"label = '{label}'").collect()}
        assert list(got) == ["x", "z", "twice", "c_q", "c_r"] or set(got) == {"x", "z", "twice", "c_q", "c_r"}
        assert got["twice"]["estimate"] is None  # determined by x
        for term, b, s in zip(("x", "z", "c_q", "c_r"), beta, se):
            assert got[term]["estimate"] == pytest.approx(b, rel=1e-6, abs=1e-9)
            assert got[term]["std_error"] == pytest.approx(s, rel=1e-6)
            assert got[term]["freedom"] == freedom and got[term]["n"] == len(rows)
            assert got[term]["p_value"] == pytest.approx(two_sided_p(b / s, freedom), abs=1e-9)
        shown = [r["residual"] for r in out.rows.where(f"label = '{label}'").orderBy("id").collect()]
        assert np.allclose(shown, error, atol=1e-6)


def test_clubs_that_never_meet(spark):
    """Two leagues without a common game free one parameter more."""
    rng = random.Random(5)
    rows = [(i, h + 50 * g, a + 50 * g, x, z, t, c, y, w) for g in (0, 1) for i, h, a, x, z, t, c, y, w in made(rng, 150, 6)]
    out = absorbed_least_squares(spark.createDataFrame(rows, SCHEMA), ["y"], ["x", "z"], ["c"], ["h", "a"])
    *_, freedom, _ = explicit(rows, 7, [1, 2])
    assert {r["freedom"] for r in out.terms.collect()} == {freedom}


def test_no_rows(spark):
    out = absorbed_least_squares(spark.createDataFrame([], SCHEMA), ["y"], ["x"], ["c"], ["h"])
    assert out.terms.count() == 0 and out.rows.count() == 0


def test_effects_settle_in_few_steps_and_leave_no_copies(spark, monkeypatch):
    """A chain of clubs, where alternating means would need thousands of sweeps; no stage may hold the rows' columns."""
    rng = random.Random(8)
    rows = []
    for i in range(240):
        h = i % 40
        a = h + (i // 40) % 2
        x, z = rng.gauss(0, 1) + h / 10, rng.random()
        rows.append((i, h, a, x, z, x, "p", 0.5 * x - z + 0.1 * h + rng.gauss(0, 1), 0.0))
    written = []
    monkeypatch.setattr(ols, "stage", lambda df, name="stage": written.append((name, df.columns)) or stage(df, name))
    out = absorbed_least_squares(spark.createDataFrame(rows, SCHEMA), ["y"], ["x", "z"], [], ["h", "a"], ["id"])
    got = {r["term"]: r for r in out.terms.collect()}
    beta, se, freedom, error = explicit(rows, 7, [1, 2])
    for term, b, s in zip(("x", "z"), beta, se):
        assert got[term]["estimate"] == pytest.approx(b, rel=1e-6) and got[term]["std_error"] == pytest.approx(s, rel=1e-6)
    assert np.allclose([r["residual"] for r in out.rows.orderBy("id").collect()], error, atol=1e-6)
    assert sum(n.startswith("effects-") for n, _ in written) < 120
    assert not any("id" in cols for n, cols in written if n != "regression")

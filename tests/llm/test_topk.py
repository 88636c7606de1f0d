import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.llm import topk as T

SCHEMA = "vec_id long, embedding array<double>, label string"


def brute(rows, every=5, k=5, scale=256):
    kept = []
    for i, x, *_ in rows:
        if i is None or x is None or any(c is None or not math.isfinite(c) or not math.isfinite(c * scale) for c in x):
            continue
        kept.append((i, tuple(math.floor(scale * c) for c in x)))
    out = []
    for q, x in sorted({r for r in kept if r[0] % every == 0}):
        found = sorted((-max(-(1 << 63), min((1 << 63) - 1, sum(a * b for a, b in zip(x, y)))), i) for i, y in kept if i != q)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(found, 1)]
    return sorted(out)


def run(spark, rows, **how):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(tuple(r) for r in T.top_k(frame, F.col("vec_id") % 5 == 0, **how).collect())


def made(rng, n, width, near):
    centres = [[rng.uniform(-1, 1) for _ in range(width)] for _ in range(8)]
    rows = []
    for i in range(n):
        c = rng.choice(centres)
        rows.append((i, [round(v + rng.gauss(0, near), 2) for v in c], "x"))
    return rows


@pytest.mark.parametrize(("near", "limits"), [(0.02, (4096, 8192, 1024)), (0.02, (7, 30, 4)), (1.0, (7, 30, 4))])
def test_equals_brute_force(spark, monkeypatch, near, limits):
    for name, value in zip(("QUERIES", "ROWS", "STEP"), limits):
        monkeypatch.setattr(T, name, value)
    rng = random.Random(4)
    rows = made(rng, 300, 6, near)
    rows += [(1000 + i, rows[3][1], "copy") for i in range(60)] + [(9, rows[9][1], "again")] * 3 + [(10, rows[10][1], "again"), (10, rows[11][1], "other")]
    rows += [(None, rows[1][1], "n"), (301, None, "n"), (305, [1.0, None], "n"), (306, [math.nan], "n"), (310, [math.inf, 1.0], "n"), (315, [], "e"), (320, [0.5, -0.25], "short"), (-5, [1e306] * 6, "far")]
    assert run(spark, rows) == brute(rows)


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(0, [2.0**22 + 1, 2.0**20], "x"), (1, [2.0**22 + 3, 2.0**21], "x"), (2, [2.0**22 + 3, 2.0**21 + 2.0**-8], "x"), (3, [1e20, -1e20], "x"), (4, [-1e20, 3.0], "x"), (5, [-1e20, 3.0], "x")]
    assert run(spark, rows, k=3) == brute(rows, k=3)


def test_few_rows_and_empty_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], "x"), (2, [1.0], "x")]) == []
    assert run(spark, [(0, [1.0], "x")]) == []
    assert run(spark, [(0, [1.0], "x"), (3, [-0.5], "x")]) == [(0, 1, 3, 256 * -128)]


def test_bounds_hold_and_exclude(spark):
    """On clustered vectors most cells of queries do without most vectors, and never without one of the best."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16)) * 100
    x = np.floor(centres[rng.integers(0, 12, 3000)] + rng.normal(size=(3000, 16)) * 5)
    cells = T.Cells(T.fit_pivots(x[:500], 12))
    q = x[::50]
    cell = cells.nearest(q)
    along, off = cells.reach(q)
    m = len(cells.pivots)
    cells.low, cells.high, cells.off = np.zeros(m), np.zeros(m), np.zeros(m)
    for c in np.unique(cell):
        own = along[cell == c, c]
        cells.low[c], cells.high[c], cells.off[c] = own.min(), own.max(), off[cell == c, c].max()
    cells.sure = T.sure_scores(cells, np.arange(0, 3000, 7), x[::7], 5)
    wanted = cells.wanted(x)[:, np.unique(cell)]
    score = q @ x.T
    score[np.arange(len(q)), np.arange(0, 3000, 50)] = -np.inf
    for i in range(len(q)):
        assert cells.wanted(x)[np.argsort(-score[i])[:5], cell[i]].all()
        assert (score[i] <= cells.at_most(x)[:, cell[i]]).all()
    assert wanted.mean() < 0.5

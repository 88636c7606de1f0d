"""Formation clustering, cluster quality and cluster profiles."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.formation import DEFAULT_LINES, formation_lenient
from touchline.functions.values import lookup
from touchline.operators.blocks import blockwise
from touchline.session import stage

LINES = ("defenders", "midfielders", "attackers")
#: Starts of k-means, and the distinct points that it may run over.
STARTS = 64
MOST_POINTS = 10_000
# Names of the clusters from the fewest to the most attackers.
STRATEGIES = ("Defensive", "Aggressive", "Offensive")
STRATEGIES_BALANCED = ("Defensive", "Balanced", "Aggressive")


def standardised(df: DataFrame, cols: Sequence[str], weight: str | None = None) -> DataFrame:
    """Columns centred and divided by the population deviation, rows counted by weight; NULL stays NULL.

    The mean comes first and the squares are those of the gaps to it, so that large values lose no digits.
    All columns share one aggregate, or two with weights.
    """
    numbers = {c: F.col(c).cast("double") for c in cols}
    both = lambda kind, of: F.struct(*[of(c, x).alias(c) for c, x in numbers.items()]).alias(kind)
    if weight is None:
        known = df.agg(F.struct(both("mean", lambda c, x: F.avg(x)), both("dev", lambda c, x: F.stddev_pop(x))).alias("known")).scalar()
        mean, dev = known["mean"], known["dev"]
    else:
        w = lambda x: F.when(x.isNotNull(), F.col(weight))
        mean = df.agg(both("mean", lambda c, x: F.sum(x * w(x)) / F.sum(w(x)))).scalar()
        spread = lambda c, x: F.sqrt(F.sum(F.pow(x - F.col("_mean")[c], F.lit(2.0)) * w(x)) / F.sum(w(x)))
        dev = df.withColumn("_mean", mean).agg(both("dev", spread)).scalar()
    gaps = {c: x - mean[c] for c, x in numbers.items()}
    return df.withColumns({c: F.when(g.isNotNull(), F.coalesce(F.try_divide(g, dev[c]), F.lit(0.0))) for c, g in gaps.items()})


def mllib_standardised(df: DataFrame, cols: Sequence[str], out: str = "scaled") -> DataFrame:
    """The same through the MLlib scaler (sample deviation)."""
    vec = VectorAssembler(inputCols=list(cols), outputCol="_vec").transform(df)
    scaler = StandardScaler(inputCol="_vec", outputCol=out, withMean=True, withStd=True)
    return scaler.fit(vec).transform(vec).drop("_vec")


def formation_lines(df: DataFrame, col: str) -> DataFrame:
    lines = formation_lenient(F.col(col))
    return df.withColumns({name: lines[i].cast("double") for i, name in enumerate(LINES)})


def formation_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct formations over the role columns, with their number of uses.

    NULL joins the default line-up, which must have a label but adds no weight.
    """
    default = "-".join(str(n) for n in DEFAULT_LINES)
    both = df.select(F.explode(F.array(*[F.col(c) for c in cols])).alias("_f"))
    return both.groupBy(F.coalesce("_f", F.lit(default)).alias("formation")).agg(F.count("_f").alias("n"))


@dataclass(frozen=True)
class Clustering:
    """Centres in the scaled space, and the weighted sum of squared distances to them."""

    centres: tuple[tuple[float, ...], ...]
    cost: float

    def clusterCenters(self) -> list[np.ndarray]:  # noqa: N802 - the name that fitted models have
        return [np.array(c) for c in self.centres]


def _lloyd(points: np.ndarray, weight: np.ndarray, k: int, seed: int, start: int, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Weighted k-means from one seeded start (spread by squared distance), then single moves while they pay."""
    rng = np.random.default_rng([seed, start])
    chosen = [int(rng.choice(len(points), p=weight / weight.sum()))]
    while len(chosen) < k:
        gap = ((points[:, None] - points[chosen][None]) ** 2).sum(2).min(1) * weight
        chosen.append(int(rng.choice(len(points), p=gap / gap.sum())) if gap.sum() > 0 else int(rng.integers(len(points))))
    centres = points[chosen].astype(float)
    for _ in range(rounds):
        own = ((points[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        moved = np.array([np.average(points[own == c], axis=0, weights=weight[own == c]) if weight[own == c].sum() else centres[c] for c in range(k)])
        if np.array_equal(moved, centres):
            break
        centres = moved
    own = ((points[:, None] - centres[None]) ** 2).sum(2)
    return centres, float((own.min(1) * weight).sum())


def best_clustering(points: DataFrame, cols: Sequence[str], weight: str, k: int, starts: int = STARTS, seed: int = 42) -> Clustering:
    """The cheapest of many seeded starts of weighted k-means over a short list of distinct points.

    The starts run in one job; each sees all points, of which there may be at most
    MOST_POINTS. Centres come in ascending order, whatever start they are from.
    """
    rows = points.select(*[F.col(c).cast("double") for c in cols], F.col(weight).cast("double")).limit(MOST_POINTS + 1).collect()
    if len(rows) > MOST_POINTS:
        raise ValueError(f"more than {MOST_POINTS} distinct points")
    held = np.array(sorted(tuple(r) for r in rows), float).reshape(len(rows), len(cols) + 1)
    x, w = held[:, :-1], held[:, -1]
    if not len(x):
        return Clustering(tuple((0.0,) * len(cols) for _ in range(k)), 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_lloyd(x, w, k, seed, start) for start in batch.column("id").to_pylist()]
            ordered = [sorted(map(tuple, c.tolist())) for c, _ in found]
            yield pa.RecordBatch.from_pydict({"cost": [c for _, c in found], "centres": ordered}, schema=pa.schema([("cost", pa.float64()), ("centres", pa.list_(pa.list_(pa.float64())))]))

    tried = points.sparkSession.range(starts).mapInArrow(run, "cost double, centres array<array<double>>")
    best = tried.orderBy(F.round("cost", 9), "centres").first()
    return Clustering(tuple(tuple(c) for c in best["centres"]), best["cost"])


def fit_strategies(df: DataFrame, cols: Sequence[str], k: int = 3, seed: int = 42) -> tuple[Clustering, DataFrame]:
    """K-means over the formations used, and the table of formations with cluster ids.

    The fit runs on distinct formations weighted by use, written once so that
    ``df`` is scanned once. Scaling uses the mean and deviation over all uses. Of
    the clusters nearest to a formation the first counts.
    """
    counts = stage(formation_counts(df, cols), "formations")
    scaled = stage(standardised(formation_lines(counts, "formation"), LINES, "n"), "scaled")
    merged = scaled.where("n > 0").groupBy(*LINES).agg(F.sum("n").alias("n"))
    model = best_clustering(merged, LINES, "n", k, seed=seed)
    gaps = [sum((F.pow(F.col(c) - F.lit(float(v)), F.lit(2.0)) for c, v in zip(LINES, centre, strict=True)), F.lit(0.0)) for centre in model.centres]
    nearest = F.array_min(F.array(*[F.struct(g.alias("gap"), F.lit(i).alias("id")) for i, g in enumerate(gaps)]))["id"]
    labelled = scaled.withColumn("features", array_to_vector(F.array(*LINES))).withColumn("prediction", nearest)
    return model, labelled.select("formation", "n", "features", "prediction")


def strategy_names(model: Clustering, names: Sequence[str] = STRATEGIES) -> Column:
    """Cluster id to name, by the attackers coordinate of the centres in rising order."""
    ranked = np.argsort([c[2] for c in model.clusterCenters()], kind="stable")
    return lookup(F.col("prediction"), {int(c): names[i] for i, c in enumerate(ranked)})


def with_strategies(
    df: DataFrame, roles: dict[str, str], names: Sequence[str] = STRATEGIES, seed: int = 42
) -> DataFrame:
    """Strategy columns from formation columns: {formation column: strategy column}."""
    model, labels = fit_strategies(df, list(roles), len(names), seed)
    default = "-".join(str(n) for n in DEFAULT_LINES)
    named = stage(labels.select("formation", strategy_names(model, names).alias("name")), "strategies")
    for src, out in roles.items():
        side = named.select(F.col("formation").alias("_f"), F.col("name").alias(out))
        df = df.withColumn("_f", F.coalesce(F.col(src), F.lit(default))).join(side, "_f", "left").drop("_f")
    return df


def pca_plane(df: DataFrame, cols: Sequence[str], k: int = 2) -> DataFrame:
    """First principal components of the standardised columns, as ``pc1``, ``pc2``...

    The greatest loading of a component (the first of equal ones) is positive.
    """
    vec = VectorAssembler(inputCols=list(cols), outputCol="_vec").transform(standardised(df, cols))
    model = PCA(k=k, inputCol="_vec", outputCol="_pc").fit(vec)
    loads = model.pc.toArray()
    turn = [float(np.sign(loads[np.argmax(np.round(np.abs(loads[:, i]), 9)), i]) or 1.0) for i in range(k)]
    out, parts = model.transform(vec), vector_to_array("_pc")
    return out.withColumns({f"pc{i + 1}": parts[i] * turn[i] for i in range(k)}).drop("_vec", "_pc")


def _distance_sums(points: pd.DataFrame, others: pd.DataFrame, cols: Sequence[str]) -> pd.DataFrame:
    """Per point and cluster, the weighted sum of distances to the other block."""
    q = points[list(cols)].to_numpy(dtype=float)
    out = []
    for cluster, part in others.groupby("_label"):
        d = part[list(cols)].to_numpy(dtype=float)
        w = part["_w"].to_numpy(dtype=float)
        sums = np.zeros(len(q))
        for start in range(0, len(d), 1000):
            gap = q[:, None, :] - d[None, start : start + 1000, :]
            sums += np.sqrt((gap * gap).sum(axis=2)) @ w[start : start + 1000]
        out.append(points.assign(_other=cluster, _size=w.sum(), _sum=sums))
    names = [*points.columns, "_other", "_size", "_sum"]
    return pd.concat(out, ignore_index=True)[names] if out else pd.DataFrame(columns=names)


def silhouette(df: DataFrame, cols: Sequence[str], label: str, block_rows: int = 5_000) -> DataFrame:
    """Mean silhouette with the Euclidean distance, exact, as one row.

    Works on distinct labelled points with their multiplicity; distances are
    summed per cluster inside block pairs and never kept.
    """
    points = df.select(*[F.col(c).cast("double").alias(c) for c in cols], F.col(label).cast("string").alias("_label"))
    points = points.groupBy(*cols, "_label").agg(F.count("*").cast("double").alias("_w"))
    fields = ", ".join(f"{c} double" for c in cols)
    sums = blockwise(
        points, points, lambda p, o: _distance_sums(p, o, cols),
        f"{fields}, _label string, _w double, _other string, _size double, _sum double",
        block_rows, block_rows,
    )
    per = sums.groupBy(*cols, "_label", "_w", "_other").agg(F.sum("_sum").alias("_sum"), F.sum("_size").alias("_size"))
    own = F.col("_label") == F.col("_other")
    ab = per.groupBy(*cols, "_label", "_w").agg(
        F.max(F.when(own, F.col("_size"))).alias("_n"),
        F.max(F.when(own, F.try_divide("_sum", F.col("_size") - 1))).alias("_a"),
        F.min(F.when(~own, F.col("_sum") / F.col("_size"))).alias("_b"),
    )
    s = F.when(F.col("_n") <= 1, 0.0).otherwise(
        F.coalesce(F.try_divide(F.col("_b") - F.col("_a"), F.greatest("_a", "_b")), F.lit(0.0))
    )
    return ab.agg(F.try_divide(F.sum(s * F.col("_w")), F.sum("_w")).alias("silhouette"))


def squared_silhouette(labelled: DataFrame, features: str = "features", weight: str | None = None, label: str = "prediction") -> DataFrame:
    """Mean silhouette with the squared distance over all rows a point stands for, as one row; one linear pass.

    The sum of squared distances to a cluster follows from its number of rows, the
    sum of their vectors and of their squares. A row alone in its cluster counts 0.
    """
    kind = labelled.schema[features].dataType.typeName()
    x = F.col(features) if kind == "array" else vector_to_array(features)
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    points = labelled.select(x.alias("_x"), w.alias("_w"), F.col(label).alias("_c")).where("_w > 0")
    square = lambda v: F.aggregate(v, F.lit(0.0), lambda a, b: a + b * b)
    long = points.select("_c", "_w", F.posexplode("_x").alias("_j", "_v"))
    sums = long.groupBy("_c", "_j").agg(F.sum(F.col("_v") * F.col("_w")).alias("_s"))
    vectors = sums.groupBy("_c").agg(F.transform(F.array_sort(F.collect_list(F.struct("_j", "_s"))), lambda p: p["_s"]).alias("_sum"))
    sizes = points.groupBy("_c").agg(F.sum("_w").alias("_n"), F.sum(square(F.col("_x")) * F.col("_w")).alias("_q"))
    table = sizes.join(vectors, "_c").agg(F.collect_list(F.struct("_c", "_n", "_q", "_sum")).alias("all")).scalar()
    each = points.withColumn("_k", table)
    product = lambda a, b: F.aggregate(F.zip_with(a, b, lambda u, v: u * v), F.lit(0.0), lambda u, v: u + v)
    apart = lambda k: F.greatest(k["_n"] * square(F.col("_x")) - 2 * product(F.col("_x"), k["_sum"]) + k["_q"], F.lit(0.0))
    own = F.filter("_k", lambda k: k["_c"] == F.col("_c"))
    other = F.filter("_k", lambda k: k["_c"] != F.col("_c"))
    each = each.withColumn("_n", own[0]["_n"]).withColumn("_a", F.try_divide(apart(own[0]), F.col("_n") - 1))
    each = each.withColumn("_b", F.array_min(F.transform(other, lambda k: apart(k) / k["_n"])))
    s = F.when(F.col("_n") <= 1, 0.0).otherwise(F.coalesce(F.try_divide(F.col("_b") - F.col("_a"), F.greatest("_a", "_b")), F.lit(0.0)))
    return each.agg(F.try_divide(F.sum(s * F.col("_w")), F.sum("_w")).alias("squared_silhouette"))

"""Model preparation, cross-validated training and evaluation with MLlib."""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.learning.gram import fold_of, learning_curve, linear_search
from touchline.learning.trees import Blocks, TreeModel, blocks, confusions, errors, fit_boosted, fit_classes, fit_grid, metrics_of, ways_of
from touchline.operators.relational import stable_draw

SEED = 42
ROWS_PER_TASK = 30_000


# --- splitting --------------------------------------------------------------


def random_split(df: DataFrame, train: float = 0.8, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    a, b = df.randomSplit([train, 1 - train], seed)
    return a, b


def stable_split(df: DataFrame, ids: Sequence[str], train: float = 0.8, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the ids: the same on any partitioning and after a retry."""
    draw: Column = stable_draw(seed, *[F.col(i) for i in ids])
    return df.where(draw < train), df.where(draw >= train)


# --- preparation ------------------------------------------------------------


def feature_pipeline(
    numeric: Sequence[str],
    categorical: Sequence[str],
    impute: bool = False,
    scale: bool = False,
) -> Pipeline:
    """Indexers, one-hot encoders and the assembler, as one unfitted pipeline.

    Everything is learnt by ``fit`` on the training rows. Categories not seen
    there share one extra slot. ``impute`` adds a median imputer for the numbers
    and ``scale`` standardises them. Without ``impute`` a NULL number is an error,
    as a row must not vanish from a fit or a score.
    """
    stages: list = []
    numbers = list(numeric)
    if impute and numbers:
        filled = [f"{c}_filled" for c in numbers]
        stages.append(Imputer(strategy="median", inputCols=numbers, outputCols=filled))
        numbers = filled
    if scale and numbers:
        stages.append(VectorAssembler(inputCols=numbers, outputCol="numbers", handleInvalid="error"))
        stages.append(StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True))
        numbers = ["scaled"]
    if categorical:
        index = [f"{c}_index" for c in categorical]
        vectors = [f"{c}_vec" for c in categorical]
        stages.append(
            StringIndexer(inputCols=list(categorical), outputCols=index, stringOrderType="frequencyDesc", handleInvalid="keep")
        )
        stages.append(OneHotEncoder(inputCols=index, outputCols=vectors))
        numbers = numbers + vectors
    stages.append(VectorAssembler(inputCols=numbers, outputCol="features", handleInvalid="error"))
    return Pipeline(stages=stages)


def slot_names(df: DataFrame, features: str = "features") -> list[str]:
    """Name of each vector slot, read from the column's metadata."""
    attrs = df.schema[features].metadata["ml_attr"]["attrs"]
    slots = [a for kind in attrs.values() for a in kind]
    return [a.get("name", str(a["idx"])) for a in sorted(slots, key=lambda a: a["idx"])]


# --- regression --------------------------------------------------------------


def regression_grids(seed: int = SEED) -> dict:
    """The three regressors with the parameter grids they are tuned over."""
    # The iterations, trees, depths, bins and penalties of the published models.
    lr = LinearRegression(maxIter=5)
    dt = DecisionTreeRegressor(seed=seed)
    rf = RandomForestRegressor(numTrees=10, seed=seed)
    return {
        "LinearRegression": (
            lr,
            ParamGridBuilder().addGrid(lr.regParam, [0.1, 0.01]).addGrid(lr.elasticNetParam, [0.0, 0.5, 1.0]).build(),
        ),
        "DecisionTree": (dt, ParamGridBuilder().addGrid(dt.maxDepth, [2, 5, 10]).build()),
        "RandomForest": (
            rf,
            ParamGridBuilder().addGrid(rf.maxDepth, [5, 10]).addGrid(rf.maxBins, [32, 64]).build(),
        ),
    }


def gradient_boosted(seed: int = SEED) -> dict:
    return {"GradientBoosted": (GBTRegressor(seed=seed), ParamGridBuilder().build())}


@dataclass
class Fitted:
    name: str
    model: object
    metrics: dict[str, float]
    importances: list[tuple[str, float]] = field(default_factory=list)


def evaluate_regression(predictions: DataFrame) -> dict[str, float]:
    return {m: RegressionEvaluator(metricName=m).evaluate(predictions) for m in ("rmse", "mae", "r2")}


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """RMSE, MAE and R² as one aggregate."""
    err = (F.col(label) - F.col(prediction)).cast("double")
    y = F.col(label).cast("double")
    return df.agg(
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        (1 - F.try_divide(F.sum(err * err), F.var_pop(y) * F.count(y))).alias("r2"),
    )


def importances(model, names: Sequence[str]) -> list[tuple[str, float]]:
    """Non-zero importances by slot name, greatest first."""
    values = getattr(model, "featureImportances", None)
    if values is None:
        return []
    pairs = [(names[i], float(v)) for i, v in zip(values.indices, values.values) if v]
    return sorted(pairs, key=lambda p: (-p[1], p[0]))


def spread(df: DataFrame) -> DataFrame:
    """Even partitions for training rows, which are cached and read by every fit.

    As many as the cluster shuffles into, but none so small that starting its
    task costs more than its work.
    """
    spark = df.sparkSession
    most = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(min(most, 1 + df.count() // ROWS_PER_TASK))


def _penalties(estimator, grid: Sequence[dict]) -> list[tuple[float, float]]:
    """(penalty, mixing) of each entry if the grid is one of a linear model's penalties only, else none."""
    if not isinstance(estimator, LinearRegression) or any({p.name for p in entry} - {"regParam", "elasticNetParam"} for entry in grid):
        return []
    of = lambda entry, param: float(entry.get(param, estimator.getOrDefault(param)))
    return [(of(e, estimator.regParam), of(e, estimator.elasticNetParam)) for e in grid]


def _tree_grid(estimator, grid: Sequence[dict]) -> list[tuple[int, int]]:
    """(depth, bins) of each entry if the estimator is a tree, forest or boosting with only these set, else none."""
    if not isinstance(estimator, DecisionTreeRegressor | RandomForestRegressor | GBTRegressor):
        return []
    own = {"seed", "numTrees", "maxDepth", "maxBins"}
    if any({p.name for p in entry} - own for entry in [*grid, {p: 0 for p in estimator.params if estimator.isSet(p)}]):
        return []
    if isinstance(estimator, GBTRegressor) and len(grid) > 1 or any(p.name == "numTrees" for entry in grid for p in entry):
        return []
    of = lambda entry, param: int(entry.get(param, estimator.getOrDefault(param)))
    return [(of(e, estimator.maxDepth), of(e, estimator.maxBins)) for e in grid or [{}]]


def _tree_blocks(fit_on: DataFrame, score_on: DataFrame, redrawn: int, groups: Sequence[int], grids: dict) -> tuple[Blocks, Blocks]:
    """Training and test rows as blocks, binned for every number of bins in the grids."""
    rows = fit_on.count()
    if redrawn:
        fit_on = fit_on.withColumn("fold", F.pmod(F.monotonically_increasing_id(), F.lit(redrawn)).cast("int"))
    ways = ways_of(fit_on, groups, sorted({most for grid in grids.values() for _, most in grid}), rows)
    width = fit_on.schema["features"].metadata["ml_attr"]["num_attrs"]
    return blocks(fit_on, ways, width, rows), blocks(score_on.withColumn("fold", F.lit(0)), ways, width, 0)


def _fit_trees(data: Blocks, estimator, grid: Sequence[tuple[int, int]], folds: int) -> TreeModel:
    seed = estimator.getSeed()
    if isinstance(estimator, GBTRegressor):
        (depth, most), = grid
        return fit_boosted(data, depth, most, estimator.getMaxIter(), estimator.getStepSize())
    return fit_grid(data, grid, estimator.getNumTrees() if isinstance(estimator, RandomForestRegressor) else 1, folds, seed)


def train_regressors(
    train: DataFrame,
    test: DataFrame,
    label: str,
    numeric: Sequence[str],
    categorical: Sequence[str],
    grids: dict | None = None,
    folds: int = 3,
    parallelism: int = 8,
    seed: int = SEED,
    impute: bool = False,
) -> list[Fitted]:
    """Tune each regressor by cross-validation on RMSE and score it on the test rows.

    The features are assembled once per target and cached for all fits. A grid of
    one entry is fitted with it; choosing among several needs at least two folds,
    which follow a hash of the rows. Penalties of the linear model are chosen from
    sums of products, in one scan for all of them and all folds.
    """
    if folds < 2 and any(len(grid) > 1 for _, grid in (grids or regression_grids(seed)).values()):
        raise ValueError("choosing among several settings needs at least two folds")
    prepared: PipelineModel = feature_pipeline(numeric, categorical, impute=impute).fit(train)
    cols = ["features", F.col(label).cast("double").alias("label")]
    fold = fold_of(max(folds, 1), vector_to_array("features"), F.col("label")).alias("fold")
    fit_on = spread(prepared.transform(train).where(F.col(label).isNotNull()).select(*cols)).select("*", fold).persist()
    few = fit_on.select("fold").distinct().count() < folds  # then the folds must be drawn row by row
    score_on = prepared.transform(test).where(F.col(label).isNotNull()).select(*cols).persist()
    names = slot_names(fit_on)
    fitted = []
    wanted = grids or regression_grids(seed)
    trees = {name: found for name, (estimator, grid) in wanted.items() if (found := _tree_grid(estimator, grid))}
    data, data_test = _tree_blocks(fit_on, score_on, folds if few else 0, [len([n for n in names if n.startswith(f"{c}_vec_")]) for c in categorical], trees) if trees else (None, None)
    for name, (estimator, grid) in wanted.items():
        if name in trees:
            model = _fit_trees(data, estimator, trees[name], folds)
            metrics = metrics_of(errors(data_test, [(model.most, -1, model)])[0])
            fitted.append(Fitted(name, model, metrics, importances(model, names)))
            continue
        penalties = _penalties(estimator, grid)
        if len(grid) > 1 and penalties:
            _, _, best = linear_search(fit_on, "label", F.col("fold"), folds, penalties)
            model = estimator.fit(fit_on, grid[penalties.index(best)])
        elif len(grid) > 1:
            search = CrossValidator(
                estimator=estimator, estimatorParamMaps=grid, evaluator=RegressionEvaluator(metricName="rmse"),
                numFolds=folds, parallelism=parallelism, seed=seed, foldCol="" if few else "fold",
            )
            model = search.fit(fit_on).bestModel
        else:
            model = estimator.fit(fit_on, grid[0] if grid else {})
        metrics = evaluate_regression(model.transform(score_on))
        fitted.append(Fitted(name, model, metrics, importances(model, names)))
    fit_on.unpersist()
    score_on.unpersist()
    return fitted


def metrics_table(spark: SparkSession, results: dict[str, list[Fitted]]) -> DataFrame:
    """One row per target and model."""
    rows = [(t, f.name, *[float(f.metrics[m]) for m in ("rmse", "mae", "r2")]) for t, fs in results.items() for f in fs]
    return spark.createDataFrame(rows, "target string, model string, rmse double, mae double, r2 double")


def importance_table(spark: SparkSession, results: dict[str, list[Fitted]]) -> DataFrame:
    rows = [(t, f.name, n, v) for t, fs in results.items() for f in fs for n, v in f.importances]
    return spark.createDataFrame(rows, "target string, model string, feature string, importance double")


def benchmark(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Sample deviation of each target: what predicting the mean would score."""
    return df.agg(*[F.stddev_samp(t).alias(f"benchmark_{t}") for t in targets])


# --- linear model with coefficient tests -------------------------------------


def linear_model(
    df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Ordinary least squares: the coefficient table, and rows with fit and residual.

    Rows with any NULL are left out. The coefficient table has one row per slot
    plus the intercept, with standard error, t and p.
    """
    used = df.select(*numeric, *categorical, F.col(label).cast("double").alias("label")).na.drop("any")
    stages: list = []
    inputs = list(numeric)
    if categorical:
        index = [f"{c}_index" for c in categorical]
        inputs += [f"{c}_vec" for c in categorical]
        stages += [
            StringIndexer(inputCols=list(categorical), outputCols=index, handleInvalid="error"),
            OneHotEncoder(inputCols=index, outputCols=inputs[len(numeric):]),
        ]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    data = Pipeline(stages=stages).fit(used).transform(used).select("features", "label").persist()
    model = LinearRegression(solver="normal", regParam=0.0).fit(data)
    s = model.summary
    names = [*slot_names(data), "(intercept)"]
    values = [*[float(v) for v in model.coefficients], float(model.intercept)]
    rows = list(zip(names, values, s.coefficientStandardErrors, s.tValues, s.pValues))
    table = df.sparkSession.createDataFrame(
        rows, "term string, estimate double, std_error double, t_value double, p_value double"
    )
    fitted = model.transform(data).select("label", F.col("prediction").alias("fitted"))
    data.unpersist()
    return table, fitted.withColumn("residual", F.col("label") - F.col("fitted"))


# --- classification -----------------------------------------------------------


def _class_scores(counts: dict[tuple[float, float], int]) -> dict[str, float]:
    """Scores from the rows of each label and class said; a class that is never said has precision 0."""
    truth, said = (Counter() for _ in range(2))
    for (y, p), n in counts.items():
        truth[y] += n
        said[p] += n
    total, hit = sum(truth.values()), {y: counts.get((y, y), 0) for y in truth}
    weighted = lambda of: sum(truth[y] / total * (hit[y] / of[y] if of[y] else 0.0) for y in sorted(truth))
    return {
        "accuracy": sum(hit.values()) / total if total else float("nan"),
        "weightedPrecision": weighted(said), "weightedRecall": weighted(truth),
    }


def evaluate_classes(predictions: DataFrame) -> dict[str, float]:
    """Accuracy, weighted precision and weighted recall, in one pass."""
    return _class_scores({(r[0], r[1]): r[2] for r in predictions.groupBy("label", "prediction").count().collect()})


def class_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy, weighted precision and weighted recall from the confusion counts."""
    counts = df.groupBy(F.col(label).alias("y"), F.col(prediction).alias("p")).agg(F.count("*").alias("n"))
    truth = counts.groupBy("y").agg(F.sum("n").alias("n_true"), F.sum(F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)).alias("hit"))
    said = counts.groupBy(F.col("p").alias("y")).agg(F.sum("n").alias("n_said"))
    each = truth.join(said, "y", "left")
    total = F.sum("n_true")
    return each.agg(
        (F.sum("hit") / total).alias("accuracy"),
        (F.sum(F.coalesce(F.try_divide(F.col("hit"), F.col("n_said")), F.lit(0.0)) * F.col("n_true")) / total).alias("weighted_precision"),
        (F.sum(F.try_divide(F.col("hit"), F.col("n_true")) * F.col("n_true")) / total).alias("weighted_recall"),
    )


def train_classifiers(
    train: DataFrame, test: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str], seed: int = SEED
) -> DataFrame:
    """Four classifiers on a text label, scored on the test rows: one row per model. The trees grow from staged bins."""
    # a label that training never saw is a class of its own, which no model can hit; without a label there is nothing to score
    train, test = train.where(F.col(label).isNotNull()), test.where(F.col(label).isNotNull())
    indexer = StringIndexer(inputCol=label, outputCol="label", handleInvalid="keep")
    prepared = Pipeline(stages=[indexer, *feature_pipeline(numeric, categorical).getStages()]).fit(train)
    inputs = F.array(*[F.col(c).cast("double") for c in [*numeric, *[f"{c}_index" for c in categorical]]]).alias("x")
    fit_on = spread(prepared.transform(train).select("features", "label", inputs)).persist()
    score_on = prepared.transform(test).select("features", "label", inputs).persist()
    width = fit_on.schema["features"].metadata["ml_attr"]["num_attrs"]
    classes = len(prepared.stages[0].labels)
    models = {
        "NeuralNetwork": MultilayerPerceptronClassifier(layers=[width, 5, 5, classes], seed=seed),
        "DecisionTree": DecisionTreeClassifier(seed=seed),
        "RandomForest": RandomForestClassifier(seed=seed),
        "LogisticRegression": LogisticRegression(maxIter=10),
    }
    names = slot_names(fit_on)
    groups = [len([n for n in names if n.startswith(f"{c}_vec_")]) for c in categorical]
    trees = {n: e for n, e in models.items() if isinstance(e, DecisionTreeClassifier | RandomForestClassifier)}
    grids = {n: [(e.getMaxDepth(), e.getMaxBins())] for n, e in trees.items()}
    data, data_test = _tree_blocks(fit_on.withColumn("fold", F.lit(0)), score_on, 0, groups, grids)
    grown = [
        fit_classes(data, classes, *grids[n][0], e.getNumTrees() if isinstance(e, RandomForestClassifier) else 1, e.getSeed())
        for n, e in trees.items()
    ]
    scores = {n: _class_scores(c) for n, c in zip(trees, confusions(data_test, grown), strict=True)}
    rows = []
    for name, estimator in models.items():
        m = scores[name] if name in scores else evaluate_classes(estimator.fit(fit_on).transform(score_on))
        rows.append((name, m["accuracy"], m["weightedPrecision"], m["weightedRecall"]))
    fit_on.unpersist()
    score_on.unpersist()
    return train.sparkSession.createDataFrame(
        rows, "model string, accuracy double, weighted_precision double, weighted_recall double"
    )


# --- runtime by share of rows --------------------------------------------------


def runtime_by_fraction(
    df: DataFrame, targets: Sequence[str], numeric: Sequence[str], categorical: Sequence[str],
    fractions: Sequence[float] = (0.001, 0.01, 0.1, 1.0), seed: int = SEED, ids: Sequence[str] | None = None, **options,
) -> DataFrame:
    """Train on growing nested samples and report rows, seconds and the best RMSE of each.

    A sample holds the rows whose hash of the ids (all columns unless named) is below
    its fraction, so that a larger one holds all smaller ones. A strategy of the other
    side is no input.
    """
    rows, ids = [], list(ids or df.columns)
    draw = stable_draw(seed + 1, *[F.col(i) for i in ids])
    for fraction in fractions:
        part = df if fraction >= 1 else df.where(draw < fraction)
        start = time.perf_counter()
        scores = []
        train, test = stable_split(part, ids, seed=seed)
        for target in targets:
            own = own_side(categorical, target)
            scores += [f.metrics["rmse"] for f in train_regressors(train, test, target, numeric, own, **options)]
        seconds = time.perf_counter() - start
        rows.append((float(fraction), part.count(), seconds, float(min(scores))))
    return df.sparkSession.createDataFrame(rows, "fraction double, rows bigint, seconds double, rmse double")


def own_side(categorical: Sequence[str], target: str) -> list[str]:
    """The categories without the strategy of the side that the target isn't of."""
    side = next((s for s in ("home", "away") if s in target.split("_")), None)
    other = {"home": "away", "away": "home"}.get(side)
    return [c for c in categorical if not ("strategy" in c and other in c.split("_"))]


def linear_curve(
    df: DataFrame, targets: Sequence[str], numeric: Sequence[str], categorical: Sequence[str], ids: Sequence[str],
    fractions: Sequence[float] = (0.001, 0.01, 0.1, 1.0), seed: int = SEED, folds: int = 3,
) -> DataFrame:
    """Learning curve of the tuned linear model: target, fraction, rows, rmse. One scan of the rows for each target.

    Samples are nested as in `runtime_by_fraction`; each is tuned by cross-validation
    and scored on the same test rows.
    """
    draw = stable_draw(seed + 1, *[F.col(i) for i in ids])
    grid = _penalties(*regression_grids(seed)["LinearRegression"])
    out = []
    train, test = stable_split(df, ids, seed=seed)
    for target in targets:
        prepared = feature_pipeline(numeric, own_side(categorical, target)).fit(train)
        fold = fold_of(folds, *[F.col(i) for i in ids])
        curve = learning_curve(prepared.transform(train), target, draw, fractions, fold, folds, grid, prepared.transform(test))
        out += [(target, *point) for point in curve]
    return df.sparkSession.createDataFrame(out, "target string, fraction double, rows bigint, rmse double")

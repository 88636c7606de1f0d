"""Scaling, clustering, rules and models."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from touchline.catalog.aggregates import _case
from touchline.catalog.base import games, query, rounded
from touchline.functions import formation_digits, rule_strategy
from touchline.learning.cluster import (
    LINES,
    STRATEGIES_BALANCED,
    fit_strategies,
    formation_lines,
    mllib_standardised,
    pca_plane,
    silhouette,
    squared_silhouette,
    standardised,
    strategy_names,
    with_strategies,
)
from touchline.learning.gram import linear_search, predicted
from touchline.learning.ols import absorbed_least_squares
from touchline.learning.rules import association_rules, basket, most_significant, one_hot_items, pair_rules
from touchline.learning.silhouette import silhouette_within
from touchline.learning.train import (
    benchmark,
    class_metrics,
    feature_pipeline,
    gradient_boosted,
    importance_table,
    linear_curve,
    linear_model,
    metrics_table,
    regression_grids,
    regression_metrics,
    runtime_by_fraction,
    slot_names,
    stable_split,
    train_classifiers,
    train_regressors,
)
from touchline.operators.impute import impute
from touchline.operators.relational import outcome, stack_roles
from touchline.operators.stats import attach
from touchline.session import stage

SCALED = ["home_club_position", "attendance"]


@query(
    "standardised",
    """
SELECT game_id, round((home_club_position - avg(home_club_position) OVER ()) / stddev_pop(home_club_position) OVER (), 5) + 0.0 AS home_club_position,
       round((attendance - avg(attendance) OVER ()) / stddev_pop(attendance) OVER (), 5) + 0.0 AS attendance
FROM games WHERE home_club_position IS NOT NULL AND attendance IS NOT NULL
""",
)
def scaled(spark, sf):
    g = games(spark, sf).select("game_id", *SCALED).na.drop("any")
    out = standardised(g, SCALED)
    return out.withColumns({c: F.round(c, 5) + F.lit(0.0) for c in SCALED})


@query(
    "standardised_mllib",
    """
SELECT game_id, round((home_club_position - avg(home_club_position) OVER ()) / stddev_samp(home_club_position) OVER (), 5) + 0.0 AS home_club_position,
       round((attendance - avg(attendance) OVER ()) / stddev_samp(attendance) OVER (), 5) + 0.0 AS attendance
FROM games WHERE home_club_position IS NOT NULL AND attendance IS NOT NULL
""",
)
def scaled_mllib(spark, sf):
    g = games(spark, sf).select("game_id", *SCALED).na.drop("any")
    parts = vector_to_array("scaled")
    return mllib_standardised(g, SCALED).select(
        "game_id", *[(F.round(parts[i], 5) + F.lit(0.0)).alias(c) for i, c in enumerate(SCALED)]
    )


ROLES = {
    "home": {"formation": "home_club_formation", "goals_scored": "home_club_goals", "goals_conceded": "away_club_goals"},
    "away": {"formation": "away_club_formation", "goals_scored": "away_club_goals", "goals_conceded": "home_club_goals"},
}


# Every way to divide the distinct points of the formations used into three clusters, and the cheapest of them.
KMEANS_SQL = """
WITH used AS (SELECT home_club_formation AS f FROM games UNION ALL SELECT away_club_formation FROM games),
lists AS (SELECT f, coalesce(list_filter(string_split(f, '-'), lambda x: regexp_full_match(x, '[0-9]+')), []) AS s FROM used),
lines AS (SELECT f, CASE WHEN len(s) IN (3, 4) THEN s[1]::INTEGER ELSE 4 END AS d,
  CASE len(s) WHEN 3 THEN s[2]::INTEGER WHEN 4 THEN s[2]::INTEGER + s[3]::INTEGER ELSE 4 END AS m,
  CASE len(s) WHEN 3 THEN s[3]::INTEGER WHEN 4 THEN s[4]::INTEGER ELSE 2 END AS a FROM lists),
sc AS (SELECT avg(d) AS md, stddev_pop(d) AS sd, avg(m) AS mm, stddev_pop(m) AS sm, avg(a) AS ma, stddev_pop(a) AS sa FROM lines WHERE f IS NOT NULL),
pt AS (SELECT d, m, a, (d - any_value(md)) / any_value(sd) AS x, (m - any_value(mm)) / any_value(sm) AS y, (a - any_value(ma)) / any_value(sa) AS z, count(*) AS w,
  row_number() OVER (ORDER BY d, m, a) - 1 AS i FROM lines, sc WHERE f IS NOT NULL GROUP BY d, m, a),
way AS (SELECT code, i, (code // (3 ** i)::BIGINT) % 3 AS c FROM range((3 ** (SELECT count(*) FROM pt))::BIGINT) AS r(code), pt),
part AS (SELECT code, c, sum(w * (x * x + y * y + z * z)) - (pow(sum(w * x), 2) + pow(sum(w * y), 2) + pow(sum(w * z), 2)) / sum(w) AS cost,
  sum(w * x) / sum(w) AS cx, sum(w * y) / sum(w) AS cy, sum(w * z) / sum(w) AS cz FROM way JOIN pt USING (i) GROUP BY code, c),
best AS (SELECT code FROM part GROUP BY code HAVING count(*) = 3 ORDER BY round(sum(cost), 6), code LIMIT 1),
centre AS (SELECT cx, cy, cz, row_number() OVER (ORDER BY cz) AS rank FROM part JOIN best USING (code)),
form AS (SELECT DISTINCT f, d, m, a FROM lines),
near AS (SELECT f, rank, cx, cy, cz, (d - md) / sd AS x, (m - mm) / sm AS y, (a - ma) / sa AS z FROM form, sc, centre
  QUALIFY row_number() OVER (PARTITION BY f ORDER BY pow((d - md) / sd - cx, 2) + pow((m - mm) / sm - cy, 2) + pow((a - ma) / sa - cz, 2)) = 1)
"""


def _named_sql(names) -> str:
    listed = ", ".join(f"'{n}'" for n in names)
    return KMEANS_SQL + f", named AS (SELECT f, [{listed}][rank] AS name FROM near)"


@query(
    "kmeans_strategy",
    _named_sql(("Defensive", "Aggressive", "Offensive"))
    + """
SELECT game_id, home_club_formation, away_club_formation, h.name AS strategy_home, v.name AS strategy_away
FROM games LEFT JOIN named h ON h.f IS NOT DISTINCT FROM home_club_formation LEFT JOIN named v ON v.f IS NOT DISTINCT FROM away_club_formation
""",
)
def kmeans(spark, sf):
    g = games(spark, sf).select("game_id", "home_club_formation", "away_club_formation")
    return with_strategies(g, {"home_club_formation": "strategy_home", "away_club_formation": "strategy_away"})


@query(
    "kmeans_quality",
    KMEANS_SQL
    + """, uses AS (SELECT rank, x, y, z, count(*) AS w FROM used JOIN near ON used.f = near.f GROUP BY ALL),
g AS (SELECT u.rank, u.x, u.y, u.z, u.w, o.rank AS other, sum(o.w) AS n, sum(o.w * (pow(u.x - o.x, 2) + pow(u.y - o.y, 2) + pow(u.z - o.z, 2))) AS s
  FROM uses u, uses o GROUP BY ALL),
ab AS (SELECT rank, x, y, z, w, max(n) FILTER (rank = other) AS n, max(s / nullif(n - 1, 0)) FILTER (rank = other) AS a, min(s / n) FILTER (rank <> other) AS b FROM g GROUP BY ALL),
q AS (SELECT sum(w * CASE WHEN n <= 1 THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END) / sum(w) AS v FROM ab)
SELECT rank::INTEGER AS rank, sum(w)::BIGINT AS n, round((SELECT v FROM q), 6) + 0.0 AS squared_silhouette,
  round((SELECT sum(cost) FROM part JOIN best USING (code)), 6) + 0.0 AS cost FROM uses GROUP BY rank
""",
)
def kmeans_quality(spark, sf):
    """Rows of each cluster in the order of attackers, the silhouette over all uses, and the cost, which no division undercuts."""
    model, labels = fit_strategies(games(spark, sf), ["home_club_formation", "away_club_formation"])
    value = squared_silhouette(labels, weight="n").scalar()
    sizes = labels.where("n > 0").groupBy(strategy_names(model, (1, 2, 3)).cast("int").alias("rank")).agg(F.sum("n").alias("n"))
    return rounded(sizes.withColumn("squared_silhouette", value).withColumn("cost", F.lit(model.cost)), "squared_silhouette", "cost")


@query(
    "cluster_profile",
    _named_sql(("Defensive", "Balanced", "Aggressive"))
    + """, long AS (SELECT game_id, home_club_formation AS formation, home_club_goals AS goals_scored, away_club_goals AS goals_conceded, 'home' AS team_type FROM games
  UNION ALL SELECT game_id, away_club_formation, away_club_goals, home_club_goals, 'away' FROM games)
SELECT game_id, formation, goals_scored, goals_conceded, team_type, name AS strategy,
  round(avg(goals_scored) OVER (PARTITION BY name), 6) AS average_goals_scored_cluster, round(avg(goals_conceded) OVER (PARTITION BY name), 6) AS average_goals_conceded_cluster
FROM long LEFT JOIN named ON named.f IS NOT DISTINCT FROM formation
""",
)
def cluster_profile(spark, sf):
    long = stack_roles(games(spark, sf), "game_id", ROLES, "team_type")
    named = with_strategies(long, {"formation": "strategy"}, STRATEGIES_BALANCED)
    means = named.groupBy("strategy").agg(
        F.avg("goals_scored").alias("average_goals_scored_cluster"), F.avg("goals_conceded").alias("average_goals_conceded_cluster")
    )
    return rounded(attach(named, means, ["strategy"]), "average_goals_scored_cluster", "average_goals_conceded_cluster")


@query(
    "rule_profile",
    f"""
WITH l AS (SELECT game_id, 'home' AS team_type, {_case('home', 'home_club_formation')} AS strategy, home_club_goals AS s, away_club_goals AS c FROM games
UNION ALL SELECT game_id, 'away', {_case('home', 'away_club_formation')}, away_club_goals, home_club_goals FROM games)
SELECT game_id, team_type, strategy, round(avg(s) OVER (PARTITION BY strategy), 6) AS mean_scored,
       round(avg(c) OVER (PARTITION BY strategy), 6) AS mean_conceded FROM l
""",
)
def rule_profile(spark, sf):
    long = stack_roles(games(spark, sf), "game_id", ROLES, "team_type")
    long = long.withColumn("strategy", rule_strategy(F.col("formation"), "home"))
    means = long.groupBy("strategy").agg(F.avg("goals_scored").alias("mean_scored"), F.avg("goals_conceded").alias("mean_conceded"))
    out = attach(long.select("game_id", "team_type", "strategy"), means, ["strategy"])
    return rounded(out, "mean_scored", "mean_conceded")


LINES_SQL = """
  CASE WHEN len(s) IN (3, 4) THEN s[1]::INTEGER ELSE 4 END AS d,
  CASE len(s) WHEN 3 THEN s[2]::INTEGER WHEN 4 THEN s[2]::INTEGER + s[3]::INTEGER ELSE 4 END AS m,
  CASE len(s) WHEN 3 THEN s[3]::INTEGER WHEN 4 THEN s[4]::INTEGER ELSE 2 END AS a
"""


@query(
    "silhouette",
    f"""
WITH f AS (SELECT {_case('home', 'home_club_formation')} AS label,
  coalesce(list_filter(string_split(home_club_formation, '-'), lambda x: regexp_full_match(x, '[0-9]+')), []) AS s FROM games),
p AS (SELECT label, d, m, a, count(*) AS w FROM (SELECT label, {LINES_SQL} FROM f) GROUP BY ALL),
sums AS (SELECT p.label, p.d, p.m, p.a, p.w, o.label AS other, sum(o.w) AS n,
  sum(o.w * sqrt((p.d - o.d) * (p.d - o.d) + (p.m - o.m) * (p.m - o.m) + (p.a - o.a) * (p.a - o.a))) AS dist
  FROM p, p AS o GROUP BY ALL),
ab AS (SELECT label, d, m, a, w, max(n) FILTER (label = other) AS n_own, max(dist / nullif(n - 1, 0)) FILTER (label = other) AS x,
  min(dist / n) FILTER (label <> other) AS y FROM sums GROUP BY ALL)
SELECT round(sum(w * CASE WHEN n_own <= 1 THEN 0 ELSE coalesce((y - x) / nullif(greatest(x, y), 0), 0) END) / sum(w), 6) + 0.0 AS silhouette FROM ab
""",
)
def exact_silhouette(spark, sf):
    g = games(spark, sf).withColumn("label", rule_strategy(F.col("home_club_formation"), "home"))
    return rounded(silhouette(formation_lines(g, "home_club_formation"), LINES, "label"), "silhouette")


@query(
    "silhouette_free",
    """
WITH p AS (SELECT competition_type AS l, attendance / 1000.0::DOUBLE AS x, home_club_position::DOUBLE AS y, count(*) AS w FROM games
  WHERE attendance IS NOT NULL AND home_club_position IS NOT NULL GROUP BY ALL),
d AS (SELECT p.l, p.x, p.y, p.w, o.l AS other, sum(o.w) AS n, sum(o.w * sqrt((p.x - o.x) * (p.x - o.x) + (p.y - o.y) * (p.y - o.y))) AS s FROM p, p AS o GROUP BY ALL),
ab AS (SELECT l, x, y, w, max(n) FILTER (l = other) AS n, max(s / nullif(n - 1, 0)) FILTER (l = other) AS a, min(s / n) FILTER (l <> other) AS b FROM d GROUP BY ALL)
SELECT round(sum(w * CASE WHEN n <= 1 THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END) / sum(w), 2) + 0.0 AS silhouette, true AS within FROM ab
""",
)
def free_silhouette(spark, sf):
    """Of attendance and position by kind of competition; within: the error's bound keeps the tolerance."""
    g = games(spark, sf).withColumns({"x": F.col("attendance") / 1000.0, "y": F.col("home_club_position").cast("double")})
    out = silhouette_within(g, ["x", "y"], "competition_type", 0.005)
    return out.select((F.round("silhouette", 2) + F.lit(0.0)).alias("silhouette"), (F.col("error") <= 0.005).alias("within"))


@query(
    "pca_pair",
    """
WITH g AS (SELECT game_id, home_club_position AS a, attendance AS b FROM games WHERE home_club_position IS NOT NULL AND attendance IS NOT NULL),
s AS (SELECT avg(a) AS ma, stddev_pop(a) AS sa, avg(b) AS mb, stddev_pop(b) AS sb, sign(corr(a, b)) AS c FROM g),
z AS (SELECT game_id, (a - ma) / sa AS x, (b - mb) / sb AS y, c FROM g, s)
SELECT game_id, round((x + c * y) / sqrt(2), 5) + 0.0 AS pc1, round((x - c * y) / sqrt(2), 5) + 0.0 AS pc2 FROM z
""",
)
def pca_two(spark, sf):
    g = games(spark, sf).select("game_id", *SCALED).na.drop("any")
    out = pca_plane(g, SCALED)
    return out.select("game_id", *[(F.round(c, 5) + F.lit(0.0)).alias(c) for c in ("pc1", "pc2")])


@query("pca_plane")
def pca(spark, sf):
    g = games(spark, sf).select("game_id", *SCALED, "away_club_position").na.drop("any")
    return pca_plane(g, [*SCALED, "away_club_position"]).select("game_id", "pc1", "pc2")


METRICS = ["support_a", "support_c", "support", "confidence", "lift", "leverage", "conviction", "zhang"]
RULES_SQL = """
WITH b AS (SELECT nullif(regexp_extract(home_club_formation, '(\\d+(?:-\\d+)+)', 1), '') AS f, home_club_goals::VARCHAR AS g FROM games),
t AS (SELECT f, g FROM b WHERE f IS NOT NULL AND g IS NOT NULL),
n AS (SELECT count(*) AS n FROM t),
i AS (SELECT item, count(*) / (SELECT n FROM n) AS s FROM (SELECT f AS item FROM t UNION ALL SELECT g FROM t) GROUP BY 1),
p AS (SELECT f, g, count(*) / (SELECT n FROM n) AS s FROM t GROUP BY 1, 2),
two AS (SELECT f AS a, g AS c, s FROM p UNION ALL SELECT g, f, s FROM p),
r AS (SELECT a AS antecedent, c AS consequent, x.s AS sa, y.s AS sc, two.s AS s FROM two JOIN i x ON a = x.item JOIN i y ON c = y.item
      WHERE two.s >= 0.01 AND two.s / x.s >= 0.01),
k AS (SELECT antecedent, consequent, round(sa, 6) AS support_a, round(sc, 6) AS support_c, round(s, 6) AS support, round(s / sa, 6) AS confidence,
  round(s / sa / sc, 6) AS lift, round(s - sa * sc, 6) + 0.0 AS leverage, round((1 - sc) / nullif(1 - s / sa, 0), 6) AS conviction,
  round((s - sa * sc) / nullif(greatest(s * (1 - sa), sa * (sc - s)), 0), 6) + 0.0 AS zhang FROM r)
"""


def _basket_columns(spark, sf):
    return games(spark, sf).select("game_id", formation_digits(F.col("home_club_formation")).alias("formation"), F.col("home_club_goals").alias("goals"))


@query("association_rules", RULES_SQL + "SELECT * FROM k")
def rules(spark, sf):
    return rounded(pair_rules(_basket_columns(spark, sf), "formation", "goals"), *METRICS)


@query("association_rules_fpgrowth", RULES_SQL + "SELECT * FROM k")
def rules_fpgrowth(spark, sf):
    rows = _basket_columns(spark, sf).where("formation is not null and goals is not null")
    return rounded(association_rules(rows.select(basket(F.col("formation"), F.col("goals")).alias("items")), "items"), *METRICS)


@query("top_zhang", RULES_SQL + "SELECT * FROM k ORDER BY abs(zhang) DESC, antecedent, consequent LIMIT 1")
def top_zhang(spark, sf):
    return rounded(most_significant(pair_rules(_basket_columns(spark, sf), "formation", "goals")), *METRICS)


@query(
    "one_hot_items",
    """
SELECT game_id, regexp_extract(home_club_formation, '(\\d+(?:-\\d+)+)', 1) AS item, 1 AS present FROM games WHERE home_club_formation IS NOT NULL
UNION ALL SELECT game_id, home_club_goals::VARCHAR, 1 FROM games WHERE home_club_goals IS NOT NULL
""",
)
def one_hot(spark, sf):
    rows = _basket_columns(spark, sf).select("game_id", basket(F.col("formation"), F.col("goals")).alias("items"))
    return one_hot_items(rows, "game_id", "items")


# --- models on the game table --------------------------------------------------

TARGETS = ["home_club_goals", "away_club_goals"]
NUMERIC = ["season", "home_club_position", "away_club_position", "attendance"]
CATEGORICAL = ["competition_id", "home_strategy"]


def model_table(spark, sf):
    """Games with a result and a rule strategy per side; an unknown number is the column's mean. Staged once for all fits."""
    g = games(spark, sf).where("home_club_goals is not null").select(
        "game_id", *NUMERIC, "home_club_id", "away_club_id", "competition_id", "home_club_goals", "away_club_goals",
        rule_strategy(F.col("home_club_formation"), "home").alias("home_strategy"),
        rule_strategy(F.col("away_club_formation"), "away").alias("away_strategy"),
    )
    return impute(stage(g, "model"), NUMERIC[1:], "mean")


MODEL_SQL = f"""
WITH m AS (SELECT game_id, season, home_club_id, away_club_id, coalesce(home_club_position, avg(home_club_position) OVER ()) AS home_club_position,
  coalesce(away_club_position, avg(away_club_position) OVER ()) AS away_club_position, coalesce(attendance, avg(attendance) OVER ()) AS attendance,
  competition_id, home_club_goals, away_club_goals,
  {_case('home', 'home_club_formation')} AS home_strategy, {_case('away', 'away_club_formation')} AS away_strategy FROM games
  WHERE home_club_goals IS NOT NULL)
"""


@query(
    "string_index",
    MODEL_SQL
    + """, c AS (SELECT competition_id, row_number() OVER (ORDER BY count(*) DESC, competition_id) - 1 AS i FROM m GROUP BY competition_id)
SELECT m.game_id, c.i::DOUBLE AS competition_index FROM m JOIN c ON m.competition_id = c.competition_id
""",
)
def string_index(spark, sf):
    from pyspark.ml.feature import StringIndexer

    m = model_table(spark, sf).select("game_id", "competition_id")
    return StringIndexer(inputCol="competition_id", outputCol="competition_index").fit(m).transform(m).drop("competition_id")


@query(
    "feature_vectors",
    MODEL_SQL
    + """, c AS (SELECT home_strategy, row_number() OVER (ORDER BY count(*) DESC, home_strategy) - 1 AS i FROM m GROUP BY home_strategy)
SELECT game_id, season::DOUBLE AS x0, attendance::DOUBLE AS x1, (i = 0)::INTEGER::DOUBLE AS x2, (i = 1)::INTEGER::DOUBLE AS x3,
       (i = 2)::INTEGER::DOUBLE AS x4, (i = 3)::INTEGER::DOUBLE AS x5 FROM m JOIN c ON m.home_strategy = c.home_strategy
""",
)
def feature_vectors(spark, sf):
    m = model_table(spark, sf)
    out = feature_pipeline(["season", "attendance"], ["home_strategy"]).fit(m).transform(m)
    x = vector_to_array("features")
    return out.select("game_id", *[x[i].alias(f"x{i}") for i in range(6)])


@query("scaled_features")
def scaled_features(spark, sf):
    g = games(spark, sf).select("game_id", *NUMERIC, "competition_id")
    out = feature_pipeline(NUMERIC, ["competition_id"], impute=True, scale=True).fit(g).transform(g)
    return out.select("game_id", vector_to_array("features").alias("features"))


@query(
    "stable_split",
    """
SELECT o_orderkey AS game_id, ('0x' || substr(md5(o_orderkey || ':42'), 1, 8))::BIGINT / 4294967296.0::DOUBLE < 0.8 AS in_train FROM orders
""",
    linked_tables=False,
)
def split(spark, sf):
    ids = games(spark, sf).select("game_id")
    train, test = stable_split(ids, ["game_id"])
    return train.withColumn("in_train", F.lit(True)).unionByName(test.withColumn("in_train", F.lit(False)))


@query(
    "benchmark_stddev",
    "SELECT round(stddev_samp(home_club_goals), 6) AS benchmark_home_club_goals, round(stddev_samp(away_club_goals), 6) AS benchmark_away_club_goals FROM games",
)
def bench(spark, sf):
    return rounded(benchmark(games(spark, sf), ["home_club_goals", "away_club_goals"]), "benchmark_home_club_goals", "benchmark_away_club_goals")


@query(
    "regression_metrics",
    """
WITH p AS (SELECT home_club_goals AS y, avg(home_club_goals) OVER (PARTITION BY competition_id) AS f FROM games WHERE home_club_goals IS NOT NULL)
SELECT round(sqrt(avg((y - f) * (y - f))), 6) AS rmse, round(avg(abs(y - f)), 6) AS mae,
       round(1 - sum((y - f) * (y - f)) / (var_pop(y) * count(y)), 6) + 0.0 AS r2 FROM p
""",
)
def reg_metrics(spark, sf):
    g = games(spark, sf).where("home_club_goals is not null").select("competition_id", "home_club_goals")
    means = g.groupBy("competition_id").agg(F.avg("home_club_goals").alias("guess"))
    return rounded(regression_metrics(attach(g, means, ["competition_id"]), "home_club_goals", "guess"), "rmse", "mae", "r2")


@query(
    "class_metrics",
    """
WITH c AS (SELECT o_orderpriority AS y, CASE WHEN o_totalprice > 250000 THEN '1-URGENT' ELSE '5-LOW' END AS p, count(*) AS n FROM orders GROUP BY ALL),
t AS (SELECT y, sum(n) AS nt, sum(CASE WHEN y = p THEN n ELSE 0 END) AS hit FROM c GROUP BY 1), s AS (SELECT p AS y, sum(n) AS ns FROM c GROUP BY 1)
SELECT round(sum(hit) / sum(nt), 6) AS accuracy, round(sum(coalesce(hit / ns, 0) * nt) / sum(nt), 6) AS weighted_precision,
       round(sum(hit / nt * nt) / sum(nt), 6) AS weighted_recall FROM t LEFT JOIN s USING (y)
""",
    linked_tables=False,
)
def cls_metrics(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.col("o_orderpriority").alias("y"), F.when(F.col("o_totalprice") > 250000, "1-URGENT").otherwise("5-LOW").alias("p")
    )
    return rounded(class_metrics(o, "y", "p"), "accuracy", "weighted_precision", "weighted_recall")


@query(
    "simple_regression",
    MODEL_SQL
    + """
SELECT 'attendance' AS term, round(regr_slope(home_club_goals, attendance), 9) + 0.0 AS estimate FROM m
UNION ALL SELECT '(intercept)', round(regr_intercept(home_club_goals, attendance), 9) + 0.0 FROM m
""",
)
def simple_regression(spark, sf):
    terms, _ = linear_model(model_table(spark, sf), "home_club_goals", ["attendance"])
    return terms.select("term", (F.round("estimate", 9) + F.lit(0.0)).alias("estimate"))


# The inputs of the published linear model beside the clubs, which are absorbed.
OLS_NUMERIC = (
    "year", "pos_home", "pos_away", "seats", "attendance", "age_home", "age_away", "ntr_home", "ntr_away", "yellow", "red",
    "height_home", "height_away", "val_home", "val_away", "assists",
)
OLS_FACTORS = ("strategy_home", "strategy_away", "league", "country")


def _regression_rows(spark, sf):
    """The training share of the clean games with totals of both sides and rule strategies."""
    from touchline.catalog.whole import SETTINGS, _cleaned

    g = _cleaned(spark, sf, SETTINGS)
    both = {c: F.col(f"{c}_home") + F.col(f"{c}_away") for c in ("yellow", "red", "assists")}
    g = g.withColumns(both | {f"strategy_{s}": rule_strategy(F.col(f"formation_{s}"), s) for s in ("home", "away")})
    train, _ = stable_split(g, ["date", "home_id", "away_id", "goals_home", "goals_away"])
    return absorbed_least_squares(
        train, ["goals_home", "goals_away"], OLS_NUMERIC, OLS_FACTORS, ["home_id", "away_id"], ["date", "home_id", "away_id"]
    )


@query("coefficient_table")
def coefficients(spark, sf):
    return _regression_rows(spark, sf).terms


@query("match_residuals")
def match_residuals(spark, sf):
    return _regression_rows(spark, sf).rows


@query(
    "within_slopes",
    MODEL_SQL
    + """, d AS (SELECT attendance - avg(attendance) OVER (PARTITION BY home_club_id) AS x,
  home_club_goals - avg(home_club_goals) OVER (PARTITION BY home_club_id) AS h,
  away_club_goals - avg(away_club_goals) OVER (PARTITION BY home_club_id) AS a FROM m),
s AS (SELECT sum(x * x) AS xx, sum(x * h) AS xh, sum(h * h) AS hh, sum(x * a) AS xa, sum(a * a) AS aa, count(*) AS n,
  (SELECT count(DISTINCT home_club_id) FROM m) AS clubs FROM d),
r AS (SELECT 'home_club_goals' AS label, xh / xx AS b, hh - xh * xh / xx AS e, xx, n, n - clubs - 1 AS freedom FROM s
      UNION ALL SELECT 'away_club_goals', xa / xx, aa - xa * xa / xx, xx, n, n - clubs - 1 FROM s)
SELECT label, 'attendance' AS term, round(b, 10) + 0.0 AS estimate, round(sqrt(e / freedom / xx), 10) AS std_error,
  round(b / sqrt(e / freedom / xx), 5) + 0.0 AS t_value, n, freedom FROM r
""",
)
def within_slopes(spark, sf):
    out = absorbed_least_squares(model_table(spark, sf), ["home_club_goals", "away_club_goals"], ["attendance"], absorb=["home_club_id"]).terms
    digits = {"estimate": 10, "std_error": 10, "t_value": 5}
    return out.withColumns({c: F.round(c, d) + F.lit(0.0) for c, d in digits.items()}).drop("p_value")


RIDGE = [(p, 0.0) for p in (1.0, 0.1, 0.01)]


def _hash_fold(folds: int):
    """Fold by the digest of the game, which SQL can state."""
    return (F.conv(F.substring(F.md5(F.concat(F.col("game_id").cast("string"), F.lit(":fold"))), 1, 8), 16, 10).cast("bigint") % folds).cast("int")


@query(
    "ridge_folds",
    MODEL_SQL
    + """, f AS (SELECT attendance AS u, season::DOUBLE AS v, home_club_goals::DOUBLE AS y,
  (('0x' || substr(md5(game_id || ':fold'), 1, 8))::BIGINT % 3)::INTEGER AS fold FROM m),
k AS (SELECT unnest([0, 1, 2])::INTEGER AS fold),
t AS (SELECT k.fold, avg(u) AS mu, avg(v) AS mv, avg(y) AS my, stddev_pop(u) AS su, stddev_pop(v) AS sv, stddev_pop(y) AS sy,
  covar_pop(u, v) AS cuv, covar_pop(u, y) AS cuy, covar_pop(v, y) AS cvy FROM k JOIN f ON f.fold <> k.fold GROUP BY k.fold),
g AS (SELECT unnest([1.0, 0.1, 0.01])::DOUBLE AS penalty),
c AS (SELECT *, 1 + penalty / sy AS d, cuv / su / sv AS r, cuy / su AS p, cvy / sv AS q FROM t, g),
b AS (SELECT fold, penalty, mu, mv, my, (p * d - q * r) / (d * d - r * r) / su AS bu, (q * d - p * r) / (d * d - r * r) / sv AS bv FROM c)
SELECT penalty, 0.0::DOUBLE AS mixing, b.fold, count(*) AS rows, round(sqrt(avg(pow(y - my - bu * (u - mu) - bv * (v - mv), 2))), 8) AS rmse
FROM b JOIN f ON f.fold = b.fold GROUP BY penalty, b.fold
""",
)
def ridge_folds(spark, sf):
    m = model_table(spark, sf).withColumn("features", F.array(F.col("attendance").cast("double"), F.col("season").cast("double")))
    table, _, _ = linear_search(m, "home_club_goals", _hash_fold(3), 3, RIDGE)
    return table.withColumn("rmse", F.round("rmse", 8))


@query("linear_curve")
def curve(spark, sf):
    categories = ["competition_id", "home_strategy", "away_strategy"]
    return linear_curve(model_table(spark, sf), TARGETS, NUMERIC, categories, ["game_id"])


@query(
    "residuals",
    MODEL_SQL
    + """, f AS (SELECT regr_slope(home_club_goals, attendance) AS b, regr_intercept(home_club_goals, attendance) AS a FROM m)
SELECT home_club_goals::DOUBLE AS label, round(a + b * attendance, 5) + 0.0 AS fitted, round(home_club_goals - a - b * attendance, 5) + 0.0 AS residual FROM m, f
""",
)
def residuals(spark, sf):
    _, rows = linear_model(model_table(spark, sf), "home_club_goals", ["attendance"])
    return rows.withColumns({c: F.round(c, 5) + F.lit(0.0) for c in ("fitted", "residual")})


def _trained(spark, sf, targets, grids, folds=3):
    train, test = stable_split(model_table(spark, sf), ["game_id"])
    results = {}
    for target in targets:
        side = target.split("_")[0]
        results[target] = train_regressors(train, test, target, NUMERIC, ["competition_id", f"{side}_strategy"], grids, folds)
    return results


@query("train_regression")
def train_regression(spark, sf):
    return metrics_table(spark, _trained(spark, sf, TARGETS, regression_grids()))


@query("train_boosted")
def train_boosted(spark, sf):
    return metrics_table(spark, _trained(spark, sf, TARGETS, gradient_boosted()))


@query("importances")
def forest_importances(spark, sf):
    """Of the tuned trees and forests of both targets."""
    grids = {n: g for n, g in regression_grids().items() if n != "LinearRegression"}
    return importance_table(spark, _trained(spark, sf, TARGETS, grids))


@query("train_classifier")
def train_classifier(spark, sf):
    m = model_table(spark, sf).withColumn("outcome", outcome(F.col("home_club_goals"), F.col("away_club_goals")))
    train, test = stable_split(m, ["game_id"])
    return train_classifiers(train, test, "outcome", NUMERIC, ["home_strategy", "away_strategy", "competition_id"])


@query("runtime_by_fraction")
def by_fraction(spark, sf):
    """The published job: four nested samples, three tuned models, both targets."""
    return runtime_by_fraction(model_table(spark, sf), TARGETS, NUMERIC, ["competition_id", "home_strategy", "away_strategy"], ids=["game_id"])


@query(
    "linear_predictions",
    MODEL_SQL
    + """, s AS (SELECT game_id, attendance AS u, season::DOUBLE AS v, home_club_goals::DOUBLE AS y,
  ('0x' || substr(md5(game_id || ':42'), 1, 8))::BIGINT / 4294967296.0::DOUBLE < 0.8 AS in_train FROM m),
t AS (SELECT avg(u) AS mu, avg(v) AS mv, avg(y) AS my, var_pop(u) AS uu, var_pop(v) AS vv, covar_pop(u, v) AS uv, covar_pop(u, y) AS uy, covar_pop(v, y) AS vy FROM s WHERE in_train),
b AS (SELECT *, (uy * vv - vy * uv) / (uu * vv - uv * uv) AS bu, (vy * uu - uy * uv) / (uu * vv - uv * uv) AS bv FROM t)
SELECT game_id, y AS label, round(my + bu * (u - mu) + bv * (v - mv), 7) + 0.0 AS prediction FROM s, b WHERE NOT in_train
""",
)
def linear_predictions(spark, sf):
    """Least squares from the sums of the training games, applied to the others."""
    features = F.array(F.col("attendance").cast("double"), F.col("season").cast("double"))
    train, test = stable_split(model_table(spark, sf).withColumn("features", features), ["game_id"])
    _, fit, _ = linear_search(train, "home_club_goals", F.lit(0), 1, [(0.0, 0.0)])
    out = predicted(test, fit).withColumn("prediction", F.round("prediction", 7) + F.lit(0.0))
    return out.select("game_id", F.col("home_club_goals").cast("double").alias("label"), "prediction")


@query("predictions")
def predictions(spark, sf):
    from pyspark.ml.regression import LinearRegression

    train, test = stable_split(model_table(spark, sf), ["game_id"])
    prepared = feature_pipeline(NUMERIC, CATEGORICAL).fit(train)
    model = LinearRegression(labelCol="home_club_goals", maxIter=5).fit(prepared.transform(train))
    return model.transform(prepared.transform(test)).select("game_id", "home_club_goals", "prediction")


@query("train_test_persisted", MODEL_SQL + """
SELECT (('0x' || substr(md5(game_id || ':42'), 1, 8))::BIGINT / 4294967296.0::DOUBLE < 0.8) AS in_train, count(*) AS n FROM m GROUP BY 1
""")
def persisted(spark, sf):
    train, test = stable_split(model_table(spark, sf), ["game_id"])
    kept = [stage(part, name).agg(F.count("*").alias("n")) for part, name in ((train, "train"), (test, "test"))]
    return kept[0].select(F.lit(True).alias("in_train"), "n").unionByName(kept[1].select(F.lit(False).alias("in_train"), "n"))


@query(
    "slot_names",
    MODEL_SQL
    + """, c AS (SELECT 'competition_id' AS col, competition_id AS v, count(*) AS n FROM m GROUP BY ALL UNION ALL SELECT 'home_strategy', home_strategy, count(*) FROM m GROUP BY ALL),
o AS (SELECT col, v, row_number() OVER (PARTITION BY col ORDER BY n DESC, v) - 1 AS i, count(*) OVER (PARTITION BY col) AS width FROM c),
first AS (SELECT count(DISTINCT competition_id) AS width FROM m)
SELECT (CASE col WHEN 'competition_id' THEN 4 + i ELSE 4 + i + (SELECT width FROM first) END)::INTEGER AS slot, col || '_vec_' || v AS name, n AS rows FROM o JOIN c USING (col, v)
UNION ALL SELECT unnest([0, 1, 2, 3])::INTEGER, unnest(['season', 'home_club_position', 'away_club_position', 'attendance']), (SELECT count(*) FROM m)
""",
)
def slots(spark, sf):
    """Each slot of the feature vector by name, and the rows in which it is not 0 (or all rows, of a number)."""
    m = model_table(spark, sf)
    out = feature_pipeline(NUMERIC, CATEGORICAL).fit(m).transform(m)
    names = spark.createDataFrame(list(enumerate(slot_names(out))), "slot int, name string")
    x = F.posexplode(vector_to_array("features"))
    used = out.select(x.alias("slot", "x")).groupBy("slot").agg(F.sum(F.when((F.col("x") != 0) | (F.col("slot") < len(NUMERIC)), 1).otherwise(0)).alias("rows"))
    return names.join(used, "slot")

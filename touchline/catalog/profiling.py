"""Profiles of tables and the numbers behind charts."""

from pyspark.sql import functions as F

from touchline.catalog.aggregates import _case
from touchline.catalog.base import competitions, games, linked, query, rounded, table
from touchline.functions import rule_strategy
from touchline.operators.charts import (
    auto_histogram,
    bootstrap_interval,
    box_stats,
    conditional_density,
    density_grid,
    histogram,
    kernel_density,
    mean_interval,
    scatter_sample,
)
from touchline.operators.profile import (
    correlations,
    crosstab,
    crosstab_wide,
    describe_numbers,
    describe_texts,
    distinct_counts,
    duplicate_rows,
    null_counts,
    shape,
    table_diagnostics,
    value_counts,
    variable_kinds,
)

GAME_COLS = ["competition_id", "season", "home_club_id", "attendance", "home_club_position", "home_club_formation", "stadium"]


def _per_column(cols, template, source):
    return "\nUNION ALL ".join("SELECT " + template.format(c=c) + f" FROM {source}" for c in cols)


@query("null_counts", _per_column(GAME_COLS, "'{c}' AS \"column\", count(*) AS rows, count(*) - count({c}) AS nulls, count(*) > count({c}) AS any_null", "games"))
def nulls(spark, sf):
    return null_counts(games(spark, sf), GAME_COLS)


@query("distinct_counts", _per_column(GAME_COLS, "'{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values", "games"))
def distincts(spark, sf):
    return distinct_counts(games(spark, sf), GAME_COLS)


@query("distinct_counts_approximate")
def distincts_approximate(spark, sf):
    return distinct_counts(games(spark, sf), GAME_COLS, approximate=True)


@query(
    "duplicate_rows",
    "SELECT sum(n)::BIGINT AS rows, sum(n - 1)::BIGINT AS duplicates FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)",
    linked_tables=False,
)
def duplicates(spark, sf):
    return duplicate_rows(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"))


@query("shape", "SELECT count(*) AS rows, 16 AS columns FROM games")
def shape_of(spark, sf):
    return shape(games(spark, sf))


@query("value_counts", "SELECT home_club_formation, count(*) AS n FROM games WHERE home_club_formation IS NOT NULL GROUP BY 1")
def counts(spark, sf):
    return value_counts(games(spark, sf), "home_club_formation")


CROSS = "FROM games g JOIN competitions c ON g.competition_id = c.competition_id"


@query("crosstab", f"SELECT country_name, name AS league, count(*) AS n {CROSS} GROUP BY ALL")
def cross(spark, sf):
    return crosstab(_named(spark, sf), "country_name", "league")


def _named(spark, sf):
    c = competitions(spark, sf).select("competition_id", F.col("name").alias("league"), "country_name")
    return games(spark, sf).select("competition_id", "season").join(c, "competition_id")


@query(
    "crosstab_wide",
    "SELECT country_name, " + ", ".join(f"count(*) FILTER (season = {y}) AS \"{y}\"" for y in range(1995, 2002)) + f" {CROSS} GROUP BY 1",
)
def cross_wide(spark, sf):
    return crosstab_wide(_named(spark, sf), "country_name", "season", range(1995, 2002))


CORR_COLS = ["season", "home_club_goals", "away_club_goals", "home_club_position", "away_club_position", "attendance"]


@query(
    "correlations",
    "\nUNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) + 0.0 AS r FROM games" for a in CORR_COLS for b in CORR_COLS),
)
def corr(spark, sf):
    return rounded(correlations(games(spark, sf), CORR_COLS), "r")


NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
STATS = ["mean", "std", "min", "max", "q25", "q50", "q75"]


@query(
    "describe_numbers",
    _per_column(
        NUMBERS,
        "'{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS min, max({c}) AS max, "
        "round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75",
        "lineitem",
    ),
    linked_tables=False,
)
def describe_n(spark, sf):
    return rounded(describe_numbers(table(spark, sf, "lineitem"), NUMBERS), *STATS)


@query("describe_numbers_approximate")
def describe_n_approximate(spark, sf):
    return describe_numbers(table(spark, sf, "lineitem"), NUMBERS, approximate=True)


TEXTS = ["o_orderstatus", "o_orderpriority"]


@query(
    "describe_texts",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", (SELECT count({c}) FROM orders) AS count, (SELECT count(DISTINCT {c}) FROM orders) AS \"unique\", v AS top, n AS freq "
        f"FROM (SELECT {c} AS v, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, v LIMIT 1)"
        for c in TEXTS
    ),
    linked_tables=False,
)
def describe_t(spark, sf):
    return describe_texts(table(spark, sf, "orders"), TEXTS)


@query(
    "document_profile",
    """
SELECT 'lang' AS "column", (SELECT count(lang) FROM documents) AS count, (SELECT count(DISTINCT lang) FROM documents) AS "unique", v AS top, n AS freq
FROM (SELECT lang AS v, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, v LIMIT 1)
UNION ALL
SELECT 'text', (SELECT count(text) FROM documents), (SELECT count(DISTINCT text) FROM documents), v, n
FROM (SELECT text AS v, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, v LIMIT 1)
""",
    linked_tables=False,
)
def document_profile(spark, sf):
    return describe_texts(table(spark, sf, "documents"), ["lang", "text"])


@query(
    "variable_kinds",
    """
WITH d AS (SELECT 'o_orderstatus' AS "column", count(DISTINCT o_orderstatus) AS distinct_values, 'categorical' AS base FROM orders
UNION ALL SELECT 'o_custkey', count(DISTINCT o_custkey), 'number' FROM orders
UNION ALL SELECT 'even', count(DISTINCT o_orderkey % 2), 'number' FROM orders)
SELECT "column", distinct_values, CASE WHEN base <> 'number' THEN base WHEN distinct_values = 2 THEN 'binary' ELSE 'numerical' END AS kind FROM d
""",
    linked_tables=False,
)
def kinds(spark, sf):
    o = table(spark, sf, "orders").select("o_orderstatus", "o_custkey", (F.col("o_orderkey") % 2).alias("even"))
    return variable_kinds(o)


TABLE_TYPES = """
games: game_id bigint, competition_id string, season int, date date, home_club_id bigint, away_club_id bigint, home_club_goals int, away_club_goals int,
  home_club_position int, away_club_position int, attendance bigint, home_club_formation string, away_club_formation string, competition_type string, stadium string, home_club_name string
clubs: club_id bigint, name string, domestic_competition_id string, average_age double, stadium_name string, stadium_seats int, net_transfer_record string
competitions: competition_id string, name string, type string, country_name string
game_events: game_id bigint, club_id bigint, player_id bigint, number int, minute int, type string, description string
players: player_id bigint, name string, current_club_id bigint, date_of_birth string, height_in_cm double, sub_position string, foot string, market_value_in_eur double,
  country_of_citizenship string
appearances: game_id bigint, player_id bigint, player_club_id bigint, date date, assists int, goals int
player_valuations: valuation_id bigint, player_id bigint, date date, market_value_in_eur double
game_lineups: game_id bigint, club_id bigint, player_id bigint
"""


def _diagnostics_sql() -> str:
    parts = []
    for line in TABLE_TYPES.strip().replace("\n ", "").split("\n"):
        name, fields = line.split(": ")
        columns = [f.split() for f in fields.split(", ")]
        for column, kind in columns:
            parts.append(f"SELECT '{name}' AS \"table\", '{column}' AS \"column\", '{kind}' AS type, count(*) AS rows, {len(columns)} AS columns, count(*) - count({column}) AS nulls FROM {name}")
    return "\nUNION ALL ".join(parts)


@query("table_diagnostics", _diagnostics_sql())
def diagnostics(spark, sf):
    return table_diagnostics(linked(spark, sf))


BINS = """
WITH e AS (SELECT min({x})::DOUBLE AS lo, max({x})::DOUBLE AS hi, ({w} ) AS bins FROM {t}),
b AS (SELECT {t}.*, e.lo, (e.hi - e.lo) / e.bins AS width,
  least(coalesce(floor(({x}::DOUBLE - e.lo) / nullif((e.hi - e.lo) / e.bins, 0)), 0), e.bins - 1)::INTEGER AS bin FROM {t}, e WHERE {x} IS NOT NULL)
"""


@query(
    "histogram",
    BINS.format(x="attendance", w="30", t="games") + "SELECT bin, round(lo + bin * width, 6) AS bin_start, count(*) AS n FROM b GROUP BY bin, lo, width",
)
def hist(spark, sf):
    return rounded(histogram(games(spark, sf), "attendance", 30), "bin_start")


@query(
    "conditional_density",
    BINS.format(x="attendance", w="20", t="games")
    + """, n AS (SELECT bin, round(lo + bin * width, 6) AS s, competition_type, count(*) AS n FROM b GROUP BY ALL)
SELECT bin, competition_type, n, round(n / sum(n) OVER (PARTITION BY bin), 6) AS share FROM n
""",
)
def density(spark, sf):
    return rounded(conditional_density(games(spark, sf), "attendance", "competition_type", 20), "share")


POINTS = [0.0, 2.5, 5.0, 7.5, 10.0]


@query(
    "kernel_density",
    "\nUNION ALL ".join(
        f"SELECT {p}::DOUBLE AS x, round(avg(exp(-pow((value - {p}) / 2.0, 2) / 2)) / (2.0 * sqrt(2 * pi())), 6) AS density FROM events" for p in POINTS
    ),
    linked_tables=False,
)
def kernel(spark, sf):
    return rounded(kernel_density(table(spark, sf, "events"), "value", POINTS, 2.0), "density")


@query(
    "density_grid",
    """
WITH e AS (SELECT min(value) - 6.0 AS lo, (max(value) - min(value) + 12.0) / 255 AS step, count(*) AS n FROM events),
p AS (SELECT (value - lo) / step AS p FROM events, e),
i AS (SELECT least(floor(p), 254) AS i, p FROM p),
m AS (SELECT i, sum(m) AS m FROM (SELECT i, 1 - (p - i) AS m FROM i UNION ALL SELECT i + 1, p - i FROM i) GROUP BY i),
g AS (SELECT unnest(range(256)) AS point)
SELECT point, round(any_value(lo) + point * any_value(step), 6) + 0.0 AS x,
  round(sum(m * exp(-pow((point - i) * step / 2.0, 2) / 2)) / any_value(n) / (2.0 * sqrt(2 * pi())), 6) + 0.0 AS density
FROM g, m, e GROUP BY point
""",
    linked_tables=False,
)
def kernel_grid(spark, sf):
    return rounded(density_grid(table(spark, sf, "events"), "value", 2.0), "x", "density")


@query(
    "histogram_auto",
    """
WITH e AS (SELECT min(attendance)::DOUBLE AS lo, max(attendance)::DOUBLE AS hi, count(attendance) AS n,
  quantile_cont(attendance::DOUBLE, 0.75) - quantile_cont(attendance::DOUBLE, 0.25) AS q FROM games),
w AS (SELECT lo, hi, ceil((hi - lo) / least(2 * q / pow(n, 1.0::DOUBLE / 3), (hi - lo) / (log2(n) + 1))) AS bins FROM e),
b AS (SELECT lo + 0.0 AS lo, (hi - lo) / bins AS width, least(floor((attendance - lo) / ((hi - lo) / bins)), bins - 1)::INTEGER AS bin FROM games, w WHERE attendance IS NOT NULL)
SELECT bin, round(lo + bin * width, 6) + 0.0 AS bin_start, count(*) AS n FROM b GROUP BY bin, lo, width
""",
)
def hist_auto(spark, sf):
    return rounded(auto_histogram(games(spark, sf), "attendance"), "bin_start")


BOOTSTRAP = """
WITH r AS (SELECT game_id, {x} AS x, {y}::DOUBLE AS y FROM games WHERE {y} IS NOT NULL AND {x} IS NOT NULL),
d AS (SELECT x, y, d, md5(game_id || ':' || d || ':42') AS h FROM r, range(25) AS u(d)),
k AS (SELECT x, y, d * 8 + i AS b, ('0x' || substr(h, (4 * i + 1)::INTEGER, 4))::BIGINT AS u FROM d, range(8) AS v(i)),
w AS (SELECT x, y, b, (u >= 24110)::INTEGER + (u >= 48219)::INTEGER + (u >= 60274)::INTEGER + (u >= 64292)::INTEGER + (u >= 65297)::INTEGER
  + (u >= 65498)::INTEGER + (u >= 65531)::INTEGER AS w FROM k),
m AS (SELECT x, b, sum(y * w) / sum(w) AS m FROM w WHERE w > 0 GROUP BY x, b),
q AS (SELECT x, quantile_cont(m, 0.025) AS low, quantile_cont(m, 0.975) AS high FROM m GROUP BY x)
SELECT r.x AS {x}, count(*) AS n, round(avg(y), 5) + 0.0 AS mean, round(any_value(low), 5) + 0.0 AS low, round(any_value(high), 5) + 0.0 AS high
FROM r JOIN q ON r.x = q.x GROUP BY r.x
"""


@query("bootstrap_interval", BOOTSTRAP.format(x="competition_type", y="attendance"))
def bootstrapped(spark, sf):
    out = bootstrap_interval(games(spark, sf), "competition_type", "attendance", "game_id")
    return out.withColumns({c: F.round(c, 5) + F.lit(0.0) for c in ("mean", "low", "high")})


@query("bootstrap_line", BOOTSTRAP.format(x="season", y="home_club_goals"))
def bootstrapped_line(spark, sf):
    out = bootstrap_interval(games(spark, sf), "season", "home_club_goals", "game_id")
    return out.withColumns({c: F.round(c, 5) + F.lit(0.0) for c in ("mean", "low", "high")})


@query(
    "mean_interval",
    """
SELECT competition_type, count(attendance) AS n, round(avg(attendance), 6) AS mean,
  round(avg(attendance) - 1.96 * stddev_samp(attendance) / sqrt(count(attendance)), 6) AS low,
  round(avg(attendance) + 1.96 * stddev_samp(attendance) / sqrt(count(attendance)), 6) AS high FROM games GROUP BY 1
""",
)
def interval(spark, sf):
    return rounded(mean_interval(games(spark, sf), "competition_type", "attendance"), "mean", "low", "high")


@query(
    "mean_line",
    """
SELECT season, count(home_club_goals) AS n, round(avg(home_club_goals), 6) AS mean,
  round(avg(home_club_goals) - 1.96 * stddev_samp(home_club_goals) / sqrt(count(home_club_goals)), 6) AS low,
  round(avg(home_club_goals) + 1.96 * stddev_samp(home_club_goals) / sqrt(count(home_club_goals)), 6) AS high FROM games GROUP BY 1
""",
)
def line(spark, sf):
    return rounded(mean_interval(games(spark, sf), "season", "home_club_goals"), "mean", "low", "high")


BOX_COLS = ["q1", "median", "q3", "whisker_low", "whisker_high"]
BOX_SQL = """
WITH v AS (SELECT {key}, {x}::DOUBLE AS x FROM {t} WHERE {key} IS NOT NULL AND {x} IS NOT NULL),
q AS (SELECT {key}, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS med, quantile_cont(x, 0.75) AS q3 FROM v GROUP BY 1),
r AS (SELECT v.*, q1, med, q3, x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM v JOIN q USING ({key}))
SELECT {key}, count(*) AS n, round(max(q1), 6) AS q1, round(max(med), 6) AS median, round(max(q3), 6) AS q3,
  round(min(x) FILTER (inside), 6) AS whisker_low, round(max(x) FILTER (inside), 6) AS whisker_high, count(*) FILTER (NOT inside) AS outliers
FROM r GROUP BY 1
"""


@query("box_stats", BOX_SQL.format(key="season", x="attendance", t="games"))
def box(spark, sf):
    return rounded(box_stats(games(spark, sf), ["season"], "attendance"), *BOX_COLS)


@query("box_stats_events", BOX_SQL.format(key="event_type", x="value", t="events"), linked_tables=False)
def box_events(spark, sf):
    return rounded(box_stats(table(spark, sf, "events"), ["event_type"], "value"), *BOX_COLS)


@query(
    "scatter_sample",
    "SELECT game_id, attendance, home_club_goals FROM games WHERE ('0x' || substr(md5(game_id || ':42'), 1, 8))::BIGINT / 4294967296.0::DOUBLE < 0.05",
)
def scatter(spark, sf):
    return scatter_sample(games(spark, sf), "attendance", "home_club_goals", 0.05, ids=["game_id"])


@query(
    "goals_by_strategy_box",
    f"WITH s AS (SELECT {_case('home', 'home_club_formation')} AS strategy_home, home_club_goals FROM games), "
    + BOX_SQL.format(key="strategy_home", x="home_club_goals", t="s").strip().removeprefix("WITH "),
)
def goals_box(spark, sf):
    g = games(spark, sf).withColumn("strategy_home", rule_strategy(F.col("home_club_formation"), "home"))
    return rounded(box_stats(g, ["strategy_home"], "home_club_goals"), *BOX_COLS)

"""Projection, filters, joins by role and set operations on linked tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- projection -----------------------------------------------------------


def project_renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep, order and rename columns in one step: old name to new name."""
    return df.select(*[F.col(a).alias(b) for a, b in names.items()])


def suffixed(df: DataFrame, suffix: str, keep: Sequence[str] = ()) -> DataFrame:
    """All columns with a suffix, but for those in ``keep``."""
    return df.select(*[F.col(c).alias(c if c in keep else c + suffix) for c in df.columns])


def with_constants(df: DataFrame, cols: Sequence[str], value=0) -> DataFrame:
    return df.withColumns({c: F.lit(value) for c in cols})


def columns_of_kind(df: DataFrame, kind: str, without: str | None = None) -> list[str]:
    """Names of the ``number`` or ``text`` columns, less those containing ``without``."""
    base = {"number": T.NumericType, "text": T.StringType}[kind]
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, base)]
    return [n for n in names if without is None or without not in n]


def outcome(home: Column, away: Column) -> Column:
    """``home``, ``away`` or ``draw`` from two scores."""
    return F.when(home > away, "home").when(home < away, "away").otherwise("draw")


def with_row_order(df: DataFrame, out: str = "original_order") -> DataFrame:
    """Increasing row number in reading order, to sort by at the sink."""
    return df.withColumn(out, F.monotonically_increasing_id())


# --- filters --------------------------------------------------------------


def not_below(df: DataFrame, col: str, low) -> DataFrame:
    """Drop rows under ``low``; rows without a value stay."""
    return df.where((F.col(col) >= low) | F.col(col).isNull())


def rows_missing(df: DataFrame, *cols: str) -> DataFrame:
    """Rows in which all the named columns are NULL."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNull() for c in cols]))


def count_above(df: DataFrame, limits: Mapping[str, tuple[str, float]]) -> DataFrame:
    """One row of counts: output name to (column, threshold)."""
    return df.agg(*[F.count_if(F.col(c) > t).alias(o) for o, (c, t) in limits.items()])


def sample_fraction(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def stable_draw(seed: int, *ids: Column) -> Column:
    """Number in [0, 1) that depends on the row's ids and the seed only."""
    hexa = F.substring(F.md5(F.concat_ws(":", *[i.cast("string") for i in ids], F.lit(str(seed)))), 1, 8)
    return F.conv(hexa, 16, 10).cast("bigint") / F.lit(float(16**8))


# --- joins ----------------------------------------------------------------


def keep_known(df: DataFrame, key: str, other: DataFrame, other_key: str | None = None) -> DataFrame:
    """Rows whose key occurs in the other table (semi-join).

    The other side shrinks to distinct keys before it is shuffled; the join then
    reuses that partitioning.
    """
    ids = other.select(F.col(other_key or key).alias(key)).distinct()
    return df.join(ids, key, "left_semi")


def keep_known_either(df: DataFrame, key: str, other: DataFrame, roles: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in any of the role columns.

    The role columns become one column of distinct ids first, so that this stays
    an equi-join.
    """
    ids = other.select(F.explode(F.array(*[F.col(r) for r in roles])).alias(key)).distinct()
    return df.join(ids, key, "left_semi")


def side_join(
    facts: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    roles: Mapping[str, Mapping[str, str]],
    names: str = "{col}_{role}",
) -> DataFrame:
    """Left-join the same table once per role.

    ``roles`` maps a role such as ``home`` to {table key: fact column}; the other
    table columns arrive as ``{col}_{role}`` (or by the given pattern).
    """
    for role, mapping in roles.items():
        side = table.select(
            *[F.col(k).alias(mapping.get(k, k)) for k in keys],
            *[F.col(c).alias(names.format(col=c, role=role)) for c in table.columns if c not in keys],
        )
        facts = facts.join(side, [mapping.get(k, k) for k in keys], "left")
    return facts


def semi_cascade(tables: Mapping[str, DataFrame], kind: str = "domestic_league") -> dict[str, DataFrame]:
    """Cut all tables down to what the games of one competition type use.

    Clubs, competitions and events follow the games of that type; players and
    valuations follow the appearances kept; games without appearances leave last.
    """
    t = dict(tables)
    games = t["games"].where(F.col("competition_type") == kind)
    apps = keep_known(t["appearances"], "game_id", games)
    t["competitions"] = keep_known(t["competitions"], "competition_id", games)
    t["game_events"] = keep_known(t["game_events"], "game_id", games)
    t["clubs"] = keep_known_either(t["clubs"], "club_id", games, ["home_club_id", "away_club_id"])
    t["players"] = keep_known(t["players"], "player_id", apps)
    t["player_valuations"] = keep_known(t["player_valuations"], "player_id", apps)
    t["appearances"] = apps
    t["games"] = keep_known(games, "game_id", apps)
    return t


# --- stacking and folding roles ---------------------------------------------


def stack_roles(df: DataFrame, key: str, roles: Mapping[str, Mapping[str, str]], tag: str) -> DataFrame:
    """One row per (key, role) from one row per key, in a single pass.

    ``roles`` maps the role name to {output name: input column}.
    """
    rows = [
        F.struct(F.lit(role).alias(tag), *[F.col(src).alias(out) for out, src in cols.items()])
        for role, cols in roles.items()
    ]
    return df.select(key, F.explode(F.array(*rows)).alias("_r")).select(key, "_r.*")


def fold_roles(long: DataFrame, key: str, tag: str, roles: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """The reverse: ``{role}_{col}`` columns, one row per key."""
    picks = [
        F.max(F.when(F.col(tag) == role, F.col(c))).alias(f"{role}_{c}") for role in roles for c in cols
    ]
    return long.groupBy(key).agg(*picks)

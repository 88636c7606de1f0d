"""Formation text such as ``4-2-3-1`` or ``4-3-3 Attacking``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.functions.values import lookup

# The digit group inside a formation text, and the line-up that
# stands in for texts that cannot be read.
FORMATION_PATTERN = r"(\d+(?:-\d+)+)"
DEFAULT_LINES = (4, 4, 2)

# The strategy that each formation stands for, by side.
DEFENSIVE = (
    "4-3-3 Defending", "5-4-1", "5-3-2", "3-6-1", "4-5-1", "5-4-1 Diamond", "4-5-1 flat",
    "6-2-2", "6-1-3",
)
AGGRESSIVE = (
    "4-3-3 Attacking", "3-4-3", "3-5-2 Attacking", "5-2-3", "3-4-3 Diamond", "3-3-3-1",
    "4-2-4", "3-3-4",
)
BALANCED = (
    "4-2-3-1", "4-3-2-1", "4-4-2 double 6", "4-1-4-1", "4-3-1-2", "3-5-2 flat", "4-4-1-1",
    "4-4-2", "3-4-2-1", "3-5-2", "4-4-2 Diamond", "4-3-3", "3-4-1-2", "3-1-4-2", "4-1-3-2",
)
ONE_SIDE_ONLY = {
    "home": {"Defensive": ("2-7-1",), "Aggressive": ("2-5-3", "2-4-4"), "Balanced": ("4-6-0",)},
    "away": {"Defensive": ("5-1-4", "6-3-1"), "Aggressive": (), "Balanced": ("2-6-2",)},
}


def formation_digits(c: Column) -> Column:
    """The digit group of the text, NULL where there is none."""
    return F.nullif(F.regexp_extract(c, FORMATION_PATTERN, 1), F.lit(""))


def _lines(parts: Column, otherwise: Column) -> Column:
    four = F.array(parts[0], parts[1] + parts[2], parts[3])
    return F.when(F.size(parts) == 3, parts).when(F.size(parts) == 4, four).otherwise(otherwise)


def formation_strict(c: Column) -> Column:
    """[defenders, midfielders, attackers]; NULL unless it has 3 or 4 numbers.

    Four numbers are read as two midfield lines.
    """
    parts = F.transform(F.split(c, "-"), lambda p: p.try_cast("int"))
    clean = F.when(~F.exists(parts, lambda p: p.isNull()), parts)
    return _lines(clean, F.lit(None).cast("array<int>"))


def formation_lenient(c: Column) -> Column:
    """[defenders, midfielders, attackers], taking only the purely numeric parts.

    Anything but 3 or 4 such parts, and NULL, reads as the default line-up.
    """
    digits = F.filter(F.split(c, "-"), lambda p: p.rlike("^[0-9]+$"))
    parts = F.transform(digits, lambda p: p.cast("int"))
    return _lines(parts, F.array(*[F.lit(n) for n in DEFAULT_LINES]))


def strategy_table(side: str) -> dict[str, str]:
    common = {"Defensive": DEFENSIVE, "Aggressive": AGGRESSIVE, "Balanced": BALANCED}
    extra = ONE_SIDE_ONLY[side]
    return {f: name for name, fs in common.items() for f in (*fs, *extra[name])}


def rule_strategy(c: Column, side: str) -> Column:
    """Strategy by the fixed table of that side, ``Unknown`` when not listed."""
    return lookup(c, strategy_table(side), "Unknown")

"""Numeric and lookup expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Currency marks, scale suffixes and the typographic minus sign.
CURRENCY_MARKS = "€+"
SCALE_SUFFIXES = {"m": "e6", "k": "e3"}
MINUS_SIGN = "−"


def to_number(c: Column, to: str = "double") -> Column:
    """Cast that turns unreadable text into NULL instead of failing."""
    return c.try_cast(to)


def money(c: Column) -> Column:
    """Amount text such as ``€1.2m``, ``-770k`` or ``+€72.25m`` as a double.

    The marks may stand anywhere; ``+-0`` reads as plain zero.
    """
    text = F.translate(c, CURRENCY_MARKS + MINUS_SIGN, "")
    negative = c.contains("-") | c.contains(MINUS_SIGN)
    text = F.regexp_replace(text, "-", "")
    for suffix, exponent in SCALE_SUFFIXES.items():
        text = F.replace(text, F.lit(suffix), F.lit(exponent))
    size = text.try_cast("double")
    return F.when(negative & (size != 0), -size).otherwise(size)


def ratio(num: Column, den: Column, scale: float = 1.0) -> Column:
    """Quotient (times ``scale``); NULL on a zero denominator."""
    q = F.try_divide(num.cast("double"), den.cast("double"))
    return q if scale == 1.0 else q * F.lit(scale)


def clip_upper(c: Column, top: float) -> Column:
    """Cap at ``top``; NULL stays NULL."""
    return F.when(c > top, F.lit(top)).otherwise(c)


def replace_value(c: Column, old, new) -> Column:
    return F.when(c == old, F.lit(new)).otherwise(c)


def is_missing(c: Column, floating: bool = False) -> Column:
    return c.isNull() | F.isnan(c) if floating else c.isNull()


def lookup(c: Column, table: Mapping, default=None) -> Column:
    """Value of ``c`` in a small literal table, else ``default``."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    found = F.try_element_at(F.create_map(*pairs), c)
    return found if default is None else F.coalesce(found, F.lit(default))

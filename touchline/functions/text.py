"""Text predicates and accent folding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.functions.transliterate import transliterate


def contains_ignoring_case(c: Column, needle: str) -> Column:
    """True where the text holds ``needle`` in any case; NULL text counts as no."""
    return F.coalesce(F.lower(c).contains(needle.lower()), F.lit(False))


def contains_flag(c: Column, needle: str) -> Column:
    """1 where the text holds ``needle`` exactly, else 0 (also for NULL)."""
    return F.coalesce(c.contains(needle), F.lit(False)).cast("int")


def fold_accents(c: Column) -> Column:
    """Text in plain letters; those of alphabets without a table keep their letters and lose their marks."""
    return transliterate(c)

"""Text column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def first_word(c) -> Column:
    """Item 0 of a split on one space: '' stays '', null stays null,
    a leading space gives ''."""
    return F.split(_c(c), " ").getItem(0)


def first_char(c) -> Column:
    """First character, or null for null / empty text (the coded model field)."""
    return F.nullif(F.substring(_c(c), 1, 1), F.lit(""))

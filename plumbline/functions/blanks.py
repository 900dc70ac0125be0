"""Blank and placeholder tests as columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.config import DISGUISED_BLANKS, WHITESPACE


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def is_placeholder(c: Column, words: Sequence[str] = DISGUISED_BLANKS) -> Column:
    """A text that only means "nothing here", blank text included; null is not one."""
    return F.coalesce(F.lower(strip(c)).isin(list(words)), F.lit(False))


def is_filled(c: Column, words: Sequence[str] = DISGUISED_BLANKS) -> Column:
    """Neither null nor blank nor a placeholder."""
    return ~F.coalesce(F.lower(strip(c)).isin(list(words)), F.lit(True))

"""Cleaning predicates of the prep step (all pushed down where possible)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadweave.schema import DELETED_AUTHOR


def author_present(col: str = "author") -> Column:
    """Not null and not the deleted marker (null rows are dropped)."""
    return ~(F.col(col).isNull() | (F.col(col) == F.lit(DELETED_AUTHOR)))


def has_comments(col: str = "num_comments") -> Column:
    """``NOT (num_comments = 0)``: under 3-valued logic a null count is dropped too."""
    return ~(F.col(col) == F.lit(0))


def subreddit_in(names: Iterable[str], col: str = "subreddit") -> Column:
    """Case-sensitive allow-list."""
    return F.col(col).isin(list(names))

"""Prep step: clean posts and comments, derive hashed ids, trim columns.

Filters come before the hash columns so Catalyst can push them to the scan
(filters on expression output are not pushed).  Comments are trimmed to a
keep-list; posts lose the columns of a drop-list, so other columns that drift
in from month to month pass through.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadweave.functions import author_present, has_comments, java_string_hash, subreddit_in
from threadweave.schema import COMMENT_KEEP_COLUMNS, MONTH_COL, SEASON_DROP_COLUMNS, SUBMISSION_DROP_COLUMNS


def remove_deleted_authors(df: DataFrame) -> DataFrame:
    return df.filter(author_present())


def remove_zero_comment_posts(df: DataFrame) -> DataFrame:
    return df.filter(has_comments())


def filter_subreddits(df: DataFrame, allow: Iterable[str] | None) -> DataFrame:
    """Keep allow-listed subreddits; ``allow=None`` switches the filter off."""
    return df if allow is None else df.filter(subreddit_in(allow))


# Id modes.  "hash" (default) reproduces the original identity: the 32-bit
# Java string hash, one id space for posts, users and subreddits — birthday
# collisions grow as n^2/2^33 (~1e4 colliding pairs at 1e7 posts), silently
# joining wrong posts or merging users at large scale.  "name" keeps the
# string keys themselves, prefixed so users and subreddits never share an id.
ID_MODES = ("hash", "name")
_NAME_PREFIX = {"author": "u/", "subreddit": "r/"}


def with_hash(df: DataFrame, source: str, target: str, id_mode: str = "hash") -> DataFrame:
    if id_mode == "hash":
        return df.withColumn(target, java_string_hash(source))
    if id_mode == "name":
        prefix = _NAME_PREFIX.get(source)
        col = F.col(source) if prefix is None else F.concat(F.lit(prefix), F.col(source))
        return df.withColumn(target, col)
    raise ValueError(f"id_mode must be one of {ID_MODES}")


def trim_submissions(df: DataFrame, drop: Iterable[str] = SUBMISSION_DROP_COLUMNS) -> DataFrame:
    dropped = set(drop)
    return df.select(*[c for c in df.columns if c not in dropped])


def trim_comments(df: DataFrame) -> DataFrame:
    keep = list(COMMENT_KEEP_COLUMNS) + ([MONTH_COL] if MONTH_COL in df.columns else [])
    return df.select(*keep)


def clean_submissions(raw: DataFrame, allow: Iterable[str] | None = None) -> DataFrame:
    """Posts with an author and comments, in the allowed subreddits."""
    return remove_zero_comment_posts(filter_subreddits(remove_deleted_authors(raw), allow))


def clean_comments(raw: DataFrame, allow: Iterable[str] | None = None) -> DataFrame:
    """Comments with an author, in the allowed subreddits."""
    return filter_subreddits(remove_deleted_authors(raw), allow)


def prep_submissions(raw: DataFrame, allow: Iterable[str] | None = None, id_mode: str = "hash") -> DataFrame:
    """Cleaned posts; adds link_hash, op_id, sub_id."""
    df = clean_submissions(raw, allow)
    df = with_hash(df, "name", "link_hash", id_mode)
    df = with_hash(df, "author", "op_id", id_mode)
    df = with_hash(df, "subreddit", "sub_id", id_mode)
    return trim_submissions(df)


def prep_comments(raw: DataFrame, allow: Iterable[str] | None = None, id_mode: str = "hash") -> DataFrame:
    """Cleaned comments; adds link_hash, auth_id, sub_id; keeps 11 columns (+ month)."""
    df = clean_comments(raw, allow)
    df = with_hash(df, "link_id", "link_hash", id_mode)
    df = with_hash(df, "author", "auth_id", id_mode)
    df = with_hash(df, "subreddit", "sub_id", id_mode)
    return trim_comments(df)


def prep_season_posts(raw: DataFrame, allow: Iterable[str] | None = None, id_mode: str = "hash") -> DataFrame:
    """Season variant: one drop-list, ids link_hash and auth_id (renamed op_id later)."""
    df = trim_submissions(raw, SEASON_DROP_COLUMNS)
    df = remove_deleted_authors(remove_zero_comment_posts(df))
    df = filter_subreddits(df, allow)
    return with_hash(with_hash(df, "name", "link_hash", id_mode), "author", "auth_id", id_mode)


def prep_season_comments(raw: DataFrame, allow: Iterable[str] | None = None, id_mode: str = "hash") -> DataFrame:
    df = trim_submissions(raw, SEASON_DROP_COLUMNS)
    df = filter_subreddits(remove_deleted_authors(df), allow)
    return with_hash(with_hash(df, "link_id", "link_hash", id_mode), "author", "auth_id", id_mode)

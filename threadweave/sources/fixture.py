"""Discussion tables derived from the driver's test tables.

The test data has no posts or comments, so ``orders`` plays the posts and
``lineitem`` the comments (one comment per line item, on the post of its
order).  Customer and part keys share the author space ``u<n>`` so that the
user graph has real cycles.  Subreddit = ``<orderpriority>/<orderstatus>``
(15 values).  Every row of both source tables is used.

Some source columns that the pipeline has no use for carry names from its
drop-lists (score, domain, gilded, edited, ...), so trimming has work to do.

Slices are date ranges on ``created_utc``; they are written as range
predicates so Catalyst pushes them to the parquet scan of ``orders``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadweave.sources.tables import read_table

# Periods that play the three "months" of the season variant, and the
# four-month slice; half-open [start, end) ranges on created_utc.
SEASON_PERIODS: dict[str, tuple[str, str]] = {
    "T1": ("1996-01-01", "1996-05-01"),
    "T2": ("1996-05-01", "1996-09-01"),
    "T3": ("1996-09-01", "1997-01-01"),
}
SEASON_LABEL = "season"
SLICE4_MONTHS = ("1996-06", "1996-07", "1996-08", "1996-09")

# Allow-list used with the fixture data for the subreddit filter: the
# subreddits whose status part is F or O.
FIXTURE_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
FIXTURE_ALLOW_LIST = tuple(f"{p}/{s}" for p in FIXTURE_PRIORITIES for s in ("F", "O"))

# Authors looked up by the author report.
FIXTURE_AUTHORS = ("u0", "u1")


def _subreddit(o_priority: str = "o_orderpriority", o_status: str = "o_orderstatus") -> Column:
    return F.concat(F.col(o_priority), F.lit("/"), F.col(o_status))


def submissions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw posts: name, author, subreddit, subreddit_id, num_comments, created_utc, month;
    to be dropped: score, domain."""
    orders = read_table(spark, sf_dir, "orders")
    per_order = (read_table(spark, sf_dir, "lineitem")
                 .groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")))
    o = orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
    key = F.col("o_custkey") % 50
    return o.select(
        F.concat(F.lit("t3_"), F.col("o_orderkey").cast("string")).alias("name"),
        F.when(key == 7, F.lit("[deleted]")).when(key == 8, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("u"), F.col("o_custkey").cast("string"))).alias("author"),
        _subreddit().alias("subreddit"),
        F.concat(F.lit("t5_"), _subreddit()).alias("subreddit_id"),
        F.coalesce(F.col("n"), F.lit(0).cast("bigint")).alias("num_comments"),
        F.col("o_orderdate").alias("created_utc"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        F.col("o_totalprice").alias("score"),
        F.col("o_orderstatus").alias("domain"),
    )


def comments_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw comments: id, link_id, parent_id, body, author, subreddit, subreddit_id, created_utc, month;
    to be dropped: score, gilded, controversiality, edited, retrieved_on."""
    li = read_table(spark, sf_dir, "lineitem")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", "o_orderstatus", "o_orderdate")
    j = li.join(orders, li.l_orderkey == orders.o_orderkey)
    link = F.concat(F.lit("t3_"), F.col("l_orderkey").cast("string"))
    return j.select(
        F.concat(F.lit("t1_"), F.col("l_orderkey").cast("string"), F.lit("_"),
                 F.col("l_linenumber").cast("string")).alias("id"),
        link.alias("link_id"),
        link.alias("parent_id"),
        F.concat("l_returnflag", "l_linestatus").alias("body"),
        F.when(F.col("l_partkey") % 50 == 9, F.lit("[deleted]"))
         .otherwise(F.concat(F.lit("u"), F.col("l_partkey").cast("string"))).alias("author"),
        _subreddit().alias("subreddit"),
        F.concat(F.lit("t5_"), _subreddit()).alias("subreddit_id"),
        F.col("o_orderdate").alias("created_utc"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        F.col("l_quantity").alias("score"),
        F.col("l_linenumber").alias("gilded"),
        F.col("l_discount").alias("controversiality"),
        F.col("l_returnflag").alias("edited"),
        F.col("l_shipdate").alias("retrieved_on"),
    )


def in_range(start: str, end: str, col: str = "created_utc") -> Column:
    return (F.col(col) >= F.lit(start).cast("timestamp_ntz")) & (F.col(col) < F.lit(end).cast("timestamp_ntz"))


def period_label(periods: dict[str, tuple[str, str]] = SEASON_PERIODS, col: str = "created_utc") -> Column:
    expr = None
    for label, (start, end) in periods.items():
        cond = in_range(start, end, col)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def periods_span(periods: dict[str, tuple[str, str]] = SEASON_PERIODS) -> tuple[str, str]:
    return min(s for s, _ in periods.values()), max(e for _, e in periods.values())

"""Joins of a large edge table with a per-vertex state table.

Graph iterations join edges (billions of rows) with one state row per vertex
(rank, colour, ...).  Two plans, picked from counted sizes:

* **broadcast** — the state table has at most ``threadweave.broadcast.maxRows``
  rows (counted, so the bound is checked); edges never move and a hot vertex
  costs nothing extra.  A join made once (``join_state``) also keeps the table
  within a share of the driver's heap, as the driver builds it;
* **skew split** — otherwise.  Keys with more than T edge rows are *hot*; with
  T = max(minHotRows, |E| / maxHotKeys) there are at most maxHotKeys of them
  (pigeonhole), so the hot keys and their state rows have a proven bound and
  are broadcast; edges of hot keys join map-side, the rest by a normal shuffle
  join in which no key exceeds T rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from math import ceil

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadweave.runtime import (
    CONF_BROADCAST_ROWS, CONF_HOT_MAX_KEYS, CONF_HOT_MIN_ROWS, broadcast_bytes, conf_int, cut, cut_placed, partitions_for,
)


#: A string column counts as so many numbers when a table's size is bounded.
STRING_WEIGHT = 3

#: Bytes of a row of a few numbers in a broadcast hash table, as measured (67 MB
#: for 864,000 posts), and of an id in a row's list.
ROW_BYTES, ID_BYTES = 80, 4


def row_weight(df: DataFrame) -> int:
    """How many rows of a few numbers a row like those of ``df`` counts as: string
    columns (name ids) weigh more."""
    strings = sum(f.dataType.typeName() in ("string", "varchar", "char") for f in df.schema)
    return 1 + STRING_WEIGHT * strings


def broadcast_ok(df: DataFrame, rows: int) -> bool:
    """Whether ``rows`` rows like those of ``df`` are within the broadcast bound,
    which is for rows of a few numbers."""
    return rows * row_weight(df) <= conf_int(df.sparkSession, CONF_BROADCAST_ROWS)


def fits_driver(df: DataFrame, rows: int, ids: int = 0) -> bool:
    """Whether the driver can build a hash table of ``rows`` rows like those of
    ``df``, with ``ids`` ids in all their lists."""
    return (ROW_BYTES * rows + ID_BYTES * ids) * row_weight(df) <= broadcast_bytes(df.sparkSession)


def hot_keys(edges: DataFrame, keys: Sequence[str], n_edges: int, max_keys: int | None = None) -> DataFrame | None:
    """Keys carrying more than T rows; at most ``max_keys`` (default
    maxHotKeys) of them by construction.

    Returns None when no key can be hot (|E| <= minHotRows).
    """
    spark = edges.sparkSession
    min_rows = conf_int(spark, CONF_HOT_MIN_ROWS)
    if n_edges <= min_rows:
        return None
    limit = min(max_keys or conf_int(spark, CONF_HOT_MAX_KEYS), conf_int(spark, CONF_HOT_MAX_KEYS))
    threshold = max(min_rows, ceil(n_edges / limit))
    return (edges.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") > threshold).select(*keys))


def join_state(edges: DataFrame, state: DataFrame, keys: Sequence[str], state_rows: int,
               hot: DataFrame | None = None, how: str = "inner", ids: int = 0) -> DataFrame:
    """``edges ⋈ state`` on ``keys`` (state is unique on keys, ``ids``: ids in lists of its rows)."""
    keys = list(keys)
    if broadcast_ok(state, max(state_rows, ids)) and fits_driver(state, state_rows, ids):
        return edges.join(F.broadcast(state), keys, how)
    if hot is None:
        return edges.join(state, keys, how)
    hot_b = F.broadcast(hot)
    cold_part = edges.join(hot_b, keys, "left_anti").join(state, keys, how)
    hot_state = state.join(hot_b, keys, "left_semi")
    hot_part = edges.join(hot_b, keys, "left_semi").join(F.broadcast(hot_state), keys, how)
    return cold_part.unionByName(hot_part)


def semi_or_anti(df: DataFrame, keys_df: DataFrame, keys: Sequence[str], keys_rows: int, how: str) -> DataFrame:
    """``left_semi``/``left_anti`` against a key set, broadcast when its count allows."""
    keys_df = F.broadcast(keys_df) if broadcast_ok(keys_df, keys_rows) else keys_df
    return df.join(keys_df, list(keys), how)


@dataclass
class EdgeLayout:
    """Edges prepared once for many joins with changing state on one key.

    Under the broadcast bound ``cold`` is the plain edge table.  Beyond it the
    cold edges are partitioned and sorted by the key and kept, so a join
    shuffles only the state; the edges of hot keys lie apart (``hot``) and
    meet a broadcast state of at most maxHotKeys rows."""

    keys: list[str]
    cold: DataFrame
    hot: DataFrame | None = None
    hot_set: DataFrame | None = None
    kept: bool = False

    def join(self, state: DataFrame, state_rows: int, how: str = "inner") -> DataFrame:
        """``edges ⋈ state`` (state is unique on the key, ``state_rows`` rows at most)."""
        if broadcast_ok(state, state_rows):
            return self.all_edges().join(F.broadcast(state), self.keys, how)
        cold = self.cold.join(state, self.keys, how)
        if self.hot is None:
            return cold
        hot_state = state.join(F.broadcast(self.hot_set), self.keys, "left_semi")
        return cold.unionByName(self.hot.join(F.broadcast(hot_state), self.keys, how))

    def all_edges(self) -> DataFrame:
        return self.cold if self.hot is None else self.cold.unionByName(self.hot)

    def release(self) -> None:
        if self.kept:
            self.cold.unpersist()

    def among(self, alive: DataFrame) -> EdgeLayout:
        """The edges with a key in ``alive`` (partitioned like the states), written
        where they lie and kept; beyond the broadcast bound."""
        cold, _ = cut_placed(self.cold.join(alive, self.keys, "left_semi"), "edges-among")
        hot = self.hot
        if hot is not None:
            hot = cut(hot.join(F.broadcast(alive.join(F.broadcast(self.hot_set), self.keys, "left_semi")), self.keys, "left_semi"), "hot-edges")
        return EdgeLayout(self.keys, cold.persist(StorageLevel.MEMORY_AND_DISK), hot, self.hot_set, kept=True)

    def count_keys(self, name: str) -> DataFrame:
        """Edges per key: (keys, name); where the edges lie, without an exchange beyond the bound."""
        n = F.count(F.lit(1)).alias(name)
        counts = self.cold.groupBy(*self.keys).agg(n)
        return counts if self.hot is None else counts.unionByName(self.hot.groupBy(*self.keys).agg(n))


def lay_out(edges: DataFrame, keys: Sequence[str], n_edges: int, state_rows: int,
            build: Callable[[DataFrame], DataFrame] = lambda df: df) -> EdgeLayout:
    """Lay ``edges`` (a written table of ``n_edges`` rows) out for joins on
    ``keys`` with states of at most ``state_rows`` rows.

    ``build`` makes the wanted edges from rows that hold whole keys (distinct
    edges, weights), so it runs where the rows already lie.  The number of
    partitions follows the counted rows.  A lost partition is recomputed from
    the written table."""
    keys = list(keys)
    spark = edges.sparkSession
    if broadcast_ok(edges, state_rows):
        return EdgeLayout(keys, build(edges))
    hot_set, hot, cold = hot_keys(edges, keys, n_edges), None, edges
    if hot_set is not None:
        hot_set = cut(hot_set, "hot-keys")
        hot = cut(build(edges.join(F.broadcast(hot_set), keys, "left_semi")), "hot-edges")
        cold = edges.join(F.broadcast(hot_set), keys, "left_anti")
    cold = build(cold.repartition(partitions_for(spark, n_edges), *keys))
    cold = cold.sortWithinPartitions(*keys).persist(StorageLevel.MEMORY_AND_DISK)
    return EdgeLayout(keys, cold, hot, hot_set, kept=True)


@dataclass
class GraphLayout:
    """Edges laid out by both ends, with the hot sources and the hot targets
    apart, for loops that send along edges in both directions.  Beyond the
    broadcast bound the edges move twice, here, and never again: a loop that
    works on fewer and fewer vertices sends from those only, and ignores what
    arrives elsewhere."""

    by_src: EdgeLayout
    by_dst: EdgeLayout

    @classmethod
    def of(cls, edges: DataFrame, group: Sequence[str], n_edges: int, state_rows: int,
           build: Callable[[DataFrame], DataFrame] = lambda df: df) -> GraphLayout:
        return cls(*(lay_out(edges, [*group, end], n_edges, state_rows, build) for end in ("src", "dst")))

    def among(self, alive: DataFrame) -> GraphLayout:
        """By source the edges out of ``alive`` vertices, by target those into them: (group..., id)."""
        return GraphLayout(self.by_src.among(alive.withColumnRenamed("id", "src")), self.by_dst.among(alive.withColumnRenamed("id", "dst")))

    def release(self) -> None:
        self.by_src.release()
        self.by_dst.release()

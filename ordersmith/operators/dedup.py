"""Keep one row per key.

Two plans give the same rows when the order is total:

* ``window``: ``row_number() over (partition by keys order by ...) = 1``. Spark
  plans a partial ``WindowGroupLimit`` in front of the shuffle, so each map task
  sends at most one row per key: a key holding a third of all rows does not
  land whole in one task.
* ``aggregate``: ``max_by(struct(row), struct(order))`` per key, with partial
  aggregation before the shuffle. The ranking is "larger wins", so a
  preference for smaller values must be expressed by the caller (for
  example by negating a numeric column).

Callers give a total order (end it with a unique column) so the kept row does
not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
               method: str = "window") -> DataFrame:
    """Per key, the first row by ``order`` (a list of sorted columns such as
    ``F.col("event_time").desc_nulls_last()``)."""
    keys = list(keys)
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)
    raise ValueError(f"unknown method {method!r}")


def keep_max(df: DataFrame, keys: Sequence[str], ranking: Sequence[Column]) -> DataFrame:
    """Aggregate form: per key, the row with the largest ``struct(*ranking)``.

    Null ranks lowest, like ``desc nulls last``. Pre-aggregates before the
    shuffle, so hot keys are reduced on the map side.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    rank = F.struct(*[r.alias(f"r{i}") for i, r in enumerate(ranking)])
    best = F.max_by(F.struct(*others), rank).alias("__row")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col("__row")[c].alias(c) for c in others])


def latest_per_key(df: DataFrame, keys: Sequence[str], time_col: str,
                   tie_breakers: Sequence[Column] = (), method: str = "window") -> DataFrame:
    """Latest ``time_col`` per key; null times lose; ties broken by
    ``tie_breakers`` (e.g. ``offset desc``)."""
    if method == "aggregate":
        return keep_max(df, keys, [F.col(time_col), *tie_breakers])
    order = [F.col(time_col).desc_nulls_last(), *tie_breakers]
    return keep_first(df, keys, order)


def first_on_tie(df: DataFrame, keys: Sequence[str], time_col: str,
                 arrival: Sequence[Column]) -> DataFrame:
    """Latest time per key, where a missing time counts as '' and among equal
    times the row that arrived first stays (``arrival`` ascending)."""
    order = [F.coalesce(F.col(time_col), F.lit("")).desc(), *arrival]
    return keep_first(df, keys, order)


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """``DISTINCT ON (keys) ... ORDER BY keys, order``; the remaining
    columns (ascending, nulls last) complete the order so the result is stable."""
    keys = list(keys)
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    return keep_first(df, keys, [*order, *rest])

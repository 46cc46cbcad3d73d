"""Upsert and insert-if-absent (K4 K5 K6, R2).

Both are joins on the primary key, so they shuffle both sides once by the key
and scale with the table. The source must hold one row per key (the callers
reduce it: the later row wins). Source rows with a null key are left out: a key
that never matches would add a row with every load.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_T, _S = "__in_target", "__in_source"


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str], newer_col: str | None = None) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE SET update_cols``.

    * a key only in the source is inserted with all its columns;
    * a key in both takes ``update_cols`` from the source (an update to null is a
      real update) and keeps every other column of the target;
    * a key only in the target is kept.

    With ``newer_col`` (R2) the update happens only if the source's value of
    that column is larger than the target's (text comparison, null as ''), and
    ``newer_col`` moves with the update columns; so a late or repeated event
    never overwrites a newer one. The output has the target's columns.
    """
    keys = list(keys)
    cols = [c for c in target.columns if c not in keys]
    upd = set(update_cols) | ({newer_col} if newer_col else set())
    t = target.withColumn(_T, F.lit(True)).alias("t")
    s = source.dropna(subset=keys).select(*keys, *[c for c in cols if c in source.columns]) \
        .withColumn(_S, F.lit(True)).alias("s")
    j = t.join(s, on=keys, how="full_outer")
    in_t = F.col(f"t.{_T}").isNotNull()
    in_s = F.col(f"s.{_S}").isNotNull()
    take_update = in_s
    if newer_col:
        newer = F.coalesce(F.col(f"s.{newer_col}"), F.lit("")) > \
            F.coalesce(F.col(f"t.{newer_col}"), F.lit(""))
        take_update = in_s & (~in_t | newer)
    out: list[Column] = [F.col(k) for k in keys]
    for c in cols:
        src = F.col(f"s.{c}") if c in source.columns else F.lit(None)
        tgt = F.col(f"t.{c}")
        typ = target.schema[c].dataType
        if c in upd:
            out.append(F.when(take_update, src.cast(typ)).otherwise(tgt).alias(c))
        else:
            out.append(F.when(in_t, tgt).otherwise(src.cast(typ)).alias(c))
    return j.select(*out)


def only_new(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``source`` whose key is complete and not in ``target``."""
    keys = list(keys)
    return source.dropna(subset=keys).join(target.select(*keys), on=keys, how="left_anti")


def insert_new(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``INSERT ... ON CONFLICT DO NOTHING``: source rows whose key is not in the
    target are appended (the source must hold one row per key: see dedup)."""
    return target.unionByName(only_new(target, source, keys).select(*target.columns))

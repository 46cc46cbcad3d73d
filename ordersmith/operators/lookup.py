"""Lookup joins (J1 J2 J3), heavy keys, and the size check in front of a broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only after proving it has at most ``max_rows`` rows.

    The proof reads at most ``max_rows + 1`` rows (``limit`` stops the scan),
    so it is cheap whatever the table holds. Beyond the bound the frame is
    returned as is: the join then shuffles, and AQE may still switch to a
    broadcast once the measured shuffle size is small.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def enrich(left: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Left equi-join on one key, lookup columns appended, key first.

    No broadcast hint: the lookup grows with the data (customers). AQE measures
    the lookup side after its shuffle and broadcasts it only if small; a skewed
    key on the left is split by AQE's skew-join handling.
    """
    return left.join(lookup, on=key, how="left")


HEAVY = 256                   # keys that are told apart as heavy, at most
TRACKED = 1 << 14             # keys a sketch keeps: counts are off by 3.5 rows in so many, at most


def heavy_keys(df: DataFrame, key: str, share: float = 1 / 1024) -> list:
    """Keys that hold more than ``share`` of the rows of ``df``, at most ``HEAVY`` of them.

    Found by a frequent-items sketch of fixed size in every task, merged in the end; no
    shuffle of keys. Keys whose share is well above the sketch's error (3.5 / ``TRACKED``) are
    never missed; a key too many costs one more broadcast row.
    """
    found = df.agg(F.expr(f"approx_top_k(`{key}`, {HEAVY}, {TRACKED})").alias("top"),
                   F.count(key).alias("n")).first()
    return [r["item"] for r in found["top"] or [] if r["item"] is not None and r["count"] > share * found["n"]]


def enrich_skewed(left: DataFrame, lookup: DataFrame, key: str, heavy: list, spread: str) -> DataFrame:
    """:func:`enrich`, with rows of ``heavy`` keys kept out of the shuffle by ``key``.

    The lookup's rows of those keys (``lookup`` holds a key once, so no more rows than
    ``heavy`` has) are broadcast. All other rows meet the lookup by key; rows that are already
    served, or have no key, go there under a key that no lookup row has, made of the column
    ``spread``, so they are dealt evenly and not to one task.
    """
    if not heavy:
        return enrich(left, lookup, key)
    names = [c for c in lookup.columns if c != key]
    served = lookup.where(F.col(key).isin(heavy)).select(
        key, F.lit(True).alias("__served"), F.struct(*names).alias("__hot"))
    near = left.join(F.broadcast(served), key, "left")
    done = F.col("__served").isNotNull() | F.col(key).isNull()
    own = F.struct(F.when(done, F.col(spread).cast("string")).alias("spread"),
                   F.when(~done, F.col(key)).alias("key"))
    far = lookup.where(~F.col(key).isin(heavy)).select(
        F.struct(F.lit(None).cast("string").alias("spread"), F.col(key).alias("key")).alias("__own"),
        F.struct(*names).alias("__cold"))
    out = near.withColumn("__own", own).join(far, "__own", "left")
    value = F.coalesce("__hot", "__cold")
    return out.select(*left.columns, *[value[n].alias(n) for n in names])

"""Interleaving sources to target weights by Pfair scheduling.

A source of weight w gets its block j (from 0) in the slots between its release
``floor(j / w)`` and its deadline ``ceil((j + 1) / w)``; one block goes out per slot, the
released one with the earliest deadline. So after every slot each source has
had its weighted share to within less than one block. Weights are exact fractions over the
whole run, never rounded to a number of slots.

The schedule is worked out ahead, block by block, in one pass on the driver: time grows
with the number of blocks (rows / ``block_rows``), memory does not, as finished chunks of
it are written to the shared folder.

All rows stay in DataFrame operations. A row's rank in its source is a count
of smaller keys, taken in two levels (rows within a key bucket, buckets within
the source), so a source with a third of all rows meets no single task. A bucket's blocks
come with its base, so rows are shuffled once.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .staging import require

MAX_SOURCES = 10_000
MAX_FRAME = 1 << 16
CHUNK = 1 << 18           # blocks of the schedule that the driver holds
ADDED = ["block", "release", "deadline", "slot", "position", "on_target"]


def frame_shares(weights: dict[str, float], frame: int | None = None) -> tuple[dict[str, int], int]:
    """Slots per frame of each source: weights rounded by largest remainder, one at least.
    For callers that want a short frame to repeat; ``mix_sources`` does not round."""
    live = {s: w for s, w in weights.items() if w > 0}
    if not live:
        return {}, 0
    frame = frame or min(MAX_FRAME, max(1000, 4 * len(live)))
    if len(live) > frame:
        raise ValueError(f"{len(live)} sources do not fit {frame} slots")
    total = sum(live.values())
    spare = frame - len(live)
    ideal = {s: max(0.0, frame * w / total - 1) for s, w in live.items()}
    scale = spare / sum(ideal.values()) if sum(ideal.values()) else 0
    share = {s: 1 + math.floor(x * scale) for s, x in ideal.items()}
    rest = sorted(live, key=lambda s: (math.floor(ideal[s] * scale) - ideal[s] * scale, s))
    for s in rest[:frame - sum(share.values())]:
        share[s] += 1
    return share, sum(share.values())


def exact_weights(weights: dict[str, float]) -> tuple[dict[str, int], int]:
    """The positive weights as integers over a common total, without rounding."""
    live = {s: Fraction(w) for s, w in weights.items() if w > 0}
    unit = math.lcm(*(w.denominator for w in live.values()))
    whole = {s: int(w * unit) for s, w in live.items()}
    return whole, sum(whole.values())


def edf(weight: dict[str, int], total: int, blocks: dict[str, int]) \
        -> Iterator[tuple[str, int, int, int, int]]:
    """(source, block, slot, release, deadline) by earliest deadline among released blocks,
    for the first ``blocks`` of each source of weight ``weight / total``."""
    waiting = [(0, s, 0) for s in sorted(weight) if blocks[s] > 0]     # release, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int, int]] = []           # deadline, source, block, release
    slot = 0
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])               # sources that ran out leave slots empty
        while waiting and waiting[0][0] <= slot:
            release, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * total // weight[s]), s, j, release))
        deadline, s, j, release = heapq.heappop(ready)
        yield s, j, slot, release, deadline
        slot += 1
        if j + 1 < blocks[s]:
            heapq.heappush(waiting, ((j + 1) * total // weight[s], s, j + 1))


def edf_frame(share: dict[str, int], frame: int) -> list[tuple[str, int, int]]:
    """(source, block of the frame, slot) by earliest deadline among released blocks."""
    return [row[:3] for row in edf(share, frame, share)]


PLAN = "__source string, block long, slot long, release long, deadline long"


def _plan(spark: SparkSession, weights: dict[str, float], blocks: dict[str, int]) -> tuple[DataFrame, int]:
    """Schedule of all blocks, and the slot in which the first source has run out."""
    weight, total = exact_weights(weights)
    # one block more than there is, to see when it would have been due
    turns = edf(weight, total, {s: blocks[s] + 1 for s in weight})
    path, horizon, written = scratch_path(spark, "mix-plan"), None, False
    while chunk := list(islice(turns, CHUNK)):
        past = [t for s, j, t, _, _ in chunk if j == blocks[s]]
        horizon = min(past + ([] if horizon is None else [horizon]), default=None)
        rows = [r for r in chunk if r[1] < blocks[r[0]]]
        if rows:
            source, *numbers = zip(*rows)
            table = pa.table([pa.array(source, pa.string()), *(pa.array(c, pa.int64()) for c in numbers)],
                             names=["__source", "block", "slot", "release", "deadline"])
            spark.createDataFrame(table, PLAN).write.mode("append").parquet(path)
            written = True
    plan = spark.read.schema(PLAN).parquet(path) if written else spark.createDataFrame([], PLAN)
    return plan, horizon or 0


def source_rank(df: DataFrame, source: str, key: Column, block_rows: int, plan: DataFrame) -> DataFrame:
    """Adds ``__rank``: rows of the same source with a smaller ``key`` (hex text), from 0; and
    ``__turn``: the plan's (slot, release, deadline) of the row's block."""
    near = Window.partitionBy(source, "__bucket").orderBy("__key", "__tie")
    rows = (df.withColumn("__key", key).withColumn("__bucket", F.substring("__key", 1, 3))
            .withColumn("__at", F.row_number().over(near) - 1))
    counts = df.groupBy(source, F.substring(key, 1, 3).alias("__bucket")).count()
    before = Window.partitionBy(source).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(source, "__bucket", F.coalesce(F.sum("count").over(before), F.lit(0))
                         .alias("__base"), "count")
    # the blocks that a bucket has rows of, in order
    turns = (base.withColumn("block", F.explode(F.expr(
                f"sequence(__base div {block_rows}, (__base + count - 1) div {block_rows})")))
             .join(plan, [source, "block"], "left")
             .groupBy(source, "__bucket").agg(F.min("__base").alias("__base"), F.array_sort(F.collect_list(
                 F.struct("block", "slot", "release", "deadline"))).alias("__turns")))
    first = F.expr(f"__base div {block_rows}")
    return (rows.join(turns, [source, "__bucket"])
            .withColumn("__rank", F.col("__base") + F.col("__at"))
            .withColumn("block", F.expr(f"__rank div {block_rows}"))
            .withColumn("__turn", F.get("__turns", (F.col("block") - first).cast("int")))
            .drop("__key", "__bucket", "__at", "__base", "__turns"))


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, id_col: str = "doc_id",
                source_col: str = "source", block_rows: int = 16, power: float = 0.5) -> DataFrame:
    """``docs`` with block, release, deadline, slot, position and on_target (ADDED).

    ``weights``: target share of each source's blocks; by default in proportion
    to its number of rows to the ``power``. Blocks are ``block_rows`` rows of a
    source in the order of md5(id). Sorting by ``position`` gives the mix;
    ``on_target`` says that no source had run out by that slot (later rows keep
    their order, but the exhausted source's slots stay empty).

    Null sources are one source named ''. Sources without a weight get null in all
    added columns but ``block`` and false in ``on_target``. Null and repeated
    ids are ranked by the hash of their row; equal rows take any order
    among themselves. An empty table gives an empty result. Input columns
    named like the added ones are replaced; all others pass through. More than
    ``MAX_SOURCES`` sources are an error: their sizes and schedule are held in one place.
    """
    require(docs, id_col, source_col)
    spark = docs.sparkSession
    own = [c for c in docs.columns if c not in ADDED]
    rows = (docs.select(*own).withColumn("__source", F.coalesce(F.col(source_col).cast("string"),
                                                                F.lit("")))
            .withColumn("__tie", F.xxhash64(*[c for c in own])))
    sizes = {r["__source"]: r["count"] for r in
             rows.groupBy("__source").count().limit(MAX_SOURCES + 1).collect()}
    if len(sizes) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    if weights is None:
        weights = {s: n ** power for s, n in sizes.items()}
    plan, horizon = _plan(spark, {s: w for s, w in weights.items() if s in sizes},
                          {s: -(-n // block_rows) for s, n in sizes.items()})
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    ranked = source_rank(rows, "__source", key, block_rows, plan)
    slot = F.col("__turn.slot")
    return ranked.select(
        *own, "block", F.col("__turn.release").alias("release"),
        F.col("__turn.deadline").alias("deadline"), slot.alias("slot"),
        (slot * block_rows + F.expr(f"__rank % {block_rows}")).alias("position"),
        F.coalesce(slot < horizon, F.lit(False)).alias("on_target"))

"""Exact duplicates by a 128-bit content hash, bytes compared inside groups; DataFrame only.

1. Each text, white space normalised, becomes a narrow row: id, 128-bit hash, SHA-256.
   The narrow rows are a written table, so nothing later recomputes them.
2. Rows are grouped by the hash, counted, and the smallest id is taken. Copies meet on
   the map side first, so a group with a third of all rows sends one row per task.
3. The texts are read again and grouped by (hash, bytes): this compares the bytes themselves,
   again on the map side first, and no row meets another by its hash alone. A hash with more
   than one class of bytes is a collision, and its rows are grouped anew by class.
4. Every row takes its group's keeper. Groups larger than ``1 / HOT_GROUPS`` of all rows
   (there are fewer than ``HOT_GROUPS`` of them) are broadcast; the others are joined on
   the hash, where no key is larger than that share.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import require, stage

HOT_GROUPS = 512
WHITE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """The text with every run of white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), WHITE, " ")


def content_hash(norm: Column) -> Column:
    """128 bits of content."""
    return F.unhex(F.md5(norm))


def _groups(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.min(F.struct(F.col("id").isNull().alias("late"), "id", "row")).alias("first"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                hash_of: Callable[[Column], Column] = content_hash) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``.

    Rows are equal when their texts are identical after white space normalisation (null:
    empty, so null and empty texts are one group). The row with the smallest id stays.
    Rows without an id come after all others; ``keep_id`` is null where no row of the group
    has an id. Of rows that repeat the smallest id exactly one is kept. Other columns are
    ignored, ids of any orderable type work, and an empty table gives none.
    """
    require(docs, id_col, text_col)
    source = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("norm"))
    source = source.withColumn("h", hash_of(F.col("norm")))
    rows = stage(source.select("id", F.monotonically_increasing_id().alias("row"), "h",
                               F.unhex(F.sha2("norm", 256)).alias("sha")), "exact-rows")
    groups = stage(_groups(rows, "h").where("n > 1"), "exact-groups")
    share = rows.count() // HOT_GROUPS
    hot, cold = groups.where(F.col("n") > share), groups.where(F.col("n") <= share)
    collided = _collisions(source.select("h", "norm"), rows)

    own = _groups(rows.join(collided, "h", "left_semi"), "h", "sha")
    own = own.select("h", "sha", F.col("n").alias("n2"), F.col("first").alias("first2"))
    near = rows.join(F.broadcast(hot), "h", "left")
    far = near.where("n IS NULL").drop("n", "first").join(cold, "h", "left")
    out = near.where("n IS NOT NULL").unionByName(far).join(own, ["h", "sha"], "left")
    keeper = F.coalesce("first2", "first", F.struct(F.col("id").isNull().alias("late"), "id", "row"))
    return out.select(F.col("id").alias(id_col), keeper["id"].alias("keep_id"),
                      F.coalesce("n2", "n", F.lit(1)).cast("long").alias("group_size"),
                      (F.col("row") == keeper["row"]).alias("kept"),
                      F.lower(F.hex("sha")).alias("text_sha256"))


def _collisions(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """(h) of the groups whose texts are not all the same bytes."""
    classes = texts.groupBy("h", "norm").agg(F.count("*").alias("copies"))
    found = stage(classes.groupBy("h").agg(F.count("*").alias("classes")).where("classes > 1"),
                  "exact-collisions")
    # From here on classes are told apart by SHA-256; two of one digest would be an error.
    digests = rows.select("h", "sha").join(found, "h").groupBy("h", "sha").agg(F.max("classes").alias("c"))
    told = digests.groupBy("h").agg(F.count("*").alias("n"), F.max("c").alias("c"))
    return told.select(F.when(F.col("n") == F.col("c"), F.col("h")).otherwise(F.raise_error(F.lit(
        "different texts with equal 128-bit and 256-bit hashes")).cast("binary")).alias("h"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns; nulls and repeats as in ``exact_dedup``,
    but of rows without an id one of each text stays only where no row with an id has it."""
    kept = (exact_dedup(docs, id_col, text_col).where("kept")
            .select(F.col(id_col).alias("__keep_id"), F.col("text_sha256").alias("__keep_sha")))
    left = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"),
                       F.sha2(normalised(F.col(text_col)), 256).alias("sha"))
    same = F.col("id").eqNullSafe(F.col("__keep_id")) & (F.col("sha") == F.col("__keep_sha"))
    return left.join(kept, same, "left_semi").dropDuplicates(["id", "sha"]).select("row.*")


__all__ = ["exact_dedup", "drop_copies", "normalised", "content_hash", "HOT_GROUPS"]

"""Connected components of a link table, without collecting links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import stage


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of a link.

    Alternating large-star and small-star steps until nothing changes: each
    step is a minimum per node (combined before the shuffle) and an equi-join
    that adaptive execution may split, so a node with very many neighbours
    meets no single task. Every round is a written table. Links with a null
    end and links of a node to itself are ignored; an empty table gives none.
    """
    edges = stage(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                  .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
                  .distinct(), "cc")
    state = _fingerprint(edges)
    while state[0]:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"),
                                                              F.col("u").alias("v")))
        # large star: every larger neighbour is linked to the smallest node around
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())
        # small star: a node's smaller neighbours are linked to the smallest of them
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u")
                 .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
                         .alias("e")).select("e.u", "e.v").where("u != v").distinct())
        edges = stage(small, "cc")
        now = _fingerprint(edges)
        if now == state:
            break
        state = now
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
                              .distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]

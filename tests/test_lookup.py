"""Heavy keys, lookups that spread them, and first rows without a merge."""
import pytest
from pyspark.sql import functions as F

from conftest import rows
from ordersmith.operators.lookup import enrich, enrich_skewed, heavy_keys
from ordersmith.sources.files import first_rows_by_key


def orders(spark, n=30_000):
    """A third of the orders at seller s7, a tenth without a seller, the rest over 900."""
    seller = F.when(F.col("id") % 3 == 0, F.lit("s7")).when(F.col("id") % 10 == 1, F.lit(None)) \
        .otherwise(F.concat(F.lit("s"), (F.col("id") % 900).cast("string")))
    return spark.range(n).select(F.col("id").cast("string").alias("order_id"), seller.alias("seller_id"))


def sellers(spark):
    return spark.range(800).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("seller_id"),
                                   F.col("id").alias("k"),
                                   F.when(F.col("id") != 7, F.lit("x")).alias("note"))


def test_heavy_keys_are_found(spark):
    assert heavy_keys(orders(spark), "seller_id", share=1 / 100) == ["s7"]
    assert heavy_keys(orders(spark).limit(0), "seller_id") == []
    assert heavy_keys(orders(spark).select(F.lit(None).cast("string").alias("seller_id")), "seller_id") == []


@pytest.mark.parametrize("heavy", [[], ["s7"], ["s7", "s899", "not there"]])
def test_spread_lookup_equals_the_join(spark, heavy):
    left = orders(spark, 5000)
    got = enrich_skewed(left, sellers(spark), "seller_id", heavy, "order_id")
    want = enrich(left, sellers(spark), "seller_id")
    assert rows(got, "order_id", "seller_id", "k", "note") == rows(want, "order_id", "seller_id", "k", "note")


def test_no_task_gets_the_heavy_seller(spark):
    """AQE (and with it its skew handling) and small broadcasts off: the join's own dealing."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        def sizes(df):
            return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        left = orders(spark)
        plain = sizes(enrich(left, sellers(spark), "seller_id"))
        even = sizes(enrich_skewed(left, sellers(spark), "seller_id", heavy_keys(left, "seller_id"), "order_id"))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert max(plain) > 3 * plain[len(plain) // 2]
    assert max(even) < 3 * even[len(even) // 2] and sum(even) == 30_000


@pytest.mark.parametrize("k", [0, 1, 700, 1500, 1999, 2000, 2500])
def test_first_rows_by_ranges(spark, k):
    key = F.when(F.col("id") % 4 == 0, F.lit(None)).when(F.col("id") % 4 == 1, F.lit(5)).otherwise(F.col("id"))
    df = spark.range(2000).select(key.alias("key"), F.col("id").alias("v"))
    got = first_rows_by_key(df, "key", k, merge_at_most=-1 if k == 0 else 0)
    want = df.orderBy(F.col("key").asc_nulls_first()).limit(k)
    assert rows(got, "key") == rows(want, "key")
    assert got.columns == df.columns and got.distinct().count() == min(k, 2000)

"""The daily run's records, first rows of files, observed checks, dated mart and retention."""
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from ordersmith.operators.quality import Check, between, in_set, not_null, run_suite, suite_metrics, unique
from ordersmith.plans import dashboard, jobs, registry
from ordersmith.sinks.staging import version_dir, write_observed
from test_jobs import files, write_csv


def test_a_daily_run_over_awkward_files(spark, tmp_path):
    """K6 takes the first row of a file, rejects are counted and kept, and the report of what was
    observed in the writes equals the one from the tables."""
    bad = [("o4", "c2", "created", "2017-09-16 10:00:00", "", "", "", "")]
    sellers = write_csv(tmp_path / "s.csv", ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
                        [("s1", "900", "zeta", "sp"), ("s1", "100", "alpha", "sp"), ("s2", "1", "beta", "rj"),
                         ("", "5", "none", "sp")])
    items = write_csv(tmp_path / "i.csv", ["order_id", "order_item_id", "product_id", "seller_id",
                                           "shipping_limit_date", "price", "freight_value"],
                      [("o1", "1", "pz", "s1", "", "9.00", "1"), ("o1", "1", "pa", "s1", "", "5.00", "1"),
                       ("o1", "x", "p", "s1", "", "1", "1"), ("o2", "1", "p", "s2", "", "y", "1")])
    payments = write_csv(tmp_path / "p.csv", ["order_id", "payment_sequential", "payment_type",
                                              "payment_installments", "payment_value"],
                         [("o1", "1", "boleto", "1", "5"), ("o2", "one", "boleto", "1", "5"),
                          ("", "1", "boleto", "1", "5")])
    cfg = jobs.Config(root=str(tmp_path / "lake"), buckets=4, **{
        **files(tmp_path, bad), "sellers_csv": sellers, "order_items_csv": items, "payments_csv": payments})
    out = jobs.run_daily(spark, cfg, halt_on_failure=False)
    assert rows(jobs.staged(spark, cfg, "raw_sellers")) == [
        ("s1", "900", "Zeta", "SP"), ("s2", "1", "Beta", "RJ")]
    got = jobs.staged(spark, cfg, "raw_order_items").collect()
    assert [(r["product_id"], float(r["price"])) for r in got] == [("pz", 9.0)]
    counts = {(r["step"], r["source"], r["outcome"]): r["rows"] for r in out["records"].collect()}
    assert counts["publish", "payments", "rejected: payment_sequential"] == 1
    assert counts["ingest", "payments", "rejected: order_id"] == 1
    assert counts["load", "order_items", "rejected: order_item_id"] == 1
    assert counts["load", "order_items", "rejected: price"] == 1
    assert counts["load", "sellers", "rejected: seller_id"] == 1
    assert counts["load", "sellers", "in table"] == 2
    for step, source in {k[:2] for k in counts}:
        left = sum(n for k, n in counts.items() if k[:2] == (step, source) and k[2].startswith("rejected"))
        assert counts[step, source, "read"] == counts[step, source, "accepted"] + left
    kept = spark.read.option("recursiveFileLookup", "true").parquet(cfg.rejects("order_items"))
    assert rows(kept, "reason") == [("order_item_id",), ("price",)]
    report = rows(out["report"])
    assert report == rows(jobs.quality_report(spark, cfg)) and not all(r[-1] for r in report)
    # a second file: what is in the table stays
    cfg.sellers_csv = write_csv(tmp_path / "s2.csv", ["seller_id", "seller_zip_code_prefix", "seller_city",
                                                      "seller_state"], [("s1", "1", "new", "sp"), ("s3", "1", "c", "sp")])
    jobs.load_reference_files(spark, cfg, 2)
    assert [r[0] for r in rows(jobs.staged(spark, cfg, "raw_sellers"), "seller_city")] == ["Beta", "C", "Zeta"]


def test_observed_suite_reads_the_table_for_uniqueness_only(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0), ("a", 500.0), (None, None), ("c", 3.0)], "k string, v double")
    checks: list[Check] = [not_null("k"), unique("k"), between("v", 0, 100), in_set("k", ["a", "b"])]
    seen = write_observed(df, str(tmp_path / "t"), 1, metrics=suite_metrics(checks, "s"))
    table = spark.read.parquet(version_dir(str(tmp_path / "t"), 1))
    assert seen["rows"] == 4
    got = run_suite(table, "x", checks, observed=seen, prefix="s")
    assert rows(got) == rows(run_suite(table, "x", checks))
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Scan parquet") == 1 and "ReadSchema: struct<k:string>" in plan


def files_read(df) -> int:
    """Files that the scan of ``df`` (a projection of a filtered table, not run before) opens, from
    its metrics."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


def test_a_month_of_the_dated_mart_opens_few_files(spark, tmp_path):
    fact = registry.Marts(spark, SF_SMALL).fact_orders()
    root = str(tmp_path / "fact")
    write_observed(jobs.dated(fact), root, 1, partition_by=[dashboard.MONTH])
    mart = spark.read.parquet(version_dir(root, 1))
    everything = len(mart.inputFiles())
    one = dashboard.purchased(mart, "1996-03-01", "1996-03-31").select("order_id")
    want = dashboard.purchased(fact, "1996-03-01", "1996-03-31").select("order_id")
    assert 0 < files_read(one) <= 3 < everything / 10
    assert rows(one) == rows(want) and one.count() > 0
    assert rows(dashboard.kpis(mart, "1996-02-10", "1996-04-05")) == rows(
        dashboard.kpis(fact, "1996-02-10", "1996-04-05"))


def test_one_common_time_spreads_over_tasks(spark):
    """A third of all orders at one time: no task of the layout gets them all."""
    fact = spark.range(30_000).select(
        F.col("id").cast("string").alias("order_id"), F.when(
            F.col("id") % 3 == 0, F.lit("2020-01-01 00:00:00")).otherwise(F.concat(
                F.lit("2020-02-0"), (F.col("id") % 9 + 1).cast("string"))).cast("timestamp_ntz")
        .alias("order_purchase_timestamp"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in jobs.dated(fact).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < 2 * 30_000 / 8

"""Plan-shape tests: the scale properties the design relies on."""
import re

from pyspark.sql import functions as F

from ordersmith.operators.dedup import keep_first
from ordersmith.plans import dashboard, models
from ordersmith.plans import registry as R
from conftest import SF_SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_dedup_limits_before_the_shuffle(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    p = plan_of(keep_first(ev, ["user_id"], [F.col("ts").desc()]))
    partial = p.find("WindowGroupLimit")
    assert "Partial" in p and "Final" in p
    # the partial limit sits below (printed after) the exchange
    assert p.rfind("Exchange hashpartitioning") < p.rfind("Partial")
    assert partial >= 0


def test_each_message_is_parsed_once(spark):
    p = plan_of(R.q_clean_payments(spark, SF_SMALL))
    assert len(re.findall(r"from_json\(", p)) == 1


def test_rollup_counts_distinct_unless_told_otherwise(spark):
    m = R.Marts(spark, SF_SMALL)
    fact = m.fact_orders()
    assert "Expand" not in plan_of(models.agg_daily_gmv(fact, order_id_unique=True))
    distinct = plan_of(models.agg_daily_gmv(fact))
    assert "Expand" in distinct or "count(distinct" in distinct.lower()


def test_quality_passes_do_not_multiply_rows(spark):
    assert "Expand" not in plan_of(R.q_quality_fact_orders(spark, SF_SMALL))
    assert "Expand" not in plan_of(R.q_model_tests(spark, SF_SMALL))


def test_dashboard_filters_reach_the_parquet_scan(spark, tmp_path):
    fact = R.Marts(spark, SF_SMALL).fact_orders()
    path = str(tmp_path / "fact")
    fact.write.parquet(path)
    written = spark.read.parquet(path)
    p = formatted(dashboard.kpis(written, "1996-01-01", "1996-12-31"))
    scan = p[p.index("Scan parquet"):]
    pushed = [line for line in scan.splitlines() if line.startswith("PushedFilters")][0]
    assert "GreaterThanOrEqual(order_purchase_timestamp" in pushed
    assert "LessThan(order_purchase_timestamp" in pushed
    read_schema = [line for line in scan.splitlines() if line.startswith("ReadSchema")][0]
    assert "order_status" not in read_schema and "customer_key" not in read_schema
    assert "payment_value" in read_schema and "seller_key" in read_schema


def test_no_data_sized_broadcast_hint(spark):
    """The only broadcast hint in the model graph is the bounded nation table."""
    m = R.Marts(spark, SF_SMALL)
    logical = m.fact_orders()._jdf.queryExecution().analyzed().toString()
    hints = re.findall(r"ResolvedHint.*broadcast", logical)
    assert len(hints) <= 3      # nation lookups of customers (orders, dimension) and sellers

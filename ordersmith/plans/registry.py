"""Named queries over a test-table folder (one per operator group of the
survey), each ``(spark, sf_dir) -> DataFrame``.

Money leaves as double, counts as bigint, ids as text; clock columns
(ingest/refresh time) are left out so that results can be compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.timestamps import utc_iso
from ..operators.dedup import first_on_tie, keep_first, latest_per_key
from ..operators.lookup import heavy_keys
from ..operators.quality import (
    QualityError, declared_metrics, enforce, run_model_tests, run_suite, suite_metrics, summarize,
)
from ..schemas import CUSTOMERS_CSV, RAW_ORDER_ITEMS, RAW_ORDERS, RAW_SELLERS, STAGING_KEYS
from ..session import release, scratch_path, table_bytes
from ..sinks.buckets import BucketTable
from ..sinks.staging import in_small_files, read_current, version_dir, write_messages, write_observed
from ..sources import encoders
from ..sources.files import read_csv, read_mart, read_sellers
from ..sources.topic import read_topic
from ..sources import testbed as tb
from . import dashboard, ingest, models, suites

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the dashboard queries on the test tables.
GMV_RANGE = ("1997-01-01", "1997-12-31")
STATUS_RANGE = ("1995-01-01", "2001-12-31")
KPI_RANGE = ("1996-01-01", "1996-12-31")
EMPTY_RANGE = ("1990-01-01", "1990-12-31")
TOP_N = 10
STATE = "SP"
SAMPLE_ROWS = 10_000
FILE_BYTES = 4 << 20            # of the table, a file of messages

RAW_ORDER_COLUMNS = ["order_id", "customer_id", "order_status", "purchase_timestamp",
                     "approved_at", "delivered_carrier_date", "delivered_customer_date",
                     "estimated_delivery_date", "customer_city", "customer_state"]
PAYMENT_COLUMNS = ["order_id", "payment_sequential", "payment_type", "payment_installments",
                   "payment_value"]


def _comparable(df: DataFrame) -> DataFrame:
    """Compared outputs: whole-day counts as double (what ``date_part`` returns
    in the original SQL) and dates as midnight timestamps, so that the values
    compare equal however the two result sets are materialised (pandas turns a
    nullable bigint into float, and a DuckDB date into a timestamp)."""
    for c in df.columns:
        if c == "delivery_days":
            df = df.withColumn(c, F.col(c).cast("double"))
        elif c == "order_date":
            df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


def _money(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("double"))
    return df


# Suites whose scalar checks are taken while their table is written.
CHECKED = {
    "fact_orders": lambda: suites.fact_orders_suite(*suites.REFERENCE_FACT_ROWS),
    "dim_customers": lambda: suites.dim_customers_suite(),
}


class Marts:
    """The model graph over the test tables. Every node is built once per
    instance, so a query using several marts shares their sub-plans (and
    Spark reuses the shared exchanges)."""

    def __init__(self, spark: SparkSession, sf_dir: str, written: tuple[str, ...] = ()):
        """``written``: these nodes are written once under the shared folder and read back,
        as the daily job does, so tests read tables and not their lineage."""
        self.t = tb.Tables(spark, sf_dir)
        self.root = scratch_path(spark, "marts")
        self.written = written
        self.seen: dict[str, dict] = {}
        self._memo: dict[str, DataFrame] = {}

    def _get(self, name, build):
        if name not in self._memo:
            df = build()
            if name in self.written:
                checks = CHECKED.get(name, lambda: [])()
                self.seen[name] = write_observed(df, f"{self.root}/{name}", 1, metrics=[
                    *suite_metrics(checks, "s"), *declared_metrics(name, suites.declared_model_tests())])
                df = read_current(df.sparkSession, f"{self.root}/{name}", df.schema)
            self._memo[name] = df
        return self._memo[name]

    def raw_orders(self):
        return self._get("raw_orders", lambda: tb.raw_orders(self.t))

    def raw_payments(self):
        return self._get("raw_payments", lambda: tb.raw_payments(self.t))

    def raw_order_items(self):
        return self._get("raw_order_items", lambda: tb.raw_order_items(self.t))

    def raw_sellers(self):
        return self._get("raw_sellers", lambda: tb.raw_sellers(self.t))

    def stg_orders(self):
        return self._get("stg_orders", lambda: models.stg_orders(self.raw_orders()))

    def stg_customers(self):
        return self._get("stg_customers",
                         lambda: models.stg_customers(self.raw_orders(), with_clock=False))

    def stg_sellers(self):
        return self._get("stg_sellers",
                         lambda: models.stg_sellers(self.raw_sellers(), with_clock=False))

    def dim_customers(self):
        return self._get("dim_customers", lambda: models.dim_customers(self.stg_customers()))

    def dim_sellers(self):
        return self._get("dim_sellers", lambda: models.dim_sellers(
            self.stg_sellers(), self.raw_order_items(), self.raw_payments()))

    def fact_orders(self):
        return self._get("fact_orders", lambda: models.fact_orders(
            self.stg_orders(), self.stg_sellers(), self.raw_order_items(), self.raw_payments(),
            self.dim_customers(), with_clock=False))

    def agg_daily_gmv(self):
        return self._get("agg_daily_gmv", lambda: models.agg_daily_gmv(self.fact_orders()))


# --- ingest ---------------------------------------------------------------

def q_clean_orders(spark, sf_dir):
    t = tb.Tables(spark, sf_dir)
    return ingest.clean_orders(tb.order_event_stream(t), with_ingest_time=False)


def payment_topic(t: tb.Tables) -> DataFrame:
    from ..sources.topic import as_envelope
    rows = tb.payments_csv(t)
    ev = rows.select(F.to_json(F.struct(*encoders.payment_event_fields(
        rows, F.col("event_time")))).alias("value"))
    return as_envelope(ev, "payments", offset_col=None)


def q_clean_payments(spark, sf_dir):
    t = tb.Tables(spark, sf_dir)
    return ingest.clean_payments(payment_topic(t), with_ingest_time=False)


def q_encode_orders(spark, sf_dir):
    t = tb.Tables(spark, sf_dir)
    rows = tb._as_csv_text(tb.order_rows(t), "purchase_timestamp")
    return encoders.encode_orders(rows, utc_iso(F.col("purchase_timestamp")))


def q_encode_payments(spark, sf_dir):
    t = tb.Tables(spark, sf_dir)
    return encoders.encode_payments(tb.payments_csv(t), utc_iso(F.col("l_shipdate")))


def q_enrich_orders(spark, sf_dir):
    t = tb.Tables(spark, sf_dir)
    clean = ingest.clean_orders(tb.order_event_stream(t), with_ingest_time=False)
    return ingest.enrich_orders(clean, ingest.customer_lookup(tb.customer_lookup(t)))


def q_latest_event_per_user(spark, sf_dir):
    t = tb.Tables(spark, sf_dir)
    return latest_per_key(t("events"), ["user_id"], "ts", [F.col("event_id").desc()])


def q_first_on_tie(spark, sf_dir):
    t = tb.Tables(spark, sf_dir)
    arrival = [F.col("l_partkey").asc(), F.col("l_suppkey").asc(),
               F.col("l_extendedprice").asc()]
    kept = first_on_tie(tb.payment_events(t), ["order_id", "payment_sequential"],
                        "event_time", arrival)
    return _money(kept.select(*PAYMENT_COLUMNS, "event_time"), "payment_value")


def q_events_parsed(spark, sf_dir):
    t = tb.Tables(spark, sf_dir)
    e = t("events")
    return e.select("event_id", "user_id", "event_type", "value",
                    F.from_json("props", "k int")["k"].alias("k"))


def q_parse_event_times(spark, sf_dir):
    """F2 F3 F5 F12 on every event time: formatted three ways, parsed back."""
    from ..functions.timestamps import (
        iso_text, month_start, parse_ts, parse_ts_one_format, whole_days_between,
    )
    e = tb.Tables(spark, sf_dir)("events").select("event_id", "ts")
    frac = iso_text("ts", "T", fraction=True)
    iso = iso_text("ts", "T")
    blank = iso_text("ts", " ")
    return e.select(
        "event_id",
        parse_ts(frac).alias("iso_fraction"),
        parse_ts(iso).alias("iso_seconds"),
        parse_ts(blank).alias("blank_seconds"),
        parse_ts_one_format(blank).alias("strict_blank"),
        parse_ts_one_format(iso).alias("strict_iso"),
        whole_days_between("ts", month_start("ts")).alias("day_of_month_elapsed"),
        utc_iso(F.col("ts")).alias("event_time_text"))


def _stored_orders(ro: DataFrame) -> DataFrame:
    """Orders as an earlier load stored them: processing, approved at purchase,
    delivered at the estimate, no carrier date, no city/state."""
    return ro.select(
        "order_id", "customer_id", F.lit("processing").alias("order_status"),
        "purchase_timestamp", F.col("purchase_timestamp").alias("approved_at"),
        F.lit(None).cast("timestamp_ntz").alias("delivered_carrier_date"),
        F.col("estimated_delivery_date").alias("delivered_customer_date"),
        "estimated_delivery_date", F.lit(None).cast("string").alias("customer_city"),
        F.lit(None).cast("string").alias("customer_state"))


def _even(c: str):
    return F.pmod(F.col(c).cast("long"), F.lit(2)) == 0


def _incoming(c: str):
    """Keys of the incoming batch: every odd key, and the even keys not
    divisible by 3 (even keys divisible by 3 stay untouched)."""
    k = F.col(c).cast("long")
    return (F.pmod(k, F.lit(2)) == 1) | (F.pmod(k, F.lit(3)) != 0)


def q_upsert_orders(spark, sf_dir):
    t = tb.Tables(spark, sf_dir)
    ro = tb.raw_orders(t)
    target = _stored_orders(ro.filter(_even("order_id")))
    source = ro.filter(_incoming("order_id"))
    return ingest.upsert_orders(target, source).select(*RAW_ORDER_COLUMNS)


def q_upsert_payments(spark, sf_dir):
    t = tb.Tables(spark, sf_dir)
    ev = tb.payment_events(t)
    keys = ["order_id", "payment_sequential"]
    target = keep_first(ev.filter(_even("l_orderkey")), keys, tb.payment_latest_order()) \
        .select(*PAYMENT_COLUMNS)
    changed = ev.filter(_incoming("l_orderkey")).withColumn(
        "payment_value", F.col("payment_value") + F.lit(1).cast("decimal(12,2)")) \
        .withColumn("payment_type", F.upper("payment_type")) \
        .withColumn("payment_installments", (F.pmod(F.col("l_suppkey"), F.lit(12)) + 1)
                    .cast("int"))
    source = keep_first(changed, keys, tb.payment_latest_order()).select(*PAYMENT_COLUMNS)
    out = ingest.upsert_payments(target, source)
    return _money(out.select(*PAYMENT_COLUMNS), "payment_value")


def q_insert_new_sellers(spark, sf_dir):
    t = tb.Tables(spark, sf_dir)
    s = tb.raw_sellers(t)
    target = s.filter(_even("seller_id"))
    source = s.withColumn("seller_city", F.upper("seller_city"))
    return ingest.insert_new_sellers(target, source)


def q_insert_new_items(spark, sf_dir):
    t = tb.Tables(spark, sf_dir)
    target = tb.raw_order_items(t).filter(_even("order_id"))
    source = tb.order_item_rows(t).withColumn(
        "price", F.col("price") + F.lit(1).cast("decimal(12,2)"))
    out = ingest.insert_new_items(target, source, tb.item_first_order())
    return _money(out, "price", "freight_value")


# --- models -----------------------------------------------------------------

def q_stg_orders(spark, sf_dir):
    return _comparable(Marts(spark, sf_dir).stg_orders().drop("ingested_at"))


def q_stg_customers(spark, sf_dir):
    return Marts(spark, sf_dir).stg_customers()


def q_stg_sellers(spark, sf_dir):
    return Marts(spark, sf_dir).stg_sellers()


def q_dim_customers(spark, sf_dir):
    return Marts(spark, sf_dir).dim_customers()


def q_dim_sellers(spark, sf_dir):
    return _money(Marts(spark, sf_dir).dim_sellers(), "total_revenue")


def q_order_payment_total(spark, sf_dir):
    return _money(models.order_payment_total(Marts(spark, sf_dir).raw_payments()),
                  "total_payment_value")


def q_order_primary_seller(spark, sf_dir):
    return models.order_primary_seller(Marts(spark, sf_dir).raw_order_items())


def q_fact_orders(spark, sf_dir):
    return _comparable(_money(Marts(spark, sf_dir).fact_orders(), "payment_value"))


def q_agg_daily_gmv(spark, sf_dir):
    return _comparable(Marts(spark, sf_dir).agg_daily_gmv())


# --- dashboard --------------------------------------------------------------

def q_daily_gmv_range(spark, sf_dir):
    return _comparable(dashboard.daily_gmv(Marts(spark, sf_dir).agg_daily_gmv(), *GMV_RANGE))


def q_top_sellers(spark, sf_dir):
    return dashboard.top_sellers(Marts(spark, sf_dir).dim_sellers(), TOP_N)


def q_top_sellers_by_state(spark, sf_dir):
    return dashboard.top_sellers(Marts(spark, sf_dir).dim_sellers(), TOP_N, STATE)


def q_top_sellers_labels(spark, sf_dir):
    return dashboard.top_seller_labels(q_top_sellers(spark, sf_dir))


def q_order_status_dist(spark, sf_dir):
    return dashboard.order_status_dist(Marts(spark, sf_dir).fact_orders(), *STATUS_RANGE)


def q_order_status_share(spark, sf_dir):
    return dashboard.order_status_share(q_order_status_dist(spark, sf_dir))


def q_delivery_by_state(spark, sf_dir):
    return dashboard.delivery_by_state(Marts(spark, sf_dir).fact_orders())


def q_delivery_one_state(spark, sf_dir):
    return dashboard.delivery_by_state(Marts(spark, sf_dir).fact_orders(), STATE)


def q_kpis(spark, sf_dir):
    return dashboard.kpis(Marts(spark, sf_dir).fact_orders(), *KPI_RANGE)


def q_kpis_empty_range(spark, sf_dir):
    return dashboard.kpis(Marts(spark, sf_dir).fact_orders(), *EMPTY_RANGE)


# --- quality ----------------------------------------------------------------

def _checked(m: Marts, name: str) -> DataFrame:
    """The suite of a mart that is written once: scalar checks observed in that write, the
    uniqueness checks read the written table."""
    df = getattr(m, name)()
    return run_suite(df, name, CHECKED[name](), observed=m.seen[name], prefix="s")


def q_quality_fact_orders(spark, sf_dir):
    return _checked(Marts(spark, sf_dir, written=("fact_orders",)), "fact_orders")


def q_quality_dim_customers(spark, sf_dir):
    return _checked(Marts(spark, sf_dir, written=("dim_customers",)), "dim_customers")


MODELS = ("raw_orders", "raw_payments", "raw_sellers", "raw_order_items", "stg_orders", "stg_customers",
          "stg_sellers", "dim_customers", "dim_sellers", "fact_orders", "agg_daily_gmv")


def q_model_tests(spark, sf_dir):
    m = Marts(spark, sf_dir, written=MODELS)
    tables = {name: getattr(m, name)() for name in MODELS}
    return run_model_tests(tables, suites.declared_model_tests(), m.seen)


def q_quality_on_sample(spark, sf_dir):
    """The suite on a fixed sample (first rows by key).

    The fact is written first and the sample read from it, as the pipeline does.
    """
    m = Marts(spark, sf_dir, written=("fact_orders",))
    m.fact_orders()
    sample = read_mart(spark, version_dir(f"{m.root}/fact_orders", 1), SAMPLE_ROWS, "order_id")
    return run_suite(sample, "fact_orders_sample", suites.fact_orders_suite(*suites.REFERENCE_FACT_ROWS))


def q_first_rows_of_mart(spark, sf_dir):
    """The first half of the fact mart by order id, found by ranges of the key."""
    m = Marts(spark, sf_dir, written=("fact_orders",))
    m.fact_orders()
    half = m.seen["fact_orders"]["rows"] // 2
    rows = read_mart(spark, version_dir(f"{m.root}/fact_orders", 1), half, "order_id", merge_at_most=0)
    return _comparable(_money(rows, "payment_value"))


def q_fact_orders_hot_seller(spark, sf_dir):
    """The fact with one seller on a third of all orders and without a seller on others;
    heavy sellers are found in a sketch and looked up in a broadcast."""
    m = Marts(spark, sf_dir)
    key = F.pmod(F.col("order_id").cast("long"), F.lit(3))
    items = m.raw_order_items().withColumn("seller_id", F.when(key == 0, F.lit("1"))
                                           .when(key == 1, F.col("seller_id")))
    fact = models.fact_orders(m.stg_orders(), m.stg_sellers(), items, m.raw_payments(), m.dim_customers(),
                              with_clock=False, heavy_sellers=heavy_keys(items, "seller_id"))
    return _comparable(_money(fact, "payment_value"))


def q_quality_summary(spark, sf_dir):
    """Q9: per suite, success and passed/evaluated checks."""
    m = Marts(spark, sf_dir, written=("fact_orders", "dim_customers"))
    rep = _checked(m, "fact_orders").unionByName(_checked(m, "dim_customers"))
    return summarize(rep)


def q_constraints_raw_payments(spark, sf_dir):
    """Declared NOT NULL and primary key of the payments staging table."""
    return enforce(Marts(spark, sf_dir, written=("raw_payments",)).raw_payments(), ["order_id", "payment_sequential"],
                   ["order_id", "payment_sequential"], "raw_payments")


def q_customer_lookup(spark, sf_dir):
    """The customer file as a lookup, one normalised row per id."""
    t = tb.Tables(spark, sf_dir)
    return ingest.customer_lookup(tb.customer_lookup(t), normalize=True)


def q_csv_sellers(spark, sf_dir):
    """K2 K3 K6: the sellers written as a CSV file (columns in another order, cities with
    quotes and commas) and loaded by name."""
    t = tb.Tables(spark, sf_dir)
    path = scratch_path(spark, "sellers-csv")
    odd = F.concat(F.lit('"x", '), F.col("seller_city"))
    tb.raw_sellers(t).select("seller_state", odd.alias("seller_city"), "seller_zip_code_prefix",
                             F.lit("more").alias("another"), "seller_id") \
        .write.csv(path, header=True, escape='"', quote='"')
    return ingest.seller_rows(read_sellers(spark, path))


def q_topic_orders(spark, sf_dir):
    """K1 B1: the order events written as JSON lines, in two runs, and read as a topic."""
    events = tb.order_event_stream(tb.Tables(spark, sf_dir))
    path = scratch_path(spark, "topic-orders")
    for run, rest in (("run-000000001", 0), ("run-000000002", 1)):
        events.filter(F.pmod("offset", F.lit(2)) == rest) \
            .select(F.col("value").cast("string")).write.text(f"{path}/{run}")
    return ingest.clean_orders(read_topic(spark, "orders", f"{path}/*"), with_ingest_time=False)


def q_same_time_orders(spark, sf_dir):
    """The same event time in two runs of files of unequal size: the later run wins. The
    number of files grows with the table, so none goes whole through one task."""
    t = tb.Tables(spark, sf_dir)
    rows = tb._as_csv_text(tb.order_rows(t), "purchase_timestamp")
    when = F.lit("2020-01-01T00:00:00")
    path = scratch_path(spark, "topic-ties")
    first = rows.withColumn("order_status", F.lit("processing"))
    files = 1 + table_bytes(rows) // FILE_BYTES
    for run, part, files in (("run-000000001", first, files), ("run-000000002", rows, 7 * files)):
        write_messages(part.select(F.to_json(F.struct(*encoders.order_event_fields(part, when)),
                                             {"ignoreNullFields": "false"}).alias("value"))
                       .repartition(files, "value"), f"{path}/{run}")
    return ingest.clean_orders(read_topic(spark, "orders", f"{path}/*"), with_ingest_time=False)


def _dirty_payments(t: tb.Tables) -> DataFrame:
    """Payment messages, a part of them broken by key: by k mod 7 the sequence missing (0),
    numbers as text (1), text that is no number (2), an empty order id (3), JSON cut off (4)."""
    p = tb.raw_payments(t)
    kind = F.pmod(F.col("order_id").cast("long"), F.lit(7))
    plain = F.to_json(F.struct("order_id", "payment_sequential", "payment_type",
                               "payment_installments",
                               F.col("payment_value").cast("double").alias("payment_value")))
    text = F.to_json(F.struct("order_id", *[F.concat(F.lit(" "), F.col(c).cast("string")).alias(c) for c in
                              ("payment_sequential", "payment_installments", "payment_value")],
                              "payment_type"))
    value = (F.when(kind == 0, F.to_json(F.struct("order_id", "payment_type")))
             .when(kind == 1, text).when(kind == 2, F.replace(plain, F.lit('"payment_value":'),
                                                             F.lit('"payment_value":"x","y":')))
             .when(kind == 3, F.regexp_replace(plain, '"order_id":"[0-9]+"', '"order_id":""'))
             .when(kind == 4, F.left(plain, F.lit(20))).otherwise(plain))
    from ..sources.topic import as_envelope
    return as_envelope(p.select(value.alias("value")), "payments", offset_col=None)


def q_clean_payments_dirty(spark, sf_dir):
    """Defaults, numbers as text, and messages that are left out."""
    return ingest.clean_payments(_dirty_payments(tb.Tables(spark, sf_dir)), with_ingest_time=False)


def q_rejected_payments(spark, sf_dir):
    """Rejects of the same messages, counted by reason."""
    return ingest.rejected_payments(_dirty_payments(tb.Tables(spark, sf_dir))) \
        .groupBy("reason").agg(F.count(F.lit(1)).alias("messages"))


# --- staging tables in buckets ------------------------------------------------

def q_bucketed_upsert_orders(spark, sf_dir):
    """The upsert of ``upsert_orders``, as two loads of a bucketed staging table."""
    ro = tb.raw_orders(tb.Tables(spark, sf_dir))
    schema = StructType([f for f in RAW_ORDERS.fields if f.name in RAW_ORDER_COLUMNS])
    into = BucketTable(spark, scratch_path(spark, "orders-table"), schema, STAGING_KEYS["raw_orders"])
    update = ingest.update_columns("raw_orders", timed=False)
    into.upsert(_stored_orders(ro.filter(_even("order_id"))), (0, 1), update)
    into.upsert(ro.filter(_incoming("order_id")), (0, 2), update)
    return into.read().select(*RAW_ORDER_COLUMNS)


def q_bucketed_insert_items(spark, sf_dir):
    """K6: the insert of ``insert_new_items``, as two loads of a bucketed staging table."""
    t = tb.Tables(spark, sf_dir)
    keys = STAGING_KEYS["raw_order_items"]
    into = BucketTable(spark, scratch_path(spark, "items-table"), RAW_ORDER_ITEMS, keys)
    into.insert_new(tb.raw_order_items(t).filter(_even("order_id")), (0, 1))
    source = tb.order_item_rows(t).withColumn(
        "price", F.col("price") + F.lit(1).cast("decimal(12,2)"))
    into.insert_new(ingest.first_in_file(source, keys, tb.item_first_order()), (0, 2))
    return _money(into.read(), "price", "freight_value")


def q_first_seller_in_file(spark, sf_dir):
    """K6: every seller three times in the file; the row that stands first is kept, though
    later ones sort before it."""
    s = tb.raw_sellers(tb.Tables(spark, sf_dir))
    path = scratch_path(spark, "sellers-twice")
    copies = s.withColumn("n", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).withColumn(
        "seller_city", F.concat(F.element_at(F.array(F.lit("m "), F.lit("z "), F.lit("a ")), F.col("n") + 1),
                                "seller_city"))
    copies.orderBy("n", "seller_id").drop("n").write.csv(path, header=True, escape='"', quote='"')
    rows = ingest.accepted(ingest.seller_records(read_sellers(spark, path)))
    into = BucketTable(spark, scratch_path(spark, "sellers-table"), RAW_SELLERS, STAGING_KEYS["raw_sellers"])
    into.insert_new(ingest.first_in_file(rows, into.keys), (0, 1))
    return into.read()


def q_csv_multiline_customers(spark, sf_dir):
    """K2: customers with line breaks and quotes in their city, the file read by splits."""
    path = scratch_path(spark, "customers-csv")
    rows = tb.customer_lookup(tb.Tables(spark, sf_dir))
    odd = F.when(F.length("customer_city") % 2 == 0, F.concat(F.lit('"a,b"\n'), "customer_city")) \
        .otherwise(F.col("customer_city"))
    rows.withColumn("customer_city", odd).write.csv(
        path, header=True, escape='"', quote='"', ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False)
    return read_csv(spark, path, CUSTOMERS_CSV, split_from=0)


def _stream_runs(spark, drops, lose_checkpoint=False, customers=None):
    """The order table after each drop of messages came in through the stream."""
    from ..streaming.ingest import run_order_stream

    base = scratch_path(spark, "stream-runs")
    for i, messages in enumerate(drops):
        write_messages(messages.select(F.col("value").cast("string")), f"{base}/in/drop-{i}")
        checkpoint = f"{base}/checkpoint-{i if lose_checkpoint else 0}"
        out = run_order_stream(spark, f"{base}/in/*", f"{base}/table", checkpoint, customers)
    return out


def q_stream_same_time_orders(spark, sf_dir):
    """Three messages of one order and one event time in a drop; the last in the files is kept."""
    rows = tb._as_csv_text(tb.order_rows(tb.Tables(spark, sf_dir)), "purchase_timestamp")
    when = F.lit("2020-01-01T00:00:00")
    status = F.element_at(F.array(F.lit("shipped"), F.lit("delivered"), F.col("order_status")), F.col("n") + 1)
    events = rows.withColumn("n", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))) \
        .withColumn("order_status", status)
    value = F.to_json(F.struct(*encoders.order_event_fields(events, when)), {"ignoreNullFields": "false"})
    out = _stream_runs(spark, [events.orderBy("n", "order_id").select(value.alias("value"))])
    return out.select(*ingest.ORDER_COLUMNS)


def q_stream_lost_checkpoint(spark, sf_dir):
    """The checkpoint is lost between two drops; the table holds the newest events all the same."""
    t = tb.Tables(spark, sf_dir)
    events = tb.order_event_stream(t)
    drops = [events.filter(F.pmod("offset", F.lit(2)) == k) for k in (0, 1)]
    out = _stream_runs(spark, drops, lose_checkpoint=True,
                       customers=ingest.customer_lookup(tb.customer_lookup(t)))
    return out.select(*ingest.ORDER_COLUMNS, "customer_city", "customer_state", "event_time")


# --- whole runs ---------------------------------------------------------------

def _csv_files(t: tb.Tables, root: str, broken: bool = False) -> dict[str, str]:
    """The reference files and exports as CSV; ``broken`` ones have fields that cannot be used,
    by key modulo 7: payments an instalment count (1) or value (2) that is no number, items an
    item number (3), orders no id (4), sellers no id (5)."""
    files = {
        "orders": tb.orders_csv(t), "customers": tb.customer_lookup(t),
        "payments": tb.raw_payments(t), "sellers": tb.raw_sellers(t),
        "items": tb.raw_order_items(t).withColumn(
            "shipping_limit_date", F.date_format("shipping_limit_date", "yyyy-MM-dd HH:mm:ss")),
    }
    files = {n: df.select(*[F.col(c).cast("string") for c in df.columns]) for n, df in files.items()}

    def spoil(name, column, key, rest, value):
        bad = F.pmod(F.col(key).cast("long"), F.lit(7)) == rest
        files[name] = files[name].withColumn(column, F.when(bad, F.lit(value)).otherwise(F.col(column)))

    if broken:
        spoil("payments", "payment_installments", "order_id", 1, "1.5")
        spoil("payments", "payment_value", "order_id", 2, "much")
        spoil("items", "order_item_id", "order_id", 3, "x")
        spoil("orders", "order_id", "order_id", 4, None)
        spoil("sellers", "seller_id", "seller_id", 5, None)
    for name, df in files.items():
        in_small_files(df.write).csv(f"{root}/csv/{name}", header=True, escape='"', quote='"')
        release(t.spark)
    return {f"{n}_csv": f"{root}/csv/{f}" for n, f in (
        ("orders", "orders"), ("payments", "payments"), ("customers", "customers"),
        ("sellers", "sellers"), ("order_items", "items"))}


def q_daily_run(spark, sf_dir):
    """One whole daily run from CSV files; its sales mart."""
    from . import jobs

    root = scratch_path(spark, "daily-run")
    cfg = jobs.Config(root=root, buckets=8, **_csv_files(tb.Tables(spark, sf_dir), root))
    jobs.run_daily(spark, cfg, halt_on_failure=False)
    return _comparable(jobs.marts(spark, cfg)["agg_daily_gmv"])


def q_daily_rejects(spark, sf_dir):
    """What every step of a daily run over broken files read, took and left out."""
    from . import jobs

    root = scratch_path(spark, "daily-rejects")
    cfg = jobs.Config(root=root, buckets=8, **_csv_files(tb.Tables(spark, sf_dir), root, broken=True))
    return jobs.run_daily(spark, cfg, halt_on_failure=False)["records"]


def q_daily_gate(spark, sf_dir):
    """A run that its checks stop (orders hold a status that is not allowed): the failed
    checks of the report it left, and that it was stopped."""
    from . import jobs

    root = scratch_path(spark, "daily-gate")
    cfg = jobs.Config(root=root, buckets=8, **_csv_files(tb.Tables(spark, sf_dir), root))
    stopped = False
    try:
        jobs.run_daily(spark, cfg)
    except QualityError:
        stopped = True
    report = spark.read.parquet(version_dir(f"{root}/quality", 1))
    return report.filter("not success").select("suite", "check", "column", "unexpected",
                                               F.lit(stopped).alias("stopped"))


def q_kpis_from_dated_mart(spark, sf_dir):
    """The KPIs of a date range from a fact mart laid out by purchase month."""
    from . import jobs

    m = Marts(spark, sf_dir)
    root = scratch_path(spark, "dated-fact")
    write_observed(jobs.dated(m.fact_orders()), root, 1, partition_by=[dashboard.MONTH])
    return dashboard.kpis(spark.read.parquet(version_dir(root, 1)), *KPI_RANGE)


QUERIES: dict[str, Query] = {
    "csv_sellers": q_csv_sellers,
    "topic_orders": q_topic_orders,
    "same_time_orders": q_same_time_orders,
    "clean_payments_dirty": q_clean_payments_dirty,
    "rejected_payments": q_rejected_payments,
    "daily_run": q_daily_run,
    "daily_rejects": q_daily_rejects,
    "daily_gate": q_daily_gate,
    "kpis_from_dated_mart": q_kpis_from_dated_mart,
    "bucketed_upsert_orders": q_bucketed_upsert_orders,
    "bucketed_insert_items": q_bucketed_insert_items,
    "first_seller_in_file": q_first_seller_in_file,
    "csv_multiline_customers": q_csv_multiline_customers,
    "stream_same_time_orders": q_stream_same_time_orders,
    "stream_lost_checkpoint": q_stream_lost_checkpoint,
    "clean_orders": q_clean_orders,
    "clean_payments": q_clean_payments,
    "encode_orders": q_encode_orders,
    "encode_payments": q_encode_payments,
    "enrich_orders": q_enrich_orders,
    "latest_event_per_user": q_latest_event_per_user,
    "first_on_tie": q_first_on_tie,
    "events_parsed": q_events_parsed,
    "parse_event_times": q_parse_event_times,
    "upsert_orders": q_upsert_orders,
    "upsert_payments": q_upsert_payments,
    "insert_new_sellers": q_insert_new_sellers,
    "insert_new_items": q_insert_new_items,
    "stg_orders": q_stg_orders,
    "stg_customers": q_stg_customers,
    "stg_sellers": q_stg_sellers,
    "dim_customers": q_dim_customers,
    "dim_sellers": q_dim_sellers,
    "order_payment_total": q_order_payment_total,
    "order_primary_seller": q_order_primary_seller,
    "fact_orders": q_fact_orders,
    "agg_daily_gmv": q_agg_daily_gmv,
    "daily_gmv_range": q_daily_gmv_range,
    "top_sellers": q_top_sellers,
    "top_sellers_by_state": q_top_sellers_by_state,
    "top_sellers_labels": q_top_sellers_labels,
    "order_status_dist": q_order_status_dist,
    "order_status_share": q_order_status_share,
    "delivery_by_state": q_delivery_by_state,
    "delivery_one_state": q_delivery_one_state,
    "kpis": q_kpis,
    "kpis_empty_range": q_kpis_empty_range,
    "quality_fact_orders": q_quality_fact_orders,
    "quality_dim_customers": q_quality_dim_customers,
    "model_tests": q_model_tests,
    "quality_on_sample": q_quality_on_sample,
    "quality_summary": q_quality_summary,
    "first_rows_of_mart": q_first_rows_of_mart,
    "fact_orders_hot_seller": q_fact_orders_hot_seller,
    "constraints_raw_payments": q_constraints_raw_payments,
    "customer_lookup": q_customer_lookup,
}


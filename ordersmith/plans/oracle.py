"""Oracle SQL (DuckDB dialect) for every registered query with a SQL form.

The adapter and the models are written from their definitions, in another form than the
Spark code: scalar subqueries instead of pre-aggregated joins, the seller revenue as
the sum over every pair of an item and a payment of one order. Value lists and checks are
spelled out here, so that a wrong list in the code turns a row red.
"""

from __future__ import annotations

from collections import namedtuple

from . import registry as R

# The lists and checks below are this module's own statement of them.
STATUSES = ["delivered", "shipped", "processing", "approved", "invoiced", "unavailable", "canceled"]
STATES = ["AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO", "MA", "MT", "MS", "MG", "PA", "PB", "PR",
          "PE", "PI", "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE", "TO"]
PENDING_NAMES = ["processing", "approved", "invoiced", "unavailable", "canceled", "created", "processing"]
Expectation = namedtuple("Expectation", "kind name column mostly min_value max_value values",
                         defaults=(None, 1.0, None, None, ()))
_NULL = ("not_null", "expect_column_values_to_not_be_null")
_UNIQUE = ("unique", "expect_column_values_to_be_unique")
_BETWEEN = ("between", "expect_column_values_to_be_between")
_SET = ("in_set", "expect_column_values_to_be_in_set")
_ROWS = ("row_count", "expect_table_row_count_to_be_between")
FACT_CHECKS = [
    Expectation(*_NULL, "order_id"), Expectation(*_UNIQUE, "order_id"),
    Expectation(*_NULL, "customer_key"), Expectation(*_NULL, "payment_value"),
    Expectation(*_BETWEEN, "payment_value", 1.0, 0, 100000), Expectation(*_NULL, "order_status"),
    Expectation(*_SET, "order_status", 1.0, None, None, STATUSES),
    Expectation(*_BETWEEN, "delivery_days", 0.98, 0, 365),
    Expectation(*_ROWS, None, 1.0, 1, 10000000),
    Expectation(*_NULL, "order_purchase_timestamp", 0.99),
]
CUSTOMER_CHECKS = [
    Expectation(*_NULL, "customer_key"), Expectation(*_UNIQUE, "customer_key"),
    Expectation(*_NULL, "customer_id"), Expectation(*_UNIQUE, "customer_id"),
    Expectation(*_SET, "state", 0.95, None, None, STATES), Expectation(*_NULL, "city", 0.99),
]
PAYMENT_KEY_CHECKS = [
    Expectation(*_NULL, "order_id"), Expectation(*_NULL, "payment_sequential"),
    Expectation(*_UNIQUE, "__pk"),
]
Declared = namedtuple("Declared", "model column test values", defaults=((),))
MODEL_TESTS = [
    Declared("raw_orders", "order_id", "not_null"), Declared("raw_orders", "customer_id", "not_null"),
    Declared("raw_orders", "order_status", "accepted_values", STATUSES),
    Declared("raw_payments", "order_id", "not_null"),
    Declared("raw_sellers", "seller_id", "not_null"), Declared("raw_sellers", "seller_id", "unique"),
    Declared("raw_order_items", "order_id", "not_null"),
    Declared("stg_orders", "order_id", "not_null"), Declared("stg_orders", "order_id", "unique"),
    Declared("stg_orders", "customer_id", "not_null"), Declared("stg_orders", "order_status", "not_null"),
    Declared("stg_orders", "order_status", "accepted_values", STATUSES),
    *[Declared(m, c, t) for m, cols in (("stg_customers", ("customer_key", "customer_id")),
                                        ("stg_sellers", ("seller_key", "seller_id")))
      for c in cols for t in ("not_null", "unique")],
    Declared("fact_orders", "order_id", "not_null"), Declared("fact_orders", "order_id", "unique"),
    Declared("fact_orders", "customer_key", "not_null"),
    Declared("fact_orders", "payment_value", "not_null"),
    Declared("fact_orders", "order_status", "accepted_values", STATUSES),
    Declared("dim_customers", "customer_key", "not_null"),
    Declared("dim_customers", "customer_key", "unique"),
    Declared("dim_customers", "customer_id", "not_null"),
    Declared("dim_customers", "customer_id", "unique"),
    Declared("dim_sellers", "seller_key", "not_null"), Declared("dim_sellers", "seller_key", "unique"),
    Declared("agg_daily_gmv", "order_date", "not_null"), Declared("agg_daily_gmv", "order_date", "unique"),
    Declared("agg_daily_gmv", "total_gmv", "not_null"),
]


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _initcap(x: str) -> str:
    return ("array_to_string(list_transform(regexp_extract_all(" + x +
            r", '([\p{L}\p{N}]+|[^\p{L}\p{N}]+)', 1), lambda w: upper(w[1:1]) || lower(w[2:])), '')")


def _title(x: str) -> str:
    return ("array_to_string(list_transform(regexp_extract_all(" + x +
            r", '(\p{L}+|[^\p{L}]+)', 1), lambda w: upper(w[1:1]) || lower(w[2:])), '')")


def _round_ratio(total: str, n: str, digits: int) -> str:
    """Half away from zero of total/n with whole-number total (T4)."""
    return (f"CASE WHEN ({n}) > 0 THEN CAST(sign({total}) * ((2 * abs({total}) + ({n})) // "
            f"(2 * ({n}))) AS DOUBLE) / {float(10 ** digits)} END")


ST = _list(STATES[:25])
PENDING = _list(PENDING_NAMES)
VALID = _in(STATUSES)

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name, deps, sql):
    CTES[name] = (deps, sql)


cte("ord", [], f"""
  SELECT o_orderkey,
    CAST(o_orderkey AS VARCHAR) AS order_id,
    CAST(o_custkey AS VARCHAR) AS customer_id,
    CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
      ELSE ({PENDING})[CAST(o_orderkey % 7 AS INTEGER) + 1] END AS order_status,
    o_orderdate + to_seconds(CAST((o_orderkey * 37) % 86400 AS BIGINT)) AS purchase_timestamp,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 1 DAY END AS approved_at,
    CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderdate + INTERVAL 2 DAY END
      AS delivered_carrier_date,
    CASE WHEN o_orderstatus = 'F' THEN o_orderdate + to_days(CAST(o_orderkey % 40 AS INTEGER))
      + to_seconds(CAST((o_orderkey * 53) % 86400 AS BIGINT)) END AS delivered_customer_date,
    o_orderdate + INTERVAL 30 DAY AS estimated_delivery_date
  FROM orders""")

cte("cust", [], f"""
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
    'u' || CAST(c_custkey AS VARCHAR) AS customer_unique_id,
    lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
    ' ' || lower(n_name) || ' ' AS customer_city,
    ({ST})[c_nationkey + 1] AS customer_state
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")

cte("raw_orders", ["ord", "cust"], """
  SELECT ord.order_id, ord.customer_id, order_status, purchase_timestamp, approved_at,
    delivered_carrier_date, delivered_customer_date, estimated_delivery_date,
    cust.customer_city, cust.customer_state
  FROM ord LEFT JOIN cust ON ord.customer_id = cust.customer_id""")

cte("pay_ev", [], """
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS payment_sequential,
    CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto'
      WHEN 'R' THEN 'voucher' END AS payment_type,
    CAST(1 + l_partkey % 12 AS INTEGER) AS payment_installments,
    CAST(l_extendedprice AS DECIMAL(12, 2)) AS payment_value,
    strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS event_time,
    l_orderkey, l_partkey, l_suppkey, l_extendedprice, l_shipdate
  FROM lineitem""")

cte("raw_payments", ["pay_ev"], """
  SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value
  FROM (SELECT *, row_number() OVER (PARTITION BY order_id, payment_sequential
          ORDER BY event_time DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn
        FROM pay_ev) WHERE rn = 1""")

cte("items_all", [], """
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
    CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
    l_shipdate AS shipping_limit_date, CAST(l_extendedprice AS DECIMAL(12, 2)) AS price,
    CAST(l_quantity AS DECIMAL(12, 2)) AS freight_value,
    l_orderkey, l_shipdate, l_partkey, l_suppkey, l_extendedprice
  FROM lineitem""")

cte("raw_order_items", ["items_all"], """
  SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, price,
    freight_value
  FROM (SELECT *, row_number() OVER (PARTITION BY order_id, order_item_id
          ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS rn
        FROM items_all) WHERE rn = 1""")

cte("raw_sellers", [], f"""
  SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
    lpad(CAST(s_suppkey % 100000 AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
    lower(n_name) AS seller_city, ({ST})[s_nationkey + 1] AS seller_state
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""")

cte("stg_orders", ["raw_orders"], f"""
  SELECT order_id, customer_id, order_status,
    purchase_timestamp AS order_purchase_timestamp, approved_at AS order_approved_at,
    delivered_carrier_date AS order_delivered_carrier_date,
    delivered_customer_date AS order_delivered_customer_date,
    estimated_delivery_date AS order_estimated_delivery_date,
    customer_city, customer_state,
    CASE WHEN delivered_customer_date IS NOT NULL AND purchase_timestamp IS NOT NULL
      THEN CAST(date_part('day', delivered_customer_date - purchase_timestamp) AS BIGINT)
      ELSE NULL END AS delivery_days
  FROM raw_orders
  WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND order_status IN {VALID}""")

cte("stg_customers", ["raw_orders"], f"""
  SELECT md5(customer_id) AS customer_key, customer_id, customer_city, customer_state
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
          ORDER BY customer_city ASC NULLS LAST, customer_state ASC NULLS LAST) AS rn
        FROM (SELECT customer_id, {_initcap('trim(customer_city)')} AS customer_city,
                upper(trim(customer_state)) AS customer_state
              FROM raw_orders WHERE customer_id IS NOT NULL)) WHERE rn = 1""")

cte("stg_sellers", ["raw_sellers"], f"""
  SELECT md5(seller_id) AS seller_key, seller_id, seller_zip_code_prefix, seller_city,
    seller_state
  FROM (SELECT *, row_number() OVER (PARTITION BY seller_id
          ORDER BY seller_zip_code_prefix ASC NULLS LAST, seller_city ASC NULLS LAST,
                   seller_state ASC NULLS LAST) AS rn
        FROM (SELECT seller_id, seller_zip_code_prefix,
                {_initcap('trim(seller_city)')} AS seller_city,
                upper(trim(seller_state)) AS seller_state
              FROM raw_sellers WHERE seller_id IS NOT NULL)) WHERE rn = 1""")

cte("dim_customers", ["stg_customers"], """
  SELECT customer_key, customer_id, customer_city AS city, customer_state AS state
  FROM stg_customers""")

# every (item, payment) pair of one order, one row each: a payment counts once per item
cte("sold", ["raw_order_items", "raw_payments"], """
  SELECT i.seller_id, q.payment_value
  FROM raw_order_items i JOIN raw_payments q ON q.order_id = i.order_id""")

cte("dim_sellers", ["stg_sellers", "sold", "raw_order_items"], """
  SELECT x.seller_key, x.seller_id, x.seller_city AS city, x.seller_state AS state,
    (SELECT count(*) FROM (SELECT DISTINCT order_id FROM raw_order_items i
       WHERE i.seller_id = x.seller_id)) AS total_orders,
    coalesce((SELECT sum(payment_value) FROM sold WHERE sold.seller_id = x.seller_id), 0)
      AS total_revenue
  FROM stg_sellers x""")

cte("primary_sellers", ["raw_order_items"], """
  SELECT order_id, min(seller_id) AS seller_id FROM raw_order_items GROUP BY order_id""")

cte("paid_totals", ["raw_payments"], """
  SELECT order_id, sum(payment_value) AS total_payment_value FROM raw_payments
  GROUP BY order_id""")

cte("fact_orders", ["stg_orders", "stg_customers", "raw_order_items", "stg_sellers", "raw_payments"], """
  SELECT a.order_id,
    (SELECT any_value(k.customer_key) FROM stg_customers k WHERE k.customer_id = a.customer_id)
      AS customer_key,
    coalesce((SELECT any_value(z.seller_key) FROM stg_sellers z WHERE z.seller_id =
      (SELECT min(i.seller_id) FROM raw_order_items i WHERE i.order_id = a.order_id)), 'unknown')
      AS seller_key,
    coalesce((SELECT sum(q.payment_value) FROM raw_payments q WHERE q.order_id = a.order_id), 0)
      AS payment_value,
    a.order_status, a.order_purchase_timestamp, a.order_approved_at,
    a.order_delivered_customer_date, a.order_estimated_delivery_date, a.delivery_days,
    a.order_status = 'delivered' AS is_delivered, a.customer_state
  FROM stg_orders a""")

cte("agg_daily_gmv", ["fact_orders"], f"""
  SELECT order_date, CAST(total_orders AS BIGINT) AS total_orders,
    CAST(gmv AS DOUBLE) AS total_gmv,
    {_round_ratio('CAST(gmv * 100 AS HUGEINT)', 'n_pay', 2)} AS avg_payment_value,
    CAST(delivered_orders AS BIGINT) AS delivered_orders,
    {_round_ratio('CAST(dd AS HUGEINT) * 10', 'n_dd', 1)} AS avg_delivery_days
  FROM (SELECT CAST(order_purchase_timestamp AS DATE) AS order_date,
          count(DISTINCT order_id) AS total_orders, sum(payment_value) AS gmv,
          count(payment_value) AS n_pay,
          sum(CASE WHEN is_delivered THEN 1 ELSE 0 END) AS delivered_orders,
          sum(delivery_days) AS dd, count(delivery_days) AS n_dd
        FROM fact_orders WHERE order_purchase_timestamp IS NOT NULL GROUP BY 1)""")

cte("order_events", ["ord"], """
  SELECT order_id, customer_id, 'processing' AS order_status, purchase_timestamp,
    approved_at, delivered_carrier_date, CAST(NULL AS TIMESTAMP) AS delivered_customer_date,
    estimated_delivery_date, strftime(purchase_timestamp, '%Y-%m-%dT%H:%M:%S') AS event_time,
    o_orderkey * 2 AS off
  FROM ord
  UNION ALL
  SELECT order_id, customer_id, order_status, purchase_timestamp, approved_at,
    delivered_carrier_date, delivered_customer_date, estimated_delivery_date,
    strftime(purchase_timestamp + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S') AS event_time,
    o_orderkey * 2 + 1 AS off
  FROM ord""")

cte("clean_orders", ["order_events"], """
  SELECT order_id, customer_id, order_status, purchase_timestamp, approved_at,
    delivered_carrier_date, delivered_customer_date, estimated_delivery_date
  FROM (SELECT *, row_number() OVER (PARTITION BY order_id
          ORDER BY event_time DESC NULLS LAST, off DESC) AS rn FROM order_events)
  WHERE rn = 1""")


def with_ctes(*names: str) -> str:
    """``WITH`` clause holding ``names`` and everything they depend on."""
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        for d in CTES[n][0]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in seen) + "\n"


def _dates(col: str, rng) -> str:
    return f"CAST({col} AS DATE) BETWEEN DATE '{rng[0]}' AND DATE '{rng[1]}'"


def _ts(col: str, fmt: str = "%Y-%m-%d %H:%M:%S") -> str:
    return f"strftime({col}, '{fmt}')"


def _suite_sql(table: str, suite: str, checks) -> str:
    """Oracle of :func:`run_suite`: one SELECT per check, UNION ALL."""
    rows = []
    for i, c in enumerate(checks):
        col = c.column
        if c.kind == "not_null":
            ev, un = "count(*)", f"count(*) FILTER (WHERE {col} IS NULL)"
        elif c.kind == "between":
            ev = f"count({col})"
            un = (f"count(*) FILTER (WHERE {col} IS NOT NULL AND ({col} < {c.min_value} "
                  f"OR {col} > {c.max_value}))")
        elif c.kind == "in_set":
            ev = f"count({col})"
            un = f"count(*) FILTER (WHERE {col} IS NOT NULL AND {col} NOT IN {_in(c.values)})"
        elif c.kind == "row_count":
            ev, un = "count(*)", "CAST(0 AS BIGINT)"
        elif c.kind == "unique":
            ev = f"(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {table} WHERE {col} IS NOT NULL GROUP BY {col}))"
            un = f"(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {table} WHERE {col} IS NOT NULL GROUP BY {col}) WHERE n > 1)"
        if c.kind == "row_count":
            share = "CAST(NULL AS DOUBLE)"
            ok = f"(e BETWEEN {c.min_value} AND {c.max_value})"
        else:
            share = "CASE WHEN e > 0 THEN CAST(e - u AS DOUBLE) / e END"
            ok = f"CASE WHEN e = 0 THEN true ELSE CAST(e - u AS DOUBLE) / e >= {float(c.mostly)} END"
        colv = f"'{col}'" if col else "CAST(NULL AS VARCHAR)"
        rows.append(
            f"SELECT '{suite}' AS suite, CAST({i} AS INTEGER) AS position, '{c.name}' AS \"check\", "
            f"{colv} AS \"column\", CAST(e AS BIGINT) AS evaluated, CAST(u AS BIGINT) AS unexpected, "
            f"{share} AS share, {ok} AS success "
            f"FROM (SELECT {ev} AS e, {un} AS u {'' if c.kind == 'unique' else 'FROM ' + table})")
    return "\nUNION ALL\n".join(rows)


def _model_tests_sql(tests) -> str:
    rows = []
    for t in tests:
        if t.test == "not_null":
            f = f"(SELECT count(*) FROM {t.model} WHERE {t.column} IS NULL)"
        elif t.test == "unique":
            f = (f"(SELECT count(*) FROM (SELECT {t.column} FROM {t.model} WHERE {t.column} "
                 f"IS NOT NULL GROUP BY {t.column} HAVING count(*) > 1))")
        else:
            f = (f"(SELECT count(DISTINCT {t.column}) FROM {t.model} WHERE {t.column} "
                 f"NOT IN {_in(t.values)})")
        rows.append(f"SELECT '{t.model}' AS model, '{t.column}' AS \"column\", '{t.test}' AS test, "
                    f"CAST({f} AS BIGINT) AS failures, {f} = 0 AS success")
    return "\nUNION ALL\n".join(rows)


def stream_ingest_orders_sql() -> str:
    """The streamed staging table equals the latest event of every order, enriched."""
    return with_ctes("order_events", "cust") + """,
latest AS (SELECT order_id, max(event_time) AS event_time FROM order_events GROUP BY order_id)
SELECT e.order_id, e.customer_id, e.order_status, e.purchase_timestamp, e.approved_at,
  e.delivered_carrier_date, e.delivered_customer_date, e.estimated_delivery_date,
  c.customer_city, c.customer_state, e.event_time
FROM latest l JOIN order_events e ON e.order_id = l.order_id AND e.event_time = l.event_time
LEFT JOIN cust c ON c.customer_id = e.customer_id"""


def _daily_rejects_sql() -> str:
    """Rows read, taken and left out by every step of the run over broken files: the key modulo 7
    says what is broken."""
    bad = "CAST({} AS BIGINT) % 7".format
    orders, sellers, key = bad("order_id"), bad("seller_id"), bad("order_id")
    sent = f"{key} NOT IN (1, 2)"
    steps = [
        ("publish", "orders", "ord", "true", [], None),
        ("publish", "payments", "raw_payments", sent, [
            ("payment_sequential", "false"), ("payment_installments", f"{key} = 1"),
            ("payment_value", f"{key} = 2")], None),
        ("ingest", "orders", "ord", f"{orders} <> 4", [
            ("order_id", f"{orders} = 4"), ("customer_id", "false")], f"{orders} <> 4"),
        ("ingest", "payments", f"(SELECT * FROM raw_payments WHERE {sent})", "true", [
            (c, "false") for c in ("order_id", "payment_sequential", "payment_installments",
                                   "payment_value")], "true"),
        ("load", "sellers", "raw_sellers", f"{sellers} <> 5", [("seller_id", f"{sellers} = 5")],
         f"{sellers} <> 5"),
        ("load", "order_items", "raw_order_items", f"{key} <> 3", [
            ("order_id", "false"), ("order_item_id", f"{key} = 3"), ("price", "false"),
            ("freight_value", "false")], f"{key} <> 3"),
    ]
    rows = []
    for step, source, table, taken, reasons, kept in steps:
        outcomes = [("read", "true"), ("accepted", taken), *[(f"rejected: {r}", c) for r, c in reasons]]
        outcomes += [("in table", kept)] if kept else []
        rows += [f"SELECT '{step}' AS step, '{source}' AS source, '{o}' AS outcome, "
                 f"(SELECT count(*) FROM {table} WHERE {c}) AS rows" for o, c in outcomes]
    return with_ctes("ord", "raw_payments", "raw_sellers", "raw_order_items") + "\nUNION ALL ".join(rows)


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    ts_cols = ("purchase_timestamp", "approved_at", "delivered_carrier_date",
               "delivered_customer_date", "estimated_delivery_date")
    q["clean_orders"] = with_ctes("clean_orders") + "SELECT * FROM clean_orders"
    q["topic_orders"] = q["clean_orders"]
    q["same_time_orders"] = with_ctes("ord") + """
SELECT order_id, customer_id, order_status, purchase_timestamp, approved_at,
  delivered_carrier_date, delivered_customer_date, estimated_delivery_date FROM ord"""
    q["csv_sellers"] = with_ctes("raw_sellers") + f"""
SELECT seller_id, seller_zip_code_prefix, {_title("'\"x\", ' || seller_city")} AS seller_city,
  upper(seller_state) AS seller_state FROM raw_sellers"""
    q["clean_payments_dirty"] = with_ctes("raw_payments") + """
SELECT order_id, CASE k WHEN 0 THEN 1 ELSE payment_sequential END AS payment_sequential,
  payment_type, CASE k WHEN 0 THEN 1 ELSE payment_installments END AS payment_installments,
  CASE k WHEN 0 THEN 0.0 ELSE CAST(payment_value AS DOUBLE) END AS payment_value
FROM (SELECT *, CAST(order_id AS BIGINT) % 7 AS k FROM raw_payments) WHERE k NOT IN (2, 3, 4)"""
    q["rejected_payments"] = with_ctes("raw_payments") + """
SELECT CASE WHEN CAST(order_id AS BIGINT) % 7 = 2 THEN 'payment_value' ELSE 'order_id' END AS reason,
  count(*) AS messages FROM raw_payments WHERE CAST(order_id AS BIGINT) % 7 IN (2, 3, 4) GROUP BY 1"""
    q["daily_run"] = with_ctes("agg_daily_gmv") + \
        "SELECT * REPLACE (CAST(order_date AS TIMESTAMP) AS order_date) FROM agg_daily_gmv"
    q["first_seller_in_file"] = with_ctes("raw_sellers") + f"""
SELECT seller_id, seller_zip_code_prefix, {_title("'m ' || seller_city")} AS seller_city,
  upper(seller_state) AS seller_state FROM raw_sellers"""
    q["csv_multiline_customers"] = with_ctes("cust") + """
SELECT customer_id, customer_unique_id, customer_zip_code_prefix,
  CASE WHEN length(customer_city) % 2 = 0 THEN '"a,b"' || chr(10) || customer_city
    ELSE customer_city END AS customer_city, customer_state FROM cust"""
    q["stream_same_time_orders"] = q["same_time_orders"]
    q["stream_lost_checkpoint"] = stream_ingest_orders_sql()
    q["daily_rejects"] = _daily_rejects_sql()
    q["daily_gate"] = with_ctes(
        "raw_orders", "raw_payments", "raw_sellers", "raw_order_items", "stg_orders", "stg_customers",
        "stg_sellers", "fact_orders", "dim_customers", "dim_sellers", "agg_daily_gmv") + f"""
SELECT suite, "check", "column", unexpected, true AS stopped FROM (
  SELECT suite, "check", "column", unexpected, success FROM (
    {_suite_sql("fact_orders", "fact_orders", FACT_CHECKS)}
    UNION ALL {_suite_sql("dim_customers", "dim_customers", CUSTOMER_CHECKS)})
  UNION ALL SELECT 'model_tests', model || ':' || test, "column", failures, success FROM (
    {_model_tests_sql(MODEL_TESTS)})) WHERE NOT success"""
    q["clean_payments"] = with_ctes("pay_ev") + """
SELECT order_id, payment_sequential, payment_type, payment_installments,
  CAST(payment_value AS DOUBLE) AS payment_value FROM pay_ev"""
    opt = ",\n  ".join(f"'{c}', {_ts(c)}" for c in ts_cols[1:])
    q["encode_orders"] = with_ctes("ord") + f"""
SELECT json_object('order_id', order_id, 'customer_id', customer_id,
  'order_status', order_status,
  'purchase_timestamp', coalesce({_ts('purchase_timestamp')}, ''),
  {opt},
  'event_time', strftime(purchase_timestamp, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00',
  'schema_version', '1.0') AS value
FROM ord"""
    q["encode_payments"] = with_ctes("pay_ev") + """
SELECT json_object('order_id', order_id, 'payment_sequential', payment_sequential,
  'payment_type', payment_type, 'payment_installments', payment_installments,
  'payment_value', CAST(payment_value AS DOUBLE),
  'event_time', strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00',
  'schema_version', '1.0') AS value
FROM pay_ev"""
    q["enrich_orders"] = with_ctes("clean_orders", "cust") + """
SELECT o.customer_id, o.order_id, o.order_status, o.purchase_timestamp, o.approved_at,
  o.delivered_carrier_date, o.delivered_customer_date, o.estimated_delivery_date,
  c.customer_city, c.customer_state
FROM clean_orders o LEFT JOIN cust c ON o.customer_id = c.customer_id"""
    q["latest_event_per_user"] = """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST,
    event_id DESC) AS rn FROM events) WHERE rn = 1"""
    q["first_on_tie"] = with_ctes("pay_ev") + """
SELECT order_id, payment_sequential, payment_type, payment_installments,
  CAST(payment_value AS DOUBLE) AS payment_value, event_time FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id, payment_sequential
    ORDER BY coalesce(event_time, '') DESC, l_partkey, l_suppkey, l_extendedprice) AS rn
  FROM pay_ev) WHERE rn = 1"""
    q["events_parsed"] = """
SELECT event_id, user_id, event_type, value,
  TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"""
    q["parse_event_times"] = """
SELECT event_id, ts AS iso_fraction, date_trunc('second', ts) AS iso_seconds,
  date_trunc('second', ts) AS blank_seconds, date_trunc('second', ts) AS strict_blank,
  CAST(NULL AS TIMESTAMP) AS strict_iso,
  CAST(date_part('day', ts - date_trunc('month', ts)) AS BIGINT) AS day_of_month_elapsed,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS event_time_text
FROM events"""
    q["upsert_orders"] = with_ctes("raw_orders") + """,
tgt AS (SELECT order_id, customer_id, 'processing' AS order_status, purchase_timestamp,
          purchase_timestamp AS approved_at, CAST(NULL AS TIMESTAMP) AS delivered_carrier_date,
          estimated_delivery_date AS delivered_customer_date, estimated_delivery_date,
          CAST(NULL AS VARCHAR) AS customer_city, CAST(NULL AS VARCHAR) AS customer_state
        FROM raw_orders WHERE CAST(order_id AS BIGINT) % 2 = 0),
src AS (SELECT * FROM raw_orders
        WHERE CAST(order_id AS BIGINT) % 2 = 1 OR CAST(order_id AS BIGINT) % 3 <> 0)
SELECT coalesce(t.order_id, s.order_id) AS order_id,
  CASE WHEN t.order_id IS NOT NULL THEN t.customer_id ELSE s.customer_id END AS customer_id,
  CASE WHEN s.order_id IS NOT NULL THEN s.order_status ELSE t.order_status END AS order_status,
  CASE WHEN s.order_id IS NOT NULL THEN s.purchase_timestamp ELSE t.purchase_timestamp END
    AS purchase_timestamp,
  CASE WHEN t.order_id IS NOT NULL THEN t.approved_at ELSE s.approved_at END AS approved_at,
  CASE WHEN t.order_id IS NOT NULL THEN t.delivered_carrier_date ELSE s.delivered_carrier_date END
    AS delivered_carrier_date,
  CASE WHEN s.order_id IS NOT NULL THEN s.delivered_customer_date ELSE t.delivered_customer_date END
    AS delivered_customer_date,
  CASE WHEN t.order_id IS NOT NULL THEN t.estimated_delivery_date ELSE s.estimated_delivery_date END
    AS estimated_delivery_date,
  CASE WHEN s.order_id IS NOT NULL THEN s.customer_city ELSE t.customer_city END AS customer_city,
  CASE WHEN s.order_id IS NOT NULL THEN s.customer_state ELSE t.customer_state END AS customer_state
FROM tgt t FULL OUTER JOIN src s ON t.order_id = s.order_id"""
    q["upsert_payments"] = with_ctes("pay_ev") + """,
tgt AS (SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value
        FROM (SELECT *, row_number() OVER (PARTITION BY order_id, payment_sequential
                ORDER BY event_time DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) rn
              FROM pay_ev WHERE l_orderkey % 2 = 0) WHERE rn = 1),
src AS (SELECT order_id, payment_sequential, upper(payment_type) AS payment_type,
          CAST(1 + l_suppkey % 12 AS INTEGER) AS payment_installments,
          payment_value + CAST(1 AS DECIMAL(12, 2)) AS payment_value
        FROM (SELECT *, row_number() OVER (PARTITION BY order_id, payment_sequential
                ORDER BY event_time DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) rn
              FROM pay_ev WHERE l_orderkey % 2 = 1 OR l_orderkey % 3 <> 0) WHERE rn = 1)
SELECT coalesce(t.order_id, s.order_id) AS order_id,
  coalesce(t.payment_sequential, s.payment_sequential) AS payment_sequential,
  CASE WHEN s.order_id IS NOT NULL THEN s.payment_type ELSE t.payment_type END AS payment_type,
  CASE WHEN t.order_id IS NOT NULL THEN t.payment_installments ELSE s.payment_installments END
    AS payment_installments,
  CAST(CASE WHEN s.order_id IS NOT NULL THEN s.payment_value ELSE t.payment_value END AS DOUBLE)
    AS payment_value
FROM tgt t FULL OUTER JOIN src s
  ON t.order_id = s.order_id AND t.payment_sequential = s.payment_sequential"""
    q["insert_new_sellers"] = with_ctes("raw_sellers") + """
SELECT * FROM raw_sellers WHERE CAST(seller_id AS BIGINT) % 2 = 0
UNION ALL
SELECT seller_id, seller_zip_code_prefix, upper(seller_city) AS seller_city, seller_state
FROM raw_sellers WHERE seller_id NOT IN
  (SELECT seller_id FROM raw_sellers WHERE CAST(seller_id AS BIGINT) % 2 = 0)"""
    q["insert_new_items"] = with_ctes("raw_order_items", "items_all") + """,
first_src AS (SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date,
                price + CAST(1 AS DECIMAL(12, 2)) AS price, freight_value
              FROM (SELECT *, row_number() OVER (PARTITION BY order_id, order_item_id
                      ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) rn
                    FROM items_all) WHERE rn = 1),
tgt AS (SELECT * FROM raw_order_items WHERE CAST(order_id AS BIGINT) % 2 = 0)
SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date,
  CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value FROM tgt
UNION ALL
SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date,
  CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value
FROM first_src s WHERE NOT EXISTS (
  SELECT 1 FROM tgt WHERE tgt.order_id = s.order_id AND tgt.order_item_id = s.order_item_id)"""
    q["bucketed_upsert_orders"] = q["upsert_orders"]
    q["bucketed_insert_items"] = q["insert_new_items"]
    q["stg_orders"] = with_ctes("stg_orders") + \
        "SELECT * REPLACE (CAST(delivery_days AS DOUBLE) AS delivery_days) FROM stg_orders"
    q["stg_customers"] = with_ctes("stg_customers") + "SELECT * FROM stg_customers"
    q["stg_sellers"] = with_ctes("stg_sellers") + "SELECT * FROM stg_sellers"
    q["dim_customers"] = with_ctes("dim_customers") + "SELECT * FROM dim_customers"
    q["dim_sellers"] = with_ctes("dim_sellers") + """
SELECT seller_key, seller_id, city, state, total_orders,
  CAST(total_revenue AS DOUBLE) AS total_revenue FROM dim_sellers"""
    q["order_payment_total"] = with_ctes("paid_totals") + """
SELECT order_id, CAST(total_payment_value AS DOUBLE) AS total_payment_value FROM paid_totals"""
    q["order_primary_seller"] = with_ctes("primary_sellers") + "SELECT * FROM primary_sellers"
    q["fact_orders"] = with_ctes("fact_orders") + """
SELECT order_id, customer_key, seller_key, CAST(payment_value AS DOUBLE) AS payment_value,
  order_status, order_purchase_timestamp, order_approved_at, order_delivered_customer_date,
  order_estimated_delivery_date, CAST(delivery_days AS DOUBLE) AS delivery_days, is_delivered,
  customer_state
FROM fact_orders"""
    q["agg_daily_gmv"] = with_ctes("agg_daily_gmv") + \
        "SELECT * REPLACE (CAST(order_date AS TIMESTAMP) AS order_date) FROM agg_daily_gmv " \
        "ORDER BY order_date"
    q["daily_gmv_range"] = with_ctes("agg_daily_gmv") + f"""
SELECT CAST(order_date AS TIMESTAMP) AS order_date, total_orders, total_gmv, avg_payment_value,
  avg_delivery_days
FROM agg_daily_gmv WHERE order_date BETWEEN DATE '{R.GMV_RANGE[0]}' AND DATE '{R.GMV_RANGE[1]}'
ORDER BY order_date"""
    top = """
SELECT seller_id, city, state, total_orders, CAST(total_revenue AS DOUBLE) AS total_revenue
FROM dim_sellers WHERE total_revenue > 0 {extra}
ORDER BY total_revenue DESC, seller_id ASC LIMIT {n}"""
    q["top_sellers"] = with_ctes("dim_sellers") + top.format(extra="", n=R.TOP_N)
    q["top_sellers_by_state"] = with_ctes("dim_sellers") + top.format(
        extra=f"AND state = '{R.STATE}'", n=R.TOP_N)
    q["top_sellers_labels"] = with_ctes("dim_sellers") + f""",
top AS ({top.format(extra="", n=R.TOP_N)})
SELECT seller_id, substring(seller_id, 1, 8) || '…' AS seller_label,
  'R$' || format('{{:,}}', CAST(round_even(total_revenue, 0) AS BIGINT)) AS revenue_label,
  total_revenue
FROM top ORDER BY total_revenue ASC, seller_id DESC"""
    dist = f"""
SELECT order_status, count(*) AS order_count FROM fact_orders
WHERE {_dates('order_purchase_timestamp', R.STATUS_RANGE)}
GROUP BY order_status"""
    q["order_status_dist"] = with_ctes("fact_orders") + dist + \
        "\nORDER BY order_count DESC, order_status ASC"
    q["order_status_share"] = with_ctes("fact_orders") + f""",
dist AS ({dist})
SELECT order_status, order_count,
  CAST(order_count AS DOUBLE) / sum(order_count) OVER () AS share,
  {_round_ratio('CAST(order_count AS HUGEINT) * 1000', 'sum(order_count) OVER ()', 1)} AS percent
FROM dist"""
    dstate = """
SELECT customer_state, {avg} AS avg_delivery_days, count(*) AS total_orders
FROM fact_orders
WHERE delivery_days IS NOT NULL AND customer_state IS NOT NULL {extra}
GROUP BY customer_state ORDER BY avg_delivery_days DESC, customer_state ASC"""
    avg = _round_ratio("CAST(sum(delivery_days) AS HUGEINT) * 10", "count(*)", 1)
    q["delivery_by_state"] = with_ctes("fact_orders") + dstate.format(avg=avg, extra="")
    q["delivery_one_state"] = with_ctes("fact_orders") + dstate.format(
        avg=avg, extra=f"AND customer_state = '{R.STATE}'")
    kp = """
SELECT CAST(count(DISTINCT order_id) AS BIGINT) AS total_orders,
  coalesce(CAST(sum(payment_value) AS DOUBLE), 0.0) AS total_gmv,
  coalesce({avg}, 0.0) AS avg_delivery_days,
  CAST(count(DISTINCT seller_key) AS BIGINT) AS active_sellers
FROM fact_orders WHERE {dates}"""
    kavg = _round_ratio("CAST(sum(delivery_days) AS HUGEINT) * 10", "count(delivery_days)", 1)
    q["kpis"] = with_ctes("fact_orders") + kp.format(
        avg=kavg, dates=_dates("order_purchase_timestamp", R.KPI_RANGE))
    q["kpis_from_dated_mart"] = q["kpis"]
    q["kpis_empty_range"] = with_ctes("fact_orders") + kp.format(
        avg=kavg, dates=_dates("order_purchase_timestamp", R.EMPTY_RANGE))
    q["quality_fact_orders"] = with_ctes("fact_orders") + _suite_sql(
        "fact_orders", "fact_orders", FACT_CHECKS)
    q["quality_dim_customers"] = with_ctes("dim_customers") + _suite_sql(
        "dim_customers", "dim_customers", CUSTOMER_CHECKS)
    q["model_tests"] = with_ctes(
        "raw_orders", "raw_payments", "raw_sellers", "raw_order_items", "stg_orders",
        "stg_customers", "stg_sellers", "fact_orders", "dim_customers", "dim_sellers",
        "agg_daily_gmv") + _model_tests_sql(MODEL_TESTS)
    fact = q["fact_orders"][len(with_ctes("fact_orders")):]
    q["first_rows_of_mart"] = with_ctes("fact_orders") + fact + """
ORDER BY fact_orders.order_id LIMIT (SELECT count(*) // 2 FROM fact_orders)"""
    q["fact_orders_hot_seller"] = with_ctes("fact_orders", "raw_order_items", "stg_sellers") + """,
sold_by AS (
  SELECT order_id, min(CASE CAST(order_id AS BIGINT) % 3 WHEN 0 THEN '1' WHEN 1 THEN seller_id END)
    AS seller_id FROM raw_order_items GROUP BY order_id),
hot AS (
  SELECT f.* REPLACE (coalesce(z.seller_key, 'unknown') AS seller_key) FROM fact_orders f
  LEFT JOIN sold_by b ON b.order_id = f.order_id LEFT JOIN stg_sellers z ON z.seller_id = b.seller_id)
""" + fact.replace("FROM fact_orders", "FROM hot")
    q["quality_on_sample"] = with_ctes("fact_orders") + f""",
sample AS (SELECT * FROM fact_orders ORDER BY order_id LIMIT {R.SAMPLE_ROWS})
""" + _suite_sql("sample", "fact_orders_sample", FACT_CHECKS)
    both = (_suite_sql("fact_orders", "fact_orders", FACT_CHECKS) + "\nUNION ALL\n"
            + _suite_sql("dim_customers", "dim_customers", CUSTOMER_CHECKS))
    q["quality_summary"] = with_ctes("fact_orders", "dim_customers") + f""",
rep AS ({both})
SELECT suite, bool_and(success) AS success,
  CAST(sum(CASE WHEN success THEN 1 ELSE 0 END) AS BIGINT) AS passed,
  CAST(count(*) AS BIGINT) AS evaluated
FROM rep GROUP BY suite"""
    q["constraints_raw_payments"] = with_ctes("raw_payments") + """,
keyed AS (SELECT *, order_id || '|' || CAST(payment_sequential AS VARCHAR) AS "__pk"
          FROM raw_payments)
""" + _suite_sql("keyed", "raw_payments", PAYMENT_KEY_CHECKS)
    q["customer_lookup"] = with_ctes("cust") + f"""
SELECT customer_id, customer_city, customer_state FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY customer_city ASC NULLS LAST,
    customer_state ASC NULLS LAST) AS rn
  FROM (SELECT customer_id, {_initcap('trim(customer_city)')} AS customer_city,
          upper(trim(customer_state)) AS customer_state
        FROM cust WHERE customer_id IS NOT NULL)) WHERE rn = 1"""
    return q


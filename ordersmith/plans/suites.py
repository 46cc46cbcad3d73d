"""The pipeline's quality suites (Q6 Q7) and declared model tests (Q8)."""

from __future__ import annotations

from ..operators.quality import (
    ModelTest, between, in_set, not_null, row_count_between, unique,
)
from ..schemas import BRAZILIAN_STATES, VALID_ORDER_STATUSES


# Fixed values that must equal the reference's: bounds of the fact's row count.
REFERENCE_FACT_ROWS = (1, 10_000_000)


def fact_orders_suite(min_rows: int | None = 1, max_rows: int | None = None):
    """Q6: 10 expectations on ``fact_orders`` (fixed values that must equal the
    reference's; the row bounds are the caller's: the registered queries pass
    ``REFERENCE_FACT_ROWS``)."""
    return [
        not_null("order_id"),
        unique("order_id"),
        not_null("customer_key"),
        not_null("payment_value"),
        between("payment_value", 0, 100_000),
        not_null("order_status"),
        in_set("order_status", VALID_ORDER_STATUSES),
        between("delivery_days", 0, 365, mostly=0.98),
        row_count_between(min_rows, max_rows),
        not_null("order_purchase_timestamp", mostly=0.99),
    ]


def dim_customers_suite():
    """Q7: 6 expectations on ``dim_customers``."""
    return [
        not_null("customer_key"),
        unique("customer_key"),
        not_null("customer_id"),
        unique("customer_id"),
        in_set("state", BRAZILIAN_STATES, mostly=0.95),
        not_null("city", mostly=0.99),
    ]


def _t(model, column, *tests, values=()):
    return [ModelTest(model, column, t, tuple(values) if t == "accepted_values" else ())
            for t in tests]


def declared_model_tests():
    """Q8: 7 tests on the staging sources, 27 on the models (34)."""
    st = VALID_ORDER_STATUSES
    return [
        # sources
        *_t("raw_orders", "order_id", "not_null"),
        *_t("raw_orders", "customer_id", "not_null"),
        *_t("raw_orders", "order_status", "accepted_values", values=st),
        *_t("raw_payments", "order_id", "not_null"),
        *_t("raw_sellers", "seller_id", "not_null", "unique"),
        *_t("raw_order_items", "order_id", "not_null"),
        # models
        *_t("stg_orders", "order_id", "not_null", "unique"),
        *_t("stg_orders", "customer_id", "not_null"),
        *_t("stg_orders", "order_status", "not_null"),
        *_t("stg_orders", "order_status", "accepted_values", values=st),
        *_t("stg_customers", "customer_key", "not_null", "unique"),
        *_t("stg_customers", "customer_id", "not_null", "unique"),
        *_t("stg_sellers", "seller_key", "not_null", "unique"),
        *_t("stg_sellers", "seller_id", "not_null", "unique"),
        *_t("fact_orders", "order_id", "not_null", "unique"),
        *_t("fact_orders", "customer_key", "not_null"),
        *_t("fact_orders", "payment_value", "not_null"),
        *_t("fact_orders", "order_status", "accepted_values", values=st),
        *_t("dim_customers", "customer_key", "not_null", "unique"),
        *_t("dim_customers", "customer_id", "not_null", "unique"),
        *_t("dim_sellers", "seller_key", "not_null", "unique"),
        *_t("agg_daily_gmv", "order_date", "not_null", "unique"),
        *_t("agg_daily_gmv", "total_gmv", "not_null"),
    ]

"""Every registered query against its DuckDB oracle on the smallest tables."""
import importlib.util
import math
import os

import duckdb
import pandas as pd
import pytest

from conftest import ROOT, SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

spec = importlib.util.spec_from_file_location("spark_entry",
                                              os.path.join(ROOT, "__spark_entry__.py"))
entry_mod = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry_mod)
from ordersmith.plans.registry import QUERIES as CORE  # noqa: E402

NAMES = sorted([*CORE, "stream_ingest_orders"])
QUERIES = entry_mod.queries()
ORACLE = entry_mod.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        v = v.item()
    if isinstance(v, float):
        return round(v, 9)
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    return v


def _rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False)),
                  key=repr)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(QUERIES)
    assert set(NAMES) <= set(ORACLE)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = duck.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _rows(got) == _rows(want)


def test_entry(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["order_date", "total_orders", "total_gmv", "avg_payment_value",
                          "delivered_orders", "avg_delivery_days"]
    assert df.count() > 0

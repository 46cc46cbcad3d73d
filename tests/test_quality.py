import pytest
from ordersmith.operators.quality import (
    QualityError, between, enforce, gate, in_set, not_null, row_count_between, run_model_tests,
    run_suite, summarize, unique, ModelTest,
)


def report(spark, data, schema, checks):
    df = spark.createDataFrame(data, schema)
    return {r["position"]: r for r in run_suite(df, "s", checks).collect()}


def test_between_mostly_ignores_nulls(spark):
    data = [(float(i),) for i in range(98)] + [(1000.0,), (2000.0,)] + [(None,)] * 50
    r = report(spark, data, "x double", [between("x", 0, 100, mostly=0.98)])[0]
    assert (r["evaluated"], r["unexpected"], r["share"], r["success"]) == (100, 2, 0.98, True)
    data = [(float(i),) for i in range(97)] + [(1000.0,)] * 3
    assert report(spark, data, "x double", [between("x", 0, 100, mostly=0.98)])[0][
        "success"] is False


def test_unique_counts_every_repeated_row(spark):
    r = report(spark, [("a",), ("a",), ("b",), (None,)], "x string", [unique("x")])[0]
    assert (r["evaluated"], r["unexpected"], r["success"]) == (3, 2, False)


def test_in_set_all_null_passes(spark):
    r = report(spark, [(None,), (None,)], "x string", [in_set("x", ["a"])])[0]
    assert (r["evaluated"], r["success"]) == (0, True)


def test_row_count_empty_fails(spark):
    r = report(spark, [], "x string", [row_count_between(1, 10_000_000), not_null("x")])
    assert r[0]["success"] is False and r[1]["success"] is True


def test_gate_and_summary(spark):
    df = spark.createDataFrame([("a",), ("a",)], "x string")
    rep = run_suite(df, "s", [not_null("x"), unique("x")])
    s = summarize(rep).first()
    assert (s["success"], s["passed"], s["evaluated"]) == (False, 1, 2)
    with pytest.raises(QualityError):
        gate(rep)
    assert len(gate(run_suite(df, "s", [not_null("x")]))) == 1


def test_model_tests_dbt_semantics(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "y"), (None, "z"), (None, None)],
                               "k string, s string")
    out = {(r["column"], r["test"]): r["failures"] for r in run_model_tests(
        {"t": df}, [ModelTest("t", "k", "not_null"), ModelTest("t", "k", "unique"),
                    ModelTest("t", "s", "accepted_values", ("x", "y"))]).collect()}
    assert out == {("k", "not_null"): 2, ("k", "unique"): 1, ("s", "accepted_values"): 1}


def test_enforce_composite_key(spark):
    df = spark.createDataFrame([("o1", 1), ("o1", 1), ("o1", 2)], "order_id string, seq int")
    r = {row["check"]: row for row in enforce(df, ["order_id"], ["order_id", "seq"]).collect()}
    assert r["expect_column_values_to_be_unique"]["unexpected"] == 2

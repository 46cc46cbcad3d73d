"""Declarative data-quality checks.

A suite is a list of :class:`Check`; :func:`run_suite` evaluates all of them in
one aggregation pass over the table (plus one narrow count per uniqueness
check) and returns the report as a DataFrame, one row per check:
``(suite, position, check, column, evaluated, unexpected, share, success)``.

Semantics: ``evaluated`` is every row for ``not_null`` and row count, and the
non-null rows for the others (nulls are ignored, and an empty set passes);
``share = (evaluated - unexpected) / evaluated``; a check passes when
``share >= mostly``. For ``unique`` every row of a repeated value is
unexpected. The row-count check reports the count as ``evaluated``, 0
unexpected and no share; it passes when the count is within its bounds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)


class QualityError(RuntimeError):
    """Raised by :func:`gate` when a suite has a failing check (Q10)."""


@dataclass(frozen=True)
class Check:
    kind: str
    column: str | None = None
    mostly: float = 1.0
    min_value: float | None = None
    max_value: float | None = None
    values: tuple = field(default_factory=tuple)

    @property
    def name(self) -> str:
        return {
            "not_null": "expect_column_values_to_not_be_null",
            "unique": "expect_column_values_to_be_unique",
            "between": "expect_column_values_to_be_between",
            "in_set": "expect_column_values_to_be_in_set",
            "row_count": "expect_table_row_count_to_be_between",
        }[self.kind]


def not_null(column: str, mostly: float = 1.0) -> Check:
    return Check("not_null", column, mostly)


def unique(column: str, mostly: float = 1.0) -> Check:
    return Check("unique", column, mostly)


def between(column: str, min_value=None, max_value=None, mostly: float = 1.0) -> Check:
    return Check("between", column, mostly, min_value, max_value)


def in_set(column: str, values: Sequence, mostly: float = 1.0) -> Check:
    return Check("in_set", column, mostly, values=tuple(values))


def row_count_between(min_value: int | None, max_value: int | None) -> Check:
    return Check("row_count", None, 1.0, min_value, max_value)


REPORT_SCHEMA = StructType([
    StructField("suite", StringType(), False),
    StructField("position", IntegerType(), False),
    StructField("check", StringType(), False),
    StructField("column", StringType(), True),
    StructField("evaluated", LongType(), True),
    StructField("unexpected", LongType(), True),
    StructField("share", DoubleType(), True),
    StructField("success", BooleanType(), True),
])


def _count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def _out_of_range(c: Column, chk: Check) -> Column:
    bad = F.lit(False)
    if chk.min_value is not None:
        bad = bad | (c < F.lit(chk.min_value))
    if chk.max_value is not None:
        bad = bad | (c > F.lit(chk.max_value))
    return c.isNotNull() & bad


def _scalar_aggs(chk: Check, i: str) -> list[Column]:
    """(evaluated, unexpected) aggregate expressions of a non-unique check."""
    if chk.kind == "row_count":
        return [F.count(F.lit(1)).alias(f"e{i}"), F.lit(0).cast("bigint").alias(f"u{i}")]
    c = F.col(chk.column)
    if chk.kind == "not_null":
        return [F.count(F.lit(1)).alias(f"e{i}"), _count_if(c.isNull()).alias(f"u{i}")]
    if chk.kind == "between":
        return [F.count(c).alias(f"e{i}"), _count_if(_out_of_range(c, chk)).alias(f"u{i}")]
    if chk.kind == "in_set":
        return [F.count(c).alias(f"e{i}"),
                _count_if(c.isNotNull() & ~c.isin(*chk.values)).alias(f"u{i}")]
    raise ValueError(chk.kind)


def _judge(chk: Check) -> Column:
    e, u = F.col("evaluated"), F.col("unexpected")
    share = F.when(e > 0, (e - u).cast("double") / e)
    if chk.kind == "row_count":
        lo = F.lit(chk.min_value) if chk.min_value is not None else F.lit(None)
        hi = F.lit(chk.max_value) if chk.max_value is not None else F.lit(None)
        ok = F.coalesce(e >= lo, F.lit(True)) & F.coalesce(e <= hi, F.lit(True))
        return F.struct(F.lit(None).cast("double").alias("share"), ok.alias("success"))
    ok = F.when(e == 0, F.lit(True)).otherwise(share >= F.lit(float(chk.mostly)))
    return F.struct(share.alias("share"), ok.alias("success"))


def _repeats(df: DataFrame, key: list[str]) -> DataFrame:
    """One row: non-null keys' rows (``n``), rows of repeated keys (``rows``) and how many
    keys repeat (``keys``). One count per key, combined before its shuffle."""
    known = df.select(*key).dropna(subset=key).groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    again = F.col("__n") > 1
    return known.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("n"),
                     F.coalesce(F.sum(F.when(again, F.col("__n"))), F.lit(0)).alias("rows"),
                     F.count(F.when(again, 1)).alias("keys"))


def suite_metrics(checks: Sequence[Check], prefix: str = "") -> list[Column]:
    """Aggregates of all checks but uniqueness, for one aggregation or to be observed while the
    table is written; :func:`run_suite` takes their values as ``observed``."""
    return [a for i, c in enumerate(checks) if c.kind != "unique"
            for a in _scalar_aggs(c, f"{prefix}{i}")]


def run_suite(df: DataFrame, suite: str, checks: Sequence[Check], key: Sequence[str] | None = None,
              observed: dict | None = None, prefix: str = "") -> DataFrame:
    """Evaluate ``checks`` on ``df`` (best a written table): one aggregation without a shuffle
    of rows for all checks but uniqueness, one narrow count per unique column. ``key``
    names the columns of a uniqueness check whose column is '__pk'. With the values
    ``observed`` when the table was written only uniqueness reads it again."""
    scalar = [(i, c) for i, c in enumerate(checks) if c.kind != "unique"]
    parts = []

    def row(i, c, evaluated, unexpected):
        return F.struct(F.lit(i).alias("position"), F.lit(c.name).alias("check"),
                        F.lit(c.column).cast("string").alias("column"),
                        evaluated.cast("bigint").alias("evaluated"),
                        unexpected.cast("bigint").alias("unexpected"))

    if scalar:
        names = [f"{k}{prefix}{i}" for i, _ in scalar for k in "eu"]
        one = df.sparkSession.createDataFrame([tuple(observed[n] for n in names)],
                                              ", ".join(f"{n} long" for n in names)) \
            if observed is not None else df.agg(*suite_metrics(checks, prefix))
        parts.append(one.select(F.inline(F.array(*[
            row(i, c, F.coalesce(F.col(f"e{prefix}{i}"), F.lit(0)),
                F.coalesce(F.col(f"u{prefix}{i}"), F.lit(0))) for i, c in scalar]))))
    for i, c in enumerate(checks):
        if c.kind == "unique":
            columns = list(key) if key and c.column == "__pk" else [c.column]
            parts.append(_repeats(df, columns).select(F.inline(F.array(
                row(i, c, F.col("n"), F.col("rows"))))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    judged = [F.when(F.col("position") == i, _judge(c)) for i, c in enumerate(checks)]
    out = out.withColumn("j", F.coalesce(*judged))
    return out.select(
        F.lit(suite).alias("suite"), F.col("position").cast("int").alias("position"),
        "check", "column", "evaluated", "unexpected",
        F.col("j.share").alias("share"), F.col("j.success").alias("success"))


def summarize(report: DataFrame) -> DataFrame:
    """Q9: one row per suite: success and passed/evaluated checks."""
    return report.groupBy("suite").agg(
        F.min(F.col("success").cast("int")).cast("boolean").alias("success"),
        F.sum(F.col("success").cast("int")).cast("bigint").alias("passed"),
        F.count(F.lit(1)).alias("evaluated"))


def gate(report: DataFrame) -> list:
    """Q10: raise :class:`QualityError` if any check failed.

    Collects the report, whose size is the number of checks (not of the data).
    """
    rows = report.orderBy("suite", "position").collect()
    failed = [r for r in rows if not r["success"]]
    if failed:
        names = ", ".join(f"{r['suite']}:{r['check']}({r['column']})" for r in failed)
        raise QualityError(f"{len(failed)} of {len(rows)} checks failed: {names}")
    return rows


# --- declared model tests (dbt semantics: failures = rows the test query returns)

@dataclass(frozen=True)
class ModelTest:
    model: str
    column: str
    test: str                   # not_null | unique | accepted_values
    values: tuple = ()


def _outside(t: ModelTest) -> Column:
    return F.col(t.column).isNotNull() & ~F.col(t.column).isin(*t.values)


def declared_metrics(model: str, tests: Sequence[ModelTest]) -> list[Column]:
    """Aggregates of a model's null and value tests, to be observed while it is written."""
    out = []
    for i, t in enumerate(tests):
        if t.model == model and t.test == "not_null":
            out.append(_count_if(F.col(t.column).isNull()).alias(f"f{i}"))
        elif t.model == model and t.test == "accepted_values":
            out.append(_count_if(_outside(t)).alias(f"f{i}"))
    return out


def run_model_tests(tables: dict[str, DataFrame], tests: Sequence[ModelTest],
                    observed: dict[str, dict] | None = None) -> DataFrame:
    """Q8: ``(model, column, test, failures, success)`` per declared test.

    ``not_null``: null rows; ``unique``: values present more than once;
    ``accepted_values``: distinct non-null values outside the list. Per model one
    aggregation for its null counts, and one narrow count per tested column.

    ``observed`` holds, by model, the values of :func:`declared_metrics` taken when it was written:
    its null tests then read nothing, and a value test reads the table only to count the
    different values when some row was outside.
    """
    parts: list[DataFrame] = []
    known: list[tuple[int, ModelTest, int]] = []
    observed = observed or {}

    def row(i, t, failures):
        return F.struct(F.lit(i).alias("idx"), F.lit(t.model).alias("model"),
                        F.lit(t.column).alias("column"), F.lit(t.test).alias("test"),
                        failures.cast("bigint").alias("failures"))

    by_model: dict[str, list[tuple[int, ModelTest]]] = {}
    for i, t in enumerate(tests):
        by_model.setdefault(t.model, []).append((i, t))
    for model, items in by_model.items():
        df = tables[model]
        seen = observed.get(model)
        nulls = [(i, t) for i, t in items if t.test == "not_null"]
        if seen is not None:
            known += [(i, t, seen[f"f{i}"] or 0) for i, t in nulls]
        elif nulls:
            one = df.agg(*[_count_if(F.col(t.column).isNull()).alias(f"f{i}") for i, t in nulls])
            parts.append(one.select(F.inline(F.array(*[
                row(i, t, F.coalesce(F.col(f"f{i}"), F.lit(0))) for i, t in nulls]))))
        for i, t in items:
            if t.test == "unique":
                parts.append(_repeats(df, [t.column]).select(F.inline(F.array(row(i, t, F.col("keys"))))))
            elif t.test == "accepted_values" and seen is not None and not seen[f"f{i}"]:
                known.append((i, t, 0))
            elif t.test == "accepted_values":
                outside = df.select(t.column).where(~F.col(t.column).isin(*t.values)).distinct()
                parts.append(outside.agg(F.count(t.column).alias("f"))
                             .select(F.inline(F.array(row(i, t, F.col("f"))))))
            elif t.test != "not_null":
                raise ValueError(t.test)
    if known:
        spark = next(iter(tables.values())).sparkSession
        parts.append(spark.createDataFrame(
            [(i, t.model, t.column, t.test, n) for i, t, n in known],
            "idx int, model string, column string, test string, failures long"))
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p)
    return merged.select("model", "column", "test", "failures",
                         (F.col("failures") == 0).alias("success"))


def enforce(df: DataFrame, not_null_cols: Sequence[str], key: Sequence[str],
            table: str = "table") -> DataFrame:
    """Report of declared constraints (NOT NULL columns, primary key)."""
    checks = [not_null(c) for c in not_null_cols]
    if len(key) == 1:
        return run_suite(df, table, [*checks, unique(key[0])])
    return run_suite(df, table, [*checks, unique("__pk")], key)

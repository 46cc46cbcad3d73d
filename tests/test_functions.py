import datetime as dt

from pyspark.sql import functions as F

from ordersmith.functions import (
    initcap_words, money_text, normalize_city, parse_ts, parse_ts_one_format, round_avg_money,
    round_avg_whole, short_id, surrogate_key, try_int, utc_iso, whole_days_between,
)

T = dt.datetime


def one(spark, expr, data, schema="x string"):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_parse_three_formats(spark):
    data = [("2017-09-13T08:59:02.123456",), ("2017-09-13T08:59:02",), ("2017-09-13 08:59:02",),
            ("",), (None,), ("not-a-date",), ("2017-02-30 00:00:00",)]
    assert one(spark, parse_ts("x"), data) == [
        T(2017, 9, 13, 8, 59, 2, 123456), T(2017, 9, 13, 8, 59, 2), T(2017, 9, 13, 8, 59, 2),
        None, None, None, None]
    assert one(spark, parse_ts_one_format("x"), data) == [
        None, None, T(2017, 9, 13, 8, 59, 2), None, None, None, None]


def test_parsed_type_has_no_zone(spark):
    df = spark.createDataFrame([("2017-09-13 08:59:02",)], "x string").select(parse_ts("x"))
    assert df.schema[0].dataType.typeName() == "timestamp_ntz"


def test_whole_days_truncate(spark):
    df = spark.createDataFrame([(T(2017, 9, 13, 8, 59, 2), T(2017, 9, 23)),
                                (T(2017, 9, 13, 8, 0), T(2017, 9, 12, 0, 0)),
                                (T(2017, 9, 13), None)],
                               "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(whole_days_between("b", "a")).collect()] == [9, -1, None]


def test_initcap_words(spark):
    data = [("são paulo",), ("rio de janeiro",), ("santa barbara d'oeste",), ("mogi-mirim",),
            ("NATION_7",), ("",), (None,)]
    assert one(spark, initcap_words("x"), data) == [
        "São Paulo", "Rio De Janeiro", "Santa Barbara D'Oeste", "Mogi-Mirim", "Nation_7", "",
        None]
    assert one(spark, normalize_city("x"), [("  mogi-mirim ",)]) == ["Mogi-Mirim"]


def test_md5_key(spark):
    assert one(spark, surrogate_key("x"), [("a",), (None,)]) == [
        "0cc175b9c0f1b6a831c399e269772661", None]


def test_round_half_away_exact(spark):
    # payments 2.01 and 0.00 -> 1.005 -> 1.01 (double rounding would give 1.0)
    df = spark.createDataFrame([("2.01",), ("0.00",)], "x string") \
        .select(F.col("x").cast("decimal(12,2)").alias("v"))
    r = df.agg(round_avg_money(F.sum("v"), F.count("v"), 2)).first()[0]
    assert r == 1.01
    # delivery days 0,0,0,1 -> 0.25 -> 0.3 ; negatives round away from zero
    d = spark.createDataFrame([(0,), (0,), (0,), (1,)], "d long")
    assert d.agg(round_avg_whole(F.sum("d"), F.count("d"), 1)).first()[0] == 0.3
    n = spark.createDataFrame([(-1,), (0,), (0,), (0,)], "d long")
    assert n.agg(round_avg_whole(F.sum("d"), F.count("d"), 1)).first()[0] == -0.3
    e = spark.createDataFrame([], "d long")
    assert e.agg(round_avg_whole(F.sum("d"), F.count("d"), 1)).first()[0] is None


def test_lenient_int(spark):
    assert one(spark, try_int("x"), [("3",), (" 3 ",), ("1.0",), ("",), ("x",)]) == [
        3, 3, None, None, None]


def test_labels(spark):
    assert one(spark, short_id("x"), [("abcdefghijkl",)]) == ["abcdefgh…"]
    assert one(spark, money_text("v"), [(1234.4,), (1234.5,), (1235.5,)], "v double") == [
        "R$1,234", "R$1,234", "R$1,236"]


def test_utc_iso(spark):
    assert one(spark, utc_iso(F.col("t")), [(T(2024, 1, 2, 3, 4, 5, 6),)], "t timestamp_ntz") == [
        "2024-01-02T03:04:05.000006+00:00"]
    now = one(spark, utc_iso(), [(1,)], "x int")[0]
    assert now.endswith("+00:00") and now[10] == "T"


def test_text_and_ranges_do_not_depend_on_session_zone(spark):
    """1999-10-03 00:00 does not exist in Sao Paulo (DST started at midnight);
    timestamp_ntz text and date ranges must not move with the session zone."""
    from ordersmith.functions import iso_text, month_start, on_dates, ts_text
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        df = spark.createDataFrame([(T(1999, 10, 3, 0, 0, 0),), (T(1999, 10, 2, 23, 30, 0, 5),)],
                                   "t timestamp_ntz")
        got = df.select(ts_text("t"), iso_text("t", "T", fraction=True), utc_iso(F.col("t")),
                        on_dates("t", "1999-10-03", "1999-10-03"), month_start("t")).collect()
        assert tuple(got[0]) == ("1999-10-03 00:00:00", "1999-10-03T00:00:00.000000",
                                 "1999-10-03T00:00:00.000000+00:00", True, T(1999, 10, 1))
        assert tuple(got[1])[:4] == ("1999-10-02 23:30:00", "1999-10-02T23:30:00.000005",
                                     "1999-10-02T23:30:00.000005+00:00", False)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)

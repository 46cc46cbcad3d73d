"""Property tests: operators against brute-force Python on random inputs."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ordersmith.operators.dedup import keep_first, keep_max
from ordersmith.operators.upsert import insert_new, upsert
from ordersmith.plans.models import seller_metrics

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
keys = st.sampled_from(["a", "b", "c", "d"])


@SETTINGS
@given(st.lists(st.tuples(keys, st.integers(0, 5), st.integers(0, 1000)), min_size=1,
                max_size=40, unique_by=lambda r: r[2]))
def test_dedup_forms_match_brute_force(spark, data):
    df = spark.createDataFrame(data, "k string, t int, v int")
    want = {}
    for k, t, v in data:
        if k not in want or (t, v) > want[k]:
            want[k] = (t, v)
    a = {r["k"]: (r["t"], r["v"]) for r in
         keep_first(df, ["k"], [F.col("t").desc(), F.col("v").desc()]).collect()}
    b = {r["k"]: (r["t"], r["v"]) for r in keep_max(df, ["k"], [F.col("t"), F.col("v")]).collect()}
    assert a == want and b == want


@SETTINGS
@given(st.dictionaries(keys, st.integers(0, 9), max_size=4),
       st.dictionaries(keys, st.integers(0, 9), max_size=4))
def test_upsert_matches_dict_update(spark, target, source):
    sch = "k string, u int, keep int"
    t = spark.createDataFrame([(k, v, v) for k, v in target.items()], sch)
    s = spark.createDataFrame([(k, v, -v) for k, v in source.items()], sch)
    want = {k: (v, v) for k, v in target.items()}
    for k, v in source.items():
        want[k] = (v, want[k][1]) if k in want else (v, -v)
    once = upsert(t, s, ["k"], ["u"])
    got = {r["k"]: (r["u"], r["keep"]) for r in once.collect()}
    assert got == want
    twice = {r["k"]: (r["u"], r["keep"]) for r in upsert(once, s, ["k"], ["u"]).collect()}
    assert twice == want
    ins = {r["k"]: r["u"] for r in insert_new(t, s, ["k"]).collect()}
    assert ins == {**source, **target}


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["o1", "o2", "o3"]), st.sampled_from(["s1", "s2"])),
                max_size=8),
       st.lists(st.tuples(st.sampled_from(["o1", "o2", "o4"]), st.integers(0, 500)), max_size=6))
def test_seller_revenue_forms_match_brute_force(spark, items, pays):
    it = spark.createDataFrame(items, "order_id string, seller_id string")
    py = spark.createDataFrame([(o, v) for o, v in pays], "order_id string, v int") \
        .select("order_id", (F.col("v").cast("decimal(12,2)") / 100).cast("decimal(12,2)")
                .alias("payment_value"))
    want = {}
    for o, s in items:
        matches = [v for po, v in pays if po == o] or [0]
        orders, rev = want.get(s, (set(), 0))
        want[s] = (orders | {o}, rev + sum(matches))
    want = {s: (len(o), r) for s, (o, r) in want.items()}
    for method in ("pre_aggregated", "fan_out"):
        got = {r["seller_id"]: (r["total_orders"], int(round(float(r["total_revenue"]) * 100)))
               for r in seller_metrics(it, py, method).collect()}
        assert got == want


@SETTINGS
@given(st.lists(st.text(alphabet="abcXYZ09 -'_.ãçéõÁ", max_size=12), min_size=1, max_size=20))
def test_initcap_words_matches_brute_force(spark, texts):
    import regex
    from ordersmith.functions import initcap_words

    def brute(t):
        return "".join(w[:1].upper() + w[1:].lower()
                       for w in regex.findall(r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+", t))
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    assert [r[0] for r in df.select(initcap_words("x")).collect()] == [brute(t) for t in texts]


@SETTINGS
@given(st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(1, 10**6)), min_size=1,
                max_size=30), st.integers(0, 3))
def test_round_ratio_is_half_away_from_zero(spark, pairs, digits):
    from decimal import ROUND_HALF_UP, Decimal
    from ordersmith.functions import round_ratio

    df = spark.createDataFrame(pairs, "t long, n long")
    got = [r[0] for r in df.select(round_ratio("t", "n", digits)).collect()]
    want = [float((Decimal(t) / Decimal(n)).quantize(Decimal(1), rounding=ROUND_HALF_UP)
                  / (10 ** digits)) for t, n in pairs]
    assert got == want

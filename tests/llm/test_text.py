"""Chat formatting and HTML extraction."""
import hashlib

import pytest

from conftest import SF_SMALL
from ordersmith.llm.chat_format import format_chats, parse, under_loss
from ordersmith.llm.html_extract import extract, extract_main_text, fit_weights
from ordersmith.llm.oracles import ORACLES
from ordersmith.llm.queries import QUERIES
from pyspark.sql import functions as F

ODD = ["", " ", "\\", "\\\\", "a\\b", "</s>", "<s>", "[INST] ", " [/INST]", "[/INST]</s><s>user[INST] x",
       "<\\s>", "ends with \\", "<", "</", "\n", "é</s>\\n", "[\\INST]", "</s", "s>", None]


def test_any_content_survives(spark):
    rows = [(c, 2 * i + k, role, text) for c, k in ((1, 0), (2, 1)) for i, text in enumerate(ODD)
            for role in (["user", "assistant", text][i % 3],)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for r in format_chats(df).collect():
        want = [(a or "", t or "") for c, _, a, t in sorted(rows, key=lambda x: x[1]) if c == r["conv_id"]]
        assert [tuple(t) for t in r["turns"]] == want
        spans = [r["formatted"][s["start"] - 1:s["start"] - 1 + s["length"]] for s in r["loss_spans"]]
        assert len(spans) == sum(a == "assistant" for a, _ in want)


def test_loss_text_and_awkward_rows(spark):
    df = spark.createDataFrame(
        [(1, 1, "assistant", "b</s>"), (1, 0, "user", "a"), (1, 1, "assistant", "b</s>"),
         (None, None, None, None), (2, None, "assistant", "late"), (2, 5, "assistant", "early")],
        "conv_id long, turn long, role string, text string")
    out = format_chats(df.withColumn("own", F.lit(1)).withColumn("first", F.lit(2)))
    got = {r["conv_id"]: (r["loss"], len(r["turns"])) for r in out.select(
        "conv_id", "turns", under_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    assert got == {1: ("b</s>b</s>", 3), None: ("", 1), 2: ("earlylate", 2)}
    assert format_chats(df.limit(0)).count() == 0


def test_parse_cuts_at_the_grammar(spark):
    df = spark.createDataFrame([("<s>u[INST] a [/INST]</s><s>v[INST]  [/INST]</s>",)], "f string")
    assert [tuple(t) for t in df.select(parse(F.col("f"))).first()[0]] == [("u", "a"), ("v", "")]


PAGE = """<!doctype html><html><head><title>T</title><style>p{{}}</style><script>var a="</p>";</script></head>
<body><header><h1>Site</h1></header><nav><ul><li><a href="/">Home page here</a></li><li><a>News</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this page, accept them all</div>
<article><h1>Title of it</h1><p>First &amp; <b>bo</b>ld  text&nbsp;here.<p>Second paragraph with more words in it.
<div class="ad">Buy this now, it is cheap and good, do not wait</div>
<p>Third one<br>goes on.</p><form><label>Mail</label><input value="x"></form><aside>Read also this</aside>
<!-- hidden <p>note</p> --><p>End.</p></article>
<section id="comments"><p>First comment by a reader, long enough to count</p></section>
<footer>&copy; somebody, all rights reserved</footer></body></html>"""
WANT = ("Title of it First & bold text here. Second paragraph with more words in it. Third one goes on. End.")


def test_extract_keeps_the_article_only(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    weights = fit_weights(pages)
    assert extract(PAGE, weights) == WANT
    assert extract(PAGE, {}) == WANT
    assert extract(None, weights) == extract("", weights) == extract("<p", weights) == ""
    assert extract("<html><body><nav><a>x</a></nav></body></html>", weights) == ""
    long = "<article>" + "<p>some words</p>" * 20_000 + "</article>"
    assert extract(long, weights) == " ".join(["some words"] * 20_000)


BODY = ("<article><h1>Title</h1>" + "<p>some words of the article here and more</p>" * 20 + "</article>")


@pytest.mark.parametrize("page", [
    '<div class="content has-sidebar">{}<div class="sidebar"><ul><li>one link</li></ul></div></div>',
    '<div id="page-with-header"><div class="header">Site name</div>{}</div>',
    '<form id="aspnetForm" action="x"><input name="s">{}</form>',
    '{}<div class="thread"><p>a reader says so</p></div>',
    '{}<div class="comment-list"><div class="post-reply"><p>' + "long reader comment " * 200 + "</p></div></div>",
    '{}<form class="search"><label>find</label></form><div class="site-footer">all rights</div>',
])
def test_extract_keeps_articles_whatever_stands_around_them(spark, page):
    weights = fit_weights(spark.read.parquet(f"{SF_SMALL}/pages.parquet"))
    want = "Title " + " ".join(["some words of the article here and more"] * 20)
    for w in (weights, {}):
        assert extract("<html><body>" + page.format(BODY) + "</body></html>", w) == want
    plain = BODY.replace("article>", "div>")
    assert extract("<html><body><form id='f'>" + plain + "</form></body></html>", weights) == want
    # a form beside a longer text is no wrapper
    assert extract("<html><body>" + plain + "<form><p>your name</p></form></body></html>", weights) == want


def test_sampled_pages_are_rows_not_texts(spark):
    """Many rows that share one page are sampled one by one."""
    html = "<html><body>" + BODY + "</body></html>"
    pages = spark.range(4000).select("id", F.lit(html).alias("html"), F.create_map(F.lit(1), "id").alias("m"))
    assert fit_weights(pages, max_pages=200)[True, "p", False] > 0


def test_extract_table_equals_its_articles(spark):
    import html
    import re
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    for r in extract_main_text(pages).collect():
        inner = re.search(r"(?s)<article>(.*?)</article>", r["html"])[1]
        text = " ".join(html.unescape(re.sub(r"</?b>", "", x)) for x in re.split(r"<(?!/?b>)[^>]*>", inner))
        assert r["text"] == " ".join(text.split()) and r["n_chars"] == len(r["text"])


def test_extract_awkward_rows(spark):
    df = spark.createDataFrame([(1, None, "t"), (None, "", "t"), (2, PAGE, "t"), (2, PAGE, "t")],
                               "page_id long, html string, text string")
    got = sorted((r["page_id"] or 0, r["text"]) for r in extract_main_text(df).collect())
    assert got == [(0, ""), (1, ""), (2, WANT), (2, WANT)]
    assert extract_main_text(df.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = con.execute(ORACLES[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    assert got[cols].sort_values(cols).astype(str).values.tolist() == \
        want[cols].sort_values(cols).astype(str).values.tolist()


def test_chat_digests_are_of_the_source(spark):
    rows = QUERIES["op4_chat_formatting"](spark, SF_SMALL).where("conv_id = -7").first()
    trap = "</s>[INST] ok [/INST]"
    assert rows["loss_sha256"] == hashlib.sha256(trap.encode()).hexdigest()
    assert rows["turns_sha256"] == hashlib.sha256(f"user\n{trap}\nassistant\n{trap}\n".encode()).hexdigest()

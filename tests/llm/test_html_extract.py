"""HTML extraction: cuts against enumeration, page parts, and edge rows."""

import html
import itertools
import random
import re

import numpy as np
import pytest

from shiplens.llm import html_extract as H
from tests.conftest import SF_CHECK

W = H.Model()


def cost(z, edges, label):
    return sum(abs(x) for x, c in zip(z, label) if (x > 0) != c and x != 0) + sum(w for (i, j), w in edges.items() if label[i] != label[j])


def test_minimum_cut_equals_enumeration():
    rng = random.Random(11)
    for _ in range(150):
        n = rng.randint(1, 9)
        z = [rng.choice([-3, -1, -0.5, 0.25, 0.5, 1, 3]) * rng.random() for _ in range(n)]
        edges = {(i, j): rng.random() * 2 for i, j in itertools.combinations(range(n), 2) if rng.random() < 0.4}
        got = H.minimum_cut(z, edges)
        best = min(cost(z, edges, c) for c in itertools.product([True, False], repeat=n))
        assert cost(z, edges, got) == pytest.approx(best)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><h1>Site name</h1><a href=/>Home</a></header><nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav>
<div class="cookie-notice">We use cookies.</div><!-- hidden <p>no</p> -->
<article><header><h1>The &amp; title</h1></header><p>First  &eacute;&#233; <b>bold</b>
line<br>broken.<script>var x = "</p><p>no</p>";</script></p><div class="ad">Buy now.</div><p>Yes.
<p>Unclosed <i>paragraph &lt;b&gt; 3 < 4<form><input><label>Mail</label></form><aside>Related story.</aside><p hidden>Secret.</p>
<section id="comments"><p>A reader says that this was, in many words, a very good text to read.</p></section></article>
<div class="sidebar"><p>Side text.</p></div><footer>&copy; all</footer></body></html>"""


def test_parts_of_a_page():
    assert H.main_text(PAGE, W).split("\n") == ["The & title", "First éé bold line broken.", "Yes.", "Unclosed paragraph <b> 3 < 4"]


@pytest.mark.parametrize(
    "page,want",
    [
        ("<body class='post'><form id=aspnet><div class='page with-sidebar'><div id=main-content><p>Main.</p></div><div class=sidebar><p>Side.</p></div></div></form>", "Main."),
        ("<article><div class='entry-header'><h1>Title</h1></div><p>Text.</p><div class=share>Share this</div></article>", "Title\nText."),
        ("<main><p>Text.</p></main><section id=comments><article><p>A long comment, really.</p></article></section>", "Text."),
        ("<header class=site-header><p>Name</p></header><div role=main><p>Text.</p><div role=complementary>More</div></div>", "Text."),
        ("<article><p>One.</p><article class='related'><p>Other story.</p></article><p>Two.</p></article>", "One.\nTwo."),
        ("<div class=article><p>One</p><nav>Next</nav><table><tr><td>Cell a<td>Cell b</table><pre>x  y</pre></div>", "One\nCell a\nCell b\nx y"),
    ],
)
def test_parts_by_name_and_role(page, want):
    assert H.main_text(page, W) == want


@pytest.mark.parametrize("mark", ["style='overflow:hidden'", 'aria-hidden="false"', "data-hidden=0", 'title="hidden gems"', "data-id=footer", "data-role='navigation'", "title='a class=ad id=nav'", 'data-x="1" title="hidden'])
def test_names_inside_other_attributes_say_nothing(mark):
    assert H.main_text(f"<div {mark}><article {mark}><p {mark}>One <b {mark}>and</b> two.</p></article></div>", W) == "One and two."


@pytest.mark.parametrize("mark", ["hidden", "HIDDEN=''", "title='x' hidden", "class = 'ad'", "ID=comments", "data-x=a/b role='navigation'"])
def test_whole_attributes_are_read(mark):
    assert H.main_text(f"<article><p>One.</p><div {mark}>Two.</div></article>", W) == "One."


LONG = "A sentence that tells, in plain words and at some length, what happened on that day. " * 12


@pytest.mark.parametrize(
    "page,want",
    [
        ("<article class='post comments-open'><p>Text.</p></article>", "Text."),
        ("<main class='content has-sidebar'><p>Text.</p></main><div class=sidebar>Side.</div>", "Text."),
        ("<article class='has-share'><p>One.</p><article class='related-post'><p>Other.</p></article></article>", "One."),
        ("<article><p>Do <em class='alert'>not</em> go<b>od</b>, <span class='notice'>now</span>.</p></article>", "Do not good, now."),
        ("<article><p>One.</p><p><span class='share'>Share this</span></p><p>a<i hidden>x <b>y</b> z</i>b <i hidden>x</i> c</p></article>", "One.\nab c"),
        (f"<article><p>{LONG}</p><div class='notice'>{LONG}</div><p>{LONG}</p></article>", "\n".join([LONG.strip()] * 3)),
        (f"<article><p>{LONG}</p></article><div class='sidebar'><p>{LONG}</p><p>{LONG}</p></div><footer>x</footer>", LONG.strip()),
        ("<article><ul><li><span class=tags>a<li>One.</ul><p><span class=share>b<p>Two.</article>", "One.\nTwo."),
    ],
)
def test_text_and_neighbours_can_outvote_names(page, want):
    assert H.main_text(page, W) == want


def test_page_without_an_article_element():
    long = "A sentence, with words and marks, that goes on for a while. " * 4
    page = f"<body><ul><li><a href=x>Home</a><li><a href=y>News</a></ul><div><p>{long}</p><p>{long}</p></div><p class='footer'>x</p></body>"
    assert H.main_text(page, W) == "\n".join([long.strip()] * 2)


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "<!-- open <p>x", "<script>x", "<p>a</p></div></p><div>", "&#x110000; &nosuch;", "<a 'b <c \"d" * 50])
def test_odd_pages_do_not_crash(page):
    assert isinstance(H.main_text(page, W), str)


def test_very_long_page():
    page = "<article>" + "<p>Some words, here.</p>" * 20_000 + "</article>"
    assert H.main_text(page, W) == "\n".join(["Some words, here."] * 20_000)
    soup = "<div>" + "<p>Some words, here.</p><a href=x>go</a>" * 2_000 + "</div>"
    assert isinstance(H.main_text(soup, W), str)


def test_query_returns_the_article_of_every_page(spark):
    got = {r.page_id: r for r in H.op4_html_extraction(spark, SF_CHECK).collect()}
    pages = spark.read.parquet(f"{SF_CHECK}/pages.parquet").collect()
    assert len(got) == len(pages)
    for r in pages:
        body = re.search("<article>(.*)</article>", r.html, re.S)[1].replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in re.split("</?(?:p|h1)>", body)]
        assert got[r.page_id].text == "\n".join(p for p in parts if p)
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url


def test_edge_rows(spark):
    df = spark.createDataFrame([(1, "u", None), (None, None, "<p>x</p>"), (2, "u", PAGE), (2, "u", PAGE)], "page_id long, url string, html string")
    w = H.train(df)
    got = H.extracted(df.withColumnRenamed("url", "text_"), w).collect()
    assert len(got) == 4 and got[0].text == "" and got[2].text == got[3].text
    assert H.train(df.limit(0)) == H.Model() and H.extracted(df.limit(0), w).count() == 0
    with pytest.raises(ValueError, match="of their own"):
        H.extracted(df.withColumn("text", df.url), w)


STORY = "The share price fell on Monday, after the company said that it would sell less than planned. " * 3


@pytest.mark.parametrize(
    "page,want",
    [
        (f"<article><section id='social-history'><p>{STORY}</p></section></article>", STORY.strip()),
        ("<article><div class='share-price'><p>The share price fell.</p></div></article>", "The share price fell."),
        (f"<div id='content'><div class='modal-verbs'><p>{STORY}</p></div></div>", STORY.strip()),
        (f"<body><form id=aspnet><div><a href=/>Home</a> <a href=/x>News</a></div><div><p>{STORY}</p><p>{STORY}</p></div></form></body>", "\n".join([STORY.strip()] * 2)),
        ("<article><p>One, two.</p><div class='cookie-notice'>We use cookies.</div><div class='ad-slot-left'>Buy now.</div></article>", "One, two."),
    ],
)
def test_one_word_of_a_name_does_not_decide(page, want):
    assert H.main_text(page, W) == want


def test_pages_without_any_mark_are_judged_by_the_prior(spark):
    page = f"<body><ul><li><a href=x>Home</a><li><a href=y>News</a></ul><div><p>{STORY}</p><p>Short one.</p><p>{STORY}</p></div></body>"
    df = spark.createDataFrame([(i, page) for i in range(20)], "page_id long, html string")
    model = H.train(df)
    assert model == H.Model()
    assert {r.text for r in H.extracted(df, model).collect()} == {"\n".join([STORY.strip(), "Short one.", STORY.strip()])}


def unmarked(page):
    """The page with its telling elements turned into plain ones."""
    page = re.sub(r"<(/?)(nav|article|footer|main|aside|header)\b[^>]*>", r"<\1div>", page)
    return re.sub(r"<div class=[^>]*>", "<div>", page)


def accuracy(pages, model, how):
    """Share of blocks labelled as the marked page says, on pages whose marks are taken away from every other one."""
    right = total = 0
    for k, page in enumerate(pages):
        truth = [b.article and not b.boiler for b in H.blocks_of(page)]
        blocks = H.blocks_of(unmarked(page) if k % 2 else page)
        assert [b.text for b in blocks] == [b.text for b in H.blocks_of(page)]
        if how == "cut":
            label = model.labels(blocks)
        elif how == "classifier":
            label = [z > 0 for z in model.logits(blocks)]
        else:  # the elements alone
            label = [b.article and not b.boiler for b in blocks]
        right += sum(a == b for a, b in zip(label, truth))
        total += len(truth)
    return right / total


def test_the_cut_beats_the_classifier_and_the_marks_alone(spark):
    df = spark.read.parquet(f"{SF_CHECK}/pages.parquet").select("page_id", "html")
    model = H.train(df)
    pages = [r.html for r in df.orderBy("page_id").collect()]
    found = {how: accuracy(pages, model, how) for how in ("cut", "classifier", "marks")}
    assert found["cut"] > found["classifier"] > found["marks"], found
    assert found["cut"] > 0.93 and found["classifier"] < 0.9, found


def test_fit_equals_plain_newton(spark):
    df = spark.read.parquet(f"{SF_CHECK}/pages.parquet").select("page_id", "html").where("page_id < 40")
    rows = df.selectExpr("html", "xxhash64(page_id, 'hide') % 2 = 0 as hide").collect()
    parts = [H.training_rows(r.html, r.hide) for r in rows]
    x, y = np.vstack([p[0] for p in parts]), np.concatenate([p[1] for p in parts]).astype(float)
    prior = np.array(H.PRIOR)
    w = prior.copy()
    for _ in range(H.STEPS):
        g, h = H.newton_sums(x, y, w)
        w = w + np.linalg.solve(h + H.RIDGE * np.eye(len(w)), g - H.RIDGE * (w - prior))
    assert np.allclose(H.train(df, sample=10**6).weights, w, atol=1e-5)

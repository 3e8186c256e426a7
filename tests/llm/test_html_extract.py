"""Extraction on pages that the model never saw, on the driver pages and on edge cases."""

import html as entities
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from loam.llm.common import table
from loam.llm.html_extract import extract_text, learn, main_text, marginals, read_page


@pytest.fixture(scope="module")
def model():
    return learn()


T1 = "Snow fell on the pass all day, so the road stayed closed until evening."
T2 = "Two lorries were stuck near the tunnel; nobody was hurt."

UNSEEN = [
    (f"<html><body><header><p>The Herald</p></header><nav><a href='/'>Home</a></nav><article><h1>Snow</h1><p>{T1}</p><p>{T2}</p></article><footer><p>Imprint {T2}</p></footer></body></html>", f"Snow {T1} {T2}"),
    (f"<body><div id='nav'><ul><li><a href='/'>One</a><li><a href='/'>Two</a></ul></div><div id='content'><h1>Snow</h1><p>{T1}<p>{T2}</div><div class='comments'><p>Nice {T2}</p></div><div id='footer'>{T2}</div>", f"Snow {T1} {T2}"),
    (f"<main><h2>Snow</h2><p>{T1}</p><div class='advert'><p>{T2}</p></div><ul><li>a</li><li>b</li></ul></main><aside><p>{T2}</p></aside>", f"Snow {T1} a b"),
    (f"<div class='cookie-notice'><p>{T1}</p></div><article><p>{T2}</p><form><p>Sign up, please. {T1}</p></form></article>", T2),
    (f"<article><h1>A&amp;B &lt;c&gt; &#233;</h1><p>x<b>y</b>z \n\t w&nbsp;v</p><script>var a='<p>no</p>'</script><style>p{{}}</style><!-- no -->{T1}</article>", f"A&B <c> é xyz w v {T1}"),
    (f"<article><p>{T1}</p><section class='comments'><p>{T2}</p></section></article>", T1),
    (f"<p>{T1}</p>", T1),
    (f"<article><h1>Cut</h1><p>{T1} &am", f"Cut {T1} &am"),
    ("", ""),
    ("<article></article>", ""),
    ("<<<>>> </p></div><article><p>ok then</p></b></article></html></html>", "ok then"),
]


@pytest.mark.parametrize("page,text", UNSEEN)
def test_unseen_pages(model, page, text):
    assert main_text(page, model) == text


def test_messages_give_exact_marginals(model):
    """Sum-product against the sum over all labellings of a small tree."""
    page = read_page("<div class='x'><p>Some words here.</p><a href='/'>link</a><section><p>More of it, too.</p></section></div>")
    n = len(page.nodes)
    total, content = 0.0, np.zeros(n)
    for code in range(1 << (n - 1)):
        y = [0] + [(code >> k) & 1 for k in range(n - 1)]
        score = sum(model.potential(page, i)[y[page.nodes[i].parent], y[i]] + model.evidence(page, i)[y[i]] for i in range(1, n))
        total += np.exp(score)
        content += np.exp(score) * np.array(y)
    assert np.allclose(marginals(page, model), content / total, atol=1e-9)


def test_driver_pages(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    got = {r.page_id: r for r in extract_text(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(</article>|<footer>|$)", r.html, re.S)[1]
        text = re.sub(r"<[^>]*>?", lambda m: " " if re.match(r"</?(p|h1|br)", m[0]) else "", body)
        want = " ".join(entities.unescape(text).split())
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)


def test_nulls_repeats_clashes_and_empty_table(spark):
    schema = "page_id long, url string, html string"
    rows = [(1, None, None), (1, None, None), (None, "u", f"<article><p>{T1}</p></article>")]
    df = spark.createDataFrame(rows, schema).withColumn("page", F.lit(3)).withColumn("text", F.lit("clash"))
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in extract_text(df).collect())
    assert got == [(0, T1, len(T1)), (1, "", 0), (1, "", 0)]
    assert extract_text(spark.createDataFrame([], schema)).count() == 0


def test_text_of_rare_elements_in_an_article_stays():
    body = "This is a long paragraph of the article with many words in it, as articles have them. "
    page = (f"<html><body><nav><a href=a>Home</a> <a href=b>News</a></nav><article><h1>Head</h1><p>{body}</p><p>{body}<math>E=mc2</math></p>"
            f"<noscript><p>{body}Plain.</p></noscript><object><p>{body}Object.</p></object></article></body></html>")
    text = main_text(page, learn())
    assert all(x in text for x in ("E=mc2", "Plain.", "Object.")) and "News" not in text


@pytest.mark.parametrize("page,text", [
    (f"<body>{T1} {T2}<br>{T2} <i>{T1}</i><p>A paragraph of its own, long enough to be read.</p></body>", f"{T1} {T2} {T2} {T1} A paragraph of its own, long enough to be read."),
    (f"{T1}\n {T2}", f"{T1} {T2}"),
    (f"<html><body><nav><a href='/'>Home</a></nav>{T1}<div class='comments'><p>{T2}</p></div></body></html>", T1),
    (f"<body><a href='/'>Log in</a> | <article><h1>Snow</h1><p>{T1}</p></article>Imprint</body>", f"Snow {T1}"),
])
def test_text_right_under_the_body(model, page, text):
    assert main_text(page, model) == text


def test_time_grows_with_the_page_only(model):
    for part in ("<b>" * 20_000 + "<li>x</li>" * 20_000, "<b>" * 20_000 + "</i>" * 20_000, "<table>" + "<b>" * 20_000 + "<td>x" * 20_000):
        start = time.perf_counter()
        read_page(f"<article>{part}</article>")
        assert time.perf_counter() - start < 5

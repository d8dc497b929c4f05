import html
import re

import pytest

from fleetpulse.llm import main_text
from tests.llm import cases

SF = "/root/testdata/sf0.01"
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>if(a<b){x="</p>"}</script>
</head><body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a></ul></nav>
<div id="cookie-notice">We use cookies</div><!-- <p>old</p> --><div class=wrap>%s<h1>Real &amp; title</h1>
<p>First para with <a href="y>z">a link</a> in<b>si</b>de.<p>No end &lt;tag&gt; caf&eacute; &#x41;&nbsp;&#66;
<div class="ad">Buy <p>now</p></div><p>Second&nbsp;para.<br>line</p><form><input> Sign up</form>
<section class="user-comments"><article><p>Great post I like it a lot and so on</p></article></section>%s
<aside><p>Side text about many things</p></aside></div><footer>copyright</footer></body></html>"""
TEXT = "Real & title First para with a link inside. No end <tag> café A B Second para. line"


@pytest.mark.parametrize("tags", [("<main><article>", "</article></main>"), ("<article>", ""), ("", "")])
def test_leaves_out_what_is_no_article(tags):
    assert main_text.main_text(PAGE % tags) == TEXT


def test_cut_off_and_odd_pages():
    text = main_text.main_text
    assert text(None) == text("") == text("<nav>menu</nav>") == text("<script>x") == text("<!-- x") == ""
    assert text("plain words & more") == "plain words & more"
    assert text("<article><p>a b c <b>d") == "a b c d"
    assert text("<article><p>one two</p></article><foo") == "one two"
    assert text("1 < 2 and <p title='a>b'>three</p>") == "1 < 2 and three"
    assert text("<p>it's <i>fine</i>, isn't it?</p>") == "it's fine, isn't it?"
    assert len(text("<p>word " * 20_000)) == 5 * 20_000 - 1


def expected(page):
    inner = re.search(r"<article>(.*?)(</article>|<footer>|\Z)", page, re.S)[1]
    blocks = re.sub(r"<(p|h1|br|/p|/h1)[^>]*>", "\n", inner)
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", blocks)).split())


def test_all_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = main_text.extract(pages).collect()
    pages = {r["page_id"]: r["html"] for r in pages.collect()}
    assert len(found) == len(pages)
    for r in found:
        assert r["text"] == expected(pages[r["page_id"]]) and r["n_chars"] == len(r["text"])


def test_edge_rows(spark):
    rows = [(1, "u", PAGE % ("", "")), (1, "u", PAGE % ("", "")), (None, None, None), (2, "v", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for name in cases.CLASHING:
        pages = pages.selectExpr("*", f"'own' AS {name}") if name != "text" else pages
    got = sorted(((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in main_text.extract(pages).collect()), key=str)
    n = len(TEXT)
    assert got == sorted([(1, "u", TEXT, n), (1, "u", TEXT, n), (None, None, "", 0), (2, "v", "", 0)], key=str)
    assert main_text.extract(pages.limit(0)).collect() == []


def test_best_region_is_the_largest_sum():
    import itertools
    import random

    rng = random.Random(1)
    for _ in range(200):
        scores = [rng.choice([-2, -1, 0, 1, 3]) for _ in range(rng.randint(0, 12))]
        a, b = main_text.best_region(scores)
        sums = [sum(scores[i:j]) for i, j in itertools.combinations(range(len(scores) + 1), 2)]
        assert sum(scores[a:b]) == max([0, *sums])


LONG = " ".join(f"word{i}" for i in range(200))


def test_body_in_a_div_beside_article_cards():
    cards = "<div class='grid'><article><a href=x>Other post</a></article><article>teaser</article></div>"
    learned = main_text.learn(main_text.count_kinds(f"<nav>menu</nav><article><p>{LONG}</p></article><div>x</div>"))
    for page in (f"{cards}<div class=post><p>{LONG}</p><p>The end</p></div>", f"<div><p>{LONG}</p><p>The end</p></div>{cards}"):
        for weights in (main_text.Weights(), learned):
            assert f"{LONG} The end" in main_text.main_text(page, weights)


def test_names_inside_an_article():
    text = main_text.main_text
    page = f"""<article data-title='The hidden cost'><h2 id='related-work'>Related work</h2><p>{LONG}</p>
    <section id='discussion'><p>We discuss</p></section><div class="alert">Mind the gap</div>
    <div class="related"><a href=x>Another post</a></div><div class="comments">Great post</div>
    <p aria-hidden="true">no</p><p hidden>no</p><p style="display: none">no</p><p>The end</p></article>"""
    assert text(page) == f"Related work {LONG} We discuss Mind the gap The end"
    assert text(f"<div><h2 id='search'>Search</h2><p>{LONG}</p></div>") == f"Search {LONG}"
    outside = "<div class=alert>" + LONG + "</div>" + f"<article><p>{LONG}</p><div class=alert>a</div></article>"
    learned = main_text.learn(main_text.count_kinds(outside))
    assert dict(learned.names)["alert"] < -1


def test_names_outside_an_article():
    text = main_text.main_text
    assert text(f"<section class='search-results'><p>{LONG}</p><p>The end</p></section>") == f"{LONG} The end"
    assert text(f"<div class=notice>Sale</div><div class=post><p>{LONG}</p></div><div class=share>Tell</div>") == LONG
    assert text(f"<div class=comments><p>{LONG}</p></div>") == ""
    cards = f"<div class=related><div class=widget><article>{LONG}</article></div></div>"
    assert text(f"{cards}<article><p>{LONG} own</p></article>") == f"{LONG} own"
    learned = main_text.learn(main_text.count_kinds(f"<article><p>{LONG}</p></article><div class=share>{LONG}</div>"))
    assert text(f"<div><p>{LONG}</p></div><div class=share>{LONG}</div>", learned) == LONG


def test_header_of_an_article():
    page = f"<header><h1>Site</h1></header><article><header><h1>Own title</h1></header><p>{LONG}</p></article>"
    learned = main_text.learn(main_text.count_kinds(page.replace("<header><h1>Own title</h1></header>", "")))
    for weights in (main_text.Weights(), learned):
        assert main_text.main_text(page, weights) == f"Own title {LONG}"


def test_kinds_are_a_fixed_set(spark):
    """Whatever tags and names the pages make up; what is learned of the others is the same."""
    odd = "".join(f"<x{i}>a</x{i}><div class='menuitem{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}'>b</div>" for i in range(1500))
    page = f"<article>{odd}<p>{LONG}</p></article><div><ul><li>menu</li></ul></div>"
    pages = spark.createDataFrame([(page,)], "html string")
    weights = main_text.learned_weights(pages)
    assert dict(weights.tags).keys() == {"", "div", "p", "ul", "li", "article"}
    assert dict(weights.names).keys() == {"menu"}
    assert weights == main_text.learn(main_text.count_kinds(page))

import html
import random
import re
import time

import pytest

from amalgam.llm import htmltext, queries


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""),
        ("", ""),
        ("<p></p>", ""),
        ("<article><h1>A &amp; B</h1><p>x<b>y</b>\n z<br>w</p></article>", "A & B xy z w"),
        ("<nav><ul><li><a href='/'>Home</a></ul></nav><article><p>one<p>two</article><footer>foot</footer>", "one two"),
        ("<div class='ad'>buy<article><p>kept</p></article>", "kept"),
        ("<article><p>a</p><div class=\"comments\"><article class='comment'><p>reader</p></article></div><p>b</p></article>", "a b"),
        ("<article><script>var t='</p>';</script><p>t&eacute;&#233;&nbsp;x</p><!-- <p>no</p> --><form><p>mail</p></form></article>", "téé x"),
        ("<html><head><title>T</title></head><body><header>Site</header><main><header><h1>Head</h1></header><p>p</p></main><aside>s</aside>", "Head p"),
        ("<article><p>" + "</p><p></p><p>".join("abcdefghij") + "</p></article>", "a b c d e f g h i j"),
        ("<article><p>unclosed <b>bold<p>next &lt;tag&gt; 1 < 2", "unclosed bold next <tag> 1 < 2"),
        ('<article><p title="a>b">x</p></article>', "x"),
        ("<article><p class='ad'>buy<p>one <span class='promo'>no <span>way</span></span>two<h2 class=notice>cookies</h2><div data-url='?id=menu'>kept</div></article>", "one two kept"),
        ("<article><p>Hello there.</p><datalist><option>a</datalist><p>More of it.</article>", "Hello there. More of it."),
        ("<article><p>a <button>press<p>b</article><div><p>c</div>", "a press b"),
        ("<article><p>a <button><div>press</div></button>b</p><select><option>x<option>y</select><p>c</p></article>", "a b c"),
        ("<article><select><option>x</article>", ""),
        ('<article><p title=5">second</p><p title="a=b>c">third</p></article>', "second third"),
        ("<article><p class='comment-on-law'>law</p><div id='menu-items'><p>soup</p></div><p class='comment-list'>no</p><p class='adBanner'>no</p></article>", "law soup"),
        ("<article><p>1 < 2 and 3 > 2, </ and <3</p><svg><title>t</title><path/></svg><p>x<svg/>y</p></article>", "1 < 2 and 3 > 2, </ and <3 xy"),
        ("<article><p>text</p><script>never(", "text"),
        ("<head><title>t</title><body><article>x", "x"),
        ("<p>a</p><!-- <p>b</p>", "a"),
        ("<article><section class='related-links'><p>more</p></section><p>a<br>b</p><ul><li>c<li>d</ul></article><section id=comments><p>hi</p></section>", "a b c d"),
    ],
)
def test_cases(page, want):
    assert htmltext.main_text(page) == want


def test_page_without_article():
    body = "".join(f"<p>{'Sentence number %d of the story goes on here. ' % i * 3}</p>" for i in range(6))
    page = f"<div><a href=x>Home</a></div><div><a href=y>News</a></div><div></div><div id=q>{body}</div><div><a href=z>Next</a></div><div><a href=z>Last</a></div>"
    text = htmltext.main_text(page)
    assert text.startswith("Sentence number 0") and text.endswith("here.") and "News" not in text and "Next" not in text


def test_short_sections_of_a_page_without_article():
    advert = "".join(f"<p class='ad'>buy {i}</p>" for i in range(4))
    long, short, tiny = "long text of the main part " * 40, "a section of one paragraph with rather more than eighty-six characters, split off by adverts", "a tiny section"
    menu = "".join(f"<div><a href='/{i}'>link {i}</a></div>" for i in range(8))
    page = f"<body>{menu}<p>{long}</p>{advert}<p>{tiny}</p>{advert}<p>{short}</p>{advert}<p>{long}</p>{advert}<p>{short} too</p>{menu}<p>imprint</p></body>"
    assert htmltext.main_text(page) == " ".join([long.strip(), tiny, short, long.strip(), short + " too"])


def by_windows(lengths, window, surge):
    """Lines to keep: each stretch of lines no ``window`` zeros apart, from the first to the last one with a sum above ``surge``."""
    runs = []
    for i, n in enumerate(lengths):
        if n and runs and i - runs[-1][1] < window:
            runs[-1][1] = i + 1
        elif n:
            runs.append([i, i + 1])
    tops = [max(sum(lengths[i : i + window]) for i in range(max(0, a - window + 1), b)) for a, b in runs]
    up = [k for k, t in enumerate(tops) if t > surge]
    return [tuple(r) for r in (runs[up[0] : up[-1] + 1] if up else runs)]


def test_stretches_by_windows():
    rng = random.Random(1)
    for _ in range(3000):
        lengths = [rng.choice([0, 0, 0, 1, 5, 60]) for _ in range(rng.randrange(20))]
        window, surge = rng.randint(1, 4), rng.choice([0, 4, 50, 90])
        assert htmltext.stretches(lengths, window, surge) == by_windows(lengths, window, surge), (lengths, window, surge)


@pytest.mark.parametrize("page", [
    "<a " * 50_000, "<a " * 50_000 + ">", "<" * 200_000, "<div>" * 40_000 + "x" + "</div>" * 40_000, "</section>" * 40_000, "<div><p class='ad'>" * 20_000, "<!--" * 50_000,
    "<option>" * 40_000, "<button>" * 40_000, "<a x='" * 30_000, '<a x="' * 30_001 + "'", "&amp" * 60_000, "<script>" * 40_000, "<ul><li>" * 30_000 + "</section>" * 30_000, "<p>" + "word " * 400_000,
])
def test_hostile_and_long_pages(page):
    start = time.perf_counter()
    htmltext.main_text(page)
    assert time.perf_counter() - start < 3


def test_stretches():
    assert htmltext.stretches([0, 0, 5, 0, 5, 0, 0, 0, 0, 7]) == [(2, 5), (9, 10)]
    assert htmltext.stretches([1, 0, 0, 0, 9, 9], surge=5) == [(4, 6)]
    assert htmltext.stretches([]) == []


def test_real_pages_keep_the_article(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    got = queries.op8_html(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(source)
    for r in got:
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", source[r.page_id], re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<(?!/?b>)[^>]*>", " ", inner).replace("<b>", "").replace("</b>", "")).split())
        assert r.text == want and r.n_chars == len(want)
        assert htmltext.main_text(re.sub(r"(</?)(article|main)\b", r"\1div", source[r.page_id])) == want


def test_table(spark):
    rows = [(1, "u", "<article>x</article>", "clash"), (None, None, None, None), (1, "u", "<article>x</article>", "clash")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert sorted(r.text for r in htmltext.extract(pages).collect()) == ["", "x", "x"]
    assert htmltext.extract(pages.drop("url").limit(0)).count() == 0

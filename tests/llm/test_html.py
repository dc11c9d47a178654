import html
import random
import re

import pytest

from tapeworks.llm import html as H
from tapeworks.llm.html import Wrapper, containers, extract, learn, main_text, tree

SCHEMA = "page_id bigint, url string, html string, host string, text string, main string"


def page(i, extra=""):
    return (
        f'<html><head><title>T{i}</title><script>if (a</p>b) x("<p>no")</script></head><body><header><p>Site</p></header><nav><ul><li><a href=/>Home</a><li><a href=/b>B</a></ul></nav>'
        f'<div class="cookie-notice">We use cookies</div><div id=content><h2>Title {i}</h2><p>First {i} para<p>More <b>bo</b>ld &amp; x&nbsp;y\n {i}{extra}</div>'
        f'<div class="sidebar"><p>side {i}</p></div><section id="comments"><p>reader {i}</p></section><form><input><button>Go</button></form><footer>f {i}</footer></body></html>'
    )


def wrapper_of(pages):
    state = None
    for text in pages:
        state = learn(state, tree(text)[0])
    return state


def shape(parts):
    """The wrapper as an expression."""
    return " ".join((f"{p.sign}[{shape(p.kids)}]" if p.sign else f"({shape(p.kids)})").replace("[]", "") + "+" * p.many + "?" * p.maybe for p in parts)


def test_wrapper_is_a_union_free_expression():
    body = lambda x: f"<body>{x}</body>"
    expression = lambda *pages: shape(wrapper_of([body(p) for p in pages]))
    assert expression("<h1>a</h1><p>b</p><p>c</p>", "<h1>a</h1><ul><li>x<li>y</ul><p>z</p>") == "page[body[h1 ul[li li]? p+]]"
    assert expression("<dl><dt>a<dd>b<dt>c<dd>d</dl>", "<dl><dt>a<dd>b</dl>") == "page[body[dl[(dt dd)+]]]"
    assert expression("<dl><dt>a<dd>b</dl>", "<dl><dt>a<dd>b<dt>c<dd>d</dl>", "<dl><dt>a<dd>b<dt>c<dd>d<dt>e<dd>f</dl>") == "page[body[dl[(dt dd)+]]]"
    assert expression("<div>a</div><div>b</div>", "<div>c</div><div>d</div>") == "page[body[div div]]"
    assert expression("<div><h1>a</h1></div><div><p>b</p></div>", "<div><p>d</p></div>") == "page[body[div[h1? p?]+]]"
    three = "<div><ul><li>a</ul></div><div><h1>b</h1></div><div><p>c</p></div>"
    assert expression(three, three.replace("<div><h1>b</h1></div>", "")) == "page[body[div[ul[li]] div[h1]? div[p]]]"
    assert expression('<div class="a post-7 wide">x</div>', '<div class="a post-9">y</div>') == "page[body[div.a]]"
    assert expression("<p>a</p>", "") == "page[body[p?]]"
    assert expression("<section><p>a</p></section><section><h2>t</h2><p>b</p></section>", "<section><p>a</p></section>") == "page[body[section[h2? p]+]]"


def test_wrapper_without_article():
    pages = [page(i, "<ul><li>a<li>b</ul>" if i % 2 else "") for i in range(6)]
    parts = wrapper_of(pages)
    w = Wrapper.of(parts)
    assert extract(pages[2], w) == "Title 2 First 2 para More bold & x y 2"
    assert extract(pages[3], w) == "Title 3 First 3 para More bold & x y 3 a b"
    assert "ul[li li]?" in shape(parts)
    assert "p+" in shape(wrapper_of([*pages, page(9, "<p>x")]))


def plain(i):
    """Blocks of one kind only: nothing but their place and what changes tells them apart."""
    legal = "All rights reserved by the owners of this site, who ask you to read their long terms before you go on. " * 4
    return f"<body><div><p>Our site has a motto that is the same everywhere, and it is quite long too</p></div><div><p>Story {i} begins.</p><p>It goes on {i * 7}.</p></div><div><p>{legal}</p></div></body>"


def test_alignment_tells_equal_paths_apart(monkeypatch):
    pages = [plain(i) for i in range(8)]
    want = [f"Story {i} begins. It goes on {i * 7}." for i in range(8)]
    w = Wrapper.of(wrapper_of(pages))
    assert [extract(p, w) for p in pages] == want
    # an alignment that knows no places folds all divs into one, as a list of paths would
    monkeypatch.setattr(H, "pairs", lambda a, b: [([p for p in a if p.key == k], [p for p in b if p.key == k]) for k in dict.fromkeys(p.key for p in (*a, *b))])
    assert [extract(p, Wrapper.of(wrapper_of(pages))) for p in pages] != want


def test_template_text_is_no_main_text_but_copies_are():
    pages = [f"<body><main><div>Subscribe to us</div><p>News {i}</p><p>and more {i}</p></main></body>" for i in range(6)]
    w = Wrapper.of(wrapper_of(pages))
    assert extract(pages[1], w) == "News 1 and more 1"
    same = ["<body><main><h1>Title</h1><p>All of these pages are copies.</p></main></body>"] * 6
    assert extract(same[0], Wrapper.of(wrapper_of(same))) == "Title All of these pages are copies."


def test_common_openings_do_not_hide_a_slot():
    opening = "This very long opening is the same on every page of the host and goes on. " * 5
    pages = [f"<body><div><h3>menu</h3></div><div><p>{opening}{i}</p></div></body>" for i in range(5)]
    w = Wrapper.of(wrapper_of(pages))
    assert extract(pages[3], w) == f"{opening}3"


def test_pages_of_several_templates():
    pages = [f"<body><nav>n</nav><article><p>Story {i}</p></article><footer>f</footer></body>" for i in range(4)]
    pages += [f"<body><table><tr><td>x<td><div><p>Old story {i}</p><p>told here {i}</p></div></table></body>" for i in range(4)]
    w = Wrapper.of(wrapper_of(pages))
    assert [extract(p, w) for p in pages] == [f"Story {i}" for i in range(4)] + [f"Old story {i} told here {i}" for i in range(4)]
    # what the wrapper has never seen is its own wrapper
    assert extract("<body><center><h1>New</h1><p>One off.</p></center></body>", w) == "New One off."


def test_odd_marks_and_markup():
    alone = lambda x: extract(x, None)
    assert alone("<main><div class='comment-policy-story'>Article body…</div></main>") == "Article body…"
    assert alone("<body><div class='side'>only</div></body>") == "only" == alone("<body><div class='sidebar'>only</div></body>")
    assert alone('<main><p class="a>Hello</p> <p>World</p></main>') == "Hello World"
    assert alone("<article>the long story is here</article><article class='social share'>tweet</article>") == "the long story is here"
    assert alone("<article><p>one two three</p><section class='post-comments'><p>no</p></section></article>") == "one two three no"
    assert alone("<article><p>one two three</p><section class='comments list'><p>no</p></section></article>") == "one two three"
    assert alone("<body><form>f</form><footer>g</footer></body>") == ""


@pytest.mark.parametrize("deep", [5_000, 100_000])
def test_deep_pages(deep):
    text = "<div>" * deep + "deep text<p>more" + "</div>" * deep + "<p>after"
    assert extract(text, None).startswith("deep text more")
    assert extract("</p>" * deep + "<i>" * deep + "x", None) == "x"


def test_wrappers_stay_small():
    rng = random.Random(5)
    tags = "p h2 ul div section table pre blockquote dl ol figure".split()

    def messy(n):
        return "".join(f"<{t} class='{rng.choice('abcdefgh')}{rng.choice('xyz')}'>{messy(n // 4) if n else 'w'}</{t}>" for t in rng.choices(tags, k=rng.randint(1, 60)))

    state, pages = None, [f"<body>{messy(8)}</body>" for _ in range(12)]
    for text in pages:
        state = learn(state, tree(text)[0])
        assert H._size(state) <= H.NODES
    w = Wrapper.of(state)
    assert all(extract(p, w) for p in pages)
    for p in pages[:5]:
        # the whole of a page whose body is the container
        assert sorted(t for _, t in tree(p)[1]) == ["w"] * p.count(">w<")


def test_wrappers_survive_a_dump():
    parts = wrapper_of([page(i) for i in range(5)])
    again = [H.Part.load(p.dump()) for p in parts]
    assert shape(again) == shape(parts) and containers(again) == containers(parts)
    merged = learn(again, [H.Part.load(p.dump()) for p in wrapper_of([page(i, "<ul><li>a</ul>") for i in range(9, 14)])])
    assert extract(page(40), Wrapper.of(merged)) == "Title 40 First 40 para More bold & x y 40"


def test_pages_by_host(spark):
    article = lambda i, h: f'<body><nav>n</nav><article><header><h1>H{i}</h1></header><p>a &lt;{i}&gt;<br>b<div class="ad">buy</div><aside>x</aside><p>c<section class="comments"><p>no</section></article><footer>z'
    rows = [(i, f"https://A.example/{i}", article(i, 0), "h", "t", None) for i in range(20)]
    rows += [(100 + i, f"http://u@b.example:80/{i}", page(i), None, None, "m") for i in range(7)]
    odd = [None, "", "plain", "<<<>", "<p", "<!-- open", "<script>", "<article>" + "w " * 50_000 + "</article>", "<article><p>&bogus; &#65;</article>", "\x00<p>x"]
    rows += [(200 + i, None if i % 2 else "::odd::", h, None, None, None) for i, h in enumerate(odd)] + [(200, None, None, None, None, None)]
    got = main_text(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = got.collect()
    text = {r.page_id: r.text for r in found}
    assert len(found) == len(rows) and text[3] == "H3 a <3> b c" and text[104] == "Title 4 First 4 para More bold & x y 4"
    assert text[200] == "" and text[201] == "" and text[202] == "plain" and text[208] == "&bogus; A" and text[207] == ("w " * 50_000).strip() and all(r.n_chars == len(r.text) for r in found)
    assert main_text(spark.createDataFrame([], SCHEMA)).count() == 0


def test_given_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    truth = {}
    for r in rows.collect():
        inner = r.html.partition("<article>")[2].partition("</article>")[0]
        truth[r.page_id] = " ".join(html.unescape(re.sub(r"<[^>]*>", "\n", re.sub(r"</?b>", "", inner))).split())
    assert {r.page_id: r.text for r in main_text(rows).collect()} == truth


def test_given_pages_without_article(spark):
    """The same pages with their article, nav and footer turned into bare divs."""
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    bare = [(r.page_id, r.url, re.sub(r"(</?)(article|footer|nav)\b", r"\1div", r.html).replace(' class="ad"', ""), None, None, None) for r in rows]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(bare, SCHEMA)).collect()}
    right = 0
    for r in rows:
        inner = r.html.partition("<article>")[2].partition("</article>")[0]
        right += got[r.page_id] == " ".join(html.unescape(re.sub(r"<[^>]*>", "\n", re.sub(r"</?b>", "", inner))).split())
    assert right >= 0.9 * len(rows)

"""The article of synthetic pages of several layouts, whatever surrounds it."""

import html
import random

import pytest

from cabgrid.llm.html_text import extract_main_text, main_text
from corpus import sentence

JUNK = [
    "<nav><ul><li><a href=/>Home page link</a><li><a href=/b>News, sport, and more</a></ul></nav>",
    "<header><p>Site name, with, some, commas, in, it</p></header>",
    "<div class='cookie-banner'>We use cookies, and more cookies, to track you. Accept?</div>",
    "<aside><p>Also read, this, and, that, one, long, list, of, words.</p></aside>",
    '<div id="sidebar-right"><p>Side text, long, with, commas, and more of it.</p></div>',
    "<div class=ad>Buy now, only today, at half the price!</div>",
    "<form action=/s><p>Search, find, look up</p><input name=q><button>Go</button></form>",
    "<script>var x = '<p>no, no, no</p>'; if (a < b) { c(); }</script>",
    "<style>p > a { color: red }</style><!-- a <p>comment</p> -->",
    '<section id="comments"><p>Great post, thanks, really, very good, I like it, yes.</p></section>',
    '<div role="complementary"><p>More, like, this, and, this.</p></div>',
    "<div style='display:none'><p>Hidden, text, here, now.</p></div>",
    "<footer>&copy; someone, 2020, all rights, reserved</footer>",
]


def article(rng):
    blocks, parts = [], []
    for k in range(rng.randint(3, 8)):
        words = sentence(rng, rng.randint(15, 60)) + ", R&D < 3 \"é\"."
        blocks.append(words)
        body = html.escape(words).replace(" ", rng.choice([" ", "\n  ", " <b>"]), 1)
        parts.append((rng.choice(["<p>", "<p class=x>"]) + body) + rng.choice(["</p>", ""]))
    return " ".join(blocks), "\n".join(parts)


WRAPS = ["<article><h1>A title</h1>{}</article>", "<main><h1>A title</h1>{}</main>", '<div class="post-content"><h1>A title</h1>{}</div>', "<div><div><h1>A title</h1>{}</div></div>"]


@pytest.mark.parametrize("wrap", WRAPS)
@pytest.mark.parametrize("seed", range(6))
def test_article_is_found_among_junk(wrap, seed):
    rng = random.Random(seed)
    text, markup = article(rng)
    junk = rng.sample(JUNK, 9)
    page = f"<!DOCTYPE html><html><head><title>T, t</title></head><body>{''.join(junk[:5])}{wrap.format(markup)}{''.join(junk[5:])}</body></html>"
    assert main_text(page) == "A title " + text


def test_junk_inside_the_article_goes():
    page = "<article><h1>T</h1><p>One, two, three.</p><div class='ad'>Buy, buy</div><p>Four.<aside>Note</aside><p>Five.<div class='share-buttons'>Share</div></article>"
    assert main_text(page) == "T One, two, three. Four. Five."


def test_parts_of_the_article_stay():
    page = "<div class=header>Site</div><article><div class='article-header'><h1>T</h1><p class=byline>By A</p></div><p>One, two.<p class=tags>x y</article>"
    assert main_text(page) == "T By A One, two. x y"


@pytest.mark.parametrize("name", ["content with-sidebar", "no-sidebar", "post hidden-print", "post comments-open", "hidden-print", "has-footer entry", "sidebar"])
def test_names_of_a_layout_dont_drop_the_text(name):
    text = "One, two, three and more of the text. " * 5
    assert main_text(f"<body><nav>Home</nav><div class='{name}'><h1>T</h1><p>{text}</p></div><footer>F</footer></body>") == "T " + text.strip()


@pytest.mark.parametrize("name", ["sidebar-right", "site-footer", "post-comments", "widget-content", "main-menu", "page-header"])
def test_names_of_other_parts_still_drop_them(name):
    text = "One, two, three and more of the text. " * 5
    assert main_text(f"<body><div class='{name}'><p>Other, words, here.</p></div><div><p>{text}</p></div><div class='{name}'><p>Other, words.</p></div></body>") == text.strip()


def test_parts_beside_the_best_container_stay():
    first = " ".join(f"Paragraph {k}, of the text, with commas." for k in range(20))
    body = "".join(f"<p>Paragraph {k}, of the text, with commas.</p>" for k in range(20))
    rest = "<h3>More</h3><ul><li>x<li>y</ul><blockquote>Said.</blockquote><pre>k</pre><table><tr><td>1<td>2</table><div><p>Short, end.</p></div>"
    links = "<div><a href=/a>One link</a> <a href=/b>two links</a></div>"
    assert main_text(f"<body>{links}<div>{body}</div>{links}{rest}<div class=ad>Buy</div>{links}</body>") == first + " More x y Said. k 1 2 Short, end."


def test_blocks_spaces_and_references():
    page = "<article><p>a&amp;b&nbsp;c<br>d <i>e</i>f</p><ul><li>x<li>y</ul><table><tr><td>1<td>2</table><pre>k\n  l</pre></article>"
    assert main_text(page) == "a&b c d ef x y 1 2 k l"


@pytest.mark.parametrize(
    "inside, want",
    [
        ("Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be, as said, so.", "Let x=1 be, as said, so."),
        ("A <svg><circle r=1 /><text>label</text></svg> here.", "A label here."),
        ("See <object data=f.pdf>the file</object> now.", "See the file now."),
        ("An <noscript>image of it</noscript> there.", "An image of it there."),
        ("Write:<xmp><b>&amp; x</xmp>like this.", "Write: <b>&amp; x like this."),
        ("Gone <style>p{}</style><template><p>t</p></template><iframe>f</iframe>is that.", "Gone is that."),
    ],
)
def test_text_of_other_kinds_of_elements_stays(inside, want):
    rest = "More of the text, with commas, and so on. " * 4
    assert main_text(f"<body><article><p>{inside}</p><p>{rest}</p></article></body>") == f"{want} {rest.strip()}"


@pytest.mark.parametrize("tag", ["form", "fieldset"])
def test_a_page_that_sits_in_a_form(tag):
    text = "One, two, three and more of the text. " * 5
    page = f"<body><{tag}><nav>Home</nav><div class='story'><p>{text}</p></div><button>Go</button><footer>F</footer></{tag}></body>"
    assert main_text(page) == text.strip()
    beside = f"<body><div><p>{text}</p></div><{tag}><label>Name</label> <p>Send, now, this.</p></{tag}></body>"
    assert main_text(beside) == text.strip()


@pytest.mark.parametrize(
    "page, want",
    [(None, ""), ("", ""), ("plain", "plain"), ("<p>a<b>b", "ab"), ("</p></div>x", "x"), ("<a href='x", ""), ("<script>x", ""), ("<nav>only</nav>", ""), ("<![CDATA[a<b]]>", "a<b")],
)
def test_broken_pages(page, want):
    assert main_text(page) == want


def test_very_deep_and_very_long_pages():
    assert main_text("<div>" * 20_000 + "deep text") == "deep text"
    assert main_text("<b>" * 5_000 + "</i></p>" * 500 + "z") == "z"
    long = "<p>" + "word, " * 50_000
    assert main_text(f"<article>{long}</article>").count("word,") == 50_000
    assert main_text("<p a=\"" * 3000) == ""


def test_rows(spark):
    rows = [(1, "u", "<p>x</p>", "t"), (1, "u", "<p>x</p>", "t"), (None, None, None, None), (2, "v", "", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract_main_text(pages)
    assert got.columns == pages.columns
    assert sorted((str(r.page_id), r.text) for r in got.collect()) == [("1", "x"), ("1", "x"), ("2", ""), ("None", "")]
    assert extract_main_text(pages.where("page_id > 9")).collect() == []

"""Main text of web pages by scoring the element tree.

Every text block outside menus, forms, adverts and the like gives points to the
elements around it: one, one for each comma, and up to three for its length; in
full to the element it stands in, half to the one above, a third to the next.
An element's points are discounted by the share of its text that is in links.
The best container is kept, or the article around it, with those siblings that
score well themselves or read like paragraphs of the same text, and all between
and after them that isn't mostly links. Where nothing is left, class and id values
are disregarded, then that an element is a form (a page may sit in one).
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from cabgrid.llm.scratch import small_batches

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)(?=>)|[^>]*+)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"([a-zA-Z][\w:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Elements whose content is never text of the page.
_RAW = frozenset("script style title textarea iframe template noframes".split())
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in (*_RAW, "xmp")}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img "
    "math svg object noscript".split()
)
#: What stands inside one of these is inline, whatever it is called.
_FOREIGN = ("math", "svg")
_JUNK_TAGS = frozenset("nav footer aside form button select menu dialog head fieldset".split())
#: Of these, what may hold a whole page; disregarded where nothing is left otherwise.
_FORMS = frozenset("form fieldset".split())
_JUNK_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
#: Words of class and id values that mark parts other than the article.
_JUNK_WORDS = re.compile(
    r"^(ad|ads|adv|advert\w*|adbox|adsense|banner\w*|sponsor\w*|promo\w*|sidebar\w*|side|widget\w*|menu\w*|nav|navbar|navigation|breadcrumb\w*|"
    r"footer\w*|masthead|topbar|toolbar|comment\w*|disqus|respond|repl(?:y|ies)|cookie\w*|consent|gdpr|notice\w*|alert\w*|popup\w*|modal\w*|"
    r"overlay|newsletter\w*|subscri\w+|signup|login|share|sharing|social\w*|related\w*|recommend\w*|pagination|pager|skip|hidden|copyright|disclaimer)$"
)
_GOOD_WORDS = re.compile(r"^(article\w*|body|content\w*|entry\w*|main\w*|post\w*|story\w*|text)$")
#: Beginnings and ends of values that tell of a layout or state, not of a part.
_LAYOUT = frozenset("with without no not has have is hide show js".split())
_STATE = frozenset("open closed on off enabled disabled print visible".split())
_WHOLE = frozenset("html body article main".split())
#: A start tag that ends an open paragraph, or an open element of its own kind.
_CLOSES = {"li": "li", "dt": "dd", "dd": "dt", "tr": "tr", "td": "td", "th": "th", "option": "option"}
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A sibling is kept from this share of the best container's points.
SIBLING_SHARE = 0.2


@dataclass(slots=True)
class _Element:
    tag: str
    parent: int
    junk: bool
    in_link: bool
    inline: bool
    points: float = 0.0
    length: int = 0
    linked: int = 0
    children: list[int] = field(default_factory=list)


def _junk_name(pieces: list[str], in_article: bool) -> bool:
    """Whether a class or id value, as a whole, names a part other than the article:
    by its first piece (sidebar-right) or its last one (site-footer)."""
    if pieces[0] in _LAYOUT or pieces[-1] in _STATE:
        return False
    if _JUNK_WORDS.match(pieces[0]) or _JUNK_WORDS.match(pieces[-1]):
        return True
    return "header" in (pieces[0], pieces[-1]) and not in_article and not re.match("article|entry|post|story", pieces[0])


def _is_junk(tag: str, attrs: str, in_article: bool, by_name: bool = True, forms: bool = True) -> tuple[bool, float]:
    """Whether an element isn't part of an article (``by_name``: by its class and id
    values too; ``forms``: if it is a form), and points for its names."""
    if (tag in _JUNK_TAGS and (forms or tag not in _FORMS)) or (tag == "header" and not in_article):
        return True, 0.0
    points = 25.0 if tag in ("article", "main") else 0.0
    named_junk = named_good = False
    if not attrs or tag in ("html", "body"):
        return False, points
    for name, a, b, c in _ATTR.findall(attrs):
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id"):
            named = [p for p in (re.findall(r"[a-z0-9]+", v) for v in value.split()) if p]
            junk = [_junk_name(p, in_article) for p in named]
            good = any(not j and any(map(_GOOD_WORDS.match, p)) for p, j in zip(named, junk))
            named_junk |= any(junk) and (tag not in _WHOLE or "comment" in value)
            named_good |= good
            if good:
                points += 10.0
        elif name == "role":
            if value in _JUNK_ROLES:
                return True, 0.0
            points += 25.0 if value in ("main", "article") else 0.0
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True, 0.0
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True, 0.0
    if by_name and named_junk and not named_good:
        return True, 0.0
    return False, points


def _parse(page: str, by_name: bool, forms: bool) -> tuple[list[_Element], list[tuple[int, str]]]:
    """Elements, and the text blocks in page order with the element of each."""
    elements = [_Element("html", -1, False, False, False)]
    stack, open_tags = [0], {"html": 1}
    blocks: list[tuple[int, str]] = []
    pieces: list[str] = []
    linked = 0
    owner = 0  # the innermost element that isn't inline

    def flush() -> None:
        nonlocal linked
        if pieces:
            block = " ".join(html.unescape("".join(pieces)).split())
            if block and not elements[owner].junk:
                blocks.append((owner, block))
                elements[owner].linked += min(linked, len(block))
            pieces.clear()
            linked = 0

    def close(to: int) -> None:
        """Close the stack's elements from position ``to`` on."""
        nonlocal owner
        if any(not elements[e].inline for e in stack[to:]):
            flush()
        for e in stack[to:]:
            open_tags[elements[e].tag] -= 1
        del stack[to:]
        owner = next(e for e in reversed(stack) if not elements[e].inline)

    def last(tag: str) -> int:
        return next(i for i in range(len(stack) - 1, -1, -1) if elements[stack[i]].tag == tag)

    def say(raw: str) -> None:
        nonlocal linked
        top = elements[stack[-1]]
        if raw and not top.junk:
            pieces.append(raw)
            if top.in_link:
                linked += len(raw.strip())

    at = 0
    while True:
        token = _TOKEN.search(page, at)
        say(page[at : token.start()] if token else page[at:])
        if token is None:
            break
        at = token.end()
        if token["cdata"] is not None:
            say(token["cdata"].replace("&", "&amp;"))
            continue
        if token["tag"] is None:
            continue
        tag = token["tag"].lower()
        if token["end"]:
            if tag in ("br", "p") and not open_tags.get(tag):
                pieces.append(" ")
            elif open_tags.get(tag) and len(stack) > 1 and tag not in ("html", "body"):
                close(max(1, last(tag)))
            continue
        if tag in _RAW:
            stop = _RAW_END[tag].search(page, at)
            at = stop.end() if stop else len(page)
            continue
        if tag == "xmp":  # text as it stands, up to its end tag
            stop = _RAW_END[tag].search(page, at)
            flush()
            say(page[at : stop.start() if stop else len(page)].replace("&", "&amp;"))
            flush()
            at = stop.end() if stop else len(page)
            continue
        if tag in _VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                pieces.append(" ")
            continue
        if tag in ("html", "body") and len(stack) > 1 and open_tags.get(tag):
            continue
        inline = tag in _INLINE or any(open_tags.get(t) for t in _FOREIGN)
        if not inline:
            if open_tags.get("p"):
                place = last("p")
                if not any(elements[e].tag in ("table", "td", "th") for e in stack[place:]):
                    close(place)
            for kind in {tag, _CLOSES.get(tag, tag)} if tag in _CLOSES else ():
                if open_tags.get(kind):
                    place = last(kind)
                    if not any(elements[e].tag in ("ul", "ol", "dl", "table", "select") for e in stack[place + 1 :]):
                        close(place)
            flush()
        up = elements[stack[-1]]
        junk, points = (True, 0.0) if up.junk else _is_junk(tag, token["attrs"], bool(open_tags.get("article") or open_tags.get("main")), by_name, forms)
        if junk and inline:
            junk = up.junk or tag != "a"  # a link with an odd name is still text
        elements.append(_Element(tag, stack[-1], junk, up.in_link or tag == "a", inline, points))
        up.children.append(len(elements) - 1)
        if token["attrs"].endswith("/") and any(open_tags.get(t) for t in _FOREIGN):
            continue  # such elements can be closed by their own tag
        stack.append(len(elements) - 1)
        open_tags[tag] = open_tags.get(tag, 0) + 1
        if not inline:
            owner = stack[-1]
    flush()
    return elements, blocks


def main_text(page: str | None) -> str:
    """The article of a page, blocks joined by one space; empty if there is none."""
    if not page:
        return ""
    for by_name, forms in ((True, True), (False, True), (True, False), (False, False)):
        found = _best_text(page, by_name, forms)
        if found:
            return found
    return ""


def _best_text(page: str, by_name: bool, forms: bool) -> str:
    elements, blocks = _parse(page, by_name, forms)
    if not blocks:
        return ""
    for at, block in blocks:
        elements[at].length += len(block)
        points = 1 + block.count(",") + min(len(block) / 100, 3)
        home = at
        if elements[at].tag in _HEADINGS or elements[at].tag == "p" or not elements[at].children:
            home = max(elements[at].parent, 0)  # a paragraph's points go to what holds it
        share = 1
        while home >= 0 and share <= 4:
            elements[home].points += points / share
            home = elements[home].parent
            share += 1
    for i in range(len(elements) - 1, 0, -1):  # children come after their parents
        e = elements[i]
        elements[e.parent].length += e.length
        elements[e.parent].linked += e.linked

    def score(i: int) -> float:
        e = elements[i]
        return e.points * (1 - e.linked / max(e.length, 1)) if e.length and not e.junk else 0.0

    best = max((i for i, e in enumerate(elements) if not e.inline), key=lambda i: (score(i), -i))
    above = best
    while above > 0:
        if elements[above].tag in ("article", "main"):
            best = above
            break
        above = elements[above].parent
    keep = {best}
    if elements[best].parent >= 0 and elements[best].tag not in ("article", "main"):
        begun = False
        for s in elements[elements[best].parent].children:
            e = elements[s]
            begun = begun or s in keep
            density = e.linked / max(e.length, 1)
            plain = e.tag in ("p", "h1", "h2") or (not e.inline and not e.points and e.length > 80)
            if score(s) >= max(10.0, SIBLING_SHARE * score(best)) or ((plain or (begun and not e.inline)) and not e.junk and e.length and density < 0.25):
                keep.add(s)
                begun = True
    elif elements[best].tag == "article":
        # Articles beside the best one (a text in several parts).
        keep |= {s for s in elements[max(elements[best].parent, 0)].children if elements[s].tag == "article" and score(s) >= SIBLING_SHARE * score(best)}
    inside = [i in keep for i in range(len(elements))]
    for i in range(1, len(elements)):
        inside[i] = inside[i] or inside[elements[i].parent]
    return " ".join(block for at, block in blocks if inside[at])


@F.arrow_udf(T.StringType())
def main_text_column(pages: pa.Array) -> pa.Array:
    return pa.array([main_text(p.as_py()) for p in pages], pa.string())


def extract_main_text(pages: DataFrame, html_col: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with the main text of each whole page in ``name`` (which replaces
    a column of that name). Pages of any length are read whole, and rows that repeat
    are pages like others. Null and empty pages, and pages without text, give an
    empty string. Markup may be broken: unclosed elements end with their parents,
    stray end tags are ignored. An empty table gives an empty result."""
    small_batches(pages.sparkSession)
    return pages.withColumn(name, main_text_column(F.col(html_col)))

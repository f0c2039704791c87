"""Main text of web pages by scoring the element tree.

Paragraphs pass points for their length and commas to the elements around them, less to farther
ones; an element's points are discounted by the share of its text that stands in links. The
element with most points, lifted to the article or main element around it if there is one, and
otherwise to the lowest element around all scored paragraphs, is kept together with its siblings that
are text and not links. Elements that are menus, page
headers, footers, sidebars, notices, adverts, forms, scripts, styles or reader comments by their
tag, role, class or id count for nothing and give no text. A class or id says so only of an element that
does not hold the main or article element, nor (comments aside) most of the page's text: there it names
the layout, and so does a form around these. Of a name of several words (share-price) all must be words for
such things or for places on a page. Names that begin with has-, no-, with- or without- say nothing.

Nulls, ties and odd input: a null or empty page, or one without text, gives an empty text; of
equal scores the first element wins; unclosed and misnested tags are closed as they come, a tag
cut off at the end is dropped; repeated rows stay; an empty table gives an empty result. Pages
are read whole, in time that grows with their length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrowmap import map_arrow

# Elements of the HTML standard by their role in the tree.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr img".split()
)
ENDS_P = frozenset(
    "address article aside blockquote body center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
#: What an opening tag closes, and the elements that this does not reach out of.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
PARAGRAPHS = frozenset("p pre blockquote td li dd".split())
CONTAINERS = frozenset("article section div main body td blockquote html center table tbody tr ul ol dl figure details".split())

JUNK_TAGS = frozenset(
    "nav footer aside script style noscript template svg math button select input iframe object embed applet "
    "canvas dialog menu head datalist audio video map".split()
)
JUNK_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form tablist".split()
)
JUNK_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense adsbygoogle adbox sponsor sponsored sponsors promo promos "
    "promotion nav navbar navigation menu menubar submenu breadcrumb breadcrumbs pagination pager footer header masthead "
    "topbar sidebar sidebars side rail aside widget widgets comment comments commentlist disqus respond replies reply "
    "discussion cookie cookies consent gdpr notice notices alert banner newsletter subscribe subscription signup login "
    "paywall popup modal overlay toast share sharing social related recommended recommendations teaser outbrain taboola "
    "skip search toolbar copyright hidden feedback".split()
)
JUNK_PARTS = re.compile(r"sidebar|advert|sponsor|cookie|breadcrumb|newsletter|navbar|popup|comment[s-]|disqus")
_TAG = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|(/?)([a-zA-Z][^\s/>]*)([^>]*)(>|\Z))")
_ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
READERS = frozenset("comment comments commentlist disqus respond reply replies discussion".split())
_LAYOUT = re.compile(r"(?:has|no|with|without)[-_]")
#: Not junk; junk by a name, by a name for readers' comments, or by what the element is.
TEXT, NAMED, COMMENTS, JUNK = range(4)
_NAME_WORD = re.compile(r"[a-z]+")
#: Words that names of layout elements are made of besides, and that say nothing by themselves.
PLACES = frozenset(
    "main site page web global local home top bottom left right center middle upper lower first second third last "
    "primary secondary tertiary sticky fixed floating mobile desktop tablet small medium large wide narrow inner outer "
    "box boxes block blocks area areas region zone slot slots unit units panel panels pane bar bars strip row rows col "
    "cols column columns grid cell section sections list lists item items entry group groups set container containers "
    "wrapper wrap holder placeholder frame layer module modules component element content contents body text title "
    "heading label icon icons logo image img button buttons btn link links form forms field input post posts article "
    "articles story stories news latest popular more by of to for the and in on under count number id js css is".split()
)
_COMMAS = re.compile("[,،、，]")


class _Node:
    __slots__ = ("commas", "direct", "junk", "kind", "links", "parent", "points", "scored", "size", "tag", "within")

    def __init__(self, tag: str, parent: int, kind: int, within: bool) -> None:
        self.tag, self.parent, self.kind, self.within = tag, parent, kind, within
        self.junk = self.scored = False
        self.size = self.links = self.direct = self.commas = 0
        self.points = 0.0


def _kind(tag: str, attributes: str, within: bool) -> int:
    """``within``: inside an article or main element, where a header is the article's own."""
    if tag in JUNK_TAGS or (tag == "header" and not within):
        return JUNK
    if tag == "form":
        return NAMED
    if not attributes or tag in ("html", "body", "article", "main") and "comment" not in attributes.lower():
        return TEXT
    if tag in INLINE and tag not in ("span", "a"):
        return TEXT
    kind = TEXT
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return JUNK
        if name == "style" and "display:none" in value.replace(" ", ""):
            return JUNK
        if name == "role" and value in JUNK_ROLES:
            return JUNK
        if name in ("class", "id"):
            kind = max([kind, *(_named(x, within) for x in value.split() if not _LAYOUT.match(x))])
    return kind


def _named(token: str, within: bool) -> int:
    """What one class, or an id, says of its element."""
    words = _NAME_WORD.findall(token)
    junk = {w for w in words if w in JUNK_WORDS or JUNK_PARTS.search(w)}
    if within:
        junk.discard("header")
    if not junk or any(w not in junk and w not in PLACES for w in words):
        return TEXT
    return COMMENTS if any(w in READERS or w.startswith(("comments", "disqus")) for w in junk) else NAMED


def _parse(html: str) -> tuple[list[_Node], list[tuple[int, str | None]]]:
    """Elements in page order, and pieces of text (element, text); None marks a block's edge."""
    nodes = [_Node("#root", -1, TEXT, False)]
    events: list[tuple[int, str | None]] = []
    stack = [0]
    opened: dict[str, int] = {}
    at, end = 0, len(html)

    def close(index: int) -> None:
        for i in stack[index:]:
            opened[nodes[i].tag] -= 1
        del stack[index:]

    while at < end:
        m = _TAG.search(html, at)
        upto = m.start() if m else end
        if upto > at:
            events.append((stack[-1], html[at:upto]))
        if not m:
            break
        tag = m.group(2)
        if tag is None:
            opener = m.group()
            ending = {"<!--": "-->", "<![CDATA[": "]]>"}.get(opener, ">")
            stop = html.find(ending, m.end())
            if opener == "<![CDATA[":
                events.append((stack[-1], html[m.end() : stop if stop >= 0 else end].replace("&", "&amp;")))
            at = stop + len(ending) if stop >= 0 else end
            continue
        at = m.end()
        if not m.group(4):
            break  # cut off in the middle of a tag
        tag, attributes = tag.lower(), m.group(3)
        if m.group(1):
            if tag == "br" or tag not in INLINE:
                events.append((stack[-1], None))
            if opened.get(tag):
                i = len(stack) - 1
                while nodes[stack[i]].tag != tag:
                    i -= 1
                close(i)
            continue
        for quote in "\"'":
            # A ">" inside a quoted value does not end the tag.
            if attributes.count(quote) % 2 and (stop := html.find(quote, at)) >= 0 and "=" + quote in attributes:
                after = html.find(">", stop)
                if after >= 0:
                    attributes, at = attributes + html[at - 1 : after], after + 1
        if tag in ENDS_P and opened.get("p"):
            i = len(stack) - 1
            while nodes[stack[i]].tag != "p":
                i -= 1
            if not any(nodes[x].tag in ("td", "th", "button", "table") for x in stack[i + 1 :]):
                close(i)
        if tag in CLOSES:
            closed, limits = CLOSES[tag]
            i = len(stack) - 1
            lowest = None
            while i > 0 and nodes[stack[i]].tag not in limits:
                if nodes[stack[i]].tag in closed:
                    lowest = i
                i -= 1
            if lowest is not None:
                close(lowest)
        if tag not in INLINE:
            events.append((stack[-1], None))
        above = nodes[stack[-1]]
        kind = _kind(tag, attributes, above.within)
        if tag in VOID:
            continue
        if tag in RAW:
            stop = re.compile(f"</{tag}", re.I).search(html, at)
            at = stop.start() if stop else end
            if stop:
                close_at = html.find(">", at)
                at = close_at + 1 if close_at >= 0 else end
            continue
        if attributes.endswith("/") and tag in ("svg", "path"):
            continue
        nodes.append(_Node(tag, stack[-1], kind, above.within or tag in ("article", "main")))
        stack.append(len(nodes) - 1)
        opened[tag] = opened.get(tag, 0) + 1
    return nodes, events


def _settle(nodes: list[_Node], events: list[tuple[int, str | None]]) -> None:
    """Which elements are junk, or stand in junk."""
    hard, linked = [False] * len(nodes), [False] * len(nodes)
    for i, node in enumerate(nodes[1:], 1):
        hard[i] = hard[node.parent] or node.kind == JUNK
        linked[i] = linked[node.parent] or node.tag == "a"
    sizes = [0] * len(nodes)
    for i, text in events:
        if text and not hard[i] and not linked[i]:
            sizes[i] += len(" ".join(text.split()))
    for i in range(len(nodes) - 1, 0, -1):
        sizes[nodes[i].parent] += sizes[i]
    # Every main element counts, and the longest article if it is a good part of the page.
    own = [i for i, n in enumerate(nodes) if n.tag in ("article", "main") and n.kind == TEXT and sizes[i]]
    longest = max((i for i in own if nodes[i].tag == "article"), key=lambda i: sizes[i], default=0)
    holds = [False] * len(nodes)
    for i in own:
        if nodes[i].tag == "main" or (i == longest and 4 * sizes[i] >= sizes[0]):
            while i > 0 and not holds[nodes[i].parent]:
                i = nodes[i].parent
                holds[i] = True
    for i, node in enumerate(nodes[1:], 1):
        named = node.kind in (NAMED, COMMENTS) and not holds[i]
        most = node.kind == NAMED and 2 * sizes[i] > sizes[0]
        node.junk = nodes[node.parent].junk or node.kind == JUNK or (named and not most)


def _score(nodes: list[_Node], events: list[tuple[int, str | None]]) -> None:
    for i, text in events:
        if text and not nodes[i].junk:
            n = len(" ".join(text.split()))
            if n:
                node = nodes[i]
                node.size += n
                node.direct += n
                node.commas += len(_COMMAS.findall(text))
    # Children have higher numbers than their parents: one pass from the end sums up.
    for node in reversed(nodes[1:]):
        above = nodes[node.parent]
        above.size += node.size
        above.links += node.size if node.tag == "a" else node.links
        if node.tag in INLINE:
            above.direct += node.direct
        above.commas += node.commas
    for node in nodes[1:]:
        if node.junk:
            continue
        is_paragraph = node.tag in PARAGRAPHS or (node.tag in CONTAINERS and node.direct >= 25)
        length = node.direct if node.tag in CONTAINERS and node.tag not in PARAGRAPHS else node.size
        if not is_paragraph or length < 25:
            continue
        share = 1 + node.commas * length / max(1, node.size) + min(length // 100, 3)
        share *= 1 - node.links / max(1, node.size)
        node.scored = 2 * node.links < node.size
        if node.tag in CONTAINERS and node.tag not in PARAGRAPHS:
            node.points += share
        above, level = node.parent, 1
        while above > 0 and level <= 5:
            nodes[above].points += share / (level if level < 3 else 3 * (level - 1))
            above, level = nodes[above].parent, level + 1


#: What is text beside the main element, and what is a menu there if it holds links and little else.
SIBLINGS = frozenset("h1 h2 h3 h4 h5 h6 p section blockquote pre figure table dl ul ol".split())
MENUS = frozenset("ul ol dl div section table".split())


def _around_scored(nodes: list[_Node]) -> int:
    """The lowest element that holds all scored paragraphs."""
    held = [int(n.scored) for n in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        held[nodes[i].parent] += held[i]
    return max(i for i, n in enumerate(held) if n == held[0])


def main_text(html: str | None) -> str:
    """The page's main text, white space single, blocks joined by one space."""
    if not html:
        return ""
    nodes, events = _parse(html)
    _settle(nodes, events)
    _score(nodes, events)
    best, top = -1, 0.0
    for i, node in enumerate(nodes):
        if not node.junk and node.tag in CONTAINERS and node.size:
            points = node.points * (1 - node.links / node.size)
            if points > top:
                best, top = i, points
    roots: set[int] = set()
    if best < 0:
        # No paragraph earned a point: all that an article or main element holds, or else the page.
        mains = [i for i, n in enumerate(nodes) if n.tag in ("article", "main") and n.size and not n.junk]
        roots.add(mains[0] if mains else 0)
    else:
        i, inner = best, best
        while i > 0 and nodes[i].tag not in ("article", "main"):
            i = nodes[i].parent
        best = i if i > 0 else min(best, _around_scored(nodes))
        roots.add(best)
        for i, node in enumerate(nodes):
            if i == best or node.junk or not node.size or node.parent != nodes[best].parent:
                continue
            if node.tag in SIBLINGS and 2 * node.links < node.size and (i > best or node.tag != "p" or node.size > 80):
                roots.add(i)
    kept, deep = [False] * len(nodes), [False] * len(nodes)
    for i, node in enumerate(nodes):
        # Beside the element with most points, lists of links are menus.
        deep[i] = best < 0 or i == inner or (node.parent >= 0 and deep[node.parent])
        menu = not deep[i] and node.tag in MENUS and 5 * node.links > 4 * node.size
        kept[i] = i in roots or (node.parent >= 0 and kept[node.parent] and not node.junk and not menu)
    parts = [" " if text is None else unescape(text) for i, text in events if kept[i] or text is None]
    return " ".join("".join(parts).split())


def extract(pages: DataFrame) -> DataFrame:
    """Per page row: page_id, url, text, n_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # One page after another: no more than a batch of texts is held.
            texts = [main_text(batch.column(2)[i].as_py()) for i in range(batch.num_rows)]
            n = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), n], ["page_id", "url", "text", "n_chars"]
            )

    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return map_arrow(rows, run, f"page_id {kind}, url string, text string, n_chars long")

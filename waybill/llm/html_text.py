"""Main text of web pages by tree scoring.

A page is read into a tree of elements. Every paragraph gives points for its length and its
commas to its ancestors, fewer the further up they are; a container's points are discounted
by the share of its text that stands in links. The best container is the article, and
siblings that score near it, or are headings and paragraphs with hardly a link, belong to
it. Menus, footers, forms, scripts and the like never take part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of HTML elements and the words by which pages name their parts.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Never text, or never an article's.
DROPPED = set(
    "head script style noscript template iframe object svg math canvas audio video select option textarea button "
    "nav footer aside dialog menu".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: Elements whose text is a block of its own.
BLOCKS = HEADINGS | set(
    "p div section article main header body html ul ol li dl dt dd table caption thead tbody tfoot tr td th blockquote pre "
    "figure figcaption address details summary fieldset center hgroup search hr".split()
)
#: An open element of the set ends before a start tag of the name; it is looked for up to the nearest of its bounds.
ENDS = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
ARTICLE = {"article", "main"}
BARRED_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
BARRED = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner banners "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager header masthead topbar footer sidebar aside "
    "notice notices cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup login paywall "
    "comment comments commentlist disqus respond reply replies share sharing social related recommended recommendations "
    "widget widgets toolbar copyright legal disclaimer skip hidden".split()
)
#: A tag that the page ends in.
UNENDED = re.compile(r"<[A-Za-z/!?][^<>]*\Z")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

#: Characters of a paragraph below which it gives no points, and characters for each point, up to three.
LEAST_CHARS = 25
CHARS_A_POINT = 100
#: Share of the best score from which on a sibling is kept, and the most of a kept paragraph that may be links.
NEAR = 0.2
LINKED = 0.25


class Node:
    __slots__ = ("tag", "parent", "children", "barred", "names", "points", "chars", "linked")

    def __init__(self, tag: str, parent: Node | None, barred: bool = False, names: set[str] = frozenset()) -> None:
        self.tag, self.parent, self.barred, self.names = tag, parent, barred, names
        self.children: list[Node | str] = []
        self.points, self.chars, self.linked = 0.0, 0, 0


class _Tree(HTMLParser):
    """Elements and texts; unclosed and stray tags as browsers take them, as far as blocks are concerned."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", None)

    def _end_open(self, tags: set[str], bounds: set[str]) -> None:
        node = self.at
        while node.parent is not None and node.tag not in bounds:
            if node.tag in tags:
                self.at = node.parent
                return
            node = node.parent

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            # A block ends an open paragraph, with all that is open inside it.
            self._end_open({"p"}, BLOCKS - {"p"})
        if tag in HEADINGS:
            self._end_open(HEADINGS, BLOCKS - HEADINGS)
        if tag in ENDS:
            self._end_open(*ENDS[tag])
        named = dict(attrs)
        node = Node(tag, self.at, tag in DROPPED or _unseen(named), _barred_by_name(tag, named))
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # The slash means nothing but in elements without content.
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        inline = tag not in BLOCKS
        while node.parent is not None:
            if node.tag == tag:
                self.at = node.parent
                return
            # An inline element can't be ended from inside a block that it doesn't hold.
            if inline and node.tag in BLOCKS:
                return
            node = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def _unseen(named: dict[str, str | None]) -> bool:
    return (
        "hidden" in named
        or (named.get("aria-hidden") or "").lower() == "true"
        or (named.get("role") or "").lower() in BARRED_ROLES
        or bool(HIDDEN.search(named.get("style") or ""))
    )


def _barred_by_name(tag: str, named: dict[str, str | None]) -> set[str]:
    """Words of class and id that name a part that is no article. An article is barred by a whole name only."""
    if tag in ("html", "body"):
        return set()
    names = f"{named.get('class') or ''} {named.get('id') or ''}"
    words = names.lower().split() if tag in ARTICLE else (w.lower() for w in WORDS.findall(names))
    # A form is no text, but pages may stand in one as a whole.
    return BARRED.intersection(words) | ({tag} if tag in ("header", "form") else set())


def _ordered(root: Node) -> list[Node]:
    """All elements, parents first, without what is barred."""
    out, open_ = [], [root]
    while open_:
        node = open_.pop()
        out.append(node)
        open_.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.barred)
    return out


def _bar(root: Node) -> None:
    """Decide on elements barred by name, headers and forms: what holds the article is kept."""
    order = _ordered(root)
    holds: set[int] = set()
    for node in reversed(order):
        if node.tag in ARTICLE and not node.names:
            holds.add(id(node))
        if id(node) in holds and node.parent is not None:
            holds.add(id(node.parent))
    for node in order:
        if node.names and id(node) not in holds:
            node.barred = True
            # The heading of an article may stand in a header of its own; the rest of that is no text.
            if node.names == {"header"} and _inside(node, ARTICLE):
                node.barred, node.children = False, [n for n in _ordered(node) if n.tag in HEADINGS]


def _inside(node: Node, tags: set[str]) -> Node | None:
    """The nearest ancestor of one of the tags that isn't barred by name."""
    above = node.parent
    while above is not None and (above.tag not in tags or above.names):
        above = above.parent
    return above


def _scored(root: Node) -> list[Node]:
    """Fill in characters, linked characters and points; all elements, parents first."""
    order = _ordered(root)
    for node in reversed(order):
        own = sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        node.chars += own
        if node.tag == "a":
            node.linked = node.chars
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.linked += node.linked
    for node in order:
        text = _own_text(node) if node.tag in BLOCKS else ""
        if len(text) < LEAST_CHARS:
            continue
        points = 1.0 + text.count(",") + text.count("、") + text.count("，") + min(len(text) // CHARS_A_POINT, 3)
        points *= 1 - _density(node)
        above, share = node.parent, 1.0
        if node.tag not in ("p", "pre", "td", "blockquote"):
            node.points += points
        for level in range(1, 6):
            if above is None:
                break
            above.points += points * share
            share = 0.5 if level == 1 else share * level / (level + 1)
            above = above.parent
    return order


def _own_text(node: Node) -> str:
    """Text of an element outside the blocks in it."""
    parts, open_ = [], list(reversed(node.children))
    while open_:
        c = open_.pop()
        if isinstance(c, str):
            parts.append(c)
        elif not c.barred and c.tag not in BLOCKS:
            parts.append(" " if c.tag == "br" else "")
            open_.extend(reversed(c.children))
    return " ".join("".join(parts).split())


def _density(node: Node) -> float:
    return node.linked / node.chars if node.chars else 0.0


def _kept(root: Node) -> list[Node]:
    """The best container with the siblings that belong to it, in page order."""
    order = _scored(root)
    score = lambda n: n.points * (1 - _density(n))
    best = max((n for n in order if n.points > 0), key=score, default=None)
    marked = next((n for n in order if n.tag == "article" and not n.names and n.chars), None) or next((n for n in order if n.tag == "main" and n.chars), None)
    if best is None:
        # No paragraph is long enough to tell: the element that says it is the article, or all that is left.
        return [marked or root]
    # What a page marks as its article is wider than the part of it that scores best.
    if best.tag not in ARTICLE:
        wider = _inside(best, {"article"}) or _inside(best, {"main"})
        if wider is None and best.tag in ("html", "body") and marked is not None and 2 * marked.chars > best.chars:
            wider = marked
        best = wider or best
    elif best.tag == "main" and marked is not None and marked.tag == "article" and 2 * marked.chars > best.chars:
        best = marked
    if best.parent is None or best.tag in ("body", "html"):
        return [best]
    if best.tag in ARTICLE:
        same = [c for c in best.parent.children if isinstance(c, Node) and not c.barred]
        least = NEAR * score(best)
        return [c for c in same if c is best or (c.tag in ("p", "section", "div") and c.points > 0 and score(c) >= least and _density(c) < LINKED)]
    least = max(1.0, NEAR * score(best))
    out = []
    for c in best.parent.children:
        if not isinstance(c, Node) or c.barred:
            continue
        plain = c.tag in HEADINGS or (c.tag in ("p", "pre", "blockquote") and _density(c) < LINKED)
        if c is best or plain or (c.tag in BLOCKS and score(c) >= least and _density(c) < LINKED):
            out.append(c)
    return out


def _blocks(nodes: list[Node]) -> list[str]:
    """Texts of blocks in page order, white space as one blank; text between blocks is a block too."""
    out: list[str] = []
    parts: list[str] = []

    def end() -> None:
        if text := " ".join("".join(parts).split()):
            out.append(text)
        parts.clear()

    open_: list[Node | str | None] = list(reversed(nodes))
    while open_:
        c = open_.pop()
        if c is None:
            end()
        elif isinstance(c, str):
            parts.append(c)
        elif c.barred:
            continue
        elif c.tag == "br":
            parts.append(" ")
        elif c.tag in BLOCKS:
            end()
            open_.append(None)
            open_.extend(reversed(c.children))
        else:
            open_.extend(reversed(c.children))
    end()
    return out


def main_text(html: str | None) -> str:
    """Main text of a page; empty if there is none."""
    if not html:
        return ""
    tree = _Tree()
    tree.feed(UNENDED.sub("", html))
    tree.close()
    _bar(tree.root)
    return "\n\n".join(_blocks(_kept(tree.root)))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [main_text(html.as_py()) for html in b.column("html")]
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string())], [*b.schema.names[:-1], "text"])


def html_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars: the main text of every page, a row per row of ``pages``.

    A null or empty html, or one without text outside of menus and the like, gives an empty
    text; html that isn't well formed is read as far as it goes, to its end. Repeated rows
    stay, ids and urls are passed on as they are, null or not; other columns are ignored.
    Depth and length of a page have no limit: nothing recurses, and time grows with the
    length. Each page is on its own, so rows are never moved between tasks.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    found = rows.mapInArrow(_extracted, f"{kinds}, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))

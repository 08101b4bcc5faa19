"""The main text of a web page, by scores that paragraphs pass up the tree."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

from pyspark.sql import DataFrame

from quayside.llm.common import map_rows

# Elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
NEVER = frozenset(
    "head script style noscript template iframe object svg math canvas nav footer aside button select textarea "
    "input menu dialog title".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p pre td blockquote li dd".split())
CLOSES_P = BLOCK - frozenset(("br", "option"))
# An element of the key's kind ends an open one of these, unless an element of the last set is nearer.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
UNLIKELY = frozenset(
    "ad ads adv advert advertisement adverts advertising banner banners breadcrumb breadcrumbs comment comments "
    "commentlist consent cookie cookies disclaimer discussion disqus dropdown foot footer gdpr header login masthead "
    "menu menus modal nav navbar navigation newsletter notice notices outbrain overlay pager pagination popup promo "
    "promoted promotion reactions recommended related remark replies reply respond responses rss share sharing shoutbox sidebar signup "
    "skyscraper social sponsor sponsored sponsors subscribe subscription taboola tags toolbar tooltip widget widgets".split()
)
# Of these, words that a story may be about.
EVERYDAY = frozenset("discussion notice notices promotion reactions related remark reply responses share sharing social tags".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
WHOLE = 0.6  # share of the page's text outside links that shows a doubtful element to be the page itself
TINY = 80  # characters; a shorter result is tried again with doubtful elements
SENTENCE = 60  # characters of a text that may be a sentence and no label
LINKED = 0.33  # share of link text up to which a block beside the story is no menu
_ENDED = re.compile(r"[.!?:;…。！？]['\")\]»”’]*$")
_TOKEN = re.compile(r"[a-z]+")
_CUT_OFF = re.compile(r"<[a-zA-Z/!?]")


class Node:
    __slots__ = ("children", "doubt", "header", "parent", "score", "skip", "tag", "weak", "within")

    def __init__(self, tag: str, parent: Node | None, skip: bool = False):
        self.tag, self.parent, self.skip, self.score = tag, parent, skip, 0.0
        self.doubt = False  # its names, or that it is a form, say that it may be no content
        self.within = parent is not None and (parent.within or parent.tag in ("article", "main"))
        self.weak = False  # its names are everyday words inside an article
        self.header = tag == "header"
        self.children: list[Node | str] = []


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", None)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in CLOSES_P:
            self._end({"p"}, {"table", "article", "section", "div", "body", "button"})
        if tag in IMPLIED:
            self._end(*IMPLIED[tag])
        node = Node(tag, self.at, tag in NEVER)
        self._judge(node, dict(attrs))
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag not in VOID:
            self._end({tag}, set())

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """Sections as ``<![if x]>`` are comments to a browser; none is worth an error."""
        return self.parse_bogus_comment(i)

    def _end(self, tags: set, stop: set) -> None:
        node = self.at
        while node.parent is not None:
            if node.tag in tags:
                self.at = node.parent
                return
            if node.tag in stop:
                return
            node = node.parent

    def _judge(self, node: Node, given: dict) -> None:
        """What the element's attributes say about it; nothing for whole pages or articles."""
        if node.tag in ("html", "body", "article", "main"):
            return
        node.skip |= "hidden" in given or (given.get("role") or "").lower() in ROLES
        names = f"{given.get('class') or ''} {given.get('id') or ''}".lower()
        telling = UNLIKELY.intersection(_TOKEN.findall(names)) if names.strip() else ()
        if node.within and telling == {"header"}:
            node.header = True  # the head of an article, whatever its tag
        elif telling or node.tag == "form":
            node.doubt = True
            # Inside an article an everyday word is a weak sign: what it names is judged by its text.
            node.weak = node.within and node.tag != "form" and telling <= EVERYDAY


def parse(page: str) -> Node:
    builder = _Builder()
    builder.feed(page)
    # A tag or comment that the page's end cuts off is markup, not text.
    if not _CUT_OFF.match(builder.rawdata):
        builder.close()
    return builder.root


def settle(root: Node) -> bool:
    """Skip the doubtful elements that are no content, and tell whether there are any.

    One that holds the page's only articles, or most of the text outside links of a page without
    other articles, is the page's frame and stays; what is doubtful inside it is judged by itself.
    """
    order, stack = [], [(root, False, False)]
    while stack:
        x, linked, doubted = stack.pop()
        linked, doubted = linked or x.tag == "a", doubted or x.doubt
        order.append((x, linked, doubted))
        if not x.skip:
            stack += [(c, linked, doubted) for c in x.children if isinstance(c, Node)]
    if not any(x.doubt for x, _, _ in order):
        return False
    plain = any(x.tag in ("article", "main") and not doubted for x, _, doubted in order)
    size: dict[int, tuple[int, bool]] = {}
    for x, linked, _ in reversed(order):
        total, holds = 0, x.tag in ("article", "main") and not x.skip
        for c in () if x.skip else x.children:
            if isinstance(c, Node):
                total, holds = total + size[id(c)][0], holds or size[id(c)][1]
            elif not linked:
                total += len("".join(c.split()))
        size[id(x)] = total, holds
    page, dropped = size[id(root)][0], False
    for x, _, _ in order:
        total, holds = size[id(x)]
        if x.weak and not x.skip and tells(x):
            continue
        if x.doubt and not x.skip and not (holds and not plain) and not (page and total >= WHOLE * page and not plain):
            x.skip = dropped = True
    return dropped


def tells(node: Node) -> bool:
    """Whether an element has a paragraph of whole sentences, few of whose words are links."""
    stack = [node]
    while stack:
        x = stack.pop()
        if x.tag == "p" and is_sentence(text_of(x)) and link_density(x) < LINKED:
            return True
        stack += [c for c in x.children if isinstance(c, Node) and not c.skip]
    return False


def is_sentence(text: str) -> bool:
    return len(text) >= SENTENCE and bool(_ENDED.search(text))


def link_density(node: Node) -> float:
    return link_densities(node)[id(node)]


def visible(node: Node) -> Iterator[Node]:
    """Elements in page order, without those that are no content; no recursion, pages may be deep."""
    stack = [(node, False)]
    while stack:
        x, inside = stack.pop()
        inside = inside or x.tag in ("article", "main")
        if x.skip or (x.header and not inside):
            continue
        yield x
        stack += [(c, inside) for c in reversed(x.children) if isinstance(c, Node)]


def pieces(node: Node) -> Iterator[str]:
    """Strings of an element in page order, with a space wherever a block begins or ends."""
    stack: list = [(node, False, False)]
    while stack:
        x, inside, header = stack.pop()
        if isinstance(x, str):
            if not header:
                yield x
            continue
        inside = inside or x.tag in ("article", "main")
        if x.skip or (x.header and not inside):
            continue
        if x.header:
            header = True  # of a header within an article only the headings are text
        elif x.tag in HEADINGS or (header and x.tag == "p" and is_lead(x)):
            header = False
        edge = x.tag in BLOCK
        if edge:
            yield " "
            stack.append((" ", inside, False))
        stack += [(c, inside, header) for c in reversed(x.children)]


def is_lead(node: Node) -> bool:
    """A paragraph of a header that is a sentence and not a line about the author or the date."""
    return is_sentence(own_text(node)) and link_density(node) < LINKED


def text_of(node: Node) -> str:
    return " ".join("".join(pieces(node)).split())


def own_text(node: Node) -> str:
    """Text outside blocks within the element."""
    parts, stack = [], list(reversed(node.children))
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            parts.append(x)
        elif not x.skip and (x.tag not in BLOCK or x.tag == "br"):
            parts.append(" " if x.tag == "br" else "")
            stack += list(reversed(x.children))
    return " ".join("".join(parts).split())


def points(text: str) -> float:
    """One for being there, one per comma, one per hundred characters up to three."""
    return 1 + text.count(",") + min(len(text) / 100, 3)


def link_densities(root: Node) -> dict[int, float]:
    """Share of link text in the text of every element, spaces aside; one pass from the leaves up."""
    order, stack = [], [(root, False)]
    while stack:
        x, linked = stack.pop()
        linked = linked or x.tag == "a"
        order.append((x, linked))
        if not x.skip:
            stack += [(c, linked) for c in x.children if isinstance(c, Node)]
    size: dict[int, tuple[int, int]] = {}
    for x, linked in reversed(order):
        total = links = 0
        for c in () if x.skip else x.children:
            if isinstance(c, Node):
                n, of_links = size[id(c)]
            else:
                n = len("".join(c.split()))
                of_links = n if linked else 0
            total, links = total + n, links + of_links
        size[id(x)] = total, links
    return {k: links / total if total else 0.0 for k, (total, links) in size.items()}


def extract(page: str | None) -> str:
    """The main text of one page.

    Paragraphs give their points to the parent, half of them to the next ancestor and a third per
    level beyond; scores are discounted by the share of link text. The best container is kept
    with those of its siblings that score a fifth of it, or that are paragraphs of low link
    density, and with what stands between and beside those and is no menu (:func:`_walked`). An
    ``article`` or ``main`` element is the container itself, and only sections and articles are its
    siblings, but for lists of replies. Equal scores: the first element in page order. A page without
    paragraphs gives the text of its body. Forms, and elements whose names say that they are no
    content, are left out unless they frame the page (:func:`settle`), or are named by an everyday
    word inside an article and hold sentences; a page without an article that then has hardly any
    text, or one without any text, is tried again with them.
    """
    if not page or not page.strip():
        return ""
    root = parse(page)
    dropped = settle(root)
    text = main_text(root)
    short = not text or (len(text) < TINY and not any(x.tag in ("article", "main") for x in visible(root)))
    if dropped and short:
        text = max(text, main_text(parse(page)), key=len)
    return text


def main_text(root: Node) -> str:
    """The text of the best container of a parsed page."""
    scored: dict[int, Node] = {}
    for node in visible(root):
        text = own_text(node) if node.tag in PARAGRAPHS or node.tag in ("div", "section", "article", "main") else ""
        if not text:
            continue
        worth = points(text)
        up = node.parent if node.tag in PARAGRAPHS else node
        level = 1
        while up is not None and up.parent is not None and level <= 5:
            up.score += worth / (level if level < 3 else 3 * (level - 1))
            scored[id(up)] = up
            up, level = up.parent, level + 1
    if not scored:
        return text_of(root)
    density = link_densities(root)
    final = {k: n.score * (1 - density[k]) for k, n in scored.items()}
    top = scored[max(final, key=final.get)]
    up = top
    while up is not None and up.tag not in ("article", "main"):
        up = up.parent
    whole = up is not None
    top = up or top  # an element that the page itself calls its article is the container
    best = final.get(id(top), 0.0)
    beside = top.parent.children

    def scores(node: Node) -> bool:
        same = node is top or final.get(id(node), 0.0) >= max(10.0, best / 5)
        if not same and node.tag == "p":
            text = text_of(node)
            same = len(text) > 80 and density[id(node)] < 0.25
        return same

    if whole:
        kept = [
            x for x in beside
            if x is top or (isinstance(x, Node) and not x.skip and x.tag in ("article", "section") and scores(x)
                            and not _thread(x, top))
        ]
        return " ".join(t for x in kept if (t := text_of(x) if not x.header else ""))
    return _walked(beside, [isinstance(x, Node) and not x.skip and scores(x) for x in beside], density)


def _thread(node: Node, story: Node) -> bool:
    """Whether a section is a list of replies or of other stories: several articles, each less than the story."""
    held, stack = [], [node]
    while stack:
        x = stack.pop()
        if x.tag == "article" and x is not node:
            held.append(len(text_of(x)))
        else:
            stack += [c for c in x.children if isinstance(c, Node) and not c.skip]
    return len(held) > 1 and max(held) < len(text_of(story))


def _walked(beside: list, kept: list[bool], density: dict[int, float]) -> str:
    """The kept elements and what belongs to them, in page order.

    Between kept elements everything stays that is no menu: headings, lists, short paragraphs and bare
    text. Before the first one its headings and what is said in sentences stay, and after the last one
    what is said in sentences.
    """
    first, last = kept.index(True), len(kept) - 1 - kept[::-1].index(True)
    out: list[str] = []
    bare: list[str] = []

    def flush(inside: bool) -> None:
        text = " ".join("".join(bare).split())
        bare.clear()
        if text and (inside or _ENDED.search(text)):
            out.append(text)

    for i, x in enumerate(beside):
        inside = first < i < last
        if isinstance(x, str):
            bare.append(x)
            continue
        if x.tag not in BLOCK and not x.skip and x.tag not in NEVER:
            bare.append("".join(pieces(x)))
            continue
        flush(inside or (first < i <= last))
        if x.skip or x.header:
            continue
        text = text_of(x)
        if kept[i]:
            out.append(text)
        elif not text or density[id(x)] > LINKED:
            continue
        elif inside or (i < first and x.tag in HEADINGS) or _ENDED.search(text) or (i > first and _listed(x)):
            out.append(text)
    flush(False)
    return " ".join(t for t in out if t)


def _listed(node: Node) -> bool:
    """A list of the story, which need not end like a sentence: it has no links."""
    return node.tag in ("ul", "ol", "dl", "table") and link_density(node) == 0.0


def main_texts(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Main text of every page: ``page_id, url, text, n_chars``.

    A NULL or empty page, and one without any content, gives an empty text. Markup may be
    unclosed, cut off or absent. Other columns are not read; repeated rows each get a row.
    """

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        for k, u, h in rows:
            text = extract(h)
            yield k, u, text, len(text)

    kinds = {c: pages.schema[c].dataType.simpleString() for c in (key, url)}
    schema = f"`{key}` {kinds[key]}, `{url}` {kinds[url]}, text string, n_chars bigint"
    return map_rows(pages.select(key, url, html), work, schema)

"""Main text of web pages by composite text density (operator 2).

A page is read into a light tree (tolerant of unclosed tags).  Subtrees whose element, role, class
or id says menu, header, footer, sidebar, notice, advert, form, script, style or reader comments are
cut out first; where a name only may say so (``related-work``, ``search-results``) and the block lies in an
article, its density against the article's decides.  Every remaining node gets its composite density: characters per tag, adjusted by the
share of link characters and link tags; a node's density sum is the sum over its children.  The
subtree with the largest density sum is the article's core; the smallest density on the path from
it to the body is the threshold a node must reach for the largest-sum subtree below it to count as
content too.  Where the core lies in an ``article`` or ``main`` element, the content is that element,
whatever the threshold says; elsewhere it is the common container of the subtrees that count, widened
while its parent holds headings, paragraphs or lists of its own, with all blocks in it but links beside
the first and last subtree that counts: nothing of an article is lost because a block is short.

Text: character references decoded, white space inside a block becomes one space, blocks are joined
in page order by one line feed.

Defined cases: null, empty or tagless html (its text is the one block); markup without text gives an
empty text; pages are processed whole, in time linear in their tags however deep these nest; repeated rows are extracted
each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAG = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z))", re.S
)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/]|\Z)", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea iframe noembed noframes xmp".split())
RAW_END = {t: re.compile(rf"</{t}[^>]*(?:>|\Z)", re.I | re.A) for t in RAW}
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split()
)
CUT = set("head nav footer aside form script style title noscript template iframe object embed button select textarea dialog menu".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
COMMENTS = set("comment comments commentlist commentary disqus respond reply replies discussion".split())
MARKS = COMMENTS | set(
    "ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored promo promotion sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr notice notification banner popup modal overlay newsletter subscribe "
    "subscription signup social share sharing related recommended widget toolbar pagination pager login search hidden".split()
)
# marks that other words make a name of something else: inside an article the density decides on such a block
DOUBTFUL = set("related recommended search share sharing social hidden login subscription navigation menu modal overlay toolbar".split())
# fixed values: a block so named is text from this share of the article's characters per tag, below that share of links
DENSE, LINKED = 0.5, 0.2
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
PROSE = HEADINGS | {"p", "pre", "blockquote"}
# fixed value: from this share of its characters in links, a block is links (the rest: bars and dots between them)
LINKS = 0.8
RESULT = "page_id long, url string, text string, n_chars long"


class Node:
    __slots__ = (
        "tag", "parent", "children", "marks", "cut", "doubt", "block", "inside", "chars", "tags", "links", "link_tags", "density", "total"
    )

    def __init__(self, tag: str, parent: Node | None, marks: frozenset = frozenset(), cut: bool = False, doubt: bool = False):
        self.tag, self.parent, self.marks, self.cut, self.doubt = tag, parent, marks, cut, doubt
        self.children: list[Node | str] = []
        #: the nearest element around that is not inline, itself included
        self.block: Node = parent.block if parent and tag in INLINE else self


def attributes(text: str) -> tuple[frozenset, bool, bool]:
    """Marks of class and id, whether the element is hidden or has a cut role, and whether its marks are doubtful."""
    marks, cut, doubt = set(), False, True
    for m in ATTRIBUTE.finditer(text):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id"):
            for part in value.split():
                words = {w.lower() for w in WORD.findall(part)}
                marks |= words & MARKS
                doubt &= not words & MARKS or words & MARKS <= DOUBTFUL and not words <= MARKS
        elif name == "role":
            cut |= value.lower() in ROLES
        elif name == "hidden":
            cut = True
        elif name == "aria-hidden":
            cut |= value.lower() == "true"
        else:
            cut |= "display:none" in value.replace(" ", "").lower()
    return frozenset(marks), cut, doubt and bool(marks)


class Path:
    """The open elements.  Counts of them tell whether an end tag closes any without climbing; an inline
    end closes none beyond the block it stands in, so inline elements are counted per open block."""

    def __init__(self, root: Node):
        self.node = root
        self.open: Counter[str] = Counter()
        self.inline: list[Counter[str]] = [Counter()]

    def push(self, new: Node) -> None:
        self.node = new
        if new.tag in INLINE:
            self.inline[-1][new.tag] += 1
        else:
            self.open[new.tag] += 1
            self.inline.append(Counter())

    def pop(self) -> Node:
        node = self.node
        if node.tag in INLINE:
            self.inline[-1][node.tag] -= 1
        else:
            self.open[node.tag] -= 1
            self.inline.pop()
        self.node = node.parent
        return node

    def end(self, tag: str) -> None:
        if (self.inline[-1] if tag in INLINE else self.open)[tag]:
            while self.pop().tag != tag:
                pass


def parse(page: str) -> Node:
    """The page's tree.  A block's start closes an open paragraph; an end tag closes down to its
    start, and is ignored if none is open."""
    root = Node("#page", None)
    path = Path(root)
    end = 0
    while m := TAG.search(page, end):
        if m.start() > end:
            path.node.children.append(page[end : m.start()])
        end = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            path.end(tag)
            continue
        if tag not in INLINE and tag not in VOID:
            at = path.node.block
            if at.tag == "p" or at.tag == tag and tag in ("li", "option", "tr", "td", "th", "dt", "dd"):
                while path.pop() is not at:
                    pass
        named = attributes(m[3]) if m[3] and not m[3].isspace() else ()
        new = Node(tag, path.node, *named)
        path.node.children.append(new)
        if tag in RAW:
            close = RAW_END[tag].search(page, end)
            end = close.end() if close else len(page)
        elif tag not in VOID and not m[3].endswith("/"):
            path.push(new)
    if end < len(page):
        path.node.children.append(page[end:])
    return root


def walk(root: Node) -> list[Node]:
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return out


def prune(root: Node) -> list[Node]:
    """Cut out what its element, role, class or id names as something other than the article; the
    blocks inside an article whose name is doubtful stay and are returned, in page order."""
    nodes = walk(root)
    scope = set()  # what holds an article
    for n in reversed(nodes):
        if n.parent is not None and (n.tag in ("article", "main") or id(n) in scope):
            scope.add(id(n.parent))
    gone, doubtful = set(), []
    for n in nodes:
        above = n.parent
        n.inside = None if above is None else above if above.tag in ("article", "main") else above.inside
        if above is not None and id(above) in gone:
            gone.add(id(n))
        if above is None or id(n) in gone or n.tag in ("html", "body", "main"):
            continue
        inside = n.inside is not None
        drop = n.tag in CUT or n.cut
        drop |= bool(n.marks & COMMENTS) and (n.tag != "article" or inside)
        marked = bool(n.marks) and id(n) not in scope and n.tag not in ("article", *HEADINGS) and not (n.marks == {"header"} and inside)
        drop |= marked and not (n.doubt and inside)
        if n.tag == "header" or n.marks == {"header"}:
            if inside:
                gone |= {id(c) for c in n.children if isinstance(c, Node) and c.tag not in HEADINGS}
                n.children = [c for c in n.children if isinstance(c, Node)]
            else:
                drop |= id(n) not in scope
        if drop:
            gone.add(id(n))
        elif marked:
            doubtful.append(n)
    for n in nodes:
        n.children = [c for c in n.children if isinstance(c, str) or id(c) not in gone]
    return [n for n in doubtful if id(n) not in gone]


def settle(root: Node, doubtful: list[Node]) -> None:
    """Cut the doubtful blocks that are sparse beside the rest of their article, or mostly links."""
    densities(root)
    marked, rest = {id(n) for n in doubtful}, {}
    within = set()  # blocks in a doubtful block of the same article
    for n in walk(root):
        above = n.parent
        if above is not None and (id(above) in within or id(above) in marked) and n.tag not in ("article", "main"):
            within.add(id(n))
    for n in doubtful:
        chars, tags = rest.get(id(n.inside), (n.inside.chars, n.inside.tags))
        rest[id(n.inside)] = (chars, tags) if id(n) in within else (chars - n.chars, tags - n.tags - 1)
    gone = set()
    for n in doubtful:
        chars, tags = rest[id(n.inside)]
        if n.links > LINKED * n.chars or n.chars / max(n.tags, 1) < DENSE * chars / max(tags, 1):
            gone.add(id(n))
    for above in {id(n.parent): n.parent for n in doubtful if id(n) in gone}.values():
        above.children = [c for c in above.children if isinstance(c, str) or id(c) not in gone]


def ancestors(node: Node) -> Iterator[Node]:
    while node := node.parent:
        yield node


def densities(root: Node) -> list[Node]:
    """Composite density and density sum of every node below the body."""
    nodes = walk(root)
    for n in reversed(nodes):
        text = "".join(c for c in n.children if isinstance(c, str))
        n.chars, n.tags, n.links, n.link_tags = len("".join(text.split())), 0, 0, 0
        for c in n.children:
            if isinstance(c, Node):
                n.chars, n.tags = n.chars + c.chars, n.tags + c.tags + 1
                n.links, n.link_tags = n.links + c.links, n.link_tags + c.link_tags + (c.tag == "a")
        if n.tag == "a":
            n.links = n.chars
    share = root.links / max(root.chars, 1)
    for n in reversed(nodes):
        tags, link_tags, links = max(n.tags, 1), max(n.link_tags, 1), max(n.links, 1)
        base = math.log(n.chars / max(n.chars - n.links, 1) * n.links + share * n.chars + math.e)
        ratio = max(n.chars / links * tags / link_tags, 1.0)
        n.density = n.chars / tags * (math.log(ratio) / math.log(max(base, 1.0001)) if n.links else 1.0) if n.chars else 0.0
        n.total = sum(c.density for c in n.children if isinstance(c, Node)) or n.density
    return nodes


def content(root: Node) -> list[Node]:
    """The nodes whose subtrees are the article, in page order."""
    if doubtful := prune(root):
        settle(root, doubtful)
    body = next((n for n in walk(root) if n.tag == "body"), root)
    nodes = densities(body)
    core = max(nodes, key=lambda n: n.total)
    if scope := next((a for a in [core, *ancestors(core)] if a.tag in ("article", "main")), None):
        return [scope]
    threshold = min(a.density for a in [core, *ancestors(core)] if hasattr(a, "density"))
    best = {}  # the largest-sum node of each subtree
    for n in reversed(nodes):
        best[id(n)] = max([n, *[best[id(c)] for c in n.children if isinstance(c, Node)]], key=lambda x: x.total)
    chosen = {id(best[id(n)]) for n in nodes if n.density >= threshold and n.chars}
    tops, below = [], set()  # the chosen nodes that lie in no other chosen one
    for n in nodes:
        if n is not body and (id(n.parent) in below or id(n.parent) in chosen):
            below.add(id(n))
        elif id(n) in chosen:
            tops.append(n)
    return [container(tops)] if tops else [body]


def container(tops: list[Node]) -> Node:
    """The element of an article whose dense subtrees are ``tops``, without the links around them."""
    # in page order, what holds the first and the last of them holds all
    held = {id(a) for a in (tops[0], *ancestors(tops[0]))}
    node = next(a for a in (tops[-1], *ancestors(tops[-1])) if id(a) in held)
    while hasattr(node.parent, "density") and any(c is not node and prose(c) for c in node.parent.children):
        node = node.parent
    if node in tops:
        return node
    above: set[int] = set()
    for n in tops:
        while n is not None and id(n) not in above:
            above.add(id(n))
            n = n.parent
    dense = [k for k, c in enumerate(node.children) if id(c) in above]
    node.children = [c for k, c in enumerate(node.children) if dense[0] <= k <= dense[-1] or not links(c)]
    return node


def links(n: Node | str) -> bool:
    return isinstance(n, Node) and n.tag not in PROSE and n.chars > 0 and n.links >= LINKS * n.chars


def prose(n: Node | str) -> bool:
    """A heading, paragraph or list, or an element around headings only."""
    if isinstance(n, str) or not n.chars or n.links >= LINKS * n.chars and n.tag not in HEADINGS:
        return False
    return n.tag in PROSE or n.tag in ("ul", "ol", "dl") or sum(h.chars for h in walk(n) if h.tag in HEADINGS) == n.chars


def blocks(nodes: list[Node]) -> str:
    out: list[list[str]] = [[]]
    todo: list[Node | str | None] = []
    for n in reversed(nodes):
        todo += [None, n, None]
    while todo:
        n = todo.pop()
        if n is None:
            if out[-1]:
                out.append([])
        elif isinstance(n, str):
            out[-1].append(n)
        elif n.tag == "br":
            out[-1].append(" ")
        else:
            edge = [] if n.tag in INLINE else [None]
            todo += [*edge, *reversed(n.children), *edge]
    texts = (" ".join(references.unescape("".join(b)).split()) for b in out)
    return "\n".join(t for t in texts if t)


def main_text(page: str | None) -> str:
    return blocks(content(parse(page))) if page else ""


def extract(pages: DataFrame, html: str = "html", page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, url, text, n_chars`` per page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h.as_py()) for h in b.column(2)]
            arrays = [b.column(0), b.column(1), pa.array(texts, type=pa.string()), pa.array([len(t) for t in texts], type=pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(page_id).cast("long"), F.col(url).cast("string"), F.col(html).cast("string")).mapInArrow(run, RESULT)

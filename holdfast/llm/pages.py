"""Main text of web pages: flat blocks, their neighbours' features, and a trained decision tree.

A page is cut into blocks at block-level tags. Each block has its number of words, its link density (share of words
inside links), those of the blocks before and after it, and where it stands (inside an article, outside one on a page that has one,
inside a menu, form or the like, in an element whose class or id names such a thing, in a heading, paragraph or list item).
A decision tree trained by Spark ML on the labelled pages below tells text from the rest. The tree is a handful of splits
and travels with the task; pages are independent, so nothing is shuffled. Cutting takes time linear in the page.

Defined cases: NULL or empty html gives empty text; unclosed tags end with what contains them, paragraphs, headings, list items and
table cells with the next of their kind; unfinished comments, scripts and styles reach to the end of the page; elements marked as
hidden give no text; an element named like furniture that is never closed doesn't swallow an article after it; anything else that
is no tag is text; repeated rows give one row each.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Elements by their role in HTML.
RAW = frozenset("script style textarea iframe title".split())  # without an end they reach to the end of the page
SILENT = RAW | frozenset("noscript template svg object canvas audio video select annotation".split())
FURNITURE = frozenset("nav header footer aside form menu dialog button fieldset".split())
BODY = frozenset("article main".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr math mfrac mi mn mo mrow msqrt mstyle msub msubsup msup mtext semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
PARAGRAPHS = frozenset("p pre blockquote dd figcaption".split())
#: What ends by itself when another of its kind begins, and the elements that hide an earlier one.
SIBLINGS = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "td": (("td", "th"), ("table",)), "th": (("td", "th"), ("table",)), "tr": (("tr",), ("table",)),
    "tbody": (("thead", "tbody"), ("table",)), "tfoot": (("thead", "tbody"), ("table",)),
}
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
#: Words that name furniture, alone or beside the second list's words, and those of reader comments.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies copyright disclaimer "
    "disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice pagination pager popup promo promotion related "
    "reply replies share sharing sidebar social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
BESIDE = frozenset(
    "site page global top bottom left right main primary secondary box list wrapper wrap container section block button buttons link "
    "links bar area form signup item items content post posts article articles entry story stories user reader tools consent legal text "
    "media policy body inner outer row col column sticky mobile desktop slot unit thread level".split()
)
COMMENTS = frozenset("comment comments disqus reply replies".split())
OPENINGS = frozenset("article post entry page story main".split())  # of which a header is part of the text
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>|<[!?][^>]*+>", re.S
)
PLAIN_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>[^>]*+)>|<[!?][^>]*+>", re.S)
ATTR = re.compile(r"([^\s\"'>/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?+")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
HEADING = re.compile(r"h[1-6]$")


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    inside: bool  # in an article or main element
    elsewhere: bool  # outside them, on a page that has one
    furniture: bool  # in a menu, form, footer ...
    hinted: bool  # in an element named like one
    kind: str  # heading, paragraph, item or ""


class _Place(NamedTuple):
    """What holds inside an open element."""

    name: str
    number: int
    inside: bool = False
    furniture: bool = False
    hinted: bool = False
    unseen: bool = False
    swallowed: int = -1  # the chain of hints and forms around the article that this stands in


FEATURES = (
    "words", "density", "words_before", "density_before", "words_after", "density_after", "inside", "elsewhere", "furniture", "hinted",
    "heading", "paragraph", "item",
)


def hints(told: str) -> tuple[bool, bool]:
    """Whether one of the class names or ids, read as a whole, names furniture, and whether reader comments."""
    furniture = comments = False
    for token in told.split():
        parts = {x.lower() for x in PART.findall(token)}
        if parts & NAMES and parts <= NAMES | BESIDE and not (parts & {"header", "masthead"} and parts & OPENINGS):
            furniture = True
            comments |= bool(parts & COMMENTS)
    return furniture, comments


def _attrs(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in ATTR.finditer(text):
        out.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return out


class _Cutter:
    """Open elements by position and by name, so that each tag costs what it opens and closes."""

    def __init__(self) -> None:
        self.open = [_Place("", 0)]
        self.at: dict[str, list[int]] = {}  # name -> positions in open
        self.closed = [False]  # by element number: met its own end tag
        self.chains: list[tuple[int, int, bool]] = []  # (number of the element, the chain around it, whether it is a form)
        self.hint_chain = [-1]  # by position: the chain of hints and forms that the next article stands in
        self.found: list[tuple[Block, int]] = []

    def push(self, name: str, attrs: dict[str, str]) -> None:
        top, number = self.open[-1], len(self.closed)
        role = attrs.get("role", "").lower()
        body = name in BODY or role in BODY
        hint, comments = hints(attrs.get("class", "") + " " + attrs.get("id", "")) if name not in ("html", "body") else (False, False)
        own = (name in FURNITURE and not (name == "header" and top.inside)) or role in ROLES or comments
        unseen = name not in ("html", "body") and (
            "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or bool(UNSEEN.search(attrs.get("style", "")))
        )
        chain = self.hint_chain[-1]
        if (hint and not own) or name == "form":  # what an article may have been swallowed by
            self.chains.append((number, chain, not hint))
            chain = len(self.chains) - 1
        held = own and name != "form"
        if body and not top.furniture and not held:
            place = _Place(name, number, True, False, hint, top.unseen or unseen, self.hint_chain[-1])
        else:
            place = _Place(name, number, top.inside, top.furniture or held, top.hinted or hint or name == "form", top.unseen or unseen, top.swallowed)
        self.closed.append(False)
        self.at.setdefault(name, []).append(len(self.open))
        self.open.append(place)
        self.hint_chain.append(chain)

    def last(self, *names: str) -> int:
        return max((self.at[x][-1] for x in names if self.at.get(x)), default=0)

    def cut(self, to: int) -> None:
        """Closes everything from a position on."""
        while len(self.open) > to:
            self.at[self.open.pop().name].pop()
            self.hint_chain.pop()

    def implied(self, name: str) -> None:
        if (p := self.last("p", "h1", "h2", "h3", "h4", "h5", "h6")):
            self.cut(p)
        if name in SIBLINGS:
            ends, scope = SIBLINGS[name]
            if (i := self.last(*ends)) > self.last(*scope):
                self.cut(i)

    def end(self, name: str) -> None:
        if (i := self.last(name)):
            self.closed[self.open[i].number] = True
            self.cut(i)

    def block(self, parts: list[str], linked: int) -> None:
        place = self.open[-1]
        text = " ".join(entities.unescape("".join(parts)).split()) if parts else ""
        if text:
            n = text.count(" ") + 1
            kind = "heading" if HEADING.match(place.name) else "paragraph" if place.name in PARAGRAPHS else "item" if self.last("li") > self.last("ul", "ol", "menu", "article", "main", "td") else ""
            self.found.append((Block(text, n, min(n, linked), place.inside, False, place.furniture, place.hinted, kind), place.swallowed))

    def blocks(self) -> list[Block]:
        """Blocks, with what is known at the end of the page: hints that were closed count for the article within them."""
        counts: list[bool] = []
        for number, around, form in self.chains:  # a form around an article is the page's own
            counts.append((self.closed[number] and not form) or (around >= 0 and counts[around]))
        held = [c >= 0 and counts[c] for _, c in self.found]
        clean = [b.inside and not b.furniture and not b.hinted for b, _ in self.found]
        if not any(x and not h for x, h in zip(clean, held, strict=True)):  # never give up the only article of a page
            held = [False] * len(held)
        has = any(x and not h for x, h in zip(clean, held, strict=True))
        return [b._replace(hinted=b.hinted or h, elsewhere=has and not b.inside) for (b, _), h in zip(self.found, held, strict=True)]


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in their order."""
    cutter, parts = _Cutter(), []
    linked = links = 0
    tag, endless = TAG, set()  # names without an end tag in the rest of the page

    at, n, last = 0, len(page), page.rfind(">")
    while at < n:
        start = page.find("<", at)
        m = tag.match(page, start) if start >= 0 else None
        while start >= 0 and not m:
            if tag is TAG and re.match(r"</?[a-zA-Z]|<[!?]", page[start : start + 3]):
                tag = PLAIN_TAG  # a quote that is never closed: from here on tags end at the next bracket
            elif start > last:
                start = -1
                break
            else:
                start = page.find("<", start + 1)
            m = tag.match(page, start) if start >= 0 else None
        piece = page[at : start if m else n]
        if piece and not cutter.open[-1].unseen:
            parts.append(piece)
            linked += len(piece.split()) if links else 0
        if not m:
            break
        at = m.end()
        if not m["name"]:
            continue
        name, ends = m["name"].lower(), bool(m["end"])
        if name in SILENT:
            if not ends and name not in endless and not m["attrs"].endswith("/"):
                stop = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                if stop:
                    at = stop.end()
                elif name in RAW:
                    break
                else:
                    endless.add(name)
            parts.append(" ")
            continue
        attrs = {} if ends else _attrs(m["attrs"])
        if name in INLINE:
            if name == "a":
                links = max(0, links + (-1 if ends else 1))
            elif name == "br":
                parts.append(" ")
            if ends:
                if cutter.open[-1].name == name:  # only unseen ones are kept open
                    cutter.end(name)
            elif name not in VOID and (cutter.open[-1].unseen or "hidden" in attrs or UNSEEN.search(attrs.get("style", ""))):
                cutter.push(name, attrs)
            continue
        cutter.block(parts, linked)
        parts.clear()
        linked = links = 0
        if ends:
            cutter.end(name)
        elif name not in VOID:
            cutter.implied(name)
            cutter.push(name, attrs)
    cutter.block(parts, linked)
    return cutter.blocks()


def features(found: list[Block]) -> list[tuple[float, ...]]:
    """FEATURES of each block; a neighbour that isn't there has 0 words."""
    size = [(float(b.words), b.linked / b.words) for b in found]
    edge = (0.0, 0.0)
    return [
        (
            *size[i], *(size[i - 1] if i else edge), *(size[i + 1] if i + 1 < len(size) else edge),
            *map(float, (b.inside, b.elsewhere, b.furniture, b.hinted, b.kind == "heading", b.kind == "paragraph", b.kind == "item")),
        )
        for i, b in enumerate(found)
    ]


def _said(n: int) -> str:
    """n words of plain prose."""
    return " ".join(("the river rose in the night and by morning the lower road lay under water so school would not open".split() * (n // 20 + 1))[:n])


def _linked(n: int) -> str:
    return f"<a href='/x'>{_said(n)}</a>"


def labelled_pages(n: int = 1600, seed: int = 1) -> list[tuple[str, str]]:
    """Labelled table: n pages, with 1 for each block that belongs to the main text.

    Pages are drawn from layouts: with an article or main element or without, furniture in elements meant for it, in named ones or in
    bare ones, paragraphs of 1 to 90 words with and without links, lists, headings, asides within the text, pages of a single block.
    """
    draw = random.Random(seed)
    size = lambda: draw.choice((1, 2, 3, 5, 8, 13, 20, 32, 45, 60, 90))
    some = lambda kinds, k: [draw.choice(kinds)() for _ in range(k)]
    item = lambda: draw.randint(1, 4)

    label = lambda: draw.choice((1, 2, 3, 4, 7, 14, 25))
    menu = lambda: [(f"<li>{_linked(label())}</li>", "0") for _ in range(draw.randint(2, 6))]
    furniture = (
        lambda: [("<nav><ul>", ""), *menu(), ("</ul></nav>", "")],
        lambda: [(f"<div class='{draw.choice(('ad', 'cookie-notice', 'sidebar', 'share', 'newsletter'))}'><p>{_said(size())}</p></div>", "0")],
        lambda: [(f"<{x}><p>{_said(size())}</p></{x}>", "0") for x in (draw.choice(("aside", "footer", "form", "nav")),)],
        lambda: [(f"<header><p>{_said(size())}</p></header>", "0")],
        lambda: [("<section class='comments'>", ""), *((f"<p>{_said(size())}</p>", "0") for _ in range(2)), ("</section>", "")],
        lambda: [("<div class='related'><h3>" + _said(item()) + "</h3><ul>", "0"), *menu(), ("</ul></div>", "")],
    )
    bare = (  # outside any article, in elements that say nothing
        lambda: [(f"<div>{_said(draw.randint(1, 5))}</div>", "0")],
        lambda: [("<ul>", ""), *menu(), ("</ul>", "")],
        lambda: [("<table><tr>", ""), *((f"<td>{_linked(label())}</td>", "0") for _ in range(3)), ("</tr></table>", "")],
        lambda: [(f"<div>{_linked(label())} {_linked(label())}</div>", "0")],
        lambda: [(f"<p>{_linked(label())} {_linked(label())}</p>", "0")],
    )
    para = lambda: [(f"<p>{_said(size())}</p>", "1")]
    cited = lambda: [(f"<p>{_said(draw.randint(8, 40))} {_linked(item())}</p>", "1")]
    head = lambda: [(f"<h2>{_said(draw.randint(1, 9))}</h2><p>{_said(size())}</p>", "11")]
    points = lambda: [("<ul>", ""), *((f"<li>{_said(draw.randint(2, 20))}</li>", "1") for _ in range(3)), ("</ul>", "")]
    loose = lambda: [(f"<div>{_said(draw.randint(15, 90))}</div>", "1")]
    anything = lambda: [(f"<div>{_said(size())}</div>", "1")]
    source = lambda: [(f"<p>{_linked(size())}</p>", "1")]
    mostly = lambda: [(f"<p>{_said(item())} {_linked(size())}</p>", "1")]

    out = []
    for i in range(n):
        layout = i % 8
        if layout == 0:  # a single block
            body = [(draw.choice(("<p>{}</p>", "<div>{}</div>", "{}", "<article>{}</article>", "<h1>{}</h1>")).format(_said(size())), "1")]
        elif layout < 5:
            x = draw.choice(("article", "main"))
            text = some((para, para, cited, head, points, anything, source, mostly, furniture[0], furniture[1], furniture[2], furniture[5]), draw.randint(1, 9))
            around = lambda: [*furniture, *bare, lambda: [(f"<p>{_said(size())}</p>", "0")], lambda: [(f"<h3>{_said(item())}</h3>", "0")]]
            body = sum(some(around(), draw.randint(0, 3)), []) + [(f"<{x}>", "")] + sum(text, para()) + [(f"</{x}>", "")] + sum(some(around(), draw.randint(0, 3)), [])
        else:
            text = some((para, para, para, cited, head, points, loose), draw.randint(2, 9))
            edge = (*furniture, *bare)
            body = sum(some(edge, draw.randint(0, 3)), []) + sum(text, []) + sum(some(edge, draw.randint(0, 3)), [])
        out.append(("".join(x for x, _ in body), "".join(y for _, y in body)))
    return out


def train(spark: SparkSession, labelled: list[tuple[str, str]] | None = None, depth: int = 16):
    """The decision tree as nested tuples: (feature, threshold, left, right) or a class."""
    rows = []
    for page, marks in labelled or labelled_pages():
        found = features(blocks(page))
        if len(found) != len(marks):
            raise ValueError(f"{len(marks)} labels for {len(found)} blocks")
        rows += [(float(mark), Vectors.dense(f)) for mark, f in zip(marks, found, strict=True)]
    model = DecisionTreeClassifier(maxDepth=depth, seed=1).fit(spark.createDataFrame(rows, ["label", "features"]))

    def node(j):
        if j.getClass().getSimpleName() == "LeafNode":
            return int(j.prediction())
        split = j.split()
        return split.featureIndex(), split.threshold(), node(j.leftChild()), node(j.rightChild())

    return node(model._java_obj.rootNode())


def _says(tree, x: tuple[float, ...]) -> int:
    while not isinstance(tree, int):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree


def main_text(page: str | None, tree) -> str:
    found = blocks(page or "")
    return "\n\n".join(b.text for b, x in zip(found, features(found), strict=True) if _says(tree, x))


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", tree=None) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    tree = train(pages.sparkSession) if tree is None else tree
    lean = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), 256):  # pages may be long: results leave in small batches
                some = b.slice(at, 256)
                texts = [main_text(x.as_py(), tree) for x in some.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    kind = lambda c: lean.schema[c].dataType.simpleString()
    return lean.mapInArrow(run, f"page_id {kind('page_id')}, url {kind('url')}, text string, n_chars bigint")

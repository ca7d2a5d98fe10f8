"""A tolerant reader of HTML: a tree of elements with runs of text as leaves.

Elements are nodes where they start a block, are a control, or are inline and have a telling name; other inline
elements only carry text on. Text between two block borders is a block. It has one run for each node that its pieces
are in, so that an inline advert can be told from the sentence around it. Scripts, styles, titles, comments and the
like are skipped, missing end tags are implied, unknown end tags are ignored, and a page that breaks off keeps what
came before.
"""

from __future__ import annotations

import html as references
import re
from dataclasses import dataclass, field
from functools import lru_cache

# Element names by what they do.
VOID = set("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
RAW = set("script style title textarea iframe noembed noframes xmp".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var".split()
)
CONTROL = set("audio button canvas datalist map meter noscript object option progress select svg template video".split())
CLOSES_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3"
    " h4 h5 h6 header hgroup hr li dd dt main menu nav ol p pre search section summary table ul".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
# An open element of the key is ended by a start tag of the key, up to an open element of the value.
ENDED_BY_SELF = {
    "li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"},
    "thead": {"table"}, "tbody": {"table"}, "tfoot": {"table"}, "option": {"select", "datalist"}, "a": set(),
}
ALSO_ENDS = {
    "dd": ("dt",), "dt": ("dd",), "td": ("th",), "th": ("td",), "tr": ("td", "th"), "tbody": ("tr", "thead", "td", "th"),
    "tfoot": ("tr", "tbody", "td", "th"), "thead": ("caption",),
}
WALLS = {"td", "th", "caption", "table", "template", "object"}
IN_TABLE = set("caption thead tbody tfoot tr td th".split())

# Words in names of elements that tell what they are for.
ROLES = {
    "menu": "nav navigation navbar menu menubar breadcrumb breadcrumbs toc pagination pager tabs skip sitemap",
    "header": "header masthead topbar branding logo banner",
    "footer": "footer foot colophon copyright bottom contentinfo legal imprint",
    "sidebar": "sidebar aside side rail complementary widget related recommended trending popular teaser teasers",
    "notice": "cookie cookies consent gdpr notice notices alert popup modal overlay paywall toast dialog announcement warning",
    "advert": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner affiliate",
    "form": "form search login signin signup register contact newsletter subscribe subscription",
    "comments": "comment comments commentlist reply replies respond disqus discussion review reviews feedback",
    "share": "share sharing social follow like likes tweet facebook twitter",
    "content": "article content main body post entry story text page prose news blog copy",
}
ROLE_OF: dict[str, list[str]] = {}
for _role, _words in ROLES.items():
    for _word in _words.split():
        ROLE_OF.setdefault(_word, []).append(_role)
TELLING = {"class", "id", "role", "aria-label", "itemprop", "itemtype", "data-role", "data-component"}

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>\"']*)(>?)")
_ATTRIBUTE = re.compile(
    r"[\s/]*([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"'][^\s>]*)?))?"
)
_GAP = re.compile(r"[\s/=]*")
_COMMENT = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))", re.S)
_OTHER = re.compile(r"<[!?/][^>]*>?")
_CAMEL = re.compile(r"([a-z])([A-Z])")
_LETTERS = re.compile(r"[a-z]+")


@dataclass
class Page:
    """Nodes, the root first and parents before children; runs with the node they are in and the block they belong to."""

    tags: list[str] = field(default_factory=lambda: ["body"])
    roles: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    named: list[bool] = field(default_factory=lambda: [False])
    parents: list[int] = field(default_factory=lambda: [-1])
    depths: list[int] = field(default_factory=lambda: [0])
    texts: list[str] = field(default_factory=list)
    owners: list[int] = field(default_factory=list)
    blocks: list[int] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)  # code points in links


@lru_cache(1 << 14)
def _roles(names: str) -> tuple[str, ...]:
    found = _LETTERS.findall(_CAMEL.sub(r"\1 \2", names).lower())
    return tuple(sorted({role for word in found for role in ROLE_OF.get(word, ())}))


def _attributes(html: str, at: int) -> tuple[str, int]:
    """The telling values of the attributes from a place on, and where the tag ends."""
    telling = []
    while True:
        found = _ATTRIBUTE.match(html, at)
        if found is None:
            at = _GAP.match(html, at).end()
            if at >= len(html):
                return " ".join(telling), at
            if html[at] == ">":
                return " ".join(telling), at + 1
            at += 1
            continue
        at = found.end()
        if found[1].lower() in TELLING:
            telling.append(references.unescape(found[2] or found[3] or found[4] or ""))


class _Reader:
    def __init__(self) -> None:
        self.page = Page()
        self.open: list[tuple[str, int]] = []  # names of open elements and their nodes
        self.pieces: list[tuple[int, str, bool]] = []
        self.block = 0
        self.links = 0

    @property
    def node(self) -> int:
        return self.open[-1][1] if self.open else 0

    def text(self, raw: str) -> None:
        if raw:
            self.pieces.append((self.node, references.unescape(raw) if "&" in raw else raw, self.links > 0))

    def border(self) -> None:
        """The block ends: its pieces become runs, one a node."""
        if not self.pieces:
            return
        grouped: dict[int, list] = {}
        for i, (node, text, linked) in enumerate(self.pieces):
            grouped.setdefault(node, []).append((i, text, linked))
        page, filled = self.page, False
        if len(grouped) == 1:
            parts = [(next(iter(grouped)), self.pieces)]
        else:
            # Pieces of a node that others interrupt are runs of their own, so that the order of the block stays.
            parts = []
            for piece in self.pieces:
                if parts and parts[-1][0] == piece[0]:
                    parts[-1][1].append(piece)
                else:
                    parts.append((piece[0], [piece]))
        for node, pieces in parts:
            whole = "".join(p[1] for p in pieces)
            if len(parts) == 1:
                whole = " ".join(whole.split())
            if not whole.strip():
                if len(parts) > 1 and filled:
                    page.texts[-1] += whole
                continue
            page.texts.append(whole)
            page.owners.append(node)
            page.blocks.append(self.block)
            page.linked.append(sum(len(p[1]) for p in pieces if p[2]))
            filled = True
        self.block += filled
        self.pieces = []

    def start(self, name: str, telling: str) -> None:
        if name in ("html", "body", "head"):
            self.border()
            return
        if name == "br":
            self.pieces.append((self.node, " ", False))
            return
        if name == "hr":
            self.border()
        if name in VOID:
            return
        if name in CLOSES_P:
            self.end("p", {"table", "td", "th", "button", "caption"})
        if name in ENDED_BY_SELF:
            for other in (name, *ALSO_ENDS.get(name, ())):
                self.end(other, ENDED_BY_SELF[name] or WALLS)
        if name in HEADINGS and self.open and self.open[-1][0] in HEADINGS:
            self.end(self.open[-1][0], set())
        inline = name in INLINE or (name not in CONTROL and name not in _BLOCKS and "-" not in name)
        roles = _roles(f"{telling} {name}" if "-" in name else telling) if telling or "-" in name else ()
        if not inline and name not in CONTROL:
            self.border()
        if inline and not (set(roles) - {"content"}):
            self.open.append((name, self.node))
        else:
            page = self.page
            page.tags.append(name)
            page.roles.append(roles)
            page.named.append(bool(telling))
            page.parents.append(self.node)
            page.depths.append(page.depths[self.node] + 1)
            self.open.append((name, len(page.tags) - 1))
        self.links += name == "a"

    def end(self, name: str, walls) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == name:
                ended = self.open[i:]
                if any(n not in INLINE and n not in CONTROL for n, _ in ended):
                    self.border()
                del self.open[i:]
                self.links -= sum(n == "a" for n, _ in ended)
                return
            if self.open[i][0] in walls:
                return

    def read(self, html: str) -> Page:
        at = 0
        while True:
            mark = html.find("<", at)
            if mark < 0:
                self.text(html[at:])
                break
            self.text(html[at:mark])
            found = _TAG.match(html, mark)
            if found is None:
                other = _COMMENT.match(html, mark) or _OTHER.match(html, mark)
                if other is None:
                    self.text("<")
                at = other.end() if other else mark + 1
                continue
            name = found[2].lower()
            telling = ""
            if found[4] and not found[3].strip(" /"):
                at = found.end()
            else:
                telling, at = _attributes(html, found.end(2))
            if found[1]:
                if name == "br":
                    self.start("br", "")
                elif name == "p":
                    self.border()
                    self.end("p", WALLS)
                elif name not in ("html", "body", "head"):
                    self.end(name, () if name == "table" else ("table",) if name in IN_TABLE else WALLS)
            elif name in RAW:
                last = _raw_end(name).search(html, at)
                at = last.end() if last else len(html)
            elif at <= len(html) and html[at - 1 : at] == ">":
                self.start(name, telling)
        self.border()
        return self.page


_BLOCKS = CLOSES_P | set(ENDED_BY_SELF) - INLINE | set("caption colgroup legend optgroup rb rtc frameset".split())


@lru_cache(64)
def _raw_end(name: str) -> re.Pattern:
    return re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I)


def read(html: str) -> Page:
    return _Reader().read(html)


def join(page: Page, kept: list[bool]) -> str:
    """The blocks of the kept runs in page order, white space as one space, blocks parted by an empty line."""
    out: list[str] = []
    last = None
    for text, block, keep in zip(page.texts, page.blocks, kept):
        if not keep:
            continue
        if block == last:
            out[-1] += text
        else:
            out.append(text)
            last = block
    return "\n\n".join(" ".join(t.split()) for t in out)

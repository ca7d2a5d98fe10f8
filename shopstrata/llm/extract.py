"""Main text of web pages by a tree-structured graphical model.

The nodes of a page's tree and, as leaves, its runs of text are each content or not. A node has potentials from its own
features (name, words in its names, length, links, punctuation, place), and each parent and child have a potential for
their pair of states, by the kinds of the two. Sum-product messages, first from the leaves upward and then from the
root downward, give the exact marginal of each node; a run is kept where being content is the more probable.

The potentials are fitted to labelled pages ``(html, text)``, text being the main text as blocks parted by empty lines:
in each round Spark sums the gradient of the likelihood (the labels less the marginals) over the pages, and the driver
takes one step with the few hundred sums. A prior draws the weights to ``prior``, a plain guess by names.

Where no labels are given, ``bootstrap_labels`` makes them from at most some ``sample`` pages of up to ``longest`` code
points, a bound by parameter: pages with a single article (or main) element, whose text is the label. Each of them is
also dressed anew in ``dressings`` templates, with other elements and names, so that the model learns what the given
pages do not show: sidebars, notices, adverts, forms and reader comments that hold prose as long as the article's.

Messages go level by level through the trees of many pages at once, so a task holds a few hundred pages or one long one.

Edge cases: a page that is null, empty or without text has the empty text. Pages are judged one by one, so repeated
rows have equal texts. Extra columns are ignored. With no pages there are no rows; with no labelled page the prior
decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import lru_cache
from html import escape
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstrata.llm import dom
from shopstrata.llm.scratch import written

# --- features ---------------------------------------------------------------------

_NAMES = (
    "body article main section div p ul ol li dl dt dd table tr td th nav header footer aside form fieldset figure"
    " figcaption blockquote pre address details summary dialog h1 h2 h3 h4 a span"
).split()
_SECTIONS = set("article main section nav header footer aside form".split())
_FLOW = set("p ul ol li dl dt dd table tbody thead tr td th figure figcaption blockquote pre h1 h2 h3 h4 h5 h6".split())
_SIZES = range(12)
_PARTS = range(5)


def _feature_names() -> list[str]:
    names = ["element", "run", "named", "tag:control", "tag:other", "in:control", "in:other"]
    names += [f"tag:{n}" for n in _NAMES] + [f"in:{n}" for n in _NAMES]
    names += [f"role:{r}" for r in dom.ROLES] + [f"inside:{r}" for r in dom.ROLES]
    for kind in ("element", "run"):
        names += [f"{kind} size:{i}" for i in _SIZES]
        names += [f"{kind} {what}:{i}" for what in ("links", "stops", "place", "share") for i in _PARTS]
    return names + [f"runs:{i}" for i in _PARTS]


FEATURES = {name: i for i, name in enumerate(_feature_names())}
# Kinds of parent and child: the child is a run, a sectioning element, another element or one of running text; the
# parent is another element, an article (or main) or an element of running text.
KINDS = 4 * 3
SIZE = len(FEATURES) + 4 * KINDS


@lru_cache(1 << 12)
def _tag_feature(prefix: str, tag: str) -> int:
    known = tag if tag in _NAMES else "control" if tag in dom.CONTROL else "h4" if tag in dom.HEADINGS else "other"
    return FEATURES[f"{prefix}:{known}"]


_ARTICLES = [FEATURES["tag:article"], FEATURES["tag:main"]]


def prior() -> np.ndarray:
    """Weights before any label: sections by their names, and children mostly as their parents."""
    weights = np.zeros(SIZE)
    for role in dom.ROLES:
        weights[FEATURES[f"role:{role}"]] = 2.0 if role == "content" else -2.0
    for name, weight in (("article", 3), ("main", 3), ("nav", -3), ("footer", -3), ("aside", -3), ("form", -2), ("header", -1.5), ("control", -3)):
        weights[FEATURES[f"tag:{name}"]] = weight
    weights[FEATURES["in:p"]] = 0.5
    for i in _PARTS:
        weights[FEATURES[f"run links:{i}"]] = -0.4 * i
    pairs = weights[len(FEATURES) :].reshape(KINDS, 2, 2)  # kind, state of the parent, state of the child
    pairs[:, 0, 1], pairs[:, 1, 1] = -2.0, 1.0
    pairs[4 * 1 + 3, 1, 1] = pairs[4 * 2, 1, 1] = 4.0  # running text of an article, and runs of running text
    return weights


@dataclass(frozen=True)
class Trees:
    """The nodes of some pages: elements and runs, each page's root first and parents before their children."""

    parent: np.ndarray  # -1 for roots
    kind: np.ndarray  # of the pair with the parent
    depth: np.ndarray
    start: np.ndarray  # the features of node i are features[start[i]:start[i + 1]]
    features: np.ndarray
    run: np.ndarray  # nodes that are runs, in page order


def _part(share: np.ndarray) -> np.ndarray:
    return np.clip((share * len(_PARTS)).astype(np.int64), 0, len(_PARTS) - 1)


_STOPS = str.maketrans({c: None for c in ".,;:!?"})


def trees(pages: list[dom.Page]) -> Trees:
    parent, kind, depth, tag, page_of, named, run_at = [], [], [], [], [], [], []
    roles: list[tuple[str, ...]] = []
    size, linked, stops = [], [], []
    for number, page in enumerate(pages):
        first = len(parent)
        parent += [p + first if p >= 0 else -1 for p in page.parents] + [o + first for o in page.owners]
        kind += [_kind(t, r) for t, r in zip(page.tags, page.roles)] + [0] * len(page.texts)
        depth += page.depths + [page.depths[o] + 1 for o in page.owners]
        tag += [_tag_feature("tag", t) for t in page.tags] + [_tag_feature("in", page.tags[o]) for o in page.owners]
        roles += page.roles + [page.roles[o] for o in page.owners]
        named += page.named + [False] * len(page.texts)
        page_of += [number] * (len(parent) - first)
        run_at += range(len(parent) - len(page.texts), len(parent))
        size += [len(t) for t in page.texts]
        linked += page.linked
        stops += [len(t) - len(t.translate(_STOPS)) for t in page.texts]
    n, runs = len(parent), np.array(run_at, dtype=np.int64)
    parents, kinds, depths, page_at = (np.array(x, dtype=np.int64) for x in (parent, kind, depth, page_of))
    holder = np.isin(np.array(tag), _ARTICLES) + 2 * (kinds == 3)
    kinds += 4 * holder[np.maximum(parents, 0)]
    is_run = np.zeros(n, dtype=bool)
    is_run[runs] = True
    # Code points, those in links, stops and runs below each node, and the code points of the page before it.
    totals = np.zeros((n, 4))
    totals[runs] = np.array([size, linked, stops, [1] * len(runs)], dtype=np.float64).T
    before = np.full(n, np.inf)
    before[runs] = np.cumsum(totals[runs, 0]) - totals[runs, 0]
    for at in _levels(depths)[:0:-1]:
        np.add.at(totals, parents[at], totals[at])
        np.minimum.at(before, parents[at], before[at])
    root = np.flatnonzero(parents < 0)[page_at]
    length, whole = np.maximum(totals[:, 0], 1), np.maximum(totals[root, 0], 1)
    before[totals[:, 3] == 0] = 0
    place = np.where(totals[:, 3] > 0, before - before[root], whole) / whole
    sized = np.where(is_run, FEATURES["run size:0"], FEATURES["element size:0"])
    columns = [
        np.where(is_run, FEATURES["run"], FEATURES["element"]), np.array(tag, dtype=np.int64),
        sized + np.clip(np.log2(length).astype(np.int64), 0, len(_SIZES) - 1),
    ]
    # The shape of a single run counts once: for the run, not again for the paragraph around it.
    twice = ~is_run & (kinds % 4 == 3) & (totals[:, 3] == 1)
    for i, share in enumerate((totals[:, 1] / length, totals[:, 2] / length * 25, place, totals[:, 0] / whole)):
        part = np.clip((share * len(_PARTS)).astype(np.int64), 0, len(_PARTS) - 1)
        columns.append(sized + len(_SIZES) + i * len(_PARTS) + part)
    many = np.clip(np.ceil(np.log2(np.maximum(totals[:, 3], 1))).astype(np.int64), 0, len(_PARTS) - 1)
    columns.append(np.where(is_run, -1, FEATURES["runs:0"] + many))
    columns[2:] = [np.where(twice, -1, c) for c in columns[2:]]
    columns.append(np.where(np.array(named, dtype=bool), FEATURES["named"], -1))
    told = [(i, FEATURES[f"{'inside' if is_run[i] else 'role'}:{r}"]) for i, rs in enumerate(roles) if rs for r in rs]
    node = np.append(np.tile(np.arange(n), len(columns)), [i for i, _ in told]).astype(np.int64)
    flat = np.append(np.concatenate(columns), [f for _, f in told]).astype(np.int64)
    node, flat = node[flat >= 0], flat[flat >= 0]
    start = np.append(0, np.cumsum(np.bincount(node, minlength=n)))
    return Trees(parents, kinds, depths, start, flat[np.argsort(node, kind="stable")], runs)


def _kind(tag: str, roles: tuple[str, ...]) -> int:
    """Kind of an element as a child; a list that is named a menu is no running text."""
    return 1 if tag in _SECTIONS else 3 if tag in _FLOW and set(roles) <= {"content"} else 2


def _levels(depth: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if len(depth) else []


# --- messages ---------------------------------------------------------------------


def marginals(t: Trees, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability that each node is content, and summed probabilities of the pairs of states by kind."""
    many = np.diff(t.start)
    unary = np.bincount(np.repeat(np.arange(len(many)), many), weights=weights[t.features], minlength=len(many))
    pairs = weights[len(FEATURES) :].reshape(KINDS, 2, 2)
    below = np.stack([np.zeros(len(unary)), unary], axis=1)  # a node's own potential and its children's messages
    message = np.zeros_like(below)
    levels = _levels(t.depth)
    for at in levels[:0:-1]:
        message[at] = np.logaddexp.reduce(pairs[t.kind[at]] + below[at][:, None, :], axis=2)
        np.add.at(below, t.parent[at], message[at])
    belief, joint = below.copy(), np.zeros((KINDS, 2, 2))
    for at in levels[1:]:
        # What the parent believes without this child.
        rest = belief[t.parent[at]] - message[at]
        both = rest[:, :, None] + pairs[t.kind[at]]
        belief[at] += np.logaddexp.reduce(both, axis=1)
        both += below[at][:, None, :]
        both -= both.max(axis=(1, 2), keepdims=True)
        np.exp(both, out=both)
        both /= both.sum(axis=(1, 2), keepdims=True)
        np.add.at(joint, t.kind[at], both)
    return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500))), joint


def gradient(t: Trees, label: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Of the log likelihood of the nodes' states: what the labels count less what the marginals expect."""
    probable, joint = marginals(t, weights)
    found = np.bincount(t.features, weights=np.repeat(label - probable, np.diff(t.start)), minlength=len(FEATURES))
    child = np.flatnonzero(t.parent >= 0)
    state = label.astype(np.int64)
    seen = np.bincount(t.kind[child] * 4 + state[t.parent[child]] * 2 + state[child], minlength=4 * KINDS)
    return np.append(found, seen - joint.ravel())


def labelled_nodes(t: Trees, runs: list[bool]) -> np.ndarray:
    """States of all nodes: an element is content if a run below it is."""
    label = np.zeros(len(t.parent))
    label[t.run] = runs
    for at in _levels(t.depth)[:0:-1]:
        np.maximum.at(label, t.parent[at], label[at])
    return label


def matched(page: dom.Page, text: str) -> list[bool]:
    """Which runs of a page make up its main text: the longest stretches of equal blocks first; where that leaves blocks
    over, each from the last on is the last run that equals it and comes before the next one's."""
    wanted = [" ".join(b.split()) for b in text.split("\n\n")]
    found = [" ".join(t.split()) for t in page.texts]
    kept = [False] * len(found)
    for a, _, many in SequenceMatcher(None, found, wanted, autojunk=False).get_matching_blocks():
        kept[a : a + many] = [True] * many
    if sum(kept) == len(wanted):
        return kept
    last, left = [False] * len(found), len(wanted)
    for i in range(len(found) - 1, -1, -1):
        if left and found[i] == wanted[left - 1]:
            last[i] = True
            left -= 1
    return kept if left else last


# --- labels -----------------------------------------------------------------------

_OUTSIDE = {"nav", "aside", "footer", "form"} | dom.CONTROL


def by_element(page: dom.Page) -> list[bool] | None:
    """Runs in the page's only article, else its only main element; None where there is no such element."""
    for name in ("article", "main"):
        if page.tags.count(name) != 1:
            continue
        inside = [False] * len(page.tags)
        for i, (tag, parent) in enumerate(zip(page.tags, page.parents)):
            telling = set(page.roles[i]) - {"content"}
            inside[i] = tag == name or (parent >= 0 and inside[parent] and tag not in _OUTSIDE and not telling)
        return [inside[o] for o in page.owners]
    return None


# Names of elements in dressed pages: for each part, elements of its own and names for plain ones.
_PARTS_OF_PAGES = {
    "menu": (["nav"], "menu main-menu navbar site-navigation breadcrumbs nav top-menu navigation"),
    "header": (["header"], "header page-header site-header masthead topbar branding"),
    "footer": (["footer"], "footer site-footer page-footer colophon footer-bottom legal"),
    "sidebar": (["aside"], "sidebar side-bar widget-area related related-posts right-rail trending post-sidebar recommended"),
    "notice": (["dialog", "aside"], "cookie-notice consent gdpr-banner notice alert cookie-bar modal site-announcement"),
    "advert": (["aside"], "ad ads advert advertisement sponsored promo ad-slot article-ad sponsor-box content-promo"),
    "form": (["form"], "newsletter subscribe-form search-form login signup-box contact-form newsletter-signup"),
    "comments": ([], "comments comment-list post-comments replies discussion reader-comments respond"),
    "share": ([], "share social-links share-bar follow-us social"),
}
_CONTENT_NAMES = "content article post entry-content post-body main-content story article-body page-content entry text".split()
_FRAMES = "container wrapper row page-wrapper col-8 layout inner grid".split()


class _Dresser:
    """Writes a page's texts into another template; ``self.kept`` are the blocks of the main text."""

    def __init__(self, random: Random, title: str, prose: list[str], foreign: list[str], other: list[str]):
        self.random, self.title, self.prose, self.foreign = random, title, prose, foreign
        self.other = other or ["Home"]
        self.kept: list[str] = []

    def line(self, most: int = 6) -> str:
        words = self.random.choice(self.other).split()
        at = self.random.randrange(max(1, len(words)))
        return escape(" ".join(words[at : at + self.random.randint(1, most)]) or "Home")

    def passage(self) -> str:
        return escape(self.random.choice(self.foreign or self.other))

    def named(self, names: list[str]) -> str:
        return self.random.choice(['class="{}"', 'id="{}"', "class={}", 'class="{} clearfix"']).format(self.random.choice(names))

    def wrap(self, part: str, inner: str) -> str:
        tags, names = _PARTS_OF_PAGES[part]
        if tags and self.random.random() < 0.5:
            tag = self.random.choice(tags)
            name = "" if self.random.random() < 0.6 else " " + self.named(names.split())
        else:
            tag, name = self.random.choice(["div", "section", "div", "ul" if part in ("menu", "share") else "div"]), " " + self.named(names.split())
        return f"<{tag}{name}>{inner}</{tag}>"

    def links(self) -> str:
        items = [f'<a href="/{i}">{self.line(3)}</a>' for i in range(self.random.randint(2, 9))]
        return "".join(f"<li>{i}</li>" for i in items) if self.random.random() < 0.7 else " | ".join(items)

    def part(self, part: str) -> str:
        pick = self.random
        passages = "".join(f"<p>{self.passage()}</p>" for _ in range(pick.randint(1, 3)))
        inner = {
            "menu": lambda: f"<ul>{self.links()}</ul>" if pick.random() < 0.7 else self.links(),
            "header": lambda: f"<p>{self.line()}</p>" + pick.choice(["", self.part("menu"), f"<h2>{self.line()}</h2>"]),
            "footer": lambda: pick.choice([f"&copy; {self.line()} &middot; {self.passage()}", f"<p>&copy; {self.line()}</p>{passages}", self.links()]),
            "sidebar": lambda: f"<h3>{self.line()}</h3>" + pick.choice([passages, f"<ul>{self.links()}</ul>", self.passage()]),
            "notice": lambda: pick.choice([f"<p>{self.passage()}</p>", self.passage(), self.line(12)]) + pick.choice(["", "<button>OK</button>"]),
            "advert": lambda: pick.choice([self.passage(), f"<p>{self.passage()}</p>", f'<a href="/x">{self.line()}</a>']),
            "form": lambda: f"<label>{self.line()}</label><input name=q>" + pick.choice(["", passages]) + f"<button>{self.line(2)}</button>",
            "comments": lambda: f"<h3>{self.line()}</h3>" + "".join(
                pick.choice(['<div class="comment"><b>{}</b><p>{}</p></div>', "<div><span>{}</span><p>{}</p></div>", "<li>{}<p>{}</p></li>",
                             "<article><header>{}</header><p>{}</p></article>"]).format(self.line(2), self.passage())
                for _ in range(pick.randint(1, 5))),
            "share": self.links,
        }[part]()
        return self.wrap(part, inner)

    def body(self) -> str:
        pick, out = self.random, []
        heading = pick.choice(["<h1>{}</h1>", "<h1>{}</h1>", "<header><h1>{}</h1></header>", "<h2>{}</h2>"])
        if self.title:
            out.append(heading.format(escape(self.title)))
            self.kept.append(self.title)
        plain = pick.choice(["<p>{}</p>", "<p>{}</p>", "<p>{}", "<div>{}</div>", "<p><b>{}<br>"])
        for text in self.prose:
            form = pick.choice([plain] * 8 + ["<ul><li>{}</li></ul>", "<blockquote>{}</blockquote>", "<h2>{}</h2>", "<p><em>{}</em></p>", '<p><a href="/y">{}</a></p>'])
            out.append(form.format(escape(text)))
            self.kept.append(text)
            if pick.random() < 0.06:
                out.append(self.part(pick.choice(["advert", "share", "form", "sidebar", "notice"])))
        return "".join(out)

    def page(self) -> str:
        pick = self.random
        body = self.body()
        name = self.named(_CONTENT_NAMES)
        holder = pick.choice([
            "<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>", f"<div {name}>{{}}</div>",
            f"<section {name}>{{}}</section>", f"<main><div {name}>{{}}</div></main>", f"<div {name}><article>{{}}</article></div>",
            '<div role="main">{}</div>', "<div>{}</div>", "{}",
        ])
        body = holder.replace("{}", body)
        ahead = [self.part(p) for p in ("notice", "header", "menu", "advert", "sidebar") if pick.random() < 0.5]
        after = [self.part(p) for p in ("share", "comments", "advert", "form", "sidebar", "footer", "notice") if pick.random() < 0.5]
        whole = "".join(ahead) + body + "".join(after)
        if pick.random() < 0.4:
            whole = f'<div class="{pick.choice(_FRAMES)}">{whole}</div>'
        return f"<!DOCTYPE html><html><head><title>{escape(self.title)}</title></head><body>{whole}" + pick.choice(["</body></html>", ""])


def _labelled(dressings: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, shown = [], []
            for key, html in zip(batch.column("key").to_pylist(), batch.column("html").to_pylist()):
                page = dom.read(html)
                kept = by_element(page)
                if not kept or not any(kept):
                    continue
                out.append((html, dom.join(page, kept)))
                blocks = out[-1][1].split("\n\n")
                titled = page.tags[page.owners[kept.index(True)]] in dom.HEADINGS
                other = [t for t, k in zip(page.texts, kept) if not k and t.strip()]
                shown.append((key, blocks[0] if titled else "", blocks[titled:], other))
            # Prose around an article is that of other pages, so that it is told by its place and not by its words.
            for key, title, prose, other in shown:
                for n in range(dressings):
                    random = Random(f"{key}:{n}")
                    foreign = [t for t in random.choice(shown)[2] if t not in prose and t != title]
                    dresser = _Dresser(random, title, prose, foreign or other, other)
                    out.append((dresser.page(), "\n\n".join(dresser.kept)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], pa.string()) for i in (0, 1)], names=["html", "text"]
            )

    return run


def bootstrap_labels(
    pages: DataFrame, html_col: str = "html", sample: int = 1000, longest: int = 1 << 15, dressings: int = 3
) -> DataFrame:
    """Labelled pages ``html, text`` from some ``sample`` distinct pages that show their article by an element, and from
    ``dressings`` templates of each."""
    fitting = pages.select(F.col(html_col).alias("html"), F.xxhash64(html_col).alias("key")).where(
        F.col("html").isNotNull() & (F.char_length("html") <= longest)
    )
    share = F.lit(max(1, -(-fitting.count() // sample)))
    chosen = fitting.where(F.pmod(F.xxhash64("key"), share) == 0).dropDuplicates(["key"])
    return chosen.repartition(8, "key").sortWithinPartitions("key").mapInArrow(_labelled(dressings), "html string, text string")


# --- Spark ------------------------------------------------------------------------

_STORED = "parent array<long>, kind array<long>, depth array<long>, start array<long>, features array<long>, run array<long>, label array<double>"


def _slices(batches: Iterator[pa.RecordBatch], size: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Parts of batches with some ``size`` code points of HTML, one page at least."""
    for batch in batches:
        first = held = 0
        for i, html in enumerate(batch.column("html")):
            held += len(html.as_py())
            if held >= size or i == batch.num_rows - 1:
                yield batch.slice(first, i + 1 - first)
                first, held = i + 1, 0


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _STORED.split(", ")]
    for batch in _slices(batches):
        pages = [dom.read(h) for h in batch.column("html").to_pylist()]
        t = trees(pages)
        runs = [k for page, text in zip(pages, batch.column("text").to_pylist()) for k in matched(page, text)]
        values = [t.parent, t.kind, t.depth, t.start, t.features, t.run, labelled_nodes(t, runs)]
        yield pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v)) for v in values], names=names
        )


def _gradients(weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE + 1)
        for batch in batches:
            for i in range(batch.num_rows):
                *arrays, label = (c[i].values.to_numpy() for c in batch.columns)
                t = Trees(*arrays)
                total[:-1] += gradient(t, label, weights)
                total[-1] += np.count_nonzero(t.parent < 0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(SIZE + 1)), pa.array(total)], names=["at", "value"])

    return run


def fit(labelled: DataFrame, rounds: int = 80, rate: float = 0.3, hold: float = 0.0005) -> np.ndarray:
    """Weights from labelled pages ``html, text``; ``hold`` is the pull to the prior's weights."""
    stored = written(
        labelled.where(F.col("html").isNotNull()).select("html", F.coalesce("text", F.lit("")).alias("text"))
        .mapInArrow(_stored, _STORED), "trees",
    )
    weights = start = prior()
    mean, square = np.zeros(SIZE), np.zeros(SIZE)
    for n in range(1, rounds + 1):
        sums = stored.mapInArrow(_gradients(weights), "at long, value double").groupBy("at").agg(F.sum("value"))
        total = np.zeros(SIZE + 1)
        for at, value in sums.collect():  # a row a weight
            total[at] = value
        if not total[-1]:
            break
        step = total[:-1] / total[-1] - hold * (weights - start)
        mean, square = 0.9 * mean + 0.1 * step, 0.99 * square + 0.01 * step**2
        weights = weights + rate * (mean / (1 - 0.9**n)) / (np.sqrt(square / (1 - 0.99**n)) + 1e-6)
    return weights


def _judged(weights: np.ndarray, every: bool):
    """For each batch its rows with their text, or with the blocks and how probable they are content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            pages = [dom.read(h) for h in batch.column("html").to_pylist()]
            t = trees(pages)
            probable = marginals(t, weights)[0][t.run]
            ends = np.cumsum([len(p.texts) for p in pages])
            parts = [probable[e - len(p.texts) : e] for p, e in zip(pages, ends)]
            if every:
                columns = [
                    pa.array([p.texts for p in pages], pa.list_(pa.string())),
                    pa.array([p.tolist() for p in parts], pa.list_(pa.float64())),
                ]
            else:
                columns = [pa.array([dom.join(p, list(k >= 0.5)) for p, k in zip(pages, parts)], pa.string())]
            kept = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "html"]
            names = [n for n in batch.schema.names if n != "html"]
            yield pa.RecordBatch.from_arrays([*kept, *columns], names=[*names, *(["runs", "content"] if every else ["text"])])

    return run


def extract(
    pages: DataFrame, labelled: DataFrame | None = None, weights: np.ndarray | None = None, id_col: str = "page_id",
    url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """``page_id, url, text``: the main text of every page, by ``weights`` or else the model of ``labelled`` pages
    (html, text), or else of those of ``bootstrap_labels``."""
    return _mapped(pages, labelled, weights, id_col, url_col, html_col, every=False)


def runs(
    pages: DataFrame, labelled: DataFrame | None = None, weights: np.ndarray | None = None, id_col: str = "page_id",
    url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """``page_id, url, runs, content``: all runs of text of every page and how probable each is content."""
    return _mapped(pages, labelled, weights, id_col, url_col, html_col, every=True)


def _mapped(pages, labelled, weights, id_col, url_col, html_col, every) -> DataFrame:
    if weights is None:
        weights = fit(bootstrap_labels(pages, html_col) if labelled is None else labelled)
    asked = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html")
    )
    kept = f"page_id {asked.schema['page_id'].dataType.simpleString()}, url {asked.schema['url'].dataType.simpleString()}"
    return asked.mapInArrow(_judged(weights, every), kept + (", runs array<string>, content array<double>" if every else ", text string"))

"""Extraction of main texts: the reader, exact marginals and gradients against enumeration, and held-out pages."""

from __future__ import annotations

import html as references
import itertools
import re
from random import Random

import numpy as np
import pyarrow as pa
import pytest

from shopstrata.llm import dom, extract
from shopstrata.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string, text string, runs string, key string"


def article(html: str) -> str:
    inner = html[html.index("<article>") + 9 : html.index("</article>")]
    blocks = (" ".join(references.unescape(re.sub("<[^>]*>", "", s)).split()) for s in re.split("</?(?:p|h1)>", inner))
    return "\n\n".join(b for b in blocks if b)


@pytest.fixture(scope="module")
def weights(spark):
    pages = spark.read.parquet(f"/root/testdata/sf0.01/pages.parquet")
    return extract.fit(extract.bootstrap_labels(pages))


def test_query_returns_the_articles(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    got = QUERIES["op11_html_extraction"](spark, FOLDER).collect()
    assert len(got) == len(pages)
    for r in got:
        page = pages[r["page_id"]]
        assert (r["url"], r["text"], r["n_chars"]) == (page["url"], article(page["html"]), len(r["text"]))


@pytest.mark.parametrize(("html", "texts"), [
    ("<p>a <b>x<br><p>y &amp &copy; &#x41;<p>q", ["a x", "y & © A", "q"]),
    ("<ul><li>a<li>b <ul><li>c</ul><li>d</ul>e", ["a", "b", "c", "d", "e"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>tail", ["a", "b", "c", "tail"]),
    ('<script>var t="</p>";</script>x < y <!-- c > d --> z<style>p{}</style>', ["x < y z"]),
    ('<div title="x > y" data-q=it\'s>hello</div>bye<p title=unfinished', ["hello", "bye"]),
    ("<title>t</title><h1>one<h2>two</h2></div></p>three", ["one", "two", "three"]),
    ("\n a\t b c \r\n", ["a b c"]), ("", []), ("<", ["<"]), ("<p></p><br>", []), ("a<textarea>b", ["a"]),
])
def test_reader(html, texts):
    page = dom.read(html)
    assert dom.join(page, [True] * len(page.texts)) == "\n\n".join(texts)


def test_inline_advert_leaves_its_sentence():
    page = dom.read('<p>one <span class="ad">buy</span> two</p>')
    kept = [not page.roles[o] for o in page.owners]
    assert dom.join(page, kept) == "one two" and page.blocks == [0, 0, 0]


def pages_of(random):
    def part(depth):
        tag = random.choice(["p", "div", "article", "nav", "ul", "li"])
        inner = "".join(part(depth + 1) for _ in range(random.randrange(3))) if depth < 2 else ""
        return f'<{tag} class="{random.choice(["ad", "content", "x"])}">{random.choice(["some words.", "", "x"])}{inner}</{tag}>'

    return [dom.read(part(0)) for _ in range(3)]


def log_weight(t, states, weights):
    pairs = weights[len(extract.FEATURES) :].reshape(extract.KINDS, 2, 2)
    total = 0.0
    for i, state in enumerate(states):
        total += state * weights[t.features[t.start[i] : t.start[i + 1]]].sum()
        if t.parent[i] >= 0:
            total += pairs[t.kind[i], states[t.parent[i]], state]
    return total


def test_marginals_and_gradient_are_exact():
    random, checked = Random(3), 0
    while checked < 15:
        t = extract.trees(pages_of(random))
        n = len(t.parent)
        if n > 13 or not len(t.run):
            continue
        checked += 1
        weights = np.random.default_rng(checked).normal(size=extract.SIZE)
        every = list(itertools.product((0, 1), repeat=n))
        logs = np.array([log_weight(t, s, weights) for s in every])
        chances = np.exp(logs - np.logaddexp.reduce(logs))
        assert extract.marginals(t, weights)[0] == pytest.approx(chances @ np.array(every), abs=1e-9)
        label = np.array(random.choice(every), dtype=float)
        found = extract.gradient(t, label, weights)

        def likelihood(w):
            return log_weight(t, label.astype(int).tolist(), w) - np.logaddexp.reduce([log_weight(t, s, w) for s in every])

        for at in random.sample(range(extract.SIZE), 6) + t.features[:3].tolist() + [len(extract.FEATURES) + 4 * int(t.kind[-1]) + 3]:
            step = np.zeros(extract.SIZE)
            step[at] = 1e-5
            assert found[at] == pytest.approx((likelihood(weights + step) - likelihood(weights - step)) / 2e-5, abs=1e-4)


def test_held_out_pages_and_templates(spark, weights):
    htmls = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").where("page_id >= 2000").collect()]
    shown = [(h, article(h)) for h in htmls]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(htmls))), pa.array(htmls)], names=["key", "html"])
    dressed = list(zip(*next(extract._labelled(1)(iter([batch]))).to_pydict().values()))[len(htmls) :]
    wrong = {}
    for name, pairs in (("shown", shown), ("dressed", dressed)):
        read = [dom.read(h) for h, _ in pairs]
        t = extract.trees(read)
        kept = extract.marginals(t, weights)[0][t.run] >= 0.5
        truth = np.array([k for p, (_, text) in zip(read, pairs) for k in extract.matched(p, text)])
        wrong[name] = (kept != truth).mean()
    assert wrong["shown"] < 0.001 and wrong["dressed"] < 0.02, wrong


def test_other_templates_by_name(spark, weights):
    text = ["A long way up", "The first passage has some words, and it goes on. It ends here.", "A second one follows; it is as long as that."]
    main = f"<h1>{text[0]}</h1><p>{text[1]}</p><p>{text[2]}</p>"
    around = (
        '<header class="site-header"><a href="/">Home of words</a></header><nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>'
        '<div class="cookie-notice"><p>We use cookies here, as all others do. Do you agree?</p><button>Yes</button></div>'
        '{}<aside class="sidebar"><h3>Related</h3><p>Some other passage that is not ours, but as long as ours.</p></aside>'
        '<form class="newsletter"><label>Mail</label><input><p>Get our letters, each day one of them.</p><button>Go</button></form>'
        '<section id="comments"><h3>Comments</h3><div class="comment"><b>Jo</b><p>I liked this one very much, thanks for it.</p></div></section>'
        '<div class="ad">Buy more things, they are cheap.</div><footer>&copy; words.example <a href="/i">Imprint</a></footer>'
    )
    rows = [(i, "u", around.replace("{}", holder.replace("{}", main))) for i, holder in enumerate([
        "<article>{}</article>", "<main>{}</main>", '<div class="post-content">{}</div>', '<div id="content"><article>{}</article></div>',
    ])]
    got = extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), weights=weights).collect()
    assert [r["text"] for r in sorted(got, key=lambda r: r["page_id"])] == ["\n\n".join(text)] * len(rows)


def test_edges(spark, weights):
    long = "<p>" + "word, " * 200_000
    deep = "<div>" * 3000 + "<p>Deep down, there is a text.</p>"
    rows = [(1, "a", None), (2, None, ""), (3, "c", "<article><p>One text, here.</p></article>"), (3, "c", "<article><p>One text, here.</p></article>"),
            (None, "d", "<script>x</script>"), (4, "e", f"<article>{long}</article>"), (5, "f", f"<article>{deep}</article>")]
    pages = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA)
    got = extract.extract(pages, weights=weights)
    assert got.columns == ["page_id", "url", "text"]
    found = sorted(map(tuple, got.collect()), key=repr)
    assert (1, "a", "") in found and (2, None, "") in found and (None, "d", "") in found
    assert found.count((3, "c", "One text, here.")) == 2
    assert (4, "e", ("word, " * 200_000).strip()) in found and (5, "f", "Deep down, there is a text.") in found
    every = extract.runs(pages, weights=weights).where("page_id = 3").first()
    assert every["runs"] == ["One text, here."] and every["content"][0] > 0.5
    assert extract.extract(pages.limit(0)).isEmpty()


def test_own_labels_are_learned(spark):
    def page(i):
        return f"<div class=x{i % 3}><p>Keep this passage {i}, please.</p></div><table><tr><td>Passage {i} to go, sadly.</td></tr></table>"

    labelled = spark.createDataFrame([(page(i), f"Passage {i} to go, sadly.") for i in range(40)], "html string, text string")
    rows = spark.createDataFrame([(99, "u", page(99))], "page_id long, url string, html string")
    assert extract.extract(rows, labelled=labelled).first()["text"] == "Passage 99 to go, sadly."

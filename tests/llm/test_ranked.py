"""Ranked search against a plain evaluation of every item on every document, and its edge cases."""

from __future__ import annotations

import math
import re
from collections import Counter
from random import Random

import numpy as np
import pytest

from shopstrata.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, no string, n string, score string, terms string"
ITEMS = "item_id string, text string, no string, rank string, doc_id string"


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def expected(docs, items, top=10):
    held = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    rows = []
    for item, text in items:
        found = []
        for doc, counts in held:
            m = 25 + 75 * sum(counts.values()) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 8 * m))
                for t in terms(text) if counts[t]
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        rows += [(item, i + 1, doc, -s) for i, (s, _, _, doc) in enumerate(sorted(found, key=lambda f: f[:3])[:top])]
    return sorted(rows, key=repr)


def tables(seed, documents=300, items=40):
    random = Random(seed)
    words = [f"w{i}" for i in range(120)] + ["Été", "ßtrasse", "İ", "A1"]

    def text(longest):
        return random.choice([" ", "-", "_", "\n"]).join(random.choice(words[: random.choice([6, 40, 124])]) for _ in range(random.randrange(longest)))

    docs = [(i, text(60)) for i in range(documents)]
    docs += [(3, docs[3][1]), (None, docs[4][1]), (None, None), (-5, docs[5][1]), (9, "w1 " * 5000), (10, "W1 " * 5000), (11, "")]
    asked = [(f"q{i}", text(25)) for i in range(items)]
    asked += [("q0", asked[0][1]), (None, "w1 w1 w2"), ("none", None), ("odd", "nowhere at all"), ("same", asked[7][1])]
    return docs, asked


@pytest.mark.parametrize("block_terms", [1 << 17, 60])
def test_rows_are_those_of_a_plain_evaluation(spark, block_terms):
    docs, items = tables(block_terms)
    got = ranked.rank(
        spark.createDataFrame([(*d, *"xxxx") for d in docs], DOCS).repartition(5),
        spark.createDataFrame([(*i, *"xxx") for i in items], ITEMS), block_terms=block_terms,
    )
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(docs, items)


def test_batches_of_few_documents_give_the_same(spark, monkeypatch):
    docs, items = tables(1, documents=80, items=10)
    monkeypatch.setattr(ranked, "_CELLS", 500)  # fewer than four documents a batch
    got = ranked.rank(spark.createDataFrame([(*d, *"xxxx") for d in docs], DOCS), spark.createDataFrame([(*i, *"xxx") for i in items], ITEMS), top=3)
    assert sorted(map(tuple, got.collect()), key=repr) == expected(docs, items, top=3)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a", *"xxxx")], DOCS), spark.createDataFrame([("q", "a", *"xxx")], ITEMS)
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.limit(0), items.limit(0))):
        assert ranked.rank(d, i).isEmpty()


def test_shared_sets_are_summed_once_and_every_item_keeps_its_terms():
    random = Random(2)
    items = []
    for no in range(60):
        held = Counter(random.choices(range(30), k=12) + random.choices(range(1000), k=6))
        items.append((no, list(held), list(held.values())))
    dag = ranked.share(items)
    value = np.arange(len(dag.terms))[:, None] ** 2 + 7
    rows = np.arange(len(dag.terms))
    got = ranked._accumulate(dag, np.zeros(len(rows), np.int64), rows, value[:, 0], 1)[:, 0]
    known = {int(t): int(value[i, 0]) for i, t in enumerate(dag.terms.view(np.int64))}
    assert got.tolist() == [sum(known[t] * n for t, n in zip(ts, ns)) for _, ts, ns in items]
    plain = sum(sum(ns) for _, _, ns in items)
    assert dag.levels and sum(len(a) for a, _ in dag.levels) + sum(len(n) for _, n in dag.items) < plain

"""Nulls, empty and repeated rows, ties, empty tables and clashing columns; planted copies, passages and secrets."""

from __future__ import annotations

import io
import math
from random import Random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shopstrata.llm import chat, chosenpath, decontaminate, maxent, mixing, pii, quality, secrets, urls, warc

TOKEN = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"
LONG = " ".join(f"w{i}" for i in range(30_000))
BASE = [f"word{i}" for i in range(120)]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string, cls string, start string"


@pytest.fixture(scope="module")
def docs(spark):
    near = [*BASE[:60], "other", *BASE[61:]]
    texts = [
        (1, " ".join(BASE)), (2, " ".join(BASE)), (3, " ".join(near)), (4, None), (5, ""), (5, ""), (6, LONG),
        (None, "a mail to x.y@example.com and 10.0.0.1"), (7, f'the token = "{TOKEN}" ' + " ".join(reversed(BASE))),
        (8, "one two three four five six seven eight nine ten eleven"), (1, " ".join(BASE)),
    ]
    rows = [(i, t, "en", "s", len(t or ""), "x", "x", "x", "x") for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "Two three FOUR five six seven eight nine ten eleven"), (2, "nine ten"), (3, None), (4, "not there at all")]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (6, 0, 0), (8, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")


def test_quality(docs):
    got = {(r["doc_id"], r["n_words"]): r["fail_bits"] for r in quality.ledger(docs).collect()}
    assert got[(4, 0)] & 1 and got[(5, 0)] & 1 and got[(1, 120)] == 0 and got[(6, 30_000)] == 0
    assert quality.keep(docs).columns == docs.columns and quality.keep(docs).count() == 6
    assert quality.keep(docs.limit(0)).isEmpty()
    report = {r["rule"]: r for r in quality.ablations(quality.ledger(docs), quality.BASE).collect()}
    assert report["too_few_words"]["failing"] == 5 and report["too_few_words"]["rejected_without"] == 0


def test_chosen_paths(docs):
    got = {}
    for r in chosenpath.join(docs).collect():
        got.setdefault(r["doc_id"], []).append((r["class_id"], r["copy_id"], r["n_links"]))
    assert got[1] == [(1, 1, 3)] * 2 and got[2] == [(1, 1, 3)] and got[3] == [(1, 3, 3)]
    assert got[4] == [(4, 4, 0)] and got[5] == [(5, 5, 0)] * 2 and got[None] == [(None, None, 0)]
    kept = chosenpath.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "4", "5", "6", "7", "8", "None"]
    assert chosenpath.join(docs.limit(0)).isEmpty()


@pytest.mark.parametrize("blocks", [{"block_sets": 8}, {"block_sets": 20}, {"block_mass": 200}])
def test_large_groups_are_compared_in_blocks(spark, blocks):
    rows = [(i, " ".join([*BASE, f"end{i}"])) for i in range(40)]
    got = chosenpath.join(spark.createDataFrame(rows, "doc_id long, text string"), limit=8, **blocks).collect()
    assert {(r["class_id"], r["n_links"]) for r in got} == {(0, 39)}


@pytest.mark.parametrize("levels", [1, 2, 3, 4])
def test_the_runs_keep_the_recall_where_every_level_is_needed(levels):
    assert (1 - (1 - math.exp(-1)) ** levels) ** chosenpath.runs_for(0.999, levels) <= 0.001


def test_recall_where_all_shingles_are_frequent(spark):
    random = Random(3)
    lines = [" ".join(f"l{k}w{i}" for i in range(14)) for k in range(16)]
    texts = sorted({" ".join(lines[k] for k in sorted(random.sample(range(16), 13))) for _ in range(160)})
    sets = [set(zip(*[t.split()[i:] for i in range(5)])) for t in texts]
    near = [sum(len(a & b) >= 0.8 * len(a | b) - 1e-9 for b in sets) - 1 for a in sets]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["n_links"] for r in chosenpath.join(docs, limit=2).collect()}
    assert sum(near) > 400 and all(found[i] <= n for i, n in enumerate(near))
    assert sum(found.values()) >= 0.999 * sum(near)


def test_components_do_not_end_unfinished(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    assert {r["root"] for r in chosenpath.components(chain).collect()} == {0}
    with pytest.raises(RuntimeError):
        chosenpath.components(chain, rounds=1)


def test_decontamination(docs, items):
    got = {r["doc_id"]: r for r in decontaminate.decontaminate(docs, items).collect()}
    assert (got[8]["n_words"], got[8]["n_hit"], got[8]["n_items"], got[8]["contaminated"]) == (11, 10, 2, True)
    assert not got[4]["contaminated"] and got[6]["n_words"] == 30_000 and len(got) == 9
    assert decontaminate.decontaminate(docs, items).count() == docs.count()
    assert 8 not in {r["doc_id"] for r in decontaminate.clean(docs, items).collect()}
    assert decontaminate.clean(docs, items.limit(0)).count() == docs.count()


def test_secrets(docs):
    found = secrets.scan(docs).where("is_secret").collect()
    assert [(r["doc_id"], r["hit"]) for r in found] == [(7, TOKEN)]
    masked = secrets.redact(docs)
    assert masked.columns == docs.columns and masked.count() == docs.count()
    assert masked.where(F.contains("text", F.lit(TOKEN))).isEmpty() and masked.where("text is null").count() == 1
    assert secrets.scan(docs.limit(0)).isEmpty()


AWS = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"


@pytest.mark.parametrize(("text", "hit"), [
    (f'aws_secret_access_key = "{AWS}"', AWS), (f"AWS_SECRET_ACCESS_KEY={AWS}\n", AWS), (f'"aws_secret_access_key": "{AWS}",', AWS),
    ('password = "Tr0ub4dor&3xy"', "Tr0ub4dor&3xy"), ("db_password: p$5w!rd9 next", "p$5w!rd9"), ("url?token=ab1&pwd=x7&1q&page=2", "x7&1q"),
    ("é PWD='hunter2'", "hunter2"),
])
def test_assigned_secrets_under_any_name(spark, text, hit):
    found = secrets.describe(secrets.candidates(spark.createDataFrame([(1, text)], "doc_id long, text string")),
                             spark.createDataFrame([], "triple string"))
    mine = [r for r in secrets.bootstrap_labels(found).collect() if r["label"] == 1]
    assert [(r["hit"], r["credential"], r["assigned"]) for r in mine] == [(hit, 1, 1)]
    assert text[mine[0]["start"] : mine[0]["end"]] == hit


def test_contexts_are_the_text_around(spark):
    text = "é" * 50 + f" secret_a=ab1! secret_b=cd2? {TOKEN} private_key_of_the_server={AWS}== pwd=x9y8 " + "ü" * 60
    docs = spark.createDataFrame([(1, text), (2, f"{TOKEN}")], "doc_id long, text string")
    found = [r for r in secrets.candidates(docs).collect()]
    assert len([r for r in found if r["doc_id"] == 1]) == 6
    for r in found:
        whole = text if r["doc_id"] == 1 else TOKEN
        assert whole[r["start"] : r["end"]] == r["hit"]
        assert r["before"] == whole[max(0, r["start"] - 40) : r["start"]] and r["after"] == whole[r["end"] : r["end"] + 40]


def test_short_secrets_are_masked_where_they_were_found(spark):
    text = f'é x9y8z and pwd = "x9y8z", {TOKEN}; then token = "{TOKEN}" end'
    docs = spark.createDataFrame([(1, text)] * 2, "doc_id long, text string")
    masked = secrets.redact(docs, mask="#").collect()
    assert [r["text"] for r in masked] == ['é x9y8z and pwd = "#", #; then token = "#" end'] * 2


def test_coverage_does_not_depend_on_the_number_of_rows(spark):
    random = Random(9)
    letters = "".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=40))
    prose = "the weather there was rather nice and another father gathered his leather and feathers together"
    rows = [(i, f'{prose} secret = "{letters}" and see the/weather/there/gather') for i in range(3)]
    coverage = []
    for copies in (1, 20):
        docs = spark.createDataFrame(rows * copies, "doc_id long, text string")
        described = secrets.describe(secrets.candidates(docs), secrets.common_triples(docs))
        coverage.append({(r["hit"], round(r["coverage"], 9)) for r in described.select("hit", "coverage").collect()})
    assert coverage[0] == coverage[1]
    assert dict(coverage[0])[letters] < 0.2 and dict(coverage[0])["the/weather/there/gather"] > 0.5


def test_personal_data(spark, docs):
    got = {r["doc_id"]: r for r in pii.find(docs).collect()}
    assert (got[None]["n_email"], got[None]["n_ip"], got[4]["spans"]) == (1, 1, "")
    assert pii.find(docs).count() == docs.count() and pii.find(docs.limit(0)).isEmpty()
    rows = [(i, f"contact number is +1 555 123 45{i:02d} please") for i in range(6)]
    rows += [(9, "contact number is AB-77-1234 please"), (10, "a contact number 99.1234x")]
    found = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[9] == "id:18:28" and found[10] == ""


def test_language_model(docs):
    rows = maxent.score(docs, shape=maxent.Shape(rows=1 << 10, classes=8, singles=3)).collect()
    assert len(rows) == docs.count()
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (4, 5)} == {1}
    assert maxent.score(docs.limit(0)).isEmpty()


@pytest.mark.parametrize("fold", [0, 1])
def test_one_text_trains_in_either_fold(spark, fold):
    texts = spark.range(40).select(F.concat(F.lit("one two three four five six seven eight "), F.col("id").cast("string")).alias("text"))
    one = texts.where(F.pmod(F.xxhash64("text", F.lit(1)), F.lit(2)) == fold).orderBy("text").first()["text"]
    docs = spark.createDataFrame([(i, one) for i in range(200)], "doc_id long, text string")
    rows = maxent.score(docs, shape=maxent.Shape(rows=1 << 10, slots=1 << 12, max_slots=1 << 12)).collect()
    assert all(r["score"] > r["base_score"] for r in rows)


def test_the_history_chooses_among_the_words_of_a_class(spark):
    random = Random(5)
    following = {f"a{i}zz": f"b{i}zz" for i in range(30)}
    rows = []
    for i in range(800):
        firsts = random.choices(list(following), k=25)
        rows.append((i, " ".join(f"{a} {following[a]}" for a in firsts)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # One class holds all words; half of them follow from the word before, the others are drawn from thirty.
    held = maxent.score(docs, shape=maxent.Shape(classes=2, singles=0, head=1000)).where("held_out").collect()
    mean = {k: sum(r[k] for r in held) / sum(r["n_tokens"] for r in held) for k in ("score", "base_score")}
    assert len(held) > 40 and mean["score"] > mean["base_score"] + 0.5


@pytest.mark.parametrize("head", [0, 3, 1000])
def test_token_probabilities_add_up_to_one(spark, head):
    texts = ["a bb ccc dd a bb", "ccc ee a dd ff gg", "bb a hh ii jj a"] * 5
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumn("fold", F.lit(0))
    shape = maxent.Shape(rows=1 << 10, slots=1 << 10, classes=6, singles=2, tails=2, head=head, rounds=1)
    counts = maxent.count_words(docs)
    known = maxent.describe(counts, shape)
    trees = known.trees
    inner = np.random.default_rng(1).normal(size=known.shape.slots).astype(np.float32)
    for first in (1 + shape.singles, shape.classes - 1):
        words = {k: n for k, n, c in _words_of(counts, known) if c == first}
        inside = {k: known.leaf_of(*[np.array([x]) for x in (k, *_place(known, k))], np.array([first]))[0] for k in words}
        leaves = np.unique(np.append(list(inside.values()), known.tail_leaf[first]).astype(np.int64))
        owner, nodes, ones = trees.steps(leaves)
        marks = np.full((3, len(leaves)), 77, dtype=np.uint32)
        turns = maxent.node_logits(inner, trees, maxent.slots_of(marks, owner, trees.line[nodes], known.shape), nodes)
        log = -np.bincount(owner, np.logaddexp(0, np.where(ones > 0, -turns, turns)), len(leaves))
        assert np.exp(log).sum() == pytest.approx(1, abs=1e-5)
        # A tail leaf's words and its place for unknown ones fill its mass.
        for t, leaf in enumerate(known.tail_leaf[first]):
            mass = sum(n + 0.1 for k, n in words.items() if inside[k] == leaf) + 0.1
            assert mass == pytest.approx(known.tail_mass[first, t])


def test_three_levels_of_a_tree_lie_together():
    random = np.random.default_rng(4)
    trees = maxent.grow(random.integers(1, 1000, 600).astype(float), random.integers(0, 3, 600))
    assert len(np.unique(trees.line)) == len(trees.offset) and trees.line.max() < 8 * len(trees.offset)
    # One feature's weights of the nodes that begin at the same node share eight places, each with its own.
    marks, shape = np.full((1, 1), 77, dtype=np.uint32), maxent.Shape()
    slots = maxent.slots_of(marks, np.zeros(len(trees.line), dtype=np.int64), trees.line, shape)[0]
    for first in np.unique(trees.line // 8):
        own = slots[trees.line // 8 == first]
        assert len(np.unique(own // 8)) == 1 and len(np.unique(own)) == len(own)


def test_words_are_looked_up_like_in_a_sorted_list():
    random = np.random.default_rng(6)
    # Crowded first bits, the smallest and the largest hash among them.
    head = np.unique(np.concatenate([
        random.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2), np.arange(40, dtype=np.uint64),
        np.uint64((1 << 64) - 1) - np.arange(40, dtype=np.uint64),
    ]))
    one = np.zeros(len(head))
    known = maxent.Words(1, 1, head, one, one, one, one, one, maxent.grow(one[:0], one[:0]), maxent.Shape())
    keys = np.concatenate([head, head + np.uint64(1), random.integers(0, 1 << 63, 5000, dtype=np.uint64)])
    at, inside = known.look_up(keys)
    assert (inside == np.isin(keys, head)).all() and (head[at[inside]] == keys[inside]).all()


def _place(known, key):
    at, inside = known.look_up(np.array([key], dtype=np.uint64))
    return at[0], inside[0]


def _words_of(counts, known):
    for r in counts.collect():
        key = np.int64(r["word"]).view(np.uint64)
        at, inside = known.look_up(np.array([key]))
        yield key, r["n"], known.class_of(at, inside, np.array([r["suffix"]]))[0]


def test_mixing(docs, labels):
    rows = mixing.mix(docs, labels).collect()
    assert len(rows) == docs.count() and all(r["rate"] >= 0 for r in rows)
    assert mixing.mix(docs, labels.limit(0)).count() == docs.count() and mixing.mix(docs.limit(0), labels).isEmpty()


def test_rates_of_overlapping_domains_reach_their_targets(spark):
    lean = (F.col("doc_id") % 5 - 2) / 25
    members = spark.range(400).select(
        F.col("id").alias("doc_id"), (50 + F.col("id") % 100).alias("n_tokens")
    ).withColumn("p", F.array(F.lit(0.6), 0.2 + lean, 0.2 - lean))
    rated, gaps = mixing.fit_rates(members, {"clean": 0.6, "low": 0.22, "toxic": 0.18})
    rows = rated.collect()
    total = sum(r["n_tokens"] for r in rows)
    for k, (name, share) in enumerate((("clean", 0.6), ("low", 0.22), ("toxic", 0.18))):
        reached = sum(r["n_tokens"] * r["rate"] * r["p"][k] for r in rows) / total
        assert reached - share == pytest.approx(gaps[name], abs=1e-9) and abs(gaps[name]) <= 1e-5


def test_rates_say_which_gap_is_left(spark):
    """Documents of one domain cannot fill another."""
    members = spark.range(20).select(F.col("id").alias("doc_id"), F.lit(10).alias("n_tokens")).withColumn(
        "p", F.array(F.lit(1.0), F.lit(0.0), F.lit(0.0))
    )
    rated, gaps = mixing.fit_rates(members, {"clean": 0.5, "low": 0.5, "toxic": 0.0}, patience=3)
    assert gaps["low"] == -0.5 and abs(gaps["clean"]) < 0.05 and rated.count() == 20


def test_chat(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "hi"), (1, 2, "assistant", None), (1, 2, None, "x"), (None, 0, "user", "y")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.rotate(turns).collect()
    assert len(got) == 4 * 3 + 1
    mine = next(r for r in got if r["perspective"] == "user" and r["turn"] == 1)
    assert mine["segment"][mine["mask_start"] : mine["mask_end"]] == "hi<|im_end|>\n" and mine["trained"]
    assert chat.rotate(turns.limit(0)).isEmpty()


def test_warc(spark, tmp_path):
    body = "é<p>" * 9000
    rows = [(3, "http://a/\r\nb", body), (1, None, body), (2, "u", None), (5, "u", ""), (None, "u", "x\r\n\r\nWARC/1.1\r\n"), (1, None, body)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.round_trip(pages).collect()
    assert sorted((str(r["page_id"]), r["payload_bytes"], r["record_type"], r["refers_to"], r["problem"]) for r in got) == [
        ("1", 45_000, "response", None, None), ("1", 45_000, "response", None, None), ("2", 0, "response", None, None),
        ("3", 45_000, "revisit", 1, None), ("5", 0, "revisit", 2, None), ("None", 15, "response", None, None),
    ]
    warc.write(pages, str(tmp_path / "w"))
    whole = warc.read(spark, str(tmp_path / "w"), keep_payload=True).where("page_id = 1").first()
    assert bytes(whole["payload"]).decode() == body
    assert warc.unchunk(b"3\r\nab") == (b"", "chunk cut short")
    assert list(warc.parse(io.BytesIO(b""))) == []
    assert warc.round_trip(pages.limit(0)).isEmpty()


def test_urls(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://EXAMPLE.net/en/x?q"), (4, "http://x.net"), (5, "http://a.b.org/fr/1"), (6, "ftp://q.com/z")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in urls.judge(pages).collect()}
    assert got == {
        1: ("", "", None), 2: ("", "", None), 3: ("example.net", "/en/x", "example.net/en/"), 4: ("x.net", "", None),
        5: ("a.b.org", "/fr/1", "org/fr/"), 6: ("q.com", "/z", None),
    }
    assert urls.judge(pages.limit(0)).isEmpty()


def test_url_ratios_are_written_by_several_tasks(spark):
    known = spark.createDataFrame([(f"http://h{i}.net/p{i * i}", "allow" if i % 2 else "block") for i in range(60)], "url string, verdict string")
    # As with tables too large to broadcast or to coalesce.
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    kept = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        model = urls.fit(known, known)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert len(model.ratios.inputFiles()) > 1
    assert model.ratios.count() == model.ratios.select("gram").distinct().count() > 0


def test_pipeline_stages(spark, docs, items, labels, tmp_path):
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    now, left = docs, []
    for _, stage in corpus_pipeline.STAGES:
        now = corpus_pipeline.written(stage(spark, now, str(tmp_path)), "test")
        left.append(sorted(str(r[0]) for r in now.select("doc_id").collect()))
    assert left == [["1", "1", "2", "3", "6", "7"], *[["1", "6", "7"]] * 4]

"""The registered queries of the subpackage against DuckDB or a brute-force version, on whole tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from shopstrata.llm import urls
from shopstrata.llm.queries import ORACLES, QUERIES
from tests.compare import differences, open_oracle

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_counterpart(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), open_oracle(FOLDER), ORACLES[name]) == []


def _texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def test_language_model_base_is_exact_and_the_model_is_better(spark):
    split = {d: [*WORD.findall(t.translate(LOWER)), None] for d, t in _texts(spark).items()}
    counts = Counter()
    for d, ws in split.items():
        if zlib.crc32(str(d).encode()) % 10:
            counts.update(ws)
    total, kinds = sum(counts.values()), len(counts)
    rows = QUERIES["op1_lm_scoring"](spark, FOLDER).collect()
    assert len(rows) == len(split)
    for r in rows:
        ws = split[r["doc_id"]]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in ws)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(counts[w] > 0 for w in ws), total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0) and r["score"] < 0
    trained = [r for r in rows if not r["held_out"]]
    assert sum(r["score"] for r in trained) > sum(r["base_score"] for r in trained)


KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _valid(kind: str, hit: str) -> bool:
    digits = [int(c) for c in hit if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def base_spans(text: str) -> str:
    found = []
    for order, (kind, pattern) in enumerate(KINDS.items()):
        found += [
            (m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if _valid(kind, m.group())
        ]
    return ",".join(x[2] for x in sorted(found))


def test_base_personal_data_equals_brute_force(spark):
    texts = _texts(spark)
    rows = QUERIES["op3_pii"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        wanted = base_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(wanted.encode()).hexdigest()
        assert ",".join(s for s in r["spans"].split(",") if not s.startswith("id:")) == wanted
        assert r["n_card"] == wanted.count("card:")


def test_url_rules_and_model(spark):
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    rows = QUERIES["op8_url_filters"](spark, FOLDER).collect()
    assert len(rows) == len(pages)
    for r in rows:
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", pages[r["page_id"]] or "")
        host, path = (m.group(1).translate(LOWER), m.group(2)) if m else ("", "")
        fits = [
            (len(rule), rule, verdict) for verdict, rule in urls.RULES
            if (host == rule.split("/")[0] or host.endswith("." + rule.split("/")[0]))
            and path.startswith("/" + rule.split("/", 1)[1])
        ]
        assert (r["host"], r["path"]) == (host, path)
        assert r["rule"] == (max(fits)[1] if fits else None)
        assert r["verdict"] == max(fits)[2] if fits else r["verdict"] in ("allow", "block")


def test_secrets_are_the_assigned_tokens(spark):
    texts = _texts(spark)
    planted = sum(len(re.findall(r'token = "[0-9a-f]{40}"', t)) for t in texts.values())
    rows = QUERIES["op2_secret_scans"](spark, FOLDER).where("is_secret").collect()
    assert len(rows) == planted
    for r in rows:
        hit = texts[r["doc_id"]][r["start"] : r["end"]]
        assert hashlib.sha256(hit.encode()).hexdigest() == r["secret_sha256"]


def test_mixing_meets_its_targets(spark):
    rows = QUERIES["op5_mixing"](spark, FOLDER).collect()
    assert all(r["rate"] >= 0 for r in rows)
    total = sum(r["n_tokens"] for r in rows)
    for name, share in (("clean", 0.90), ("low", 0.07), ("toxic", 0.03)):
        reached = sum(r["n_tokens"] * r["rate"] * r[f"p_{name}"] for r in rows) / total
        assert reached == pytest.approx(share, abs=0.00002) and rows[0][f"gap_{name}"] == pytest.approx(reached - share, abs=1e-9)

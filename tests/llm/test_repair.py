"""Conversation repair against a plain search over all edits, in blocks of any size, and its edge cases."""

from __future__ import annotations

import hashlib
import heapq
import zlib
from random import Random

import pytest

from shopstrata.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, kind string, block string, mark string, cost string, dropped string"
SPACE = " \t\n\x0b\f\r"


def cheapest(rows: list[tuple[str, str, str]]) -> tuple[int, str, str]:
    """Cost, letters and repaired text of rows (role, text, fault): the first path that leaves the queue."""
    following = {"": "u", "s": "u", "u": "a", "a": "u"}
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, letters, i, state, out = heapq.heappop(queue)
        if i == len(rows) and state in ("", "a"):
            return cost, letters, "\n".join(out)
        if (i, state) in done:
            continue
        done.add((i, state))
        turn = following[state]
        name = "user" if turn == "u" else "assistant"
        heapq.heappush(queue, (cost + 2, letters + "I", i, turn, (*out, f"{name}:")))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(queue, (cost + 3, letters + "D", i + 1, state, out))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if role[:1] == turn or (role[:1] == "s" and state == ""):
                    heapq.heappush(queue, (cost + extra, letters + "K", i + 1, role[:1], (*out, f"{role}:{text}")))
                heapq.heappush(queue, (cost + 2 + extra, letters + "R", i + 1, turn, (*out, f"{name}:{text}")))
    raise AssertionError("no path")


def expected(rows):
    groups = {}
    for conv, turn, role, text, *_ in rows:
        groups.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
        groups[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for conv, turns in groups.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).digest()))
        known = {t for t, _, _ in turns if t is not None}
        found, seen = [], set()
        for _, role, text in turns:
            bare = text.rstrip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            found.append((role, text, fault))
        cost, letters, whole = cheapest(found)
        initials = [r[:1] for r, _, _ in found]
        yield (
            conv, max(known) - min(known) + 1 - len(known) if known else 0,
            *(sum(f == k for _, _, f in found) for k in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, letters, hashlib.sha256(whole.encode()).hexdigest(),
        )


def conversations(seed: int, longest: int):
    random = Random(seed)
    rows = []
    for conv in [None, *range(40)]:
        for turn in range(random.randrange(1, longest)):
            role = random.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = random.choice(["Yes.", "No!", "and then", "", " \t", None, f"Turn {turn}?", f"cut {turn}", "Über — \n alles."])
            rows.append((conv, random.choice([turn, turn, turn, turn + 3, None]), role, text, "x", "x", "x", "x", "x"))
    return rows


@pytest.mark.parametrize(("bits", "longest"), [(9, 9), (1, 30), (3, 60)])
def test_report_is_that_of_a_plain_search(spark, monkeypatch, bits, longest):
    monkeypatch.setattr(repair, "BLOCK_BITS", bits)
    rows = conversations(bits, longest)
    got = repair.report(repair.damage(spark.createDataFrame(rows, SCHEMA)))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected(rows), key=repr)


def test_long_conversation_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK_BITS", 4)
    rows = [(7, t, "user" if t % 3 else "assistant", f"Turn {t // 2}" + "." * (t % 5 > 0), *"xxxxx") for t in range(2500)]
    got = repair.report(repair.damage(spark.createDataFrame(rows, SCHEMA)))
    assert list(map(tuple, got.collect())) == list(expected(rows))


def test_turns_are_real_and_in_order(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "assistant", "Hello."), (1, 3, "user", "Why")]
    got = repair.repair(spark.createDataFrame([(*r, *"xxxxx") for r in rows], SCHEMA)).collect()
    audit = "".join(r["edit"] for r in sorted(got, key=lambda r: r["place"]))
    plain = [("system", "Be kind.", ""), ("assistant", "Hello.", ""), ("assistant", "Hello.", "duplicate"), ("user", "Why", "truncated")]
    assert audit == cheapest(plain)[1]
    left = [(r["role"], r["text"]) for r in sorted(got, key=lambda r: r["place"]) if r["edit"] != "D"]
    assert "\n".join(f"{a}:{b}" for a, b in left) == cheapest(plain)[2]


def test_empty_table_and_dropped_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.report(repair.damage(empty)).isEmpty() and repair.repair(empty).isEmpty()
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = repair.report(repair.damage(spark.createDataFrame([(gone, 0, "user", "Hi.", *"xxxxx")], SCHEMA))).collect()
    assert list(map(tuple, got)) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_prices_leave_every_cheapest_arc_tight():
    random = Random(5)
    for _ in range(300):
        codes = "".join(chr(65 + random.randrange(16)) for _ in range(random.randrange(12)))
        rows = []
        for code in codes:
            value = ord(code) - 65
            role = ("system", "user", "assistant", "tool")[value & 3]
            rows.append((role, "x", ("", "blank", "duplicate", "truncated")[value >> 2]))
        letters, lasts, cost = repair._traces(codes, repair.LAST)
        tail = {repair.SYSTEM: "II", repair.USER: "I"}.get(lasts[0], "")
        assert (cost, letters[0] + tail) == cheapest(rows)[:2]

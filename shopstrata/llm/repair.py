"""Repair of the turn structure of conversations by an auction for shortest paths.

The lattice of a conversation has a node for each number of turns read and each of four states of what has been
kept: nothing, a system turn, a last user turn, a last assistant turn. Arcs keep, rerole or delete the next turn or
insert an empty one, at integer costs. Every node has a price, at most the cost of an arc plus the price of the
arc's head. The auction starts a path at a node: where the last node's price is below its best arc it is raised to
that and the path contracts, otherwise the path is extended along the best arc, until it meets a node whose price is
final. Nodes start paths from the last turn to the first, and prices are kept from one start to the next, so a path
is short. At the end all prices are the costs to the end: an arc is on a cheapest path if and only if it is tight
(price = cost + price of its head), and the first tight arc in the order of the edits' letters is followed.

A conversation may be of any length. Its turns are dealt in order to blocks of at most ``BLOCK`` turns. Blocks are
solved side by side, once for each of the four states they can end in; only sixteen numbers a block are then folded
from the last block to the first, which gives the prices at the ends of all blocks, and each block traces its edits
from each of its four first states. One sweep over the turns, sorted by Spark, picks the right ones. It holds one
Arrow batch and the letters of one conversation; a checksum over a conversation is serial by its nature.

Edge cases: a null id is a conversation of its own. Null role or text is one space. Turns are ordered by turn (nulls
first), then role and checksum of the text. Extra columns are ignored. A conversation whose turns are all dropped by
``damage`` has a row with zeros, an empty audit and the checksum of the empty text; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopstrata.llm.columns import BLANKS
from shopstrata.llm.scratch import written

BLOCK_BITS = 9
BLOCK = 1 << BLOCK_BITS

# Costs of the edits.
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1

EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES = (EMPTY, SYSTEM, USER, ASSISTANT)
# The state after a further user or assistant turn; only one of the two fits in each state.
TURN = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
FAR = 1 << 40

# A turn's code is a letter for its role's initial (s, u, a, other) and its first fault.
INITIALS = "sua"
SOUND, IS_BLANK, IS_DUPLICATE, IS_CUT = range(4)


def _code(initial: Column, fault: Column) -> Column:
    place = F.instr(F.lit(INITIALS), initial)
    known = F.when((initial != "") & (place > 0), place - 1).otherwise(3)
    return F.char(F.lit(65) + known + 4 * fault)


def _meaning(code: str) -> tuple[int, int]:
    """State that the role's initial stands for (EMPTY: none), and the fault."""
    value = ord(code) - 65
    return (SYSTEM, USER, ASSISTANT, EMPTY)[value & 3], value >> 2


# --- the auction ------------------------------------------------------------------


def _arcs(code: str | None, after: tuple[int, ...], state: int) -> list[tuple[str, int, int, bool]]:
    """Letter, cost with the head's price where the head is a later node, state of the head, whether it is later."""
    arcs = [("I", INSERT, TURN[state], False)]
    if code is None:
        return arcs
    arcs.append(("D", DELETE + after[state], state, True))
    own, fault = _meaning(code)
    if fault in (IS_BLANK, IS_DUPLICATE):
        return arcs
    extra = CUT if fault == IS_CUT else 0
    if own == TURN[state]:
        arcs.append(("K", extra + after[own], own, True))
    elif own == SYSTEM and state == EMPTY:
        arcs.append(("K", extra + after[SYSTEM], SYSTEM, True))
    arcs.append(("R", REROLE + extra + after[TURN[state]], TURN[state], True))
    return arcs


def _layer(arcs: list[list[tuple[str, int, int, bool]]], fixed: dict[int, int]) -> tuple[int, ...]:
    """Final prices of the four nodes of a layer, those of later layers being final; ``fixed`` prices are given."""
    price = [fixed.get(q, 0) for q in STATES]
    final = [q in fixed for q in STATES]
    for origin in STATES:
        path = [origin]
        while not final[origin]:
            node = path[-1]
            best, head, later = FAR, node, True
            for _, cost, to, ahead in arcs[node]:
                total = cost if ahead else cost + price[to]
                if total < best:
                    best, head, later = total, to, ahead
            if price[node] < best:
                price[node] = best
                if len(path) > 1:
                    path.pop()  # contraction
            elif later or final[head]:
                for q in path:
                    final[q] = True
            else:
                path.append(head)  # extension
    return tuple(min(p, FAR) for p in price)


# The states from which a block can end in a state: turns can always be deleted, and user and assistant ones inserted.
_FROM = {EMPTY: (EMPTY,), SYSTEM: (EMPTY, SYSTEM), USER: STATES, ASSISTANT: STATES}


def _prices(codes: str, ends: tuple[int, ...]) -> list[tuple[int, ...]]:
    """Prices of all nodes of a block, layer by layer, given those of its end."""
    reach = {q for end in STATES if ends[end] < FAR for q in _FROM[end]}
    fixed = {q: FAR for q in STATES if q not in reach}
    layers = [ends]
    for code in reversed(codes):
        layers.append(_layer([_arcs(code, layers[-1], q) for q in STATES], fixed))
    return layers[::-1]


# After the last turn a path may end where nothing was kept or an assistant turn is last.
LAST = _layer([_arcs(None, (), q) for q in STATES], {EMPTY: 0, ASSISTANT: 0})


@lru_cache(1 << 15)
def _costs(codes: str) -> tuple[int, ...]:
    """Costs from each first state to each last one, row by row."""
    columns = [_prices(codes, tuple(0 if q == end else FAR for q in STATES))[0] for end in STATES]
    return tuple(columns[end][q] for q in STATES for end in STATES)


@lru_cache(1 << 15)
def _traces(codes: str, ends: tuple[int, ...]) -> tuple[tuple[str, ...], tuple[int, ...], int]:
    """The edits from each first state, the states they end in, and the price of the state EMPTY."""
    layers = _prices(codes, ends)
    letters, lasts = [], []
    for state in STATES:
        found, at, dead = [], 0, layers[0][state] >= FAR
        while at < len(codes) and not dead:
            now = layers[at]
            tight = [
                (letter, to, later)
                for letter, cost, to, later in _arcs(codes[at], layers[at + 1], state)
                if (cost if later else cost + now[to]) == now[state]
            ]
            letter, state, later = min(tight)
            found.append(letter)
            at += later
        letters.append("".join(found))
        lasts.append(state)
    return tuple(letters), tuple(lasts), layers[0][EMPTY]


# --- Spark ------------------------------------------------------------------------


def _plain(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    space = F.lit(" ")
    return rows.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"),
        F.coalesce(F.col(role_col), space).alias("role"), F.coalesce(F.col(text_col), space).alias("text"),
    )


def damage(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id, turn, role, text, dropped``: rows with faults put in by the checksum of their place. Dropped rows
    stay, marked, so that their conversation is known."""
    plain = _plain(rows, conv_col, turn_col, role_col, text_col)

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    return plain.withColumn("_kind", kind).select(
        "conv_id", "turn",
        F.when(F.col("_kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, F.lit("")).when(F.col("_kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        (F.col("_kind") == 0).alias("dropped"),
        F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


_ORDER = ("conv_id", "turn", "role", "mark")


def _sorted_by() -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in _ORDER]


def _blocks(rows: DataFrame) -> DataFrame:
    """``conv_id, block, codes, turn, role, mark``: the codes of each block's turns in order, and its first turn's place.
    No texts travel here."""
    bare = F.rtrim("text", F.lit(BLANKS))
    slim = rows.select(
        "conv_id", "turn", "role", "mark",
        F.when(bare == "", IS_BLANK).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), IS_CUT).otherwise(SOUND)
        .alias("fault"),
    )
    # The place is written once, so that it cannot change when a task is run again.
    placed = written(
        slim.repartitionByRange(*_sorted_by()).sortWithinPartitions(*_sorted_by())
        .withColumn("at", F.monotonically_increasing_id()),
        "turns",
    )
    same = Window.partitionBy("conv_id", "role", "mark").orderBy("at")
    seen = F.row_number().over(same) > 1
    fault = F.when(F.col("fault") == IS_BLANK, IS_BLANK).when(seen, IS_DUPLICATE).otherwise(F.col("fault"))
    coded = placed.withColumn("code", _code(F.left("role", F.lit(1)), fault))
    first = F.min_by(F.struct("turn", "role", "mark"), "at")
    return coded.groupBy("conv_id", F.shiftright("at", BLOCK_BITS).alias("block")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "code"))), lambda x: x["code"]), "").alias("codes"),
        first.alias("first"),
    ).select("conv_id", "block", "codes", "first.*")


def _mapped(frame: DataFrame, added: str, values) -> DataFrame:
    """``frame`` with columns that ``values`` gets from each row as a dict; rows are taken batch by batch."""
    names = [c.split()[0] for c in added.split(", ")]
    schema = frame.select("*", *(F.lit(None).cast(c.split(" ", 1)[1]).alias(c.split()[0]) for c in added.split(", "))).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = values()
        for batch in batches:
            found = [step(r) for r in batch.to_pylist()]
            columns = [pa.array([f[i] for f in found], _ARROW[n]) for i, n in enumerate(names)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *names])

    return frame.mapInArrow(run, schema)


_NUMBERS = pa.list_(pa.int64())
_ARROW = {"costs": _NUMBERS, "ends": _NUMBERS, "letters": pa.list_(pa.string()), "lasts": _NUMBERS, "cost": pa.int64()}


def _cost_step():
    return lambda r: (list(_costs(r["codes"])),)


def _fold_step():
    """Prices at the end of each block, the blocks of a conversation coming last first."""
    state: dict = {"conv": None, "ends": None}

    def step(r):
        if state["ends"] is None or r["conv_id"] != state["conv"]:
            state["conv"], state["ends"] = r["conv_id"], LAST
        ends, costs = state["ends"], r["costs"]
        state["ends"] = tuple(min(FAR, *(costs[4 * q + e] + ends[e] for e in STATES)) for q in STATES)
        return (list(ends),)

    return step


def _trace_step():
    def step(r):
        letters, lasts, cost = _traces(r["codes"], tuple(r["ends"]))
        return list(letters), list(lasts), cost

    return step


def plan(rows: DataFrame) -> DataFrame:
    """The cheapest edits block by block: ``conv_id, block, codes``, the place of the block's first turn, and from each
    of the four states the edits' ``letters``, the state reached (``lasts``) and the ``cost`` from the state EMPTY to
    the end of the conversation."""
    solved = _mapped(_blocks(rows), "costs array<bigint>", _cost_step)
    backwards = solved.repartition("conv_id").sortWithinPartitions("conv_id", F.col("block").desc())
    folded = _mapped(backwards, "ends array<bigint>", _fold_step).drop("costs")
    # Dealt anew, so that the blocks of one long conversation are traced side by side.
    dealt = folded.repartition("conv_id", "block")
    return _mapped(dealt, "letters array<string>, lasts array<bigint>, cost bigint", _trace_step).drop("ends")


class _Conversation:
    """One conversation as the sweep meets it: its blocks' edits, then its turns."""

    def __init__(self) -> None:
        self.letters: deque[str] = deque()
        self.entry = self.state = EMPTY
        self.cost: int | None = None
        self.audit: list[str] = []
        self.faults = [0, 0, 0, 0]
        self.illegal = self.turns = 0
        self.last_code: str | None = None
        self.low = self.high = None
        self.place = 0
        self.hash = hashlib.sha256()

    def block(self, codes: str, letters: list[str], lasts: list[int], cost: int) -> None:
        if self.cost is None:
            self.cost = cost
        self.letters.extend(letters[self.entry])
        self.entry = lasts[self.entry]
        for code in codes:
            own, fault = _meaning(code)
            self.faults[fault] += 1
            if self.last_code is not None and (_meaning(self.last_code)[0], own) not in _LEGAL:
                self.illegal += 1
            self.last_code = code

    def turn(self, turn: int | None, role: str, text: str) -> list[tuple[str, str, str]]:
        if turn is not None and turn != self.high:
            self.low, self.high = turn if self.low is None else self.low, turn
            self.turns += 1
        edits = []
        while (letter := self.letters.popleft()) == "I":
            edits.append(self._inserted())
        if letter == "K":
            own = role[:1]
            self.state = SYSTEM if own == "s" else TURN[self.state]
        elif letter == "R":
            self.state = TURN[self.state]
            role = ROLE[self.state]
        edits.append((letter, role, text))
        return edits

    def end(self) -> list[tuple[str, str, str]]:
        edits = []
        while self.state in (SYSTEM, USER):
            edits.append(self._inserted())
        return edits

    def _inserted(self) -> tuple[str, str, str]:
        self.state = TURN[self.state]
        return "I", ROLE[self.state], ""

    def digest(self, edits: list[tuple[str, str, str]]) -> None:
        for letter, role, text in edits:
            self.audit.append(letter)
            if letter != "D":
                self.hash.update(f"{chr(10) if self.place else ''}{role}:{text}".encode())
                self.place += 1

    def report(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (
            gaps, self.faults[IS_BLANK], self.faults[IS_DUPLICATE], self.faults[IS_CUT], self.illegal,
            self.cost or 0, "".join(self.audit), self.hash.hexdigest(),
        )


_LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
_REPORT = [
    ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
    ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string()),
]
_TURNS = [("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]


def _sweep(whole: bool):
    """Over turns in order, with each block's edits before its first turn: a report a conversation, or its turns."""
    fields = _REPORT if whole else _TURNS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, at, out, kind = None, None, [], pa.int64()

        def packed() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * (1 + len(fields))
            arrays = [pa.array(c, t) for c, t in zip(columns, [kind, *(t for _, t in fields)])]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["conv_id", *(n for n, _ in fields)])

        def emit(edits) -> None:
            if whole:
                conv.digest(edits)
            else:
                for edit in edits:
                    out.append((at, conv.place, *edit))
                    conv.place += 1

        def close() -> None:
            if conv is not None:
                emit(conv.end())
                if whole:
                    out.append((at, *conv.report()))

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for r in batch.to_pylist():
                if conv is None or r["conv_id"] != at:
                    close()
                    conv, at = _Conversation(), r["conv_id"]
                if r["kind"] == 0:
                    conv.block(r["codes"], r["letters"], r["lasts"], r["cost"])
                elif r["kind"] == 1:
                    emit(conv.turn(r["turn"], r["role"], r["text"]))
                if len(out) >= 4096:
                    yield packed()
            yield packed()
        close()
        yield packed()

    return run


def _swept(rows: DataFrame, whole: bool) -> DataFrame:
    marked = rows.withColumn("mark", F.unhex(F.sha2("text", 256)))
    kept = marked.where(~F.col("dropped")).drop("dropped")
    turns = marked.withColumn("kind", F.when(F.col("dropped"), 2).otherwise(1)).drop("dropped")
    edits = plan(kept).withColumn("kind", F.lit(0))
    both = turns.unionByName(edits, allowMissingColumns=True)
    order = [*_sorted_by(), F.col("kind"), F.col("block")]
    kind = rows.schema["conv_id"].dataType.simpleString()
    spark_types = {pa.int64(): "bigint", pa.string(): "string"}
    schema = ", ".join([f"conv_id {kind}", *(f"{n} {spark_types[t]}" for n, t in (_REPORT if whole else _TURNS))])
    return both.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_sweep(whole), schema)


def _undamaged(rows: DataFrame, *columns: str) -> DataFrame:
    plain = _plain(rows, *columns)
    return plain.withColumn("dropped", F.lit(False))


def repair(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """The edited turns: ``conv_id, place, edit, role, text`` with edits K(eep), R(erole), D(elete) and I(nsert); without
    the deleted turns they are the repaired conversation."""
    return _swept(_undamaged(rows, conv_col, turn_col, role_col, text_col), whole=False)


def report(damaged: DataFrame) -> DataFrame:
    """One row per conversation of what ``damage`` returns: its faults, the cost and letters of the cheapest edits, and the
    checksum of the repaired turns."""
    return _swept(damaged, whole=True)


_BLANK = r"[\x20\x09-\x0D]"


def _best(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


def _way(state: str, cost: str, letters: str, when: str = "true") -> str:
    return f"{{'c': CASE WHEN {when} THEN {state}.c + {cost} ELSE 1000000000 END, 's': {state}.s || '{letters}'}}"


# The same edits by dynamic programming over the turns: the least (cost, letters) of each state after each turn.
ORACLE = rf"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS t
), plain AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') AS conv, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS place
  FROM conversations
), marked AS (
  SELECT plain.*, xor(list_reduce(list_transform(range(1, length(place) + 1), lambda i: ord(place[i])::BIGINT),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295) % 20 AS kind
  FROM plain, crc
), damaged AS (
  SELECT conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM marked, range(CASE WHEN kind = 3 THEN 2 ELSE 1 END) WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
    regexp_replace(text, '{_BLANK}+$', '') AS bare
  FROM damaged
), seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 AS again, left(role, 1) AS ini,
    lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY i) AS before
  FROM placed
), turns AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN again THEN 'duplicate'
    WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    i > 1 AND before || ini NOT IN ('su', 'ua', 'au') AS odd
  FROM seen
), steps AS (
  SELECT conv, i, ini, fault IN ('', 'truncated') AS usable, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS cut FROM turns
), lattice AS (
  SELECT DISTINCT conv, 0::BIGINT AS i, {{'c': 0, 's': ''}} AS e, {{'c': 1000000000, 's': ''}} AS s,
    {{'c': 1000000000, 's': ''}} AS u, {{'c': 1000000000, 's': ''}} AS a
  FROM steps
  UNION ALL
  SELECT conv, i, {_way('e', '3', 'D')},
    {_best(_way('s', '3', 'D'), _way('e', 'cut', 'K', "usable AND ini = 's'"))},
    {_best(_way('u', '3', 'D'), *(_way(q, *w) for q in 'esa' for w in
        (('cut', 'K', "usable AND ini = 'u'"), ('cut + 2', 'R', 'usable'))))},
    {_best(_way('a', '3', 'D'), _way('u', 'cut', 'K', "usable AND ini = 'a'"), _way('u', 'cut + 2', 'R', 'usable'))}
  FROM (
    SELECT l.conv, n.i, n.ini, n.usable, n.cut, l.e, l.s,
      {_best('l.u', _way('l.e', '2', 'I'), _way('l.s', '2', 'I'), _way('l.a', '2', 'I'))} AS u,
      {_best('l.a', _way('l.u', '2', 'I'), _way('l.e', '4', 'II'), _way('l.s', '4', 'II'))} AS a
    FROM lattice l JOIN steps n ON n.conv = l.conv AND n.i = l.i + 1
  )
), best AS (
  SELECT conv, {_best('e', 'a', _way('u', '2', 'I'), _way('e', '4', 'II'), _way('s', '4', 'II'))} AS found
  FROM (SELECT *, max(i) OVER (PARTITION BY conv) AS n FROM lattice) WHERE i = n
), letters AS (
  SELECT conv, p, found.s[p] AS letter,
    count(*) FILTER (found.s[p] <> 'I') OVER w AS i, count(*) FILTER (found.s[p] <> 'D') OVER w AS k
  FROM best, range(1, length(found.s) + 1) AS r(p) WINDOW w AS (PARTITION BY conv ORDER BY p)
), kept AS (
  SELECT l.*, t.role AS own, t.text,
    bool_or(k = 1 AND letter = 'K' AND t.ini = 's') OVER (PARTITION BY l.conv) AS opened
  FROM letters l LEFT JOIN turns t ON t.conv = l.conv AND t.i = l.i AND l.letter <> 'I' WHERE letter <> 'D'
), repaired AS (
  SELECT conv, string_agg(CASE WHEN letter = 'K' THEN own WHEN (k - opened::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || coalesce(text, ''), chr(10) ORDER BY p) AS whole
  FROM kept GROUP BY conv
), counted AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (odd) AS illegal
  FROM turns GROUP BY conv
)
SELECT p.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(found.c, 0)::BIGINT AS cost, coalesce(found.s, '') AS audit,
  sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, conv FROM plain) p
LEFT JOIN counted USING (conv) LEFT JOIN best USING (conv) LEFT JOIN repaired USING (conv)
"""

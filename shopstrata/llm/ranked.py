"""Ranked lexical search for many queries at once, with the sums that queries share computed once.

An item's score of a document is a sum over the item's terms, so a set of terms that several items share is a
common subexpression. The steps, for each block of items:

1. look the items' terms up in all documents: a posting row per document (its length, terms and counts), written;
2. count from it the documents with terms, all their terms, and the documents of each item term;
3. mine shared term sets: the parts of each item stand in the order of how many items have them, neighbours are
   counted, and a pair of neighbours that two or more items have becomes a part of its own, in all items that have
   both; repeated until no pair is shared. The parts are the nodes of a DAG over the items' terms;
4. for each batch of documents, fill the accumulators of the terms, add up each shared node once from its two parts,
   level by level, and an item from the few nodes left to it; keep each item's best documents;
5. merge the tasks' best documents, ``top`` an item and task.

A block of items has some ``block_terms`` terms (a single item is never split), so vocabulary, DAG and accumulators are
bounded whatever the number of items; documents are looked through once a block. Terms are told apart by 64-bit
hashes. All sums are 64-bit integers.

Edge cases: null and empty text have no terms; such documents are never found and such items find nothing. Rows that
repeat an item give its rows again. Rows that repeat a document are ranked each. Equal scores go by ascending id,
null ids last. Extra columns are ignored. With no documents or items there are no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopstrata.llm.scratch import written
from shopstrata.llm.wordhash import ALNUM_WORDS, words

# Fixed values of the ranking.
SCALE, UNIT, MIX, FLOOR, SLOPE, WEIGHT = 1_000_000_000, 1000, 8, 25, 75, 1000

_CELLS = 1 << 22  # accumulators held at once by a task


def _portions(batches: Iterator[pa.RecordBatch], size: int = 1 << 18):
    """Slices of batches with the hashes of their terms and the row that each term is in."""
    for batch in batches:
        texts, held, first = [], 0, 0
        for i, text in enumerate(batch.column("text")):
            texts.append(text.as_py().encode())
            held += len(texts[-1])
            if held < size and i < batch.num_rows - 1:
                continue
            hashes, starts, _ = words(b"\n".join(texts), ALNUM_WORDS)
            row = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right")
            yield batch.slice(first, len(texts)), hashes, row
            texts, held, first = [], 0, i + 1


def _grouped(row: np.ndarray, term: np.ndarray, kinds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, terms and counts of the pairs, in that order; terms are below ``kinds``."""
    pairs, counts = np.unique(row.astype(np.int64) * kinds + term, return_counts=True)
    return pairs // kinds, pairs % kinds, counts


def _lists(row: np.ndarray, values: np.ndarray, rows: int) -> pa.Array:
    offsets = np.append(0, np.cumsum(np.bincount(row, minlength=rows))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


# --- items ------------------------------------------------------------------------


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, hashes, row in _portions(batches):
        kinds, place = np.unique(hashes, return_inverse=True)
        owner, term, counts = _grouped(row, place, max(len(kinds), 1))
        yield pa.RecordBatch.from_arrays(
            [batch.column("no"), _lists(owner, kinds[term].view(np.int64), batch.num_rows),
             _lists(owner, counts.astype(np.int64), batch.num_rows)],
            names=["no", "terms", "counts"],
        )


@dataclass(frozen=True)
class Sharing:
    """The DAG of a block: nodes below ``len(terms)`` are terms, each later one is the sum of two earlier ones."""

    terms: np.ndarray  # sorted hashes
    levels: list[tuple[np.ndarray, np.ndarray]]  # the two parts of each shared node, nodes of a level in a row
    items: list[tuple[int, np.ndarray]]  # number of an item and the nodes that add up to it

    @property
    def nodes(self) -> int:
        return len(self.terms) + sum(len(a) for a, _ in self.levels)


def share(items: list[tuple[int, list[int], list[int]]]) -> Sharing:
    """Mine the shared term sets of ``(number, terms, counts)``; a term that is repeated counts as several parts."""
    terms = np.unique(np.array([t for _, ts, _ in items for t in ts], dtype=np.int64).view(np.uint64))
    place = {int(t): i for i, t in enumerate(terms.view(np.int64))}
    # A part is a node and a running number, so that an item can hold a term several times.
    parts = [{(place[t], k) for t, n in zip(ts, ns) for k in range(n)} for _, ts, ns in items]
    owners: dict[tuple[int, int], set[int]] = {}
    for i, held in enumerate(parts):
        for part in held:
            owners.setdefault(part, set()).add(i)
    made, levels = len(terms), []
    while True:
        pairs: Counter = Counter()
        for held in parts:
            ordered = sorted((p for p in held if len(owners[p]) > 1), key=lambda p: (-len(owners[p]), p))
            pairs.update(zip(ordered, ordered[1:]))
        level = []
        for (a, b), often in sorted(pairs.items(), key=lambda x: (-x[1], x[0])):
            both = owners[a] & owners[b] if often > 1 else ()
            if len(both) < 2:
                continue
            new = (made + len(level), 0)
            level.append((a[0], b[0]))
            owners[new] = set(both)
            owners[a] -= both
            owners[b] -= both
            for i in both:
                parts[i] -= {a, b}
                parts[i].add(new)
        if not level:
            break
        levels.append(tuple(np.array(side) for side in zip(*level)))
        made += len(level)
    nodes = [np.array(sorted(node for node, _ in held), dtype=np.int64) for held in parts]
    return Sharing(terms, levels, [(no, n) for (no, _, _), n in zip(items, nodes)])


# --- documents ----------------------------------------------------------------------

_POSTINGS = "doc_id long, n long, terms array<int>, tf array<int>"


def _postings(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch, hashes, row in _portions(batches):
            n = np.bincount(row, minlength=batch.num_rows)
            at = np.searchsorted(known, hashes)
            at[at == len(known)] = 0
            inside = known[at] == hashes
            owner, term, tf = _grouped(row[inside], at[inside], len(known))
            full = pa.array(n > 0)
            found = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n.astype(np.int64)),
                 _lists(owner, term.astype(np.int32), batch.num_rows), _lists(owner, tf.astype(np.int32), batch.num_rows)],
                names=["doc_id", "n", "terms", "tf"],
            )
            yield found.filter(full)

    return run


def _document_counts(kinds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(kinds, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=kinds)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["term", "df"])

    return run


class _Best:
    """The best documents of each item so far."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.least = np.ones(items, dtype=np.int64)
        empty = np.zeros(0, np.int64)
        self.kept = [(empty, empty.astype(bool), empty)] * items

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        good = scores >= self.least[:, None]
        for i in np.flatnonzero(good.any(axis=1)):
            at = np.flatnonzero(good[i])
            columns = [np.concatenate(c) for c in zip(self.kept[i], (scores[i, at], missing[at], ids[at]))]
            order = np.lexsort((columns[2], columns[1], -columns[0]))[: self.top]
            self.kept[i] = tuple(c[order] for c in columns)
            if len(order) == self.top:
                self.least[i] = columns[0][order[-1]]


def _accumulate(dag: Sharing, row: np.ndarray, term: np.ndarray, value: np.ndarray, docs: int) -> np.ndarray:
    """Scores of ``docs`` documents for the DAG's items from the values of their postings."""
    sums = np.zeros((dag.nodes, docs), dtype=np.int64)
    sums[term, row] = value
    at = len(dag.terms)
    for a, b in dag.levels:
        np.add(sums[a], sums[b], out=sums[at : at + len(a)])
        at += len(a)
    scores = np.empty((len(dag.items), docs), dtype=np.int64)
    for i, (_, nodes) in enumerate(dag.items):
        np.sum(sums[nodes], axis=0, out=scores[i])
    return scores


def _score(shared, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dag, weights, documents, length = shared.value
        best = _Best(len(dag.items), top)
        step = max(1, _CELLS // dag.nodes)
        for whole in batches:
            for first in range(0, whole.num_rows, step):
                batch = whole.slice(first, step)
                ids = batch.column("doc_id")
                terms, tf = batch.column("terms"), batch.column("tf").flatten().to_numpy().astype(np.int64)
                row = np.repeat(np.arange(batch.num_rows), np.diff(terms.offsets.to_numpy()))
                term = terms.flatten().to_numpy()
                m = FLOOR + SLOPE * batch.column("n").to_numpy() * documents // length
                value = weights[term] * (SCALE * tf // (UNIT * tf + MIX * m[row]))
                scores = _accumulate(dag, row, term, value, batch.num_rows)
                best.add(scores, ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False))
        out = [(no, *found) for (no, _), kept in zip(dag.items, best.kept) for found in zip(*kept)]
        columns = list(zip(*out)) or [()] * 4
        ids = pa.array(np.array(columns[3], np.int64), mask=np.array(columns[2], bool))
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), ids, pa.array(np.array(columns[1], np.int64))], names=["no", "doc_id", "score"]
        )

    return run


def _block(docs: DataFrame, items: list[tuple[int, list[int], list[int]]], top: int) -> DataFrame | None:
    context = docs.sparkSession.sparkContext
    dag = share(items)
    if not len(dag.terms):
        return None
    postings = written(docs.mapInArrow(_postings(context.broadcast(dag.terms)), _POSTINGS), "postings")
    totals = postings.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not totals[0]:
        return None
    df = np.zeros(len(dag.terms), dtype=np.int64)
    counted = postings.select("terms").mapInArrow(_document_counts(len(df)), "term int, df long")
    for term, many in counted.groupBy("term").agg(F.sum("df")).collect():  # a row per term of the block
        df[term] = many
    weights = np.array([math.floor(WEIGHT * math.log((2 * totals[0] + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)
    shared = context.broadcast((dag, weights, totals[0], totals[1]))
    return postings.mapInArrow(_score(shared, top), "no long, doc_id long, score long")


def rank(
    docs: DataFrame, items: DataFrame, top: int = 10, block_terms: int = 1 << 17, id_col: str = "doc_id",
    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each item with a score above 0."""
    numbered = written(
        items.select(
            F.monotonically_increasing_id().alias("no"), F.col(item_col).alias("item_id"),
            F.coalesce(F.col(item_text_col), F.lit("")).alias("text"),
        ),
        "items",
    )
    listed = written(
        numbered.select("no", "text").mapInArrow(_item_terms, "no long, terms array<long>, counts array<long>"), "item-terms"
    )
    total = listed.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_terms))
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).where(F.col("text") != "")
    found = docs.sparkSession.createDataFrame([], "no long, doc_id long, score long")
    for block in range(blocks):
        mine = listed.where(F.pmod(F.xxhash64("no"), F.lit(blocks)) == block).orderBy("no")
        best = _block(texts, [tuple(r) for r in mine.collect()], top)  # some block_terms terms
        found = found if best is None else found.unionByName(best)
    order = Window.partitionBy("no").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(numbered.select("no", "item_id"), "no").select("item_id", "rank", "doc_id", "score")


def _terms_sql(table: str) -> str:
    return rf"""regexp_extract_all(translate(coalesce({table}.text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_terms_sql('documents')} AS ws FROM documents),
b AS (SELECT row_number() OVER () AS q, item_id, {_terms_sql('benchmark')} AS ws FROM benchmark),
totals AS (SELECT count(*)::BIGINT AS n_docs, sum(len(ws))::BIGINT AS n_terms FROM d WHERE len(ws) > 0),
asked AS (SELECT q, item_id, term, count(*)::BIGINT AS often FROM (SELECT q, item_id, unnest(ws) AS term FROM b) GROUP BY ALL),
tf AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ws) AS term FROM d)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, totals GROUP BY term, n_docs),
m AS (SELECT r, doc_id, 100 - 75 + ((75 * len(ws)::BIGINT * n_docs) // n_terms) AS m FROM d, totals WHERE len(ws) > 0),
impact AS (SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * m)) AS x
  FROM tf JOIN w USING (term) JOIN m USING (r)),
scored AS (SELECT q, item_id, r, doc_id, sum(often * x)::BIGINT AS score FROM asked JOIN impact USING (term) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

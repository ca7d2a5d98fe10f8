"""N-gram Jaccard join by chosen paths.

Documents are sets of five-word shingles (one shingle of all words if there are fewer).
Documents with equal sets form a class, and the join runs over the classes:

1. In each run every set samples, at each level, the shingles whose hash for that run and
   level lies below 1 / (threshold * size): 1 / threshold of them on average. Two sets that
   share most shingles sample the same ones.
2. A sampled shingle is a bucket. Buckets of at most ``limit`` sets are compared by brute
   force; larger ones are split again on the shingles sampled at the next level, but only
   where that at least halves the comparisons: sets that resemble each other would meet again
   in every part. Large buckets that are not split, and those of the last level, are compared
   in pairs of blocks, which hold at most about ``BLOCK`` sets and ``MASS`` shingles.
3. Each pair belongs to the first bucket that both sets are in, so it is compared
   once, and no list of pairs is ever made: a task returns per set its number
   of links and one edge to the smallest set of its local group.

Runs are repeated until the recall target is met in the worst case, which is a pair right
at the threshold whose common shingles are all so frequent that every level is needed (see
``runs_for``). Pairs with a common shingle of their own are found at the first level.

Edge cases: null and empty text have no words and no shingles; such a document is a class
and a group of its own, with no links, also if there are several. Rows that repeat a
document, id included, are copies like any other. Only id and text are read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopstrata.llm.scratch import written
from shopstrata.llm.wordhash import BLANK_WORDS, mix, shingles, words

LIMIT = 256
LEVELS = 3
BLOCK = 1024
MASS = 1 << 20


def runs_for(recall: float, levels: int = LEVELS) -> int:
    """Runs after which a pair at the threshold is missed with a chance of at most 1 - ``recall``.

    Such a pair samples a common shingle with a chance of 1 - 1/e a level. A level's sample is the same in
    every bucket of a run, so a pair whose buckets are all split needs a common one at each level.
    """
    hit = (1 - math.exp(-1)) ** levels
    return math.ceil(math.log(1 - recall) / math.log(1 - hit))


def shingle_set(text: bytes, size: int) -> np.ndarray:
    hashes, _, _ = words(text, BLANK_WORDS)
    return np.unique(shingles(hashes, min(size, len(hashes)))) if len(hashes) else np.zeros(0, np.uint64)


_SKETCH = "doc_id long, text_key long, n long, cls long, cls2 long, sampled array<array<long>>"


def _sketch(size: int, threshold: float, runs: int, levels: int):
    seeds = mix(np.arange(1, runs * levels + 1, dtype=np.uint64))[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(4)]
            for text in batch.column("text"):
                found = shingle_set(text.as_py().encode(), size)
                sampled: list[list[int]] = [[] for _ in range(runs * levels)]
                if len(found):
                    below = np.uint64(min(2**64 - 1, int(2**64 / (threshold * len(found)))))
                    for at in range(0, len(found), 4096):
                        part = found[at : at + 4096]
                        which, where = np.nonzero(mix(part[None, :] ^ seeds) < below)
                        for k, token in zip(which.tolist(), part[where].view(np.int64).tolist()):
                            sampled[k].append(token)
                with np.errstate(over="ignore"):
                    sums = [int(mix(found).sum()), int(mix(found ^ seeds[0]).sum())] if len(found) else [0, 0]
                out[0].append(len(found))
                out[1].append(sums[0] - 2**64 if sums[0] >= 2**63 else sums[0])
                out[2].append(sums[1] - 2**64 if sums[1] >= 2**63 else sums[1])
                out[3].append(sampled)
            arrays = [batch.column("doc_id"), batch.column("text_key"), *(pa.array(c, pa.int64()) for c in out[:3])]
            arrays.append(pa.array(out[3], pa.list_(pa.list_(pa.int64()))))
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text_key", "n", "cls", "cls2", "sampled"])

    return run


def _buckets(classes: DataFrame, runs: int, levels: int, limit: int) -> DataFrame:
    """``bucket, size, cls``: the buckets to be compared, each with at least two sets."""
    sampled = classes.select("cls", "sampled")

    def level_tokens(run, level: int):
        return F.get("sampled", run * levels + level)

    starts = sampled.select("cls", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run"), "sampled").select(
        "cls", "run", F.explode(level_tokens(F.col("run"), 0)).alias("token")
    )
    entries = starts.select("cls", "run", F.xxhash64("run", "token").alias("bucket"))
    finals = []
    for level in range(levels):
        entries = written(entries, f"entries-{level}")  # counted and joined below
        counts = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        sized = written(entries.join(counts, "bucket"), f"path-{level}")
        if level == levels - 1:
            finals.append(sized)
            break
        finals.append(sized.where(F.col("size") <= limit))
        # Only sets in large buckets go on, and of those only the tokens of the next level.
        large = sized.where(F.col("size") > limit)
        tokens = sampled.select(F.col("cls").alias("_cls"), "sampled")
        parts = written(
            large.join(tokens, F.col("cls") == F.col("_cls"))
            .select("cls", "run", "bucket", "size", F.explode(level_tokens(F.col("run"), level + 1)).alias("token"))
            .select("cls", "run", F.col("bucket").alias("whole"), "size", F.xxhash64("bucket", "token").alias("bucket")),
            f"parts-{level}",
        )
        # One row a large bucket: those whose parts take more than half of its comparisons stay whole.
        part = parts.groupBy("whole", "size", "bucket").agg(F.count(F.lit(1)).cast("double").alias("sets"))
        whole = written(
            part.groupBy("whole", "size").agg(F.sum(F.col("sets") * F.col("sets")).alias("work"))
            .where(F.col("work") > F.col("size").cast("double") * F.col("size") / 2).select("whole"),
            f"whole-{level}",
        )
        finals.append(large.join(whole.withColumnRenamed("whole", "bucket"), "bucket", "left_semi"))
        entries = parts.join(whole, "whole", "left_anti").select("cls", "run", "bucket")
    union = finals[0]
    for more in finals[1:]:
        union = union.unionByName(more)
    union = union.select("bucket", "size", "cls")
    # Buckets of exactly the same sets are compared once.
    signature = union.groupBy("bucket").agg(
        F.first("size").alias("size"), F.sum(F.xxhash64("cls").cast("decimal(20,0)")).alias("sum"),
        F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("xor"),
    )
    kept = signature.groupBy("size", "sum", "xor").agg(F.min("bucket").alias("bucket")).select("bucket")
    return union.join(kept, "bucket").select("bucket", "size", "cls")


def _owned(n: np.ndarray, paths: list[np.ndarray], bucket: int, threshold: float, blocks: np.ndarray, left: int, right: int):
    """Which pairs of a group belong to its bucket and can reach the threshold by their sizes alone.

    The pairs within block k belong to the group of blocks k - 1 and k, those within block 0 to the
    group of 0 and 1, so that a bucket of several blocks needs no groups of single blocks.
    """
    ids, held = np.unique(np.concatenate(paths), return_counts=True)
    before = ids[(ids < bucket) & (held > 1)]  # a bucket of one row alone has no pair here
    member = np.zeros((len(n), len(before)), dtype=np.float32)
    for row, path in enumerate(paths):
        member[row, np.searchsorted(before, path[np.isin(path, before)])] = 1
    wanted = (member @ member.T) == 0
    low = np.minimum.outer(n, n)
    wanted &= low >= threshold * np.maximum.outer(n, n) - 1e-9
    if left != right:
        within = (blocks == right) | (blocks == 0) if right == left + 1 else np.zeros(len(blocks), bool)
        wanted &= (blocks[:, None] != blocks[None, :]) | within[:, None]
    np.fill_diagonal(wanted, False)
    return wanted


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    """The rows of each group of a stream sorted by ``bucket, left, right``, as columns of Python values."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and tuple(held[0][k] for k in ("bucket", "left", "right")) != (row["bucket"], row["left"], row["right"]):
                yield {k: [r[k] for r in held] for k in held[0]}
                held = []
            held.append(row)
    if held:
        yield {k: [r[k] for r in held] for k in held[0]}


def _distinct(group: dict[str, list]) -> dict[str, list]:
    first = {c: i for i, c in reversed(list(enumerate(group["cls"])))}
    return {k: [v[i] for i in sorted(first.values())] for k, v in group.items()}


def _pairs_of(group: dict[str, list], threshold: float) -> np.ndarray:
    return _owned(
        np.array(group["n"], dtype=np.float64), [np.array(p, dtype=np.int64) for p in group["paths"]],
        group["bucket"][0], threshold, np.array(group["block"]), group["left"][0], group["right"][0],
    )


def _needed(threshold: float):
    """The rows whose texts a comparison needs: those with at least one pair of their own in the group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        kept: list[dict] = []
        for batch in _with_schema(batches):
            schema = schema or batch[0]
            group = _distinct(batch[1])
            for i in np.flatnonzero(_pairs_of(group, threshold).any(axis=1)):
                kept.append({k: v[i] for k, v in group.items()})
            if len(kept) > 2000:
                yield pa.RecordBatch.from_pylist(kept, schema=schema)
                kept = []
        if kept:
            yield pa.RecordBatch.from_pylist(kept, schema=schema)

    return run


def _with_schema(batches: Iterator[pa.RecordBatch]):
    seen = []

    def noting():
        for batch in batches:
            seen.append(batch.schema)
            yield batch

    for group in _groups(noting()):
        yield seen[0], group


_LINKED = "cls long, links long, root long"


def _compare(size: int, threshold: float, block: int = 64):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        for group in _groups(batches):
            group = _distinct(group)
            wanted = _pairs_of(group, threshold)
            sets = [shingle_set(t.encode(), size) for t in group["text"]]
            tokens, inverse = np.unique(np.concatenate(sets), return_inverse=True)
            owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            common = np.bincount(inverse) > 1
            column = np.cumsum(common) - 1
            keep = common[inverse]
            rows, columns = owner[keep], column[inverse[keep]]
            shared = np.zeros((len(sets), len(sets)), dtype=np.float32)
            # Tokens that only one set has cannot be shared; the others come in slices, to bound the matrix.
            width = 8192
            for at in range(0, int(common.sum()), width):
                inside = (columns >= at) & (columns < at + width)
                matrix = np.zeros((len(sets), width), dtype=np.float32)
                matrix[rows[inside], columns[inside] - at] = 1
                shared += matrix @ matrix.T
            n = np.array([len(s) for s in sets], dtype=np.float64)
            linked = wanted & (shared >= threshold * (np.add.outer(n, n) - shared) - 1e-9)
            members = np.array(group["members"], dtype=np.int64)
            links = linked @ members
            root = _roots(linked, group["cls"])
            for i in np.flatnonzero(links):
                out.append({"cls": group["cls"][i], "links": int(links[i]), "root": root[i]})
            if len(out) > 5000:
                yield pa.RecordBatch.from_pylist(out, schema=_linked_schema())
                out = []
        yield pa.RecordBatch.from_pylist(out, schema=_linked_schema())

    return run


def _linked_schema() -> pa.Schema:
    return pa.schema([("cls", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def _roots(linked: np.ndarray, cls: list[int]) -> list[int]:
    """The smallest class of each row's component within the group."""
    label = np.array(cls, dtype=np.int64)
    big = np.iinfo(np.int64).max
    while True:
        near = np.where(linked, label[None, :], big).min(axis=1)
        new = np.minimum(label, near)
        if (new == label).all():
            return label.tolist()
        label = new


def components(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """``node, root``: the smallest node of each connected component of ``edges(a, b)``.

    Alternates large-star and small-star steps, which only ever shuffle edges; each round is written.
    Goes on until nothing changes; raises if that takes more than ``rounds``.
    """
    current = written(edges.where("a <> b").distinct(), "edges")
    before = None
    for done in itertools.count():
        if done == rounds:
            raise RuntimeError(f"components still change after {rounds} rounds")
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("_a"), F.least("a", "m").alias("m")
        )
        large = both.join(lowest, F.col("a") == F.col("_a")).where(F.col("b") > F.col("a")).select(
            F.col("b").alias("a"), F.col("m").alias("b")
        ).distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least.withColumnRenamed("a", "_a"), F.col("a") == F.col("_a")).where(F.col("b") != F.col("m")).select(
            F.col("b").alias("a"), F.col("m").alias("b")
        )
        current = written(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    return current.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))


def join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    threshold: float = 0.8,
    recall: float = 0.999,
    limit: int = LIMIT,
    levels: int = LEVELS,
    block_sets: int = BLOCK,
    block_mass: int = MASS,
) -> DataFrame:
    """One row per document: ``doc_id, text_key, group_key, class_id, copy_id, n_links``.

    ``n_links`` counts the other documents with similarity ``threshold`` or more, copies
    included; ``copy_id`` is the smallest id with an equal shingle set, ``class_id`` the smallest id
    that is reachable over links; null ids count only where there is no other. ``text_key`` is the
    64-bit hash of the text, for joining back, and ``group_key`` names the group, null without words.
    """
    runs = runs_for(recall, levels)
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).withColumn("text_key", F.xxhash64("text"))
    sketched = written(
        texts.select("doc_id", "text_key", "text").mapInArrow(_sketch(size, threshold, runs, levels), _SKETCH), "sketch"
    )
    key = F.xxhash64("n", "cls", "cls2")
    member = sketched.select("doc_id", "text_key", "n", key.alias("cls"), "sampled")
    filled = member.where("n > 0")
    # min() on narrow structs aggregates before the shuffle; the sampled tokens of a class are all equal.
    classes = written(
        filled.groupBy("cls").agg(
            F.count(F.lit(1)).alias("members"),
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first"),
            F.first("n").alias("n"),
            F.first("sampled").alias("sampled"),
        ),
        "classes",
    )
    buckets = written(_buckets(classes, runs, levels, limit), "buckets")
    paths = buckets.groupBy("cls").agg(F.sort_array(F.collect_set("bucket")).alias("paths"))
    narrow = classes.select("cls", "members", "first", "n")
    # Small blocks copy each text into more pairs of blocks; large ones take more memory.
    sizes = buckets.join(classes.select("cls", "n"), "cls").groupBy("bucket").agg(
        F.count(F.lit(1)).alias("sets"), F.sum("n").alias("mass")
    )
    parts = F.greatest(F.ceil(F.col("sets") / F.lit(block_sets)), F.ceil(F.col("mass") / F.lit(block_mass)))
    # No more blocks than sets.
    blocks = F.least(parts, F.col("sets")).cast("int")
    block = F.pmod(F.xxhash64("cls", "bucket"), F.col("blocks")).cast("int")
    dealt = (
        buckets.select("bucket", "cls")
        .join(sizes.select("bucket", blocks.alias("blocks")), "bucket")
        .select("bucket", "cls", "blocks", block.alias("block"))
        .select(
            "bucket", "cls", "block",
            F.explode(
                F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: (F.col("blocks") == 1) | (o != F.col("block")))
            ).alias("other"),
        )
        .select(
            "bucket", "cls", "block", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right")
        )
        .join(paths.join(narrow, "cls"), "cls")
    )

    def by_group(df: DataFrame) -> DataFrame:
        keys = ["bucket", "left", "right"]
        return df.repartition(*keys).sortWithinPartitions(*keys)

    needed = written(by_group(dealt).mapInArrow(_needed(threshold), by_group(dealt).schema), "needed")
    wanted = needed.withColumns({"_doc": F.col("first.doc_id"), "_text": F.col("first.text_key")})
    same = texts["doc_id"].eqNullSafe(wanted["_doc"]) & (texts["text_key"] == wanted["_text"])
    with_text = wanted.join(texts, same).select(*needed.columns, "text")
    linked = written(by_group(with_text).mapInArrow(_compare(size, threshold), _LINKED), "links")

    links = linked.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = components(linked.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    # The smallest document of each group of classes.
    rooted = classes.select("cls", F.col("first.doc_id").alias("copy_id"), "members").join(
        roots.withColumnRenamed("node", "cls"), "cls", "left"
    ).withColumn("root", F.coalesce("root", "cls"))
    smallest = rooted.groupBy("root").agg(F.min("copy_id").alias("class_id"))
    known = (
        rooted.join(smallest, "root")
        .join(links, "cls", "left")
        .select(
            F.col("cls").alias("_cls"), "copy_id", "class_id", F.col("root").alias("group_key"),
            (F.col("members") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        )
    )
    rows = sketched.select("doc_id", "text_key", F.when(F.col("n") > 0, key).alias("cls"))
    return rows.join(known, F.col("cls") == F.col("_cls"), "left").select(
        "doc_id", "text_key", "group_key",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("copy_id", "doc_id").alias("copy_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
    )


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with the smallest id of each group of linked documents, with their own columns.

    Documents without words are groups of their own. If rows repeat id and text, one of them stays; of rows
    that share the smallest id but differ in text, the one with the smallest text hash stays.
    """
    found = join(docs, id_col, text_col, **options)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    first = found.where("group_key is not null").groupBy("group_key").agg(F.min(rank).alias("first"))
    lone = found.where("group_key is null").select("doc_id", "text_key").distinct()
    keep = first.select("first.doc_id", "first.text_key").unionByName(lone)
    keep = written(keep.select(F.col("doc_id").alias("_llm_doc"), F.col("text_key").alias("_llm_text")), "kept")
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.withColumns({"_llm_id": F.col(id_col).cast("bigint"), "_llm_key": F.xxhash64(text)})
    same = F.col("_llm_id").eqNullSafe(F.col("_llm_doc")) & (F.col("_llm_key") == F.col("_llm_text"))
    return keyed.join(keep, same, "left_semi").dropDuplicates(["_llm_id", "_llm_key"]).drop("_llm_id", "_llm_key")


# The registered query in DuckDB: all pairs that share a shingle, then the closure of the links.
ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
p AS (SELECT r, ws, least(len(ws), 5) AS n, unnest(range(1, len(ws) - least(len(ws), 5) + 2)) AS i FROM d WHERE len(ws) > 0),
s AS (SELECT DISTINCT r, array_to_string(ws[i : i + n - 1], ' ') AS g FROM p),
z AS (SELECT r, count(*) AS n FROM s GROUP BY r),
c AS (SELECT a.r AS a, b.r AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.r < b.r GROUP BY 1, 2),
l AS (SELECT a, b, k = x.n AND k = y.n AS copy FROM c JOIN z x ON x.r = a JOIN z y ON y.r = b WHERE k >= 0.8 * (x.n + y.n - k) - 1e-9),
e AS (SELECT a, b, copy FROM l UNION ALL SELECT b, a, copy FROM l),
t(r, o) AS (SELECT r, r FROM d UNION SELECT t.r, e.b FROM t JOIN e ON t.o = e.a),
g AS (SELECT t.r, min(d.doc_id) AS class_id FROM t JOIN d ON t.o = d.r GROUP BY t.r),
m AS (SELECT e.a AS r, count(*) AS n_links, min(CASE WHEN copy THEN d.doc_id END) AS other FROM e JOIN d ON d.r = e.b GROUP BY e.a)
SELECT d.doc_id, class_id, least(d.doc_id, coalesce(other, d.doc_id)) AS copy_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links
FROM d JOIN g USING (r) LEFT JOIN m USING (r)
"""

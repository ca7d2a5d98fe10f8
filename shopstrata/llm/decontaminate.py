"""Benchmark decontamination as a prefix-filtered set join.

An item's windows are its runs of ten words (one window of all its words if it has
fewer). A window is the set of its shingles of three words, with their places. A
document contains the window only if it contains all of them, so one shingle a window
is a necessary prefix: the one that is rarest in the documents, which keeps the
candidates few. The steps:

1. count, over all documents, the shingles that occur in the benchmark;
2. give each window its rarest shingle and the place of it;
3. find that shingle in the documents, with the words around it;
4. join on the shingle, apply the length and place bounds, and verify the whole window
   word by word.

Documents are looked through in Arrow batches against a bitmap of fixed size, so
whatever the benchmark's size only likely shingles leave the scan; the join itself is an
ordinary shuffle join, whose skewed keys are split at runtime.

Edge cases: null and empty text have no words, and an item without words has no window.
Rows that repeat a document give equal results each; a null id is an id like any other.
Equal windows of several items count for each of the items.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopstrata.llm.columns import ascii_lower
from shopstrata.llm.scratch import written
from shopstrata.llm.wordhash import ALNUM_WORDS, shingles, words

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BITMAP_BITS = 1 << 23


def word_array(text: Column) -> Column:
    """Lower-case words, in JVM expressions."""
    spaced = F.btrim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS, " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def item_windows(items: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """``item_id, window_text, n``: every window of every item, as words joined by blanks."""
    listed = items.select(F.col(item_col).alias("item_id"), word_array(F.col(text_col)).alias("ws"))
    size = F.least(F.size("ws"), F.lit(window))
    return (
        listed.where(F.size("ws") > 0)
        .select(
            "item_id",
            size.alias("n"),
            F.explode(
                F.transform(
                    F.sequence(F.lit(1), F.size("ws") - size + 1),
                    lambda i: F.array_join(F.slice(F.col("ws"), i, size), " "),
                )
            ).alias("window_text"),
        )
        .distinct()
    )


_WINDOW_SHINGLES = "window_text string, shingle long, size int, place int"
_COUNTS = "shingle long, n long"
_SEEN = "doc_id long, text_key long, n_words long, shingle long, at long, before string, after string"


def _window_shingles(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys, sizes, places = [], [], [], []
            for text in batch.column(0).to_pylist():
                hashes, _, _ = words(text.encode(), ALNUM_WORDS)
                used = min(size, len(hashes))
                for place, key in enumerate(shingles(hashes, used).view(np.int64).tolist()):
                    texts.append(text)
                    keys.append(key)
                    sizes.append(used)
                    places.append(place)
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()), pa.array(keys, pa.int64()), pa.array(sizes, pa.int32()),
                 pa.array(places, pa.int32())],
                names=["window_text", "shingle", "size", "place"],
            )

    return run


def _bitmap_of(keys: DataFrame) -> np.ndarray:
    """Bits set at the keys' places, as bytes. Its size is fixed, however many keys there are; a full
    bitmap only lets more shingles through to the join."""
    place = F.pmod(F.col("shingle"), F.lit(BITMAP_BITS)).cast("int")
    places = keys.select(F.shiftright(place, 5).alias("w"), F.pmod(place, F.lit(32)).alias("bit"))
    rows = places.groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("b")).collect()
    packed = np.zeros(BITMAP_BITS // 32, dtype=np.uint32)
    for row in rows:
        packed[row["w"]] = row["b"]
    return np.unpackbits(packed.view(np.uint8), bitorder="little").view(bool)


def _hits(hashes: np.ndarray, sizes: list[int], bits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Shingles that the bitmap knows, with their places, for each size in use."""
    for size in sizes:
        found = shingles(hashes, size)
        at = np.flatnonzero(bits[found & np.uint64(BITMAP_BITS - 1)])
        yield found[at].view(np.int64), at


def _count(shared, sizes: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shared.value).view(bool)
        for batch in batches:
            kept = []
            for text in batch.column(0):
                hashes, _, _ = words(text.as_py().encode(), ALNUM_WORDS)
                kept += [keys for keys, _ in _hits(hashes, sizes, bits) if len(keys)]
            keys, counts = np.unique(np.concatenate(kept) if kept else np.zeros(0, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(counts, pa.int64())], names=["shingle", "n"]
            )

    return run


def _search(shared, sizes: list[int], window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shared.value).view(bool)
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for doc, key, text in zip(*(batch.column(i) for i in range(3))):
                text = text.as_py().encode()
                hashes, starts, ends = words(text, ALNUM_WORDS)
                for keys, at in _hits(hashes, sizes, bits):
                    for k, p in zip(keys.tolist(), at.tolist()):
                        first, last = max(0, p - window), min(len(starts), p + window)
                        row = (
                            doc.as_py(), key.as_py(), len(starts), k, p,
                            text[starts[first] : starts[p]].decode(),
                            text[starts[p] : ends[last - 1]].decode(),
                        )
                        for column, value in zip(out, row):
                            column.append(value)
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds)],
                names=[f.split()[0] for f in _SEEN.split(", ")],
            )

    return run


def _rarest(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Each window's rarest shingle; on a tie the one further left."""
    return (
        windows.join(counts, "shingle", "left")
        .groupBy("window_text")
        .agg(
            F.min(
                F.struct(F.coalesce("n", F.lit(0).cast("bigint")).alias("n"), "place", "shingle", "size")
            ).alias("p")
        )
        .where(F.col("p.n") > 0)
        .select("window_text", "p.shingle", "p.place", "p.size")
    )


def occurrences(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    shingle: int = 3,
) -> DataFrame:
    """``doc_id, text_key, window_text, start, n``: every place where a window of an item occurs."""
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).withColumn("text_key", F.xxhash64("text"))
    windows = item_windows(items, item_col, item_text, window).select("window_text").distinct()
    sliced = written(windows.mapInArrow(_window_shingles(shingle), _WINDOW_SHINGLES), "windows")
    sizes = [r["size"] for r in sliced.select("size").distinct().orderBy("size").collect()]

    known = spark.sparkContext.broadcast(np.packbits(_bitmap_of(sliced)))
    counted = texts.select("text").mapInArrow(_count(known, sizes), _COUNTS)
    counts = counted.groupBy("shingle").agg(F.sum("n").alias("n"))
    prefixes = written(_rarest(sliced, counts), "prefixes")

    wanted = spark.sparkContext.broadcast(np.packbits(_bitmap_of(prefixes)))
    seen = texts.select("doc_id", "text_key", "text").mapInArrow(_search(wanted, sizes, window), _SEEN)
    # The words before the shingle and those from it on, so that a window can be laid over its place.
    around = seen.withColumns({"before": word_array(F.col("before")), "after": word_array(F.col("after"))})
    joined = around.join(prefixes, "shingle")
    n = F.size(F.split("window_text", " "))
    start = F.col("at") - F.col("place")
    laid = F.array_join(
        F.concat(
            F.slice("before", F.size("before") - F.col("place") + 1, F.col("place")),
            F.slice("after", F.lit(1), n - F.col("place")),
        ),
        " ",
    )
    fits = (start >= 0) & (start + n <= F.col("n_words"))
    return (
        joined.where(fits)
        .where(F.when(F.size("before") >= F.col("place"), laid) == F.col("window_text"))
        .select("doc_id", "text_key", "window_text", start.alias("start"), n.alias("n"))
        .distinct()
    )


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    shingle: int = 3,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    found = written(
        occurrences(docs, items, id_col, text_col, item_col, item_text, window, shingle), "occurrences"
    )
    # Words inside at least one occurrence: each adds what lies behind the furthest end so far.
    key = ["doc_id", "text_key"]
    spans = found.groupBy(*key, "start").agg(F.max(F.col("start") + F.col("n")).alias("end"))
    earlier = Window.partitionBy(*key).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("end").over(earlier), F.lit(0))
    hit = (
        spans.withColumn("new", F.greatest(F.lit(0), F.col("end") - F.greatest("start", reached)))
        .groupBy(*key)
        .agg(F.sum("new").alias("n_hit"))
    )
    owners = item_windows(items, item_col, item_text, window).select("item_id", "window_text")
    per_item = found.select(*key, "window_text").distinct().join(owners, "window_text")
    of_items = (
        per_item.select(*key, F.col("item_id").cast("string").alias("item_id"))
        .distinct()
        .groupBy(*key)
        .agg(F.count("item_id").alias("n_items"), F.sort_array(F.collect_list("item_id")).alias("ids"))
        .select(*key, "n_items", F.array_join("ids", ",").alias("ids"))
    )
    marked = hit.join(of_items, (hit["doc_id"].eqNullSafe(of_items["doc_id"])) & (hit["text_key"] == of_items["text_key"]))
    marked = marked.select(
        hit["doc_id"].alias("_doc"), hit["text_key"].alias("_text"), "n_hit", "n_items", "ids"
    )
    text = F.coalesce(F.col(text_col), F.lit(""))
    all_docs = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(text).alias("text_key"),
        F.size(word_array(text)).cast("bigint").alias("n_words"),
    )
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("_doc")) & (F.col("text_key") == F.col("_text"))
    return all_docs.join(marked, same, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce("ids", F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, **names) -> DataFrame:
    """The documents without any window of an item, with their own columns.

    Contaminated documents are found by id and text, so that of rows sharing an id only those go whose own text is hit.
    """
    id_col, text_col = names.get("id_col", "doc_id"), names.get("text_col", "text")
    hit = written(occurrences(docs, items, **names).select("doc_id", "text_key").distinct(), "contaminated")
    hit = hit.select(F.col("doc_id").alias("_llm_doc"), F.col("text_key").alias("_llm_text"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    same = F.col(id_col).cast("bigint").eqNullSafe(F.col("_llm_doc")) & (F.xxhash64(text) == F.col("_llm_text"))
    return docs.join(hit, same, "left_anti")


# The registered query in DuckDB, over ``documents`` and ``benchmark``.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bp AS (SELECT item_id, ws, least(len(ws), 10) AS n, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM b WHERE len(ws) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(ws[i : i + n - 1], ' ') AS g FROM bp),
sizes AS (SELECT DISTINCT n FROM bw),
dp AS (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, sizes WHERE len(ws) >= n),
dw AS (SELECT r, n, i, array_to_string(ws[i : i + n - 1], ' ') AS g FROM dp),
occ AS (SELECT r, i, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
hit AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM occ) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM occ) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""

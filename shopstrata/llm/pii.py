"""Personal data: base patterns, and identifiers found by their contexts.

The base kinds are e-mail addresses, IPv4 addresses, card numbers and phone numbers. Their
finds are the seeds of a bootstrap: words around seeds make lexical patterns (the two words
to the left; the words to the left and right), and patterns and the strings they stand
around form a graph. A pattern scores the mean score of its strings, a string the
noisy-or of its patterns, seeds stay at 1, for some rounds of joins and aggregations over
distinct edges. Patterns that then score high and have stood around enough different seeds
mark other strings with digits in them as identifiers, kind ``id``. Base finds always stay.

All of it is built-in expressions, in place per row, or aggregations; only contexts of
strings with digits are shuffled, never texts.

Edge cases: null and empty text have no spans. Rows that repeat id and text have equal
results each. Matches that fail a check (parts over 255, Luhn, digits) are dropped and not retried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstrata.llm.columns import ascii_lower, spans
from shopstrata.llm.scratch import written

KINDS = ["email", "ip", "card", "phone"]
_LOCAL = "[A-Za-z0-9._%+-]"
# Possessive and only from the start of a run (or the end of the last match): same matches, linear time.
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_SIGNS = r"A-Za-z@_%+/=#:.\-"
IDENTIFIER = rf"(?:(?<![{_SIGNS}0-9])|\G)[{_SIGNS}]*+[0-9][{_SIGNS}0-9]*+"


def _valid(kind: str, hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    if kind == "ip":
        return F.rlike(hit, F.lit(rf"^(?:{_PART}\.){{3}}{_PART}$"))
    if kind == "card":
        return F.char_length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.char_length(digits).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """The valid base finds as ``array<struct<start, order, end, kind, hit, before, after>>``, by start and kind."""
    return F.sort_array(F.concat(*[_of_kind(text, order, kind) for order, kind in enumerate(KINDS)]))


def _of_kind(text: Column, order: int, kind: str) -> Column:
    return F.transform(
        F.filter(spans(text, PATTERNS[kind]), lambda s: _valid(kind, s["hit"])),
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"), F.lit(kind).alias("kind"),
            s["hit"].alias("hit"), s["before"].alias("before"), s["after"].alias("after"),
        ),
    )


def _count_of(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")


def span_text(found: Column) -> Column:
    return F.array_join(
        F.transform(
            found,
            lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")),
        ),
        ",",
    )


def _patterns(before: Column, after: Column) -> Column:
    """The lexical patterns of a context: words folded to lower case and one digit."""

    def fold(c: Column) -> Column:
        return F.regexp_replace(ascii_lower(c), "[0-9]+", "0")

    left2 = F.trim(fold(F.regexp_extract(before, r"((?:\S+\s+)?\S+)\s*$", 1)))
    left1 = F.trim(fold(F.regexp_extract(before, r"(\S+)\s*$", 1)))
    right1 = F.trim(fold(F.regexp_extract(after, r"^\s*(\S+)", 1)))
    two = F.when(F.contains(left2, F.lit(" ")), F.concat(F.lit("LL "), left2))
    both = F.when((left1 != "") & (right1 != ""), F.concat(F.lit("LR "), left1, F.lit(" "), right1))
    return F.array_compact(F.array(two, both))


def score_patterns(edges: DataFrame, rounds: int = 3) -> DataFrame:
    """``pattern, confidence, seeds`` from distinct ``edges(pattern, instance, seed)``."""
    scored = edges.withColumn("score", F.when(F.col("seed"), F.lit(1.0)).otherwise(F.lit(0.0)))
    for at in range(rounds):
        of_pattern = scored.groupBy("pattern").agg(
            F.avg("score").alias("confidence"), F.count_if("seed").alias("seeds")
        )
        if at == rounds - 1:
            return of_pattern
        of_instance = (
            edges.join(of_pattern, "pattern")
            .groupBy("instance")
            .agg(F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.999)))).alias("none"))
            .select(F.col("instance").alias("_instance"), (1 - F.exp("none")).alias("_score"))
        )
        scored = edges.join(of_instance, F.col("instance") == F.col("_instance")).select(
            "pattern", "instance", "seed", F.when(F.col("seed"), F.lit(1.0)).otherwise(F.col("_score")).alias("score")
        )
    return of_pattern


def find(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = 3,
    least_confidence: float = 0.8,
    least_seeds: int = 3,
) -> DataFrame:
    """One row per document: ``doc_id``, base counts, ``base_sha256`` and ``spans`` with the discovered ``id`` spans."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    read = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"))
    identifiers = F.filter(spans(F.col("_text"), IDENTIFIER), lambda s: F.char_length(s["hit"]) >= 6)
    local = written(
        read.select(
            "doc_id", F.xxhash64("_text").alias("text_key"), base_spans(F.col("_text")).alias("base"),
            identifiers.alias("others"),
        ),
        "pii",
    )
    seeds = local.select(F.explode("base").alias("s")).select(
        F.col("s.hit").alias("instance"), _patterns(F.col("s.before"), F.col("s.after")).alias("p"), F.lit(True).alias("seed")
    )
    others = local.select("doc_id", "text_key", "base", F.explode("others").alias("s")).select(
        "doc_id", "text_key", "base", F.col("s.start").alias("start"), F.col("s.end").alias("end"),
        F.col("s.hit").alias("instance"), F.explode(_patterns(F.col("s.before"), F.col("s.after"))).alias("pattern"),
    )
    seen = seeds.select("instance", F.explode("p").alias("pattern"), "seed").unionByName(
        others.select("instance", "pattern", F.lit(False).alias("seed"))
    )
    edges = written(seen.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "pii-edges")
    good = score_patterns(edges, rounds).where(
        (F.col("confidence") >= least_confidence) & (F.col("seeds") >= least_seeds)
    )
    clear = ~F.exists("base", lambda b: (b["start"] < F.col("end")) & (b["end"] > F.col("start")))
    discovered = (
        others.join(good.select("pattern"), "pattern")
        .where(clear)
        .groupBy(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_text"))
        .agg(
            F.collect_set(
                F.struct("start", F.lit(len(KINDS)).alias("order"), "end", F.lit("id").alias("kind"))
            ).alias("new")
        )
    )
    slim = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["order"].alias("order"), s["end"].alias("end"), s["kind"].alias("kind")))
    joined = local.select("doc_id", "text_key", slim.alias("base")).join(
        discovered, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_key") == F.col("_text")), "left"
    )
    counts = [_count_of(kind) for kind in KINDS]
    empty = F.array().cast("array<struct<start:bigint,order:int,end:bigint,kind:string>>")
    return joined.select(
        "doc_id", *counts,
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.sort_array(F.concat("base", F.coalesce("new", empty)))).alias("spans"),
        F.size(F.coalesce("new", empty)).cast("bigint").alias("n_id"),
    )

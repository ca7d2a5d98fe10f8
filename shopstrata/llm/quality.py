"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and
one bit per failed rule; a policy is a versioned mask over those bits, so a new
policy or an ablation reads the ledger and never the texts again.

Edge cases: null and empty text have no words, fail ``too_few_words`` and are
rejected. Repeated rows are judged one by one. Only the two named columns are
read, so other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstrata.llm.columns import BLANKS, let, split_words

SYMBOLS = "#*$%&|<>"

# Bit of each rule. A bit is never reused for another rule.
RULE_BITS = {
    "too_few_words": 0,
    "repeated_windows": 1,
    "symbols_per_word": 2,
    "shouting": 3,
    "duplicate_lines": 4,
    "long_words": 5,
}


def _tests(m: Column) -> dict[str, Column]:
    """When each rule fails, from the measurements."""
    n = m["n_words"]
    return {
        "too_few_words": n < 50,
        "repeated_windows": 100 * m["n_repeat_words"] > 50 * n,
        "symbols_per_word": 10 * m["n_symbols"] > n,
        "shouting": 2 * m["n_upper"] > m["word_chars"],
        "duplicate_lines": 2 * m["n_dup_lines"] > m["n_lines"],
        "long_words": m["word_chars"] > 30 * n,
    }


@dataclass(frozen=True)
class Policy:
    """A named version and the rules that reject under it."""

    version: str
    rejecting: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << RULE_BITS[name] for name in self.rejecting)


BASE = Policy("base-1", ("too_few_words", "repeated_windows"))
PRODUCTION = Policy("production-1", tuple(RULE_BITS))


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur at least twice in the text."""

    def counted(ws: Column) -> Column:
        last = F.size(ws) - 3
        windows = F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.struct(
                F.concat_ws(" ", F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)).alias("w"), i.alias("at")
            ),
        )
        # Equal windows are neighbours once sorted, with rising positions.
        return let(F.sort_array(windows), covered)

    def covered(s: Column) -> Column:
        repeated = F.filter(
            s,
            lambda x, i: (x["w"] == F.get(s, i - 1)["w"]) | (x["w"] == F.get(s, i + 1)["w"]),
        )
        places = F.sort_array(F.transform(repeated, lambda x: x["at"]))
        # Each window adds its three words, less those that the next window covers too.
        return let(
            places,
            lambda p: F.aggregate(
                F.transform(p, lambda at, i: F.least(F.lit(3), F.get(p, i + 1) - at)),
                F.lit(0).cast("bigint"),
                lambda a, x: a + x,
            ),
        )

    return let(words, lambda ws: F.when(F.size(ws) < 4, F.lit(0).cast("bigint")).otherwise(counted(ws)))


def measurements(text: Column) -> Column:
    """Everything the rules look at, as one struct."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    of_words = let(
        split_words(text),
        lambda ws: F.struct(
            F.size(ws).cast("bigint").alias("n"),
            F.char_length(F.array_join(ws, "")).cast("bigint").alias("chars"),
            _repeat_words(ws).alias("repeated"),
        ),
    )
    of_lines = let(
        lines, lambda ls: F.struct(F.size(ls).alias("n"), F.size(F.array_distinct(ls)).alias("different"))
    )
    return let(
        F.struct(of_words.alias("w"), of_lines.alias("l")),
        lambda m: F.struct(
            m["w"]["n"].alias("n_words"),
            m["w"]["chars"].alias("word_chars"),
            F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("bigint").alias("n_symbols"),
            m["l"]["n"].cast("bigint").alias("n_lines"),
            (m["l"]["n"] - m["l"]["different"]).cast("bigint").alias("n_dup_lines"),
            m["w"]["repeated"].alias("n_repeat_words"),
            F.regexp_count(text, F.lit(r"\p{Lu}")).cast("bigint").alias("n_upper"),
        ),
    )


def fail_bits(m: Column) -> Column:
    """The failed rules of a measurement struct as a bigint."""
    bits = F.lit(0).cast("bigint")
    for name, failed in _tests(m).items():
        bits = bits.bitwiseOR(F.when(failed, F.lit(1 << RULE_BITS[name])).otherwise(F.lit(0)).cast("bigint"))
    return bits


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: its id, the measurements and ``fail_bits``."""
    measured = docs.select(F.col(id_col), measurements(F.col(text_col)).alias("_m"))
    return measured.select(id_col, "_m.*", fail_bits(F.col("_m")).alias("fail_bits"))


def passes(policy: Policy, bits: Column) -> Column:
    return bits.bitwiseAND(F.lit(policy.mask).cast("bigint")) == 0


def ablations(rows: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of ``policy``: documents failing it, documents that only it rejects, and the documents
    rejected by the policy without it. One aggregation over the ledger."""
    masked = rows.select(F.col("fail_bits").bitwiseAND(F.lit(policy.mask)).alias("bits"))
    counted = masked.groupBy("bits").agg(F.count(F.lit(1)).alias("n"))
    rules = [
        F.struct(F.lit(name).alias("rule"), F.lit(1 << RULE_BITS[name]).cast("bigint").alias("bit"))
        for name in policy.rejecting
    ]
    each = counted.select("bits", "n", F.explode(F.array(*rules)).alias("r")).select("bits", "n", "r.*")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    rest = F.col("bits").bitwiseAND(F.bitwise_not("bit")) != 0

    def total(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))

    return each.groupBy("rule").agg(
        total(hit).alias("failing"), total(hit & ~rest).alias("only_this"), total(rest).alias("rejected_without")
    )


def keep(docs: DataFrame, policy: Policy = PRODUCTION, text_col: str = "text") -> DataFrame:
    """The documents that pass, with their own columns."""
    judged = docs.withColumn("_llm_bits", let(measurements(F.col(text_col)), fail_bits))
    return judged.where(passes(policy, F.col("_llm_bits"))).drop("_llm_bits")


# The ledger of the view ``documents`` in DuckDB, with the columns of the registered query.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
places AS (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w),
windows AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM places),
found AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows),
covered AS (SELECT DISTINCT r, i + unnest([0, 1, 2]) AS i FROM found WHERE n > 1),
repeated AS (SELECT r, count(*) AS n FROM covered GROUP BY r),
m AS (
  SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
         len(ls) AS n_lines, length(regexp_replace(t, '\P{Lu}', '', 'g')) AS n_upper
  FROM w LEFT JOIN repeated USING (r)),
bits AS (
  SELECT *, (n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
         + 8 * (2 * n_upper > word_chars)::INT + 16 * (2 * n_dup_lines > n_lines)::INT
         + 32 * (word_chars > 30 * n_words)::INT AS fail_bits
  FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, (fail_bits & 3) > 0 AS base_failed, fail_bits = 0 AS kept,
       CAST(n_lines AS BIGINT) AS n_lines, CAST(n_upper AS BIGINT) AS n_upper, CAST(fail_bits AS BIGINT) AS fail_bits
FROM bits
"""

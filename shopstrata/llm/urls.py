"""URL filter: rules first, then a ratio of two character language models.

URLs that a rule decides train the models: one for accepted and one for rejected URLs.
Both are Markov models of variable order over a folded alphabet. The probability of a
character after its context is interpolated with the one after a shorter context
(Witten-Bell), so that a context never seen falls back to what its end says. A URL's
score is the mean difference of log-likelihoods per character, and the threshold is the
one with the best balanced accuracy on the URLs with known verdicts that were held out.

Everything is counted, smoothed and scored with joins and aggregations of n-grams; the
table of log ratios has a row per n-gram seen, at most ``len(alphabet) ** order`` rows,
and is written, so that the optimizer knows its size.

Edge cases: a null url, or one without ``://``, has an empty host and path, no rule, and
an empty character sequence whose score is 0. If one of the classes has no
training URL, every score is 0 and the threshold is 0, which allows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstrata.llm.columns import ascii_lower
from shopstrata.llm.scratch import written

# Verdict and host/path of each rule.
RULES = [
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
]
# Lower-case letters, one digit for all, and these; every other character is ``?``.
LETTERS = "abcdefghijklmnopqrstuvwxyz0./:-_#=&%~+@ "
OTHER = "?"
BEFORE = "^"


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest fitting rule as ``struct(rule, verdict)``, or null. There are few rules, so they are a
    chain of conditions and no join."""
    chain = None
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        site, slash, rest = rule.partition("/")
        fits = ((host == site) | host.endswith("." + site)) & path.startswith(slash + rest)
        found = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        chain = F.when(fits, found) if chain is None else chain.when(fits, found)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if chain is None else chain


def folded(url: Column) -> Column:
    """The url in the models' alphabet, without scheme."""
    rest = ascii_lower(F.regexp_replace(F.coalesce(url, F.lit("")), r"(?s)^.*?://", ""))
    return F.regexp_replace(F.regexp_replace(rest, "[0-9]", "0"), "[^a-z0./:_#=&%~+@ -]", OTHER)


def ngrams(text: Column, order: int) -> Column:
    """The characters of a text, each behind the ``order`` - 1 characters before it."""
    padded = F.concat(F.lit(BEFORE * (order - 1)), text)
    return F.when(
        F.length(text) > 0,
        F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substring(padded, i, F.lit(order))),
    )


@dataclass(frozen=True)
class Model:
    ratios: DataFrame  # gram, log_ratio
    threshold: float


def _smoothed(grams: DataFrame, order: int) -> DataFrame:
    """``gram, log_ratio`` for every n-gram of ``grams(gram, accepted, rejected)``; the counts are of n-grams of
    ``order`` characters, and shorter ones are their ends."""
    level = grams.select(
        "gram", F.lit(1.0 / (len(LETTERS) + 1)).alias("p_accepted"), F.lit(1.0 / (len(LETTERS) + 1)).alias("p_rejected")
    )
    for n in range(1, order + 1):
        short = F.substring("gram", order - n + 1, n)
        counts = grams.groupBy(short.alias("_g")).agg(F.sum("accepted").alias("_a"), F.sum("rejected").alias("_r"))
        contexts = counts.groupBy(F.substring("_g", 1, n - 1).alias("_c")).agg(
            F.sum("_a").alias("_na"), F.sum("_r").alias("_nr"),
            F.count_if(F.col("_a") > 0).alias("_ta"), F.count_if(F.col("_r") > 0).alias("_tr"),
        )
        joined = level.join(counts, short == F.col("_g")).join(
            contexts, F.substring("gram", order - n + 1, n - 1) == F.col("_c")
        )

        def mixed(count: str, total: str, kinds: str, shorter: str) -> Column:
            weight = F.col(total) + F.col(kinds)
            return F.when(weight == 0, F.col(shorter)).otherwise(
                (F.col(count) + F.col(kinds) * F.col(shorter)) / weight
            )

        level = joined.select(
            "gram",
            mixed("_a", "_na", "_ta", "p_accepted").alias("p_accepted"),
            mixed("_r", "_nr", "_tr", "p_rejected").alias("p_rejected"),
        )
    return level.select("gram", (F.log("p_accepted") - F.log("p_rejected")).alias("log_ratio"))


def scored(urls: DataFrame, ratios: DataFrame, order: int) -> DataFrame:
    """``url, score`` per distinct url of ``urls(url)``: the mean log ratio of its characters."""
    distinct = urls.select("url").where(F.col("url").isNotNull()).distinct()
    grams = distinct.select("url", F.explode_outer(ngrams(folded(F.col("url")), order)).alias("gram"))
    joined = grams.join(ratios, "gram", "left")
    # Summed in millionths, so that the order of the rows does not show.
    units = F.round(F.coalesce("log_ratio", F.lit(0.0)) * 1e6).cast("bigint")
    return joined.groupBy("url").agg((F.sum(units) / F.count(F.lit(1)) / 1e6).alias("score"))


def fit(known: DataFrame, everything: DataFrame, order: int = 4, held_out: int = 5) -> Model:
    """Train on ``known(url, verdict)``, four fifths of its distinct urls by hash, and calibrate on the rest.

    ``everything(url)`` names the urls to be scored later: their n-grams get a ratio, too.
    """
    part = F.pmod(F.xxhash64("url"), F.lit(held_out))
    rows = known.where(F.col("url").isNotNull())
    mine = rows.where(part != 0).groupBy("url").agg(
        F.count_if(F.col("verdict") == "allow").alias("a"), F.count_if(F.col("verdict") == "block").alias("r")
    )
    trained = mine.select("a", "r", F.explode(ngrams(folded(F.col("url")), order)).alias("gram"))
    others = everything.select("url").where(F.col("url").isNotNull()).distinct()
    unseen = others.select(
        F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("r"),
        F.explode(ngrams(folded(F.col("url")), order)).alias("gram"),
    )
    counts = trained.unionByName(unseen).groupBy("gram").agg(F.sum("a").alias("accepted"), F.sum("r").alias("rejected"))
    counts = written(counts, "url-counts")
    ratios = written(_smoothed(counts, order), "url-ratios")

    tests = rows.where(part == 0).groupBy("url").agg(F.first("verdict").alias("verdict"))
    judged = scored(tests, ratios, order).join(tests, "url")
    bins = judged.groupBy(F.round("score", 2).alias("bin")).agg(
        F.count_if(F.col("verdict") == "allow").alias("a"), F.count_if(F.col("verdict") == "block").alias("r")
    ).collect()  # at most some thousand bins: scores are bounded by the smoothing
    return Model(ratios, _best_threshold([(b["bin"], b["a"], b["r"]) for b in bins]))


def _best_threshold(bins: list[tuple[float, int, int]]) -> float:
    """The cut between bins with the largest balanced accuracy; on a tie the middle of the widest gap."""
    accepted, rejected = sum(b[1] for b in bins), sum(b[2] for b in bins)
    if not accepted or not rejected:
        return 0.0
    below_a = below_r = 0
    best = (-1.0, 0.0, 0.0)
    ordered = sorted(bins)
    for (at, a, r), following in zip(ordered, [*ordered[1:], None]):
        below_a, below_r = below_a + a, below_r + r
        if following is not None:
            gain = below_r / rejected + (accepted - below_a) / accepted
            best = max(best, (round(gain, 12), following[0] - at, (at + following[0]) / 2))
    return best[2]


def judge(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: list[tuple[str, str]] | None = None,
    order: int = 4,
) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, score``. The score is null where a rule decides."""
    rules = RULES if rules is None else rules
    read = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    parted = read.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = parted.withColumn("by_rule", longest_rule(F.col("host"), F.col("path"), rules))
    known = ruled.where(F.col("by_rule").isNotNull()).select("url", F.col("by_rule.verdict").alias("verdict"))
    open_urls = ruled.where(F.col("by_rule").isNull()).select("url")
    model = fit(known, open_urls, order)
    scores = scored(open_urls, model.ratios, order).select(F.col("url").alias("_url"), "score")
    joined = ruled.join(scores, (F.col("url") == F.col("_url")) & F.col("by_rule").isNull(), "left")
    score = F.when(F.col("by_rule").isNull(), F.coalesce("score", F.lit(0.0)))
    return joined.select(
        "page_id", "host", "path",
        F.col("by_rule.rule").alias("rule"),
        F.coalesce(
            F.col("by_rule.verdict"), F.when(score >= model.threshold, F.lit("allow")).otherwise(F.lit("block"))
        ).alias("verdict"),
        score.alias("score"),
    )

"""Soft-membership mixing: rates per document that bring domain totals to their targets.

A multinomial classifier trained on the labelled table gives each document a posterior over
domains. The expected tokens of a domain are the sum of rate * tokens * posterior, and the
rates are fitted by projected gradient with momentum on the squared relative gaps to the targets plus
a small pull towards rate 1, until the targets are met or the gaps no longer fall; the gaps left
are returned. A document's rate depends on the totals only through one
residual per domain and step, so a step is one aggregation over a narrow table; the
driver keeps a few numbers per domain, and rates are written every ``stride`` steps.

The classifier may train on at most ``max_train`` labelled documents (smallest hashes); all
else covers every row.

Edge cases: null and empty text have no tokens, and their rate weighs nothing. Labels with
nulls are not used; a document labelled several times counts each label. Without two
labelled domains every posterior is the smoothed share of the labels. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstrata.llm.columns import ascii_lower, let, split_words
from shopstrata.llm.scratch import written

DOMAINS = ["clean", "low", "toxic"]
TARGETS = {"clean": 0.90, "low": 0.07, "toxic": 0.03}
MAX_TRAIN = 20_000


def domain(quality: Column, toxic: Column) -> Column:
    """Number of the domain of a labelled document."""
    return F.when(toxic == 1, F.lit(2)).when(quality == 0, F.lit(1)).when(quality == 1, F.lit(0))


def _features(texts: DataFrame) -> DataFrame:
    hashing = HashingTF(inputCol="_words", outputCol="features", numFeatures=1 << 14, binary=True)
    return hashing.transform(texts)


def posteriors(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_train: int = MAX_TRAIN) -> DataFrame:
    """``doc_id, n_tokens, p`` per document, ``p`` an array with a probability per domain."""
    words = split_words(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))))
    texts = docs.select(F.col(id_col).alias("doc_id"), words.alias("_words"))
    known = labels.select(
        F.col("doc_id").alias("_id"), domain(F.col("quality"), F.col("toxic")).cast("double").alias("label")
    ).where(F.col("label").isNotNull() & F.col("_id").isNotNull())
    # A bounded sample, so this side of the join has a fixed size.
    sample = written(known.orderBy(F.xxhash64("_id"), "label").limit(max_train), "mix-labels")
    share = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    tokens = F.size("_words").cast("bigint").alias("n_tokens")
    # Joined before the texts are split, so that only the sample's are.
    labelled = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text")).join(
        F.broadcast(sample), F.col("_doc") == F.col("_id")
    )
    training = labelled.select(split_words(ascii_lower(F.coalesce("_text", F.lit("")))).alias("_words"), "label")
    rows = written(_features(training).select("features", "label"), "mix-training")
    if rows.select("label").distinct().count() < 2:
        total = sum(share.values()) + len(DOMAINS)
        even = F.array(*[F.lit((share.get(float(k), 0) + 1) / total) for k in range(len(DOMAINS))])
        return texts.select("doc_id", tokens, even.alias("p"))
    model = LogisticRegression(family="multinomial", maxIter=25, regParam=1e-3).fit(rows)
    scored = model.transform(_features(texts)).withColumn("_p", vector_to_array("probability"))
    return scored.select(
        "doc_id", tokens, F.array(*[F.coalesce(F.get("_p", F.lit(k)), F.lit(0.0)) for k in range(len(DOMAINS))]).alias("p")
    )


def _stepped(state: Column, p: Column, steps: list[tuple[list[float], float]], pull: float) -> Column:
    """``state`` (the rate reached and the one looked ahead to) after steps of weighted residuals and momentum."""
    if not steps:
        return state
    history = F.array(
        *[F.struct(F.array(*[F.lit(x) for x in u]).alias("u"), F.lit(float(momentum)).alias("m")) for u, momentum in steps]
    )

    def step(s: Column, h: Column) -> Column:
        slope = sum((F.get(p, F.lit(k)) * F.get(h["u"], F.lit(k)) for k in range(len(DOMAINS))), F.lit(0.0))
        rate = F.greatest(F.lit(0.0), s["ahead"] - (slope + pull * (s["ahead"] - 1.0)) / (1.0 + pull))
        return let(
            rate, lambda r: F.struct(r.alias("rate"), F.greatest(F.lit(0.0), r + h["m"] * (r - s["rate"])).alias("ahead"))
        )

    return F.aggregate(history, state, step)


def fit_rates(
    members: DataFrame, targets: dict[str, float], stride: int = 8, pull: float = 1e-5, close: float = 1e-5, patience: int = 60
) -> tuple[DataFrame, dict[str, float]]:
    """``members(doc_id, n_tokens, p)`` with a nonnegative ``rate``, and each domain's share less its target at these rates.

    Ends once every domain is within ``close`` of its target, or once ``patience`` steps in a row have not brought the
    squared gaps a hundredth below the least before: then the targets cannot be met, or only up to the pull.
    """
    start = F.struct(F.lit(1.0).alias("rate"), F.lit(1.0).alias("ahead"))
    current = written(members.withColumn("state", start), "mix-rates")
    n = current.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    wanted = [targets[d] for d in DOMAINS]
    taken: list[tuple[list[float], float]] = []
    weights, least, waited, pace = None, math.inf, 0, 1.0
    while True:
        state = _stepped(F.col("state"), F.col("p"), taken, pull)
        rated = current.select("doc_id", "n_tokens", "p", state.alias("state"))
        if not n:  # no tokens, nothing to weigh
            gaps = [-w for w in wanted]
            break
        if len(taken) == stride:
            current = written(rated, "mix-rates")
            rated, taken = current, []
        sums = rated.agg(
            *[F.sum(F.col("n_tokens") * F.col("state.ahead") * F.get("p", F.lit(k))).alias(f"t{k}") for k in range(len(DOMAINS))]
        ).first()
        gaps = [(sums[k] or 0.0) / n - wanted[k] for k in range(len(DOMAINS))]
        if weights is None:  # by the domain's share at rate 1, which makes the steps equally long in all domains
            weights = [1.0 / max((sums[k] or 0.0) / n, 1e-3) for k in range(len(DOMAINS))]
        loss = sum(w * g * g for w, g in zip(weights, gaps))
        waited = 0 if loss < 0.99 * least else waited + 1
        least = min(least, loss)
        if max(abs(g) for g in gaps) <= close or waited >= patience:
            break
        following = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        taken.append(([w * g for w, g in zip(weights, gaps)], (pace - 1) / following))
        pace = following
    return rated.select("doc_id", "n_tokens", "p", F.col("state.ahead").alias("rate")), dict(zip(DOMAINS, gaps))


def mix(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, n_tokens``, its posteriors, its ``rate``, and per domain the gap that the
    rates of all documents leave between the domain's share of the tokens and its target."""
    rated, gaps = fit_rates(posteriors(docs, labels, id_col, text_col), targets or TARGETS)
    return rated.select(
        "doc_id", "n_tokens", *[F.get("p", F.lit(k)).alias(f"p_{d}") for k, d in enumerate(DOMAINS)], "rate",
        *[F.lit(float(gap)).alias(f"gap_{d}") for d, gap in gaps.items()],
    )

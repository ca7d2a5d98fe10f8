"""Secret scan: candidates by shape, false positives removed by a random forest.

Candidates are runs of sixteen or more key characters, and whatever of four or more characters is
assigned to a name with a credential word, up to the next blank or quote; outside quotes also up to ``<``,
``>``, ``,``, ``;`` or the next parameter. The context of a candidate goes on through other candidates. Each is described by its length and
kinds of characters, the transitions between them, the share of its letter triples that
are common in the words of all documents (dictionary coverage), how much it looks like a path, and the
words and signs next to it. A random forest trained on labelled findings scores every
candidate; those at ``threshold`` or more are secrets.

``train`` takes labelled findings. ``bootstrap_labels`` makes them where none are kept: findings
assigned to a credential word with low coverage are secrets, findings of letters or of digits alone,
or of paths without such a word are not, the others stay unlabelled. Training takes at
most ``max_train`` findings, those with the smallest hashes, a documented bound.

Edge cases: null and empty text have no candidates. Rows that repeat id and text repeat
their findings. If the labels have fewer than two classes, the labelling rule itself decides.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstrata.llm.columns import ascii_lower, let, spans
from shopstrata.llm.scratch import written

_KEY = "A-Za-z0-9+/_-"
_WORDS = "token|secret|passw|pwd|api.?key|access.?key|auth|bearer|credential|private"
CREDENTIAL = rf"(?i)({_WORDS})"
SHORTEST = 4
# The assignment is looked for first: it is rare, and looking back for the name takes longer.
_ASSIGNED = (
    r"(?<=[=:]>?[ \t]{0,3}[\"']?)(?<=(?i:" + _WORDS + r")[A-Za-z0-9_.-]{0,24}[\"']?[ \t]{0,3}[=:]{1,2}>?[ \t]{0,3}[\"']?)"
    rf"(?:(?<=[\"'])[^\s\"']{{{SHORTEST},}}+|(?<![\"'])(?:[^\s\"'<>,;&]|&(?![\w.-]+=)){{{SHORTEST},}}+)"
)
# One or two signs at the end are padding where no value follows.
CANDIDATE = rf"{_ASSIGNED}|(?:(?<![{_KEY}])|\G)[{_KEY}]{{16,}}+(?:={{1,2}}+(?![={_KEY}]|[ \t]*+[\"']))?+"
WORD = rf"(?<![{_KEY}])[A-Za-z]{{3,15}}+(?![A-Za-z0-9+/_])"  # longer ones are candidates
MAX_TRAIN = 20_000
FEATURES = [
    "length", "digits", "uppers", "others", "transitions", "distinct", "hex", "coverage", "slashes", "dots_after",
    "credential", "assigned", "quoted", "words_before", "prefixed",
]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_key, start, end, hit, before, after`` per candidate."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    read = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"))
    return read.select(
        "doc_id", F.xxhash64("_text").alias("text_key"), F.explode(spans(F.col("_text"), CANDIDATE, least=SHORTEST)).alias("s")
    ).select("doc_id", "text_key", "s.*")


def _triples(text: Column) -> Column:
    letters = ascii_lower(text)
    return F.when(
        F.length(letters) >= 3,
        F.transform(F.sequence(F.lit(1), F.length(letters) - 2), lambda i: F.substring(letters, i, F.lit(3))),
    )


def _share(count: Column) -> Column:
    return count / F.char_length("hit")


def common_triples(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``triple``: the letter triples that make up more than an even share of all triples in words.

    A share of the whole, so that more documents of the same kind change nothing. Letters that touch digits or
    other key characters and runs as long as candidates are no words.
    """
    words = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD), F.lit(0))
    counts = written(
        docs.select(F.explode(words).alias("w")).select(F.explode(_triples(F.col("w"))).alias("triple"))
        .groupBy("triple").agg(F.count(F.lit(1)).alias("n")),
        "triples",
    )
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return counts.where(F.col("n") * F.lit(26**3) > F.lit(total)).select("triple")


def describe(found: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The candidates with their features; ``dictionary(triple)`` has the common letter triples."""
    hits = found.select("hit").distinct().select("hit", F.explode(_triples(F.col("hit"))).alias("triple"))
    # At most 26 ** 3 triples of letters exist, so this side has a fixed bound.
    known = hits.join(F.broadcast(dictionary.withColumn("known", F.lit(1))), "triple", "left")
    coverage = known.groupBy("hit").agg(F.avg(F.coalesce("known", F.lit(0))).alias("coverage"))
    kinds = F.regexp_replace(
        F.regexp_replace(F.regexp_replace(F.regexp_replace("hit", "[^A-Za-z0-9]", "."), "[0-9]", "#"), "[A-Z]", "A"), "[a-z]", "a"
    )
    described = found.join(coverage.withColumnRenamed("hit", "_hit"), F.col("hit") == F.col("_hit"), "left").drop("_hit")
    return described.withColumns({
        "coverage": F.coalesce("coverage", F.lit(0.0)),
        "length": F.char_length("hit").cast("double"),
        "digits": _share(F.regexp_count("hit", F.lit("[0-9]"))),
        "uppers": _share(F.regexp_count("hit", F.lit("[A-Z]"))),
        "others": _share(F.regexp_count("hit", F.lit("[^A-Za-z0-9]"))),
        # A change of kind between neighbours: runs of one kind, less one.
        "transitions": let(kinds, lambda k: _share(F.regexp_count(k, F.lit(r"#+|A+|a+|\.+")) - 1)),
        "distinct": F.size(F.array_distinct(F.split("hit", ""))).cast("double"),
        "hex": F.rlike("hit", F.lit("^[0-9a-fA-F]+$")).cast("double"),
        "slashes": F.regexp_count("hit", F.lit("/")).cast("double"),
        "dots_after": F.rlike("after", F.lit(r"^[./]\w")).cast("double"),
        "credential": F.rlike("before", F.lit(CREDENTIAL)).cast("double"),
        "assigned": F.rlike("before", F.lit(r"[=:]>?\s*[\"']?$")).cast("double"),
        "quoted": F.rlike("before", F.lit("[\"']$")).cast("double"),
        "words_before": F.regexp_count("before", F.lit("[A-Za-z]{2,}")).cast("double"),
        "prefixed": F.rlike("hit", F.lit("^(AKIA|gh[pousr]_|sk[-_]|xox[abp]-|eyJ)")).cast("double"),
    })


def _rule() -> Column:
    secret = (F.col("credential") == 1) & (F.col("assigned") == 1) & (F.col("coverage") < 0.5)
    plain = (F.col("credential") == 0) & ((F.col("digits") == 0) | (F.col("digits") == 1) | (F.col("slashes") > 1))
    return F.when(secret, F.lit(1.0)).when(plain, F.lit(0.0))


def bootstrap_labels(described: DataFrame) -> DataFrame:
    """Labelled findings from the rule; findings it cannot tell are left out."""
    return described.withColumn("label", _rule()).where(F.col("label").isNotNull())


def train(labelled: DataFrame, max_train: int = MAX_TRAIN):
    """A random forest from findings with features and ``label``, or None if there are not two classes."""
    sample = written(
        labelled.select(*FEATURES, "label", F.xxhash64("hit", "before", "after").alias("_order"))
        .orderBy("_order").limit(max_train).drop("_order"),
        "secret-labels",
    )
    if sample.select("label").distinct().count() < 2:
        return None
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample)
    return RandomForestClassifier(numTrees=30, maxDepth=6, seed=7, subsamplingRate=0.8).fit(rows.select("features", "label"))


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    labelled: DataFrame | None = None,
    threshold: float = 0.5,
    max_train: int = MAX_TRAIN,
) -> DataFrame:
    """One row per candidate: ``doc_id, text_key, start, end, hit, score, is_secret``."""
    found = written(candidates(docs, id_col, text_col), "candidates")
    described = written(describe(found, common_triples(docs, text_col)), "findings")
    model = train(bootstrap_labels(described) if labelled is None else labelled, max_train)
    if model is None:
        scored = described.withColumn("score", F.coalesce(_rule(), F.lit(0.0)))
    else:
        rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(described)
        scored = model.transform(rows).withColumn("score", vector_to_array("probability").getItem(1))
    return scored.select(
        "doc_id", "text_key", "start", "end", "hit", F.round("score", 6).alias("score"),
        (F.col("score") >= threshold).alias("is_secret"),
    )


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = "[SECRET]", **options) -> DataFrame:
    """The documents with their own columns, every secret in the text replaced by ``mask``.

    Secrets of sixteen or more characters are replaced wherever they occur in the text, shorter ones only where
    they were found, since they may be words elsewhere.
    """
    found = scan(docs, id_col, text_col, **options).where("is_secret")
    per_doc = found.groupBy(F.col("doc_id").alias("_llm_doc"), F.col("text_key").alias("_llm_text")).agg(
        F.sort_array(F.collect_set(F.when(F.char_length("hit") >= 16, F.col("hit"))), asc=False).alias("_llm_hits"),
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("_llm_spans"),
    )
    text = F.coalesce(F.col(text_col), F.lit(""))
    same = F.col(id_col).eqNullSafe(F.col("_llm_doc")) & (F.xxhash64(text) == F.col("_llm_text"))
    state = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))
    placed = F.aggregate(
        "_llm_spans", state,
        lambda a, s: F.struct(
            F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit(mask)).alias("out"),
            s["end"].alias("at"),
        ),
        lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.char_length(text))),
    )
    masked = F.aggregate("_llm_hits", placed, lambda t, hit: F.replace(t, hit, F.lit(mask)))
    return docs.join(per_doc, same, "left").withColumn(
        text_col, F.when(F.col("_llm_hits").isNull(), F.col(text_col)).otherwise(masked)
    ).select(*docs.columns)

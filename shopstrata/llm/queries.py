"""The registered queries of the subpackage and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstrata.llm import (
    chat,
    chosenpath,
    decontaminate,
    extract,
    maxent,
    mixing,
    pii,
    quality,
    ranked,
    repair,
    secrets,
    urls,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return maxent.score(_table(spark, folder, "documents"))


def op2_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(_table(spark, folder, "documents"))
    return found.select("doc_id", "start", "end", F.sha2("hit", 256).alias("secret_sha256"), "score", "is_secret")


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(_table(spark, folder, "documents"))


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.decontaminate(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op6_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    return chat.rotate(_table(spark, folder, "conversations"))


def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return chosenpath.join(_table(spark, folder, "documents")).drop("text_key", "group_key")


def op8_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(_table(spark, folder, "pages"))


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(_table(spark, folder, "pages")).drop("payload")


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.ledger(_table(spark, folder, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality.passes(quality.BASE, F.col("fail_bits"))).alias("base_failed"),
        quality.passes(quality.PRODUCTION, F.col("fail_bits")).alias("kept"),
        "n_lines", "n_upper", "fail_bits",
    )


def op11_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract.extract(_table(spark, folder, "pages")).withColumn("n_chars", F.char_length("text").cast("bigint"))


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.rank(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.report(repair.damage(_table(spark, folder, "conversations")))


QUERIES: dict[str, Query] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_secret_scans": op2_secret_scans,
    "op3_pii": op3_pii,
    "op4_decontamination": op4_decontamination,
    "op5_mixing": op5_mixing,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_url_filters": op8_url_filters,
    "op9_warc": op9_warc,
    "op10_quality_rules": op10_quality_rules,
    "op11_html_extraction": op11_html_extraction,
    "op12_lexical_search": op12_lexical_search,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLES: dict[str, str] = {
    "op4_decontamination": decontaminate.ORACLE,
    "op6_chat_formatting": chat.ORACLE,
    "op7_jaccard_join": chosenpath.ORACLE,
    "op9_warc": warc.ORACLE,
    "op10_quality_rules": quality.ORACLE,
    "op12_lexical_search": ranked.ORACLE,
    "op13_conversation_repair": repair.ORACLE,
}

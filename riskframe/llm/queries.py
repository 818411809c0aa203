"""One registered query per operator, over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import chat, decontaminate, jaccard, lines, lm, mixing, negatives, pages, quality, secrets, suffixes, topk, whitening
from riskframe.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # Every row is in one of two deliveries; the second is scanned over the ledger of the first.
    delivery = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    found, _ = secrets.scan_history([docs.filter(delivery == i) for i in range(2)])
    return secrets.digest_columns(found)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op5_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_inner_products(table(spark, sf_dir, "embeddings"), k=5, every=50)


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.similar_documents(table(spark, sf_dir, "documents"), k=3, percent=90)
    return found.select("doc_id", "n_shingles", "n_links", "component_id")


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest_columns(suffixes.remove_repeats(table(spark, sf_dir, "documents")))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(table(spark, sf_dir, "pages"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.component_rows(table(spark, sf_dir, "embeddings"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    other = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", other))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = lines.insert(lines.empty_ledger(spark), docs)
    return lines.digest_columns(lines.clean_lines(docs, ledger))


QUERIES: dict[str, Query] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_secret_scan": op2_secret_scan,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_source_mixing": op4_source_mixing,
    "op5_chat_rotation": op5_chat_rotation,
    "op6_exact_topk": op6_exact_topk,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_html_extraction": op10_html_extraction,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_line_dedup": op13_line_dedup,
}

"""Registered queries of the corpus operators: thin projections of each operator over its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import alignment, decontam, htmltext, langid, licenses, linedup, lm, packing, quality, secrets, simhash, variants, warc
from strata.llm.common import table
from strata.llm.oracle import ORACLE  # noqa: F401

TOKENIZER, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def vocab_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("url")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocab_path())


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "pages"), langid.train(table(spark, sf_dir, "documents")))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shortened text and the deleted line ranges of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = linedup.drop_repeated_runs(docs, report="runs")
    return out.select("doc_id", "text", F.coalesce(F.size("runs"), F.lit(0)).alias("n_runs"), F.transform(
        F.coalesce("runs", F.lit([]).cast("array<struct<lo:int,hi:int>>")),
        lambda r: F.concat(r["lo"], F.lit("-"), r["hi"])).alias("deleted_lines"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.train(docs))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_corpus(table(spark, sf_dir, "documents"), vocab_path(), vocab_path(PIECES))


QUERIES = {f.__name__: f for f in (
    op1_warc, op2_best_fit_packing, op3_license_scan, op4_benchmark_decontamination, op5_language_id, op6_line_dedup,
    op7_simhash, op8_secret_scan, op9_quality_rules, op10_lm_scoring,
    op11_html_extraction, op12_spelling_variants, op13_tokenizer_alignment)}

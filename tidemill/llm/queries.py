"""The registered queries of this package: name -> (Spark callable, DuckDB text or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm.alignment import alignment_report
from tidemill.llm.decontamination import contaminated
from tidemill.llm.language import identify_languages
from tidemill.llm.lexical import LEXICAL_SQL, ranked_documents
from tidemill.llm.licenses import license_report
from tidemill.llm.mixing import mix_report
from tidemill.llm.quality import QUALITY_SQL, quality_rules
from tidemill.llm.secrets import find_secrets
from tidemill.llm.simhash_dedup import simhash_groups
from tidemill.llm.substrings import repeated_paragraphs
from tidemill.llm.tokens import token_report
from tidemill.llm.toxicity import score_toxicity
from tidemill.llm.warc import page_records


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_report(table(spark, sf_dir, "documents"))


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_records(table(spark, sf_dir, "pages"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_paragraphs(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_report(table(spark, sf_dir, "documents"))


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(table(spark, sf_dir, "documents"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op3_simhash_dedup": (op3_simhash_dedup, None),
    "op9_toxicity": (op9_toxicity, None),
    "op10_decontamination": (op10_decontamination, None),
    "op8_mixing": (op8_mixing, None),
    "op2_token_output": (op2_token_output, None),
    "op1_secrets": (op1_secrets, None),
    "op7_warc": (op7_warc, None),
    "op6_quality": (op6_quality, QUALITY_SQL),
    "op5_language": (op5_language, None),
    "op4_substring_dedup": (op4_substring_dedup, None),
    "op13_alignment": (op13_alignment, None),
    "op12_licenses": (op12_licenses, None),
    "op11_search": (op11_search, LEXICAL_SQL),
}

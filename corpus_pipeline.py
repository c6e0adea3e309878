"""The training-data pipeline over `documents`: each stage's result is written as Parquet and read again for the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm.common import materialize
from tidemill.llm.decontamination import drop_contaminated
from tidemill.llm.mixing import mixed_documents
from tidemill.llm.simhash_dedup import keep_one
from tidemill.llm.tokens import token_report
from tidemill.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.5 or more go.

    Null and empty texts stay; equal rows stay or go together; null ids are scored, not learned from; no toxic label: nothing goes; an empty table gives no rows.
    """
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that with the smallest doc_id.

    Null texts and texts without words are one group; a null id only stays where its group has no other; of repeated rows with the smallest id one stays; an
    empty table gives no rows.
    """
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null and empty texts stay, as do repeated rows without an item; ids do not matter; an empty benchmark drops nothing, an empty table gives no rows.
    """
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights: a row for each taken part of a document and each pass.

    Texts that are null or have no word are in no mix; a null source is a source, the last one; repeated rows are documents of their own; equal rows are
    interchangeable; an empty table gives no rows.
    """
    return mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards with their index in the shared folder; the rows are read back from them: doc_id, start, n_tokens, ids_crc32.

    A null text has the end id alone; null ids come first, equal ids by a hash of their texts; repeated rows are written each; an empty table gives no rows.
    """
    return token_report(docs)


STAGES = [("toxicity", toxicity), ("simhash near-dedup", near_dedup), ("benchmark decontamination", decontamination),
          ("mixing to target weights", mixing), ("token-id output", token_output)]
#: The stages cannot be written in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, over the whole documents table."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        rows = materialize(stage(spark, rows, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, rows, sf_dir)

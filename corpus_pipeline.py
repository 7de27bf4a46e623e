"""The corpus pipeline: reject toxic documents, keep one of each group of near copies, redact secrets, pack.

Each stage takes (spark, docs, sf_dir); what it returns is written as Parquet and read again as the next one's docs. All
but the last return the columns of ``documents``. No SQL expresses a trained classifier or the packing search, so there
is none; the tests hold each stage against a brute-force version.

Edge cases, of all stages: a null or empty text is not toxic, no copy of anything, has no secret, and is one end id when packed; rows
without id, and ids that stand in several rows, are documents of their own, each kept or removed by its own text; of rows that tie as
the first of a class any one stays; texts of any length are read whole; an empty table gives no rows; other columns are handed
on by all stages but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm import packing, parity_join, secret_scan, toxicity
from starmill.llm.queries import RANKS, SPECIAL, toxicity_model
from starmill.llm.texts import documents, keep, send_package, table


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier does not reject; it learns from the labelled documents of its input."""
    return toxicity.keep_below(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of the smallest id, one row of it."""
    send_package(spark)
    return parity_join.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with their secrets replaced by the kind's name."""
    send_package(spark)
    return secret_scan.redact(docs).withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), "n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each document, with its sequence and the place in it."""
    send_package(spark)
    pieces = packing.tokenise(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, SPECIAL)
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("toxicity", toxic), ("near copies", near_copies), ("secrets", secrets), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)

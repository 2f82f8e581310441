"""Documents to token ids: five stages, each on all that its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.staging import stage
from tidemark.llm import bpe, decontaminate, quality_rules, secret_scan, simhash
from tidemark.llm.queries import RANKS, ship
from tidemark.llm.text import table


def drop_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each near-duplicate component."""
    ship(spark)
    return simhash.first_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return secret_scan.redact(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every remaining text, proved by decoding them."""
    ship(spark)
    vocabulary = (RANKS, public_tokenizers.PATTERN)
    steps = bpe.encoding(*vocabulary), bpe.decoding(*vocabulary)
    back = bpe.chain(docs.select("doc_id", "text"), *steps)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return back.select("doc_id", "ids", F.size("ids").alias("n_tokens"), same.alias("exact"))


STAGES = [
    ("quality_rules", drop_bad),
    ("simhash", drop_near_copies),
    ("decontamination", drop_leaks),
    ("secret_scan", mask_secrets),
    ("byte_bpe", tokenize),
]

#: The stages can't be said in SQL (robust estimates, a trained forest, byte-pair merges).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs

"""The pipeline from raw documents to token counts and digests, as stages that each apply one operator.

A stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept; ``docs`` has the columns of
``documents``. Each stage's result is written and read again before the next one, so lost executors repeat one
stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqspark.llm.bpe import token_digests
from dqspark.llm.jaccard import components_of_texts
from dqspark.llm.langid import fit_languages, held_out, identify_languages
from dqspark.llm.lines import dedup_lines
from dqspark.llm.mixing import mix_copies
from dqspark.plans.bounds import is_bounded
from dqspark.plans.storage import stored
from dqspark.session import use_utc


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language: those without letters or far from every language go."""
    model = fit_languages(docs.filter(~held_out(F.col("doc_id"))))
    return identify_languages(docs, model).filter("not rejected").select(docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less their repeated lines; a document may be left with an empty text."""
    kept = dedup_lines(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    return kept.select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group of near duplicates.

    A row is known by its id and its text, so of two texts under one id only that goes which has a smaller near
    duplicate. Equal rows stay or go together. Documents without an id stay. An empty table stays empty.
    """
    found = components_of_texts(docs.select("doc_id", "text")).filter("component_id <> doc_id")
    dropped = stored(found.select("doc_id", "text_hash").distinct(), "dropped")
    dropped = F.broadcast(dropped) if is_bounded(dropped) else dropped
    return docs.withColumn("text_hash", F.xxhash64("text")).join(dropped, ["doc_id", "text_hash"], "left_anti").select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in whole copies: none, one or two, so that each source meets its target."""
    return mix_copies(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes."""
    return token_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language ID", identified),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("mixing sources to target weights", mixed),
    ("byte-level BPE encoding and decoding", encoded),
]

# The centroids of the first stage are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    use_utc(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0].replace("-", "_"))
    return docs

"""Exact duplicates by sorting contents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dqspark.plans.storage import stored

BLANKS = " \t\n\x0b\x0c\r"
SALTS = 32
HEAD = 64


def without_blanks(text: Column) -> Column:
    """The text without any character of ``[\\x20\\x09-\\x0D]``; NULL is empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` for every row; other columns are not read.

    Sampled splitters range-partition the rows by normalised content, an external sort places equal
    contents next to each other, and a row starts a run unless its content equals that of the row before.
    Of a run, the row with the most code points stays, then the smallest id (NULL ids last). The sort
    key ends in a salt of the row, so that splitters can cut a content that holds much of the table: the
    runs of one content, at most ``SALTS``, are then brought together by its digest.

    NULL and blank texts are one content. Repeated rows, with one id, count each; the first of them
    in the sort is the one marked as kept. An empty table gives an empty result.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    rows = rows.select(
        "doc_id",
        F.char_length("t").alias("size"),
        without_blanks(F.col("t")).alias("content"),
        F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"),
    )
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Splitters are sampled keys that the driver holds: the content's beginning, and its hash for contents that begin alike.
    rows = rows.withColumns({"head": F.left("content", F.lit(HEAD)), "hash": F.xxhash64("content")})
    dealt = rows.repartitionByRange(parts, "head", "hash", "salt")
    cell = Window.partitionBy("head", "hash", "content", "salt").orderBy(F.desc("size"), F.asc_nulls_last("doc_id"))
    # The neighbour before, compared in full; a run's first row is its best.
    marked = dealt.withColumn("place", F.row_number().over(cell)).select(
        "doc_id", "size", "salt", "place", F.sha2("content", 256).alias("sha")
    )
    marked = stored(marked, "contents")
    runs = marked.groupBy("sha", "salt").agg(
        F.count("*").alias("n"),
        F.max(F.when(F.col("place") == 1, F.struct("size", "doc_id"))).alias("head"),
    )
    whole = Window.partitionBy("sha")
    best = whole.orderBy(F.desc("head.size"), F.asc_nulls_last("head.doc_id"))
    groups = runs.select(
        "sha",
        "salt",
        F.sum("n").over(whole).alias("group_size"),
        F.first("head").over(best).alias("best"),
        F.row_number().over(best).alias("rank"),
    )
    named = marked.join(groups, ["sha", "salt"])
    return named.select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        ((F.col("rank") == 1) & (F.col("place") == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )

"""Token counts: an exact histogram of encoded lengths with suffix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dqspark.llm.bpe import token_counts
from dqspark.plans.storage import stored

BAND = 1024


def length_histogram(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """``(n_tokens, n_docs)``: the number of rows of each encoded length. NULL counts as empty, length 0."""
    return token_counts(docs, ranks_path, pattern, text).groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def length_report(histogram: DataFrame) -> DataFrame:
    """What every context limit would do, one row for each length that occurs, taken as the limit.

    ``docs_over`` and ``tokens_over`` are documents longer than the limit and their tokens,
    ``truncated_tokens`` is the total when each document is cut at the limit, ``lost_tokens`` what that
    leaves out, ``share`` the part of documents that fit (the limit is the quantile of that share). Sums are exact: suffix
    sums within bands of 1024 lengths, and over the bands, whose number the longest document bounds. An
    empty histogram gives an empty result. The histogram is stored, as it is read twice: this runs a job.
    """
    rows = stored(histogram, "lengths").withColumns({
        "band": F.floor(F.col("n_tokens") / BAND),
        "tokens": F.col("n_tokens") * F.col("n_docs"),
    })
    after = Window.partitionBy("band").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    bands = rows.groupBy("band").agg(F.sum("n_docs").alias("docs"), F.sum("tokens").alias("toks"))
    later = Window.partitionBy(F.lit(0)).orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    all_ = Window.partitionBy(F.lit(0))
    none = F.lit(0).cast("long")
    bands = bands.select(
        "band",
        F.coalesce(F.sum("docs").over(later), none).alias("docs_later"),
        F.coalesce(F.sum("toks").over(later), none).alias("toks_later"),
        F.sum("docs").over(all_).alias("docs_all"),
        F.sum("toks").over(all_).alias("toks_all"),
    )
    docs_over: Column = F.coalesce(F.sum("n_docs").over(after), none) + F.col("docs_later")
    toks_over: Column = F.coalesce(F.sum("tokens").over(after), none) + F.col("toks_later")
    out = rows.join(bands, "band").withColumns({"docs_over": docs_over, "tokens_over": toks_over})
    lost = F.col("tokens_over") - F.col("docs_over") * F.col("n_tokens")
    return out.select(
        "n_tokens",
        "n_docs",
        "docs_over",
        "tokens_over",
        (F.col("toks_all") - lost).alias("truncated_tokens"),
        lost.alias("lost_tokens"),
        (1 - F.col("docs_over") / F.col("docs_all")).alias("share"),
    )

"""Indicator tags and status rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAG_SCHEMA = "indicator_id bigint, tags array<string>"


def indicator_tags(definitions: DataFrame) -> DataFrame:
    """``indicator_id`` and its ``key:value`` tags, one per source dataset among them."""

    def tag(key: str, column: str):
        return F.concat(F.lit(f"{key}:"), F.coalesce(F.col(column).cast("string"), F.lit("")))

    single = F.array(
        tag("name", "indicator_name"),
        tag("delay_seconds", "lag"),
        tag("timestamp_col", "timestamp_column"),
        tag("data_source", "computed_dataset_source"),
        tag("lookback_seconds", "lookback_window_length"),
    )
    datasets = F.transform(
        F.coalesce("raw_dataset_names", F.array().cast("array<string>")),
        lambda name: F.concat(F.lit("dataset:"), name),
    )
    return definitions.select(F.col("indicator_id"), F.concat(single, datasets).alias("tags"))


def merge_tags(stored: DataFrame, later: DataFrame) -> DataFrame:
    """Tags of both tables per indicator, the stored ones first."""
    none = F.array().cast("array<string>")
    a, b = stored.alias("a"), later.alias("b")
    return a.join(b, F.col("a.indicator_id") == F.col("b.indicator_id"), "full").select(
        F.coalesce("a.indicator_id", "b.indicator_id").alias("indicator_id"),
        F.concat(F.coalesce("a.tags", none), F.coalesce("b.tags", none)).alias("tags"),
    )


def indicator_statuses(
    definitions: DataFrame, error: str | None = None, meta: dict[str, str] | None = None
) -> DataFrame:
    """One status row per indicator and evaluation time (epoch ms) of exploded definitions."""
    details = dict(meta or {})
    if error:
        details["error"] = error
    pairs = [F.lit(x) for item in sorted(details.items()) for x in item]
    value = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    return definitions.select(
        "indicator_id", (F.col("evaluation_time") * 1000).alias("evaluation_time"), value.alias("meta")
    )

"""Long metric series from wide indicator results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqspark.functions.columns import EMPTY_LABEL, INDICATOR_PREFIX, RANGE_COLUMNS
from dqspark.operators.indicators import observed_only
from dqspark.plans.joins import lookup_join, quoted

NAME_TAG = "name:"
SCALARS = (T.NumericType, T.StringType, T.BooleanType, T.NullType)


def metric_series(
    result: DataFrame,
    tags: DataFrame | None = None,
    prefix: str = "dqspark",
    fixed_tags: Sequence[str] = ("origin:dqspark",),
) -> DataFrame:
    """Rows ``(indicator_id, metric, timestamp, value, tags)``, one per indicator and group.

    Sketch, time and nested columns are left out. Groups without an observed time range and NULL values are left out, each metric on its own. The
    time is the end of the look-back range. Tags are ``dimension:value``, the fixed ones and those
    of the indicator; a ``name:`` tag names the metric and gives way to ``indicator_id:``.
    """
    indicators = [c for c in result.columns if c.startswith(INDICATOR_PREFIX)]
    if not indicators:
        raise ValueError("the result holds no indicator column")
    dimensions = [c for c in result.columns if c not in indicators and c not in RANGE_COLUMNS]
    rows = observed_only(result)
    # Sketches and other values without a number have no place in a series.
    numbers = [c for c in indicators if isinstance(result.schema[c].dataType, SCALARS)]
    values = F.array(
        *[
            F.struct(
                F.lit(int(c.removeprefix(INDICATOR_PREFIX))).cast("bigint").alias("indicator_id"),
                F.col(quoted(c)).try_cast("double").alias("value"),
            )
            for c in numbers
        ]
    ).cast("array<struct<indicator_id: bigint, value: double>>")
    dimension_tags = [
        F.concat(F.lit(f"{d}:"), F.coalesce(F.col(quoted(d)).cast("string"), F.lit(EMPTY_LABEL)))
        for d in dimensions
    ]
    base = F.concat(
        F.array(*dimension_tags).cast("array<string>"), F.array(*map(F.lit, fixed_tags)).cast("array<string>")
    )
    long = (
        rows.select(
            F.col("_lookback_range_end_ts").cast("bigint").alias("timestamp"),
            base.alias("_base"),
            F.inline(F.filter(values, lambda v: v.getField("value").isNotNull())),
        )
    )
    id_name = F.concat(F.lit(INDICATOR_PREFIX), F.col("indicator_id").cast("string"))
    if tags is None:
        metric = F.concat(F.lit(f"{prefix}."), id_name)
        return long.select("indicator_id", metric.alias("metric"), "timestamp", "value", F.col("_base").alias("tags"))
    own = tags.groupBy(F.col("indicator_id").cast("bigint").alias("indicator_id")).agg(F.first("tags", True).alias("_tags"))
    # Few indicators, each with many values: the values stay where they are, or hot ids are spread.
    joined = lookup_join(long, own, ["indicator_id"])
    mine = F.coalesce("_tags", F.array().cast("array<string>"))
    named = F.filter(mine, lambda t: t.startswith(NAME_TAG))
    name = F.substring(F.get(named, F.lit(0)), len(NAME_TAG) + 1, 2**31 - 1)
    rest = F.filter(mine, lambda t: ~t.startswith(NAME_TAG))
    with_id = F.array_append(rest, F.concat(F.lit("indicator_id:"), F.col("indicator_id").cast("string")))
    return joined.select(
        "indicator_id",
        F.concat(F.lit(f"{prefix}."), F.coalesce(name, id_name)).alias("metric"),
        "timestamp",
        "value",
        F.concat(F.col("_base"), F.when(F.size(named) > 0, with_id).otherwise(rest)).alias("tags"),
    )

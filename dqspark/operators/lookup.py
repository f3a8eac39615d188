"""Name-to-code lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqspark.plans.joins import lookup_join, quoted


def code_lookup(
    df: DataFrame, column: str, codes: DataFrame, output: str | None = None, small: bool | None = None
) -> DataFrame:
    """Replace a name by its code: by official name first, then by common name, else unchanged.

    ``codes`` holds ``official_name``, ``name`` and ``code``. A code table that passes the size check
    is broadcast, a larger one is joined with the names salted.
    """
    ranked = (
        codes.select(F.col("code"), F.inline(F.array(
            F.struct(F.lit(0).alias("_rank"), F.col("official_name").alias("_key")),
            F.struct(F.lit(1).alias("_rank"), F.col("name").alias("_key")),
        )))
        .filter(F.col("_key").isNotNull())
        # One row per name: a repeated name must not repeat the data rows.
        .groupBy("_key")
        .agg(F.min_by("code", F.struct("_rank", "code")).alias("_code"))
    )
    keyed = df.withColumn("_key", F.col(quoted(column)))
    joined = lookup_join(keyed, ranked, ["_key"], "left", small)
    return joined.withColumn(output or column, F.coalesce("_code", "_key")).drop("_code", "_key")

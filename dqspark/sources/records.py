"""Many JSON lines merged to one record per object."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqspark.plans.joins import quoted

LINE, POSITION = "line", "position"


def object_lines(spark: SparkSession, path: str | Sequence[str], by: str = "object") -> DataFrame:
    """``(object, position, line)``: the lines of text objects, ``position`` ordering those of one object.

    A large object is read in several splits, by as many tasks. A position is where its split begins, then the
    running number that Spark gives the rows of a task, which reads a split from its begin to its end. The number
    comes right from the scan, so a task that runs again gives the same ones. Blank lines are left out.
    """
    rows = spark.read.option("recursiveFileLookup", True).text(path)
    place = F.struct(F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("row"))
    numbered = rows.select(F.col("_metadata.file_path").alias(by), place.alias(POSITION), F.col("value").alias(LINE))
    return numbered.filter(F.trim(LINE) != "")


def merge_records(
    lines: DataFrame, text: str, position: str, schema: T.StructType | str, by: Sequence[str] = ()
) -> DataFrame:
    """One row per object with the last value of each key, lines taken in the order of ``position``.

    A key that a line carries replaces the earlier value even when it is NULL; a key that it lacks
    leaves the earlier value alone. Lines that are no JSON object are left out.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = lines.select(
        *[F.col(quoted(c)) for c in by],
        F.col(quoted(position)).alias("_at"),
        F.from_json(F.col(quoted(text)), fields).alias("_record"),
        F.json_object_keys(F.col(quoted(text))).alias("_keys"),
    )
    exprs: list[Column] = []
    for f in fields.fields:
        at = F.when(F.array_contains("_keys", f.name), F.col("_at"))
        exprs.append(F.max_by(F.col("_record").getField(f.name), at).alias(f.name))
    keys = [F.col(quoted(c)) for c in by]
    return rows.groupBy(*keys).agg(*exprs) if keys else rows.agg(*exprs)

"""Profiles of objects as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from dqspark.functions.timecols import freshness_label, freshness_minutes
from dqspark.operators.profile import profile
from dqspark.plans.joins import epoch_seconds
from dqspark.sources.readers import csv_options, fitting_lines, wide_csv_schema

OBJECT, BATCH = "object", "batch_id"


def object_stream(
    spark: SparkSession,
    path: str,
    file_type: str,
    schema: T.StructType | str,
    files_per_trigger: int | None = None,
    **options: object,
) -> DataFrame:
    """Rows of every object that arrives under ``path``, with the ``object`` they came from.

    Formats and CSV rules are those of :func:`dqspark.sources.readers.read_dataset`.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader = spark.readStream.format({"jsonl": "json"}.get(file_type, file_type))
    if file_type == "json":
        reader = reader.option("multiLine", True)
    if file_type == "csv":
        reader = reader.options(**csv_options())
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    wanted = wide_csv_schema(fields) if file_type == "csv" else fields
    rows = reader.options(**options).schema(wanted).load(path).withColumn(OBJECT, F.col("_metadata.file_path"))
    return fitting_lines(rows, len(fields.fields), str(options.get("sep", ","))) if file_type == "csv" else rows


def run_batches(
    stream: DataFrame,
    compute: Callable[[DataFrame, int], DataFrame],
    path: str,
    checkpoint: str,
    available_now: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Write ``compute(batch, batch_id)`` under ``path``, one folder per batch.

    A batch that runs again after a failure overwrites its own folder, so each row counts once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        compute(batch, batch_id).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{BATCH}={batch_id}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def profile_stream(
    stream: DataFrame, path: str, checkpoint: str, settings: Mapping, **trigger: object
) -> StreamingQuery:
    """Profile each arriving object; ``settings`` are those of :func:`profile`.

    The stored rows are merged over objects and batches by
    :func:`dqspark.operators.rollup.rollup_metrics`.
    """

    def compute(batch: DataFrame, batch_id: int) -> DataFrame:
        return profile(batch, by=[OBJECT], **settings).metrics

    return run_batches(stream, compute, path, checkpoint, **trigger)


def freshness_stream(
    stream: DataFrame,
    timestamp: str,
    path: str,
    checkpoint: str,
    reference: int | None = None,
    by: tuple[str, ...] = (),
    **trigger: object,
) -> StreamingQuery:
    """Rows per freshness bucket and micro-batch, against ``reference`` or the batch's own time."""

    def compute(batch: DataFrame, batch_id: int) -> DataFrame:
        now = F.lit(int(reference)) if reference is not None else F.unix_seconds(F.current_timestamp())
        minutes = freshness_minutes(now, epoch_seconds(batch, timestamp))
        return batch.groupBy(*by, freshness_label(minutes).alias("freshness")).agg(F.count(F.lit(1)).alias("records"))

    return run_batches(stream, compute, path, checkpoint, **trigger)

"""Profiles of the objects that notifications name, with a log of what became of each object.

The objects of a batch are matched to datasets by bucket and key. Those of one dataset are read by one scan over
all their paths and profiled object by object in one aggregation, so a batch costs as many scans as it has datasets.
An object that is gone, or that cannot be read, is a row of the log and keeps no other from being profiled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dqspark.operators.datasets import Dataset, decoded_path, profile_objects
from dqspark.operators.profile import GROUP_SIZE, RECORD_COUNT
from dqspark.plans.joins import quoted
from dqspark.plans.storage import stored
from dqspark.sources.notifications import arrived_objects
from dqspark.sources.objects import ObjectConfig, config_table, inspect_objects, match_configs
from dqspark.sources.readers import read_dataset
from dqspark.streaming.objects import BATCH, OBJECT

PATHS_PER_READ = 10_000
GONE, EMPTY = "object not found", "no record could be read"


@dataclass(frozen=True)
class NotifiedDataset:
    """A dataset whose objects arrive in a bucket."""

    bucket: str
    dataset: Dataset

    @property
    def config(self) -> ObjectConfig:
        d = self.dataset
        return ObjectConfig(d.name, self.bucket, d.prefix.strip("/") + "/", d.suffix_template, d.file_type, d.separator)


@dataclass
class NotifiedRun:
    """Metric rows by dataset, and one log row for each object of a dataset."""

    metrics: dict[str, DataFrame]
    log: DataFrame | None


def matched_objects(notifications: DataFrame, datasets: Sequence[NotifiedDataset], payload: str = "payload") -> DataFrame:
    """``(dataset, bucket, object_key, event)`` of the distinct objects that belong to a dataset; the first one wins."""
    spark = notifications.sparkSession
    arrived = arrived_objects(notifications.select(F.col(quoted(payload)).alias("event")), "event")
    hit = match_configs(arrived, config_table(spark, [d.config for d in datasets]))
    # An object that is notified twice is one object; its last event by text is kept, whichever came first.
    return hit.groupBy("dataset", "bucket", "object_key").agg(F.max("event").alias("event"))


def existing_paths(spark: SparkSession, paths: Sequence[str], read: Callable[[list[str]], DataFrame]) -> tuple[DataFrame | None, list[str]]:
    """The scan of those paths that exist, and the others.

    Spark lists the paths of a scan and refuses it if one is missing. Halves are tried until the missing ones are
    apart: no job runs for it, and the store is asked again only for halves with a gap.
    """
    present, absent, todo = [], [], [list(paths)]
    while todo:
        some = todo.pop()
        if not some:
            continue
        try:
            # A scan of text lists its files only; no schema is inferred here.
            spark.read.text(some)
            present += some
        except AnalysisException as failure:
            if "PATH_NOT_FOUND" not in (failure.getCondition() or ""):
                raise
            if len(some) == 1:
                absent += some
            else:
                todo += [some[: len(some) // 2], some[len(some) // 2 :]]
    return (read(sorted(present)) if present else None), absent


def bare_path(uri: Column) -> Column:
    """A path without scheme and escapes, as which paths from listings and from keys compare equal."""
    return F.regexp_replace(uri, "^(?:[^:/]+:)?/+", "")


def _escaped(path: str) -> str:
    """A path that names one object: signs with a meaning in path patterns are escaped."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path)


def profile_notifications(
    notifications: DataFrame,
    datasets: Sequence[NotifiedDataset],
    roots: Callable[[str], str],
    execution_time: int = 0,
    source_id: str = "",
    payload: str = "payload",
    paths_per_read: int = PATHS_PER_READ,
) -> NotifiedRun:
    """Profile each object that the notifications name, and log each.

    ``roots`` gives the path of a bucket. Objects of no dataset are left out. The log has a row for each object:
    ``dataset, bucket, object_key, event, execution_time, min_primary_time, max_primary_time, primary_time_column,
    total_record_count, size, schema, error``; an object that is gone or gave no record has an error and no times.
    The paths of a batch come to the driver, as Spark lists them there: the stream's trigger bounds them. This runs jobs.
    """
    spark = notifications.sparkSession
    objects = stored(matched_objects(notifications, datasets, payload), "notified")
    metrics: dict[str, DataFrame] = {}
    logs = []
    names = {r["dataset"] for r in objects.select("dataset").distinct().collect()}
    for place in datasets:
        dataset = place.dataset
        if dataset.name not in names:
            continue
        root = roots(place.bucket).rstrip("/")
        mine = objects.filter((F.col("dataset") == dataset.name) & (F.col("bucket") == place.bucket))
        mine = mine.withColumn("path", F.concat(F.lit(root + "/"), "object_key"))
        inspected = stored(inspect_objects(mine, dataset.file_type), "inspected")
        paths = sorted(r["path"] for r in inspected.filter("not broken").select("path").collect())
        found, absent, errors = [], [], {}

        def read(some: list[str], dataset: Dataset = dataset) -> DataFrame:
            return read_dataset(spark, some, dataset.file_type, dataset.schema, tolerant=True)

        for at in range(0, len(paths), paths_per_read):
            some = paths[at : at + paths_per_read]
            plain = {_escaped(p): p for p in some}
            try:
                rows, gone = existing_paths(spark, list(plain), read)
            except AnalysisException as failure:
                # Not one of them has a schema.
                errors |= {p: str(failure).splitlines()[0] for p in some}
                continue
            absent += [plain[p] for p in gone]
            if rows is not None:
                found.append(rows.withColumn(OBJECT, F.col("_metadata.file_path")))
        times, primary = None, None
        if found:
            rows = found[0]
            for more in found[1:]:
                rows = rows.unionByName(more, allowMissingColumns=True)
            result = profile_objects(rows, root, dataset, source_id, execution_time)
            made = stored(result.metrics, "notified-metrics")
            metrics[dataset.name] = made
            primary = result.times.primary
            c = F.col(quoted(primary))
            times = made.groupBy(bare_path(decoded_path(F.col(OBJECT))).alias("_bare")).agg(
                F.min(c).alias("min_primary_time"), F.max(c).alias("max_primary_time"), F.sum(GROUP_SIZE).alias(RECORD_COUNT)
            )
        logs.append(_log(mine, inspected, times, primary, absent, errors, execution_time))
    if not logs:
        return NotifiedRun({}, None)
    log = logs[0]
    for more in logs[1:]:
        log = log.unionByName(more)
    return NotifiedRun(metrics, log)


def _log(
    objects: DataFrame,
    inspected: DataFrame,
    times: DataFrame | None,
    primary: str | None,
    absent: list[str],
    errors: dict[str, str],
    execution_time: int,
) -> DataFrame:
    spark = objects.sparkSession
    known = spark.createDataFrame([(p, GONE) for p in absent] + list(errors.items()), "path string, _known string")
    rows = objects.join(inspected, "path", "left").join(known, "path", "left")
    rows = rows.withColumn("_bare", bare_path(F.col("path")))
    if times is None:
        times = spark.createDataFrame([], f"_bare string, min_primary_time bigint, max_primary_time bigint, {RECORD_COUNT} bigint")
    rows = rows.join(times, "_bare", "left")
    unread = F.col(RECORD_COUNT).isNull()
    error = F.coalesce(
        "_known", F.when(unread, F.coalesce("error", F.when(F.col("schema").isNull() & (F.col("size") > 0), F.lit(EMPTY))))
    )
    return rows.select(
        "dataset",
        "bucket",
        "object_key",
        "event",
        F.lit(int(execution_time)).cast("bigint").alias("execution_time"),
        "min_primary_time",
        "max_primary_time",
        F.lit(primary).cast("string").alias("primary_time_column"),
        F.coalesce(RECORD_COUNT, F.lit(0)).cast("bigint").alias(RECORD_COUNT),
        "size",
        "schema",
        error.alias("error"),
    )


def profile_notified(
    notifications: DataFrame,
    datasets: Sequence[NotifiedDataset],
    roots: Callable[[str], str],
    output: str,
    checkpoint: str,
    available_now: bool = True,
    interval: str = "1 minute",
    **settings,
) -> StreamingQuery:
    """Profile the objects of each batch of a stream of notifications.

    Writes ``<output>/metrics/<dataset>/batch_id=<n>`` and ``<output>/log/batch_id=<n>``. A batch that runs again
    overwrites its own folders, so each object of it counts once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        run = profile_notifications(batch, datasets, roots, **settings)
        for name, rows in run.metrics.items():
            rows.write.mode("overwrite").parquet(f"{output.rstrip('/')}/metrics/{name}/{BATCH}={batch_id}")
        if run.log is not None:
            run.log.write.mode("overwrite").parquet(f"{output.rstrip('/')}/log/{BATCH}={batch_id}")

    writer = notifications.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()

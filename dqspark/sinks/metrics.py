"""Writers of small metric tables. Every function here runs a job."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqspark.functions.columns import to_base64_text
from dqspark.operators.indicators import Family, batches_of_families, evaluate_family, observed_only, shared_results
from dqspark.operators.profile import dimension_values, time_range
from dqspark.operators.tags import TAG_SCHEMA, indicator_statuses
from dqspark.plans.joins import quoted

log = logging.getLogger(__name__)

# The folders of a time of ingestion.
INGESTION_PARTS = ("year", "month", "day", "hour", "minute")
RUN = "run_id"


def for_csv(df: DataFrame) -> DataFrame:
    """Binary columns as base64 and nested ones as JSON text."""
    out = []
    for f in df.schema.fields:
        c = F.col(quoted(f.name))
        if isinstance(f.dataType, T.BinaryType):
            c = to_base64_text(c, f.dataType)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def write_metrics(
    result: DataFrame,
    path: str,
    location: Mapping[str, object],
    ingested: dt.datetime | None = None,
    file_type: str = "parquet",
    mode: str = "append",
) -> list[str]:
    """Append result rows under ``<location…>/year=/month=/day=/hour=/minute=`` folders.

    ``location`` names the leading folders, such as organisation, source and compute hash. Rows
    without an observed time range are left out. Gives the partition columns.
    """
    ingested = ingested or dt.datetime.now(dt.timezone.utc)
    rows = result
    if {"_result_min_ts", "_result_max_ts"} <= set(rows.columns):
        rows = observed_only(rows)
    parts = dict(location) | {p: f"{getattr(ingested, p):02d}" for p in INGESTION_PARTS}
    if file_type == "csv":
        rows = for_csv(rows)
    rows = rows.withColumns({name: F.lit(str(value)) for name, value in parts.items()})
    writer = rows.write.mode(mode).partitionBy(*parts).format(file_type)
    (writer.option("header", True) if file_type == "csv" else writer).save(path)
    return list(parts)


def write_run(rows: DataFrame, path: str, run_id: str, parts: Sequence[str] = ()) -> None:
    """Write the rows of one run under ``run_id=``, in place of what an earlier attempt of that run has written.

    Spark stages the files of a job and moves them when all tasks have ended; then only the folders of this run are
    replaced. So a run that is repeated, after a failure or by mistake, gives its rows once, and other runs stay.
    """
    placed = rows.withColumn(RUN, F.lit(str(run_id)))
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(RUN, *parts).parquet(path)


def write_families(
    spark: SparkSession,
    families: Iterable[Family],
    path: str,
    status_path: str,
    source_id: str,
    mode: str = "approx",
    run_id: str | None = None,
    **options,
) -> None:
    """Evaluate and write each family, and the status of its indicators with the error if it failed.

    Families that lie together and read one dataset share a scan. One that fails does not keep the others from being
    written. With a ``run_id``, metrics and statuses lie
    under the run and the family, and writing the run once more replaces them (:func:`write_run`).
    """
    for batch in batches_of_families(families):
        shared = shared_results(spark, batch, mode)
        for n, family in enumerate(batch):
            error = None
            try:
                place = {"org_id": family.org_id, "source_id": source_id, "compute_hash": family.key}
                result = shared[n] if n in shared else evaluate_family(spark, family, mode)
                if run_id is None:
                    write_metrics(result, path, place, **options)
                else:
                    found = observed_only(result) if family.timestamp else result
                    placed = found.withColumns({name: F.lit(str(value)) for name, value in place.items()})
                    write_run(placed, path, run_id, list(place))
            except Exception as failure:  # noqa: BLE001 - the status row carries it
                log.warning("family %s failed: %s", family.key, failure)
                error = str(failure)
            write_statuses(spark, family, status_path, error, run_id)


def family_statuses(spark: SparkSession, family: Family) -> DataFrame:
    """``(indicator_id, evaluation_time)`` of each indicator and time of a family, made by tasks from the two lists."""
    ids = spark.createDataFrame([(family.indicator_ids, list(family.times))], "ids array<bigint>, times array<bigint>")
    each = ids.select(F.explode("ids").alias("indicator_id"), "times")
    return each.select("indicator_id", F.explode("times").alias("evaluation_time"))


def write_statuses(
    spark: SparkSession, family: Family, path: str, error: str | None = None, run_id: str | None = None
) -> None:
    """Append the statuses of a family, or write them in place of those of the same run."""
    rows = indicator_statuses(family_statuses(spark, family), error)
    if run_id is None:
        rows.write.mode("append").parquet(path)
    else:
        write_run(rows.withColumn("compute_hash", F.lit(family.key)), path, run_id, ["compute_hash"])


def run_log(
    metrics: DataFrame,
    primary: str,
    objects: DataFrame | None = None,
    by: Sequence[str] = (),
    **constants: object,
) -> DataFrame:
    """One row per processed object: first and last primary time and what the caller adds.

    ``objects`` may bring further columns per object, such as the input event; objects without
    metrics stay in the log with no times. The dimension values of the run are rows of their own,
    see :func:`run_dimensions`.
    """
    if by:
        c = F.col(quoted(primary))
        keys = [F.col(quoted(k)) for k in by]
        found = metrics.groupBy(*keys).agg(F.min(c).alias("min_primary_time"), F.max(c).alias("max_primary_time"))
        if objects is not None:
            found = objects.join(found, list(by), "left")
    else:
        found = time_range(metrics, primary)
    return found.withColumns(
        {"primary_time_column": F.lit(primary)} | {name: F.lit(value) for name, value in constants.items()}
    )


def run_dimensions(metrics: DataFrame, dimensions: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Distinct dimension values of a run, one row each, to be stored beside its log."""
    return dimension_values(metrics, dimensions, by)


# -- tags ----------------------------------------------------------------------------------------


def write_tags(tags: DataFrame, path: str) -> None:
    """Append tags with the time of writing; of an indicator's sets, the newest is read."""
    stamped = tags.select("indicator_id", "tags", F.current_timestamp().alias("written"))
    stamped.write.mode("append").parquet(path)


def read_tags(spark: SparkSession, path: str, indicator_ids: DataFrame | Sequence[int] | None = None) -> DataFrame:
    """Stored tags of the indicators, by a filter or a semi join."""
    stored_tags = spark.read.schema(f"{TAG_SCHEMA}, written timestamp").parquet(path)
    # Sets from before times were kept count as the oldest.
    written = F.coalesce("written", F.timestamp_seconds(F.lit(0)))
    tags = stored_tags.groupBy("indicator_id").agg(F.max_by("tags", written).alias("tags"))
    if indicator_ids is None:
        return tags
    if isinstance(indicator_ids, DataFrame):
        return tags.join(indicator_ids.select("indicator_id"), "indicator_id", "left_semi")
    return tags.filter(F.col("indicator_id").isin(list(indicator_ids)))


# -- catalog -------------------------------------------------------------------------------------


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def register_table(
    spark: SparkSession, name: str, schema: T.StructType | str, path: str, partitions: Sequence[str] = ()
) -> None:
    """External parquet table over a folder, partitioned by string columns."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = T.StructType([f for f in fields.fields if f.name not in partitions])
    parts = T.StructType([T.StructField(p, T.StringType()) for p in partitions])
    ddl = T.StructType([*columns.fields, *parts.fields]).toDDL()
    by = f"PARTITIONED BY ({', '.join(map(quoted, partitions))})" if partitions else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet {by} LOCATION {_literal(path)}")


def _literal(value: object) -> str:
    """A value as SQL text."""
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def add_partition(spark: SparkSession, name: str, values: Mapping[str, object], path: str | None = None) -> None:
    spec = ", ".join(f"{quoted(k)} = {_literal(v)}" for k, v in values.items())
    location = f" LOCATION {_literal(path)}" if path else ""
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({spec}){location}")


def discover_partitions(spark: SparkSession, name: str) -> None:
    """Add all partitions whose folders exist under the table's location."""
    spark.sql(f"MSCK REPAIR TABLE {name}")

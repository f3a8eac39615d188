"""Datasets made of objects: rows with the fields of their path, profiled object by object."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dqspark.functions.columns import add_path_fields, resolve_name
from dqspark.operators.profile import Profile, prepare_dimensions, profile
from dqspark.sources.objects import path_fields, path_template
from dqspark.sources.readers import read_dataset
from dqspark.sources.records import LINE, POSITION, merge_records, object_lines
from dqspark.streaming.objects import OBJECT, object_stream, run_batches


@dataclass(frozen=True)
class Dataset:
    """What to read under a prefix and what to measure of it."""

    name: str
    prefix: str
    suffix_template: str
    file_type: str
    strings: Sequence[str] = ()
    numbers: Sequence[str] = ()
    timestamps: Mapping[str, Mapping] = field(default_factory=dict)
    dimensions: Sequence[str] | Mapping = ()
    separator: str = "="
    schema: object = None


def decoded_path(uri: Column) -> Column:
    """The path of a file's URI: ``%XX`` decoded, a plus sign kept."""
    return F.coalesce(F.try_url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))), uri)


def with_path_columns(rows: DataFrame, root: str, dataset: Dataset) -> tuple[DataFrame, list[str]]:
    """Add the path fields of the dataset's template to rows that carry their ``object`` path.

    Rows of objects whose path does not fit the template are left out. Fields found by ``{*}``
    have no name beforehand and are given in the map column ``path_fields``.
    """
    template = path_template(dataset.suffix_template, dataset.separator)
    base = f"{root.rstrip('/')}/{dataset.prefix.strip('/')}".rstrip("/")
    # Scheme and slashes before the root differ between file systems; the root itself does not.
    suffix = F.element_at(F.split(decoded_path(F.col(OBJECT)), _literal(base.split("://")[-1].lstrip("/") + "/"), 2), -1)
    fields = path_fields(
        suffix,
        F.lit(template.pattern),
        F.array(*[F.lit(n) for n in template.names]),
        F.lit(dataset.separator),
    )
    # Partition writers escape signs in values once more.
    fields = F.transform_values(fields, lambda _, value: decoded_path(value))
    found = rows.withColumn("path_fields", fields).filter(F.col("path_fields").isNotNull())
    names = list(dict.fromkeys(n for n in template.names if n and n != "*"))
    values = {n: F.col("path_fields").getItem(n) for n in names}
    out = add_path_fields(found, values)
    return (out if "*" in template.names else out.drop("path_fields")), names


def _literal(text: str) -> str:
    return "\\Q" + text + "\\E"


def profile_objects(
    rows: DataFrame,
    root: str,
    dataset: Dataset,
    source_id: str = "",
    execution_time: int = 0,
    mergeable: bool = True,
    **boundaries: DataFrame | None,
) -> Profile:
    """Profile of each object of a dataset; ``rows`` carry the ``object`` they came from.

    Configured names follow the rules of path fields: where file and path share a name, the bare
    name and ``partition.<name>`` mean the path's value and ``object.<name>`` the file's.
    """
    file_columns = [c for c in rows.columns if c != OBJECT]
    nested, wanted = prepare_dimensions(rows, dataset.dimensions, **boundaries)
    placed, names = with_path_columns(nested, root, dataset)

    def resolved(columns: Sequence[str]) -> list[str]:
        return [resolve_name(c, file_columns, names) for c in columns]

    return profile(
        placed,
        resolved(wanted),
        resolved(dataset.strings),
        resolved(dataset.numbers),
        dataset.timestamps,
        execution_time,
        source_id,
        dataset.name,
        by=[OBJECT],
        mergeable=mergeable,
    )


def profile_dataset(spark: SparkSession, root: str, dataset: Dataset, **settings) -> Profile:
    """Profile all objects now under the dataset's prefix, each on its own, in one job."""
    path = f"{root.rstrip('/')}/{dataset.prefix.strip('/')}"
    rows = read_dataset(spark, path, dataset.file_type, dataset.schema, recursive=True)
    return profile_objects(rows.withColumn(OBJECT, F.col("_metadata.file_path")), root, dataset, **settings)


def object_records(spark: SparkSession, root: str, dataset: Dataset) -> DataFrame:
    """One row per JSON-lines object under the dataset's prefix, with the fields of its path.

    The lines of an object are one record: of each key of the dataset's schema the last line that carries it wins, at
    any size of the object, as tasks merge their lines before they are shuffled. Path fields follow the rules of
    :func:`with_path_columns`. Indicators take the rows as they take those of any dataset.
    """
    path = f"{root.rstrip('/')}/{dataset.prefix.strip('/')}"
    merged = merge_records(object_lines(spark, path, OBJECT), LINE, POSITION, dataset.schema, [OBJECT])
    return with_path_columns(merged, root, dataset)[0]


def profile_arrivals(
    spark: SparkSession,
    root: str,
    dataset: Dataset,
    output: str,
    checkpoint: str,
    files_per_trigger: int | None = None,
    available_now: bool = True,
    **settings,
) -> StreamingQuery:
    """Profile each object that arrives under the dataset's prefix; its schema must be given."""
    path = f"{root.rstrip('/')}/{dataset.prefix.strip('/')}"
    stream = object_stream(
        spark, path, dataset.file_type, dataset.schema, files_per_trigger, recursiveFileLookup=True
    )

    def compute(batch: DataFrame, batch_id: int) -> DataFrame:
        return profile_objects(batch, root, dataset, **settings).metrics

    return run_batches(stream, compute, output, checkpoint, available_now)

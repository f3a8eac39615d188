"""Grouped data-quality profiles, computed in one aggregation."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqspark.functions.columns import (
    existing,
    label,
    list_dimension,
    metric_key,
    object_dimension,
    present,
    to_number,
    with_role_names,
)
from dqspark.functions.timecols import EXECUTION_TIME, TimeColumns, add_times
from dqspark.operators import geo
from dqspark.plans.joins import null_safe_join, quoted
from dqspark.plans.storage import cut_lineage

log = logging.getLogger(__name__)

GROUP_SIZE = "total_group_count"
RECORD_COUNT = "total_record_count"
SPECIAL_DIMENSIONS = ("scalar", "object", "list", "wkb")


@dataclass
class Profile:
    """A profile and the roles of its columns."""

    metrics: DataFrame
    dimensions: list[str]
    times: TimeColumns

    def with_roles(self) -> DataFrame:
        return with_role_names(self.metrics, self.dimensions, self.times.names, self.times.primary)


def prepare_dimensions(
    df: DataFrame,
    dimensions: Sequence[str] | Mapping,
    states: DataFrame | None = None,
    countries: DataFrame | None = None,
    country_codes: DataFrame | None = None,
) -> tuple[DataFrame, list[str]]:
    """Add the columns that nested, list and geometry dimensions stand for; give all names.

    ``dimensions`` is a list of columns, or a mapping with ``scalar`` (columns), ``object``
    (``parent.child``), ``list`` (``{name: {"index": i, "col": {column: field}}}``) and ``wkb``
    (a column, or ``{column: ["type", "state", "country"]}``). Any other key is a plain column.
    """
    if not isinstance(dimensions, Mapping):
        return df, list(dimensions)
    names = [d for d in dimensions if d not in SPECIAL_DIMENSIONS]
    names += list(dimensions.get("scalar", []))
    for path in dimensions.get("object", []):
        if path.split(".", 1)[0] in df.columns:
            df = df.withColumn(path, object_dimension(df, path))
        names.append(path)
    for entry in dimensions.get("list", []):
        for name, spec in entry.items():
            for column, field in spec["col"].items():
                if column in df.columns:
                    df = df.withColumn(name, list_dimension(df, column, spec["index"], field))
            names.append(name)
    for entry in dimensions.get("wkb", []):
        items = entry.items() if isinstance(entry, Mapping) else [(entry, [])]
        for column, wanted in items:
            outputs = [w for w in wanted if isinstance(w, str)]
            df, added = geo.geometry_dimensions(df, column, outputs, states, countries, country_codes)
            names += added
    return df, names


def _measured(df: DataFrame, strings: Sequence[str], numbers: Sequence[str]) -> dict[str, Column]:
    """One column per measured column: numbers coerced, NaN of texts as NULL."""
    out = {f"_text|{c}": present(df, c) for c in strings if c not in numbers}
    return out | {f"_number|{c}": to_number(df, c) for c in numbers}


def _aggregates(
    strings: Sequence[str],
    numbers: Sequence[str],
    times: TimeColumns,
    name_of: Callable[[str, str], str],
    mergeable: bool,
) -> list[Column]:
    """All aggregate expressions of a profile, for one ``agg`` call over measured columns.

    Means, null counts and squared deviations are put together from counts, sums and deviations that
    are computed anyway: Spark keeps one buffer for each distinct aggregate.
    """
    out: list[Column] = []
    size = F.count(F.lit(1))

    def add(aggregate: str, column: str, expression: Column) -> None:
        out.append(expression.alias(name_of(aggregate, column)))

    for c in strings:
        if c in numbers:
            continue
        n = F.count(F.col(quoted(f"_text|{c}")))
        add("count", c, n)
        add("null_count", c, size - n)
    for c in numbers:
        value = F.col(quoted(f"_number|{c}"))
        n, total, deviation = F.count(value), F.sum(value), F.stddev_samp(value)
        add("count", c, n)
        add("sum", c, F.coalesce(total, F.lit(0.0)))
        add("max", c, F.max(value))
        add("min", c, F.min(value))
        add("mean", c, F.try_divide(total, n))
        add("std", c, deviation)
        add("null_count", c, size - n)
        if mergeable:
            add("m2", c, F.coalesce(deviation * deviation * (n - 1), F.lit(0.0)))
    for c in times.names:
        bound = F.min if c.startswith("min_") else F.max
        out.append(bound(F.col(quoted(c))).alias(c))
    out.append(size.alias(GROUP_SIZE))
    return out


def profile(
    df: DataFrame,
    dimensions: Sequence[str] | Mapping = (),
    strings: Sequence[str] = (),
    numbers: Sequence[str] = (),
    timestamps: Mapping[str, Mapping] | None = None,
    execution_time: int = 0,
    source_id: str = "",
    dataset: str = "",
    by: Sequence[str] = (),
    keyed: bool = True,
    mergeable: bool = False,
    **boundaries: DataFrame | None,
) -> Profile:
    """Counts, nulls, sums, ranges, means, deviations and time ranges per group.

    Missing columns are left out with a warning; if dimensions are given and none exists the result
    is empty. Labels are normalised before grouping, so NULL and blank form the one group
    ``<empty>``. ``by`` adds plain grouping columns, such as the object a row came from. With
    ``keyed`` the metric names end in the hash of dimensions, source and dataset. With ``mergeable``
    the squared deviations ``m2`` are kept too, so that roll-ups can rebuild ``std``.
    """
    df, wanted = prepare_dimensions(df, dimensions, **boundaries)
    columns = list(df.columns)
    strings, numbers = existing(columns, strings), existing(columns, numbers)
    found = existing(columns, wanted)
    df, times = add_times(df, timestamps or {}, execution_time)
    if wanted and not found:
        df = df.filter(F.lit(False))
    found += times.freshness
    tail = list(wanted) + times.freshness

    def name_of(aggregate: str, column: str) -> str:
        return metric_key(aggregate, column, tail, source_id, dataset) if keyed else f"{aggregate}|{column}"

    keys = {c: F.col(quoted(c)) for c in by} | {c: label(c) for c in found}
    if wanted and not found:
        keys[wanted[0]] = F.lit("")
    # Labels and numbers are made once per row, in a projection; the aggregates only name them.
    columns = {f"_key|{c}": e for c, e in keys.items()} | _measured(df, strings, numbers)
    columns |= {c: F.col(quoted(c)) for c in times.names}
    rows = df.select(*[e.alias(name) for name, e in columns.items()])
    exprs = _aggregates(strings, numbers, times, name_of, mergeable)
    groups = [F.col(quoted(f"_key|{c}")).alias(c) for c in keys]
    metrics = rows.groupBy(*groups).agg(*exprs) if groups else rows.agg(*exprs)
    return Profile(metrics, found, times)


def add_record_counts(metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add the number of records of the run, or of each object in ``by``, to every row.

    Reads ``metrics`` twice: pass a stored or checkpointed profile.
    """
    if not by:
        total = metrics.agg(F.coalesce(F.sum(GROUP_SIZE), F.lit(0)).alias(RECORD_COUNT))
        return metrics.withColumn(RECORD_COUNT, total.scalar())
    totals = metrics.groupBy(*[F.col(quoted(c)) for c in by]).agg(F.sum(GROUP_SIZE).alias(RECORD_COUNT))
    return null_safe_join(metrics, totals, by)


def drop_unparseable(metrics: DataFrame, numbers: Sequence[str]) -> DataFrame:
    """Drop all metrics of numeric columns in which not one value parsed.

    Decides from the profile itself: the metric rows are checkpointed and their counts summed, so
    the data is not scanned again. This runs a job.
    """
    counts = {
        column: name
        for column in numbers
        for name in metrics.columns
        if name == f"count|{column}" or name.startswith(f"count|{column}|")
    }
    if not counts:
        return metrics
    stored = cut_lineage(metrics)
    sums = stored.agg(*[F.sum(F.col(quoted(n))).alias(c) for c, n in counts.items()]).first()
    dead = [c for c in counts if not sums[c]]
    for column in dead:
        log.warning("no value of column %s reads as a number, leaving it out", column)
    gone = [n for n in stored.columns if "|" in n and any(_is_metric_of(n, c) for c in dead)]
    return stored.drop(*gone)


def _is_metric_of(name: str, column: str) -> bool:
    _, _, rest = name.partition("|")
    return rest == column or rest.startswith(column + "|")


def finish(
    result: Profile,
    bucket: str | None = None,
    object_key: str | None = None,
    execution_time: int | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """The output rows of a run: role names, record counts, location and execution time.

    The profile is checkpointed, being read twice. This runs a job.
    """
    stored = Profile(cut_lineage(result.metrics), result.dimensions, result.times)
    out = add_record_counts(stored.with_roles(), by)
    if bucket is not None and object_key is not None:
        out = out.withColumn("bucket", F.lit(bucket)).withColumn("object", F.lit(object_key))
    if execution_time is not None:
        out = out.withColumn(EXECUTION_TIME, F.lit(int(execution_time)).cast("bigint"))
    return out


def time_range(metrics: DataFrame, primary: str) -> DataFrame:
    """Smallest and largest primary time of a result, one row."""
    c = F.col(quoted(primary))
    return metrics.agg(F.min(c).alias("min_primary_time"), F.max(c).alias("max_primary_time"))


def dimension_values(df: DataFrame, dimensions: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Distinct labels of every dimension as rows ``(by…, dimension, value)``, in one pass.

    Rows rather than arrays, because a dimension may have as many values as the data has rows.
    """
    pairs = F.array(
        *[F.struct(F.lit(d).alias("dimension"), label(d).alias("value")) for d in dimensions]
    )
    return (
        df.select(*[F.col(quoted(c)) for c in by], F.explode(pairs).alias("_pair"))
        .select(*[F.col(quoted(c)) for c in by], "_pair.dimension", "_pair.value")
        .distinct()
    )


def merge_metrics(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join of two metric tables on their keys, NULL keys matching each other."""
    return null_safe_join(left, right, keys)

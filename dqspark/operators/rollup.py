"""Merging of stored profiles into coarser ones, without the raw rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqspark.operators.profile import GROUP_SIZE, RECORD_COUNT
from dqspark.plans.joins import null_safe_join, quoted

SUMMED = ("count", "sum", "null_count")


def concat_results(results: Sequence[DataFrame]) -> DataFrame:
    """All rows of several results; columns that one of them lacks are NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), results)


def metric_parts(name: str) -> tuple[str, str]:
    """Aggregate and the rest of a metric name, ``("", "")`` for other columns."""
    aggregate, bar, rest = name.partition("|")
    return (aggregate, rest) if bar else ("", "")


def rollup_metrics(
    metrics: DataFrame,
    dimensions: Sequence[str],
    times: Sequence[str] = (),
    hll_lg_k: int | None = None,
) -> DataFrame:
    """Merge profile rows on ``dimensions``, a subset of those they were made with.

    Counts, sums, null counts and group sizes add up; ranges widen; means are sums over counts.
    ``std`` comes back exactly from ``m2`` where the profile kept it and is left out otherwise.
    Sketch columns ``hll|…`` and ``kll|…`` are united. Metrics with ``m2`` are read twice: pass a
    stored table.
    """
    columns = metrics.columns
    moments = [rest for kind, rest in map(metric_parts, columns) if kind == "m2"]
    source = _with_group_means(metrics, dimensions, moments) if moments else metrics
    exprs: list[Column] = []
    for name in columns:
        if name in dimensions:
            continue
        kind, rest = metric_parts(name)
        c = F.col(quoted(name))
        if kind in SUMMED or name == GROUP_SIZE:
            exprs.append(F.sum(c).alias(name))
        elif kind == "max" or name in times and not name.startswith("min_"):
            exprs.append(F.max(c).alias(name))
        elif kind == "min" or name in times:
            exprs.append(F.min(c).alias(name))
        elif kind == "mean":
            exprs.append(_ratio(rest).alias(name))
        elif kind == "m2":
            exprs.append(_merged_m2(rest).alias(name))
        elif kind == "std" and rest in moments:
            n = F.sum(F.col(quoted(f"count|{rest}")))
            exprs.append(F.when(n > 1, F.sqrt(_merged_m2(rest) / (n - 1))).alias(name))
        elif kind == "hll":
            exprs.append(F.hll_union_agg(c, True).alias(name))
        elif kind == "kll":
            exprs.append(F.expr(f"kll_merge_agg_double({quoted(name)})").alias(name))
        elif name == RECORD_COUNT:
            continue
    keys = [F.col(quoted(d)) for d in dimensions]
    return source.groupBy(*keys).agg(*exprs) if keys else source.agg(*exprs)


def _ratio(rest: str) -> Column:
    total, n = F.sum(F.col(quoted(f"sum|{rest}"))), F.sum(F.col(quoted(f"count|{rest}")))
    return F.when(n > 0, total / n)


def _merged_m2(rest: str) -> Column:
    n, total = F.col(quoted(f"count|{rest}")), F.col(quoted(f"sum|{rest}"))
    away = F.when(n > 0, total / n - F.col(quoted(f"_group_mean|{rest}")))
    return F.sum(F.col(quoted(f"m2|{rest}")) + F.coalesce(n * away * away, F.lit(0.0)))


def _with_group_means(metrics: DataFrame, dimensions: Sequence[str], moments: Sequence[str]) -> DataFrame:
    # Squared distances are taken from the merged mean: sums of squares would cancel badly.
    means = [_ratio(rest).alias(f"_group_mean|{rest}") for rest in moments]
    if not dimensions:
        merged = metrics.agg(*means)
        return metrics.withColumns(
            {f"_group_mean|{r}": merged.select(quoted(f"_group_mean|{r}")).scalar() for r in moments}
        )
    keys = [F.col(quoted(d)) for d in dimensions]
    return null_safe_join(metrics, metrics.groupBy(*keys).agg(*means), dimensions)


def rolling_rollup(
    panes: DataFrame,
    pane_end: str,
    pane_seconds: int,
    lookback: int,
    dimensions: Sequence[str],
    times: Sequence[str] = (),
) -> DataFrame:
    """Look-back metrics ending at every multiple of the pane, from profiles of single panes.

    ``pane_end`` holds the epoch second a pane ends at, and ``lookback`` is a multiple of
    ``pane_seconds``. The raw rows are aggregated once per pane; only pane rows are repeated, once
    for each window that holds the pane. The result carries ``evaluation_time``. Panes with ``m2``
    are read twice: pass a stored table.
    """
    if lookback % pane_seconds:
        raise ValueError("the look-back must be a multiple of the pane")
    steps = F.sequence(F.lit(0), F.lit(lookback // pane_seconds - 1))
    spread = panes.withColumn(
        "evaluation_time",
        F.explode(F.transform(steps, lambda i: F.col(quoted(pane_end)) + i * pane_seconds)),
    ).drop(pane_end)
    return rollup_metrics(spread, ["evaluation_time", *dimensions], times)

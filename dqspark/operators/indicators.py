"""Indicators: SQL aggregates over look-back windows, evaluated in families that share a scan."""

from __future__ import annotations

import functools
import hashlib
import itertools
import logging
import math
import operator
import re
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, GroupedData, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqspark.functions.columns import (
    INDICATOR_PREFIX,
    aliased,
    group_name,
    list_fingerprint,
    text_fingerprint,
)
from dqspark.functions.timecols import evaluation_times
from dqspark.operators.sketches import HLL_LG_K
from dqspark.plans.joins import BUCKETS_PER_WINDOW, epoch_seconds, in_time_range, interval_join, lookup_join, quoted, windows_frame
from dqspark.plans.storage import stored

log = logging.getLogger(__name__)

NONE, COUNT_DISTINCT, DECILE = "NONE", "COUNT_DISTINCT", "DECILE"
MODES = ("plain", "exact", "approx", "sketch")

# Evaluation times whose windows are broadcast without a further check.
MAX_DRIVER_TIMES = 2_000

# Windows per row from which panes are worth their shuffle, and the most panes a window may have.
MIN_OVERLAP = 3
MAX_PANES_PER_WINDOW = 4096

# Families of one dataset that one scan answers.
SHARED_FAMILIES = 32

# Windows per row up to which Spark's own window expression is used.
MAX_WINDOW_RATIO = 64

# A call and nothing else, its arguments holding at most two levels of brackets.
_ARGUMENTS = r"(?:[^()]|\((?:[^()]|\([^()]*\))*\))*"
DISTINCT_CALL = rf"(?is)^\s*count\s*\(\s*distinct\b({_ARGUMENTS})\)\s*$"
PERCENTILE_CALL = rf"(?is)^\s*approx_percentile\s*\(({_ARGUMENTS})\)\s*$"
STDDEV_CALL = rf"(?is)^\s*stddev\s*\(({_ARGUMENTS})\)\s*$"
SHARE = re.compile(r"(?i)[0-9.]+(?:e-?[0-9]+)?")


# -- calculations --------------------------------------------------------------------------------


def sketch_class(calculation: Column) -> Column:
    """``COUNT_DISTINCT`` or ``DECILE`` when the calculation is that one call, else ``NONE``."""
    return (
        F.when(calculation.rlike(DISTINCT_CALL), COUNT_DISTINCT)
        .when(calculation.rlike(PERCENTILE_CALL), DECILE)
        .otherwise(NONE)
    )


def _arguments(text: str) -> list[str]:
    """The arguments of a call: split at commas outside brackets and quotes."""
    out, depth, quote = [""], 0, ""
    for ch in text:
        if quote:
            quote = "" if ch == quote else quote
        elif ch in "'\"`":
            quote = ch
        depth += (ch in "([") - (ch in ")]") if not quote else 0
        if ch == "," and not depth and not quote:
            out.append("")
        else:
            out[-1] += ch
    return [a.strip() for a in out]


def _distinct(operands: list[str], mode: str) -> str:
    """Distinct values, or combinations without NULL, of the operands."""
    if mode == "exact":
        return f"count(DISTINCT {', '.join(operands)})"
    value = operands[0]
    if len(operands) > 1:
        full = " AND ".join(f"({o}) IS NOT NULL" for o in operands)
        value = f"CASE WHEN {full} THEN struct({', '.join(operands)}) END"
    if mode == "approx":
        return f"approx_count_distinct({value})"
    text = f"to_json({value})" if len(operands) > 1 else f"CAST({value} AS string)"
    return f"hll_sketch_agg({text}, {HLL_LG_K})"


def _percentile(calculation: str, arguments: list[str], mode: str) -> str:
    """A percentile of a value by a share or an array of shares; a third argument is an accuracy."""
    if mode == "approx" or len(arguments) not in (2, 3):
        return calculation.strip()
    operand, share = arguments[:2]
    if mode == "sketch":
        return f"kll_sketch_agg_double(CAST({operand} AS double))"
    if SHARE.fullmatch(share):
        return f"percentile_cont({share}) WITHIN GROUP (ORDER BY {operand})"
    return f"percentile({operand}, {share})"


def calculation_column(calculation: str, mode: str = "approx") -> Column:
    """The aggregate of a calculation, which is :func:`calculation_sql` of it."""
    return F.expr(calculation_sql(calculation, mode))


def calculation_sql(calculation: str, mode: str = "approx") -> str:
    """The Spark SQL of a calculation.

    ``COUNT(DISTINCT x)`` and ``approx_percentile(x, p)`` become exact or approximate values or a
    sketch, by ``mode``; ``plain`` leaves them alone. ``stddev(x)`` reads ``x`` as a number. All
    else is passed to Spark SQL as it is.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode != "plain":
        distinct = re.match(DISTINCT_CALL, calculation)
        if distinct:
            return _distinct(_arguments(distinct.group(1)), mode)
        percentile = re.match(PERCENTILE_CALL, calculation)
        if percentile:
            return _percentile(calculation, _arguments(percentile.group(1)), mode)
    deviation = re.match(STDDEV_CALL, calculation)
    if deviation:
        return f"stddev(try_cast({deviation.group(1).strip()} AS double))"
    return calculation.strip()


# Calls that a FILTER clause can follow, beside the mergeable ones.
ONE_CALL = (DISTINCT_CALL, PERCENTILE_CALL, STDDEV_CALL)
MERGEABLE_CALL = re.compile(rf"(?is)^\s*(count|sum|min|max|avg)\s*\((?!\s*distinct\b)({_ARGUMENTS})\)\s*$")


@dataclass
class Mergeable:
    """An aggregate as partial aggregates of panes, the merge of those, and how each merges to one of its kind."""

    partials: dict[str, str]
    merged: Column
    combine: dict[str, Callable[[Column], Column]]


def mergeable(dataset: DataFrame, calculation: str, name: str, mode: str = "approx") -> Mergeable | None:
    """The pane form of a calculation with the same result, or None where it has none.

    Counts, sums, ranges and double averages merge exactly; in mode ``sketch`` so do the sketches.
    """
    if mode == "sketch":
        for pattern, merge in (
            (DISTINCT_CALL, lambda c: F.hll_union_agg(c, True)),
            (PERCENTILE_CALL, lambda c: F.call_function("kll_merge_agg_double", c)),
        ):
            if re.match(pattern, calculation):
                return Mergeable({name: calculation_sql(calculation, mode)}, merge(F.col(quoted(name))), {name: merge})
    call = MERGEABLE_CALL.match(calculation)
    if not call:
        return None
    kind, whole = call.group(1).lower(), F.col(quoted(name))
    if kind == "avg":
        if dataset.select(F.expr(calculation).alias("v")).schema["v"].dataType != T.DoubleType():
            return None
        parts = {f"{name}#sum": f"sum(CAST({call.group(2)} AS double))", f"{name}#n": f"count({call.group(2)})"}
        total, n = (F.sum(F.col(quoted(part))) for part in parts)
        return Mergeable(parts, F.try_divide(total, n), {part: F.sum for part in parts})
    merge = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}[kind]
    return Mergeable({name: calculation.strip()}, merge(whole), {name: merge})


def _all_mergeable(
    dataset: DataFrame, calculations: Sequence[tuple[str, object]], mode: str
) -> dict[str, Mergeable] | None:
    found = {
        f"{INDICATOR_PREFIX}{i}": mergeable(dataset, c, f"{INDICATOR_PREFIX}{i}", mode) for c, i in calculations
    }
    return None if any(m is None for m in found.values()) else found


def _panes(rows: DataFrame, forms: dict[str, Mergeable], timestamp: str, width: int, keys: Sequence[Column]) -> DataFrame:
    """Partial aggregates per group and pane of ``width`` seconds, ``_pane`` being its first second."""
    ts = F.col(quoted(timestamp))
    start = F.floor(epoch_seconds(rows, timestamp) / width) * width
    partials = [F.expr(e).alias(n) for m in forms.values() for n, e in m.partials.items()]
    partials += [F.min(ts).alias("_result_min_ts"), F.max(ts).alias("_result_max_ts")]
    return rows.filter(ts.isNotNull()).groupBy(*keys, start.alias("_pane")).agg(*partials)


def _merges(rows: DataFrame, forms: dict[str, Mergeable], exprs: Sequence[Column]) -> list[Column]:
    """The merged values, each of the type that its direct aggregate has."""
    kinds = rows.agg(*exprs).schema
    out = [m.merged.cast(kinds[name].dataType).alias(name) for name, m in forms.items()]
    return [*out, F.min("_result_min_ts").alias("_result_min_ts"), F.max("_result_max_ts").alias("_result_max_ts")]


def _group_list(fields: str | Sequence | None) -> list:
    if not fields:
        return []
    return [f.strip() for f in fields.split(",")] if isinstance(fields, str) else list(fields)


# -- one evaluation ------------------------------------------------------------------------------


def indicator_query(
    dataset: DataFrame,
    calculations: Sequence[tuple[str, object]],
    group_fields: str | Sequence[str | Mapping[str, str]] = (),
    timestamp: str | None = None,
    evaluation_time: int | None = None,
    lookback: int | None = 0,
    filters: str | None = None,
    mode: str = "approx",
    time_range: str = "observed",
) -> DataFrame:
    """Aggregates per group over ``[evaluation_time - lookback, evaluation_time)``.

    ``calculations`` are pairs of SQL aggregate and indicator id, giving ``_indicator_<id>``. The
    observed first and last time of each group and the requested range come with them;
    ``time_range="requested"`` gives the requested bounds in place of the observed ones.
    """
    rows = dataset.filter(F.expr(f"({filters})")) if filters else dataset
    exprs = [calculation_column(c, mode).alias(f"{INDICATOR_PREFIX}{i}") for c, i in calculations]
    if timestamp:
        if evaluation_time is None:
            import time

            evaluation_time = round(time.time())
        start, end = int(evaluation_time) - int(lookback or 0), int(evaluation_time)
        rows = rows.filter(in_time_range(rows, timestamp, start, end))
        exprs += _range_columns(timestamp, F.lit(start), F.lit(end), time_range)
    keys = [aliased(f) for f in _group_list(group_fields)]
    return rows.groupBy(*keys).agg(*exprs) if keys else rows.agg(*exprs)


def _range_columns(timestamp: str, start: Column, end: Column, time_range: str) -> list[Column]:
    start, end = start.cast("bigint"), end.cast("bigint")
    ts = F.col(quoted(timestamp))
    low, high = (F.min(ts), F.max(ts)) if time_range == "observed" else (start, end)
    return [
        low.alias("_result_min_ts"),
        high.alias("_result_max_ts"),
        start.alias("_lookback_range_start_ts"),
        end.alias("_lookback_range_end_ts"),
    ]


def observed_only(result: DataFrame) -> DataFrame:
    """Result groups that have an observed time range."""
    return result.filter(F.col("_result_min_ts").isNotNull() & F.col("_result_max_ts").isNotNull())


# -- many evaluations ----------------------------------------------------------------------------


def indicator_series(
    dataset: DataFrame,
    calculations: Sequence[tuple[str, object]],
    times: Sequence[int] | DataFrame,
    lookback: int,
    timestamp: str,
    group_fields: str | Sequence[str | Mapping[str, str]] = (),
    filters: str | None = None,
    mode: str = "approx",
    small: bool | None = None,
) -> DataFrame:
    """:func:`indicator_query` for many evaluation times in one scan.

    ``times`` are epoch seconds, or a table with ``evaluation_time``, of which small jobs take up to
    ``MAX_DRIVER_TIMES`` times, or else their range, so that the scan is filtered in either case. A time whose window holds no
    row gives no result row. ``small`` is that of :func:`dqspark.plans.joins.interval_join`.

    Where windows overlap and all calculations merge, each row is aggregated once into the pane that
    divides all windows, and only panes are joined with the windows. With a table of more times, panes are merged
    along blocks as long as the look-back, from their beginning and from their end: a window is the end of
    one block and the beginning of the next, so each costs two look-ups, however many panes it spans.
    """
    rows = dataset.filter(F.expr(f"({filters})")) if filters else dataset
    keys = [aliased(f) for f in _group_list(group_fields)]
    names = [group_name(f) for f in _group_list(group_fields)]
    exprs = [calculation_column(c, mode).alias(f"{INDICATOR_PREFIX}{i}") for c, i in calculations]
    forms, width = None, 0
    if isinstance(times, DataFrame):
        end = F.col("evaluation_time").cast("bigint")
        table = times.select(end.alias("t")).filter("t IS NOT NULL").distinct()
        few = [r["t"] for r in table.take(MAX_DRIVER_TIMES + 1)]
        if len(few) <= MAX_DRIVER_TIMES:
            times = few
    if isinstance(times, DataFrame):
        first, last = table.agg(F.min("t"), F.max("t")).first()
        rows = rows.filter(in_time_range(rows, timestamp, first - int(lookback), last))
        found = _all_mergeable(dataset, calculations, mode) if lookback else None
        if found:
            out = _by_blocks(rows, found, timestamp, int(lookback), keys, names, table).agg(*_merges(rows, found, exprs))
            # Panes of a block that a window does not reach leave a row without any time.
            return _series_columns(observed_only(out), names, calculations)
        windows = table.select((F.col("t") - int(lookback)).alias("_window_start"), F.col("t").alias("_window_end"))
    else:
        if times:
            rows = rows.filter(in_time_range(rows, timestamp, min(times) - int(lookback), max(times)))
        windows = windows_frame(dataset.sparkSession, times, lookback)
        small = len(times) <= MAX_DRIVER_TIMES if small is None else small
        width = pane_width(times, lookback)
        forms = _all_mergeable(dataset, calculations, mode) if width else None
    if forms:
        panes = _panes(rows, forms, timestamp, width, keys)
        pairs = interval_join(panes, windows, "_pane", lookback, small)
        keys, exprs = [F.col(quoted(n)) for n in names], _merges(rows, forms, exprs)
    else:
        pairs = interval_join(rows, windows, timestamp, lookback, small)
        ts = F.col(quoted(timestamp))
        exprs += [F.min(ts).alias("_result_min_ts"), F.max(ts).alias("_result_max_ts")]
    out = pairs.groupBy(*keys, "_window_start", "_window_end").agg(*exprs)
    out = out.withColumnsRenamed(
        {"_window_start": "_lookback_range_start_ts", "_window_end": "_lookback_range_end_ts"}
    )
    return _series_columns(out, names, calculations)


def _common_width(times: DataFrame, lookback: int) -> int:
    """Longest pane that divides the look-back and all times of a table; tasks send one number each."""

    def divisors(batches):
        import numpy as np
        import pyarrow as pa

        found = 0
        for batch in batches:
            found = math.gcd(found, int(np.gcd.reduce(batch.column(0).to_numpy(), initial=0)))
        yield pa.RecordBatch.from_arrays([pa.array([found])], ["d"])

    return math.gcd(lookback, *[r["d"] for r in times.select("t").mapInArrow(divisors, "d long").collect()])


def _by_blocks(
    rows: DataFrame,
    forms: dict[str, Mergeable],
    timestamp: str,
    lookback: int,
    keys: Sequence[Column],
    names: Sequence[str],
    times: DataFrame,
) -> GroupedData:
    """Per group and time of a table, the partial aggregates of the two parts that make up its window.

    Groups of a block and times that look into it are joined on the block. Panes and times then lie on one line, and
    a running merge along it, from either end, gives each time what the window has of the block. A line holds the
    panes and times of one group within one look-back.
    """
    panes = _panes(rows, forms, timestamp, _common_width(times, lookback), keys)
    panes = stored(panes.withColumn("_block", F.floor(F.col("_pane") / lookback)), "panes")
    combine = {n: c for m in forms.values() for n, c in m.combine.items()}
    combine |= {"_result_min_ts": F.min, "_result_max_ts": F.max}
    groups = panes.select(*[quoted(n) for n in names], "_block").distinct()
    t = F.col("t")
    sides = []
    for forward in (True, False):
        # The window's first part ends its block, the second begins the next; an aligned window has only the first.
        at = t - lookback if forward else t
        asked = (times if forward else times.filter(F.pmod(t, F.lit(lookback)) != 0)).select(
            t.alias("_time"), at.alias("_pane"), F.floor(at / lookback).alias("_block")
        )
        asked = lookup_join(asked, groups, ["_block"], "inner")
        line = panes.unionByName(asked, allowMissingColumns=True)
        order = [F.desc("_pane"), F.col("_time").asc_nulls_first()] if forward else [F.asc("_pane"), F.col("_time").asc_nulls_last()]
        along = Window.partitionBy(*[quoted(n) for n in names], "_block").orderBy(*order)
        along = along.rowsBetween(Window.unboundedPreceding, 0)
        merged = line.select(
            *[F.col(quoted(n)) for n in names], "_time", *[c(F.col(quoted(n))).over(along).alias(n) for n, c in combine.items()]
        )
        sides.append(merged.filter(F.col("_time").isNotNull()))
    both = sides[0].unionAll(sides[1]).withColumns({
        "_lookback_range_start_ts": F.col("_time") - lookback, "_lookback_range_end_ts": F.col("_time")
    })
    return both.groupBy(*[F.col(quoted(n)) for n in names], "_lookback_range_start_ts", "_lookback_range_end_ts")


def _series_columns(out: DataFrame, names: Sequence[str], calculations: Sequence[tuple[str, object]]) -> DataFrame:
    """Groups, values, observed range and look-back range, in the order that all ways of evaluation give."""
    return out.select(
        *[F.col(quoted(n)) for n in names],
        *[F.col(quoted(f"{INDICATOR_PREFIX}{i}")) for _, i in calculations],
        "_result_min_ts",
        "_result_max_ts",
        F.col("_lookback_range_start_ts").cast("bigint").alias("_lookback_range_start_ts"),
        F.col("_lookback_range_end_ts").cast("bigint").alias("_lookback_range_end_ts"),
    )


def pane_width(times: Sequence[int], lookback: int) -> int:
    """Longest pane that divides all windows; 0 where they overlap too little to be worth it."""
    if not times or not lookback:
        return 0
    span = max(times) - min(times) + lookback
    if len(set(times)) * lookback < MIN_OVERLAP * span:
        return 0
    width = math.gcd(int(lookback), *[int(t) for t in times])
    return width if lookback // width <= MAX_PANES_PER_WINDOW else 0


def rolling_indicators(
    dataset: DataFrame,
    calculations: Sequence[tuple[str, object]],
    timestamp: str,
    lookback: int,
    interval: int,
    group_fields: str | Sequence[str | Mapping[str, str]] = (),
    filters: str | None = None,
    mode: str = "approx",
) -> DataFrame:
    """Indicators at every multiple of ``interval`` whose window holds a row.

    For SQL aggregates of any kind. Where the look-back spans several intervals, calculations that
    merge are aggregated once per pane; others take every row into each of its windows.
    """
    rows = dataset.filter(F.expr(f"({filters})")) if filters else dataset
    keys = [aliased(f) for f in _group_list(group_fields)]
    names = [group_name(f) for f in _group_list(group_fields)]
    exprs = [calculation_column(c, mode).alias(f"{INDICATOR_PREFIX}{i}") for c, i in calculations]
    ts = F.col(quoted(timestamp))
    exprs += [F.min(ts).alias("_result_min_ts"), F.max(ts).alias("_result_max_ts")]
    end = F.col("_lookback_range_end_ts")

    def in_each_window(seconds: Column) -> Column:
        first = (F.floor(seconds / interval) + 1) * interval
        last = F.floor((seconds + lookback) / interval) * interval
        return F.explode(F.sequence(first, last, F.lit(interval).cast("bigint")))

    forms = _all_mergeable(dataset, calculations, mode) if lookback >= MIN_OVERLAP * interval else None
    if forms:
        panes = _panes(rows, forms, timestamp, math.gcd(int(lookback), int(interval)), keys)
        spread = panes.withColumn("_lookback_range_end_ts", in_each_window(F.col("_pane")))
        groups = [F.col(quoted(n)) for n in names]
        out = spread.groupBy("_lookback_range_end_ts", *groups).agg(*_merges(rows, forms, exprs))
        return _series_columns(out.withColumn("_lookback_range_start_ts", end - int(lookback)), names, calculations)
    timed = isinstance(rows.schema[timestamp].dataType, (T.TimestampType, T.TimestampNTZType))
    if lookback > MAX_WINDOW_RATIO * interval or not timed:
        spread = rows.filter(ts.isNotNull()).withColumn(
            "_lookback_range_end_ts", in_each_window(epoch_seconds(rows, timestamp))
        )
        out = spread.groupBy("_lookback_range_end_ts", *keys).agg(*exprs)
        return _series_columns(out.withColumn("_lookback_range_start_ts", end - int(lookback)), names, calculations)
    window = F.window(ts, f"{int(lookback)} seconds", f"{int(interval)} seconds").alias("_window")
    out = rows.groupBy(window, *keys).agg(*exprs)
    out = out.withColumn("_lookback_range_end_ts", F.unix_seconds(F.col("_window.end").cast("timestamp")))
    return _series_columns(out.withColumn("_lookback_range_start_ts", end - int(lookback)), names, calculations)


# -- keys ----------------------------------------------------------------------------------------


def family_key(
    dataset_id: Column,
    group_fields: Column,
    filter_key: Column,
    lookback: Column,
    interval: Column,
    sketch: Column | None = None,
) -> Column:
    """Key shared by the indicators that one scan can answer."""
    parts = [dataset_id.cast("string")]
    if sketch is not None:
        parts.append(sketch)
    parts += [list_fingerprint(group_fields), filter_key, lookback.cast("string"), list_fingerprint(interval)]
    return F.concat_ws("_", *[F.coalesce(p, F.lit("")) for p in parts])


def filter_fingerprint(spark: SparkSession, predicate: str | None) -> str:
    """Key of a filter that does not depend on the order of AND and OR operands, spacing or brackets.

    Spark parses the text; operands of nested conjunctions and disjunctions are gathered and sorted.
    Runs on the driver, for definitions only.
    """
    if not predicate or not predicate.strip():
        return ""
    parser = spark._jsparkSession.sessionState().sqlParser()
    text = predicate.strip().removesuffix(";")
    return hashlib.sha1(_ordered(parser.parseExpression(text)).encode()).hexdigest()


def _ordered(expression) -> str:
    kind = expression.getClass().getSimpleName()
    if kind in ("And", "Or"):
        operands: list[str] = []
        pending = [expression]
        while pending:
            node = pending.pop()
            if node.getClass().getSimpleName() == kind:
                pending += [node.left(), node.right()]
            else:
                operands.append(_ordered(node))
        return "(" + f" {kind.upper()} ".join(sorted(operands)) + ")"
    if kind == "Not":
        return f"(NOT {_ordered(expression.child())})"
    return expression.sql()


# -- families ------------------------------------------------------------------------------------


@dataclass
class Family:
    """Indicators of one organisation with equal dataset, groups, filter, look-back and interval."""

    key: str
    org_id: object
    dataset_id: object
    dataset_query: str
    group_fields: str
    filters: str
    timestamp: str
    lookback: int
    calculations: list[tuple[str, int]]
    times: list[int] = field(default_factory=list)

    @property
    def indicator_ids(self) -> list[int]:
        return [i for _, i in self.calculations]


def exploded_times(definitions: DataFrame) -> DataFrame:
    """One row per evaluation time, in epoch seconds; blank times are dropped."""
    millis = F.explode("evaluation_times").alias("_ms")
    rest = [c for c in definitions.columns if c != "evaluation_times"]
    return (
        definitions.select(*rest, millis)
        .withColumn("_ms", F.col("_ms").cast("string").try_cast("bigint"))
        .filter(F.col("_ms").isNotNull())
        .withColumn("evaluation_time", F.floor(F.col("_ms") / 1000))
        .drop("_ms")
    )


def with_filter_keys(definitions: DataFrame, filters: str = "filters", output: str = "filter_key") -> DataFrame:
    """Add the fingerprint of a filter column. The distinct filters pass the driver in a stream."""
    spark = definitions.sparkSession
    text = F.coalesce(F.trim(F.col(quoted(filters))), F.lit(""))
    keyed = [
        (row["f"], filter_fingerprint(spark, row["f"]))
        for row in definitions.select(text.alias("f")).distinct().toLocalIterator()
    ]
    prints = spark.createDataFrame(keyed, f"_filter string, {quoted(output)} string")
    return lookup_join(definitions.withColumn("_filter", text), prints, ["_filter"]).drop("_filter")


def with_family_keys(definitions: DataFrame, sketch_in_key: bool = False) -> DataFrame:
    """Add ``sketch_type`` and ``compute_hash`` to a table of definitions."""
    kind, calculation = sketch_class(F.col("calculation")), F.col("calculation")
    key = family_key(
        F.col("computed_dataset_id"),
        F.col("group_fields"),
        F.col("_filter_key"),
        F.col("lookback_window_length"),
        F.col("evaluation_interval"),
        F.when(kind == NONE, F.lit(NONE)).otherwise(calculation) if sketch_in_key else None,
    )
    keyed = with_filter_keys(definitions, "filters", "_filter_key")
    return keyed.withColumn("sketch_type", kind).withColumn("compute_hash", key).drop("_filter_key")


def families(definitions: DataFrame, sketch_in_key: bool = False) -> Iterator[Family]:
    """The families of a definitions table, one at a time, from a sorted stream of its rows.

    Indicators of one key need not share all evaluation times: each set of indicators with the times
    they share is a family. This runs jobs.
    """
    rows = exploded_times(with_family_keys(definitions, sketch_in_key)).orderBy(
        "compute_hash", "org_id", "evaluation_time", "indicator_id"
    )
    by_key = itertools.groupby(rows.toLocalIterator(), key=lambda r: (r["compute_hash"], r["org_id"]))
    for (key, org_id), members in by_key:
        shared: dict[tuple[tuple[str, int], ...], list[int]] = {}
        first = None
        for time, group in itertools.groupby(members, key=lambda r: r["evaluation_time"]):
            wanted = {}
            for row in group:
                first = first or row
                wanted[row["indicator_id"]] = row["calculation"]
            shared.setdefault(tuple((c, i) for i, c in wanted.items()), []).append(time)
        for calculations, times in shared.items():
            yield Family(
                key=key,
                org_id=org_id,
                dataset_id=first["computed_dataset_id"],
                dataset_query=(first["computed_dataset_query"] or "").strip().removesuffix(";"),
                group_fields=first["group_fields"] or "",
                filters=first["filters"] or "",
                timestamp=first["timestamp_column"] or "",
                lookback=int(first["lookback_window_length"] or 0),
                calculations=list(calculations),
                times=times,
            )


def evaluate_family(spark: SparkSession, family: Family, mode: str = "approx") -> DataFrame:
    """All evaluation times of a family in one scan of its dataset."""
    dataset = spark.sql(family.dataset_query)
    if not family.timestamp:
        return indicator_query(dataset, family.calculations, family.group_fields, filters=family.filters, mode=mode)
    return indicator_series(
        dataset,
        family.calculations,
        family.times,
        family.lookback,
        family.timestamp,
        family.group_fields,
        family.filters,
        mode,
    )


def batches_of_families(found: Iterable[Family], most: int = SHARED_FAMILIES) -> Iterator[list[Family]]:
    """Neighbouring families over one dataset and time column, up to ``most`` at once, as one scan can answer."""
    for _, alike in itertools.groupby(found, key=lambda f: (f.dataset_query, f.timestamp)):
        while batch := list(itertools.islice(alike, most)):
            yield batch


def _is_shareable(family: Family) -> bool:
    """Whether other families may be evaluated beside it: every calculation is one call, which a condition can follow.

    What is computed from several calls would also be computed over the rows of the other families, and may fail there. Without
    times and groups there is a row even for no data, which no group stands for.
    """
    one_call = all(MERGEABLE_CALL.match(c) or any(re.match(p, c) for p in ONE_CALL) for c, _ in family.calculations)
    return one_call and bool(family.times if family.timestamp else family.group_fields)


@dataclass
class _Shared:
    """How one family takes part in a shared scan: by panes if ``forms`` are given, else by its windows."""

    number: int
    family: Family
    forms: dict[str, Mergeable] | None
    width: int
    passes: Column
    columns: dict[str, str] = field(default_factory=dict)

    @property
    def sql(self) -> dict[str, str]:
        return {n: e for m in self.forms.values() for n, e in m.partials.items()} if self.forms else {}


def _shared_member(dataset: DataFrame, number: int, family: Family, mode: str) -> _Shared:
    passes = F.expr(f"({family.filters})") if family.filters else F.lit(True)
    forms, width = None, 0
    if family.timestamp:
        first, last = min(family.times) - family.lookback, max(family.times)
        passes = passes & in_time_range(dataset, family.timestamp, first, last)
        width = pane_width(family.times, family.lookback)
        forms = _all_mergeable(dataset, family.calculations, mode) if width else None
        width = width if forms else max(1, -(-family.lookback // BUCKETS_PER_WINDOW))
    return _Shared(number, family, forms, width, passes)


def shared_aggregate(dataset: DataFrame, members: Sequence[_Shared], mode: str) -> DataFrame:
    """One aggregate of ``dataset`` that holds the groups of all ``members``, told apart by ``_family``.

    Each row is repeated, within its task, for the families whose filter and time range it passes. The copies are
    grouped by family, window or pane, and the fields of the family, which are NULL for the others; a calculation
    reads only the copies of the families that ask for it. The scan is filtered by what any family passes.
    """
    timestamp = members[0].family.timestamp
    epoch = epoch_seconds(dataset, timestamp) if timestamp else F.lit(None).cast("bigint")
    none = F.lit(None).cast("bigint")
    copies = []
    for m in members:
        place = F.floor(epoch / m.width).cast("bigint") if timestamp else none
        pane, bucket = (place * m.width, none) if m.forms else (none, place)
        copy = F.struct(F.lit(m.number).alias("f"), pane.alias("pane"), bucket.alias("bucket"))
        copies.append(F.when(m.passes, copy))
    rows = dataset.filter(functools.reduce(operator.or_, [m.passes for m in members]))
    rows = rows.select("*", F.explode(F.array_compact(F.array(*copies))).alias("_copy")).withColumns({
        "_family": F.col("_copy.f"), "_pane": F.col("_copy.pane"), "_bucket": F.col("_copy.bucket")
    }).drop("_copy")
    by_window = [m for m in members if timestamp and not m.forms]
    if by_window:
        listed = [(m.number, m.width, t - m.family.lookback, t) for m in by_window for t in sorted(set(m.family.times))]
        windows = dataset.sparkSession.createDataFrame(
            listed, "_family int, _width bigint, _window_start bigint, _window_end bigint"
        ).filter("_window_end > _window_start")
        first, last = F.floor(F.col("_window_start") / F.col("_width")), F.floor((F.col("_window_end") - 1) / F.col("_width"))
        windows = windows.withColumn("_bucket", F.explode(F.sequence(first, last))).drop("_width")
        rows = lookup_join(rows.withColumn("_epoch", epoch_seconds(rows, timestamp)), windows, ["_family", "_bucket"])
        rows = rows.filter("_bucket IS NULL OR (_epoch >= _window_start AND _epoch < _window_end)")
    else:
        rows = rows.withColumns({"_window_start": none, "_window_end": none})

    users: dict[str, list[int]] = {}
    fields: dict[str, list[int]] = {}
    for m in members:
        sql = m.sql or {f"{INDICATOR_PREFIX}{i}": calculation_sql(c, mode) for c, i in m.family.calculations}
        for name, text in sql.items():
            users.setdefault(text, []).append(m.number)
            m.columns[name] = f"_value{list(users).index(text)}"
        for name in _group_list(m.family.group_fields):
            fields.setdefault(name, []).append(m.number)
            m.columns[group_name(name)] = f"_key{list(fields).index(name)}"
    keys = [
        F.when(F.col("_family").isin(mine), aliased(name)).alias(f"_key{i}") for i, (name, mine) in enumerate(fields.items())
    ]
    values = [
        F.expr(f"{text} FILTER (WHERE _family IN ({', '.join(str(n) for n in sorted(set(mine)))}))").alias(f"_value{i}")
        for i, (text, mine) in enumerate(users.items())
    ]
    if timestamp:
        ts = F.col(quoted(timestamp))
        values += [F.min(ts).alias("_result_min_ts"), F.max(ts).alias("_result_max_ts")]
    return rows.groupBy("_family", "_pane", "_window_start", "_window_end", *keys).agg(*values)


def _member_result(dataset: DataFrame, done: DataFrame, m: _Shared, mode: str) -> DataFrame:
    """The rows of one family from the shared aggregate, as :func:`evaluate_family` gives them."""
    family = m.family
    names = [group_name(g) for g in _group_list(family.group_fields)]
    own = [F.col(column).alias(name) for name, column in m.columns.items()]
    mine = done.filter(F.col("_family") == m.number)
    if not family.timestamp:
        return mine.select(*own).select(*[quoted(n) for n in [*names, *(f"{INDICATOR_PREFIX}{i}" for i in family.indicator_ids)]])
    ranges = [F.col("_result_min_ts"), F.col("_result_max_ts")]
    if m.forms:
        exprs = [calculation_column(c, mode).alias(f"{INDICATOR_PREFIX}{i}") for c, i in family.calculations]
        windows = windows_frame(dataset.sparkSession, family.times, family.lookback)
        pairs = interval_join(mine.select(*own, *ranges, "_pane"), windows, "_pane", family.lookback)
        mine = pairs.groupBy(*[quoted(n) for n in names], "_window_start", "_window_end").agg(*_merges(dataset, m.forms, exprs))
    else:
        mine = mine.select(*own, *ranges, "_window_start", "_window_end")
    mine = mine.withColumnsRenamed(
        {"_window_start": "_lookback_range_start_ts", "_window_end": "_lookback_range_end_ts"}
    )
    return _series_columns(mine, names, family.calculations)


def shared_results(spark: SparkSession, batch: Sequence[Family], mode: str = "approx") -> dict[int, DataFrame]:
    """By their place, the results of families over one dataset and time column that one scan answers.

    They are what :func:`evaluate_family` gives, which is left to evaluate the others: families that cannot share (their
    calculations combine several calls, or they have neither times nor groups), and all families if the shared job
    fails, so that the fault of one stays its own. The shared aggregate is stored and each family reads its rows;
    this runs a job.
    """
    able = [n for n, family in enumerate(batch) if _is_shareable(family)]
    if len(able) < 2:
        return {}
    try:
        dataset = spark.sql(batch[0].dataset_query)
        members = [_shared_member(dataset, n, batch[n], mode) for n in able]
        done = stored(shared_aggregate(dataset, members, mode), "families")
        return {m.number: _member_result(dataset, done, m, mode) for m in members}
    except Exception as failure:  # noqa: BLE001 - evaluated one by one, each shows its own
        log.warning("families over dataset %s are evaluated one by one: %s", batch[0].dataset_id, failure)
        return {}


def evaluate_definitions(
    definitions: DataFrame, mode: str = "approx", sketch_in_key: bool = False
) -> Iterator[tuple[Family, DataFrame]]:
    """Each family with its result, for a sink to write one after the other; families of a dataset share a scan."""
    spark = definitions.sparkSession
    for batch in batches_of_families(families(definitions, sketch_in_key)):
        shared = shared_results(spark, batch, mode)
        for n, family in enumerate(batch):
            yield family, shared[n] if n in shared else evaluate_family(spark, family, mode)


def backfill(definitions: DataFrame, times: DataFrame) -> DataFrame:
    """Definitions with further, past evaluation times: ``times`` has ``indicator_id``, ``evaluation_time`` (ms)."""
    extra = times.groupBy("indicator_id").agg(F.collect_set("evaluation_time").alias("_extra"))
    joined = definitions.join(extra, "indicator_id", "left")
    merged = F.array_union(
        F.coalesce("evaluation_times", F.array().cast("array<bigint>")),
        F.coalesce("_extra", F.array().cast("array<bigint>")),
    )
    return joined.withColumn("evaluation_times", merged).drop("_extra").select(*definitions.columns)


def definition_key(group_fields: str, interval: str, lookback: int, dataset_id: object, filter_key: str = "") -> str:
    """Driver-side form of :func:`family_key`."""
    return "_".join(
        [str(dataset_id), text_fingerprint(group_fields), filter_key, str(lookback), text_fingerprint(interval)]
    )


__all__ = [
    "COUNT_DISTINCT",
    "DECILE",
    "NONE",
    "Family",
    "backfill",
    "calculation_column",
    "definition_key",
    "evaluate_definitions",
    "evaluate_family",
    "evaluation_times",
    "exploded_times",
    "families",
    "family_key",
    "filter_fingerprint",
    "indicator_query",
    "indicator_series",
    "observed_only",
    "rolling_indicators",
    "sketch_class",
    "with_family_keys",
]

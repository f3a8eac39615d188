"""Look-back indicators over an event stream."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from dqspark.functions.columns import INDICATOR_PREFIX, aliased, group_name
from dqspark.operators.indicators import MIN_OVERLAP, _all_mergeable, _group_list, _merges, _series_columns, calculation_column
from dqspark.plans.joins import quoted


def lookback_stream(
    stream: DataFrame,
    calculations: Sequence[tuple[str, object]],
    timestamp: str,
    lookback: int,
    interval: int,
    lag: int,
    group_fields: str | Sequence[str | Mapping[str, str]] = (),
    filters: str | None = None,
    mode: str = "sketch",
) -> DataFrame:
    """Streaming form of ``rolling_indicators``: a window comes out once, when data may be later
    than its end by more than ``lag`` seconds. Distinct counts need mode ``sketch`` or ``approx``.

    Where the look-back spans several intervals and all calculations merge, each row updates the state of one
    pane, the longest stretch that divides look-back and interval. A pane comes out when it is closed and
    updates the windows that it is part of, so the state of windows is touched by panes only.
    """
    rows = stream.filter(F.expr(f"({filters})")) if filters else stream
    if not isinstance(rows.schema[timestamp].dataType, T.TimestampType):
        rows = rows.withColumn(timestamp, F.col(quoted(timestamp)).cast("timestamp"))
    rows = rows.withWatermark(timestamp, f"{int(lag)} seconds")
    ts = F.col(quoted(timestamp))
    exprs = [calculation_column(c, mode).alias(f"{INDICATOR_PREFIX}{i}") for c, i in calculations]
    exprs += [F.min(ts).alias("_result_min_ts"), F.max(ts).alias("_result_max_ts")]
    fields = _group_list(group_fields)
    keys, names = [aliased(f) for f in fields], [group_name(f) for f in fields]
    window = f"{int(lookback)} seconds", f"{int(interval)} seconds"
    forms = _all_mergeable(rows, calculations, mode) if lookback >= MIN_OVERLAP * interval else None
    if forms:
        pane = F.window(ts, f"{math.gcd(int(lookback), int(interval))} seconds").alias("_pane")
        partials = [F.expr(e).alias(n) for m in forms.values() for n, e in m.partials.items()]
        panes = rows.groupBy(pane, *keys).agg(*partials, *exprs[len(calculations) :])
        ends = F.window(F.window_time("_pane"), *window).alias("_window")
        out = panes.groupBy(ends, *[F.col(quoted(n)) for n in names]).agg(*_merges(rows, forms, exprs))
    else:
        out = rows.groupBy(F.window(ts, *window).alias("_window"), *keys).agg(*exprs)
    out = out.withColumns({
        "_lookback_range_start_ts": F.unix_seconds("_window.start"),
        "_lookback_range_end_ts": F.unix_seconds("_window.end"),
    })
    return _series_columns(out, names, calculations)


def append_stream(
    result: DataFrame, path: str, checkpoint: str, available_now: bool = True, interval: str = "1 minute"
) -> StreamingQuery:
    """Append closed windows to a parquet folder, exactly once."""
    writer = result.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start(path)

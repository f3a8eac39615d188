"""Structured Streaming: object profiles, look-back windows, freshness and distinct counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from dqspark.operators.rollup import rollup_metrics
from dqspark.plans.storage import scratch_path
from dqspark.streaming.objects import freshness_stream, object_stream, profile_stream
from dqspark.streaming.windows import append_stream, lookback_stream
from workloads.events import number_sql
from workloads.registry import query, rounded, table
from workloads.times import FRESHNESS_SQL, MIDDLE

EVENT_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)
WAIT_SECONDS = 600


def event_objects(spark, sf_dir) -> str:
    """The events as several files, in time order within each."""
    path = scratch_path(spark, "arriving")
    table(spark, sf_dir, "events").repartitionByRange(4, "event_id").write.parquet(path)
    return path


def finished(stream_query) -> None:
    if not stream_query.awaitTermination(WAIT_SECONDS):
        stream_query.stop()
        raise TimeoutError("the stream did not finish")


@query(f"""
SELECT event_type, {number_sql("value")}, round(var_pop(value) * count(value), 2) AS "m2|value",
  max(floor(epoch(ts)))::BIGINT AS max_ts, min(floor(epoch(ts)))::BIGINT AS min_ts,
  0::BIGINT AS execution_time, count(*) AS total_group_count
FROM events GROUP BY 1
""")
def stream_profile(spark, sf_dir):
    out, checkpoint = scratch_path(spark, "stream-profile"), scratch_path(spark, "stream-checkpoint")
    rows = object_stream(spark, event_objects(spark, sf_dir), "parquet", EVENT_SCHEMA, files_per_trigger=2)
    settings = {
        "dimensions": ["event_type"],
        "numbers": ["value"],
        "timestamps": {"ts": {"column": "ts", "format": "%Y-%m-%d %H:%M:%S"}},
        "keyed": False,
        "mergeable": True,
    }
    finished(profile_stream(rows, out, checkpoint, settings))
    times = ["max_ts", "min_ts", "execution_time"]
    stored = spark.read.parquet(out).drop("object", "batch_id")
    return rounded(rollup_metrics(stored, ["event_type"], times))


CLOSED_SQL = """
SELECT event_type, {metrics},
  h + (i - 2) * 3600 AS _lookback_range_start_ts, h + i * 3600 AS _lookback_range_end_ts
FROM (SELECT *, unnest(generate_series(1, 2)) AS i, floor(epoch(ts) / 3600)::BIGINT * 3600 AS h FROM events)
GROUP BY event_type, h + (i - 2) * 3600, h + i * 3600
HAVING h + i * 3600 <= (SELECT max(epoch(ts)) - 3600 FROM events)
"""


def _lookback(spark, sf_dir, calculations, lookback=7200):
    out, checkpoint = scratch_path(spark, "stream-lookback"), scratch_path(spark, "stream-checkpoint")
    rows = object_stream(spark, event_objects(spark, sf_dir), "parquet", EVENT_SCHEMA)
    result = lookback_stream(rows, calculations, "ts", lookback, 3600, 3600, "event_type")
    finished(append_stream(result, out, checkpoint))
    return spark.read.schema(result.schema).parquet(out)


PLAIN_METRICS = """count(*) AS _indicator_1, round(sum(value), 2) AS _indicator_2,
  min(floor(epoch(ts)))::BIGINT AS first_second"""


@query(CLOSED_SQL.format(metrics=PLAIN_METRICS))
def stream_lookback(spark, sf_dir):
    out = _lookback(spark, sf_dir, [("COUNT(*)", 1), ("SUM(value)", 2)])
    return out.select(
        "event_type", "_indicator_1", F.round("_indicator_2", 2).alias("_indicator_2"),
        F.unix_seconds("_result_min_ts").alias("first_second"),
        "_lookback_range_start_ts", "_lookback_range_end_ts",
    )


@query(f"""
WITH t AS (SELECT *, ({MIDDLE} - floor(epoch(ts))) / 60.0 AS m FROM events)
SELECT event_type, {FRESHNESS_SQL.format(m="m")} AS freshness, count(*) AS records FROM t GROUP BY 1, 2
""")
def stream_freshness(spark, sf_dir):
    out, checkpoint = scratch_path(spark, "stream-freshness"), scratch_path(spark, "stream-checkpoint")
    rows = object_stream(spark, event_objects(spark, sf_dir), "parquet", EVENT_SCHEMA, files_per_trigger=2)
    finished(freshness_stream(rows, "ts", out, checkpoint, MIDDLE, ("event_type",)))
    return spark.read.parquet(out).groupBy("event_type", "freshness").agg(F.sum("records").alias("records"))


@query(CLOSED_SQL.format(metrics=PLAIN_METRICS + ", round(avg(value), 10) AS _indicator_3").replace("generate_series(1, 2)", "generate_series(1, 24)").replace("(i - 2)", "(i - 24)"))
def stream_lookback_day(spark, sf_dir):
    """A look-back of 24 intervals: every row updates one pane."""
    out = _lookback(spark, sf_dir, [("COUNT(*)", 1), ("SUM(value)", 2), ("AVG(value)", 3)], 86400)
    return out.select(
        "event_type", "_indicator_1", F.round("_indicator_2", 2).alias("_indicator_2"), F.round("_indicator_3", 10).alias("_indicator_3"),
        F.unix_seconds("_result_min_ts").alias("first_second"),
        "_lookback_range_start_ts", "_lookback_range_end_ts",
    )


@query(CLOSED_SQL.format(metrics="count(DISTINCT user_id) AS exact, true AS close"))
def stream_distinct(spark, sf_dir):
    out = _lookback(spark, sf_dir, [("COUNT(DISTINCT user_id)", 1)])
    ends = F.col("_lookback_range_end_ts")
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    events = table(spark, sf_dir, "events").withColumn(
        "_lookback_range_end_ts",
        F.explode(F.transform(F.array(F.lit(1), F.lit(2)), lambda i: (F.floor(seconds / 3600) + i) * 3600)),
    )
    exact = events.groupBy("event_type", "_lookback_range_end_ts").agg(F.count_distinct("user_id").alias("exact"))
    joined = out.join(exact, ["event_type", "_lookback_range_end_ts"])
    estimate = F.hll_sketch_estimate("_indicator_1")
    return joined.select(
        "event_type", "exact", (F.abs(estimate / F.col("exact") - 1) <= 0.08).alias("close"),
        "_lookback_range_start_ts", ends,
    )

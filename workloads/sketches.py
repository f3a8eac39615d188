"""Distinct counts and quantiles, exact and by mergeable sketches."""

from __future__ import annotations

from pyspark.sql import functions as F

from dqspark.operators import sketches as S
from dqspark.operators.indicators import calculation_column, indicator_query
from dqspark.operators.rollup import rollup_metrics
from workloads.registry import query, table

DISTINCT_TOLERANCE, RANK_TOLERANCE = 0.08, 0.03


@query("""
SELECT event_type, count(DISTINCT user_id) AS distinct_count FROM events GROUP BY 1
""")
def exact_distinct(spark, sf_dir):
    return S.exact_distinct(table(spark, sf_dir, "events"), "user_id", ["event_type"])


@query("""
SELECT event_type, round(quantile_cont(value, 0.9), 6) AS percentile FROM events GROUP BY 1
""")
def exact_percentile(spark, sf_dir):
    out = S.exact_percentile(table(spark, sf_dir, "events"), "value", 0.9, ["event_type"])
    return out.withColumn("percentile", F.round("percentile", 6))


@query("""
SELECT l_returnflag, l_linestatus, round(quantile_cont(l_extendedprice, 0.25), 4) AS percentile
FROM lineitem GROUP BY 1, 2
""")
def exact_percentile_lineitem(spark, sf_dir):
    out = S.exact_percentile(
        table(spark, sf_dir, "lineitem"), "l_extendedprice", 0.25, ["l_returnflag", "l_linestatus"]
    )
    return out.withColumn("percentile", F.round("percentile", 4))


def _close(estimate, exact):
    return F.abs(estimate / exact - 1) <= DISTINCT_TOLERANCE


def _share_below(c, bound):
    return F.avg((c <= bound).cast("double"))


@query("""
SELECT event_type, count(DISTINCT user_id) AS exact, true AS value_close, true AS sketch_close,
  true AS percentile_close, count(*) AS records
FROM events GROUP BY 1
""", name="approx_distinct")
def approx_values(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    estimates = rows.groupBy("event_type").agg(
        F.count_distinct("user_id").alias("exact"),
        calculation_column("COUNT(DISTINCT user_id)", "approx").alias("by_value"),
        S.distinct_estimate(calculation_column("count( distinct user_id )", "sketch")).alias("by_sketch"),
        calculation_column("approx_percentile(value, 0.5)", "approx").alias("p50"),
        F.count(F.lit(1)).alias("records"),
    )
    shares = (
        rows.join(estimates.select("event_type", "p50"), "event_type")
        .groupBy("event_type")
        .agg(_share_below(F.col("value"), F.col("p50")).alias("share"))
    )
    return estimates.join(shares, "event_type").select(
        "event_type",
        "exact",
        _close(F.col("by_value"), F.col("exact")).alias("value_close"),
        _close(F.col("by_sketch"), F.col("exact")).alias("sketch_close"),
        (F.abs(F.col("share") - 0.5) <= RANK_TOLERANCE).alias("percentile_close"),
        "records",
    )


@query("""
SELECT count(DISTINCT user_id) AS exact_users, count(DISTINCT event_id) AS exact_events, count(*) AS records,
  true AS users_close, true AS events_close
FROM events
""")
def hll_rollup(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    daily = S.with_sketches(rows, ["day", "event_type"], distinct=["user_id", "event_id"])
    merged = rollup_metrics(daily, [])
    exact = rows.agg(
        F.count_distinct("user_id").alias("exact_users"), F.count_distinct("event_id").alias("exact_events")
    )
    return merged.select(
        exact.select("exact_users").scalar().alias("exact_users"),
        exact.select("exact_events").scalar().alias("exact_events"),
        F.col("total_group_count").alias("records"),
        S.distinct_estimate(F.col("`hll|user_id`")).alias("users"),
        S.distinct_estimate(F.col("`hll|event_id`")).alias("events"),
    ).select(
        "exact_users",
        "exact_events",
        "records",
        _close(F.col("users"), F.col("exact_users")).alias("users_close"),
        _close(F.col("events"), F.col("exact_events")).alias("events_close"),
    )


@query("""
SELECT event_type, count(*) AS records, true AS p50_close, true AS p90_close FROM events GROUP BY 1
""")
def kll_quantile(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    daily = S.with_sketches(rows, ["day", "event_type"], quantiles=["value"])
    merged = rollup_metrics(daily, ["event_type"])
    bounds = merged.select(
        "event_type",
        "total_group_count",
        S.quantile_estimate("kll|value", 0.5).alias("p50"),
        S.quantile_estimate("kll|value", 0.9).alias("p90"),
    )
    shares = (
        rows.join(bounds, "event_type")
        .groupBy("event_type", F.col("total_group_count").alias("records"))
        .agg(
            _share_below(F.col("value"), F.col("p50")).alias("s50"),
            _share_below(F.col("value"), F.col("p90")).alias("s90"),
        )
    )
    return shares.select(
        "event_type",
        "records",
        (F.abs(F.col("s50") - 0.5) <= RANK_TOLERANCE).alias("p50_close"),
        (F.abs(F.col("s90") - 0.9) <= RANK_TOLERANCE).alias("p90_close"),
    )


END = 1_706_659_200  # 2024-01-31 00:00:00


@query(f"""
SELECT event_type, {END - 10 * 86400}::BIGINT AS _result_min_ts, {END}::BIGINT AS _result_max_ts,
  {END - 10 * 86400}::BIGINT AS _lookback_range_start_ts, {END}::BIGINT AS _lookback_range_end_ts,
  true AS has_sketch, count(*) AS _indicator_2
FROM events WHERE epoch(ts) >= {END - 10 * 86400} AND epoch(ts) < {END} GROUP BY 1
""")
def requested_range(spark, sf_dir):
    out = indicator_query(
        table(spark, sf_dir, "events"),
        [("COUNT(DISTINCT user_id)", 1), ("COUNT(*)", 2)],
        "event_type",
        "ts",
        END,
        10 * 86400,
        mode="sketch",
        time_range="requested",
    )
    estimate = S.distinct_estimate(F.col("_indicator_1"))
    return out.withColumn("has_sketch", estimate > 0).drop("_indicator_1")

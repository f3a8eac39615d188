"""Indicators, their families and keys, tags and series."""

from __future__ import annotations

from pyspark.sql import functions as F

from dqspark.operators import indicators as I
from dqspark.operators.lookup import code_lookup
from dqspark.operators.series import metric_series
from dqspark.operators.tags import indicator_tags, merge_tags
from dqspark.sources.readers import computed_dataset
from workloads.registry import query, rounded, table

SHIP_END = 946_684_800  # 2000-01-01
SHIP_LOOKBACK = 730 * 86400


@query(f"""
WITH t AS (SELECT *, epoch(l_shipdate)::BIGINT AS e FROM lineitem)
SELECT l_returnflag AS flag, count(*) AS _indicator_1, round(sum(l_quantity), 2) AS _indicator_2,
  round(100.0 * count(CASE WHEN l_discount > 0.05 THEN 1 END) / count(*), 4) AS _indicator_3,
  round(stddev_samp(l_tax), 6) AS _indicator_4, count(DISTINCT l_suppkey) AS _indicator_5,
  min(e) AS _result_min_ts, max(e) AS _result_max_ts,
  {SHIP_END - SHIP_LOOKBACK}::BIGINT AS _lookback_range_start_ts, {SHIP_END}::BIGINT AS _lookback_range_end_ts
FROM t WHERE e >= {SHIP_END - SHIP_LOOKBACK} AND e < {SHIP_END} AND (l_quantity > 10 OR l_discount > 0.05)
GROUP BY 1
""")
def indicator_family(spark, sf_dir):
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("shipped_items")
    dataset = computed_dataset(spark, "SELECT * FROM shipped_items;")
    result = I.indicator_query(
        dataset,
        [
            ("COUNT(*)", 1),
            ("sum(l_quantity)", 2),
            ("100.0 * COUNT(CASE WHEN l_discount > 0.05 THEN 1 END)/COUNT(*)", 3),
            ("stddev(l_tax)", 4),
            ("COUNT(distinct l_suppkey)", 5),
        ],
        [{"l_returnflag": "flag"}],
        "l_shipdate",
        SHIP_END,
        SHIP_LOOKBACK,
        "l_quantity > 10 OR l_discount > 0.05",
        mode="exact",
    )
    for name in ("_result_min_ts", "_result_max_ts"):
        result = result.withColumn(name, F.unix_seconds(F.col(name).cast("timestamp")))
    digits = {"_indicator_2": 2, "_indicator_3": 4, "_indicator_4": 6}
    return result.withColumns(
        {n: F.round(F.col(n).cast("double"), d) for n, d in digits.items()}
    )


DAYS = [1_704_153_600 + 86400 * i for i in range(30)]


@query(f"""
WITH w AS (SELECT unnest(generate_series({DAYS[0]}, {DAYS[-1]}, 86400)) AS et)
SELECT event_type, count(*) AS _indicator_1, round(sum(value), 2) AS _indicator_2,
  count(DISTINCT user_id) AS _indicator_3,
  min(floor(epoch(ts)))::BIGINT AS _result_min_ts, max(floor(epoch(ts)))::BIGINT AS _result_max_ts,
  et - 172800 AS _lookback_range_start_ts, et AS _lookback_range_end_ts
FROM events JOIN w ON floor(epoch(ts)) >= et - 172800 AND floor(epoch(ts)) < et
WHERE value > 5 OR event_type = 'view'
GROUP BY event_type, et
""")
def indicator_backfill(spark, sf_dir):
    result = I.indicator_series(
        table(spark, sf_dir, "events"),
        [("COUNT(*)", 1), ("SUM(value)", 2), ("COUNT(DISTINCT user_id)", 3)],
        DAYS,
        2 * 86400,
        "ts",
        "event_type",
        "value > 5 OR event_type = 'view'",
        mode="exact",
    )
    for name in ("_result_min_ts", "_result_max_ts"):
        result = result.withColumn(name, F.unix_seconds(F.col(name).cast("timestamp")))
    return result.withColumn("_indicator_2", F.round("_indicator_2", 2))


@query("""
WITH times AS (SELECT 1704067200 + 25 * i AS t FROM range(100000) r(i)),
e AS (SELECT event_type, value, floor(epoch(ts))::BIGINT AS s FROM events),
w AS (
  SELECT t, event_type, count(*) AS n, sum(value) AS total, avg(value) AS mean, max(s) AS last
  FROM e JOIN times ON s >= t - 21600 AND s < t GROUP BY 1, 2)
SELECT event_type, t // 86400 AS day, count(*) AS windows, sum(n)::BIGINT AS rows_in_windows, max(n) AS most,
  round(sum(total), 2) AS total, round(sum(mean) / count(*), 6) AS mean, sum(last)::BIGINT AS lasts
FROM w GROUP BY 1, 2
""")
def indicator_series_table(spark, sf_dir):
    """A hundred thousand evaluation times, every 25 seconds, each looking back six hours."""
    times = spark.range(100_000).select((F.lit(1_704_067_200) + F.col("id") * 25).alias("evaluation_time"))
    found = I.indicator_series(
        table(spark, sf_dir, "events"), [("COUNT(*)", 1), ("SUM(value)", 2), ("AVG(value)", 3)], times, 21_600, "ts", "event_type"
    )
    return found.groupBy("event_type", F.floor(F.col("_lookback_range_end_ts") / 86400).alias("day")).agg(
        F.count(F.lit(1)).alias("windows"),
        F.sum("_indicator_1").alias("rows_in_windows"),
        F.max("_indicator_1").alias("most"),
        F.round(F.sum("_indicator_2"), 2).alias("total"),
        F.round(F.sum("_indicator_3") / F.count(F.lit(1)), 6).alias("mean"),
        F.sum(F.unix_seconds(F.col("_result_max_ts").cast("timestamp"))).alias("lasts"),
    )


@query("""
WITH t AS (SELECT event_type, value, unnest(generate_series(1, 2)) AS i,
  floor(epoch(ts) / 3600)::BIGINT * 3600 AS h, floor(epoch(ts))::BIGINT AS e FROM events)
SELECT event_type, count(*) AS _indicator_1, round(sum(value), 2) AS _indicator_2,
  min(e) AS _result_min_ts, max(e) AS _result_max_ts,
  h + (i - 2) * 3600 AS _lookback_range_start_ts, h + i * 3600 AS _lookback_range_end_ts
FROM t GROUP BY event_type, h + (i - 2) * 3600, h + i * 3600
""")
def rolling_lookback(spark, sf_dir):
    result = I.rolling_indicators(
        table(spark, sf_dir, "events"),
        [("COUNT(*)", 1), ("SUM(value)", 2)],
        "ts",
        7200,
        3600,
        "event_type",
    )
    for name in ("_result_min_ts", "_result_max_ts"):
        result = result.withColumn(name, F.unix_seconds(F.col(name).cast("timestamp")))
    return result.withColumn("_indicator_2", F.round("_indicator_2", 2))


def nation_definitions(spark, sf_dir):
    """One indicator definition per nation, over the events."""
    events_path = f"{sf_dir.rstrip('/')}/events.parquet"
    key, region = F.col("n_nationkey"), F.col("n_regionkey")
    calculation = (
        F.when(key % 4 == 0, "COUNT(*)")
        .when(key % 4 == 1, "SUM(value)")
        .when(key % 4 == 2, "COUNT(DISTINCT user_id)")
        .otherwise("MAX(value)")
    )
    times = F.transform(F.array(*[F.lit(10 + i) for i in range(3)]), lambda d: (d.cast("bigint") * 86400 + 1_703_980_800) * 1000)
    return table(spark, sf_dir, "nation").select(
        key.cast("bigint").alias("indicator_id"),
        F.col("n_name").alias("indicator_name"),
        region.cast("bigint").alias("org_id"),
        F.lit(1).cast("bigint").alias("computed_dataset_id"),
        F.lit(f"SELECT * FROM parquet.`{events_path}`;").alias("computed_dataset_query"),
        F.lit("files").alias("computed_dataset_source"),
        F.array(F.lit("events"), F.concat(F.lit("copy_"), F.col("n_name"))).alias("raw_dataset_names"),
        calculation.alias("calculation"),
        F.when(region % 2 == 0, "event_type").otherwise("").alias("group_fields"),
        F.when(region <= 1, "value > 10").otherwise("").alias("filters"),
        F.lit("ts").alias("timestamp_column"),
        times.alias("evaluation_times"),
        F.lit("0 0 * * *").alias("evaluation_interval"),
        (F.lit(86400) * (1 + region % 2)).cast("bigint").alias("lookback_window_length"),
        F.lit(60).cast("bigint").alias("lag"),
    )


@query("""
WITH w AS (SELECT unnest([10, 11, 12]) * 86400 + 1703980800 AS et),
m AS (
  SELECT n_nationkey, n_name, n_regionkey, CASE WHEN n_regionkey % 2 = 0 THEN event_type ELSE '' END AS g, et,
    count(*) AS c, sum(value) AS s, count(DISTINCT user_id) AS d, max(value) AS x
  FROM nation, w, events
  WHERE floor(epoch(ts)) >= et - 86400 * (1 + n_regionkey % 2) AND floor(epoch(ts)) < et
    AND (n_regionkey > 1 OR value > 10)
  GROUP BY ALL)
SELECT n_nationkey::BIGINT AS indicator_id, 'dq.' || n_name AS metric, et AS timestamp,
  round(CASE n_nationkey % 4 WHEN 0 THEN c WHEN 1 THEN s WHEN 2 THEN d ELSE x END, 2) AS value,
  CASE WHEN n_regionkey % 2 = 0 THEN 'event_type:' || g || ',' ELSE '' END
    || 'origin:test,delay_seconds:60,timestamp_col:ts,data_source:files,lookback_seconds:'
    || (86400 * (1 + n_regionkey % 2))::VARCHAR || ',dataset:events,dataset:copy_' || n_name
    || ',indicator_id:' || n_nationkey::VARCHAR AS tags
FROM m
""")
def indicator_families(spark, sf_dir):
    from dqspark.operators.rollup import concat_results

    definitions = nation_definitions(spark, sf_dir)
    tags = indicator_tags(definitions)
    series = [
        metric_series(result, tags, "dq", ["origin:test"])
        for _, result in I.evaluate_definitions(definitions, mode="exact")
    ]
    out = concat_results(series)
    return out.select(
        "indicator_id", "metric", "timestamp", F.round("value", 2).alias("value"), F.array_join("tags", ",").alias("tags")
    )


@query("""
WITH d AS (
  SELECT p_partkey, p_partkey % 5 AS ds, 3600 * (1 + p_size % 4) AS lb,
    CASE WHEN p_size % 2 = 0 THEN p_brand || ',  ' || p_type ELSE p_type || ',' || p_brand END AS g,
    '((p_brand = ''' || p_brand || ''') AND (p_size > 10))' AS f,
    CASE p_partkey % 4 WHEN 0 THEN 'COUNT(distinct p_container)' WHEN 1 THEN 'approx_percentile(p_retailprice, 0.5)'
      WHEN 2 THEN '100.0 * COUNT(p_size)/COUNT(*)' ELSE 'count(DISTINCT a) + count(DISTINCT b)' END AS c
  FROM part)
SELECT p_partkey AS indicator_id,
  concat_ws('_', ds::VARCHAR, sha1(array_to_string(list_sort(list_transform(string_split(g, ','), lambda x: trim(x))), ',')),
    sha1(f), lb::VARCHAR, sha1('*/5 * * * *')) AS compute_hash,
  CASE c WHEN 'COUNT(distinct p_container)' THEN 'COUNT_DISTINCT'
    WHEN 'approx_percentile(p_retailprice, 0.5)' THEN 'DECILE' ELSE 'NONE' END AS sketch_type
FROM d
""")
def family_keys(spark, sf_dir):
    key, size, brand = F.col("p_partkey"), F.col("p_size"), F.col("p_brand")
    calculation = (
        F.when(key % 4 == 0, "COUNT(distinct p_container)")
        .when(key % 4 == 1, "approx_percentile(p_retailprice, 0.5)")
        .when(key % 4 == 2, "100.0 * COUNT(p_size)/COUNT(*)")
        .otherwise("count(DISTINCT a) + count(DISTINCT b)")
    )
    condition = F.concat(F.lit("p_brand = '"), brand, F.lit("'"))
    definitions = table(spark, sf_dir, "part").select(
        key.alias("indicator_id"),
        (key % 5).alias("computed_dataset_id"),
        F.when(size % 2 == 0, F.concat(brand, F.lit(",  "), "p_type"))
        .otherwise(F.concat("p_type", F.lit(","), brand))
        .alias("group_fields"),
        F.when(size % 3 == 0, F.concat(condition, F.lit(" AND p_size > 10")))
        .otherwise(F.concat(F.lit("(p_size>10)  and ("), condition, F.lit(")")))
        .alias("filters"),
        (3600 * (1 + size % 4)).alias("lookback_window_length"),
        F.lit("*/5 * * * *").alias("evaluation_interval"),
        calculation.alias("calculation"),
    )
    return I.with_family_keys(definitions).select("indicator_id", "compute_hash", "sketch_type")


@query("""
WITH m AS (SELECT event_type, count(*) AS a, sum(value) AS b, max(CASE WHEN event_type = 'view' THEN value END) AS c
  FROM events GROUP BY 1),
u AS (SELECT event_type, 1 AS id, a::DOUBLE AS value FROM m UNION ALL SELECT event_type, 2, round(b, 2) FROM m
  UNION ALL SELECT event_type, 3, c FROM m WHERE c IS NOT NULL)
SELECT id::BIGINT AS indicator_id, CASE id WHEN 1 THEN 'dqspark.rows seen' ELSE 'dqspark._indicator_' || id END AS metric,
  1706659200::BIGINT AS timestamp, value,
  'event_type:' || event_type || ',origin:dqspark'
    || CASE id WHEN 1 THEN ',team:a,indicator_id:1' WHEN 2 THEN ',team:b' ELSE '' END AS tags
FROM u
""", name="metric_series")
def metric_series_rows(spark, sf_dir):
    result = I.indicator_query(
        table(spark, sf_dir, "events"),
        [("COUNT(*)", 1), ("SUM(value)", 2), ("MAX(CASE WHEN event_type = 'view' THEN value END)", 3)],
        "event_type",
        "ts",
        1_706_659_200,
        60 * 86400,
    )
    tags = spark.createDataFrame(
        [(1, ["name:rows seen", "team:a"]), (2, ["team:b"])], "indicator_id bigint, tags array<string>"
    )
    out = metric_series(result, tags)
    return out.select(
        "indicator_id", "metric", "timestamp", F.round("value", 2).alias("value"), F.array_join("tags", ",").alias("tags")
    )


@query("""
WITH o AS (SELECT o_custkey AS id, 'orders:' || count(*)::VARCHAR AS t FROM orders GROUP BY 1)
SELECT coalesce(c_custkey, id) AS indicator_id,
  concat_ws(',', 'segment:' || c_mktsegment, t) AS tags
FROM customer FULL JOIN o ON c_custkey = id
""")
def tag_merge(spark, sf_dir):
    stored = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("indicator_id"), F.array(F.concat(F.lit("segment:"), "c_mktsegment")).alias("tags")
    )
    later = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("indicator_id"))
        .agg(F.array(F.concat(F.lit("orders:"), F.count(F.lit(1)).cast("string"))).alias("tags"))
    )
    return merge_tags(stored, later).select("indicator_id", F.array_join("tags", ",").alias("tags"))


@query("""
SELECT CASE WHEN n_nationkey % 3 = 2 THEN n_name ELSE upper(substr(r_name, 1, 3)) || n_nationkey::VARCHAR END AS code,
  count(*) AS customers
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1
""", name="code_lookup")
def code_lookup_customers(spark, sf_dir):
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    kind = F.col("n_nationkey") % 3
    codes = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.when(kind == 0, F.col("n_name")).alias("official_name"),
        F.when(kind == 1, F.col("n_name")).alias("name"),
        F.concat(F.upper(F.substring("r_name", 1, 3)), F.col("n_nationkey").cast("string")).alias("code"),
    )
    people = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return (
        code_lookup(people, "n_name", codes, "code").groupBy("code").agg(F.count(F.lit(1)).alias("customers"))
    )


@query("""
SELECT event_type, count(*) AS _indicator_1, round(avg(value), 4) AS _indicator_2 FROM events
WHERE value BETWEEN 5 AND 50 AND props NOT LIKE '%7%' GROUP BY 1
""")
def indicator_without_time(spark, sf_dir):
    result = I.indicator_query(
        table(spark, sf_dir, "events"),
        [("COUNT(*)", 1), ("AVG(value)", 2)],
        "event_type",
        filters="value BETWEEN 5 AND 50 AND props NOT LIKE '%7%'",
    )
    return rounded(result)


@query("""
SELECT p_partkey, true AS order_ignored, true AS meaning_kept FROM part
""")
def filter_fingerprint(spark, sf_dir):
    brand = F.concat(F.lit("p_brand = '"), "p_brand", F.lit("'"))
    forms = F.array(
        F.struct(F.lit(0).alias("form"), F.concat(brand, F.lit(" AND p_size > 10")).alias("filters")),
        F.struct(F.lit(1).alias("form"), F.concat(F.lit("((p_size>10)) and "), brand).alias("filters")),
        F.struct(F.lit(2).alias("form"), F.concat(brand, F.lit(" OR p_size > 10")).alias("filters")),
    )
    rows = table(spark, sf_dir, "part").select("p_partkey", F.inline(forms))
    keys = I.with_filter_keys(rows).groupBy("p_partkey").agg(
        *[F.max(F.when(F.col("form") == i, F.col("filter_key"))).alias(f"k{i}") for i in range(3)]
    )
    return keys.select(
        "p_partkey",
        (F.col("k0") == F.col("k1")).alias("order_ignored"),
        (F.col("k0") != F.col("k2")).alias("meaning_kept"),
    )


@query("""
WITH w AS (SELECT unnest([10, 11, 12, 13]) * 86400 + 1703980800 AS et),
m AS (
  SELECT n_nationkey, CASE WHEN n_regionkey % 2 = 0 THEN 'event_type:' || event_type || ',' ELSE '' END AS g, et,
    count(*) AS c, sum(value) AS s, count(DISTINCT user_id) AS d, max(value) AS x
  FROM nation, w, events
  WHERE floor(epoch(ts)) >= et - 86400 * (1 + n_regionkey % 2) AND floor(epoch(ts)) < et
    AND (n_regionkey > 1 OR value > 10) AND (et < 1703980800 + 13 * 86400 OR n_nationkey % 2 = 0)
  GROUP BY ALL)
SELECT n_nationkey::BIGINT AS indicator_id, et AS timestamp,
  round(CASE n_nationkey % 4 WHEN 0 THEN c WHEN 1 THEN s WHEN 2 THEN d ELSE x END, 2) AS value, g || 'origin:dqspark' AS tags
FROM m
""")
def backfilled_families(spark, sf_dir):
    from dqspark.operators.rollup import concat_results

    extra = table(spark, sf_dir, "nation").filter("n_nationkey % 2 = 0").select(
        F.col("n_nationkey").cast("bigint").alias("indicator_id"),
        F.lit((13 * 86400 + 1_703_980_800) * 1000).cast("bigint").alias("evaluation_time"),
    )
    definitions = I.backfill(nation_definitions(spark, sf_dir), extra)
    series = [metric_series(result) for _, result in I.evaluate_definitions(definitions, mode="exact")]
    return concat_results(series).select(
        "indicator_id", "timestamp", F.round("value", 2).alias("value"), F.array_join("tags", ",").alias("tags")
    )


STEP, SPAN = 10 * 86400, 30 * 86400


@query(f"""
WITH e AS (SELECT l_returnflag, epoch(l_shipdate)::BIGINT AS e, l_quantity AS q FROM lineitem),
s AS (SELECT l_returnflag, (e // {STEP} + k) * {STEP} AS _lookback_range_end_ts, q
  FROM e, (SELECT unnest([1, 2, 3]) AS k))
SELECT p AS way, l_returnflag, sum(CAST(q AS DECIMAL(12,2)))::DOUBLE AS _indicator_1,
  (_lookback_range_end_ts - {SPAN})::BIGINT AS _lookback_range_start_ts, _lookback_range_end_ts::BIGINT AS _lookback_range_end_ts
FROM s, (SELECT unnest(['panes', 'window', 'spread', 'series of panes', 'interval join']) AS p) GROUP BY ALL
""")
def indicator_paths(spark, sf_dir):
    """One sum by every way of evaluation; the results are put together by position."""
    from functools import reduce

    rows = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_suppkey", F.col("l_quantity").cast("decimal(12,2)").alias("q"), F.col("l_shipdate").cast("timestamp").alias("at")
    )
    seconds = rows.withColumn("at", F.unix_seconds("at"))
    step = F.floor(F.unix_seconds("at") / STEP)
    times = rows.select(F.explode(F.array(*[(step + k) * STEP for k in (1, 2, 3)])).alias("evaluation_time")).distinct()
    merged, not_merged = [("sum(q)", 1)], [("sum(q)", 1), ("stddev(l_suppkey)", 2)]
    ways = {
        "panes": I.rolling_indicators(rows, merged, "at", SPAN, STEP, "l_returnflag"),
        "window": I.rolling_indicators(rows, not_merged, "at", SPAN, STEP, "l_returnflag"),
        "spread": I.rolling_indicators(seconds, not_merged, "at", SPAN, STEP, "l_returnflag"),
        "series of panes": I.indicator_series(rows, merged, times, SPAN, "at", "l_returnflag"),
        "interval join": I.indicator_series(rows, not_merged, times, SPAN, "at", "l_returnflag"),
    }
    parts = [d.drop("_indicator_2", "_result_min_ts", "_result_max_ts").withColumn("way", F.lit(way)) for way, d in ways.items()]
    out = reduce(lambda a, b: a.union(b), parts)
    return out.withColumn("_indicator_1", F.col("_indicator_1").cast("double"))

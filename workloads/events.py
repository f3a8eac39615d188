"""Profiles, labels, nested dimensions, names and keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from dqspark.functions import columns as C
from dqspark.operators.profile import (
    add_record_counts,
    dimension_values,
    drop_unparseable,
    finish,
    merge_metrics,
    profile,
)
from dqspark.operators.rollup import concat_results, rolling_rollup, rollup_metrics
from dqspark.plans.storage import cut_lineage
from workloads.registry import EVENT_MEAN_DIGITS, query, rounded, table

NUMBER_SQL = """
  count({c}) AS "count|{n}", round(coalesce(sum({c}), 0), 2) AS "sum|{n}",
  round(max({c}), 4) AS "max|{n}", round(min({c}), 4) AS "min|{n}",
  round(avg({c}), {mean}) AS "mean|{n}", round(stddev_samp({c}), 6) AS "std|{n}",
  count(*) FILTER (WHERE {c} IS NULL) AS "null_count|{n}"
"""
TEXT_SQL = """
  count({c}) AS "count|{c}", count(*) FILTER (WHERE {c} IS NULL) AS "null_count|{c}"
"""
LABEL_SQL = "coalesce(nullif(trim({c}::VARCHAR), ''), '<empty>')"


def number_sql(name: str, column: str | None = None) -> str:
    mean = EVENT_MEAN_DIGITS if name == "value" else 6
    return NUMBER_SQL.format(c=column or name, n=name, mean=mean)


TS = {"ts": {"column": "ts", "format": "%Y-%m-%d %H:%M:%S", "primary": True}}
RUN_TIME = 1_706_659_200


@query(f"""
SELECT {LABEL_SQL.format(c="event_type")} AS event_type, {TEXT_SQL.format(c="props")}, {number_sql("value")},
  max(floor(epoch(ts)))::BIGINT AS max_ts, min(floor(epoch(ts)))::BIGINT AS min_ts,
  {RUN_TIME}::BIGINT AS execution_time, count(*) AS total_group_count
FROM events GROUP BY 1
""")
def profile_events(spark, sf_dir):
    result = profile(
        table(spark, sf_dir, "events"),
        dimensions=["event_type"],
        strings=["props"],
        numbers=["value"],
        timestamps=TS,
        execution_time=RUN_TIME,
        keyed=False,
    )
    return rounded(result.metrics)


@query(f"""
SELECT {number_sql("l_quantity")}, {number_sql("l_extendedprice")}, {number_sql("l_discount")},
  {TEXT_SQL.format(c="l_returnflag")}, 0::BIGINT AS execution_time,
  count(*) AS total_group_count, count(*) AS total_record_count
FROM lineitem
""")
def profile_global(spark, sf_dir):
    result = profile(
        table(spark, sf_dir, "lineitem"),
        strings=["l_returnflag"],
        numbers=["l_quantity", "l_extendedprice", "l_discount"],
        keyed=False,
    )
    return rounded(add_record_counts(cut_lineage(result.metrics)))


@query(f"""
SELECT l_returnflag, l_linestatus, {number_sql("l_quantity")}, {number_sql("l_extendedprice")},
  {number_sql("l_discount")}, {number_sql("l_tax")}, 0::BIGINT AS execution_time, count(*) AS total_group_count
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def profile_lineitem(spark, sf_dir):
    result = profile(
        table(spark, sf_dir, "lineitem"),
        dimensions=["l_returnflag", "l_linestatus"],
        numbers=["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
        keyed=False,
    )
    return rounded(result.metrics)


@query(f"""
WITH t AS (
  SELECT o_orderstatus, TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS priority,
    TRY_CAST(CASE WHEN o_custkey % 3 = 0 THEN o_custkey::VARCHAR || 'x'
      WHEN o_custkey % 3 = 1 THEN ' ' || o_custkey::VARCHAR || ' ' END AS DOUBLE) AS customer
  FROM orders)
SELECT o_orderstatus, {number_sql("priority")}, {number_sql("customer")},
  0::BIGINT AS execution_time, count(*) AS total_group_count
FROM t GROUP BY 1
""")
def numeric_coerce(spark, sf_dir):
    key = F.col("o_custkey")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderstatus",
        F.substring("o_orderpriority", 1, 1).alias("priority"),
        F.when(key % 3 == 0, F.concat(key.cast("string"), F.lit("x")))
        .when(key % 3 == 1, F.concat(F.lit(" "), key.cast("string"), F.lit(" ")))
        .alias("customer"),
        F.col("o_orderpriority").alias("never"),
    )
    numbers = ["priority", "customer", "never"]
    result = profile(rows, dimensions=["o_orderstatus"], numbers=numbers, keyed=False)
    return rounded(drop_unparseable(result.metrics, numbers))


@query(f"""
WITH t AS (SELECT CASE o_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '  ' WHEN 2 THEN ' a ' ELSE 'a' END AS tag,
  o_totalprice FROM orders)
SELECT {LABEL_SQL.format(c="tag")} AS tag, {number_sql("o_totalprice")},
  0::BIGINT AS execution_time, count(*) AS total_group_count FROM t GROUP BY 1
""")
def labels_normalised(spark, sf_dir):
    kind = F.col("o_custkey") % 4
    tag = F.when(kind == 1, "  ").when(kind == 2, " a ").when(kind == 3, "a")
    rows = table(spark, sf_dir, "orders").withColumn("tag", tag)
    return rounded(profile(rows, dimensions=["tag"], numbers=["o_totalprice"], keyed=False).metrics)


@query(f"""
SELECT coalesce(json_extract_string(props, '$.k'), '') AS "props.k", {number_sql("value")},
  0::BIGINT AS execution_time, count(*) AS total_group_count
FROM events GROUP BY 1
""")
def json_dimension(spark, sf_dir):
    result = profile(
        table(spark, sf_dir, "events"), dimensions={"object": ["props.k"]}, numbers=["value"], keyed=False
    )
    return rounded(result.metrics)


@query("""
WITH t AS (SELECT role, string_split(text, chr(10)) AS lines FROM conversations)
SELECT coalesce(role, '<empty>') AS role,
  coalesce(length(lines[2])::VARCHAR, '<empty>') AS second_line,
  0::BIGINT AS execution_time, count(*) AS total_group_count
FROM t GROUP BY 1, 2
""")
def list_dimension(spark, sf_dir):
    lines = F.transform(
        F.split("text", "\n"), lambda line: F.struct(F.length(line).cast("string").alias("length"))
    )
    rows = table(spark, sf_dir, "conversations").withColumn("lines", lines)
    spec = {"second_line": {"index": 1, "col": {"lines": "length"}}}
    return profile(rows, dimensions={"scalar": ["role"], "list": [spec]}, keyed=False).metrics


@query(f"""
SELECT 'web' AS "partition.event_type", event_type AS "object.event_type", 'eu' AS region,
  {number_sql("value")}, 0::BIGINT AS execution_time, count(*) AS total_group_count
FROM events GROUP BY event_type
""")
def collision_columns(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    fields = {"event_type": "web", "region": "eu"}
    names = [
        C.resolve_name(n, rows.columns, list(fields))
        for n in ("event_type", "object.event_type", "partition.region")
    ]
    return rounded(profile(C.add_path_fields(rows, fields), names, numbers=["value"], keyed=False).metrics)


@query("""
SELECT c_custkey AS customer, c_name AS c_name, c_acctbal * 2 AS "double balance", 1::BIGINT AS _indicator_7,
  c_nationkey AS "time|max_seen", c_mktsegment AS "dim|c_mktsegment"
FROM customer
""")
def tolerant_select(spark, sf_dir):
    rows = table(spark, sf_dir, "customer")
    wanted = C.tolerant_select(rows, ["c_custkey", "no_such_column", "c_name", "c_acctbal", "c_nationkey", "c_mktsegment"])
    shaped = wanted.select(
        C.aliased({"c_custkey": "customer"}),
        C.aliased(" c_name "),
        C.aliased({"c_acctbal * 2": "double balance"}),
        F.lit(1).cast("bigint").alias("_INDICATOR_7"),
        F.col("c_nationkey").alias("max_seen"),
        "c_mktsegment",
    )
    return C.with_role_names(C.lower_reserved(shaped), ["c_mktsegment"], ["max_seen"], None)


KIND_SQL = """CASE WHEN TRY_CAST({c} AS DOUBLE) IS NULL THEN 'string'
  WHEN TRY_CAST({c} AS DOUBLE) = floor(TRY_CAST({c} AS DOUBLE)) THEN 'integer' ELSE 'number' END"""


@query(f"""
WITH t AS (SELECT p_partkey, p_brand, p_size::VARCHAR AS p_size, p_retailprice::VARCHAR AS p_retailprice FROM part)
SELECT p_partkey, {KIND_SQL.format(c="p_brand")} AS brand_type, {KIND_SQL.format(c="p_size")} AS size_type,
  {KIND_SQL.format(c="p_retailprice")} AS price_type, TRY_CAST(p_size AS BIGINT) AS size_value
FROM t
""")
def partition_value_types(spark, sf_dir):
    size, price = F.col("p_size").cast("string"), F.col("p_retailprice").cast("string")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        C.inferred_type(F.col("p_brand")).alias("brand_type"),
        C.inferred_type(size).alias("size_type"),
        C.inferred_type(price).alias("price_type"),
        C.inferred_value(size)["as_integer"].alias("size_value"),
    )


@query("""
WITH t AS (SELECT *, p_brand || ' | ' || p_type || '|' || p_name AS items FROM part)
SELECT p_partkey, sha1(array_to_string(list_sort(list_transform(string_split(items, '|'), lambda x: trim(x))), '|'))
    AS fingerprint,
  'part ' || p_brand || '-' || p_size::VARCHAR AS filled
FROM t
""")
def metric_key(spark, sf_dir):
    items = F.concat_ws("|", F.concat("p_brand", F.lit(" ")), F.concat(F.lit(" "), "p_type"), "p_name")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        C.list_fingerprint(items, "|").alias("fingerprint"),
        C.fill_template("part {p_brand}-{p_size}").alias("filled"),
    )


@query("""
WITH t AS (SELECT o_orderstatus, o_totalprice::VARCHAR AS price, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders)
SELECT o_orderstatus, to_base64(encode(count(DISTINCT day)::VARCHAR)) AS days_text,
  round(stddev_samp(TRY_CAST(price AS DOUBLE)), 4) AS price_std,
  min(epoch(TRY_CAST(day AS DATE)))::BIGINT AS first_day, max(epoch(TRY_CAST(day AS DATE)))::BIGINT AS last_day
FROM t GROUP BY 1
""")
def safe_scalars(spark, sf_dir):
    from pyspark.sql import types as T

    rows = table(spark, sf_dir, "orders").select(
        "o_orderstatus",
        F.col("o_totalprice").cast("string").alias("price"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
    )
    day = C.date_epoch(F.col("day"))
    return rows.groupBy("o_orderstatus").agg(
        C.to_base64_text(F.count_distinct("day"), T.LongType()).alias("days_text"),
        F.round(C.safe_stddev(F.col("price")), 4).alias("price_std"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
    )


@query(f"""
SELECT a.*, b.* EXCLUDE (event_type) FROM
  (SELECT event_type, {TEXT_SQL.format(c="props")}, count(*) AS total_group_count FROM events GROUP BY 1) a
  JOIN (SELECT event_type, {number_sql("value")} FROM events GROUP BY 1) b
  ON a.event_type IS NOT DISTINCT FROM b.event_type
""")
def merge_profiles(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    texts = profile(rows, ["event_type"], strings=["props"], keyed=False).metrics.drop("execution_time")
    numbers = profile(rows, ["event_type"], numbers=["value"], keyed=False).metrics
    numbers = numbers.drop("execution_time", "total_group_count")
    return rounded(merge_metrics(texts, numbers, ["event_type"]))


@query("""
SELECT DISTINCT 'event_type' AS dimension, event_type AS value FROM events
UNION SELECT DISTINCT 'user_id', user_id::VARCHAR FROM events
""", name="dimension_values")
def dimension_value_rows(spark, sf_dir):
    return dimension_values(table(spark, sf_dir, "events"), ["event_type", "user_id"])


@query(f"""
SELECT event_type, {number_sql("value")}, round(var_pop(value) * count(value), 2) AS "m2|value",
  max(floor(epoch(ts)))::BIGINT AS max_ts, min(floor(epoch(ts)))::BIGINT AS min_ts,
  0::BIGINT AS execution_time, count(*) AS total_group_count
FROM events GROUP BY 1
""", name="rollup_metrics")
def rollup_daily(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    daily = profile(rows, ["event_type"], numbers=["value"], timestamps=TS, by=["day"], keyed=False, mergeable=True)
    stored = cut_lineage(daily.metrics)
    return rounded(rollup_metrics(stored, ["event_type"], daily.times.names))


@query(f"""
WITH panes AS (
  SELECT event_type, ts, value, unnest(generate_series(0, 23)) AS i,
    (floor(epoch(ts) / 3600)::BIGINT + 1) * 3600 AS pane FROM events)
SELECT pane + i * 3600 AS evaluation_time, event_type, {number_sql("value")},
  0::BIGINT AS execution_time, count(*) AS total_group_count
FROM panes GROUP BY 1, 2
""")
def rolling_profile(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn(
        "pane_end", (F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 3600) + 1) * 3600
    )
    panes = profile(rows, ["event_type"], numbers=["value"], by=["pane_end"], keyed=False, mergeable=True)
    rolled = rolling_rollup(
        cut_lineage(panes.metrics), "pane_end", 3600, 24 * 3600, ["event_type"], panes.times.names
    )
    return rounded(rolled.drop("m2|value"))


@query(f"""
SELECT 'orders' AS dataset, o_orderstatus AS status, {number_sql("o_totalprice")},
  NULL::BIGINT AS "count|l_tax", NULL::DOUBLE AS "sum|l_tax", NULL::DOUBLE AS "max|l_tax",
  NULL::DOUBLE AS "min|l_tax", NULL::DOUBLE AS "mean|l_tax", NULL::DOUBLE AS "std|l_tax",
  NULL::BIGINT AS "null_count|l_tax", count(*) AS total_group_count FROM orders GROUP BY 2
UNION ALL
SELECT 'lineitem', l_linestatus, NULL, NULL, NULL, NULL, NULL, NULL, NULL, {number_sql("l_tax")}, count(*)
FROM lineitem GROUP BY 2
""")
def concat_datasets(spark, sf_dir):
    orders = profile(
        table(spark, sf_dir, "orders").withColumnRenamed("o_orderstatus", "status"),
        ["status"], numbers=["o_totalprice"], keyed=False,
    )
    items = profile(
        table(spark, sf_dir, "lineitem").withColumnRenamed("l_linestatus", "status"),
        ["status"], numbers=["l_tax"], keyed=False,
    )
    both = concat_results([
        orders.metrics.withColumn("dataset", F.lit("orders")),
        items.metrics.withColumn("dataset", F.lit("lineitem")),
    ])
    return rounded(both.drop("execution_time"))


KEY_TAIL = C.text_fingerprint("event_type|web|events", "|")


@query(f"""
SELECT event_type AS "dim|event_type", max(floor(epoch(ts)))::BIGINT AS "primary_time|max_ts",
  min(floor(epoch(ts)))::BIGINT AS "time|min_ts", {RUN_TIME}::BIGINT AS "time|execution_time",
  count(props) AS "count|props|{KEY_TAIL}",
  count(*) FILTER (WHERE props IS NULL) AS "null_count|props|{KEY_TAIL}",
  count(*) AS total_group_count, (SELECT count(*) FROM events) AS total_record_count,
  'landing' AS bucket, 'events.parquet' AS object, {RUN_TIME}::BIGINT AS execution_time
FROM events GROUP BY event_type
""")
def object_profile(spark, sf_dir):
    result = profile(
        table(spark, sf_dir, "events"),
        ["event_type"],
        strings=["props"],
        timestamps=TS,
        execution_time=RUN_TIME,
        source_id="web",
        dataset="events",
    )
    return finish(result, "landing", "events.parquet", RUN_TIME)

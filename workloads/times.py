"""Event times: precision, zones, freshness, evaluation grids, look-back windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from dqspark.functions.timecols import add_times, evaluation_times
from dqspark.operators.profile import profile
from workloads.registry import query, rounded, table

MIDDLE = 1_705_276_800  # 2024-01-15 00:00:00

FRESHNESS_SQL = """CASE WHEN {m} < -60 THEN 'future: >1 hour' WHEN {m} < 0 THEN 'future: 0-1 hour'
  WHEN {m} <= 5 THEN '0-5min' WHEN {m} <= 10 THEN '5-10min' WHEN {m} <= 20 THEN '10-20min'
  WHEN {m} <= 30 THEN '20-30min' WHEN {m} <= 60 THEN '30-60min' WHEN {m} <= 120 THEN '1-2h'
  WHEN {m} <= 180 THEN '2-3h' WHEN {m} <= 1440 THEN '3-24h' ELSE '>24h' END"""


@query(f"""
WITH t AS (SELECT *, ({MIDDLE} - floor(epoch(ts))) / 60.0 AS m FROM events)
SELECT event_type, {FRESHNESS_SQL.format(m="m")} AS ts_freshness, count(value) AS "count|value",
  round(sum(value), 2) AS "sum|value", {MIDDLE}::BIGINT AS execution_time,
  max(floor(epoch(ts)))::BIGINT AS max_ts, min(floor(epoch(ts)))::BIGINT AS min_ts, count(*) AS total_group_count
FROM t GROUP BY 1, 2
""")
def freshness_buckets(spark, sf_dir):
    result = profile(
        table(spark, sf_dir, "events"),
        ["event_type"],
        numbers=["value"],
        timestamps={"ts": {"column": "ts", "format": "%Y-%m-%d %H:%M:%S", "freshness": True}},
        execution_time=MIDDLE,
        keyed=False,
    )
    names = ["event_type", "ts_freshness", "count|value", "sum|value", "execution_time", "max_ts", "min_ts"]
    return rounded(result.metrics.select(*[f"`{n}`" for n in [*names, "total_group_count"]]))


def _epoch(sql: str) -> str:
    return f"epoch({sql})::BIGINT"


@query(f"""
SELECT event_id, {_epoch("date_trunc('second', ts)")} AS min_second, {_epoch("date_trunc('second', ts)")} AS max_second,
  {_epoch("date_trunc('minute', ts)")} AS min_minute, {_epoch("date_trunc('minute', ts)")} + 59 AS max_minute,
  {_epoch("date_trunc('hour', ts)")} AS min_hour, {_epoch("date_trunc('hour', ts)")} + 3599 AS max_hour,
  {_epoch("date_trunc('day', ts)")} AS min_day, {_epoch("date_trunc('day', ts)")} + 86399 AS max_day,
  {_epoch("date_trunc('month', ts)")} AS min_month,
  {_epoch("date_trunc('month', ts) + INTERVAL 1 MONTH")} - 1 AS max_month,
  {_epoch("date_trunc('year', ts)")} AS min_year, {_epoch("date_trunc('year', ts) + INTERVAL 1 YEAR")} - 1 AS max_year
FROM events
""")
def time_precision(spark, sf_dir):
    def text(pattern: str):
        return F.date_format(F.col("ts").cast("timestamp"), pattern)

    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit(" "), text("yyyy-MM-dd'T'HH:mm:ss")).alias("second_text"),
        text("dd/MM/yyyy HH:mm").alias("minute_text"),
        text("yyyy-MM-dd").alias("day_text"),
        text("hh a").alias("hour_text"),
        text("MMM yyyy").alias("month_text"),
        text("yyyy").alias("year_text"),
    )
    mappings = {
        "second": {"column": "second_text", "format": "%Y-%m-%dT%H:%M:%S"},
        "minute": {"column": "minute_text", "format": "%d/%m/%Y %H:%M"},
        "hour": {"column": "{day_text} at {hour_text}", "format": "%Y-%m-%d at %I %p"},
        "day": {"column": "day_text", "format": "%Y-%m-%d"},
        "month": {"column": "month_text", "format": "%b %Y"},
        "year": {"column": "year_text", "format": "%Y"},
        "absent": {"column": "{no_such}-{day_text}", "format": "%Y-%m-%d"},
    }
    out, times = add_times(rows, mappings, 0)
    return out.select("event_id", *[n for n in times.names if n != "execution_time"])


@query("""
SELECT event_id, epoch(date_trunc('day', ts) + INTERVAL 5 HOUR)::BIGINT AS min_west,
  epoch(date_trunc('day', ts) + INTERVAL 29 HOUR)::BIGINT - 1 AS max_west,
  epoch(date_trunc('second', ts))::BIGINT AS min_unknown, epoch(date_trunc('second', ts))::BIGINT AS max_unknown,
  epoch(date_trunc('second', ts) - INTERVAL 2 HOUR)::BIGINT AS min_offset,
  epoch(date_trunc('second', ts) - INTERVAL 2 HOUR)::BIGINT AS max_offset
FROM events
""")
def time_zone(spark, sf_dir):
    stamp = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format(F.col("ts").cast("timestamp"), "yyyyMMdd").alias("day_text"),
        stamp.alias("stamp"),
        F.concat(stamp, F.lit("+0200")).alias("stamp_offset"),
    )
    mappings = {
        "west": {"column": "day_text", "format": "%Y%m%d", "timezone": "Etc/GMT+5"},
        "unknown": {"column": "stamp", "format": "%Y-%m-%d %H:%M:%S", "timezone": "Nowhere/Atlantis"},
        "offset": {"column": "stamp_offset", "format": "%Y-%m-%d %H:%M:%S%z"},
    }
    out, times = add_times(rows, mappings, 0)
    return out.select("event_id", *[n for n in times.names if n != "execution_time"])


@query("""
SELECT event_type, min(floor(epoch(ts)))::BIGINT AS min_seen, max(floor(epoch(ts)))::BIGINT AS max_seen,
  7::BIGINT AS execution_time, count(*) AS total_group_count
FROM events GROUP BY 1
""")
def unix_passthrough(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("epoch", F.unix_seconds(F.col("ts").cast("timestamp")))
    spec = {"seen": {"column": "epoch", "format": "unixtime", "timezone": "UTC", "primary": True}}
    result = profile(rows, ["event_type"], timestamps=spec, execution_time=7, keyed=False)
    assert result.times.primary == "max_seen"
    return result.metrics


@query("""
WITH b AS (SELECT event_type, min(floor(epoch(ts)))::BIGINT AS s, max(floor(epoch(ts)))::BIGINT - 3600 AS e
  FROM events GROUP BY 1),
g AS (SELECT event_type, s, e, unnest(generate_series(s - s % 900, e + 10 * 86400, 900)) AS t FROM b),
ok AS (SELECT * FROM g WHERE isodow(to_timestamp(t)::TIMESTAMP) <= 5
  AND hour(to_timestamp(t)::TIMESTAMP) BETWEEN 8 AND 18 AND t > s),
n AS (SELECT event_type, min(t) AS nxt FROM ok WHERE t > e GROUP BY 1)
SELECT ok.event_type, t AS evaluation_time FROM ok JOIN n USING (event_type) WHERE t <= e OR t = nxt
""")
def eval_grid(spark, sf_dir):
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    bounds = (
        table(spark, sf_dir, "events")
        .groupBy("event_type")
        .agg(F.min(seconds).alias("last_evaluation"), F.max(seconds).alias("max_time"))
    )
    return evaluation_times(
        bounds, "*/15 8-18 * * mon-fri", "last_evaluation", "max_time", delay=3600, keep=("event_type",)
    )


@query("""
WITH o AS (SELECT o_orderkey, o_custkey, date_trunc('day', o_orderdate) AS d FROM orders),
p AS (SELECT *, epoch(d)::BIGINT AS e, (o_custkey % 24)::BIGINT AS h, (o_orderkey % 60)::BIGINT AS m FROM o)
SELECT o_orderkey, e AS min_short, e + 86399 AS max_short, e + 3600 * h + 60 * m AS min_digits,
  e + 3600 * h + 60 * m AS max_digits, e + 3600 * (h - 2) + 60 * m AS min_offset, e + 3600 * (h - 2) + 60 * m + 59 AS max_offset,
  e AS min_named, e + 86399 AS max_named, e + 3600 * h + 60 * m + 9 AS min_packed, e + 3600 * h + 60 * m + 9 AS max_packed
FROM p
""")
def time_formats(spark, sf_dir):
    day = F.date_trunc("day", "o_orderdate")
    at = (day + F.make_dt_interval(hours=(F.col("o_custkey") % 24).cast("int"), mins=(F.col("o_orderkey") % 60).cast("int")))
    rows = table(spark, sf_dir, "orders").withColumn("at", at)
    texts = {
        "short": ("M/d/yyyy", "%m/%d/%Y"),
        "digits": ("yyyy-M-d H:m:s", "%Y-%m-%d %H:%M:%S"),
        "offset": ("yyyy-MM-dd'T'HH:mm'+02:00'", "%Y-%m-%dT%H:%M%z"),
        "named": ("EEEE, d MMM yyyy", "%A, %d %b %Y"),
        "packed": ("yyyyMMddHHmm'09123456'", "%Y%m%d%H%M%S%f"),
    }
    written = rows.select("o_orderkey", *[F.date_format("at", pattern).alias(f"t_{k}") for k, (pattern, _) in texts.items()])
    out, times = add_times(written, {k: {"column": f"t_{k}", "format": f} for k, (_, f) in texts.items()}, 0)
    return out.select("o_orderkey", *[n for n in times.names if n != "execution_time"])


CHANGE = 1_730_602_800  # 2024-11-03 03:00 UTC, three hours before clocks in New York go back


@query(f"""
WITH e AS (SELECT event_id, {CHANGE} + (event_id * 37) % 21600 AS e FROM events)
SELECT event_id, e::BIGINT AS min_exact, e::BIGINT AS max_exact, (e - e % 3600)::BIGINT AS min_hourly,
  (e - e % 3600 + 3599)::BIGINT AS max_hourly, e::BIGINT AS min_text, e::BIGINT AS max_text FROM e
""")
def time_zone_change(spark, sf_dir):
    at = F.timestamp_seconds(F.lit(CHANGE) + (F.col("event_id") * 37) % 21600)
    text = F.concat(F.date_format(at - F.expr("INTERVAL 4 HOURS"), "yyyy-MM-dd HH:mm:ss"), F.lit("-04:00"))
    rows = table(spark, sf_dir, "events").select("event_id", at.alias("at"), text.alias("text"))
    zone = {"timezone": "America/New_York"}
    specs = {
        "exact": {"column": "at", "format": "%Y-%m-%d %H:%M:%S", **zone},
        "hourly": {"column": "at", "format": "%Y-%m-%d %H", **zone},
        "text": {"column": "text", "format": "%Y-%m-%d %H:%M:%S%z", **zone},
    }
    out, times = add_times(rows, specs, 0)
    return out.select("event_id", *[n for n in times.names if n != "execution_time"])

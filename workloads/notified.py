"""Notifications of arrived objects, from the message to profiles and a log."""

from __future__ import annotations

from pyspark.sql import functions as F

from dqspark.operators.datasets import Dataset, decoded_path
from dqspark.operators.rollup import rollup_metrics
from dqspark.plans.storage import scratch_path
from dqspark.streaming.notified import NotifiedDataset, bare_path, profile_notified
from workloads.registry import query, rounded, table
from workloads.streams import finished

TIMES = {"ts": {"column": "ts", "format": "%Y-%m-%d %H:%M:%S", "primary": True}}
WEB = Dataset("web", "landing/web", "{event_type}", "parquet", numbers=["value"], timestamps=TIMES, dimensions=["event_type"])
APP = Dataset(
    "app", "landing/app", "{event_type}", "jsonl", numbers=["value"], timestamps=TIMES, dimensions=["event_type"],
    schema="event_id bigint, ts string, user_id bigint, value double",
)
DATASETS = [NotifiedDataset("lake", WEB), NotifiedDataset("lake", APP)]


def _arrivals(spark, sf_dir) -> tuple[str, str]:
    """Events of even users as parquet, of odd ones as JSON lines, a broken object, and notifications of all.

    One more object is notified that is gone, and one that belongs to no dataset.
    """
    root, messages = scratch_path(spark, "lake"), scratch_path(spark, "notifications")
    rows = table(spark, sf_dir, "events").withColumn("ts", F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss"))
    rows = rows.select("event_id", "ts", "user_id", "value", "event_type").repartition(3, "event_id")
    rows.filter("user_id % 2 = 0").write.partitionBy("event_type").parquet(f"{root}/landing/web")
    odd = rows.filter("user_id % 2 = 1")
    odd.select("event_type", F.to_json(F.struct("event_id", "ts", "user_id", "value")).alias("value")).write.partitionBy(
        "event_type"
    ).text(f"{root}/landing/app")
    broken = rows.limit(1).select(F.lit("broken").alias("event_type"), F.lit("no parquet at all").alias("value"))
    broken.write.mode("append").partitionBy("event_type").text(f"{root}/landing/web")
    files = [spark.read.text(f"{root}/landing/{name}").select(F.col("_metadata.file_path").alias("path")) for name in ("web", "app")]
    base = bare_path(F.lit(root.rstrip("/") + "/"))
    known = files[0].unionAll(files[1]).distinct()
    key = F.substring(bare_path(decoded_path(F.col("path"))), F.length(base) + F.lit(1), F.length("path"))
    extra = spark.createDataFrame(
        [("landing/web/event_type=gone/part-0.parquet",), ("elsewhere/event_type=x/part-0.parquet",)], "key string"
    )
    keys = known.select(key.alias("key")).unionAll(extra)
    record = F.struct(F.struct(F.struct(F.lit("lake").alias("name")).alias("bucket"), F.struct("key").alias("object")).alias("s3"))
    keys.select(F.to_json(F.struct(F.array(record).alias("Records"))).alias("value")).repartition(2).write.text(messages)
    return root, messages


def _profiled(spark, sf_dir) -> str:
    root, messages = _arrivals(spark, sf_dir)
    out, checkpoint = scratch_path(spark, "notified-out"), scratch_path(spark, "notified-state")
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(messages).withColumnRenamed("value", "payload")
    finished(profile_notified(stream, DATASETS, lambda bucket: root, out, checkpoint, execution_time=5))
    return out


@query("""
SELECT CASE user_id % 2 WHEN 0 THEN 'web' ELSE 'app' END AS dataset, event_type, count(value) AS "count|value",
  round(sum(value), 2) AS "sum|value", max(floor(epoch(ts)))::BIGINT AS max_ts, min(floor(epoch(ts)))::BIGINT AS min_ts,
  count(*) AS total_group_count
FROM events GROUP BY 1, 2
""")
def notified_profile(spark, sf_dir):
    out = _profiled(spark, sf_dir)
    frames = []
    for dataset in (WEB, APP):
        rows = spark.read.parquet(f"{out}/metrics/{dataset.name}").drop("batch_id")
        plain = rows.withColumnsRenamed({c: c.rpartition("|")[0] for c in rows.columns if c.count("|") == 2})
        rolled = rollup_metrics(plain, ["event_type"], ["max_ts", "min_ts", "execution_time"])
        frames.append(
            rolled.select(
                F.lit(dataset.name).alias("dataset"), "event_type", "`count|value`", "`sum|value`", "max_ts", "min_ts", "total_group_count"
            )
        )
    return rounded(frames[0].unionAll(frames[1]))


@query("""
WITH t AS (SELECT *, CASE user_id % 2 WHEN 0 THEN 'web' ELSE 'app' END AS dataset FROM events)
SELECT dataset, event_type AS folder, max(floor(epoch(ts)))::BIGINT AS last_time, true AS has_range, count(*) AS records,
  CASE dataset WHEN 'web' THEN 'struct<event_id:bigint,ts:string,user_id:bigint,value:double>' END AS "schema",
  0 AS failures, 'max_ts' AS primary_time_column
FROM t GROUP BY 1, 2
UNION ALL SELECT 'web', f, NULL, NULL, 0, NULL, 1, NULL FROM (VALUES ('broken'), ('gone')) v(f)
""")
def notified_run_log(spark, sf_dir):
    log = spark.read.parquet(f"{_profiled(spark, sf_dir)}/log")
    return log.groupBy("dataset", F.regexp_extract("object_key", "event_type=([^/]+)", 1).alias("folder")).agg(
        F.max("max_primary_time").alias("last_time"),
        F.every(F.col("min_primary_time") <= F.col("max_primary_time")).alias("has_range"),
        F.sum("total_record_count").alias("records"),
        F.max("schema").alias("schema"),
        F.count("error").cast("int").alias("failures"),
        F.max(F.when(F.col("error").isNull(), F.col("primary_time_column"))).alias("primary_time_column"),
    )

"""Results written and read back: formats, metric tables, tags, logs, catalog tables, inventories."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from dqspark.operators import indicators as I
from dqspark.operators.datasets import Dataset, object_records, profile_arrivals, profile_dataset
from dqspark.operators.profile import profile
from dqspark.operators.rollup import concat_results, rollup_metrics
from dqspark.operators.tags import indicator_tags
from dqspark.plans.storage import cut_lineage, scratch_path, stored
from dqspark.sinks import metrics as K
from dqspark.sources.objects import object_inventory
from dqspark.sources.readers import read_dataset
from workloads.events import TEXT_SQL, number_sql
from workloads.indicators import nation_definitions
from workloads.registry import query, rounded, table
from workloads.streams import finished

EVENT_JSON = "event_id bigint, ts string, user_id bigint, event_type string, value double, props string"
INGESTED = dt.datetime(2024, 2, 3, 4, 5, tzinfo=dt.timezone.utc)


def _as_text(events):
    return events.withColumn("ts", F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss"))


@query("""
SELECT f AS format, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value, props
FROM events, (VALUES ('jsonl'), ('json'), ('parquet')) t(f)
""")
def format_roundtrip(spark, sf_dir):
    rows = _as_text(table(spark, sf_dir, "events"))
    lines, document, files = (scratch_path(spark, n) for n in ("jsonl", "json", "parquet"))
    rows.write.json(lines)
    rows.write.parquet(files)
    # One document per thousand events, each a JSON array in a file of its own.
    arrays = rows.groupBy(F.floor(F.col("event_id") / 1000).alias("part")).agg(
        F.to_json(F.collect_list(F.struct(*rows.columns))).alias("value")
    )
    arrays.write.partitionBy("part").text(document)
    frames = [
        read_dataset(spark, lines, "jsonl", EVENT_JSON),
        read_dataset(spark, f"{document}/*", "json", EVENT_JSON),
        read_dataset(spark, files, "parquet"),
    ]
    return concat_results(
        [f.select(F.lit(n).alias("format"), *rows.columns) for n, f in zip(("jsonl", "json", "parquet"), frames)]
    )


@query("""
SELECT c_custkey, c_name, c_acctbal FROM customer
UNION ALL SELECT c_custkey, c_name || ' short', NULL FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT c_custkey, c_name || ', quoted', c_acctbal FROM customer WHERE c_mktsegment = 'HOUSEHOLD'
""")
def csv_tolerant(spark, sf_dir):
    path = scratch_path(spark, "csv")
    header = "c_custkey,c_name,c_acctbal"
    key, name, balance = F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_acctbal").cast("string")
    segment = F.col("c_mktsegment")
    lines = F.array_compact(F.array(
        F.concat_ws(",", key, name, balance),
        F.when(segment == "BUILDING", F.concat_ws(",", key, F.concat(name, F.lit(" short")))),
        F.when(segment == "HOUSEHOLD", F.concat_ws(",", key, F.concat(F.lit('"'), name, F.lit(', quoted"')), balance)),
        F.when(segment == "MACHINERY", F.concat_ws(",", key, name, balance, F.lit("extra"))),
        F.when(segment == "AUTOMOBILE", F.concat_ws(",", key, name, balance, F.lit(""), F.lit("extra"))),
        F.when(segment == "FURNITURE", F.concat_ws(",", key, name, balance, F.lit(""))),
    ))
    # Each file gets the header as its column name; nothing is quoted, as the separator never occurs.
    rows = table(spark, sf_dir, "customer").select(F.explode(lines).alias(header))
    rows.write.options(header=True, sep="|", quote="", escape="", quoteAll=False).csv(path)
    return read_dataset(spark, path, "csv", "c_custkey bigint, c_name string, c_acctbal double")


@query("""
SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer
""")
def csv_inferred(spark, sf_dir):
    path = scratch_path(spark, "csv-inferred")
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey"), "c_name", "c_acctbal", "c_mktsegment")
    rows.write.option("header", True).csv(path)
    read = read_dataset(spark, path, "csv")
    return read.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query("""
SELECT event_type, count(*) AS _indicator_1, round(sum(value), 2) AS _indicator_2, '7' AS org_id, 'web' AS source_id,
  'k' AS compute_hash, '2024' AS year, '02' AS month, '03' AS day, '04' AS hour, '05' AS minute,
  (SELECT count(*) FROM (VALUES (1), (2)) t(i)) AS statuses
FROM events WHERE epoch(ts) < 1706659200 GROUP BY 1
""")
def metrics_table(spark, sf_dir):
    path, statuses = scratch_path(spark, "metrics"), scratch_path(spark, "statuses")
    events = f"{sf_dir.rstrip('/')}/events.parquet"
    family = I.Family(
        "k", 7, 1, f"SELECT * FROM parquet.`{events}`", "event_type", "", "ts", 60 * 86400,
        [("COUNT(*)", 1), ("SUM(value)", 2)], [1_706_659_200],
    )
    K.write_families(spark, [family], path, statuses, "web", ingested=INGESTED)
    strings = ", ".join(f"{c} string" for c in ("org_id", "source_id", "compute_hash", *K.INGESTION_PARTS))
    schema = "event_type string, _indicator_1 bigint, _indicator_2 double, " + strings
    log = spark.read.parquet(statuses).filter(F.size("meta") == 0)
    return (
        spark.read.schema(schema)
        .parquet(path)
        .withColumn("_indicator_2", F.round("_indicator_2", 2))
        .withColumn("statuses", log.agg(F.count(F.lit(1))).scalar())
    )


@query("""
SELECT r AS run_id, event_type, count(*) AS _indicator_1, round(sum(value), 2) AS _indicator_2, 't' || t::VARCHAR AS end_time,
  (SELECT count(*) FROM range(4) s(i)) AS statuses
FROM events, (VALUES ('monday', 1705276800), ('monday', 1706659200), ('tuesday', 1706659200)) runs(r, t)
WHERE epoch(ts) >= t - 864000 AND epoch(ts) < t GROUP BY r, t, event_type
""")
def repeated_runs(spark, sf_dir):
    """Two runs of one family; the first fails halfway, is repeated, and is written once more by mistake."""
    path, statuses = scratch_path(spark, "runs"), scratch_path(spark, "run-statuses")
    events = f"{sf_dir.rstrip('/')}/events.parquet"

    def family(times, dataset=f"SELECT * FROM parquet.`{events}`"):
        return I.Family("k", 7, 1, dataset, "event_type", "", "ts", 10 * 86400, [("COUNT(*)", 1), ("SUM(value)", 2)], times)

    both = [1_705_276_800, 1_706_659_200]
    K.write_families(spark, [family(both, "SELECT * FROM no_such_table")], path, statuses, "web", run_id="monday")
    for _ in range(2):
        K.write_families(spark, [family(both)], path, statuses, "web", run_id="monday")
    K.write_families(spark, [family(both[1:])], path, statuses, "web", run_id="tuesday")
    monday = spark.read.parquet(statuses).filter((F.col("run_id") == "monday") & (F.size("meta") == 0))
    return spark.read.parquet(path).select(
        F.col("run_id").cast("string").alias("run_id"), "event_type", "_indicator_1", F.round("_indicator_2", 2).alias("_indicator_2"),
        F.concat(F.lit("t"), F.col("_lookback_range_end_ts").cast("string")).alias("end_time"),
        monday.agg(F.count(F.lit(1))).scalar().alias("statuses"),
    )


@query("""
SELECT event_type, count(*) AS _indicator_1, true AS sketch_is_text FROM events GROUP BY 1
""")
def metrics_csv(spark, sf_dir):
    path = scratch_path(spark, "metrics-csv")
    result = I.indicator_query(
        table(spark, sf_dir, "events"), [("COUNT(*)", 1), ("COUNT(DISTINCT user_id)", 2)], "event_type",
        "ts", 1_706_659_200, 60 * 86400, mode="sketch",
    )
    K.write_metrics(result, path, {"source_id": "web"}, INGESTED, "csv")
    back = read_dataset(spark, f"{path}/*/*/*/*/*/*", "csv")
    estimate = F.hll_sketch_estimate(F.unbase64("_indicator_2"))
    return back.select(
        "event_type", F.col("_indicator_1").cast("bigint").alias("_indicator_1"), (estimate > 0).alias("sketch_is_text")
    )


@query("""
SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS total_group_count, round(max(value), 4) AS "max_value"
FROM events GROUP BY 1, 2
""")
def registered_table(spark, sf_dir):
    path, name = scratch_path(spark, "registered"), f"dq_daily_{uuid.uuid4().hex}"
    rows = table(spark, sf_dir, "events").withColumn("day", F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd"))
    daily = profile(rows, ["event_type"], numbers=["value"], by=["day"], keyed=False).metrics
    daily = daily.select("day", "event_type", "total_group_count", F.round("`max|value`", 4).alias("max_value"))
    daily.write.partitionBy("day").parquet(path)
    K.register_table(spark, name, daily.schema, path, ["day"])
    assert K.table_exists(spark, name)
    first = {"day": "2024-01-01"}
    K.add_partition(spark, name, first, f"{path}/day=2024-01-01")
    K.discover_partitions(spark, name)
    return spark.table(name)


@query("""
SELECT n_nationkey::BIGINT AS indicator_id,
  'name:' || n_name || ',delay_seconds:60,timestamp_col:ts,data_source:files,lookback_seconds:'
    || (86400 * (1 + n_regionkey % 2))::VARCHAR || ',dataset:events,dataset:copy_' || n_name AS tags
FROM nation WHERE n_regionkey < 3
""", name="indicator_tags")
def stored_tags(spark, sf_dir):
    path = scratch_path(spark, "tags")
    definitions = nation_definitions(spark, sf_dir)
    K.write_tags(indicator_tags(definitions), path)
    wanted = definitions.filter(F.col("org_id") < 3)
    return K.read_tags(spark, path, wanted).select("indicator_id", F.array_join("tags", ",").alias("tags"))


@query("""
SELECT event_type AS object, min(latest) AS min_primary_time, max(latest) AS max_primary_time,
  'max_ts' AS primary_time_column, 'events' AS dataset, count(DISTINCT user_id) AS dimension_values
FROM (SELECT event_type, user_id, max(floor(epoch(ts)))::BIGINT AS latest FROM events GROUP BY 1, 2) GROUP BY 1
""")
def run_log(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("object", F.col("event_type"))
    spec = {"ts": {"column": "ts", "format": "%Y-%m-%d %H:%M:%S", "primary": True}}
    result = profile(rows, ["user_id"], timestamps=spec, by=["object"], keyed=False)
    profiled = cut_lineage(result.metrics)
    log = K.run_log(profiled, result.times.primary, by=["object"], dataset="events")
    values = K.run_dimensions(profiled, result.dimensions, ["object"])
    return log.join(values.groupBy("object").agg(F.count(F.lit(1)).alias("dimension_values")), "object")


@query("""
SELECT c AS compression, 'small' AS size_class, true AS has_files, (SELECT count(*) FROM events) AS records
FROM (VALUES ('gzip'), ('bzip2'), ('none')) t(c)
""", name="object_inventory")
def object_inventory_files(spark, sf_dir):
    path = scratch_path(spark, "inventory")
    rows = _as_text(table(spark, sf_dir, "events"))
    for codec in ("none", "gzip", "bzip2"):
        rows.repartition(4).write.option("compression", codec).json(f"{path}/{codec}")
    found = object_inventory(spark, path).filter(F.col("path").contains("part-"))
    counted = spark.read.option("recursiveFileLookup", True).schema(EVENT_JSON).json(path)
    per_codec = counted.groupBy(
        F.regexp_extract(F.col("_metadata.file_path"), "/(none|gzip|bzip2)/", 1).alias("compression")
    ).agg(F.count(F.lit(1)).alias("records"))
    kinds = found.groupBy("compression", "size_class").agg((F.count(F.lit(1)) > 0).alias("has_files"))
    return rounded(kinds.join(per_codec, "compression"))


DATASET = Dataset(
    name="events",
    prefix="landing/web",
    suffix_template="{day}/{event_type}",
    file_type="jsonl",
    strings=["props"],
    numbers=["value"],
    timestamps={"ts": {"column": "ts", "format": "%Y-%m-%d %H:%M:%S", "primary": True}},
    dimensions=["event_type", "object.day", "partition.day"],
    schema="event_id bigint, ts string, user_id bigint, value double, props string, day string",
)

DATASET_SQL = """
SELECT event_type, 'd' || (user_id % 3)::VARCHAR AS "object.day", strftime(ts, '%Y-%m-%d') AS "partition.day",
  {text}, {number}, max(floor(epoch(ts)))::BIGINT AS max_ts, min(floor(epoch(ts)))::BIGINT AS min_ts,
  5::BIGINT AS execution_time, count(*) AS total_group_count
FROM events GROUP BY 1, 2, 3
""".format(text=TEXT_SQL.format(c="props"), number=number_sql("value"))


def _write_dataset(spark, sf_dir) -> str:
    root = scratch_path(spark, "dataset")
    seconds = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd")
    rows = _as_text(table(spark, sf_dir, "events").withColumn("part_day", seconds))
    inside = rows.withColumn("day", F.concat(F.lit("d"), (F.col("user_id") % 3).cast("string")))
    # Folders of the day and the type; the day inside the files is another one.
    for_paths = inside.withColumnsRenamed({"day": "inner_day"}).withColumnRenamed("part_day", "day")
    record = F.to_json(F.struct("event_id", "ts", "user_id", "value", "props", F.col("inner_day").alias("day")))
    # Ranges of folders, large folders in several: files are as many as folders and tasks, not folders times tasks.
    ranged = for_paths.select("day", "event_type", "event_id", record.alias("value")).repartitionByRange("day", "event_type", "event_id")
    ranged.drop("event_id").write.partitionBy("day", "event_type").text(f"{root}/landing/web")
    return root


def _merged(metrics):
    names = {c: c.rpartition("|")[0] for c in metrics.columns if c.count("|") == 2}
    rolled = rollup_metrics(
        metrics.withColumnsRenamed(names), ["event_type", "object.day", "partition.day"],
        ["max_ts", "min_ts", "execution_time"],
    )
    return rounded(rolled.drop("m2|value"))


@query(DATASET_SQL)
def object_dataset(spark, sf_dir):
    found = profile_dataset(spark, _write_dataset(spark, sf_dir), DATASET, source_id="web", execution_time=5)
    return _merged(cut_lineage(found.metrics))


@query(DATASET_SQL)
def arriving_dataset(spark, sf_dir):
    root, out, state = _write_dataset(spark, sf_dir), scratch_path(spark, "arrived"), scratch_path(spark, "state")
    finished(profile_arrivals(spark, root, DATASET, out, state, source_id="web", execution_time=5))
    return _merged(spark.read.parquet(out).drop("batch_id"))


RECORDS = Dataset(
    "records", "records", "{event_type}/{shard}", "jsonl",
    schema="event_id bigint, user_id bigint, value double, props string, shard string",
)
SPLIT_BYTES = "16384"
# Tasks that the splits are dealt to: a split keeps its size, a task reads several.
SPLIT_TASKS = "512"


def _records(spark, sf_dir):
    """Events as lines of JSON objects, in order of their ids, each with some of the keys; merged, read in small splits."""
    root = scratch_path(spark, "records")
    event = F.col("event_id")
    text = F.concat(
        F.lit('{"shard": "inner", "event_id": '), event.cast("string"),
        F.when(F.col("user_id") % 2 == 0, F.concat(F.lit(', "user_id": '), F.col("user_id").cast("string"))).otherwise(""),
        F.when(event % 3 == 0, F.concat(F.lit(', "value": '), F.col("value").cast("string"))).otherwise(""),
        F.when(event % 7 == 0, F.lit(', "props": null')).when(event % 5 == 0, F.concat(F.lit(', "props": "p'), event.cast("string"), F.lit('"'))).otherwise(""),
        F.lit("}"),
    )
    rows = table(spark, sf_dir, "events").select("event_type", (event % 2).alias("shard"), event, text.alias("value"))
    rows = rows.repartition("event_type", "shard").sortWithinPartitions("event_type", "shard", "event_id")
    rows.drop("event_id").write.partitionBy("event_type", "shard").text(f"{root}/records")
    settings = {"spark.sql.files.maxPartitionBytes": SPLIT_BYTES, "spark.sql.files.maxPartitionNum": SPLIT_TASKS}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        return stored(object_records(spark, root, RECORDS), "merged-records")
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


RECORDS_SQL = """
SELECT event_type, (event_id % 2)::VARCHAR AS shard, max(event_id) AS event_id,
  arg_max(user_id, event_id) FILTER (user_id % 2 = 0) AS user_id, arg_max(value, event_id) FILTER (event_id % 3 = 0) AS "value",
  CASE WHEN max(event_id) FILTER (event_id % 7 = 0) >= max(event_id) FILTER (event_id % 5 = 0) THEN NULL
    ELSE 'p' || max(event_id) FILTER (event_id % 5 = 0)::VARCHAR END AS props
FROM events GROUP BY 1, 2
"""


@query(f"SELECT event_type, shard, 'inner' AS inner_shard, event_id, user_id, value, props FROM ({RECORDS_SQL})")
def object_records_merged(spark, sf_dir):
    found = _records(spark, sf_dir)
    return found.select(
        "event_type", F.col("`partition.shard`").alias("shard"), F.col("`object.shard`").alias("inner_shard"),
        "event_id", "user_id", "value", "props",
    )


@query(f"""
SELECT shard, count(*) AS _indicator_1, sum(event_id)::BIGINT AS _indicator_2, count(props) AS _indicator_3
FROM ({RECORDS_SQL}) GROUP BY 1
""", name="object_records")
def object_record_indicators(spark, sf_dir):
    rows = _records(spark, sf_dir).withColumnRenamed("partition.shard", "shard")
    calculations = [("COUNT(*)", 1), ("SUM(event_id)", 2), ("COUNT(props)", 3)]
    return I.indicator_query(rows, calculations, "shard").select("shard", *[f"_indicator_{i}" for _, i in calculations])

"""Schemas, catalog tables, object paths, notifications and merged records."""

from __future__ import annotations

from pyspark.sql import functions as F

from dqspark.functions import columns as C
from dqspark.operators import schema as S
from dqspark.operators.indicators import indicator_query
from dqspark.operators.rollup import concat_results
from dqspark.plans.storage import scratch_path
from dqspark.sources import objects as O
from dqspark.sources.notifications import arrived_objects
from dqspark.sources.readers import matching_tables, read_dataset, read_table, sample, sampled_text_schema
from dqspark.sources.records import merge_records
from workloads.registry import query, table


@query("""
SELECT event_type, 'OBJECT<k: BIGINT>' AS json_type FROM events GROUP BY 1
""", name="json_schema")
def json_schema_observed(spark, sf_dir):
    return S.observed_json_type(table(spark, sf_dir, "events"), "props", ["event_type"])


@query("""
SELECT * FROM (VALUES
  ('embedding', 'array', NULL, true), ('embedding[]', 'number', 'double', true),
  ('label', 'integer', 'bigint', true), ('part', 'object', NULL, true),
  ('part.half', 'number', 'double', true), ('part.odd', 'boolean', NULL, true),
  ('part.name', 'string', NULL, true), ('vec_id', 'integer', 'bigint', true)
) t(path, type, format, nullable) WHERE EXISTS (SELECT 1 FROM embeddings)
""")
def schema_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id",
        "embedding",
        "label",
        F.struct(
            (F.col("label") / 2 + 0.25).alias("half"),
            (F.col("label") % 2 == 1).alias("odd"),
            F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("name"),
        ).alias("part"),
    )
    texts = rows.select(F.to_json(F.struct("*")).alias("record"))
    # JSON numbers in variants read as decimals of the digits seen; the widest stored type is meant.
    found = S.inferred_schema(texts, "record")
    return S.schema_rows(S.widened(found), spark)


@query("""
SELECT * FROM (VALUES
  ('o_custkey', 'string', 'STRING'), ('o_orderdate', 'string', 'STRING'), ('o_orderkey', 'string', 'STRING'),
  ('o_orderpriority', 'string', 'STRING'), ('o_orderstatus', 'string', 'STRING'),
  ('o_totalprice', 'string', 'STRING'), ('partition.o_orderstatus', 'string', 'STRING'),
  ('year', 'string', 'STRING')
) t(path, type, ddl_type) WHERE EXISTS (SELECT 1 FROM orders)
""")
def sampled_schema(spark, sf_dir):
    path = scratch_path(spark, "sampled")
    table(spark, sf_dir, "orders").write.json(path)
    found = S.with_path_fields(sampled_text_schema(spark, path, "jsonl", 100), {"o_orderstatus": "F", "year": "2024"})
    small = S.json_schema(found, scalars="string")
    kinds = S.spark_type(small)
    rows = [
        (name.removeprefix("object."), spec["type"], kinds[name].dataType.simpleString().upper())
        for name, spec in small["properties"].items()
    ]
    assert sample(read_dataset(spark, path, "jsonl"), 100).count() <= 100
    return spark.createDataFrame(rows, "path string, type string, ddl_type string")


@query("""
WITH f AS (UNPIVOT (SELECT count(o_orderkey) AS o_orderkey, count(o_custkey) AS o_custkey,
    count(o_orderstatus) AS o_orderstatus, count(o_totalprice) AS o_totalprice, count(o_orderdate) AS o_orderdate,
    count(o_orderpriority) AS o_orderpriority FROM orders) ON COLUMNS(*) INTO NAME field VALUE filled
  UNION ALL UNPIVOT (SELECT count(event_id) AS event_id, count(ts) AS ts, count(user_id) AS user_id,
    count(event_type) AS event_type, count("value") AS "value", count(props) AS props FROM events)
    ON COLUMNS(*) INTO NAME field VALUE filled)
SELECT 'seen_' || table_name AS dataset, field, filled,
  CASE data_type WHEN 'BIGINT' THEN 'integer' WHEN 'DOUBLE' THEN 'number' WHEN 'TIMESTAMP' THEN 'integer' ELSE 'string' END AS type,
  CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'date-time' END AS format
FROM f JOIN information_schema.columns ON column_name = field AND table_name IN ('orders', 'events')
""")
def catalog_fields(spark, sf_dir):
    parts = []
    for name in ("orders", "events"):
        rows = table(spark, sf_dir, name)
        rows.createOrReplaceTempView(f"seen_{name}")
        counts = rows.agg(*[F.count(c).alias(c) for c in rows.columns])
        parts.append(counts.unpivot([], counts.columns, "field", "filled").withColumn("dataset", F.lit(f"seen_{name}")))
    described = [
        (found["dataset"], field, spec["type"], spec.get("format"))
        for found in S.catalog_schemas(spark, ["seen_orders", "seen_events"])
        for field, spec in found["schema"]["properties"].items()
    ]
    kinds = spark.createDataFrame(described, "dataset string, field string, type string, format string")
    return concat_results(parts).join(F.broadcast(kinds), ["dataset", "field"])


@query("""
SELECT 'dq_nation' AS table_name, count(*) AS records FROM nation
UNION ALL SELECT 'dq_orders', count(*) FROM orders
UNION ALL SELECT 'dq_order_items', count(*) FROM lineitem
""")
def catalog_tables(spark, sf_dir):
    for view, source in (("dq_nation", "nation"), ("dq_orders", "orders"), ("dq_order_items", "lineitem"),
                         ("dq_people", "customer")):
        table(spark, sf_dir, source).createOrReplaceTempView(view)
    names = matching_tables(spark, ["dq_nation", "dq_order*"])
    return concat_results([
        read_table(spark, n).agg(F.count(F.lit(1)).alias("records")).select(F.lit(n).alias("table_name"), "records")
        for n in names
    ])


# -- object paths --------------------------------------------------------------------------------

URL_SQL = r"""
urls AS (
  SELECT page_id, regexp_extract(url, '^https?://([^/]+)/', 1) AS host,
    regexp_extract(url, '^https?://[^/]+/([^/]+)/', 1) AS lang,
    regexp_extract(url, '^https?://[^/]+/[^/]+/([0-9]+)', 1) AS num FROM pages)
"""


def page_objects(spark, sf_dir):
    """Pages as objects of two buckets, with keys that carry fields in several forms."""
    url = F.col("url")
    host = F.regexp_extract(url, "^https?://([^/]+)/", 1)
    lang = F.regexp_extract(url, "^https?://[^/]+/([^/]+)/", 1)
    number = F.regexp_extract(url, "^https?://[^/]+/[^/]+/([0-9]+)", 1)
    kind = F.col("page_id") % 4
    key = (
        F.when(kind == 0, F.concat(F.lit("raw/lang="), lang, F.lit("/"), host, F.lit("/"), number, F.lit(".json")))
        .when(kind == 1, F.concat(F.lit("raw/any="), lang, F.lit("/x/"), number, F.lit(".json")))
        .when(kind == 2, F.concat(F.lit("logs/"), host, F.lit("/day="), number, F.lit("/part 0+1.json")))
        .otherwise(F.concat(F.lit("other/"), host))
    )
    bucket = F.when(kind == 2, "logs-bucket").otherwise("raw-bucket")
    return table(spark, sf_dir, "pages").select("page_id", bucket.alias("bucket"), key.alias("object_key"))


CONFIGS = [
    O.ObjectConfig("by_language", "raw-bucket", "raw", "{lang}/<host>", "jsonl"),
    O.ObjectConfig("by_anything", "raw-bucket", "raw/", "{*}/x", "jsonl"),
    O.ObjectConfig("logs", "logs-bucket", "logs/", "<host>/{day}", "json"),
]

PATHS_SQL = f"""
WITH {URL_SQL}
SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'by_language' WHEN 1 THEN 'by_anything' ELSE 'logs' END AS dataset,
  CASE page_id % 4 WHEN 2 THEN 'json' ELSE 'jsonl' END AS file_type,
  CASE page_id % 4 WHEN 0 THEN 'host=' || host || ',lang=' || lang WHEN 1 THEN 'any=' || lang
    ELSE 'day=' || num || ',host=' || host END AS fields
FROM urls WHERE page_id % 4 < 3
"""


def _fields_text(c):
    entries = F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(F.array_sort(entries), ",")


@query(PATHS_SQL)
def path_fields(spark, sf_dir):
    out = O.match_configs(page_objects(spark, sf_dir), O.config_table(spark, CONFIGS))
    return out.select("page_id", "dataset", "file_type", _fields_text(F.col("path_fields")).alias("fields"))


@query(PATHS_SQL)
def path_fields_salted(spark, sf_dir):
    out = O.match_configs(page_objects(spark, sf_dir), O.config_table(spark, CONFIGS), small=False)
    return out.select("page_id", "dataset", "file_type", _fields_text(F.col("path_fields")).alias("fields"))


@query(PATHS_SQL)
def path_fields_many_configs(spark, sf_dir):
    """Ten thousand configs of one bucket, most of whose prefixes no object has."""
    others = [O.ObjectConfig(f"other{i}", "raw-bucket", f"raw/{'d' * (i % 9)}{i}/", "{lang}/<host>") for i in range(10_000)]
    out = O.match_configs(page_objects(spark, sf_dir), O.config_table(spark, [*others, *CONFIGS]))
    return out.select("page_id", "dataset", "file_type", _fields_text(F.col("path_fields")).alias("fields"))


@query(f"""
WITH {URL_SQL},
o AS (SELECT page_id, CASE page_id % 4 WHEN 2 THEN 'logs-bucket' ELSE 'raw-bucket' END AS bucket,
  CASE page_id % 4 WHEN 0 THEN 'raw/lang=' || lang || '/' || host || '/' || num || '.json'
    WHEN 1 THEN 'raw/any=' || lang || '/x/' || num || '.json'
    WHEN 2 THEN 'logs/' || host || '/day=' || num || '/part 0+1.json' ELSE 'other/' || host END AS k FROM urls)
SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'S3_TRIGGER' WHEN 1 THEN 'S3_TRIGGER' WHEN 2 THEN 'SNS_S3_TRIGGER'
    WHEN 3 THEN 'GCS_TRIGGER' ELSE 'UNSUPPORTED' END AS event_source,
  CASE WHEN page_id % 5 < 4 THEN bucket END AS bucket,
  CASE WHEN page_id % 5 = 4 THEN NULL ELSE k || s END AS object_key
FROM o, (VALUES (''), ('.copy')) t(s) WHERE s = '' OR page_id % 5 IN (1, 2)
""")
def notifications(spark, sf_dir):
    objects = page_objects(spark, sf_dir)
    encoded = F.url_encode("object_key")

    def record(key):
        return F.struct(
            F.struct(
                F.struct(F.col("bucket").alias("name")).alias("bucket"), F.struct(key.alias("key")).alias("object")
            ).alias("s3")
        )

    one = F.array(record(encoded))
    two = F.array(record(encoded), record(F.concat(encoded, F.lit(".copy"))))
    inner = F.to_json(F.struct(two.alias("Records")))
    kind = F.col("page_id") % 5
    payload = (
        F.when(kind == 0, F.to_json(F.struct(one.alias("Records"))))
        .when(kind == 1, F.to_json(F.struct(F.struct(two.alias("Records")).alias("requestPayload"))))
        .when(kind == 2, F.to_json(F.struct(
            F.array(F.struct(F.struct(inner.alias("Message")).alias("Sns"))).alias("Records"))))
        .when(kind == 3, F.to_json(F.struct(F.struct("bucket", F.col("object_key").alias("name")).alias("data"))))
        .otherwise(F.lit('{"unexpected": 1}'))
    )
    events = objects.select("page_id", payload.alias("payload"))
    return arrived_objects(events).select("page_id", "event_source", "bucket", "object_key")


@query("""
SELECT conv_id, arg_max(role, turn) AS role, arg_max(text, turn) FILTER (WHERE turn % 3 = 0) AS note,
  max(turn) AS turn
FROM conversations GROUP BY 1
""")
def record_merge(spark, sf_dir):
    note = F.when(F.col("turn") % 3 == 0, F.col("text"))
    lines = table(spark, sf_dir, "conversations").select(
        "conv_id", F.col("turn").alias("line"), F.to_json(F.struct("role", note.alias("note"), "turn")).alias("record")
    )
    return merge_records(lines, "record", "line", "role string, note string, turn bigint", ["conv_id"])


@query("""
WITH l AS (SELECT lang, source, count(*) AS records FROM documents GROUP BY ALL)
SELECT lang AS "partition.lang", source AS "object.lang", records FROM l
""")
def path_clash_columns(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("source").alias("lang"), F.col("lang").alias("_path_lang"))
    out = C.add_path_fields(rows, {"lang": F.col("_path_lang")})
    keys = [C.resolve_name(n, rows.columns, ["lang"]) for n in ("lang", "object.lang")]
    return out.groupBy(*[f"`{k}`" for k in keys]).agg(F.count(F.lit(1)).alias("records"))


@query("""
SELECT event_type, CASE WHEN event_type = 'view' THEN 'event_type,k' ELSE 'k' END AS names, count(*) AS records
FROM events GROUP BY 1, 2
""")
def common_columns(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    wide = F.regexp_replace("props", "}$", ', "event_type": 1}')
    record = F.when(F.col("event_type") == "view", wide).otherwise(F.col("props"))
    path = C.common_names(["day", "event_type", "k"], [*rows.columns, "k"])
    names = F.array_join(C.common_fields(record, path), ",").alias("names")
    return rows.groupBy("event_type", names).agg(F.count(F.lit(1)).alias("records"))


@query("""
SELECT role, count(*) AS _indicator_1, max(turn) AS _indicator_2, round(avg(notes), 6) AS _indicator_3
FROM (SELECT conv_id, arg_max(role, turn) AS role, max(turn) AS turn,
    CASE WHEN arg_max(text, turn) FILTER (WHERE turn % 3 = 0) IS NULL THEN 0 ELSE 1 END AS notes
  FROM conversations GROUP BY 1)
GROUP BY 1
""")
def record_indicators(spark, sf_dir):
    note = F.when(F.col("turn") % 3 == 0, F.col("text"))
    lines = table(spark, sf_dir, "conversations").select(
        "conv_id", F.col("turn").alias("line"), F.to_json(F.struct("role", note.alias("note"), "turn")).alias("record")
    )
    records = merge_records(lines, "record", "line", "role string, note string, turn bigint", ["conv_id"])
    noted = "AVG(CASE WHEN note IS NULL THEN 0 ELSE 1 END)"
    result = indicator_query(records, [("COUNT(*)", 1), ("MAX(turn)", 2), (noted, 3)], "role")
    return result.withColumn("_indicator_3", F.round("_indicator_3", 6))

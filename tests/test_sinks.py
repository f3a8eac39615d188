import datetime as dt

from pyspark.sql import functions as F

from dqspark.operators import indicators as I
from dqspark.operators.profile import profile
from dqspark.plans.bounds import is_bounded
from dqspark.plans.storage import cut_lineage, scratch_path, stored
from dqspark.sinks import metrics as K

AT = dt.datetime(2024, 2, 3, 4, 5, tzinfo=dt.timezone.utc)


def family(query, calcs):
    return I.Family("key", 3, 1, query, "g", "", "t", 100, calcs, [100, 200])


def test_families_and_statuses(spark, tmp_path):
    spark.createDataFrame([("a", 5), ("b", 150)], "g string, t bigint").createOrReplaceTempView("sink_data")
    good = family("SELECT * FROM sink_data", [("COUNT(*)", 1), ("COUNT(DISTINCT t)", 2)])
    bad = family("SELECT * FROM sink_data", [("SUM(raise_error('broken'))", 9)])
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    worse = family("SELECT FROM WHERE", [("COUNT(*)", 8)])
    K.write_families(spark, [worse, bad, good], out, log, "src", "exact", ingested=AT)
    back = spark.read.parquet(out)
    assert {(r["g"], r["_indicator_1"], r["_lookback_range_end_ts"]) for r in back.collect()} == {("a", 1, 100), ("b", 1, 200)}
    assert tuple(back.select("org_id", "source_id", "compute_hash", "year", "minute").first()) == (3, "src", "key", 2024, 5)
    status = {(r["indicator_id"], r["evaluation_time"]): r["meta"] for r in spark.read.parquet(log).collect()}
    assert status[1, 100_000] == {} and "broken" in status[9, 200_000]["error"] and len(status) == 8
    assert "error" in status[8, 100_000]


def test_a_run_that_is_repeated_is_written_once(spark, tmp_path):
    spark.createDataFrame([("a", 5), ("b", 150), ("b", None)], "g string, t bigint").createOrReplaceTempView("run_data")
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    good = family("SELECT * FROM run_data", [("COUNT(*)", 1)])
    bad = family("SELECT * FROM run_data", [("SUM(raise_error('broken'))", 1)])
    for families in ([bad], [good], [good]):
        K.write_families(spark, families, out, log, "src", run_id="r1")
    K.write_families(spark, [good], out, log, "src", run_id="r2")
    assert sorted((r["run_id"], r["g"], r["_indicator_1"]) for r in spark.read.parquet(out).collect()) == [
        ("r1", "a", 1), ("r1", "b", 1), ("r2", "a", 1), ("r2", "b", 1),
    ]
    rows = spark.read.parquet(log).collect()
    assert len(rows) == 4 and all(r["meta"] == {} for r in rows)


def test_statuses_of_many_times_are_made_by_tasks(spark):
    many = I.Family("key", 3, 1, "", "g", "", "t", 100, [("COUNT(*)", i) for i in range(40)], list(range(500)))
    rows = K.family_statuses(spark, many)
    assert rows.count() == 20_000 and rows.filter("indicator_id = 39 and evaluation_time = 499").count() == 1


def test_rows_without_range_are_left_out(spark, tmp_path):
    df = spark.createDataFrame([(1, 5, 6), (2, None, 6)], "v int, _result_min_ts int, _result_max_ts int")
    K.write_metrics(df, str(tmp_path / "m"), {"a": 1}, AT)
    assert spark.read.parquet(str(tmp_path / "m")).count() == 1


def test_run_log_and_dimensions(spark, rows):
    df = spark.createDataFrame([("o1", "a", 5), ("o1", "b", 9), ("o2", "a", 7)], "object string, k string, t bigint")
    spec = {"t": {"column": "t", "format": "unixtime", "primary": True}}
    result = profile(df, ["k"], timestamps=spec, by=["object"], keyed=False)
    objects = spark.createDataFrame([("o1", "{}"), ("o3", "{}")], "object string, input_event string")
    log = K.run_log(result.metrics, result.times.primary, objects, ["object"], schema="s")
    got = {r["object"]: (r["min_primary_time"], r["max_primary_time"], r["schema"]) for r in log.collect()}
    assert got == {"o1": (5, 9, "s"), "o3": (None, None, "s")}
    assert K.run_log(result.metrics, result.times.primary).first()["max_primary_time"] == 9
    assert rows(K.run_dimensions(result.metrics, ["k"], ["object"])) == [("o1", "k", "a"), ("o1", "k", "b"), ("o2", "k", "a")]


def test_tags_table(spark, tmp_path):
    path = str(tmp_path / "tags")
    K.write_tags(spark.createDataFrame([(1, ["a:b"]), (2, ["c:d"])], "indicator_id bigint, tags array<string>"), path)
    assert K.read_tags(spark, path).count() == 2
    assert K.read_tags(spark, path, [2]).first()["tags"] == ["c:d"]
    assert K.read_tags(spark, path, spark.sql("SELECT 1L AS indicator_id")).first()["tags"] == ["a:b"]


def test_catalog_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not K.table_exists(spark, "sink_t")
    spark.createDataFrame([(1, "x"), (2, "y")], "v int, p string").write.partitionBy("p").parquet(path)
    K.register_table(spark, "sink_t", "v int, p string", path, ["p"])
    K.register_table(spark, "sink_t", "v int, p string", path, ["p"])
    assert K.table_exists(spark, "sink_t")
    K.add_partition(spark, "sink_t", {"p": "x"})
    K.add_partition(spark, "sink_t", {"p": "x"})
    assert [tuple(r) for r in spark.table("sink_t").collect()] == [(1, "x")]
    K.discover_partitions(spark, "sink_t")
    assert spark.table("sink_t").count() == 2
    spark.sql("DROP TABLE sink_t")


def test_storage_and_bounds(spark):
    df = spark.range(100).withColumn("a|b", F.col("id") * 2)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert cut_lineage(df).count() == stored(df, "t").count() == 100
    assert is_bounded(df, max_rows=100) and not is_bounded(df, max_rows=99)
    assert not is_bounded(df, F.lit(10), max_bytes=999) and is_bounded(df, F.lit(10), max_bytes=1000)
    assert is_bounded(df.filter("false"))

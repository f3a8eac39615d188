"""Notifications to profiles and run logs; records of many lines; lines in quotes."""

import json
import random

import pytest
from pyspark.sql import functions as F

from dqspark.operators.datasets import Dataset, object_records
from dqspark.sources.objects import inspect_objects
from dqspark.sources.readers import read_dataset, sampled_text_schema
from dqspark.sources.records import LINE, POSITION, object_lines
from dqspark.streaming.notified import NotifiedDataset, existing_paths, profile_notifications, profile_notified

WEB = Dataset("web", "in/web", "{day}", "parquet", numbers=["v"], timestamps={"t": {"column": "t", "primary": True, "format": "unixtime"}}, dimensions=["day"])
APP = Dataset("app", "in/app", "<kind>/{*}", "jsonl", numbers=["v"], schema="v double", dimensions=["kind"])
DATASETS = [NotifiedDataset("b", WEB), NotifiedDataset("b", APP)]


def message(*keys, bucket="b"):
    return json.dumps({"Records": [{"s3": {"bucket": {"name": bucket}, "object": {"key": k}}} for k in keys]})


@pytest.fixture
def lake(spark, tmp_path):
    root = tmp_path / "lake"
    frame = spark.createDataFrame([(1.0, 100), (2.0, 200)], "v double, t long").coalesce(1)
    for folder in ("day=1", "day=2"):
        frame.write.parquet(str(root / "in/web" / folder))
    wider = frame.withColumn("extra", F.lit("x"))
    wider.write.parquet(str(root / "in/web/day=3"))
    (root / "in/web/day=4").mkdir(parents=True)
    (root / "in/web/day=4/broken.parquet").write_bytes(b"PAR1 nothing PAR1")
    (root / "in/app/a b/k=1").mkdir(parents=True)
    (root / "in/app/a b/k=1/x[1]{y}.json").write_text('{"v": 5}\n{"v": 6}\n')
    (root / "in/app/a b/k=1/none.json").write_text("")
    return root


def keys_of(lake):
    return sorted(str(p.relative_to(lake)) for p in lake.rglob("*") if p.is_file() and p.name[0] not in "._")


def test_every_object_is_logged_and_isolated(spark, lake):
    keys = [*keys_of(lake), "in/web/day=9/gone.parquet", "other/x.parquet", "in/web/deep/day=1/x.parquet"]
    rows = spark.createDataFrame([(message(*keys),), (message(keys[0]),), (message("in/web/day=1/x", bucket="c"),), ("junk",)], "payload string")
    for size in (1, 10_000):
        run = profile_notifications(rows, DATASETS, lambda b: str(lake), 7, paths_per_read=size)
        log = {r["object_key"]: r for r in run.log.collect()}
        assert set(log) == {k for k in keys if k not in ("other/x.parquet", "in/web/deep/day=1/x.parquet")}
        good = [r for k, r in log.items() if "web" in k and r["error"] is None]
        assert {(r["total_record_count"], r["min_primary_time"], r["max_primary_time"]) for r in good} == {(2, 200, 200)}
        assert {r["schema"] for r in good} == {"struct<v:double,t:bigint>", "struct<v:double,t:bigint,extra:string>"}
        gone, broken = log["in/web/day=9/gone.parquet"], log["in/web/day=4/broken.parquet"]
        assert "not found" in gone["error"] and gone["max_primary_time"] is None and gone["size"] is None
        assert "Arrow" in broken["error"] and broken["total_record_count"] == 0 and broken["size"] == 17
        app = {k: r for k, r in log.items() if "app" in k}
        assert {(r["total_record_count"], r["error"]) for r in app.values()} == {(2, None), (0, None)}
        assert run.metrics["web"].count() == 3 and run.metrics["app"].count() == 1


def test_no_readable_object(spark, lake):
    rows = spark.createDataFrame([(message("in/web/day=4/broken.parquet", "in/web/day=9/gone.parquet"),)], "payload string")
    run = profile_notifications(rows, DATASETS, lambda b: str(lake))
    assert run.metrics == {} and run.log.filter("error is not null").count() == 2
    assert profile_notifications(rows.limit(0), DATASETS, lambda b: str(lake)).log is None


def test_batches_are_written_once(spark, lake, tmp_path):
    messages = tmp_path / "messages"
    spark.createDataFrame([(message(*keys_of(lake)),)], "value string").write.text(str(messages))
    for attempt in range(2):  # a state that is lost makes the batch run again
        stream = spark.readStream.text(str(messages)).withColumnRenamed("value", "payload")
        query = profile_notified(stream, DATASETS, lambda b: str(lake), str(tmp_path / "out"), str(tmp_path / f"state{attempt}"))
        assert query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out/metrics/web")).count() == 3
    assert spark.read.parquet(str(tmp_path / "out/log")).count() == len(keys_of(lake))


def test_missing_paths_are_found_by_halves(spark, lake):
    good = [str(lake / k) for k in keys_of(lake) if "web" in k and "broken" not in k]
    bad = [f"{lake}/none{i}" for i in range(5)]
    frame, absent = existing_paths(spark, [bad[0], good[0], *bad[1:4], *good[1:], bad[4]], lambda some: spark.read.parquet(*some))
    assert sorted(absent) == bad and frame.count() == 2 * len(good)
    assert existing_paths(spark, bad[:1], lambda some: spark.read.parquet(*some)) == (None, bad[:1])


def test_inspected_objects(spark, lake):
    paths = spark.createDataFrame([(str(lake / k),) for k in keys_of(lake)] + [("nostore://x/y",)], "path string")
    rows = {r["path"].rsplit("/", 1)[1]: r for r in inspect_objects(paths, "parquet").collect()}
    assert rows["broken.parquet"]["broken"] and rows["y"]["error"] and not rows["y"]["broken"]


def test_records_of_objects_in_many_splits(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    want = {}
    for day in ("1", "2"):
        folder = tmp_path / f"recs/day={day}"
        folder.mkdir(parents=True)
        record, lines = {}, []
        for i in range(3000):
            line = {k: rng.choice([None, i]) for k in ("a", "b", "c") if rng.random() < 0.02}
            record |= line
            lines.append(json.dumps(line) + (" " * rng.randint(0, 40)))
        lines[100:100] = ["", "no json", "[1]"]
        (folder / "part.json").write_text("\n".join(lines))
        want[day] = tuple(record.get(k) for k in ("a", "b", "c"))
    dataset = Dataset("recs", "recs", "{day}", "jsonl", schema="a long, b long, c long")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = object_lines(spark, str(tmp_path / "recs"))
        assert lines.select(F.col(f"{POSITION}.split")).distinct().count() > 10
        ordered = [r[LINE] for r in lines.filter(F.col("object").contains("day=1")).orderBy(POSITION).collect()]
        text = (tmp_path / "recs/day=1/part.json").read_text().split("\n")
        assert ordered == [t for t in text if t.strip()]
        got = object_records(spark, str(tmp_path), dataset).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {r["day"]: (r["a"], r["b"], r["c"]) for r in got} == want


def test_line_breaks_in_quotes(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('k,t,n\n1,plain,1\n2,"two\nlines, and ""more""",2\n3,short\n4,a,4,c\n5,last,5\n')
    want = [(1, "plain", 1), (2, 'two\nlines, and "more"', 2), (3, "short", None), (5, "last", 5)]
    for schema in (None, "k int, t string, n int"):
        rows = read_dataset(spark, str(path), "csv", schema)
        assert sorted(tuple(r) for r in rows.collect()) == want
    assert sampled_text_schema(spark, str(path), "csv", None).simpleString() == "struct<k:int,t:string,n:int>"

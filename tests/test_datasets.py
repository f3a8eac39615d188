import json

from pyspark.sql import functions as F

from dqspark.operators.datasets import Dataset, profile_arrivals, profile_dataset, with_path_columns
from dqspark.operators.profile import finish


def write(root, path, records):
    target = root / path
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text("\n".join(map(json.dumps, records)))


DATASET = Dataset(
    "d", "raw", "{day}/<kind>", "jsonl", strings=["s"], numbers=["n"], dimensions=["kind", "object.kind", "day"],
    schema="kind string, s string, n string",
)


def test_objects_with_path_fields(spark, tmp_path):
    write(tmp_path, "raw/day=1/a/x.json", [{"kind": "in", "s": "p", "n": "1"}, {"kind": "in", "n": "z"}])
    write(tmp_path, "raw/day=2/b/y.json", [{"kind": "in", "s": "q", "n": "5"}])
    write(tmp_path, "raw/nothing/c/z.json", [{"kind": "in", "s": "q", "n": "7"}])
    found = profile_dataset(spark, str(tmp_path), DATASET, source_id="s", execution_time=3)
    assert found.dimensions == ["partition.kind", "object.kind", "day"]
    total = next(c for c in found.metrics.columns if c.startswith("sum|n|"))
    got = sorted(
        (r["object"].rsplit("/", 1)[1], r["partition.kind"], r["object.kind"], r["day"], r[total], r["total_group_count"])
        for r in found.metrics.collect()
    )
    assert got == [("x.json", "a", "in", "1", 1.0, 2), ("y.json", "b", "in", "2", 5.0, 1)]
    out = finish(found, by=["object"])
    assert {r["total_record_count"] for r in out.collect()} == {1, 2} and "dim|day" in out.columns
    stream = profile_arrivals(
        spark, str(tmp_path), DATASET, str(tmp_path / "out"), str(tmp_path / "state"), source_id="s", execution_time=3
    )
    assert stream.awaitTermination(120)
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert stored.agg(F.sum("total_group_count")).first()[0] == 3


def test_unnamed_path_fields_stay_in_a_map(spark):
    rows = spark.createDataFrame([("file:/base/raw/a=1/b=2/f", 1)], "object string, v int")
    out, names = with_path_columns(rows, "file:///base", Dataset("d", "raw", "{*}/{*}", "csv"))
    assert names == [] and out.first()["path_fields"] == {"a": "1", "b": "2"}
    bucket = spark.createDataFrame([("s3a://bucket/raw/7/f", 1)], "object string, v int")
    out, names = with_path_columns(bucket, "s3a://bucket", Dataset("d", "raw", "<n>", "csv"))
    assert names == ["n"] and out.first()["n"] == "7"


def test_values_and_roots_with_signs(spark, tmp_path):
    from pyspark.sql import functions as F

    from dqspark.operators.datasets import OBJECT, Dataset, with_path_columns
    from dqspark.sources.readers import read_dataset

    root = tmp_path / "my root"
    names = ["New York", "a%b", "c+d", "e"]
    spark.createDataFrame([(n, i) for i, n in enumerate(names)], "city string, v int").write.partitionBy("city").parquet(str(root / "set"))
    rows = read_dataset(spark, str(root / "set"), "parquet", "v int", recursive=True)
    dataset = Dataset(name="d", prefix="set", suffix_template="{city}", file_type="parquet", schema="v int")
    got, _ = with_path_columns(rows.withColumn(OBJECT, F.col("_metadata.file_path")), str(root), dataset)
    assert {r["v"]: r["city"] for r in got.collect()} == dict(enumerate(names))


def events_folder(spark, folder, n, parts):
    path = str(folder / "events.parquet")
    time = "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(id % 3 as int)) AS ts"
    kind, value = "if(id % 2 = 0, 'a', 'b') AS event_type", "cast(id AS double) AS value"
    rows = spark.range(0, n, 1, parts).selectExpr("id AS event_id", time, "id % 4 AS user_id", kind, value, "'{}' AS props")
    rows.write.parquet(path)
    return str(folder)


def test_dataset_is_written_by_folder(spark, tmp_path):
    """Files are as many as folders and tasks at most, however many parts the table has."""
    from pathlib import Path

    from workloads.stored import _write_dataset

    root = _write_dataset(spark, events_folder(spark, tmp_path, 240, 12))
    files = list(Path(root).rglob("part-*"))
    assert len({f.parent for f in files}) == 6
    assert len(files) <= 6 + int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_small_splits_share_tasks(spark, tmp_path, monkeypatch):
    """Objects are read in splits of 16 KB, but a task takes several; the last line of each key still wins."""
    from workloads import stored

    monkeypatch.setattr(stored, "SPLIT_TASKS", "6")
    source, settings = events_folder(spark, tmp_path, 12_000, 2), ["spark.sql.files.maxPartitionBytes", "spark.sql.files.maxPartitionNum"]
    before, context = [spark.conf.get(k, None) for k in settings], spark.sparkContext
    context.setJobGroup("splits", "small splits")
    try:
        found = stored._records(spark, source)
        tracker = context.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup("splits") for s in tracker.getJobInfo(j).stageIds]
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert max(tracker.getStageInfo(s).numTasks for s in stages if tracker.getStageInfo(s)) <= 12
    assert [spark.conf.get(k, None) for k in settings] == before
    got = {(r["event_type"], r["partition.shard"]): (r["event_id"], r["user_id"], r["value"], r["props"]) for r in found.collect()}
    assert got == {("a", "0"): (11998, 2, 11994.0, None), ("b", "1"): (11999, None, 11997.0, "p11995")}

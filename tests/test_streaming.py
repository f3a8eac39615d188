import datetime as dt
import json

from pyspark.sql import functions as F

from dqspark.operators.profile import profile
from dqspark.operators.rollup import rollup_metrics
from dqspark.streaming.objects import freshness_stream, object_stream, profile_stream
from dqspark.streaming.windows import append_stream, lookback_stream

SCHEMA = "t timestamp, k string, v double"
DAY = dt.datetime(2024, 1, 1)


def arrive(folder, name, rows):
    lines = [json.dumps({"t": t.isoformat(), "k": k, "v": v}) for t, k, v in rows]
    (folder / name).write_text("\n".join(lines))


def done(query):
    assert query.awaitTermination(120)


def test_objects_are_profiled_once(spark, tmp_path):
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()
    settings = {"dimensions": ["k"], "numbers": ["v"], "keyed": False, "mergeable": True}
    first = [(DAY, "a", 1.0), (DAY, "b", 2.0)]
    second = [(DAY, "a", 3.0), (DAY, None, 4.0)]
    arrive(source, "1.jsonl", first)
    done(profile_stream(object_stream(spark, str(source), "jsonl", SCHEMA), out, state, settings))
    arrive(source, "2.jsonl", second)
    done(profile_stream(object_stream(spark, str(source), "jsonl", SCHEMA), out, state, settings))
    done(profile_stream(object_stream(spark, str(source), "jsonl", SCHEMA), out, state, settings))
    stored = spark.read.parquet(out)
    assert {r[0].rsplit("/", 1)[1] for r in stored.select("object").distinct().collect()} == {"1.jsonl", "2.jsonl"}
    rolled = rollup_metrics(stored.drop("object", "batch_id"), ["k"], ["execution_time"])
    direct = profile(spark.createDataFrame(first + second, SCHEMA), ["k"], numbers=["v"], keyed=False, mergeable=True).metrics

    def pick(df):
        ordered = df.select(*[f"`{c}`" for c in sorted(direct.columns)]).collect()
        return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in ordered), key=str)

    assert pick(rolled) == pick(direct)


def test_closed_windows_and_late_rows(spark, tmp_path):
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()

    def run():
        rows = object_stream(spark, str(source), "jsonl", SCHEMA)
        result = lookback_stream(rows, [("COUNT(*)", 1), ("COUNT(DISTINCT k)", 2)], "t", 600, 300, 60, filters="v > 0")
        done(append_stream(result, out, state))
        return spark.read.schema(result.schema).parquet(out)

    minute = dt.timedelta(minutes=1)
    arrive(source, "1.jsonl", [(DAY + i * minute, "ab"[i % 2], 1.0) for i in range(12)] + [(DAY, "c", -1.0)])
    base = int(DAY.replace(tzinfo=dt.timezone.utc).timestamp())
    got = {r["_lookback_range_end_ts"] - base: (r["_indicator_1"]) for r in run().collect()}
    assert got == {300: 5, 600: 10}
    # A row later than the lag does not reopen a window that came out.
    arrive(source, "2.jsonl", [(DAY, "late", 1.0), (DAY + 30 * minute, "z", 1.0)])
    got = {r["_lookback_range_end_ts"] - base: (r["_indicator_1"]) for r in run().collect()}
    assert got[300] == 5 and got[600] == 10 and got[900] == 7
    estimates = run().select("_lookback_range_end_ts", F.hll_sketch_estimate("_indicator_2")).collect()
    assert {r[1] for r in estimates if r[0] - base in (300, 600, 900)} == {2}


def test_windows_from_panes(spark, tmp_path):
    """A look-back of four intervals: counts, sums and means come from the panes, and the mean by rows, not by panes."""
    source = tmp_path / "in"
    source.mkdir()
    minute = dt.timedelta(minutes=1)
    arrive(source, "1.jsonl", [(DAY, "a", 1.0), (DAY, "a", 2.0), (DAY + 6 * minute, "a", 6.0), (DAY + 40 * minute, "b", None)])
    rows = object_stream(spark, str(source), "jsonl", SCHEMA)
    calculations = [("COUNT(*)", 1), ("SUM(v)", 2), ("AVG(v)", 3), ("COUNT(v)", 4)]
    result = lookback_stream(rows, calculations, "t", 1200, 300, 60, "k")
    done(append_stream(result, str(tmp_path / "out"), str(tmp_path / "state")))
    base = int(DAY.replace(tzinfo=dt.timezone.utc).timestamp())
    stored = spark.read.schema(result.schema).parquet(str(tmp_path / "out"))
    got = {r["_lookback_range_end_ts"] - base: tuple(r[f"_indicator_{i}"] for _, i in calculations) for r in stored.collect()}
    whole = (3, 9.0, 3.0, 3)
    assert got == {300: (2, 3.0, 1.5, 2), 600: whole, 900: whole, 1200: whole, 1500: (1, 6.0, 6.0, 1)}


def test_freshness_of_batches(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    arrive(source, "1.jsonl", [(DAY, "a", 1.0), (DAY - dt.timedelta(days=2), "a", 1.0), (DAY + dt.timedelta(hours=2), "a", 1.0)])
    now = int(DAY.replace(tzinfo=dt.timezone.utc).timestamp())
    rows = object_stream(spark, str(source), "jsonl", SCHEMA)
    done(freshness_stream(rows, "t", out, str(tmp_path / "state"), now, ("k",)))
    got = {r["freshness"]: r["records"] for r in spark.read.parquet(out).collect()}
    assert got == {"0-5min": 1, ">24h": 1, "future: >1 hour": 1}
    done(freshness_stream(object_stream(spark, str(source), "jsonl", SCHEMA), "t", str(tmp_path / "o2"), str(tmp_path / "s2")))
    assert spark.read.parquet(str(tmp_path / "o2")).agg(F.sum("records")).first()[0] == 3


def test_csv_objects_follow_the_batch_rules(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "1.csv").write_text("k,v\na,1\na\nb,2,extra\nb,3\n")
    rows = object_stream(spark, str(source), "csv", "k string, v double")
    done(profile_stream(rows, out, str(tmp_path / "state"), {"dimensions": ["k"], "numbers": ["v"], "keyed": False}))
    got = {r["k"]: (r["total_group_count"], r["sum|v"]) for r in spark.read.parquet(out).collect()}
    assert got == {"a": (2, 1.0), "b": (1, 3.0)}

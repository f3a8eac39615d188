import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from dqspark.operators.profile import (
    add_record_counts, dimension_values, drop_unparseable, finish, merge_metrics, profile, time_range,
)
from dqspark.operators.rollup import concat_results, rolling_rollup, rollup_metrics


def sample(spark):
    return spark.createDataFrame(
        [
            ("a", " 1 ", "x", 1.0), (" a", "2", None, None), ("", "bad", "y", 4.0), (None, None, "z", float("nan")),
            ("b", "", "w", 9.0),
        ],
        "k string, n string, s string, v double",
    )


def by_key(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_grouped_profile(spark):
    got = by_key(profile(sample(spark), ["k"], strings=["s"], numbers=["n", "v"], keyed=False).metrics, "k")
    assert set(got) == {"a", "b", "<empty>"}
    a, e = got["a"], got["<empty>"]
    assert (a["count|n"], a["sum|n"], a["max|n"], a["min|n"], a["mean|n"]) == (2, 3.0, 2.0, 1.0, 1.5)
    assert math.isclose(a["std|n"], statistics.stdev([1, 2]))
    assert (a["count|s"], a["null_count|s"], a["total_group_count"]) == (1, 1, 2)
    assert (e["count|n"], e["sum|n"], e["null_count|n"], e["mean|n"], e["std|n"]) == (0, 0.0, 2, None, None)
    assert (e["count|v"], e["null_count|v"], e["std|v"]) == (1, 1, None)


def test_ungrouped_and_empty(spark):
    df = sample(spark)
    row = profile(df, strings=["s"], numbers=["v"], keyed=False).metrics.first()
    assert row["total_group_count"] == 5 and row["count|v"] == 3
    none = profile(df.filter("false"), strings=["s"], numbers=["v"], keyed=False).metrics.first()
    assert none["total_group_count"] == 0 and none["sum|v"] == 0.0 and none["mean|v"] is None


def test_missing_dimensions(spark, caplog):
    df = sample(spark)
    some = profile(df, ["k", "zz"], strings=["s", "yy"], keyed=False)
    assert some.dimensions == ["k"] and some.metrics.count() == 3
    none = profile(df, ["zz"], strings=["s"], keyed=False)
    assert none.metrics.count() == 0
    assert "zz" in caplog.text and "yy" in caplog.text


def test_drop_unparseable(spark):
    df = spark.createDataFrame([("a", "x", "1"), ("b", "y", "z")], "k string, dead string, live string")
    for keyed in (True, False):
        result = profile(df, ["k"], numbers=["dead", "live"], keyed=keyed).metrics
        names = drop_unparseable(result, ["dead", "live"]).columns
        assert not any("|dead" in n for n in names) and any(n.startswith("sum|live") for n in names)


def test_finish_adds_roles_and_totals(spark):
    out = finish(profile(sample(spark), ["k"], strings=["s"], execution_time=9, source_id="x", dataset="d"), "b", "o", 9)
    row = out.first()
    assert row["total_record_count"] == 5 and row["bucket"] == "b" and row["object"] == "o"
    assert {"dim|k", "primary_time|execution_time", "execution_time"} <= set(out.columns)


def test_record_counts_per_object(spark):
    df = sample(spark).withColumn("object", F.when(F.col("v") > 3, "o1").otherwise("o2"))
    metrics = profile(df, ["k"], strings=["s"], by=["object"], keyed=False).metrics
    got = {(r["object"], r["total_record_count"]) for r in add_record_counts(metrics, ["object"]).collect()}
    assert {o for o, _ in got} == {"o1", "o2"} and sum(n for _, n in got) == 5


def test_freshness_is_a_dimension(spark):
    df = spark.createDataFrame([(0, 1.0), (600, 2.0), (None, 3.0)], "t bigint, v double")
    spec = {"t": {"column": "t", "format": "unixtime", "freshness": True}}
    got = by_key(profile(df, numbers=["v"], timestamps=spec, execution_time=660, keyed=False).metrics, "t_freshness")
    assert {k: v["sum|v"] for k, v in got.items()} == {"10-20min": 1.0, "0-5min": 2.0, "<empty>": 3.0}
    assert got["<empty>"]["min_t"] is None


def test_one_scan_and_one_shuffle(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    metrics = profile(df, ["l_returnflag"], strings=["l_linestatus"], numbers=["l_tax"], keyed=False).metrics
    plan = metrics._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    assert "l_comment" not in plan and "l_extendedprice" not in plan


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(5)
    data = [
        (f"d{i % 7}", rng.choice(["a", "b"]), None if rng.random() < 0.1 else 1e6 + rng.gauss(0, 1), i)
        for i in range(400)
    ]
    return spark.createDataFrame(data, "day string, k string, v double, t bigint").cache()


@pytest.mark.parametrize("dims", [[], ["k"], ["day"]])
def test_rollup_equals_direct(spark, values, dims):
    spec = {"t": {"column": "t", "format": "unixtime"}}
    fine = profile(values, ["day", "k"], ["k"] if dims == ["day"] else [], ["v"], spec, keyed=False, mergeable=True)
    rolled = rollup_metrics(fine.metrics, dims, fine.times.names)
    direct = profile(values, dims, ["k"] if dims == ["day"] else [], ["v"], spec, keyed=False, mergeable=True).metrics
    assert set(rolled.columns) == set(direct.columns)
    key = dims[0] if dims else "total_group_count"
    a, b = by_key(rolled, key), by_key(direct, key)
    assert set(a) == set(b)
    for k in a:
        for name, value in b[k].items():
            assert a[k][name] == (value if isinstance(value, str) else pytest.approx(value, rel=1e-9)), name


def test_rollup_without_moments_has_no_std(spark, values):
    fine = profile(values, ["day", "k"], numbers=["v"], keyed=False).metrics
    assert "std|v" not in rollup_metrics(fine, ["k"]).columns


def test_rolling_panes_equal_windows(spark, values):
    panes = values.withColumn("pane_end", (F.floor(F.col("t") / 10) + 1) * 10)
    fine = profile(panes, ["k"], numbers=["v"], by=["pane_end"], keyed=False, mergeable=True)
    rolled = rolling_rollup(fine.metrics, "pane_end", 10, 30, ["k"], fine.times.names).collect()
    data = [tuple(r) for r in values.select("t", "k", "v").collect()]
    for r in rolled:
        inside = [v for t, k, v in data if r["evaluation_time"] - 30 <= t < r["evaluation_time"] and k == r["k"]]
        known = [v for v in inside if v is not None]
        assert r["total_group_count"] == len(inside) and r["count|v"] == len(known)
        if len(known) > 1:
            assert r["std|v"] == pytest.approx(statistics.stdev(known), rel=1e-7)
    with pytest.raises(ValueError):
        rolling_rollup(fine.metrics, "pane_end", 10, 25, ["k"])


def test_merge_metrics_matches_null_keys(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a int")
    b = spark.createDataFrame([(None, 3), ("y", 4)], "k string, b int")
    assert [tuple(r) for r in merge_metrics(a, b, ["k"]).collect()] == [(None, 1, 3)]


def test_concat_fills_missing(spark, rows):
    a, b = spark.sql("SELECT 1 AS x"), spark.sql("SELECT 2 AS y")
    assert rows(concat_results([a, b])) == [(1, None), (None, 2)]


def test_dimension_values_and_range(spark, rows):
    df = sample(spark)
    assert rows(dimension_values(df, ["k"])) == [("k", "<empty>"), ("k", "a"), ("k", "b")]
    assert tuple(time_range(spark.createDataFrame([(3,), (1,)], "t bigint"), "t").first()) == (1, 3)

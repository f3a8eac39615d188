import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from dqspark.operators import indicators as I
from dqspark.operators.rollup import concat_results
from dqspark.operators.series import metric_series
from dqspark.operators.tags import indicator_statuses, indicator_tags, merge_tags
from dqspark.plans.joins import in_time_range, interval_join, windows_frame

# Filters that mean the same are in one list; lists differ from each other.
SAME_FILTERS = [
    ["l_tax > 0 AND l_quantity < 24", "l_quantity<24  and (l_tax>0);"],
    ["l_tax > 0 OR l_quantity < 24", "(l_quantity < 24) OR (l_tax > 0)"],
    ["o_orderstatus = 'F' AND (o_totalprice > 900 OR o_clerk IS NULL) AND o_orderkey <> 7",
     "(o_orderkey <> 7 AND o_orderstatus = 'F') AND (o_clerk IS NULL OR o_totalprice > 900)"],
    ["o_orderstatus = 'F' AND o_totalprice > 900 OR o_clerk IS NULL"],
    ["NOT (l_discount > 0.05 AND l_returnflag = 'R')", "NOT (l_returnflag = 'R' AND l_discount > 0.05)"],
    ["NOT l_discount > 0.05 AND l_returnflag = 'R'", "l_returnflag = 'R' AND NOT l_discount > 0.05"],
    ["p_size BETWEEN 3 AND 9 AND p_type ilike '%tin'", "p_type ilike '%tin' AND p_size BETWEEN 3 AND 9"],
    ["p_size NOT BETWEEN 3 AND 9 AND p_type ilike '%tin'"],
    ["event_type IN ('view','click') AND user_id IS NOT NULL", "user_id IS NOT NULL AND event_type IN ('view', 'click')"],
    ["event_type NOT IN ('view','click') AND user_id IS NOT NULL"],
]


def test_filter_fingerprints(spark):
    prints = [{I.filter_fingerprint(spark, f) for f in group} for group in SAME_FILTERS]
    assert all(len(p) == 1 for p in prints)
    assert len(set().union(*prints)) == len(SAME_FILTERS)
    assert I.filter_fingerprint(spark, "") == I.filter_fingerprint(spark, None) == ""


@pytest.mark.parametrize(
    "calculation, kind",
    [
        ("100.0 * COUNT(p_size)/COUNT(*)", "NONE"), ("COUNT(distinct p_container)", "COUNT_DISTINCT"),
        ("approx_percentile(p_retailprice, 0.5)", "DECILE"), (" count( DISTINCT lower(trim(a)) ) ", "COUNT_DISTINCT"),
        ("count(distinct a) + count(distinct b)", "NONE"), ("count(distinct_id)", "NONE"), ("sum(x)", "NONE"),
        ("count(distinct a) FILTER (WHERE b > 1)", "NONE"),
    ],
)
def test_sketch_class(spark, calculation, kind):
    df = spark.createDataFrame([(calculation,)], "c string")
    assert df.select(I.sketch_class(F.col("c"))).first()[0] == kind


def test_family_key_golden(spark):
    # Fixed value: a stored key.
    golden = "2_64f3a05b7a514108144be81b4e01df6dc1bd465b__3600_dd41b12a27b0065a5ae6237c90e050eeded59848"
    df = spark.sql("SELECT 2 AS d, 'test2, test1' AS g, '' AS f, 3600 AS l, '*/5 * * * *' AS i")
    key = I.family_key(*[F.col(c) for c in "dgfli"])
    assert df.select(key).first()[0] == golden == I.definition_key("test1,test2", "*/5 * * * *", 3600, 2)
    sketched = I.family_key(*[F.col(c) for c in "dgfli"], F.lit("NONE"))
    assert df.select(sketched).first()[0] == golden.replace("2_", "2_NONE_", 1)


def data(spark, kind="timestamp"):
    rows = [("a", 0, 1.0, "u"), ("a", 3600, 2.0, "v"), ("b", 3600, 4.0, "u"), ("b", 7199, 8.0, "u"), ("b", 7200, 16.0, "w")]
    df = spark.createDataFrame(rows, "g string, t bigint, v double, u string")
    return df if kind == "bigint" else df.withColumn("t", F.timestamp_seconds("t").cast(kind))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "bigint"])
def test_half_open_look_back(spark, kind):
    out = I.indicator_query(
        data(spark, kind), [("COUNT(*)", 1), ("SUM(v)", 2), ("COUNT(DISTINCT u)", 3)], "g", "t", 7200, 3600,
        "v > 3 OR g = 'a'", mode="exact",
    )
    got = {r["g"]: (r["_indicator_1"], r["_indicator_2"], r["_indicator_3"]) for r in out.collect()}
    assert got == {"a": (1, 2.0, 1), "b": (2, 12.0, 1)}
    row = out.filter("g = 'b'").first()
    assert (row["_lookback_range_start_ts"], row["_lookback_range_end_ts"]) == (3600, 7200)


def test_range_on_dates(spark):
    df = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-01-10')) AS d")
    day = 1_704_067_200
    assert df.filter(in_time_range(df, "d", day + 86400, day + 3 * 86400)).count() == 2
    assert df.filter(in_time_range(df, "d", day + 1, day + 86400 + 1)).count() == 1


def test_range_is_pushed_to_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    out = I.indicator_query(df, [("COUNT(*)", 1)], "event_type", "ts", 1_705_000_000, 3600)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan


def test_no_rows_and_requested_range(spark):
    out = I.indicator_query(data(spark), [("COUNT(*)", 1)], (), "t", 99999, 10)
    assert out.count() == 1 and I.observed_only(out).count() == 0
    asked = I.indicator_query(data(spark), [("COUNT(*)", 1)], (), "t", 7200, 7200, time_range="requested").first()
    assert (asked["_result_min_ts"], asked["_result_max_ts"]) == (0, 7200)


def test_modes(spark):
    df = spark.range(1000).select((F.col("id") % 50).alias("u"), F.col("id").cast("string").alias("v"))
    row = df.agg(
        I.calculation_column("count(distinct u)", "exact"), I.calculation_column("count(distinct u)", "approx"),
        I.calculation_column("approx_percentile(CAST(v AS double), 0.5)", "exact"),
        I.calculation_column("approx_percentile(CAST(v AS double), 0.5)", "approx"),
        I.calculation_column("stddev(v)"), I.calculation_column("count(distinct u)", "plain"),
    ).first()
    assert row[0] == 50 and abs(row[1] - 50) < 5 and row[2] == 499.5 and abs(row[3] - 499.5) < 5
    assert row[4] == pytest.approx(288.8194, abs=1e-3) and row[5] == 50
    with pytest.raises(ValueError):
        I.calculation_column("count(*)", "other")


@pytest.mark.parametrize("small", [True, False, None])
def test_interval_join_against_brute_force(spark, small):
    rows = [(i, (i * 7919) % 5000) for i in range(300)] + [(1000 + i, 2500) for i in range(150)]
    df = spark.createDataFrame(rows, "id bigint, t bigint")
    times, lookback = [0, 100, 999, 1000, 2500, 2501, 5000, 9000], 700
    out = interval_join(df, windows_frame(spark, times, lookback), "t", lookback, small)
    got = sorted((r["id"], r["_window_end"]) for r in out.collect())
    assert got == sorted((i, e) for i, t in rows for e in times if e - lookback <= t < e)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_series_equals_single_queries(spark):
    df, times = data(spark), [3600, 7200, 7201, 10800]
    calcs = [("COUNT(*)", 1), ("MAX(v)", 2)]
    many = I.indicator_series(df, calcs, times, 3600, "t", "g", "v < 20")
    one = concat_results([I.indicator_query(df, calcs, "g", "t", t, 3600, "v < 20") for t in times])
    columns = sorted(one.columns)
    pick = lambda d: sorted(map(tuple, d.select(*columns).collect()), key=str)
    assert pick(many) == pick(one)
    table = spark.createDataFrame([(t,) for t in times], "evaluation_time bigint")
    assert pick(I.indicator_series(df, calcs, table, 3600, "t", "g", "v < 20")) == pick(one)


def test_rolling_equals_series(spark):
    df = data(spark)
    rolled = I.rolling_indicators(df, [("COUNT(*)", 1)], "t", 7200, 3600, "g")
    series = I.indicator_series(df, [("COUNT(*)", 1)], [3600, 7200, 10800, 14400], 7200, "t", "g")
    columns = sorted(series.columns)
    pick = lambda d: sorted(map(tuple, d.select(*columns).collect()), key=str)
    assert pick(rolled) == pick(series)
    epochs = I.rolling_indicators(data(spark, "bigint"), [("COUNT(*)", 1)], "t", 7200, 3600, "g")
    counts = lambda d: sorted((r["g"], r["_lookback_range_end_ts"], r["_indicator_1"]) for r in d.collect())
    assert counts(epochs) == counts(rolled)
    fine = I.rolling_indicators(df, [("COUNT(*)", 1)], "t", 7200, 60, "g")
    times = list(range(60, 15000, 60))
    series = I.indicator_series(df, [("COUNT(*)", 1)], times, 7200, "t", "g")
    assert pick(fine) == pick(series)


DEFINITIONS = (
    "indicator_id bigint, indicator_name string, org_id bigint, computed_dataset_id bigint,"
    " computed_dataset_query string, computed_dataset_source string, raw_dataset_names array<string>,"
    " calculation string, group_fields string, filters string, timestamp_column string,"
    " evaluation_times array<bigint>, evaluation_interval string, lookback_window_length bigint, lag bigint"
)


def definitions(spark):
    data(spark, "bigint").createOrReplaceTempView("indicator_data")

    def row(i, calc, groups, filters, times, org=1, lookback=3600):
        return (i, f"n{i}", org, 7, "SELECT * FROM indicator_data;", "src", ["d1", "d2"], calc, groups, filters, "t",
                times, "*/5 * * * *", lookback, 60)

    return spark.createDataFrame(
        [
            row(1, "COUNT(*)", "g", "v > 0 AND g <> 'z'", [3_600_000, 7_200_999]),
            row(2, "SUM(v)", " g", "g <> 'z' and (v > 0)", [7_200_000]),
            row(3, "COUNT(DISTINCT u)", "", "", [7_200_000]),
            row(4, "COUNT(*)", "g", "v > 0 AND g <> 'z'", [7_200_000], org=2),
            row(5, "COUNT(*)", "", "", [], lookback=60),
        ],
        DEFINITIONS,
    )


def test_families_share_scans(spark):
    got = sorted((f.org_id, tuple(f.indicator_ids), tuple(f.times)) for f in I.families(definitions(spark)))
    assert got == [(1, (1,), (3600,)), (1, (1, 2), (7200,)), (1, (3,), (7200,)), (2, (4,), (7200,))]
    split = list(I.families(definitions(spark), sketch_in_key=True))
    assert any("COUNT(DISTINCT u)" in f.key for f in split) and any("_NONE_" in f.key for f in split)


def test_families_of_a_dataset_are_answered_by_one_scan(spark, tmp_path):
    rows = [(i, "abc"[i % 3], i % 5, float(i % 7), 1000 + 37 * i) for i in range(400)] + [(None, None, None, None, None)]
    path = str(tmp_path / "rows")
    spark.createDataFrame(rows, "u bigint, g string, h bigint, v double, t bigint").write.parquet(path)

    def family(n, groups, filters, lookback, calcs, times, timestamp="t"):
        query = f"SELECT * FROM parquet.`{path}`"
        return I.Family(f"k{n}", 1, 1, query, groups, filters, timestamp, lookback, calcs, times)

    near, far = [3600, 7200], [1800 * i for i in range(1, 12)]
    batch = [
        family(0, "g", "", 3600, [("COUNT(*)", 1), ("SUM(v)", 2)], near),
        family(1, "h, g", "v > 2 OR g = 'a'", 7200, [("avg(v)", 3), (" MAX(u)", 4)], far),  # windows overlap: panes
        family(2, "", "", 1800, [("COUNT(DISTINCT u)", 5), ("approx_percentile(v, 0.5)", 6), ("stddev(v)", 7)], near),
        family(3, "h", "1 / v > 0.3", 3600, [("COUNT(*)", 8)], near),  # divides by zero
        family(4, "h", "", 3600, [("100.0 * SUM(v) / COUNT(*)", 9)], near),  # several calls: alone
        family(5, "g", "h > 1", 0, [("COUNT(v)", 10)], [], ""),
    ]
    assert [len(b) for b in I.batches_of_families(batch)] == [5, 1]

    def found(result):
        return sorted(tuple(round(x, 9) if isinstance(x, float) else str(x) for x in r) for r in result.collect())

    for mode in ("exact", "approx", "plain"):
        shared = I.shared_results(spark, batch[:3] + batch[4:5], mode)
        assert sorted(shared) == [0, 1, 2]
        for n, result in shared.items():
            alone = I.evaluate_family(spark, batch[n], mode)
            assert result.dtypes == alone.dtypes and found(result) == found(alone) != []
    sketches = I.shared_results(spark, batch[1:3], "sketch")
    assert sketches[1].dtypes == I.evaluate_family(spark, batch[2], "sketch").dtypes
    assert I.shared_results(spark, batch[:4], "exact") == {}  # the fault of one does not touch the others' results
    untimed = [batch[5], family(6, "h", "", 0, [("COUNT(*)", 11)], [], "")]
    for n, result in I.shared_results(spark, untimed).items():
        assert found(result) == found(I.evaluate_family(spark, untimed[n])) != []

    dataset = spark.sql(batch[0].dataset_query)
    members = [I._shared_member(dataset, n, batch[n], "exact") for n in range(3)]
    plan = I.shared_aggregate(dataset, members, "exact")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "PushedFilters: [Or(" in plan and "NestedLoop" not in plan


def test_evaluation_to_series(spark):
    defs = definitions(spark)
    tags = indicator_tags(defs)
    series = [metric_series(r, tags, "m", ["fixed"]) for _, r in I.evaluate_definitions(defs, "exact")]
    got = sorted((r["indicator_id"], r["metric"], r["timestamp"], r["value"], r["tags"][0]) for r in concat_results(series).collect())
    assert got == [
        (1, "m.n1", 3600, 1.0, "g:a"), (1, "m.n1", 7200, 1.0, "g:a"), (1, "m.n1", 7200, 2.0, "g:b"),
        (2, "m.n2", 7200, 2.0, "g:a"), (2, "m.n2", 7200, 12.0, "g:b"), (3, "m.n3", 7200, 2.0, "fixed"),
        (4, "m.n4", 7200, 1.0, "g:a"), (4, "m.n4", 7200, 2.0, "g:b"),
    ]


def test_backfill(spark):
    past = spark.createDataFrame([(3, 3_600_000), (3, 7_200_000), (5, 60_000)], "indicator_id bigint, evaluation_time bigint")
    got = {r[0]: sorted(r[1]) for r in I.backfill(definitions(spark), past).select("indicator_id", "evaluation_times").collect()}
    assert got[3] == [3_600_000, 7_200_000] and got[5] == [60_000] and got[1] == [3_600_000, 7_200_999]


def test_tags_and_statuses(spark):
    defs = definitions(spark)
    tags = {r[0]: r[1] for r in indicator_tags(defs).collect()}
    assert tags[1] == ["name:n1", "delay_seconds:60", "timestamp_col:t", "data_source:src", "lookback_seconds:3600",
                       "dataset:d1", "dataset:d2"]
    later = spark.createDataFrame([(1, ["x:y"]), (99, ["new:z"])], "indicator_id bigint, tags array<string>")
    merged = {r[0]: r[1] for r in merge_tags(indicator_tags(defs), later).collect()}
    assert merged[1] == tags[1] + ["x:y"] and merged[99] == ["new:z"] and merged[2] == tags[2]
    rows = indicator_statuses(I.exploded_times(defs), error="failed").collect()
    assert len(rows) == 5 and all(r["meta"] == {"error": "failed"} for r in rows)
    assert {r["evaluation_time"] for r in rows} == {3_600_000, 7_200_000}


def test_series_filters_each_metric_on_its_own(spark):
    now = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [("a", None, 5.0, now, now, 0, 10), ("b", 1, None, now, now, 0, 10), ("c", 1, 1.0, None, None, 0, 10)],
        "g string, _indicator_1 bigint, _indicator_2 double, _result_min_ts timestamp, _result_max_ts timestamp,"
        " _lookback_range_start_ts bigint, _lookback_range_end_ts bigint",
    )
    got = sorted((r["metric"], r["timestamp"], r["value"], tuple(r["tags"])) for r in metric_series(df, prefix="p", fixed_tags=[]).collect())
    assert got == [("p._indicator_1", 10, 1.0, ("g:b",)), ("p._indicator_2", 10, 5.0, ("g:a",))]
    with pytest.raises(ValueError):
        metric_series(df.select("g", "_result_min_ts", "_result_max_ts"))


def pick(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


CALCULATIONS = [
    ("COUNT(*)", 1), ("sum(v)", 2), ("MIN(v)", 3), ("max(coalesce(v, abs(-1)))", 4), ("avg(v)", 5), ("count(u)", 6),
]


def test_panes_give_the_same_rows(spark):
    df, times = data(spark, "timestamp_ntz"), list(range(600, 12_000, 600))
    assert I.pane_width(times, 3600) == 600 and I.pane_width([3600, 7200], 3600) == 0
    assert I.pane_width([3600, 3601, 3602], 360_000) == 0
    # A calculation that does not merge keeps the direct way.
    direct = I.indicator_series(df, [*CALCULATIONS, ("count(distinct u)", 7)], times, 3600, "t", [{"g": "h"}], "v < 9", "exact")
    panes = I.indicator_series(df, CALCULATIONS, times, 3600, "t", [{"g": "h"}], "v < 9", "exact")
    assert pick(panes) == pick(direct.drop("_indicator_7")) and panes.count() > 0
    assert panes._jdf.queryExecution().executedPlan().toString().count("Exchange hash") == 2
    direct = I.rolling_indicators(df, [*CALCULATIONS, ("count(distinct u)", 7)], "t", 3600, 600, "g", mode="exact")
    panes = I.rolling_indicators(df, CALCULATIONS, "t", 3600, 600, "g", mode="exact")
    assert pick(panes) == pick(direct.drop("_indicator_7"))
    uneven = I.rolling_indicators(df, CALCULATIONS, "t", 3700, 600, "g")
    assert pick(uneven) == pick(I.indicator_series(df, CALCULATIONS, list(range(0, 12_000, 600)), 3700, "t", "g"))


def test_sketches_merge_over_panes(spark):
    df = spark.range(5000).select((F.col("id") * 2).alias("t"), (F.col("id") % 97).alias("u"), F.col("id").cast("double").alias("v"))
    calcs = [("count(distinct u)", 1), ("approx_percentile(v, 0.5)", 2)]
    out = I.rolling_indicators(df, calcs, "t", 5000, 500, mode="sketch").filter("_lookback_range_end_ts = 6000")
    got = out.select(F.hll_sketch_estimate("_indicator_1"), F.expr("kll_sketch_get_quantile_double(_indicator_2, 0.5D)")).first()
    assert got[0] == 97 and abs(got[1] - 1750) < 60


@pytest.mark.parametrize("calculation", ["count(distinct u)", "sum(v) / count(*)", "sum(v) FILTER (WHERE v > 1)", "stddev(v)", "avg(CAST(v AS decimal(9,2)))", "count(DISTINCT(u))"])
def test_not_mergeable(spark, calculation):
    assert I.mergeable(data(spark), calculation, "x", "exact") is None


@pytest.mark.parametrize("calculation", ["approx_percentile(v, array(0.5, 0.9))", "approx_percentile(v, 0.5, 100)",
                                         "count(distinct g, u)", "approx_percentile(v, 0.5)"])
@pytest.mark.parametrize("mode", I.MODES)
def test_arguments_of_calls(spark, calculation, mode):
    row = I.indicator_query(data(spark), [(calculation, 1)], mode=mode).first()
    if "distinct" in calculation and mode != "sketch":
        assert row[0] == 4
    assert row[0] is not None


def test_all_paths_give_the_same_columns(spark):
    df = data(spark).withColumn("v", F.col("v").cast("decimal(12,2)"))
    calc = [("sum(v)", 1), ("count(*)", 2)]
    by_panes = I.indicator_series(df, calc, [3600 * i for i in range(1, 9)], 14400, "t", "g")
    direct = I.indicator_series(df, calc, [3600, 7200], 600, "t", "g")
    by_table = I.indicator_series(df, calc, spark.sql("SELECT 3600 * id AS evaluation_time FROM range(1, 9)"), 14400, "t", "g")
    rolling = [I.rolling_indicators(df, calc, "t", look, 3600, "g") for look in (3600, 14400)]
    rolling.append(I.rolling_indicators(data(spark, "bigint").withColumn("v", F.col("v").cast("decimal(12,2)")), calc, "t", 3600, 3600, "g"))
    kinds = [[(n, k) for n, k in d.dtypes if not n.startswith("_result")] for d in (by_panes, direct, by_table, *rolling)]
    assert all(k == kinds[0] for k in kinds) and dict(kinds[0])["_indicator_1"] == "decimal(22,2)"
    assert sorted(map(str, by_panes.collect())) == sorted(map(str, by_table.collect()))


def test_series_leaves_sketches_out(spark):
    calc = [("count(distinct u)", 1), ("count(*)", 2)]
    found = I.indicator_series(data(spark), calc, [7200], 7200, "t", "g", mode="sketch")
    assert {r["indicator_id"] for r in metric_series(found).collect()} == {2}
    only = found.drop("_indicator_2")
    assert metric_series(only).count() == 0


@pytest.mark.parametrize(("mode", "calculations"), [
    ("approx", [("count(*)", 1), ("sum(v)", 2), ("min(v)", 3), ("max(u)", 4), ("avg(v)", 5)]),
    ("sketch", [("count(distinct u)", 1), ("approx_percentile(v, 0.5)", 2)]),
    ("exact", [("count(distinct u)", 1)]),
])
@pytest.mark.parametrize("lookback", [60, 90, 7])
def test_tables_of_times_equal_lists(spark, monkeypatch, mode, calculations, lookback):
    rng = random.Random(lookback)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, rng.randint(0, 900)]), float(rng.randint(0, 50)), rng.randint(0, 9)) for _ in range(400)]
    df = spark.createDataFrame(rows + [("late", 5000, 1.0, 1)], "g string, t long, v double, u int")
    times = [0, 60, 61, 90, 120, 121, 333, 900, 905, 3000]
    want = I.indicator_series(df, calculations, times, lookback, "t", "g", mode=mode)
    monkeypatch.setattr(I, "MAX_DRIVER_TIMES", 3)
    table = spark.createDataFrame([(t,) for t in [*times, 60, None]], "evaluation_time long")
    got = I.indicator_series(df, calculations, table, lookback, "t", "g", mode=mode)
    assert got.dtypes == want.dtypes

    def values(frame):
        if mode == "sketch":
            frame = frame.withColumn("_indicator_1", F.hll_sketch_estimate("_indicator_1")).withColumn(
                "_indicator_2", F.expr("kll_sketch_get_n_double(_indicator_2)")
            )
        return sorted(map(tuple, frame.collect()), key=str)

    assert values(got) == values(want)


def test_windows_of_a_table_are_two_look_ups(spark, monkeypatch):
    monkeypatch.setattr(I, "MAX_DRIVER_TIMES", 3)
    df = spark.range(1000).select(F.col("id").alias("t"), F.lit(1.0).alias("v"))
    times = spark.range(0, 1000, 2).select(F.col("id").alias("evaluation_time"))
    plan = I.indicator_series(df, [("sum(v)", 1)], times, 500, "t")._jdf.queryExecution().optimizedPlan().toString()
    assert "NestedLoop" not in plan and "Generate" not in plan.replace("explode(sequence(0, 15", "")

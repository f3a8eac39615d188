import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dqspark.operators import sketches as S
from dqspark.operators.rollup import rollup_metrics

AWKWARD = [
    0.0, -0.0, 1.0, -1.0, 2.0, 4.0, 7.999999999999999, 8.0, 1e-300, -1e-300, 5e-324, 1e300, -1e300, 0.1, 0.2, 0.3,
    math.nextafter(4.0, 0), math.nextafter(4.0, 9), 1.0000000000000002, float("inf"), float("-inf"), 1e6, 1e6 + 1e-9,
]


@pytest.mark.parametrize("direct", [0, 2**20])
@pytest.mark.parametrize("p", [0.0, 0.1, 0.5, 0.77, 1.0])
def test_exact_percentile_against_numpy(spark, p, direct):
    rng = random.Random(int(p * 100))
    data = [("hot", rng.choice([rng.gauss(0, 1e3), rng.random(), 3.5])) for _ in range(900)]
    data += [("odd", v) for v in AWKWARD if math.isfinite(v)] + [("one", 5.0), ("null", None), ("nan", float("nan"))]
    data += [(None, v) for v in (1.0, 2.0, 10.0)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r["g"]: r["percentile"] for r in S.exact_percentile(df, "v", p, ["g"], direct).collect()}
    assert got["null"] is None and got["nan"] is None and got["one"] == 5.0
    for g in ("hot", "odd", None):
        want = np.quantile([v for k, v in data if k == g], p)
        assert got[g] == pytest.approx(want, rel=1e-12, abs=1e-320)


def test_exact_percentile_of_all_rows(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "v double")
    assert S.exact_percentile(df, "v", 0.25).first()[0] == 25.0
    assert S.exact_percentile(df.filter("v < 0"), "v", 0.25).count() == 0


@pytest.mark.parametrize("p", [0.0, 0.003, 0.5, 0.999, 1.0])
def test_brackets_narrow_and_survive_hot_values(spark, p):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise("spread").alias("g"),
        F.when(F.col("id") % 3 == 0, F.when(F.col("id") % 30 == 0, F.col("id")).otherwise(7)).otherwise(F.col("id") * 7919 % 60_013).cast("double").alias("v"),
    )
    want = {g: np.quantile([r["v"] for r in rows.collect() if r["g"] == g], p) for g in ("hot", "spread")}
    for direct in (1, 100, 2**20):
        assert dict(map(tuple, S.exact_percentile(rows, "v", p, ["g"], direct).collect())) == pytest.approx(want)


def test_missed_brackets_are_widened(spark, monkeypatch):
    monkeypatch.setattr(S, "RANK_ERROR", -0.2)  # brackets on the wrong side of the ranks
    rows = spark.range(5000).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("v"))
    assert dict(map(tuple, S.exact_percentile(rows, "v", 0.5, ["g"]).collect())) == {0: 2499.0, 1: 2500.0}


def test_exact_distinct(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", None)], "g string, v int")
    assert dict(map(tuple, S.exact_distinct(df, "v", ["g"]).collect())) == {"a": 2, "b": 0}
    assert S.exact_distinct(df, "v").first()[0] == 2


def test_sketches_merge_across_groups(spark):
    df = spark.range(20000).select(
        (F.col("id") % 10).alias("g"), (F.col("id") % 5000).alias("u"), F.col("id").cast("double").alias("v")
    )
    merged = rollup_metrics(S.with_sketches(df, ["g"], ["u"], ["v"]), [])
    row = merged.select(
        S.distinct_estimate(F.col("`hll|u`")), S.quantile_estimate("kll|v", 0.5), "total_group_count"
    ).first()
    assert abs(row[0] / 5000 - 1) < 0.05 and abs(row[1] / 10000 - 1) < 0.05 and row[2] == 20000

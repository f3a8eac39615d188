import datetime as dt

import pytest
from pyspark.sql import functions as F

from dqspark.functions import timecols as T


def epoch(*parts):
    return int(dt.datetime(*parts, tzinfo=dt.timezone.utc).timestamp())


@pytest.mark.parametrize(
    "text, fmt, low, high",
    [
        (" 2024-02-03 04:05:06 ", "%Y-%m-%d %H:%M:%S", epoch(2024, 2, 3, 4, 5, 6), epoch(2024, 2, 3, 4, 5, 6)),
        ("2024-02-03T04:05", "%Y-%m-%dT%H:%M", epoch(2024, 2, 3, 4, 5), epoch(2024, 2, 3, 4, 5, 59)),
        ("03/02/2024 04", "%d/%m/%Y %H", epoch(2024, 2, 3, 4), epoch(2024, 2, 3, 4, 59, 59)),
        ("03/02/2024 04 PM", "%d/%m/%Y %I %p", epoch(2024, 2, 3, 16), epoch(2024, 2, 3, 16, 59, 59)),
        ("20240203", "%Y%m%d", epoch(2024, 2, 3), epoch(2024, 2, 3, 23, 59, 59)),
        ("Feb 2024", "%b %Y", epoch(2024, 2, 1), epoch(2024, 2, 29, 23, 59, 59)),
        ("February 2023", "%B %Y", epoch(2023, 2, 1), epoch(2023, 2, 28, 23, 59, 59)),
        ("2024", "%Y", epoch(2024, 1, 1), epoch(2024, 12, 31, 23, 59, 59)),
        ("24-02-03", "%y-%m-%d", epoch(2024, 2, 3), epoch(2024, 2, 3, 23, 59, 59)),
        ("70-02-03", "%y-%m-%d", epoch(1970, 2, 3), epoch(1970, 2, 3, 23, 59, 59)),
        ("2024-034", "%Y-%j", epoch(2024, 2, 3), epoch(2024, 2, 3, 23, 59, 59)),
        ("2024-02-03 04:05:06.25", "%Y-%m-%d %H:%M:%S.%f", epoch(2024, 2, 3, 4, 5, 6), epoch(2024, 2, 3, 4, 5, 6)),
        ("2024-02-03 04:05:06+0200", "%Y-%m-%d %H:%M:%S%z", epoch(2024, 2, 3, 2, 5, 6), epoch(2024, 2, 3, 2, 5, 6)),
        ("1/2/2024", "%m/%d/%Y", epoch(2024, 1, 2), epoch(2024, 1, 2, 23, 59, 59)),
        ("2024-01-02 3:04:5", "%Y-%m-%d %H:%M:%S", epoch(2024, 1, 2, 3, 4, 5), epoch(2024, 1, 2, 3, 4, 5)),
        ("2024-02-03T04:05:06+02:00", "%Y-%m-%dT%H:%M:%S%z", epoch(2024, 2, 3, 2, 5, 6), epoch(2024, 2, 3, 2, 5, 6)),
        ("2024-02-03T04:05:06Z", "%Y-%m-%dT%H:%M:%S%z", epoch(2024, 2, 3, 4, 5, 6), epoch(2024, 2, 3, 4, 5, 6)),
        ("20240102030405123456", "%Y%m%d%H%M%S%f", epoch(2024, 1, 2, 3, 4, 5), epoch(2024, 1, 2, 3, 4, 5)),
        ("Saturday, 3 Feb 2024", "%A, %d %b %Y", epoch(2024, 2, 3), epoch(2024, 2, 3, 23, 59, 59)),
        ("Sat 03 Feb 2024 04:05:06 UTC", "%a %d %b %Y %H:%M:%S %Z", epoch(2024, 2, 3, 4, 5, 6), epoch(2024, 2, 3, 4, 5, 6)),
        ("not a time", "%Y-%m-%d", None, None),
        (None, "%Y-%m-%d", None, None),
    ],
)
def test_parse_and_precision(spark, text, fmt, low, high):
    df = spark.createDataFrame([(text,)], "t string")
    out, times = T.add_times(df, {"t": {"column": "t", "format": fmt}}, 0)
    row = out.first()
    assert (row["min_t"], row["max_t"]) == (low, high)
    assert times.names == ["execution_time", "max_t", "min_t"]


@pytest.mark.parametrize(
    "zone, low, high",
    [
        (None, epoch(2024, 7, 1), epoch(2024, 7, 31, 23, 59, 59)),
        ("America/New_York", epoch(2024, 7, 1, 4), epoch(2024, 8, 1, 3, 59, 59)),
        ("Not/AZone", epoch(2024, 7, 1), epoch(2024, 7, 31, 23, 59, 59)),
    ],
)
def test_zones_truncate_locally(spark, zone, low, high):
    df = spark.createDataFrame([("2024-07",)], "t string")
    out, _ = T.add_times(df, {"t": {"column": "t", "format": "%Y-%m", "timezone": zone}}, 0)
    assert (out.first()["min_t"], out.first()["max_t"]) == (low, high)


def test_typed_columns_need_no_text(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-02-03 04:05:06' AS n, timestamp'2024-02-03 04:05:06' AS z, date'2024-02-03' AS d")
    spec = {c: {"column": c, "format": "%Y-%m-%d %H", "timezone": "America/New_York"} for c in "nzd"}
    row = T.add_times(df, spec, 0)[0].first()
    assert row["min_n"] == epoch(2024, 2, 3, 9) and row["min_z"] == epoch(2024, 2, 3, 4)
    assert row["min_d"] == epoch(2024, 2, 3, 5)


@pytest.mark.parametrize("kind", ["typed", "text"])
def test_repeated_hour_of_a_zone_keeps_its_instants(spark, kind):
    instants = [epoch(2024, 11, 3, h, 30) for h in (4, 5, 6, 7)]
    df = spark.createDataFrame([(t,) for t in instants], "e bigint").withColumn("z", F.timestamp_seconds("e"))
    if kind == "text":
        df = df.withColumn("z", F.concat(F.date_format(F.expr("z - INTERVAL 5 HOURS"), "yyyy-MM-dd HH:mm:ss"), F.lit("-0500")))
    zone = {"column": "z", "timezone": "America/New_York"}
    spec = {"s": {**zone, "format": "%Y-%m-%d %H:%M:%S%z"}, "h": {**zone, "format": "%Y-%m-%d %H"}}
    spec = spec if kind == "typed" else {"s": spec["s"]}
    for row in T.add_times(df, spec, 0)[0].collect():
        assert row["min_s"] == row["max_s"] == row["e"]
        if kind == "typed":
            assert (row["min_h"], row["max_h"]) == (row["e"] - 1800, row["e"] + 1799)


def test_composite_primary_and_missing(spark, caplog):
    df = spark.createDataFrame([("2024-01-02", 3, 1_704_164_400)], "d string, h int, u bigint")
    spec = {
        "gone": {"column": "{zz}", "format": "%Y", "primary": True},
        "both": {"column": "{d} {h}:00", "format": "%Y-%m-%d %H:%M", "freshness": True},
        "unix": {"column": "u", "format": "unixtime", "primary": True, "freshness": True},
        "again": {"column": "u", "format": "unixtime", "primary": True},
    }
    df = df.withColumn("h", F.lpad(F.col("h").cast("string"), 2, "0"))
    out, times = T.add_times(df, spec, 5)
    assert times.primary == "max_unix" and times.freshness == ["both_freshness"]
    row = out.first()
    assert row["both_freshness"] == "0-5min" and row["execution_time"] == 5
    assert "gone" in caplog.text and "more than one primary" in caplog.text


FRESHNESS = [
    (-61, "future: >1 hour"), (-60, "future: 0-1 hour"), (-1, "future: 0-1 hour"), (0, "0-5min"), (5, "0-5min"),
    (5.5, "5-10min"), (10, "5-10min"), (20, "10-20min"), (30, "20-30min"), (60, "30-60min"), (120, "1-2h"),
    (180, "2-3h"), (1440, "3-24h"), (1441, ">24h"), (None, "<empty>"),
]


def test_freshness_edges(spark):
    df = spark.createDataFrame([(None if m is None else float(m), w) for m, w in FRESHNESS], "m double, want string")
    assert df.filter(T.freshness_label(F.col("m")) != F.col("want")).count() == 0


def test_unknown_directive():
    with pytest.raises(ValueError):
        T.spark_pattern("%U %Y")
    assert T.spark_pattern("%Y-%m-%dT%H:%M:%S%%") == "yyyy-M-d'T'H:m:s%"
    assert T.spark_pattern("%Y%m%d %H%M") == "yyyyMMdd HHmm"


def cron_brute(cron, start, end):
    """Minute by minute, stopping one past the end."""
    minute, hour, day, month, weekday = cron.split()
    fields = (
        T.cron_field(minute, 0, 59), T.cron_field(hour, 0, 23), T.cron_field(day, 1, 31),
        T.cron_field(month, 1, 12, T.MONTH_NAMES), {d % 7 for d in T.cron_field(weekday, 0, 7, T.WEEKDAY_NAMES)},
    )
    out, t = [], start
    if start > end:
        return out
    t = (t // 60 + 1) * 60
    while True:
        when = dt.datetime.fromtimestamp(t, dt.timezone.utc)
        days = (when.day in fields[2], (when.weekday() + 1) % 7 in fields[4])
        both = not day.startswith("*") and not weekday.startswith("*")
        if (when.minute in fields[0] and when.hour in fields[1] and when.month in fields[3]
                and (any(days) if both else all(days))):
            out.append(t)
            if t > end:
                return out
        t += 60


@pytest.mark.parametrize(
    "cron", ["*/15 * * * *", "0 0 * * *", "5,35 8-10 * * mon-fri", "0 12 1 * *", "30 6 13 * 5", "0 0 29 feb *", "0 */6 * 1-3 0,7"],
)
def test_evaluation_grid(spark, cron):
    start, end = epoch(2024, 1, 10, 3, 7), epoch(2024, 1, 20, 11, 30)
    bounds = spark.createDataFrame([(1, start, end + 60), (2, end, start)], "k int, s bigint, e bigint")
    out = T.evaluation_times(bounds, cron, "s", "e", delay=60, keep=("k",))
    got = sorted(tuple(r) for r in out.collect())
    assert got == [(1, t) for t in cron_brute(cron, start, end)]


def test_grid_includes_exact_end(spark):
    bounds = spark.createDataFrame([(0, 7200)], "s bigint, e bigint")
    got = sorted(r[0] for r in T.evaluation_times(bounds, "0 * * * *", "s", "e").collect())
    assert got == [3600, 7200, 10800]

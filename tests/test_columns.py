import hashlib

import pytest
from pyspark.sql import functions as F

from dqspark.functions import columns as C


def test_existing_keeps_order_and_warns(caplog):
    assert C.existing(["a", "b", "c"], ["c", "x", "a"]) == ["c", "a"]
    assert "x" in caplog.text


def test_aliased_forms(spark):
    df = spark.range(1).select(
        C.aliased("id"), C.aliased({"id + 1": "next"}), C.aliased(" id "), C.aliased({" id ": " other "})
    )
    assert df.columns == ["id", "next", "id", "other"]
    with pytest.raises(ValueError):
        C.aliased({"a": "b", "c": "d"})


def test_labels(spark):
    df = spark.createDataFrame([("a",), (" a ",), ("",), ("  \t",), (None,)], "c string")
    got = [r[0] for r in df.select(C.label("c")).collect()]
    assert got == ["a", "a", "<empty>", "<empty>", "<empty>"]


@pytest.mark.parametrize(
    "text, value",
    [
        ("1.5", 1.5), (" 2 ", 2.0), ("1.5x", None), ("", None), (None, None), ("1.5d", None), ("2f", None),
        ("1e3", 1000.0), ("nan", None), ("-7", -7.0), ("inf", float("inf")), (".5", 0.5),
    ],
)
def test_numbers_from_text(spark, text, value):
    df = spark.createDataFrame([(text,)], "c string")
    assert df.select(C.to_number(df, "c")).first()[0] == value


def test_numbers_from_other_types(spark):
    df = spark.sql("SELECT true AS b, 3 AS i, double('nan') AS d, CAST(1.25 AS decimal(5,2)) AS e, array(1) AS a")
    got = df.select(*[C.to_number(df, c) for c in df.columns]).first()
    assert list(got) == [1.0, 3.0, None, 1.25, None]


@pytest.mark.parametrize(
    "text, kind",
    [("5", "integer"), ("5.0", "integer"), ("1e3", "integer"), ("5.5", "number"), ("x", "string"), ("", "string"),
     ("inf", "number"), ("nan", "number"), ("5d", "string"), (None, None)],
)
def test_inferred_type(spark, text, kind):
    df = spark.createDataFrame([(text,)], "c string")
    assert df.select(C.inferred_type(F.col("c"))).first()[0] == kind


def test_inferred_value(spark):
    df = spark.createDataFrame([("5",), ("5.5",), ("x",)], "c string")
    got = [tuple(r[0]) for r in df.select(C.inferred_value(F.col("c"))).collect()]
    assert got == [(5, None, None), (None, 5.5, None), (None, None, "x")]


# Fingerprints that stored keys depend on.
FINGERPRINTS = {
    "B, A": "a1f86715f2bfd6bb0d269777e85422d81d222068",
    "A, B": "a1f86715f2bfd6bb0d269777e85422d81d222068",
    "A, B,    C, A": "686ba37964a11c4d915667a90ca6648ebff574fc",
    "A, A, B, C": "686ba37964a11c4d915667a90ca6648ebff574fc",
    "": "",
}


def test_list_fingerprints(spark):
    df = spark.createDataFrame([(k,) for k in FINGERPRINTS], "c string")
    got = {r[0]: r[1] for r in df.select("c", C.list_fingerprint(F.col("c"))).collect()}
    assert got == FINGERPRINTS
    assert {k: C.text_fingerprint(k) for k in FINGERPRINTS} == FINGERPRINTS
    assert spark.sql("SELECT CAST(NULL AS string) c").select(C.list_fingerprint(F.col("c"))).first()[0] == ""


def test_metric_key_ignores_dimension_order():
    a = C.metric_key("sum", "v", ["x", "y"], "src", "set")
    assert a == C.metric_key("sum", "v", ["y", "x"], "src", "set")
    assert a == "sum|v|" + hashlib.sha1(b"set|src|x|y").hexdigest()


def test_template(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "x string, n int")
    got = [r[0] for r in df.select(C.fill_template("at {x}-{n}/")).collect()]
    assert got == ["at a-1/", None]
    assert C.template_fields("at {x}-{n}/") == ["x", "n"]


def test_path_fields_and_clashes(spark):
    df = spark.createDataFrame([("file", 1)], "kind string, n int")
    out = C.add_path_fields(df, {"kind": "path", "day": "3"})
    assert out.columns == ["object.kind", "n", "partition.kind", "day"]
    assert tuple(out.first()) == ("file", 1, "path", "3")
    names = [
        C.resolve_name(n, ["kind", "n"], ["kind", "day"])
        for n in ("kind", "object.kind", "partition.kind", "object.n", "partition.day", "day", "n", "object.zz")
    ]
    assert names == ["partition.kind", "object.kind", "partition.kind", "n", "day", "day", "n", "object.zz"]


def test_nested_dimensions(spark):
    df = spark.sql(
        """SELECT * FROM VALUES
        (named_struct('c', 'x'), map('c', 'm'), '{"c": 5}', array(named_struct('f', 'p'), named_struct('f', 'q'))),
        (NULL, map('z', 'm'), 'junk', array(named_struct('f', 'p'))),
        (named_struct('c', NULL), NULL, '{"d": 5}', NULL) AS t(s, m, j, l)"""
    )
    got = df.select(
        C.object_dimension(df, "s.c"), C.object_dimension(df, "s.zz").alias("none"), C.object_dimension(df, "m.c"),
        C.object_dimension(df, "j.c"), C.list_dimension(df, "l", 1, "f").alias("second"),
        C.list_dimension(df, "l", -1, "f").alias("last"),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("x", "", "m", "5", "q", "q"), ("", "", "", "", "", "p"), ("", "", "", "", "", ""),
    ]


def test_role_and_reserved_names(spark):
    df = spark.sql("SELECT 1 AS a, 2 AS max_t, 3 AS min_t, 4 AS _INDICATOR_9, 5 AS _RESULT_MIN_TS, 6 AS Keep")
    out = C.lower_reserved(C.with_role_names(df, ["a", "zz"], ["max_t", "min_t"], "max_t"))
    assert out.columns == ["dim|a", "primary_time|max_t", "time|min_t", "_indicator_9", "_result_min_ts", "Keep"]


def test_exports(spark):
    df = spark.sql("SELECT CAST(repeat('x', 200) AS binary) AS b, 12 AS n, '2024-01-02' AS d, 'junk' AS j")
    got = df.select(
        C.to_base64_text(F.col("b"), df.schema["b"].dataType), C.to_base64_text(F.col("n"), df.schema["n"].dataType),
        C.date_epoch(F.col("d")), C.date_epoch(F.col("j")),
    ).first()
    assert "\n" not in got[0] and got[1] == "MTI=" and got[2] == 1_704_153_600 and got[3] is None


def test_common_names_and_fields(spark):
    assert C.common_names(["a", "b", "c"], ["c", "a"]) == ["a", "c"]
    df = spark.createDataFrame([('{"b": 1, "a": 2, "z": 3}',), ("junk",), (None,)], "r string")
    got = [r[0] for r in df.select(C.common_fields(F.col("r"), ["a", "b", "c"])).collect()]
    assert got == [["a", "b"], [], []]

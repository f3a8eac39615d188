import json

import pytest

from dqspark.operators import schema as S

ORDER = (
    "o_orderkey bigint, buyer struct<name: string>, o_orderdate date, ship struct<weight: double, box: struct<w: string>>,"
    " tax float, notes map<string,string>, paid boolean, o_totalprice decimal(10,2), lines smallint, placed timestamp,"
    " parts array<struct<k: string, v: array<int>>>"
)


def test_nested_json_schema(spark):
    df = spark.createDataFrame([], ORDER)
    props = S.json_schema(df)["properties"]
    assert props["buyer"] == {"type": "object", "properties": {"name": {"type": "string"}}}
    assert props["o_orderkey"] == {"type": "integer", "format": "bigint"}
    assert props["o_orderdate"] == {"type": "string", "format": "date"}
    assert props["ship"]["properties"]["weight"] == {"type": "number", "format": "double"}
    assert props["notes"] == {"type": "object", "additionalProperties": {"type": "string"}}
    assert props["o_totalprice"] == {"type": "number", "format": "decimal", "precision": 10, "scale": 2}
    assert props["placed"] == {"type": "integer", "format": "date-time"}
    assert props["parts"]["items"]["properties"]["v"] == {"type": "array", "items": {"type": "integer", "format": "int"}}


def test_flat_and_reduced(spark):
    df = spark.createDataFrame([], "a int, b struct<c: int>, d double, e boolean, f timestamp")
    flat = S.flat_json_schema(df)
    assert {k: v["type"] for k, v in flat["properties"].items()} == {"a": "integer", "b": "string", "d": "number", "e": "boolean", "f": "string"}
    nested = S.json_schema(spark.createDataFrame([], "a int, b array<double>"), scalars="string")
    assert nested == {"type": "object", "properties": {
        "a": {"type": "string"}, "b": {"type": "array", "items": {"type": "string"}}}}
    assert S.json_schema(df, scalars="string")["properties"]["b"]["properties"]["c"] == {"type": "string"}
    assert json.loads(S.as_text(flat)) == flat


def test_path_fields(spark):
    base = spark.createDataFrame([], "a int, b string").schema
    out = S.flat_json_schema(S.with_path_fields(base, {"a": "x", "day": "3", "w": "1.5"}))["properties"]
    assert set(out) == {"object.a", "partition.a", "b", "day", "w"}
    assert [out[k]["type"] for k in ("partition.a", "day", "w", "object.a")] == ["string", "integer", "number", "integer"]
    assert base.names == ["a", "b"]


def test_schema_rows(spark):
    df = spark.createDataFrame([], ORDER)
    got = {r["path"]: (r["type"], r["format"]) for r in S.schema_rows(df).collect()}
    assert got["ship.weight"] == ("number", "double") and got["parts[].v[]"] == ("integer", "int")
    assert got["notes{}"] == ("string", None) and got["parts"] == ("array", None)


def test_inferred_from_json_text(spark):
    df = spark.createDataFrame([('{"a": 1, "n": {"x": "y"}}',), ('{"a": 2.5, "l": [1]}',), ("junk",)], "t string")
    found = S.widened(S.inferred_schema(df, "t"))
    assert found.simpleString() == "struct<a:double,l:array<bigint>,n:struct<x:string>>"
    assert S.observed_json_type(df.filter("t LIKE '%y%'"), "t").first()[0] == "OBJECT<a: BIGINT, n: OBJECT<x: STRING>>"


def test_ddl_round_trip(spark):
    df = spark.createDataFrame([], ORDER)
    back = spark.createDataFrame([], S.to_ddl(S.json_schema(df)))
    for name in ("o_orderkey", "buyer", "ship", "notes", "o_totalprice", "o_orderdate", "placed", "paid"):
        assert back.schema[name].dataType == df.schema[name].dataType
    assert S.spark_type({"type": "array", "items": {"type": "integer"}}).simpleString() == "array<bigint>"
    with pytest.raises(ValueError):
        S.spark_type({"type": "mystery"})


def test_catalog_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql(f"CREATE TABLE sch_t (a int, p string) USING parquet PARTITIONED BY (p) LOCATION '{path}'")
    (found,) = S.catalog_schemas(spark, ["sch_t"])
    assert found["meta"] == {"partition_keys": ["p"]} and set(found["schema"]["properties"]) == {"a", "p"}
    spark.sql("DROP TABLE sch_t")

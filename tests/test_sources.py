import bz2
import gzip
import json

import pytest
from pyspark.sql import functions as F

from dqspark.sources import objects as O
from dqspark.sources import readers as R
from dqspark.sources.notifications import arrived_objects
from dqspark.sources.records import merge_records


def test_formats(spark, tmp_path, rows):
    records = [{"a": 1, "b": "x"}, {"a": 2, "b": None}]
    (tmp_path / "l.jsonl").write_text("\n".join(map(json.dumps, records)))
    (tmp_path / "d.json").write_text(json.dumps(records, indent=1))
    spark.createDataFrame([(1, "x"), (2, None)], "a bigint, b string").write.parquet(str(tmp_path / "p"))
    for name, kind in (("l.jsonl", "jsonl"), ("d.json", "json"), ("p", "parquet")):
        assert rows(R.read_dataset(spark, str(tmp_path / name), kind).select("a", "b")) == [(1, "x"), (2, None)]
    with pytest.raises(ValueError):
        R.read_dataset(spark, "x", "xml")


def test_csv_skips_long_and_pads_short(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('a,b,c\n1,x,2\n3,y\n4,z,5,\n6,w,7,8\n9,"q, r",10\n11\nbad,v,12\n13,m,14,,\n')
    df = R.read_dataset(spark, str(path), "csv", "a int, b string, c int")
    want = [(1, "x", 2), (3, "y", None), (9, "q, r", 10), (11, None, None), (None, "v", 12)]
    assert [tuple(r) for r in df.collect()] == want
    assert df.count() == 5 and [r[0] for r in df.select("b").collect()] == ["x", "y", "q, r", None, "v"]
    assert R.read_dataset(spark, str(path), "csv").count() == 5


def test_csv_quotes(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('a,b,c\n1,"x ""q"" y",2\n3,"p, ""q"", r",4\n5,"back\\\\slash",6\n7,plain \\ one,8\n')
    for schema in ("a int, b string, c int", None):
        rows = R.read_dataset(spark, str(path), "csv", schema).collect()
        want = [(1, 'x "q" y', 2), (3, 'p, "q", r', 4), (5, "back\\\\slash", 6), (7, "plain \\ one", 8)]
        assert sorted(tuple(r) for r in rows) == want


def test_malformed_template():
    for bad in ("{a", "a}/b", "<a>b/c", "{}", "x<y>"):
        with pytest.raises(ValueError):
            O.path_template(bad)


def test_csv_multiline_and_delimiter(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('a|b\n1|"x\ny"\n2|z|extra\n')
    df = R.read_dataset(spark, str(path), "csv", "a int, b string", delimiter="|", multiline=True)
    assert [tuple(r) for r in df.collect()] == [(1, "x\ny")]


def test_sampled_schema(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1}\n{"a": 2}\n{"b": "later"}\n')
    assert R.sampled_text_schema(spark, str(tmp_path / "a.jsonl"), "jsonl", 2).names == ["a"]
    (tmp_path / "a.csv").write_text("a,b\n1,x\n2.5,y\n")
    assert R.sampled_text_schema(spark, str(tmp_path / "a.csv"), "csv", 1).simpleString() == "struct<a:int,b:string>"
    assert R.sample(spark.range(50), 7).count() == 7


def test_matching_tables(spark):
    for name in ("mt_one", "mt_two", "mt_other", "xmt_one"):
        spark.range(1).createOrReplaceTempView(name)
    assert R.matching_tables(spark, ["mt_one", "mt_t*"]) == ["mt_one", "mt_two"]
    assert set(R.matching_tables(spark, ["*mt_one"])) == {"mt_one", "xmt_one"}
    assert {"mt_one", "xmt_one"} <= set(R.matching_tables(spark, []))
    assert R.computed_dataset(spark, "SELECT id + 1 AS n FROM mt_one; ", "mt_view").first()[0] == 1
    assert spark.table("mt_view").count() == 1


TEMPLATES = [
    ("{year}/{month}/<region>", "year=2024/month=2/eu/x.json", {"year": "2024", "month": "2", "region": "eu"}),
    ("{year}/{month}/<region>", "year=2024/day=2/eu/x.json", None),
    ("{year}/{month}/<region>", "year=2024/month=2/eu", None),
    ("{*}/{*}", "a=1/b=2/x", {"a": "1", "b": "2"}),
    ("{*}/{*}", "a=1/a=2/x", {"a": "2"}),
    ("{*}/x", "nothing/x/y", None),
    ("data/<day>", "data/2024/x", {"day": "2024"}),
    ("data/<day>", "date/2024/x", None),
    ("kind=a/<day>", "kind=a/3/x", {"kind": "a", "day": "3"}),
    ("<day>", "other=5/x", {"other": "5"}),
    ("a.b/<c>", "aXb/1/x", None),
    ("{t}", "t=a=b/x", {"t": "a=b"}),
]


@pytest.mark.parametrize("template, suffix, want", TEMPLATES)
def test_path_templates(spark, template, suffix, want):
    compiled = O.path_template(template)
    df = spark.createDataFrame([(suffix, compiled.pattern, list(compiled.names), "=")], "s string, p string, n array<string>, k string")
    assert df.select(O.path_fields(*[F.col(c) for c in "spnk"])).first()[0] == want


@pytest.mark.parametrize("small", [True, False])
def test_first_fitting_config_wins(spark, small):
    configs = O.config_table(spark, [
        O.ObjectConfig("first", "b1", "raw/", "{day}", "csv"),
        O.ObjectConfig("second", "b1", "raw", "<any>", "json"),
        O.ObjectConfig("dash", "b2", "", "{day}", "json", separator="-"),
    ])
    df = spark.createDataFrame(
        [(1, "b1", "raw/day=3/f"), (2, "b1", "raw/x/f"), (3, "b1", "other/x/f"), (4, "b2", "day-4/f"), (5, "b3", "raw/day=1/f")],
        "i int, bucket string, object_key string",
    )
    got = sorted((r["i"], r["dataset"], r["file_type"], r["path_fields"]) for r in O.match_configs(df, configs, small).collect())
    assert got == [(1, "first", "csv", {"day": "3"}), (2, "second", "json", {"any": "x"}), (4, "dash", "json", {"day": "4"})]


@pytest.mark.parametrize("small", [True, False, None])
@pytest.mark.parametrize("lengths", [3, 40])
def test_configs_meet_keys_by_their_prefix(spark, small, lengths):
    prefixes = ["a/" * (1 + i % lengths) + ("b" if i % 2 else "") for i in range(120)]
    configs = [O.ObjectConfig(f"c{i}", f"bucket{i % 3}", p, "{day}" if i % 5 else "<any>", "csv") for i, p in enumerate(prefixes)]
    keys = [(f"bucket{b}", "a/" * n + tail) for b in range(4) for n in range(0, 45, 4) for tail in ("b/x/f", "day=1/f", "f", "b/day=2/f")]
    keys += keys[:5] + [(None, "a/day=1/f"), ("bucket1", None)]
    df = spark.createDataFrame([(i, *k) for i, k in enumerate(keys)], "i int, bucket string, object_key string")

    def first(bucket, key):
        for i, c in enumerate(configs):
            if bucket == c.bucket and key and key.startswith(c.prefix):
                rest = key[len(c.prefix) :].strip("/").split("/")
                if len(rest) > 1 and (rest[0].startswith("day=") and len(rest[0]) > 4 if i % 5 else rest[0]):
                    return c.name
        return None

    got = {r["i"]: r["dataset"] for r in O.match_configs(df, O.config_table(spark, configs), small).collect()}
    assert got == {i: first(*k) for i, k in enumerate(keys) if first(*k)}
    assert O.match_configs(df, O.config_table(spark, []), small).collect() == []


def test_notifications(spark):
    def direct(key):
        return {"s3": {"bucket": {"name": "b"}, "object": {"key": key}}}

    events = [
        {"Records": [direct("a%2Fb+c"), direct("d")]},
        {"requestPayload": {"Records": [direct("e")]}},
        {"Records": [{"Sns": {"Message": json.dumps({"Records": [direct("f"), direct("g%20h")]})}},
                     {"Sns": {"Message": "junk"}}]},
        {"Records": [direct("100%")]},
        {"data": {"bucket": "gb", "name": "kept%20as+is"}},
        {"other": 1},
    ]
    df = spark.createDataFrame([(json.dumps(e),) for e in events] + [("not json",)], "payload string")
    got = [(r["event_source"], r["bucket"], r["object_key"]) for r in arrived_objects(df).collect()]
    assert got == [
        ("S3_TRIGGER", "b", "a/b c"), ("S3_TRIGGER", "b", "d"), ("S3_TRIGGER", "b", "e"),
        ("SNS_S3_TRIGGER", "b", "f"), ("SNS_S3_TRIGGER", "b", "g h"), ("UNSUPPORTED", None, None),
        ("S3_TRIGGER", "b", "100%"), ("GCS_TRIGGER", "gb", "kept%20as+is"), ("UNSUPPORTED", None, None), ("UNSUPPORTED", None, None),
    ]


def test_record_merge(spark):
    lines = [("o1", 0, '{"a": 1, "b": "x"}'), ("o1", 1, '{"b": null, "c": true}'), ("o1", 2, "junk"), ("o2", 0, '{"a": 5}')]
    df = spark.createDataFrame(lines, "o string, n int, t string")
    got = {r["o"]: tuple(r)[1:] for r in merge_records(df, "t", "n", "a bigint, b string, c boolean", ["o"]).collect()}
    assert got == {"o1": (1, None, True), "o2": (5, None, None)}


def test_inventory(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "plain.txt").write_bytes(b"hello")
    (tmp_path / "sub" / "a.gz").write_bytes(gzip.compress(b"hello"))
    (tmp_path / "b.bz2").write_bytes(bz2.compress(b"hello"))
    (tmp_path / "s.snappy").write_bytes(bytes.fromhex("ff060000") + b"sNaPpY")
    (tmp_path / "big").write_bytes(b"\0" * O.LARGE_OBJECT_BYTES)
    got = {r["path"].rsplit("/", 1)[1]: (r["size_class"], r["compression"]) for r in O.object_inventory(spark, str(tmp_path)).collect()}
    assert got == {
        "plain.txt": ("small", "none"), "a.gz": ("small", "gzip"), "b.bz2": ("small", "bzip2"),
        "s.snappy": ("small", "snappy"), "big": ("large", "none"),
    }


def test_described_objects(spark, tmp_path):
    (tmp_path / "empty").write_bytes(b"")
    df = spark.createDataFrame([(str(tmp_path / "empty"),), (str(tmp_path / "gone"),)], "path string")
    got = [tuple(r)[1:] for r in O.describe_objects(df).collect()]
    assert got == [(0, "small", "none"), (None, None, None)]


def test_objects_with_odd_names_and_stores(spark, tmp_path):
    folder = tmp_path / "my root"
    folder.mkdir()
    (folder / "a%20 b+c.txt").write_bytes(b"plain text")
    paths = [f"file:{folder}/a%20 b+c.txt", f"file:{folder}/gone", "nostore://bucket/key", "not a path"]
    frame = spark.createDataFrame([(p,) for p in paths], "path string")
    got = {r["path"]: r["size"] for r in O.describe_objects(frame).collect()}
    assert got == {paths[0]: 10, paths[1]: None, paths[2]: None, paths[3]: None}
    assert [r["size"] for r in O.object_inventory(spark, str(folder)).collect()] == [10]


def test_size_checks_weigh_texts_and_arrays(spark):
    from dqspark.plans.bounds import is_bounded

    long = spark.range(100).selectExpr("id", "repeat('x', 1000000) AS t")
    wide = spark.range(100).selectExpr("id", "array_repeat(id, 1000) AS a")
    assert not is_bounded(long) and is_bounded(wide) and not is_bounded(wide, max_bytes=100_000)


@pytest.mark.parametrize("rows, names", [(1, ["a"]), (None, ["a", "b"])])
def test_sampled_schema_of_first_or_all_rows(spark, tmp_path, rows, names):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n{"a": 2, "b": "late"}\n')
    assert R.sampled_text_schema(spark, str(tmp_path), "jsonl", rows).names == names


def test_path_fields_name_the_suffix_once(spark):
    """Lambdas compute an expression again for every element, so the suffix, here decoded, is bound."""
    from dqspark.sources.objects import path_fields, path_template

    template = path_template("{day}/<kind>/{*}")
    rows = spark.createDataFrame([("day%3D1/a/x=2/f", 1), ("day=1/kind=b/day=3/f", 2), ("other", 3)], "s string, i int")
    fields = path_fields(
        F.try_url_decode("s"), F.lit(template.pattern), F.array(*[F.lit(n) for n in template.names]), F.lit("=")
    )
    found = rows.select("i", fields.alias("m"))
    assert {r["i"]: r["m"] for r in found.collect()} == {1: {"day": "1", "kind": "a", "x": "2"}, 2: {"kind": "b", "day": "3"}, 3: None}
    assert found._jdf.queryExecution().analyzed().toString().count("try_url_decode(") == 1

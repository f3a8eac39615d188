"""Objects in a store: configs they belong to, fields of their path, size and compression."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dqspark.plans.bounds import is_bounded
from dqspark.plans.joins import salted_join

log = logging.getLogger(__name__)

LARGE_OBJECT_BYTES = 5 * 1024 * 1024

# Leading bytes (hex) of compressed files.
MAGIC = (("1F8B", "gzip"), ("425A68", "bzip2"), ("FF060000", "snappy"))


@dataclass(frozen=True)
class PathTemplate:
    """A path template as an anchored regular expression and the field name of each segment."""

    pattern: str
    names: tuple[str | None, ...]


def path_template(template: str, separator: str = "=") -> PathTemplate:
    """Compile the segments of a template: ``{name}`` takes ``name=value``, ``{*}`` any ``key=value``, ``<name>``
    any segment, and others themselves. A segment with a stray bracket is refused."""
    segments = [_segment(part, separator) for part in template.split("/") if part]
    return PathTemplate("^" + "".join(f"{pattern}/" for pattern, _ in segments) if segments else "^/", tuple(n for _, n in segments))


def _segment(part: str, separator: str) -> tuple[str, str | None]:
    """The expression of one segment and the name of its field."""
    kind, inner = part[0] + part[-1], part[1:-1]
    plain = inner if kind in ("{}", "<>") else part
    if not plain or set(plain) & set("{}<>"):
        raise ValueError(f"malformed path segment {part!r}")
    if kind == "<>":
        return "[^/]+", plain
    if kind == "{}":
        key = "[^/]+?" if plain == "*" else re.escape(plain)
        return f"{key}{re.escape(separator)}[^/]+", plain
    name, found, _ = plain.partition(separator)
    return re.escape(plain), name if found else None


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it and in whatever lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def path_fields(suffix: Column, pattern: Column, names: Column, separator: Column) -> Column:
    """Map of path fields; NULL where the suffix does not fit the pattern.

    A segment that holds the separator names its own field; the last one wins where names repeat. Suffix, segments
    and entries are bound, as lambdas would compute them again for every element.
    """

    def entry(segment: Column, name: Column) -> Column:
        at = F.instr(segment, separator)
        return F.struct(
            F.when(at > 0, F.substring(segment, F.lit(1), at - 1)).otherwise(name).alias("key"),
            F.when(at > 0, F.substring(segment, at + F.length(separator), F.length(segment)))
            .otherwise(segment)
            .alias("value"),
            name.alias("name"),
        )

    def entries_of(segments: Column) -> Column:
        entries = F.transform(names, lambda name, i: _bound(F.get(segments, i), lambda segment: entry(segment, name)))
        return F.filter(entries, lambda e: e["name"].isNotNull())

    def pairs(entries: Column) -> Column:
        last = F.filter(
            entries,
            lambda e, i: ~F.exists(
                F.slice(entries, i + 2, F.greatest(F.size(entries) - i - 1, F.lit(0))), lambda f: f["key"] == e["key"]
            ),
        )
        return F.map_from_entries(F.transform(last, lambda e: F.struct(e["key"], e["value"])))

    def fields(text: Column) -> Column:
        return F.when(F.regexp(text, pattern), _bound(_bound(F.split(text, "/"), entries_of), pairs))

    return _bound(suffix, fields)


@dataclass(frozen=True)
class ObjectConfig:
    """Objects of one dataset: a bucket, a key prefix and the template of the rest of the path."""

    name: str
    bucket: str
    prefix: str
    suffix_template: str
    file_type: str = "parquet"
    separator: str = "="


CONFIG_SCHEMA = (
    "bucket string, position int, dataset string, prefix string, file_type string,"
    " pattern string, names array<string>, separator string"
)


def config_table(spark: SparkSession, configs: Sequence[ObjectConfig]) -> DataFrame:
    rows = []
    for position, c in enumerate(configs):
        compiled = path_template(c.suffix_template, c.separator)
        rows.append((
            c.bucket, position, c.name, c.prefix, c.file_type,
            compiled.pattern, list(compiled.names), c.separator,
        ))
    return spark.createDataFrame(rows, CONFIG_SCHEMA)


# Prefix lengths up to which each has a join of its own and the objects stay where they are.
MOST_JOINS = 16


def match_configs(objects: DataFrame, configs: DataFrame, small: bool | None = None) -> DataFrame:
    """Objects (``bucket``, ``object_key``) with their dataset, file type and path fields.

    The first config whose prefix starts the key and whose template fits wins; objects without one are left out.
    For each length that a prefix has, the beginning of the key of that length is joined with the prefixes, so an
    object meets only configs whose prefix it has, however many its bucket has. Configs that pass the size check are
    broadcast, leaving the objects where they are, if their prefixes have few lengths. Otherwise the distinct objects
    are joined, salted. The lengths, which the longest key bounds, come to the driver: this runs a job.
    """

    def suffix(prefix: Column) -> Column:
        rest = F.substring(F.col("object_key"), F.length(prefix) + 1, F.length(F.col("object_key")))
        return F.regexp_replace(rest, "^/|/$", "")

    def fits(c: Column) -> Column:
        return F.regexp(suffix(c["prefix"]), c["pattern"])

    def fields(c: Column) -> Column:
        return path_fields(suffix(c["prefix"]), c["pattern"], c["names"], c["separator"])

    lengths = sorted(r["n"] for r in configs.select(F.length("prefix").alias("n")).distinct().collect() if r["n"] is not None)
    if small is None:
        small = is_bounded(configs)
    whole = F.struct("position", *[f for f in configs.columns if f not in ("bucket", "position")])
    gathered = configs.groupBy("bucket", "prefix").agg(F.collect_list(whole).alias("_configs"))
    begin = {n: F.substring(F.col("object_key"), 1, n) for n in lengths}
    if not lengths:
        joined = objects.withColumn("_c", F.lit(None).cast(configs.select(whole.alias("c")).schema["c"].dataType))
    elif small and len(lengths) <= MOST_JOINS:
        joined, found = objects, []
        for n in lengths:
            side = gathered.filter(F.length("prefix") == n).withColumnsRenamed(
                {"bucket": "_bucket", "prefix": "_prefix", "_configs": f"_configs_{n}"}
            )
            on = (F.col("bucket") == F.col("_bucket")) & (begin[n] == F.col("_prefix"))
            joined = joined.join(F.broadcast(side), on, "left").drop("_bucket", "_prefix")
            found.append(F.coalesce(F.col(f"_configs_{n}"), F.array()))
        joined = joined.withColumn("_c", F.array_min(F.filter(F.concat(*found), fits))).drop(*[f"_configs_{n}" for n in lengths])
    else:
        keys = objects.select("bucket", "object_key").distinct()
        begins = F.explode(F.array_distinct(F.array(*begin.values()))).alias("prefix")
        candidates = salted_join(keys.select("bucket", "object_key", begins), gathered, ["bucket", "prefix"])
        chosen = candidates.withColumn("_c", F.array_min(F.filter("_configs", fits))).filter(F.col("_c").isNotNull())
        chosen = chosen.groupBy("bucket", "object_key").agg(F.min("_c").alias("_c"))
        joined = objects.join(chosen, ["bucket", "object_key"], "left")
    hit = joined.filter(F.col("_c").isNotNull())
    return hit.select(
        *[F.col(c) for c in objects.columns],
        F.col("_c.dataset").alias("dataset"),
        F.col("_c.file_type").alias("file_type"),
        fields(F.col("_c")).alias("path_fields"),
    )


def compression_of(content: Column) -> Column:
    """Compression by the leading bytes."""
    head = F.hex(F.substring(content, 1, 4))
    out = None
    for prefix, name in MAGIC:
        test = head.startswith(prefix)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise(F.lit("none"))


def size_class(length: Column) -> Column:
    return F.when(length >= LARGE_OBJECT_BYTES, "large").otherwise("small")


def describe_objects(objects: DataFrame, path: str = "path") -> DataFrame:
    """Size, size class and compression of the objects at the given paths.

    Tasks read only the first bytes of each object. An object that is gone or cannot be opened has a NULL size.
    """
    described = objects.select(F.col(path).alias("path")).mapInPandas(
        _header_reader(), "path string, size bigint, head binary"
    )
    known = F.col("size").isNotNull()
    return described.select(
        "path",
        "size",
        F.when(known, size_class(F.col("size"))).alias("size_class"),
        F.when(known, compression_of(F.col("head"))).alias("compression"),
    )


def object_inventory(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """:func:`describe_objects` of the files under a path. Spark's listing leaves empty files out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path)
    return describe_objects(files.select("path"))


# Hadoop's names of a store and the one that Arrow knows.
STORE_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _store_of(path: str):
    """The file system of a Hadoop path and the object's name there; blanks and percent signs are taken as they are."""
    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme or scheme == "file":
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    authority, _, key = rest.lstrip("/").partition("/")
    store, base = fs.FileSystem.from_uri(f"{STORE_SCHEMES.get(scheme, scheme)}://{authority}/")
    return store, f"{base.rstrip('/')}/{key}"


def inspect_objects(objects: DataFrame, file_type: str, path: str = "path") -> DataFrame:
    """``(path, size, schema, error, broken)`` of the objects at the given paths, each opened on its own in a task.

    ``schema`` is that of a parquet object's footer, NULL for other types. ``error`` says why an object cannot be
    read, so one that is broken or gone keeps no other from being inspected; ``broken`` is true if it was opened
    but is not of its type.
    """

    def inspected(batches):
        import pandas as pd
        from pyarrow import ArrowException, parquet
        from pyspark.sql.pandas.types import from_arrow_schema

        def one(path: str) -> tuple:
            size = None
            try:
                store, name = _store_of(path)
                with store.open_input_file(name) as f:
                    size = f.size()
                    schema = from_arrow_schema(parquet.read_schema(f)).simpleString() if file_type == "parquet" else None
            except (OSError, ValueError, NotImplementedError, ArrowException) as failure:
                return path, size, None, f"{type(failure).__name__}: {failure}", size is not None
            return path, size, schema, None, False

        for batch in batches:
            out = pd.DataFrame([one(p) for p in batch["path"]], columns=["path", "size", "schema", "error", "broken"])
            yield out.astype({"size": "Int64"})

    return objects.select(F.col(path).alias("path")).mapInPandas(
        inspected, "path string, size bigint, schema string, error string, broken boolean"
    )


def _header_reader():
    def described(path: str) -> tuple:
        try:
            store, name = _store_of(path)
            info = store.get_file_info(name)
            if info.is_file:
                with store.open_input_file(name) as f:
                    return path, info.size, f.read(4)
        except (OSError, ValueError, NotImplementedError) as failure:
            log.warning("object %s cannot be read: %s", path, failure)
        return path, None, None

    def headers(batches):
        import pandas as pd

        for batch in batches:
            out = pd.DataFrame([described(p) for p in batch["path"]], columns=["path", "size", "head"])
            yield out.astype({"size": "Int64"})

    return headers

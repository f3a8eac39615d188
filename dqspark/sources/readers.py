"""Dataset scans by format, and catalog and SQL datasets."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMATS = ("parquet", "jsonl", "json", "csv", "avro")
OVERFLOW, RAW = "__overflow", "__raw"

# Rows read to infer a schema.
OBJECT_SAMPLE, TABLE_SAMPLE, CSV_SAMPLE = 10_000, 100, 5


def read_dataset(
    spark: SparkSession,
    path: str | list[str],
    file_type: str,
    schema: T.StructType | str | None = None,
    delimiter: str = ",",
    multiline: bool = True,
    recursive: bool = False,
    tolerant: bool = False,
) -> DataFrame:
    """Scan of files in one of the formats ``parquet``, ``jsonl``, ``json``, ``csv`` and ``avro``.

    ``json`` is a document holding an array of records. CSV files have a header line; short lines
    are padded with NULL and over-long ones are left out. A quoted CSV field may hold line breaks, so a
    file is one task; with ``multiline=False`` a large file is split, and such a field makes its lines
    irregular. Avro needs Spark's avro module. A ``recursive`` scan takes all files at any depth and
    adds no partition columns. A ``tolerant`` one skips what cannot be read of files that break or vanish
    meanwhile, and merges the schemas of parquet files.
    """
    if file_type not in FORMATS:
        raise ValueError(f"file type must be one of {FORMATS}")
    reader = spark.read.option("recursiveFileLookup", recursive)
    if tolerant:
        reader = reader.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).option("mergeSchema", True)
    if file_type == "csv":
        return _read_csv(reader, path, schema, delimiter, multiline)
    if schema is not None:
        reader = reader.schema(schema)
    if file_type == "json":
        return reader.option("multiLine", True).json(path)
    if file_type == "jsonl":
        return reader.json(path)
    return reader.format(file_type).load(path)


def _read_csv(
    reader: DataFrameReader, path: str | list[str], schema: T.StructType | str | None, delimiter: str, multiline: bool
) -> DataFrame:
    if schema is None:
        inferring = reader.options(header=True, sep=delimiter, multiLine=multiline, inferSchema=True, **CSV_QUOTES)
        schema = inferring.csv(path).schema
        reader = reader.option("inferSchema", False)
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    rows = reader.schema(wide_csv_schema(schema)).options(**csv_options(delimiter, multiline)).csv(path)
    return fitting_lines(rows, len(schema.fields), delimiter)


# A quote within quotes is doubled; a backslash is a character like any other.
CSV_QUOTES = {"quote": '"', "escape": '"'}


def csv_options(delimiter: str = ",", multiline: bool = True) -> dict[str, object]:
    """Reader options that keep every line and the raw text of irregular ones.

    The number of fields is compared only when all columns are parsed, hence no pruning.
    """
    return {
        "header": True,
        "sep": delimiter,
        "multiLine": multiline,
        **CSV_QUOTES,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": RAW,
        "columnPruning": False,
    }


def wide_csv_schema(schema: T.StructType) -> T.StructType:
    """The schema with one column for a field too many and one for raw text."""
    return T.StructType(
        [*schema.fields, T.StructField(OVERFLOW, T.StringType()), T.StructField(RAW, T.StringType())]
    )


def fitting_lines(rows: DataFrame, fields: int, delimiter: str = ",") -> DataFrame:
    """Lines of no more than ``fields`` fields, read with a wide schema.

    A line with exactly one field too many fills the overflow column and leaves no raw text.
    """
    fits = F.col(OVERFLOW).isNull() & F.col(RAW).isNotNull() & (_field_count(F.col(RAW), delimiter) <= fields)
    return rows.filter(fits).drop(OVERFLOW, RAW)


def _field_count(line: Column, delimiter: str) -> Column:
    bare = F.regexp_replace(line, '"(?:[^"]|"")*"', "")
    mark = re.escape(delimiter)
    return (F.length(bare) - F.length(F.regexp_replace(bare, mark, ""))) / len(delimiter) + 1


def sample(df: DataFrame, rows: int = OBJECT_SAMPLE) -> DataFrame:
    """First rows of a dataset, for schema inference."""
    return df.limit(rows)


def sampled_text_schema(
    spark: SparkSession, path: str, file_type: str, rows: int | None = OBJECT_SAMPLE, delimiter: str = ","
) -> T.StructType:
    """Schema of JSON-lines or CSV text inferred from its first rows, or from all if ``rows`` is None. This runs a job.

    The first rows are taken from as few files as hold them. Fields that only occur later are not in the
    schema, so a reader that is given it leaves them out.
    """
    if rows is None:
        if file_type == "csv":
            return spark.read.options(header=True, inferSchema=True, sep=delimiter, multiLine=True, **CSV_QUOTES).csv(path).schema
        return spark.read.json(path).schema
    lines = spark.read.text(path).take(rows + 1 if file_type == "csv" else rows)
    text = spark.sparkContext.parallelize([r[0] for r in lines], 1)
    if file_type == "csv":
        return spark.read.options(header=True, inferSchema=True, sep=delimiter, **CSV_QUOTES).csv(text).schema
    return spark.read.json(text).schema


def matching_tables(spark: SparkSession, names: Sequence[str], database: str | None = None) -> list[str]:
    """Tables and views of a database with one of the names; ``*`` stands for any text.

    No names means all tables.
    """
    found: dict[str, None] = {}
    for name in names or ["*"]:
        for table in spark.catalog.listTables(database, name):
            if not names or _matches(name, table.name):
                found[table.name] = None
    return list(found)


def _matches(pattern: str, name: str) -> bool:
    parts = [re.escape(p) for p in pattern.split("*")]
    return re.fullmatch(".*".join(parts), name, re.IGNORECASE) is not None


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def computed_dataset(spark: SparkSession, query: str, view: str | None = None) -> DataFrame:
    """A SQL query as a dataset, and as a temporary view if it is given a name."""
    df = spark.sql(query.strip().removesuffix(";"))
    if view:
        df.createOrReplaceTempView(view)
    return df

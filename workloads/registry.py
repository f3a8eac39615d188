"""Query registry and small helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqspark.plans.joins import quoted
from dqspark.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function, under its own name if no other is given, with its SQL if it has one."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(use_utc(spark), sf_dir)

        QUERIES[name or fn.__name__] = run
        if oracle:
            ORACLES[name or fn.__name__] = oracle.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Digits that survive another order of summation; means of event values are small and keep more, so
# that no mean of two-digit values over a power of two lies halfway.
DIGITS = {"mean": 6, "std": 6, "sum": 2, "m2": 2}
EVENT_MEAN_DIGITS = 10


def rounded(df: DataFrame) -> DataFrame:
    """Doubles rounded by the kind of metric."""
    out = []
    for f in df.schema.fields:
        c = F.col(quoted(f.name))
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            kind = f.name.partition("|")[0]
            digits = EVENT_MEAN_DIGITS if f.name == "mean|value" else DIGITS.get(kind, 4)
            c = F.round(c, digits)
        out.append(c.alias(f.name))
    return df.select(*out)

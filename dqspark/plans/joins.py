"""Join shapes shared by several operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqspark.plans.bounds import MAX_BROADCAST_ROWS, is_bounded

BUCKETS_PER_WINDOW = 64
SALT = 16
UNHASHED = (T.MapType, T.VariantType)


def quoted(name: str) -> str:
    """Back-tick a column name that may hold dots or bars."""
    return "`" + name.replace("`", "``") + "`"


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other; the keys appear once in the result."""
    a, b = left.alias("l"), right.alias("r")
    condition = reduce(
        lambda x, y: x & y, [F.col(f"l.{quoted(k)}").eqNullSafe(F.col(f"r.{quoted(k)}")) for k in keys]
    )
    columns = [F.col(f"l.{quoted(c)}").alias(c) for c in left.columns]
    columns += [F.col(f"r.{quoted(c)}").alias(c) for c in right.columns if c not in keys]
    return a.join(b, condition, how).select(*columns)


def epoch_seconds(df: DataFrame, column: str) -> Column:
    """Whole epoch seconds of a timestamp, date or numeric epoch column."""
    kind, c = df.schema[column].dataType, F.col(quoted(column))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_seconds(c.cast("timestamp"))
    return F.floor(c.cast("double")).cast("long")


def time_bound(df: DataFrame, column: str, epoch: int) -> Column:
    """Literal of the column's own type for an epoch second, so that a comparison stays pushable.

    For dates the bound is the first date whose midnight is at or after ``epoch``.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampType):
        return F.timestamp_seconds(F.lit(int(epoch)))
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_seconds(F.lit(int(epoch))).cast("timestamp_ntz")
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(F.lit(-(-int(epoch) // 86400)))
    return F.lit(int(epoch))


def in_time_range(df: DataFrame, column: str, start: int, end: int) -> Column:
    """``start <= column < end`` on the bare column."""
    c = F.col(quoted(column))
    return (c >= time_bound(df, column, start)) & (c < time_bound(df, column, end))


def windows_frame(spark: SparkSession, times: Sequence[int], lookback: int) -> DataFrame:
    """One row per evaluation time: ``_window_start`` and ``_window_end`` in epoch seconds."""
    rows = [(int(t) - int(lookback), int(t)) for t in sorted(set(times))]
    return spark.createDataFrame(rows, "_window_start bigint, _window_end bigint")


def salted_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", salt: int = SALT
) -> DataFrame:
    """Equi-join of ``left`` with a smaller ``right``, hot keys of ``left`` being spread.

    Rows of ``left`` are spread over ``salt`` sub-keys by a hash of the whole row and of the input
    partition, so that copies of one row part too and a task that runs again gives the same sub-keys.
    Those of ``right`` are repeated for each. ``how`` is ``inner`` or ``left``; NULL keys match.
    """
    if how not in ("inner", "left"):
        raise ValueError("a salted join is inner or left")
    row = [F.col(quoted(c)) for c in left.columns if not isinstance(left.schema[c].dataType, UNHASHED)]
    spread = F.pmod(F.xxhash64(*row, F.spark_partition_id()), F.lit(salt)).cast("int")
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return null_safe_join(left.withColumn("_salt", spread), repeated, [*keys, "_salt"], how).drop("_salt")


def lookup_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", small: bool | None = None
) -> DataFrame:
    """Join with a side that usually is small: broadcast where its size passes, else salted."""
    if is_bounded(right) if small is None else small:
        return null_safe_join(left, F.broadcast(right), keys, how)
    return salted_join(left, right, keys, how)


def interval_join(
    data: DataFrame,
    windows: DataFrame,
    timestamp: str,
    lookback: int,
    small: bool | None = None,
    salt: int = SALT,
) -> DataFrame:
    """Rows of ``data`` paired with every window ``[_window_start, _window_end)`` holding them.

    Windows are spread over time buckets and joined on the bucket, then the exact predicate is
    applied, so the plan is an equi-join on any size of either side. A width of ``lookback / 64``
    keeps the candidates within 2% of the matches. Windows that pass the size check are broadcast and
    the data stay where they are; otherwise each bucket is spread over ``salt`` sub-keys, as one
    stretch of time may hold much of the data.
    """
    width = max(1, -(-int(lookback) // BUCKETS_PER_WINDOW))
    if small is None:
        small = is_bounded(windows, max_rows=MAX_BROADCAST_ROWS // (BUCKETS_PER_WINDOW + 2))
    buckets = windows.filter(F.col("_window_end") > F.col("_window_start")).withColumn(
        "_bucket",
        F.explode(
            F.sequence(
                F.floor(F.col("_window_start") / width), F.floor((F.col("_window_end") - 1) / width)
            )
        ),
    )
    rows = data.withColumn("_epoch", epoch_seconds(data, timestamp))
    rows = rows.withColumn("_bucket", F.floor(F.col("_epoch") / width)).filter(F.col("_bucket").isNotNull())
    if small:
        pairs = rows.join(F.broadcast(buckets), "_bucket")
    else:
        pairs = salted_join(rows, buckets, ["_bucket"], salt=salt)
    return pairs.filter(
        (F.col("_epoch") >= F.col("_window_start")) & (F.col("_epoch") < F.col("_window_end"))
    ).drop("_bucket", "_epoch")

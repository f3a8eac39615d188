"""Size checks that must pass before a side of a join is broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def is_bounded(
    df: DataFrame,
    row_bytes: Column | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows weighing at most ``max_bytes``.

    Takes the weights of ``max_rows + 1`` rows to the driver, from no more partitions than it needs:
    a limit inside a query would read that many rows of every partition. This runs jobs.
    """
    weight = row_bytes if row_bytes is not None else _row_bytes(df)
    weights = df.select(weight.cast("bigint").alias("w")).take(max_rows + 1)
    return len(weights) <= max_rows and sum(r["w"] or 0 for r in weights) <= max_bytes


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: texts and bytes by their length, nested values by that of their JSON."""
    total = F.lit(16)
    for f in df.schema.fields:
        c = F.col("`" + f.name.replace("`", "``") + "`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + 16 + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            total = total + 16 + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        else:
            total = total + 16
    return total

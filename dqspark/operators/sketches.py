"""Mergeable distinct-count and quantile sketches, and exact counterparts at scale."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from dqspark.plans.bounds import MAX_BROADCAST_ROWS
from dqspark.plans.joins import lookup_join, null_safe_join, quoted
from dqspark.plans.storage import stored

HLL_LG_K = 12


def distinct_sketch(c: Column, lg_k: int = HLL_LG_K) -> Column:
    """Distinct-count sketch of any column, over its text form."""
    return F.hll_sketch_agg(c.cast("string"), F.lit(lg_k))


def merge_distinct(sketch: Column) -> Column:
    return F.hll_union_agg(sketch, True)


def distinct_estimate(sketch: Column) -> Column:
    return F.hll_sketch_estimate(sketch)


def quantile_sketch(column: str) -> Column:
    """Quantile sketch of a numeric column."""
    return F.expr(f"kll_sketch_agg_double(try_cast({quoted(column)} AS double))")


def merge_quantile(sketch_column: str) -> Column:
    return F.expr(f"kll_merge_agg_double({quoted(sketch_column)})")


def quantile_estimate(sketch_column: str, p: float) -> Column:
    return F.expr(f"kll_sketch_get_quantile_double({quoted(sketch_column)}, {float(p)}D)")


# Distinct values of a group that one task may rank, unless no bracket can be narrower.
DIRECT_VALUES = 2**20

# Sketches of the values within a bracket: their size, an upper bound of their rank error at that size, and the
# number of quantiles that are read off them.
KLL_K, RANK_ERROR, GRID = 800, 0.01, 200
MAX_ROUNDS = 12


def exact_percentile(
    df: DataFrame, value: str, p: float, by: Sequence[str] = (), direct: int = DIRECT_VALUES
) -> DataFrame:
    """Interpolated percentile per group, exact, for groups of any size.

    Selection by brackets. A scan sketches the values of each group, and the sketch gives a bracket that holds the
    wanted ranks. The next scan counts what lies below the bracket and sketches what lies within, and so on, until
    about ``direct`` values or a single one are left; a last scan keeps only these, with their counts, and ranks them.
    Each scan narrows a bracket some fifty times, so up to fifty million rows a group take two. Counts are exact, so a
    bracket that misses a rank is found out, and widened. Tasks send one row a group, and at last the values within.
    NULL and NaN are left out; a group without values has a NULL ``percentile``. This runs a job for each scan.
    """
    number = F.nullif(F.col(quoted(value)).try_cast("double"), F.lit(float("nan")))
    groups = [F.col(quoted(c)) for c in by]
    rows = df.select(F.struct(*groups, F.lit(0).alias("_all")).alias("_g"), (number + 0.0).alias("_v"))
    sketch = F.expr(f"kll_sketch_agg_double(_v, {KLL_K})")
    totals = rows.groupBy("_g").agg(F.count("_v").alias("_inside"), sketch.alias("_sketch"))
    rank = F.lit(float(p)) * (F.col("_n") - 1)
    state = totals.withColumn("_n", F.col("_inside")).select(
        "_g", "_n", F.lit(0).cast("bigint").alias("_below"), "_inside", "_sketch",
        F.lit(float("-inf")).alias("_low"), F.lit(float("inf")).alias("_high"), rank.alias("_r"),
    )
    margin, values = RANK_ERROR, F.col("_v").isNotNull()
    state, size = _narrowed(state, margin, direct)
    all_groups = state.select("_g")
    few = size["groups"] <= MAX_BROADCAST_ROWS // 2
    state = state.filter("_n > 0")
    brackets = ["_g", "_n", "_r", "_low", "_high"]

    def bracketed() -> DataFrame:
        return lookup_join(rows.filter(values), state.select(brackets), ["_g"], "inner", few).filter("_v <= _high")

    for _ in range(MAX_ROUNDS):
        if not size["wide"]:
            kept = bracketed().withColumn("_v", F.when(F.col("_v") >= F.col("_low"), F.col("_v")))
            kept = stored(kept.groupBy(*brackets, "_v").agg(F.count(F.lit(1)).alias("_n_v")), "bracketed")
            found = _ranked(kept)
            if not found.filter("missed").take(1):
                break
        inside = F.col("_v") >= F.col("_low")
        again = bracketed().groupBy(*brackets).agg(
            F.count_if(~inside).alias("_below"),
            F.count_if(inside).alias("_inside"),
            F.expr(f"kll_sketch_agg_double(CASE WHEN _v >= _low THEN _v END, {KLL_K})").alias("_sketch"),
        )
        margin = margin if size["wide"] else 1.0
        state, size = _narrowed(again, margin, direct)
    else:
        raise RuntimeError("no bracket was found")
    result = null_safe_join(all_groups, found.select("_g", "percentile"), ["_g"], "left")
    return result.select(*[F.col("_g").getField(c).alias(c) for c in by], "percentile")


def _narrowed(state: DataFrame, margin: float, direct: int) -> tuple[DataFrame, Row]:
    """The next bracket of each group; the number of groups, and of those whose bracket is still to be narrowed.

    A bracket that has lost a rank, by the exact counts, is opened to the whole again.
    """
    grid = ", ".join(f"{i / GRID}D" for i in range(GRID + 1))
    quantiles = F.when(F.col("_inside") > 0, F.expr(f"kll_sketch_get_quantile_double(_sketch, array({grid}))"))
    first = F.try_divide(F.floor(F.col("_r")) - F.col("_below"), F.col("_inside"))
    last = F.try_divide(F.ceil(F.col("_r")) + 1 - F.col("_below"), F.col("_inside"))
    lost = (first < 0) | (last > 1)
    low = F.floor((first - margin) * GRID).cast("int")
    high = F.ceil((last + margin) * GRID).cast("int")
    steps = state.withColumn("_q", quantiles).withColumns({"_from": low, "_to": high, "_lost": F.coalesce(lost, F.lit(True))})
    # At an end of the grid the bracket stays as it was: a sketch's ends are the ends of what it saw.
    next_low = F.when(F.col("_lost"), F.lit(float("-inf"))).when(F.col("_from") <= 0, F.col("_low")).otherwise(F.get("_q", F.col("_from")))
    next_high = F.when(F.col("_lost"), F.lit(float("inf"))).when(F.col("_to") >= GRID, F.col("_high")).otherwise(F.get("_q", F.col("_to")))
    kept = F.least(F.col("_to"), F.lit(GRID)) - F.greatest(F.col("_from"), F.lit(0))
    within = F.when(F.col("_lost"), F.col("_n")).otherwise(F.col("_inside") * kept / GRID)
    steps = steps.withColumns({"_next_low": next_low, "_next_high": next_high, "_within": within})
    moved = (F.col("_next_low") > F.col("_low")) | (F.col("_next_high") < F.col("_high")) | F.col("_lost")
    wide = (F.col("_within") > direct) & (F.col("_next_low") < F.col("_next_high")) & moved
    out = stored(
        steps.select("_g", "_n", "_r", F.col("_next_low").alias("_low"), F.col("_next_high").alias("_high"), wide.alias("_wide")),
        "brackets",
    )
    return out.drop("_wide"), out.agg(F.count(F.lit(1)).alias("groups"), F.count_if("_wide").alias("wide")).first()


def _ranked(kept: DataFrame) -> DataFrame:
    """``(_g, percentile, missed)`` from the counts of the values within each bracket, NULL standing for those below."""
    order = Window.partitionBy("_g").orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    rows = kept.withColumn("_end", F.sum("_n_v").over(order))

    def at(rank: Column) -> Column:
        here = (rank >= F.col("_end") - F.col("_n_v")) & (rank < F.col("_end"))
        return F.max(F.when(here, F.col("_v")))

    found = rows.groupBy("_g").agg(
        at(F.floor("_r")).alias("_lo"), at(F.ceil("_r")).alias("_hi"), F.max(F.col("_r") - F.floor("_r")).alias("_share")
    )
    lo, hi = F.col("_lo"), F.col("_hi")
    value = F.when(lo == hi, lo).otherwise(lo + F.col("_share") * (hi - lo))
    return found.select("_g", value.alias("percentile"), (lo.isNull() | hi.isNull()).alias("missed"))


def exact_distinct(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact number of distinct values per group; values are deduplicated before any group meets."""
    keys = [F.col(quoted(c)) for c in by]
    count = F.count_distinct(F.col(quoted(value))).alias("distinct_count")
    return df.groupBy(*keys).agg(count) if keys else df.agg(count)


def with_sketches(
    df: DataFrame,
    by: Sequence[str],
    distinct: Sequence[str] = (),
    quantiles: Sequence[str] = (),
) -> DataFrame:
    """Per group: size, ``hll|<column>`` and ``kll|<column>`` sketches, ready for roll-ups."""
    exprs = [F.count(F.lit(1)).alias("total_group_count")]
    exprs += [distinct_sketch(F.col(quoted(c))).alias(f"hll|{c}") for c in distinct]
    exprs += [quantile_sketch(c).alias(f"kll|{c}") for c in quantiles]
    return df.groupBy(*[F.col(quoted(c)) for c in by]).agg(*exprs)

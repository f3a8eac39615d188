"""Geometry dimensions over points and shapes built from the events' user ids."""

from __future__ import annotations

import struct

from pyspark.sql import functions as F

from dqspark.functions.wkb import centroid, geometry_type
from dqspark.operators import geo
from dqspark.operators.profile import profile
from workloads.registry import query, rounded, table

GRID = 16


def _hex_of_halves(order: str):
    """Hex text of the doubles 0, 0.5, 1, …, up to the edge of the grid, at twice their value."""
    return F.array(*[F.lit(struct.pack(order + "d", i / 2).hex()) for i in range(2 * GRID + 4)])


def _uint(order: str, value: int) -> str:
    return struct.pack(order + "I", value).hex()


def shapes(spark, sf_dir):
    """Events with a WKB geometry centred on their user: point, line or square, either byte order."""
    rows = (
        table(spark, sf_dir, "events")
        .withColumn("cx", F.col("user_id") % GRID)
        .withColumn("cy", F.floor(F.col("user_id") / GRID) % GRID)
    )

    def build(order: str):
        digits, flag = _hex_of_halves(order), "01" if order == "<" else "00"
        x, y = F.col("cx") * 2 + 1, F.col("cy") * 2 + 1

        def at(dx: int, dy: int):
            return F.concat(F.get(digits, (x + dx).cast("int")), F.get(digits, (y + dy).cast("int")))

        point = F.concat(F.lit(flag + _uint(order, 1)), at(0, 0))
        line = F.concat(F.lit(flag + _uint(order, 2) + _uint(order, 2)), at(-1, 0), at(1, 0))
        square = F.concat(
            F.lit(flag + _uint(order, 3) + _uint(order, 1) + _uint(order, 5)),
            at(-1, -1), at(1, -1), at(1, 1), at(-1, 1), at(-1, -1),
        )
        kind = F.col("event_id") % 3
        return F.when(kind == 0, point).when(kind == 1, line).otherwise(square)

    little = F.col("user_id") % 2 == 0
    return rows.withColumn("shape", F.unhex(F.when(little, build("<")).otherwise(build(">"))))


def squares(spark, sf_dir):
    """One square of side 3 per nation, in rows of five."""
    key = F.col("n_nationkey")
    x0, y0 = (key % 5 * 3).cast("double"), (F.floor(key / 5) * 3).cast("double")
    # The first nation's square is twice as wide and covers its neighbour's, too.
    x1, y1 = x0 + F.when(key == 0, 6.0).otherwise(3.0), y0 + 3.0

    def corner(x, y):
        return F.struct(x.alias("x"), y.alias("y"))

    ring = F.array(corner(x0, y0), corner(x1, y0), corner(x1, y1), corner(x0, y1), corner(x0, y0))
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.array(ring).alias("rings"))


TYPE_SQL = "CASE event_id % 3 WHEN 0 THEN 'Point' WHEN 1 THEN 'LineString' ELSE 'Polygon' END"
PLACED_SQL = """
placed AS (
  SELECT e.event_id, min(n_name) AS name FROM (
    SELECT event_id, user_id % 16 + 0.5 AS x, (user_id // 16) % 16 + 0.5 AS y FROM events) e
  JOIN (SELECT n_name, n_nationkey % 5 * 3 AS x0, n_nationkey // 5 * 3 AS y0,
    CASE WHEN n_nationkey = 0 THEN 6 ELSE 3 END AS w FROM nation) n
  ON x >= x0 AND x < x0 + w AND y >= y0 AND y < y0 + 3
  GROUP BY 1)
"""


@query(f"""
SELECT event_type, {TYPE_SQL} AS geo_type, count(*) AS records FROM events GROUP BY 1, 2
""")
def geo_type(spark, sf_dir):
    return (
        shapes(spark, sf_dir)
        .groupBy("event_type", geometry_type(F.col("shape")).alias("geo_type"))
        .agg(F.count(F.lit(1)).alias("records"))
    )


@query("""
SELECT event_id, user_id % 16 + 0.5::DOUBLE AS x, (user_id // 16) % 16 + 0.5::DOUBLE AS y FROM events
""")
def geo_centroid(spark, sf_dir):
    center = shapes(spark, sf_dir).select("event_id", centroid(F.col("shape")).alias("c"))
    return center.select("event_id", F.round("c.x", 9).alias("x"), F.round("c.y", 9).alias("y"))


def _placed(spark, sf_dir, small):
    points = table(spark, sf_dir, "events").select(
        "event_id",
        (F.col("user_id") % GRID + 0.5).alias("x"),
        (F.floor(F.col("user_id") / GRID) % GRID + 0.5).alias("y"),
    )
    placed = geo.region_of(points, squares(spark, sf_dir), "x", "y", "place", cell=2.0, small=small)
    return placed.groupBy("place").agg(F.count(F.lit(1)).alias("records"))


COUNTED_SQL = f"""
WITH {PLACED_SQL}
SELECT coalesce(name, '<empty>') AS place, count(*) AS records
FROM events LEFT JOIN placed USING (event_id) GROUP BY 1
"""


@query(COUNTED_SQL)
def geo_join(spark, sf_dir):
    return _placed(spark, sf_dir, None)


@query(COUNTED_SQL)
def geo_join_large(spark, sf_dir):
    return _placed(spark, sf_dir, False)


@query(f"""
WITH {PLACED_SQL},
t AS (SELECT {TYPE_SQL} AS t, coalesce(name, '<empty>') AS s, value,
    CASE WHEN name IS NULL THEN '<empty>' ELSE 'C' || replace(name, 'NATION_', '') END AS c
  FROM events LEFT JOIN placed USING (event_id))
SELECT t AS shape_geo_type, s AS shape_geo_state, c AS shape_geo_country, count(value) AS "count|value",
  round(sum(value), 2) AS "sum|value", count(*) AS total_group_count
FROM t GROUP BY 1, 2, 3
""")
def geo_dimensions(spark, sf_dir):
    regions = squares(spark, sf_dir)
    codes = table(spark, sf_dir, "nation").select(
        F.lit(None).cast("string").alias("official_name"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("C"), F.regexp_replace("n_name", "NATION_", "")).alias("code"),
    )
    result = profile(
        shapes(spark, sf_dir), {"wkb": ["shape"]}, numbers=["value"], keyed=False,
        states=regions, countries=regions, country_codes=codes,
    )
    names = [*result.dimensions, "count|value", "sum|value", "total_group_count"]
    return rounded(result.metrics.select(*[f"`{n}`" for n in names]))

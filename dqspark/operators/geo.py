"""Geometry dimensions: type, and the region that holds the centroid."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqspark.functions.columns import EMPTY_LABEL
from dqspark.functions.wkb import centroid, geometry_type
from dqspark.operators.lookup import code_lookup
from dqspark.plans.bounds import is_bounded
from dqspark.plans.joins import quoted, salted_join
from dqspark.plans.storage import stored

OUTPUTS = ("type", "state", "country")


LEAST_CELLS, MOST_CELLS, CELLS_PER_EDGE = 256, 32_768, 2

# Cell borders and reference lines lie where no coordinates are likely to be, in parts of a cell.
OFFSET_X, OFFSET_Y, REFERENCE = 0.3819660112501051, 0.2360679774997897, 0.4142135623730951


@dataclass
class RegionCells:
    """Regions cut into grid cells: rows ``_cx, _cy, _regions``, an array by name of what each region has in the cell.

    A region has ``odd``, whether the cell's reference point is within it, and the ``edges`` that meet the cell. A
    cell wholly within a region has no edges, one wholly outside is left out.
    """

    cells: DataFrame
    cell: float
    small: bool

    def place(self, x: Column, y: Column) -> dict[str, Column]:
        return {"_cx": _index(x, OFFSET_X, self.cell), "_cy": _index(y, OFFSET_Y, self.cell)}


def _index(v: Column, offset: float, cell: float) -> Column:
    return F.floor(v / cell - offset)


def _border(index: Column, offset: float, cell: float) -> Column:
    """Where a cell begins."""
    return (index + offset) * cell


def _crossing(e: Column, y: Column) -> Column:
    """The x at which an edge passes the height ``y``."""
    ax, ay, bx, by = (e.getField(f) for f in ("ax", "ay", "bx", "by"))
    return (bx - ax) * (y - ay) / F.nullif(by - ay, F.lit(0.0)) + ax


def _passes(e: Column, y: Column) -> Column:
    return (e.getField("ay") > y) != (e.getField("by") > y)


def prepare_regions(regions: DataFrame, cell: float | None = None, small: bool | None = None) -> RegionCells:
    """Cut regions into cells once, for any number of :func:`region_of`.

    Without ``cell`` the size is taken from the regions' extents and corners: some two cells for each edge. Each cell
    holds only the edges that meet it, so a region of many corners weighs little more cut than whole. ``small`` says
    whether the cells may be broadcast; it is found by a size check of the cells. This runs jobs.
    """
    corners = F.flatten("rings")
    numbered = stored(
        regions.select("name", "rings").filter(F.size(corners) > 0).withColumn("_rid", F.monotonically_increasing_id()), "regions"
    )
    if cell is None:
        cell = _cell_size(numbered)
    edges = numbered.select("_rid", "name", F.explode(_all_edges()).alias("e"))

    def low(a: str, b: str) -> Column:
        return F.least(F.col(f"e.{a}"), F.col(f"e.{b}"))

    def high(a: str, b: str) -> Column:
        return F.greatest(F.col(f"e.{a}"), F.col(f"e.{b}"))

    # By rows of the grid first: the stretch of an edge within a row says which cells of the row it meets.
    slack = F.lit(1e-6)
    first = F.floor(low("ay", "by") / cell - OFFSET_Y - slack)
    last = F.floor(high("ay", "by") / cell - OFFSET_Y + slack)
    rows = edges.withColumn("_cy", F.explode(F.sequence(first, last)))
    south, north = _border(F.col("_cy"), OFFSET_Y, cell), _border(F.col("_cy") + 1, OFFSET_Y, cell)
    edge = F.col("e")
    level = F.col("e.ay") == F.col("e.by")
    one = _crossing(edge, F.greatest(low("ay", "by"), south))
    two = _crossing(edge, F.least(high("ay", "by"), north))
    rows = rows.withColumns({
        "_west": F.when(level, low("ax", "bx")).otherwise(F.greatest(F.least(one, two), low("ax", "bx"))),
        "_east": F.when(level, high("ax", "bx")).otherwise(F.least(F.greatest(one, two), high("ax", "bx"))),
        "_line": _border(F.col("_cy") + REFERENCE, OFFSET_Y, cell),
    })
    span = F.sequence(F.floor(F.col("_west") / cell - OFFSET_X - slack), F.floor(F.col("_east") / cell - OFFSET_X + slack))
    met = rows.withColumn("_cx", F.explode(span)).groupBy("_rid", "name", "_cx", "_cy").agg(F.collect_list("e").alias("edges"))
    # Between the crossings of a row's reference line lie the cells whose reference point, at the east end, is within.
    crossed = rows.filter(_passes(edge, F.col("_line"))).groupBy("_rid", "name", "_cy").agg(
        F.sort_array(F.collect_list(_crossing(edge, F.col("_line"))), asc=False).alias("_xs")
    )
    pairs = F.transform(
        F.sequence(F.lit(0), (F.size("_xs") / 2).cast("int") - 1),
        lambda i: F.struct(F.get("_xs", i * 2 + 1).alias("lo"), F.get("_xs", i * 2).alias("hi")),
    )
    between = crossed.filter(F.size("_xs") > 1).select("_rid", "name", "_cy", F.explode(pairs).alias("p"))
    first, last = (F.floor(F.col(f"p.{end}") / cell - OFFSET_X) for end in ("lo", "hi"))
    inside = between.withColumn("_cx", F.explode(F.sequence(first - 1, last)))
    east = _border(F.col("_cx") + 1, OFFSET_X, cell)
    inside = inside.filter((east >= F.col("p.lo")) & (east < F.col("p.hi"))).select("_rid", "name", "_cx", "_cy", F.lit(True).alias("odd"))
    both = met.join(inside, ["_rid", "name", "_cx", "_cy"], "full")
    region = F.struct("name", F.coalesce("odd", F.lit(False)).alias("odd"), F.coalesce("edges", F.array().cast(_EDGES)).alias("edges"))
    gathered = both.groupBy("_cx", "_cy").agg(F.array_sort(F.collect_list(region)).alias("_regions"))
    cells = stored(gathered, "cells")
    return RegionCells(cells, cell, is_bounded(cells, _cell_bytes()) if small is None else small)


_EDGES = "array<struct<ax:double,ay:double,bx:double,by:double>>"


def _cell_bytes() -> Column:
    each = F.transform("_regions", lambda r: F.size(r["edges"]) * 32 + F.octet_length(r["name"]) + 48)
    return F.aggregate(each, F.lit(32), lambda a, b: a + b)


def _all_edges() -> Column:
    return F.flatten(F.transform(F.filter("rings", lambda r: F.size(r) > 1), _ring_edges))


def _ring_edges(ring: Column) -> Column:
    pairs = F.arrays_zip(
        F.slice(ring, F.lit(1), F.size(ring) - 1).alias("a"), F.slice(ring, F.lit(2), F.size(ring) - 1).alias("b")
    )
    return F.transform(
        pairs,
        lambda e: F.struct(
            *[e[end][axis].cast("double").alias(end + axis) for end in ("a", "b") for axis in ("x", "y")]
        ),
    )


def _cell_size(regions: DataFrame) -> float:
    """A size at which the cells of all regions' extents, and those that an edge meets, are a few for each edge."""
    shaped = regions.withColumn("_c", F.flatten("rings")).withColumn("_e", _all_edges())

    def extent(axis: str) -> Column:
        values = F.transform("_c", lambda p: p.getField(axis).cast("double"))
        return F.array_max(values) - F.array_min(values)

    def length(e: Column) -> Column:
        return F.abs(e["bx"] - e["ax"]) + F.abs(e["by"] - e["ay"])

    width, height = extent("x"), extent("y")
    lengths = F.aggregate(F.transform("_e", length), F.lit(0.0), lambda a, b: a + b)
    sums = shaped.agg(F.sum(width * height), F.sum(width + height), F.sum(F.size("_e")), F.sum(lengths)).first()
    area, around, edges, long = (v or 0 for v in sums)
    wanted = min(max(CELLS_PER_EDGE * edges, LEAST_CELLS), MOST_CELLS)
    return max(math.sqrt(area / wanted), around / wanted, long / (2 * CELLS_PER_EDGE * max(edges, 1)), 1e-9)


def region_of(
    points: DataFrame,
    regions: DataFrame | RegionCells,
    x: str,
    y: str,
    output: str,
    cell: float | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Add the name of the region a point lies within; ``<empty>`` where there is none.

    ``regions`` holds ``name`` and ``rings``, an array of closed rings, each an array of ``x, y``
    structs, or is the result of :func:`prepare_regions`; points inside an odd number of rings are within. Both
    sides must use the same coordinates. A point in several regions takes the smallest name.

    Points are joined with the regions on their grid cell, and compared with the edges in that cell only. Cells
    that pass the size check are broadcast, so the points are not shuffled. Otherwise they are joined to the distinct
    points, and the names found are joined back, both with the points salted. Preparing regions runs jobs.
    """
    cut = regions if isinstance(regions, RegionCells) else prepare_regions(regions, cell, small)
    px, py = F.col(quoted(x)).cast("double"), F.col(quoted(y)).cast("double")
    here = cut.place(px, py)

    def name(cx: Column, cy: Column) -> Column:
        return F.get(F.filter("_regions", lambda r: _within(r, px, py, cx, cy, cut.cell)), F.lit(0)).getField("name")

    if cut.small:
        located = points.withColumns(here).join(F.broadcast(cut.cells), ["_cx", "_cy"], "left")
        found = F.coalesce(name(F.col("_cx"), F.col("_cy")), F.lit(EMPTY_LABEL))
        return located.withColumn(output, found).drop("_cx", "_cy", "_regions")
    distinct = points.select(F.col(quoted(x)).alias(x), F.col(quoted(y)).alias(y)).distinct()
    located = distinct.withColumns(here).filter(F.col("_cx").isNotNull() & F.col("_cy").isNotNull())
    found = salted_join(located, cut.cells, ["_cx", "_cy"]).withColumn(output, name(F.col("_cx"), F.col("_cy")))
    found = found.filter(F.col(quoted(output)).isNotNull()).select(quoted(x), quoted(y), quoted(output))
    return salted_join(points, found, [x, y], "left").withColumn(
        output, F.coalesce(F.col(quoted(output)), F.lit(EMPTY_LABEL))
    )


def _within(region: Column, x: Column, y: Column, cx: Column, cy: Column, cell: float) -> Column:
    """Whether the way from the point to the cell's reference point, east and then up or down, changes sides.

    Both legs stay in the cell, so only its edges can be crossed. Points on an edge go by the rule of a ray to the
    east: the lower and the west edge belong to a region.
    """
    east, line = _border(cx + 1, OFFSET_X, cell), _border(cy + REFERENCE, OFFSET_Y, cell)

    def crossed(e: Column) -> Column:
        along = _crossing(e, y)
        ax, ay, bx, by = (e.getField(f) for f in ("ax", "ay", "bx", "by"))
        above = (by - ay) * (east - ax) / F.nullif(bx - ax, F.lit(0.0)) + ay
        flat = _passes(e, y) & (x < along) & (along <= east)
        steep = ((ax > east) != (bx > east)) & ((above > y) != (above > line))
        return flat != steep

    edges = region.getField("edges")
    changes = F.when(F.size(edges) == 0, F.lit(0)).otherwise(F.size(F.filter(edges, crossed)))
    return region.getField("odd") != (changes % 2 == 1)


def geometry_dimensions(
    df: DataFrame,
    column: str,
    outputs: Sequence[str] = (),
    states: DataFrame | RegionCells | None = None,
    countries: DataFrame | RegionCells | None = None,
    country_codes: DataFrame | None = None,
) -> tuple[DataFrame, list[str]]:
    """Add ``<column>_geo_type``, ``_geo_state`` and ``_geo_country`` from a WKB column.

    Unknown output names are ignored; if none is left, all three are made. State and country need
    their boundary table, or what :func:`prepare_regions` made of it; one table given for both is prepared once.
    Country names are turned into codes where a code table is given.
    """
    wanted = [o for o in OUTPUTS if o in outputs] or list(OUTPUTS)
    names, source = [f"{column}_geo_{o}" for o in wanted], F.col(quoted(column))
    if column not in df.columns:
        return df, names
    if "type" in wanted:
        kind = F.coalesce(geometry_type(source), F.lit(EMPTY_LABEL))
        df = df.withColumn(f"{column}_geo_type", kind)
    if "state" in wanted or "country" in wanted:
        df = df.withColumn("_center", centroid(source))
        df = df.withColumn("_x", F.col("_center.x")).withColumn("_y", F.col("_center.y")).drop("_center")
        if states is countries and isinstance(states, DataFrame):
            states = countries = prepare_regions(states)
        for kind, regions in (("state", states), ("country", countries)):
            if kind not in wanted:
                continue
            if regions is None:
                raise ValueError(f"the {kind} output needs a table of {kind} boundaries")
            df = region_of(df, regions, "_x", "_y", f"{column}_geo_{kind}")
        df = df.drop("_x", "_y")
        if "country" in wanted and country_codes is not None:
            df = code_lookup(df, f"{column}_geo_country", country_codes)
    return df, names

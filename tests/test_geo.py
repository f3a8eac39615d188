import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from dqspark.functions.wkb import centroid, geometry_type
from dqspark.operators import geo
from dqspark.operators.lookup import code_lookup
from dqspark.operators.profile import profile


def head(order, code):
    return (b"\x01" if order == "<" else b"\x00") + struct.pack(order + "I", code)


def path(order, points):
    return struct.pack(order + "I", len(points)) + b"".join(struct.pack(f"{order}{len(p)}d", *p) for p in points)


def point(order, *xy):
    return head(order, 1) + struct.pack(f"{order}{len(xy)}d", *xy)


def polygon(order, *rings):
    return head(order, 3) + struct.pack(order + "I", len(rings)) + b"".join(path(order, r) for r in rings)


def many(order, code, parts):
    return head(order, code) + struct.pack(order + "I", len(parts)) + b"".join(parts)


SQUARE = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
HOLE = [(2, 0), (4, 0), (4, 4), (2, 4), (2, 0)]
SHAPES = [
    (lambda o: point(o, 1, 2), "Point", (1, 2)),
    (lambda o: head(o, 2) + path(o, [(0, 0), (4, 0), (4, 2)]), "LineString", (16 / 6, 2 / 6)),
    (lambda o: polygon(o, SQUARE), "Polygon", (2, 2)),
    (lambda o: polygon(o, SQUARE[::-1]), "Polygon", (2, 2)),
    (lambda o: polygon(o, SQUARE, HOLE), "Polygon", (1, 2)),
    (lambda o: many(o, 4, [point(o, 0, 0), point(o, 2, 4)]), "MultiPoint", (1, 2)),
    (lambda o: many(o, 5, [head(o, 2) + path(o, [(0, 0), (2, 0)]), head(o, 2) + path(o, [(0, 2), (2, 2)])]),
     "MultiLineString", (1, 1)),
    (lambda o: many(o, 6, [polygon(o, SQUARE), polygon(o, [(x + 10, y) for x, y in SQUARE])]), "MultiPolygon", (7, 2)),
    (lambda o: many(o, 7, [point(o, 100, 100), polygon(o, SQUARE)]), "GeometryCollection", (2, 2)),
    (lambda o: head(o, 1001) + struct.pack(o + "3d", 1, 2, 9), "Point", (1, 2)),
    (lambda o: head(o, 0x20000001) + struct.pack(o + "I2d", 4326, 1, 2), "Point", (1, 2)),
    (lambda o: polygon(o, [(1, 1), (1, 1), (1, 1), (1, 1)]), "Polygon", (1, 1)),
    (lambda o: head(o, 2) + struct.pack(o + "I", 0), "LineString", None),
]


@pytest.mark.parametrize("order", ["<", ">"])
def test_type_and_centroid(spark, order):
    rows = [(i, bytearray(make(order))) for i, (make, _, _) in enumerate(SHAPES)]
    rows += [(100, None), (101, bytearray(b"\x01\x02")), (102, bytearray(b"\x07junkjunk"))]
    df = spark.createDataFrame(rows, "i int, g binary")
    got = {r["i"]: r for r in df.select("i", geometry_type(F.col("g")).alias("t"), centroid(F.col("g")).alias("c")).collect()}
    for i, (_, kind, center) in enumerate(SHAPES):
        assert got[i]["t"] == kind
        if center is None:
            assert got[i]["c"]["x"] is None
        else:
            assert (got[i]["c"]["x"], got[i]["c"]["y"]) == pytest.approx(center)
    assert all(got[i]["t"] is None and got[i]["c"]["x"] is None for i in (100, 101, 102))


def regions(spark):
    rows = [
        ("west", [SQUARE]), ("donut", [[(10, 0), (14, 0), (14, 4), (10, 4), (10, 0)], [(11, 1), (13, 1), (13, 3), (11, 3), (11, 1)]]),
        ("all", [[(0, 0), (14, 0), (14, 1), (0, 1), (0, 0)]]), ("empty", []),
    ]
    rows = [(n, [[(float(x), float(y)) for x, y in r] for r in rings]) for n, rings in rows]
    return spark.createDataFrame(rows, "name string, rings array<array<struct<x: double, y: double>>>")


@pytest.mark.parametrize("small", [True, False, None])
def test_regions(spark, small):
    points = [(1, 2.0, 2.0), (2, 2.0, 0.5), (3, 12.0, 2.0), (4, 10.5, 2.0), (5, -3.0, 2.0), (6, None, 2.0), (7, 2.0, 2.0)]
    df = spark.createDataFrame(points, "i int, x double, y double")
    out = geo.region_of(df, regions(spark), "x", "y", "place", cell=1.5, small=small)
    assert out.columns == ["i", "x", "y", "place"]
    got = {r["i"]: r["place"] for r in out.collect()}
    assert got == {1: "west", 2: "all", 3: "<empty>", 4: "donut", 5: "<empty>", 6: "<empty>", 7: "west"}


def star(rng, cx, cy, corners, size):
    angles = [2 * math.pi * i / corners for i in range(corners)]
    radii = [size * rng.uniform(0.3, 1) for _ in angles]
    ring = [(cx + r * math.cos(a), cy + r * math.sin(a)) for a, r in zip(angles, radii, strict=True)]
    return [*ring, ring[0]]


def inside(rings, x, y):
    odd = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                odd = not odd
    return odd


RING_FIELDS = "name string, rings array<array<struct<x: double, y: double>>>"


@pytest.mark.parametrize(("cell", "small"), [(None, None), (0.7, True), (3.0, False), (500.0, True)])
def test_regions_equal_ray_casting(spark, cell, small):
    rng = random.Random(8)
    shapes = {f"star{i}": [star(rng, rng.uniform(-9, 9), rng.uniform(-9, 9), rng.choice([3, 5, 40]), rng.uniform(0.5, 6))] for i in range(8)}
    shapes["holed"] = [star(rng, 0, 0, 30, 9), star(rng, 0, 0, 12, 2)]
    shapes["grid"] = [[(float(x), float(y)) for x, y in ((-4, -4), (4, -4), (4, 0), (0, 0), (0, 4), (-4, 4), (-4, -4))]]
    shapes["thin"] = [[(-12.0, 1.0), (12.0, 1.0), (12.0, 1.001), (-12.0, 1.001), (-12.0, 1.0)]]
    points = [(rng.uniform(-12, 12), rng.uniform(-12, 12)) for _ in range(1500)] + [(x / 2, y / 2) for x in range(-10, 11) for y in range(-10, 11)]
    points += [corner for rings in shapes.values() for corner in rings[0][:3]] + [(0.0, 1.0), (0.0, 1.001), (1e9, 1e9)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i int, x double, y double")
    table = spark.createDataFrame(list(shapes.items()), RING_FIELDS)
    got = {r["i"]: r["place"] for r in geo.region_of(df, table, "x", "y", "place", cell, small).collect()}
    want = {i: min((n for n, rings in shapes.items() if inside(rings, *p)), default="<empty>") for i, p in enumerate(points)}
    assert got == want


def test_many_corners_stay_small(spark):
    rng = random.Random(2)
    ring = star(rng, 0, 0, 20_000, 10)
    cut = geo.prepare_regions(spark.createDataFrame([("ring", [ring])], RING_FIELDS))
    assert cut.small and cut.cells.agg(F.sum(geo._cell_bytes())).first()[0] < 10e6
    points = [(rng.uniform(-10, 10), rng.uniform(-10, 10)) for _ in range(300)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i int, x double, y double")
    got = {r["i"]: r["place"] for r in geo.region_of(df, cut, "x", "y", "place").collect()}
    assert got == {i: "ring" if inside([ring], *p) else "<empty>" for i, p in enumerate(points)}


def test_geometry_dimension_choice(spark):
    df = spark.createDataFrame([(bytearray(point("<", 2, 2)), 1.0), (None, 2.0)], "g binary, v double")
    codes = spark.createDataFrame([("west", "x", "OFF"), (None, "west", "WST")], "official_name string, name string, code string")
    got = profile(df, {"wkb": [{"g": ["type", "country", "nonsense", {"epsg": "4326"}]}]}, numbers=["v"], keyed=False,
                  countries=regions(spark), country_codes=codes)
    assert got.dimensions == ["g_geo_type", "g_geo_country"]
    assert sorted(tuple(r)[:2] for r in got.metrics.collect()) == [("<empty>", "<empty>"), ("Point", "OFF")]
    everything = profile(df, {"wkb": ["g"]}, numbers=["v"], keyed=False, states=regions(spark), countries=regions(spark))
    assert everything.dimensions == ["g_geo_type", "g_geo_state", "g_geo_country"]
    with pytest.raises(ValueError):
        profile(df, {"wkb": ["g"]}, numbers=["v"])


@pytest.mark.parametrize("small", [True, False, None])
def test_code_lookup_order(spark, small):
    codes = spark.createDataFrame(
        [("Official A", "A", "AAA"), (None, "B", "BBB"), ("B", "zz", "OFB"), ("A2", "dup", "X1"), ("A3", "dup", "X2")],
        "official_name string, name string, code string",
    )
    df = spark.createDataFrame([("Official A",), ("A",), ("B",), ("dup",), ("none",), (None,)], "n string")
    got = [r[0] for r in code_lookup(df, "n", codes, small=small).collect()]
    assert sorted(got, key=str) == sorted(["AAA", "AAA", "OFB", "X1", "none", None], key=str)

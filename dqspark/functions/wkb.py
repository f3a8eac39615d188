"""Well-known-binary geometries: type from the header, centroid in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Geometry type codes of the well-known-binary format.
GEOMETRY_TYPES = {
    1: "Point",
    2: "LineString",
    3: "Polygon",
    4: "MultiPoint",
    5: "MultiLineString",
    6: "MultiPolygon",
    7: "GeometryCollection",
}


def geometry_type(wkb: Column) -> Column:
    """Type name from the first five bytes, either byte order; NULL for anything else."""
    head = F.hex(F.substring(wkb, 1, 5))
    little = F.concat(*[F.substring(head, p, 2) for p in (9, 7, 5, 3)])
    code_hex = F.when(F.substring(head, 1, 2) == "01", little).otherwise(F.substring(head, 3, 8))
    raw = F.conv(code_hex, 16, 10).try_cast("bigint")
    # Extended codes flag Z, M and SRID in the high bits; ISO codes add 1000 per extra dimension.
    code = F.pmod(raw.bitwiseAND(F.lit(0x0FFFFFFF)), F.lit(1000))
    names = F.create_map(*[F.lit(x) for pair in GEOMETRY_TYPES.items() for x in pair])
    valid = (F.length(wkb) >= 5) & F.substring(head, 1, 2).isin("00", "01")
    return F.when(valid, F.try_element_at(names, code.cast("int")))


def centroid(wkb: Column) -> Column:
    """Struct ``x, y`` of the centroid; NULL for NULL, empty or unreadable bytes.

    Polygons weigh by area, lines by length, points equally; a geometry of a lower dimension counts
    only where none of a higher one has weight.
    """
    return _centroid_udf()(wkb)


def _centroid_udf() -> Callable[[Column], Column]:
    # Everything the tasks need is nested here, so that it travels with the function.
    @F.pandas_udf("x double, y double")
    def centroids(values: pd.Series) -> pd.DataFrame:
        import struct

        import numpy as np

        # Moments are rows of weight, weight * x and weight * y, for a stack of equally long paths.

        def point_moments(p):
            known = ~np.isnan(p).any(axis=2)
            kept = np.where(known[:, :, None], p, 0.0)
            return np.column_stack([known.sum(axis=1), kept[:, :, 0].sum(axis=1), kept[:, :, 1].sum(axis=1)])

        def line_moments(p):
            step = np.hypot(np.diff(p[:, :, 0]), np.diff(p[:, :, 1]))
            mid = (p[:, 1:] + p[:, :-1]) / 2.0
            return np.column_stack(
                [step.sum(axis=1), (mid[:, :, 0] * step).sum(axis=1), (mid[:, :, 1] * step).sum(axis=1)]
            )

        def area_moments(p):
            start = p[:, :1]
            d = p - start
            dx, dy = d[:, :, 0], d[:, :, 1]
            cross = dx[:, :-1] * dy[:, 1:] - dx[:, 1:] * dy[:, :-1]
            area = cross.sum(axis=1) / 2.0
            mx = ((dx[:, :-1] + dx[:, 1:]) * cross).sum(axis=1) / 6.0 + area * start[:, 0, 0]
            my = ((dy[:, :-1] + dy[:, 1:]) * cross).sum(axis=1) / 6.0 + area * start[:, 0, 1]
            return np.column_stack([area, mx, my]) * np.where(area < 0, -1.0, 1.0)[:, None]

        def chosen(points, lines, areas):
            best = np.where(lines[:, :1] > 0, lines, points)
            best = np.where(areas[:, :1] > 0, areas, best)
            with np.errstate(divide="ignore", invalid="ignore"):
                return np.where(best[:, :1] > 0, best[:, 1:] / best[:, :1], np.nan)

        def read(buf, at, sums):
            """Add the moments of one geometry of any kind; gives the position after it."""
            order = "<" if buf[at] == 1 else ">"
            (code,) = struct.unpack_from(order + "I", buf, at + 1)
            at += 9 if code & 0x20000000 else 5
            flags, iso = code >> 28, (code & 0x0FFFFFFF) // 1000
            width = 2 + bin(flags & 0b1100).count("1") + (2 if iso == 3 else 1 if iso else 0)
            kind = (code & 0x0FFFFFFF) % 1000

            def path(at, n):
                block = np.frombuffer(buf, dtype=order + "f8", count=n * width, offset=at)
                return block.reshape(1, n, width)[:, :, :2].astype(float), at + n * width * 8

            def count(at):
                return struct.unpack_from(order + "I", buf, at)[0], at + 4

            if kind == 1:
                p, at = path(at, 1)
                sums[0] += point_moments(p)
            elif kind == 2:
                n, at = count(at)
                p, at = path(at, n)
                if n:
                    sums[0] += point_moments(p)
                    sums[1] += line_moments(p)
            elif kind == 3:
                rings, at = count(at)
                for ring in range(rings):
                    n, at = count(at)
                    p, at = path(at, n)
                    if n:
                        sums[0] += point_moments(p)
                        sums[1] += line_moments(p)
                        sums[2] += area_moments(p) * (1.0 if ring == 0 else -1.0)
            elif kind in (4, 5, 6, 7):
                n, at = count(at)
                for _ in range(n):
                    at = read(buf, at, sums)
            else:
                raise ValueError(kind)
            return at

        # Plain points, lines and one-ring polygons of one length share a layout and are read together:
        # bytes before the coordinates, by the first five bytes.
        plain = {bytes([f]) + struct.pack("<I" if f else ">I", code): skip
                 for f in (0, 1) for code, skip in ((1, 5), (2, 9), (3, 13))}
        layouts, singles = {}, []
        for i, value in enumerate(values):
            if value is None:
                continue
            buf = bytes(value)
            skip = plain.get(buf[:5])
            if skip is None or len(buf) <= skip or (len(buf) - skip) % 16:
                singles.append((i, buf))
                continue
            n, order = (len(buf) - skip) // 16, "<" if buf[0] else ">"
            counts = b"" if skip == 5 else struct.pack(order + "I", n)
            if skip == 13:
                counts = struct.pack(order + "I", 1) + counts
            if (skip == 5 and n != 1) or buf[5:skip] != counts:
                singles.append((i, buf))
            else:
                layouts.setdefault((buf[:5], skip, n, order), []).append((i, buf))

        out = np.full((len(values), 2), np.nan)
        for (_, skip, n, order), found in layouts.items():
            rows = np.frombuffer(b"".join(buf for _, buf in found), dtype=np.uint8).reshape(len(found), -1)
            p = np.ascontiguousarray(rows[:, skip:]).view(order + "f8").astype(float).reshape(len(found), n, 2)
            none = np.zeros((len(found), 3))
            lines = line_moments(p) if skip > 5 else none
            areas = area_moments(p) if skip == 13 else none
            out[[i for i, _ in found]] = chosen(point_moments(p), lines, areas)
        for i, buf in singles:
            sums = [np.zeros((1, 3)) for _ in range(3)]
            try:
                read(buf, 0, sums)
            except (ValueError, IndexError, struct.error):
                continue
            out[i] = chosen(*sums)[0]
        known = ~np.isnan(out).any(axis=1)
        return pd.DataFrame({
            name: pd.Series(out[:, axis]).astype(object).where(known, None) for axis, name in enumerate("xy")
        })

    return centroids

"""Geometry helpers: WKB codec (numpy, Arrow-batched UDFs) and a
point-in-polygon test written with built-in higher-order functions.

No geometry library is assumed.  Coordinates stay in the layer's own
projection; geometry travels as WKB (``BinaryType``) with its SRID in a
separate integer column.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# WKB geometry type codes (fixed values of the format)
WKB_POINT = 1
WKB_POLYGON = 3
WKB_MULTIPOLYGON = 6

_SQUARE_HEADER = np.frombuffer(struct.pack("<BIII", 1, WKB_POLYGON, 1, 5), dtype=np.uint8)


# ------------------------------------------------------------- encoding ----

def _squares(xmin, ymin, xmax, ymax) -> tuple[np.ndarray, np.ndarray]:
    """Axis-aligned rectangles as WKB polygons, a row of bytes each, and which have no number for a side."""
    x0, y0, x1, y1 = (np.asarray(a, dtype="<f8") for a in (xmin, ymin, xmax, ymax))
    n = len(x0)
    buf = np.empty((n, 13 + 80), dtype=np.uint8)
    buf[:, :13] = _SQUARE_HEADER
    coords = np.stack([x0, y0, x1, y0, x1, y1, x0, y1, x0, y0], axis=1).astype("<f8")
    buf[:, 13:] = np.ascontiguousarray(coords).view(np.uint8).reshape(n, 80)
    return buf, np.isnan(x0) | np.isnan(y0) | np.isnan(x1) | np.isnan(y1)


def squares_wkb(xmin, ymin, xmax, ymax) -> list:
    """Axis-aligned rectangles as WKB polygons, vectorised over arrays."""
    buf, bad = _squares(xmin, ymin, xmax, ymax)
    return [None if b else row.tobytes() for row, b in zip(buf, bad)]


def polygon_wkb(rings: list) -> bytes:
    """One polygon from a list of rings ((n, 2) arrays, closed)."""
    parts = [struct.pack("<BII", 1, WKB_POLYGON, len(rings))]
    for r in rings:
        r = np.asarray(r, dtype="<f8")
        parts.append(struct.pack("<I", len(r)))
        parts.append(r.tobytes())
    return b"".join(parts)


def multipolygon_wkb(polygons: list) -> bytes:
    return struct.pack("<BII", 1, WKB_MULTIPOLYGON, len(polygons)) + b"".join(polygon_wkb(p) for p in polygons)


@F.arrow_udf(T.BinaryType())
def bbox_polygon_wkb(bbox: pa.Array) -> pa.Array:
    """WKB rectangle of a ``geometry_bbox`` struct column, a batch in one buffer."""
    sides = [pc.struct_field(bbox, n).to_numpy(zero_copy_only=False) for n in ("xmin", "ymin", "xmax", "ymax")]
    buf, bad = _squares(*sides)
    squares = pa.FixedSizeBinaryArray.from_buffers(pa.binary(buf.shape[1]), len(buf), [None, pa.py_buffer(buf)])
    return pc.if_else(pa.array(bad), pa.scalar(None, pa.binary()), squares.cast(pa.binary()))


@F.pandas_udf(T.BinaryType())
def rings_wkb(rings: pd.Series) -> pd.Series:
    """WKB polygon from rings given as flat coordinate arrays (shell first)."""
    out = [None if g is None else polygon_wkb([np.asarray(r, dtype="<f8").reshape(-1, 2) for r in g]) for g in rings]
    return pd.Series(out, dtype=object)


# ------------------------------------------------------------- decoding ----

def _read_polygon(b: memoryview, off: int, rings: list) -> int:
    order = "<" if b[off] == 1 else ">"
    (gtype,) = struct.unpack_from(order + "I", b, off + 1)
    if gtype % 1000 != WKB_POLYGON:
        raise ValueError(f"expected polygon, got WKB type {gtype}")
    dims = 3 if gtype // 1000 in (1, 2) else 4 if gtype // 1000 == 3 else 2
    (nr,) = struct.unpack_from(order + "I", b, off + 5)
    off += 9
    for _ in range(nr):
        (npt,) = struct.unpack_from(order + "I", b, off)
        off += 4
        pts = np.frombuffer(b, dtype=order + "f8", count=npt * dims, offset=off).reshape(npt, dims)[:, :2]
        rings.append(pts)
        off += npt * dims * 8
    return off


def wkb_polygons(wkb: bytes) -> list:
    """Polygons of a (multi)polygon, each a list of rings (shell first)."""
    if wkb is None:
        return []
    b = memoryview(wkb)
    order = "<" if b[0] == 1 else ">"
    (gtype,) = struct.unpack_from(order + "I", b, 1)
    polygons: list = []
    if gtype % 1000 == WKB_POLYGON:
        polygons.append([])
        _read_polygon(b, 0, polygons[-1])
    elif gtype % 1000 == WKB_MULTIPOLYGON:
        (n,) = struct.unpack_from(order + "I", b, 5)
        off = 9
        for _ in range(n):
            polygons.append([])
            off = _read_polygon(b, off, polygons[-1])
    else:
        raise ValueError(f"unsupported WKB type {gtype}")
    return polygons


def wkb_rings(wkb: bytes) -> list:
    """All rings (outer and holes, of all parts) of a (multi)polygon."""
    return [r for poly in wkb_polygons(wkb) for r in poly]


def _widest_interval(rings: list) -> tuple[float, float, float]:
    """(x, y, width) of the widest inside interval of one polygon on a scan
    line placed between the vertex ordinates nearest to the middle of its
    bounding box (so the line never runs through a vertex)."""
    pts = np.concatenate(rings)
    ys = pts[:, 1]
    mid = (ys.min() + ys.max()) / 2.0
    lo = ys[ys <= mid].max()
    above = ys[ys > mid]
    y = (lo + above.min()) / 2.0 if len(above) else mid
    xs = []
    for r in rings:
        x1, y1, x2, y2 = r[:-1, 0], r[:-1, 1], r[1:, 0], r[1:, 1]
        cross = (y1 > y) != (y2 > y)
        if cross.any():
            xs.append(x1[cross] + (y - y1[cross]) * (x2[cross] - x1[cross]) / (y2[cross] - y1[cross]))
    if not xs:
        return (float((pts[:, 0].min() + pts[:, 0].max()) / 2.0), float(mid), -1.0)
    xs = np.sort(np.concatenate(xs))
    starts, ends = xs[0::2], xs[1::2]
    k = len(ends)
    if k == 0:
        return (float(xs[0]), float(y), 0.0)
    widths = ends - starts[:k]
    i = int(np.argmax(widths))
    return (float((starts[i] + ends[i]) / 2.0), float(y), float(widths[i]))


def interior_point(polygons: list) -> tuple[float, float]:
    """A point inside a (multi)polygon: middle of the widest scan-line
    interval over its parts.  Accepts a list of polygons (lists of rings)
    or, for a single polygon, its list of rings."""
    if not polygons:
        return (float("nan"), float("nan"))
    if isinstance(polygons[0], np.ndarray):
        polygons = [polygons]
    best = max((_widest_interval(p) for p in polygons if p), key=lambda t: t[2])
    return (best[0], best[1])


POINT_TYPE = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])


@F.pandas_udf(POINT_TYPE)
def point_on_surface(wkb: pd.Series) -> pd.DataFrame:
    """Interior point of each (multi)polygon, Arrow batch at a time."""
    pts = [interior_point(wkb_polygons(g)) if g is not None else (float("nan"), float("nan")) for g in wkb]
    arr = np.array(pts, dtype=float).reshape(-1, 2)
    return pd.DataFrame({"x": arr[:, 0], "y": arr[:, 1]})


RINGS_TYPE = T.ArrayType(T.ArrayType(T.DoubleType()))


@F.pandas_udf(RINGS_TYPE)
def rings_of(wkb: pd.Series) -> pd.Series:
    """Rings as flat coordinate arrays ``[x0, y0, x1, y1, ...]``."""
    return pd.Series([[r.ravel().tolist() for r in wkb_rings(g)] if g is not None else None for g in wkb],
                     dtype=object)


# -------------------------------------------------- point in polygon ----

def ring_crossings(ring: Column, px: Column, py: Column) -> Column:
    """Parity of a ray from (px, py) to +x crossing the ring's edges."""
    n = F.size(ring) / 2

    def edge(acc, i):
        x1, y1 = F.get(ring, i * 2), F.get(ring, i * 2 + 1)
        x2, y2 = F.get(ring, i * 2 + 2), F.get(ring, i * 2 + 3)
        # NULL on a horizontal edge, which the ray never crosses
        at = F.try_divide((x2 - x1) * (py - y1), y2 - y1) + x1
        return acc != (((y1 > py) != (y2 > py)) & F.coalesce(px < at, F.lit(False)))

    return F.when(F.size(ring) >= 8, F.aggregate(F.sequence(F.lit(0), (n - 2).cast("int")), F.lit(False), edge)) \
        .otherwise(F.lit(False))


def contains_point(rings: Column, px: Column, py: Column) -> Column:
    """Even-odd rule over all rings: holes and multipolygons included."""
    return F.aggregate(rings, F.lit(False), lambda acc, r: acc != ring_crossings(r, px, py))

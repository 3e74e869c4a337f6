"""Well-known binary geometry to edges, and back."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.runtime import ship_package

# Geometry types of the format.
LINE, POLYGON, MULTI_LINE, MULTI_POLYGON = 2, 3, 5, 6


def rings(data: bytes) -> list[list[tuple[float, float]]]:
    """The rings (or lines) of a geometry, of all its parts. Raises for other types."""
    out: list[list[tuple[float, float]]] = []

    def read(at: int) -> int:
        order = "<" if data[at] else ">"
        (kind,) = struct.unpack_from(order + "I", data, at + 1)
        at += 5
        if kind & 0x20000000:
            at += 4
        kind &= 0xFF

        def points(at: int) -> int:
            (n,) = struct.unpack_from(order + "I", data, at)
            flat = struct.unpack_from(f"{order}{2 * n}d", data, at + 4)
            out.append(list(zip(flat[::2], flat[1::2], strict=True)))
            return at + 4 + 16 * n

        if kind == LINE:
            return points(at)
        (n,) = struct.unpack_from(order + "I", data, at)
        at += 4
        for _ in range(n):
            if kind == POLYGON:
                at = points(at)
            elif kind in (MULTI_LINE, MULTI_POLYGON):
                at = read(at)
            else:
                raise ValueError(f"geometry of type {kind}")
        return at

    read(0)
    return out


def line_wkb(points: list[tuple[float, float]]) -> bytes:
    return struct.pack("<BII", 1, LINE, len(points)) + b"".join(struct.pack("<dd", *p) for p in points)


def multipolygon_wkb(polygons: list[list[list[tuple[float, float]]]]) -> bytes:
    """Polygons (each its rings) as one multipolygon. Raises if there are none."""
    if not polygons or not any(polygons):
        raise ValueError("empty geometry")
    out = struct.pack("<BII", 1, MULTI_POLYGON, len(polygons))
    for parts in polygons:
        out += struct.pack("<BII", 1, POLYGON, len(parts))
        out += b"".join(struct.pack("<I", len(r)) + b"".join(struct.pack("<dd", *p) for p in r) for r in parts)
    return out


def edges(shapes: DataFrame, id_col: str, wkb: str = "geometry_wkb") -> DataFrame:
    """(id, seq, x1, y1, x2, y2): every segment; null geometries have none."""
    ship_package(shapes.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = [(*a, *b) for ring in (rings(data) if data else []) for a, b in zip(ring, ring[1:], strict=False)]
                columns = list(zip(*found, strict=True)) or [[]] * 4
                yield pa.record_batch([pa.array([key] * len(found), pa.int64()), pa.array(range(len(found)), pa.int32()), *[pa.array(c, pa.float64()) for c in columns]], names=[id_col, "seq", "x1", "y1", "x2", "y2"])

    return shapes.select(F.col(id_col).cast("long"), wkb).mapInArrow(run, f"{id_col} long, seq int, x1 double, y1 double, x2 double, y2 double")


def bounds(edge_table: DataFrame, id_col: str) -> DataFrame:
    return edge_table.groupBy(id_col).agg(
        F.min(F.least("y1", "y2")).alias("min_lat"), F.max(F.greatest("y1", "y2")).alias("max_lat"),
        F.min(F.least("x1", "x2")).alias("min_lon"), F.max(F.greatest("x1", "x2")).alias("max_lon"),
    )

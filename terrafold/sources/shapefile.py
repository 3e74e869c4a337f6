"""ESRI shapefiles (polygons and lines with attributes)."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.runtime import ship_package
from terrafold.sources.wkb import line_wkb, multipolygon_wkb

_POLYGONS, _LINES = (5, 15, 25), (3, 13, 23)


def _area(ring: list[tuple[float, float]]) -> float:
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:], strict=False)) / 2


def _within(point: tuple[float, float], ring: list[tuple[float, float]]) -> bool:
    x, y = point
    inside = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            inside = not inside
    return inside


def shape_wkb(content: bytes) -> bytes | None:
    """The geometry of a record's content. Outer rings run clockwise and start a polygon; others
    are holes of the outer ring around them. A null shape has none."""
    (kind,) = struct.unpack_from("<i", content)
    if kind == 0:
        return None
    if kind not in _POLYGONS + _LINES:
        raise ValueError(f"shape of type {kind}")
    parts, points = struct.unpack_from("<ii", content, 36)
    starts = [*struct.unpack_from(f"<{parts}i", content, 44), points]
    flat = struct.unpack_from(f"<{2 * points}d", content, 44 + 4 * parts)
    xy = list(zip(flat[::2], flat[1::2], strict=True))
    rows = [xy[a:b] for a, b in zip(starts, starts[1:], strict=False)]
    if kind in _LINES:
        return line_wkb(rows[0])
    outer = [[r] for r in rows if _area(r) <= 0] or [[r] for r in rows]
    for hole in (r for r in rows if _area(r) > 0 and [r] not in outer):
        next((p for p in outer if _within(hole[0], p[0])), outer[-1]).append(hole)
    return multipolygon_wkb(outer)


def attributes(data: bytes, encoding: str) -> Iterator[dict[str, str | None]]:
    """The rows of an attribute table; all values as text."""
    count, start, length = struct.unpack_from("<IHH", data, 4)
    fields, at = [], 32
    while at < len(data) and data[at] != 0x0D:
        fields.append((data[at : at + 11].split(b"\0")[0].decode("ascii"), data[at + 16]))
        at += 32
    for i in range(count):
        out, at = {}, start + i * length + 1
        for name, size in fields:
            out[name] = data[at : at + size].decode(encoding).strip(" \0") or None
            at += size
        yield out


def shapes(shp: bytes, dbf: bytes, encoding: str) -> Iterator[tuple[int, dict[str, str | None], bytes | None]]:
    """(record, attributes, WKB) of a shapefile and the attribute table beside it."""
    at = 100
    for values in attributes(dbf, encoding):
        if at + 8 > len(shp):
            return
        number, words = struct.unpack_from(">ii", shp, at)
        yield number, values, shape_wkb(shp[at + 8 : at + 8 + 2 * words])
        at += 8 + 2 * words


_RECORDS = 1024


def read_shapes(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """(record, attributes, geometry_wkb) of a .shp, or of all in a folder, wherever Spark reads; one task
    takes a whole file (the format ends at 2 GB)."""
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.map_(pa.string(), pa.string()), pa.binary()]
        for batch in batches:
            for shp, dbf in zip(batch.column(0), batch.column(1), strict=True):
                rows = shapes(shp.as_py(), dbf.as_py(), encoding)
                while some := list(islice(rows, _RECORDS)):
                    numbers, values, geometries = zip(*some, strict=True)
                    columns = [list(numbers), [list(v.items()) for v in values], list(geometries)]
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["record", "attributes", "geometry_wkb"])

    one = path.lower().endswith(".shp")
    files = spark.read.format("binaryFile").load([path, path[:-4] + (".DBF" if path.endswith(".SHP") else ".dbf")] if one else path)
    stem, ending = F.regexp_replace("path", r"\.[^.]*$", "").alias("stem"), F.lower(F.substring_index("path", ".", -1))
    side = lambda kind: files.where(ending == kind).select(stem, F.col("content").alias(kind))
    return side("shp").join(side("dbf"), "stem").select("shp", "dbf").mapInArrow(run, "record int, attributes map<string,string>, geometry_wkb binary")

from __future__ import annotations

import bz2
import lzma
import struct
import zlib

import pytest

from terrafold.plans import build
from terrafold.sources import osm, shapefile, wkb


def varint(n):
    out = b""
    while True:
        n, b = n >> 7, n & 127
        if not n:
            return out + bytes([b])
        out += bytes([b | 128])


def zig(n):
    return (n << 1) ^ (n >> 63) if n >= 0 else ((-n) << 1) - 1


def field(k, v):
    return varint(k << 3) + varint(v) if isinstance(v, int) else varint(k << 3 | 2) + varint(len(v)) + v


def packed(values):
    return b"".join(varint(v) for v in values)


def deltas(values):
    return packed([zig(b - a) for a, b in zip([0, *values], values, strict=False)])


def extract(path):
    strings = ["", "highway", "primary", "name", "臺灣路", "place", "town", "addr:housenumber", "５之１號", "addr:street", "街"]
    table = b"".join(field(1, s.encode()) for s in strings)
    degrees = lambda v: [round(x * 1e7) for x in v]
    dense = field(1, deltas([1, 2, 3, 4, 5])) + field(8, deltas(degrees([24.0, 24.01, 24.02, 24.5, 24.6]))) + field(9, deltas(degrees([120.0, 120.0, 120.01, 120.5, 120.6])))
    dense += field(10, packed([0, 0, 5, 6, 3, 4, 0, 7, 8, 9, 10, 0, 5, 6, 7, 8, 0]))
    way = field(1, 9) + field(2, packed([1, 3])) + field(3, packed([2, 4])) + field(8, deltas([1, 2, 3, 99]))
    block = field(1, table) + field(2, field(2, dense)) + field(2, field(3, way))
    with open(path, "wb") as f:
        for kind, data in ((b"OSMHeader", b""), (b"OSMData", block)):
            blob = field(2, len(data)) + field(3, zlib.compress(data))
            head = field(1, kind) + field(3, len(blob))
            f.write(struct.pack(">I", len(head)) + head + blob)


@pytest.mark.parametrize("pack", [lambda d: field(1, d), lambda d: field(3, zlib.compress(d)), lambda d: field(4, lzma.compress(d)), lambda d: field(5, bz2.compress(d))])
def test_many_blocks(spark, tmp_path, pack):
    """Blocks of each encoding, one with the name of blocks among its strings."""
    with open(tmp_path / "x.pbf", "wb") as f:
        for i in range(40):
            strings = b"".join(field(1, x) for x in (b"", b"source", b"OSMData" if i == 7 else b"survey"))
            node = field(1, zig(i)) + field(2, packed([1])) + field(3, packed([2])) + field(8, zig(i)) + field(9, zig(2 * i))
            data = field(1, strings) + field(2, field(1, node))
            blob = pack(data)
            head = field(1, b"OSMData") + (field(2, b"index") if i % 2 else b"") + field(3, len(blob))
            f.write(struct.pack(">I", len(head)) + head + blob)
    one_split = b"OSMData" in pack(b"OSMData" * 2)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m" if one_split else "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = osm.read_extract(spark, str(tmp_path))
        assert one_split or found.rdd.getNumPartitions() > 4
        got = {(r["id"], r["tags"]["source"], round(r["lon"] * 1e7)) for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {(i, "OSMData" if i == 7 else "survey", 2 * i) for i in range(40)}


def test_map_extract(spark, tmp_path):
    path = str(tmp_path / "x.pbf")
    extract(path)
    objects = osm.read_extract(spark, path)
    nodes = {r["id"]: r for r in objects.where("kind = 'node'").collect()}
    assert len(nodes) == 5 and abs(nodes[3]["lat"] - 24.02) < 1e-9 and nodes[3]["tags"] == {"place": "town", "name": "臺灣路"}
    roads, edges = build.roads(objects)
    assert [(r["line_id"], r["name"], r["highway"]) for r in roads.collect()] == [(9, "台灣路", "primary")] and edges.count() == 2
    areas = spark.createDataFrame([(1, 4, "某縣", None)], "area_id long, level int, name string, county string")
    ring = [(120.4, 24.4), (120.55, 24.4), (120.55, 24.55), (120.4, 24.55), (120.4, 24.4)]
    area_edges = spark.createDataFrame([(1, *a, *b) for a, b in zip(ring, ring[1:], strict=False)], "area_id long, x1 double, y1 double, x2 double, y2 double")
    # Node 5 is a landmark without a name: no landmark, and no address either.
    assert {r["osm_id"]: r["display_name"] for r in build.map_places(objects, areas, area_edges, ("某縣",)).collect()} == {3: "台灣路"}
    got = {r["osm_id"]: r["display_name_halfwidth"] for r in build.map_places(objects, areas, area_edges, ()).collect()}
    assert got == {3: "台灣路", 4: "街5-1號"}
    clipped = osm.clip(objects, 119.9, 23.9, 120.005, 24.015)
    assert {(r["kind"], r["id"]) for r in clipped.collect()} == {("node", 1), ("node", 2), ("node", 3), ("way", 9)}


def write_shapes(path, rows):
    records = b""
    for i, (rings, _) in enumerate(rows, 1):
        points = [p for r in rings for p in r]
        starts, at = [], 0
        for r in rings:
            starts.append(at)
            at += len(r)
        content = struct.pack("<i4dii", 5, 0, 0, 0, 0, len(rings), len(points)) + struct.pack(f"<{len(rings)}i", *starts) + b"".join(struct.pack("<dd", *p) for p in points)
        records += struct.pack(">ii", i, len(content) // 2) + content
    (path / "x.shp").write_bytes(bytes(100) + records)
    names = ("COUNTYNAME", "TOWNNAME", "TOWNCODE")
    dbf = struct.pack("<BBBBIHH", 3, 0, 0, 0, len(rows), 32 + 32 * len(names) + 1, 1 + 20 * len(names)) + bytes(20)
    for n in names:
        dbf += n.encode().ljust(11, b"\0") + b"C" + bytes(4) + bytes([20, 0]) + bytes(14)
    dbf += b"\r" + b"".join(b" " + b"".join(v.encode().ljust(20) for v in values) for _, values in rows)
    (path / "x.dbf").write_bytes(dbf)


def test_shapes(spark, tmp_path):
    outer, hole = [(0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (4.0, 0.0), (0.0, 0.0)], [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0), (1.0, 1.0)]
    far = [(x + 100, y) for x, y in outer]
    write_shapes(tmp_path, [([outer, hole], ("臺中市", "中區", "1")), ([outer], ("彰化縣", "田尾鄉", "2")), ([far], ("彰化縣", "遠鄉", "3"))])
    shapes = shapefile.read_shapes(spark, str(tmp_path / "x.shp"))
    assert len(wkb.rings(bytes(shapes.first()["geometry_wkb"]))) == 2
    areas, edges = build.townships(shapes.limit(0), shapes, box={"west": -1, "south": -1, "east": 5, "north": 5})
    assert {(r["name"], r["level"], r["county"]) for r in areas.collect()} == {("中區", 7, "台中市"), ("田尾鄉", 8, "彰化縣")}
    assert edges.count() == 12

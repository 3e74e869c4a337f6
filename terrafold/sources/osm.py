"""Map extracts in the PBF format: nodes and ways, read by blocks."""

from __future__ import annotations

import bz2
import lzma
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.runtime import ship_package

_SCHEMA = "kind string, id long, tags map<string,string>, lat double, lon double, refs array<long>"


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        at += 1
        value |= (b & 0x7F) << shift
        if b < 0x80:
            return value, at
        shift += 7


def _signed(v: int) -> int:
    return (v >> 1) ^ -(v & 1)


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol buffer message: integers and byte strings."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            n, at = _varint(data, at)
            value, at = data[at : at + n], at + n
        else:
            n = 8 if kind == 1 else 4
            value, at = data[at : at + n], at + n
        yield key >> 3, value


def _packed(data: bytes) -> list[int]:
    out, at = [], 0
    while at < len(data):
        v, at = _varint(data, at)
        out.append(v)
    return out


def _running(values: list[int]) -> Iterator[int]:
    total = 0
    for v in values:
        total += _signed(v)
        yield total


def block_objects(data: bytes) -> Iterator[tuple]:
    """The nodes and ways of a primitive block."""
    top = list(fields(data))
    first = lambda number, default: next((v for k, v in top if k == number), default)
    strings = [v.decode("utf-8") for k, v in fields(first(1, b"")) if k == 1]
    granularity, lat0, lon0 = first(17, 100), first(19, 0), first(20, 0)
    degrees = lambda base, v: (base + granularity * v) * 1e-9
    pairs = lambda ks, vs: {strings[a]: strings[b] for a, b in zip(ks, vs, strict=True)}
    for group in (v for k, v in top if k == 2):
        for kind, body in fields(group):
            f: dict[int, int | bytes] = dict(fields(body)) if isinstance(body, bytes) else {}
            if kind == 1:
                tags = pairs(_packed(f.get(2, b"")), _packed(f.get(3, b"")))
                yield "node", _signed(f[1]), tags, degrees(lat0, _signed(f[8])), degrees(lon0, _signed(f[9])), None
            elif kind == 2:
                marks = _packed(f.get(10, b""))
                at = 0
                for i, la, lo in zip(_running(_packed(f[1])), _running(_packed(f[8])), _running(_packed(f[9])), strict=True):
                    tags = {}
                    while at < len(marks) and marks[at]:
                        tags[strings[marks[at]]] = strings[marks[at + 1]]
                        at += 2
                    at += 1
                    yield "node", i, tags, degrees(lat0, la), degrees(lon0, lo), None
            elif kind == 3:
                yield "way", f[1], pairs(_packed(f.get(2, b"")), _packed(f.get(3, b""))), None, None, list(_running(_packed(f.get(8, b""))))


#: What a block of data is called in its header; as the end of a line it deals an extract to tasks.
_NAME = b"OSMData"
_MOST_BLOB = 32 << 20


def _decoded(blob: bytes) -> bytes:
    f = dict(fields(blob))
    if 1 in f:
        return f[1]
    if 3 in f:
        return zlib.decompress(f[3])
    if 4 in f:
        return lzma.decompress(f[4])
    if 5 in f:
        return bz2.decompress(f[5])
    if 7 in f:
        import zstandard

        return zstandard.ZstdDecompressor().decompress(f[7], max_output_size=max(f.get(2, 0), 1))
    raise ValueError(f"a block with the fields {sorted(f)}")


def _blob(part: bytes) -> bytes | None:
    """The block of data in what follows its name: the rest of its header, the block, and the start of
    the next header. None if the block isn't whole; an error if this can't be one."""
    size = at = 0
    while not size:
        key, at = _varint(part, at)
        if key == 0x12:
            n, at = _varint(part, at)
            at += n
        elif key == 0x18:
            size, at = _varint(part, at)
        else:
            size = -1
    after = part[at + size : at + size + 5] if size > 0 else b""
    if not 0 < size <= _MOST_BLOB or len(after) == 5 and (after[:2] != b"\0\0" or after[4] != 0x0A):
        raise ValueError("a task's bytes start within a block that holds the name of blocks; read the file in one split (spark.sql.files.maxPartitionBytes)")
    return part[at : at + size] if len(part) >= at + size else None


def _objects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.int64(), pa.map_(pa.string(), pa.string()), pa.float64(), pa.float64(), pa.list_(pa.int64())]
    names = ["kind", "id", "tags", "lat", "lon", "refs"]
    split, held = None, b""
    for batch in batches:
        for file, start, part in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
            if (file, start) != split:
                if held:
                    raise ValueError(f"{split}: a block isn't whole")
                split, held = (file, start), b""
            if not held and part[:1] in (b"", b"\0"):  # a file's start, before the first block of data
                continue
            blob = _blob(held + part)
            held = held + part + _NAME if blob is None else b""
            if blob is not None and (rows := list(block_objects(_decoded(blob)))):
                columns = [list(c) for c in zip(*rows, strict=True)]
                columns[2] = [list(t.items()) for t in columns[2]]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)
    if held:
        raise ValueError(f"{split}: a block isn't whole")


def read_extract(spark: SparkSession, path: str) -> DataFrame:
    """(kind, id, tags, lat, lon, refs) of the extract at ``path``, wherever Spark reads: its line reader
    finds the blocks by their name and deals them to tasks. Blocks that can't be read are an error."""
    ship_package(spark)
    parts = spark.read.option("lineSep", _NAME.decode()).text(path)
    return parts.select("_metadata.file_path", "_metadata.file_block_start", F.col("value").cast("binary")).mapInArrow(_objects, _SCHEMA)


def way_points(objects: DataFrame) -> DataFrame:
    """(id, seq, lat, lon): the places of each way's nodes, in order; nodes that are missing are left out."""
    refs = objects.where("kind = 'way'").select("id", F.posexplode("refs").alias("seq", "ref"))
    nodes = objects.where("kind = 'node'").select(F.col("id").alias("ref"), "lat", "lon")
    return refs.join(nodes, "ref").select("id", "seq", "lat", "lon")


def way_edges(points: DataFrame, id_col: str = "line_id") -> DataFrame:
    """(id, seq, x1, y1, x2, y2): the segments of ways."""
    from pyspark.sql.window import Window

    following = Window.partitionBy("id").orderBy("seq")
    ends = points.select("id", "seq", "lat", "lon", F.lead("lat").over(following).alias("y2"), F.lead("lon").over(following).alias("x2"))
    return ends.where("y2 is not null").select(F.col("id").alias(id_col), "seq", F.col("lon").alias("x1"), F.col("lat").alias("y1"), "x2", "y2")


def clip(objects: DataFrame, west: float, south: float, east: float, north: float) -> DataFrame:
    """Objects of a box: nodes inside it, ways with a node inside it, and all nodes of those ways."""
    inside: Column = F.col("lat").between(south, north) & F.col("lon").between(west, east)
    nodes = objects.where("kind = 'node'")
    kept = nodes.where(inside)
    refs = objects.where("kind = 'way'").select("id", F.explode("refs").alias("ref"))
    ways = refs.join(kept.select(F.col("id").alias("ref")), "ref", "left_semi").select("id").distinct()
    whole = objects.where("kind = 'way'").join(ways, "id", "left_semi")
    needed = refs.join(ways, "id", "left_semi").select(F.col("ref").alias("id")).union(kept.select("id")).distinct()
    return nodes.join(needed, "id", "left_semi").unionByName(whole)

"""Packing documents into sequences of bounded length by bulk-synchronous best fit.

Pieces are placed class by class, longest first. A round sorts a class's pieces and the gaps of open
sequences by size over range partitions and sweeps them from the largest: each piece takes the
smallest gap of its partition that holds it. What partitions leave over meets by counts and
ranks: pieces that found no gap take, in order, the nearest slots that larger partitions have left.
Gaps are updated, and the next round begins, until little fits; then range partitions of the pieces
that are left open new sequences, whose gaps the next class gets too.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrafold.llm.shared import Scratch
from terrafold.llm.tokens import encoder

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, pid long"
_OWN = [x.split()[0] for x in _PIECES.split(", ")]
#: A class is swept again while at least this share of its pieces found a gap in the last round.
_WORTH = 0.02
#: What a row of a sweep is.
_MATCHED, _PIECE, _GAP = 0, 1, 2


def pieces(docs: DataFrame, size: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", json_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """A row per piece of each document's ids, ``end_id`` last.

    Documents of more than ``size`` ids are cut; the first piece may be shorter, the others have
    ``size`` ids. A null or empty text is the one id ``end_id``. pid is a number of the piece that
    no other has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, pid = encoder(json_path, ranks_path), TaskContext.get().partitionId() << 40
        for batch in batches:
            out: list[list] = [[] for _ in _OWN]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py()), np.uint32(end_id)).astype("<u4")
                first = len(ids) % size or size
                for k, start in enumerate([0, *range(first, len(ids), size)]):
                    piece = ids[start : start + size if k else first]
                    for column, x in zip(out, (doc_id, k, start, len(piece), zlib.crc32(piece.tobytes()), pid), strict=True):
                        column.append(x)
                    pid += 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names=_OWN)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, _PIECES)


def bounds(size: int) -> list[int]:
    """Where the classes of lengths end, from the longest: pieces over half the size need a sequence each."""
    out = [size // 2]
    while out[-1]:
        out.append(out[-1] // (2 if out[-1] > size // 8 else 4))
    return out


def sweep(pieces: DataFrame, gaps: DataFrame | None, each: int = 1, size: int = 1024) -> DataFrame:
    """Pieces and gaps (seq, width), matched within range partitions by best fit from the largest.

    Rows: matched pieces with seq; pieces without a gap, and slots, with part and place, in the
    order of the sweep. A slot is room for any piece that is not larger than all of its partition:
    a gap with room for more is up to ``each`` slots. Without gaps, pieces open new sequences (seq is
    then the pid of the piece that did) wherever none of their partition has room.
    """
    none = [F.lit(None).cast("long").alias(c) for c in _OWN]
    rows = pieces.select(F.lit(_PIECE).alias("state"), F.lit(None).cast("long").alias("seq"), F.lit(None).cast("long").alias("width"), *_OWN)
    if gaps is not None:
        rows = rows.unionByName(gaps.select(F.lit(_GAP).alias("state"), "seq", "width", *none))
    order = [F.desc(F.coalesce("length", "width")), F.desc("state"), F.xxhash64("pid", "seq")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    opens = gaps is None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        table = pa.Table.from_batches([pa.RecordBatch.from_arrays(b.columns, schema=shape) for b in batches], shape).combine_chunks()
        sizes = [a if b is None else b for a, b in zip(table["width"].to_pylist(), table["length"].to_pylist(), strict=True)]
        room: list[tuple[int, int]] = []  # (what is left of it, number of the sequence in seqs), in order
        seqs: list[int] = []
        got: list[tuple[int, int]] = []
        without: list[int] = []
        for i, (state, x, seq, pid) in enumerate(zip(table["state"].to_pylist(), sizes, table["seq"].to_pylist(), table["pid"].to_pylist(), strict=True)):
            if state == _GAP:
                insort(room, (x, len(seqs)))
                seqs.append(seq)
                continue
            at = bisect_left(room, (x, -1))
            if at < len(room):
                left, k = room.pop(at)
            elif opens:
                left, k = size, len(seqs)
                seqs.append(pid)
            else:
                without.append(i)
                continue
            got.append((i, seqs[k]))
            if left > x:
                insort(room, (left - x, k))
        least = max(1, sizes[-1]) if sizes else 1
        slots = [] if opens else [seqs[k] for left, k in reversed(room) for _ in range(min(each, left // least))]
        made = [(_MATCHED, table.take(pa.array([i for i, _ in got], pa.int64())), [x for _, x in got])]
        made.append((_PIECE, table.take(pa.array(without, pa.int64())), [None] * len(without)))
        made.append((_GAP, table.take(pa.array([0] * len(slots), pa.int64())), slots))
        for state, out, seq in made:
            n = len(out)
            columns = [pa.array(np.full(n, state, np.int32)), pa.array(seq, pa.int64()), *[out[c].combine_chunks() for c in _OWN], pa.array(np.full(n, part, np.int32)), pa.array(np.arange(n, dtype=np.int64))]
            yield from pa.table(columns, names=["state", "seq", *_OWN, "part", "place"]).to_batches(max_chunksize=1 << 16)

    names = ["state", "seq", "width", *_OWN]
    shape = pa.schema([(n, pa.int32() if n in ("state", "piece") else pa.int64()) for n in names])
    return ranged.select(*names).mapInArrow(run, f"state int, seq long, {_PIECES}, part int, place long")


def carry(counts: list[tuple[int, int, int]]) -> tuple[list[tuple[int, int, int, int, int, int]], dict[int, int]]:
    """How partitions' leftovers meet. ``counts``: (part, pieces, slots) of each, largest sizes first.

    Links (link, piece_part, first, n, gap_part, top): the pieces of piece_part from place ``first``
    on take the slots of gap_part from place ``top`` down. And of each part, how many of its
    pieces found a slot; those are the first ones.
    """
    links, found, open_ = [], {}, []
    for part, pieces_left, slots in counts:
        first = 0
        while first < pieces_left and open_:
            at, n = open_[-1]
            take = min(n, pieces_left - first)
            links.append((len(links), part, first, take, at, n - 1))
            first += take
            open_.pop()
            if n > take:
                open_.append((at, n - take))
        found[part] = first
        if slots:
            open_.append((part, slots))
    return links, found


def _by_part(spark: SparkSession, counts: dict[int, int]) -> DataFrame:
    """(part, n), a row for each partition of a sweep: few enough to be broadcast."""
    return F.broadcast(spark.createDataFrame(list(counts.items()), "part int, n long"))


def _matches(swept: DataFrame, links: list[tuple[int, int, int, int, int, int]]) -> DataFrame:
    """Matched pieces with seq: those of the partitions, and those across them."""
    local = swept.where(F.col("state") == _MATCHED).select(*_OWN, "seq")
    if not links:
        return local
    # No more rows than twice the partitions of the sweep.
    plan = F.broadcast(swept.sparkSession.createDataFrame(links, "link long, piece_part int, first long, n long, gap_part int, top long"))
    one = swept.where(F.col("state") == _PIECE).join(plan, F.expr("part = piece_part and place >= first and place < first + n")).select("link", (F.col("place") - F.col("first")).alias("i"), *_OWN)
    two = swept.where(F.col("state") == _GAP).join(plan, F.expr("part = gap_part and place <= top and place > top - n")).select("link", (F.col("top") - F.col("place")).alias("i"), "seq")
    return local.unionByName(one.join(two, ["link", "i"]).select(*_OWN, "seq"))


def settle(matched: DataFrame, gaps: DataFrame, size: int) -> DataFrame:
    """Pieces with seq and offset, and a row (pid null) of each gap, ``rest`` being what is left of it."""
    rows = matched.select(*_OWN, "seq", F.lit(None).cast("long").alias("width"))
    empty = [F.lit(None).cast("int" if c == "piece" else "long").alias(c) for c in _OWN]
    both = rows.unionByName(gaps.select(*empty, "seq", "width"))
    of_seq = Window.partitionBy("seq").orderBy(F.col("pid").asc_nulls_first())
    width = F.first("width").over(of_seq)
    used = F.coalesce(F.sum("length").over(of_seq.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(0))
    whole = F.coalesce(F.sum("length").over(Window.partitionBy("seq")), F.lit(0))
    return both.select(*_OWN, "seq", (size - width + used - F.col("length")).alias("offset"), F.when(F.col("pid").isNull(), F.col("width") - whole).alias("rest"))


def _place_class(todo: DataFrame, n: int, gaps: DataFrame, low: int, size: int, scratch: Scratch) -> tuple[list[DataFrame], DataFrame]:
    """Places all of ``todo`` (``n`` pieces, longer than ``low``): the tables of placed pieces, and the gaps after."""
    spark, placed = todo.sparkSession, []

    def settled(matched: DataFrame, before: DataFrame) -> DataFrame:
        table = scratch.write(settle(matched, before, size))
        placed.append(table.where("pid is not null").select(*_OWN, "seq", "offset"))
        return table.where("pid is null and rest > 0").select("seq", F.col("rest").alias("width"))

    while n:
        usable = gaps.where(F.col("width") > low)
        if not (n_gaps := usable.count()):
            break
        swept = scratch.write(sweep(todo, usable, -(-n // n_gaps), size))
        per_part = swept.groupBy("part").pivot("state", [_MATCHED, _PIECE, _GAP]).count().na.fill(0).orderBy("part").collect()
        links, found = carry([(r[0], r[2], r[3]) for r in per_part])
        matched = sum(r[1] for r in per_part) + sum(found.values())
        gaps = settled(_matches(swept, links), gaps)
        todo = swept.where(F.col("state") == _PIECE).join(_by_part(spark, found), "part").where("place >= n").select(*_OWN)
        n -= matched
        if matched < _WORTH * (n + matched) or len(per_part) == 1:
            break
    if n:
        swept = scratch.write(sweep(todo, None, size=size))
        fresh = swept.where("seq = pid").select("seq", F.lit(size).cast("long").alias("width"))
        gaps = settled(swept.select(*_OWN, "seq"), gaps.unionByName(fresh))
    return placed, gaps


def pack(docs: DataFrame, size: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", json_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): a row per piece.

    Rounds as above; only counts by partition, and by length, go to the driver. Ties have any
    order. Null ids and repeated rows are pieces like others; other columns are not read, whatever
    their names; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    cut = scratch.write(pieces(docs, size, end_id, id_col, text_col, json_path, ranks_path))
    ends = bounds(size)
    long_ones = cut.where(F.col("length") > ends[0])
    placed = [long_ones.select(*_OWN, F.col("pid").alias("seq"), F.lit(0).cast("long").alias("offset"))]
    gaps = scratch.write(long_ones.where(F.col("length") < size).select(F.col("pid").alias("seq"), (size - F.col("length")).alias("width")))
    lengths = cut.groupBy("length").count().collect()
    for high, low in zip(ends, ends[1:], strict=False):
        todo = cut.where((F.col("length") > low) & (F.col("length") <= high))
        more, gaps = _place_class(todo, sum(n for length, n in lengths if low < length <= high), gaps, low, size, scratch)
        placed += more
    out = placed[0]
    for more in placed[1:]:
        out = out.unionByName(more)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("seq").alias("sequence_id"), "offset")

"""Byte strings that occur more than once in a corpus, by a distributed sparse suffix array.

A string of ``length`` bytes that occurs twice brings with it everything inside it, so suffixes
are sorted only from *anchors*: in each window of ``length`` bytes, the 8 bytes of least hash among
those that start in its first ``SPAN`` bytes (about one position in 60). Windows in a row with the
same anchor are a *block*. Windows can only be equal if they have the same place relative to their
anchors and the anchors' suffixes begin with the same bytes. The steps:

1. Every block becomes a small row (the suffix's key, its leading four bytes and a hash of its
   first 80; a 128-bit digest of the block). Splitters drawn from a sample deal the rows by key to buckets.
   A bucket finds the blocks that occur again as they are, whose windows all repeat, and
   those that share a suffix's beginning but not all of the block.
2. The bytes of the latter, and of one of each set of equal blocks beside them, are dealt by key
   again; each bucket sorts the suffixes that start at their windows by multikey quicksort, eight
   bytes a step, and compares neighbours.

Keys that the sample shows to be too frequent for a bucket are spread over all of them and compared
across buckets by grouped counts; so are suffixes with too many different blocks, window by window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.shared import Scratch, partitions

LENGTH = 200
_GRAM, SPAN = 8, 128
#: How far an anchor may lie behind its window's start, and what every such suffix shares.
_REACH = SPAN - _GRAM
#: Windows handled at once; positions must fit the low bits of a word.
_SEGMENT, _LOW = 1 << 19, np.uint64((1 << 20) - 1)
#: Documents in the sample for splitters (and keys taken from each of its tasks at most).
SAMPLE_DOCS, _SAMPLE_KEYS = 4000, 1 << 17
#: Rows of a bucket that a task holds (about 40 bytes each).
BUCKET_ROWS = 1 << 20
#: Different blocks with one suffix key that one bucket compares; more are compared window by window.
MOST_BLOCKS = 4096
#: Blocks of spread keys that may be broadcast (about 64 bytes each).
_FEW_BLOCKS = 100_000

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_ANCHORS = "bucket int, key long, block long, tail long, id long, h long, at long"


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from every position as a number (not copied)."""
    return np.ndarray((max(len(data) - 7, 0),), "<u8", data, strides=(1,))


def _mix(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    h = (h ^ word) * _M1
    h ^= h >> np.uint64(32)
    h *= _M2
    h ^= h >> np.uint64(29)
    return h


def _blocks(data: np.ndarray, starts: np.ndarray, counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, last window and anchor of each block. ``counts`` windows start from each of
    ``starts``; none crosses a document."""
    hashes = _words(data) * _M1
    hashes ^= hashes >> np.uint64(32)
    hashes *= _M2
    least = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while 2 * width <= _REACH + 1:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = _REACH + 1 - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    anchors = (least & _LOW).astype(np.int64)
    edges = np.zeros(len(data) + 1, np.int8)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + counts, -1)
    windows = np.flatnonzero(np.cumsum(edges[:-1], dtype=np.int8))
    own = anchors[windows]
    cut = np.flatnonzero((np.diff(own) != 0) | (np.diff(windows) != 1)) + 1
    first = np.concatenate([[0], cut])
    last = np.concatenate([cut, [len(windows)]]) - 1
    return windows[first], windows[last], own[first]


def _hashes(data: np.ndarray, a: np.ndarray, b: np.ndarray, p: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix key (leading bytes, then hash of what every such suffix shares) and the halves of the
    block's digest, its anchor's place mixed into the first. Bytes are removed on the digest's word, so
    it is a cryptographic one."""
    words = _words(data)
    shared = np.zeros(len(p), np.uint64)
    for j in range((length - _REACH) // 8):
        shared = _mix(shared, words[p + 8 * j])
    lead = words[p].byteswap() >> np.uint64(32)
    key = (lead << np.uint64(32)) | (shared >> np.uint64(32))
    view, end = memoryview(data), b + length
    digests = b"".join([hashlib.blake2b(view[x:y], digest_size=16).digest() for x, y in zip(a.tolist(), end.tolist(), strict=True)])
    halves = np.frombuffer(digests, "<u8").reshape(-1, 2)
    return key, _mix(halves[:, 0].copy(), (p - a).astype(np.uint64)), halves[:, 1].copy()


def _segments(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(from byte, to byte, rows, their first window, windows) of parts of a batch's bytes."""
    n = np.diff(offsets)
    row = 0
    while row < len(n):
        if n[row] >= _SEGMENT:
            for at in range(0, n[row] - length + 1, _SEGMENT):
                count = min(_SEGMENT, n[row] - length + 1 - at)
                begin = offsets[row] + at
                yield begin, begin + count + length - 1, np.array([row]), np.array([0]), np.array([count])
            row += 1
            continue
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + _SEGMENT, "right")) - 1)
        rows = np.arange(row, stop)
        rows = rows[(n[row:stop] >= length) & (n[row:stop] < _SEGMENT)]
        whole = np.flatnonzero(n[row:stop] >= _SEGMENT)
        if len(whole):
            stop = row + int(whole[0])
            rows = rows[rows < stop]
        if len(rows):
            yield offsets[row], offsets[stop], rows, offsets[rows] - offsets[row], n[rows] - length + 1
        row = stop


def _column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes and the offsets of a binary column (nulls are empty)."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.empty(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)), at


def _batch_blocks(column: pa.Array, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, a, b, p, key, block, tail): blocks of a batch of texts, places counted from the document."""
    data, offsets = _column_bytes(column)
    for begin, end, rows, starts, counts in _segments(offsets, length):
        part = data[begin:end]
        a, b, p = _blocks(part, starts, counts, length)
        key, block, tail = _hashes(part, a, b, p, length)
        row = rows[np.searchsorted(starts, a, "right") - 1]
        back = begin - offsets[row]
        yield row, a + back, b + back, p + back, key, block, tail


def _pack_at(a: np.ndarray, b: np.ndarray, p: np.ndarray) -> np.ndarray:
    return (p << 16) | ((p - a) << 8) | (p - b)


def _unpack_at(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    p = at >> 16
    return p - ((at >> 8) & 255), p - (at & 255), p


def _keyed(docs: DataFrame, text: str, id_col: str) -> DataFrame:
    """(id, h, data): null ids have one stand-in; rows equal in id and text are one document twice."""
    of = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"), F.xxhash64(of).alias("h"), of.cast("binary").alias("data"))


def _sample(docs: DataFrame, length: int, least: int) -> tuple[int, np.ndarray, np.ndarray]:
    """How many buckets there are (``least``, or as many as hold ``BUCKET_ROWS`` blocks each), their
    splitters, and the keys that are more than a bucket by themselves."""
    total = docs.count()
    share = min(1.0, SAMPLE_DOCS / max(total, 1))
    rows = docs if share == 1.0 else docs.sample(share, seed=17)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = [np.empty(0, np.uint64)]
        for batch in batches:
            keys += [x[4] for x in _batch_blocks(batch.column(0), length)]
        out = np.concatenate(keys)
        n = len(out)
        out = np.random.default_rng(17).permutation(out)[:_SAMPLE_KEYS] if n > _SAMPLE_KEYS else out
        yield pa.record_batch([pa.array([n]), pa.array([out.tobytes()], pa.binary())], names=["n", "keys"])

    # The scan keeps its tasks; only the drawn documents are dealt to a few.
    found = rows.select("data").repartition(8).mapInArrow(run, "n long, keys binary").collect()
    n = max(least, int(sum(x[0] for x in found) / share / BUCKET_ROWS) + 1)
    keys = np.sort(np.concatenate([np.empty(0, np.uint64), *[np.frombuffer(bytes(x[1]), np.uint64) for x in found]]))
    values, counts = np.unique(keys, return_counts=True)
    hot = values[counts > max(16, len(keys) / n)]
    plain = keys[~np.isin(keys, hot)]
    splitters = np.unique(plain[(np.arange(1, n) * len(plain)) // n]) if len(plain) else plain
    return n, splitters, hot


def _status(key: np.ndarray, block: np.ndarray, tail: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, ...]:
    """For rows in ``order``: rows of the same block, whether it is the first of them, whether its
    suffix key has a block that occurs once beside others, and how many blocks the key has."""
    k, h, t = key[order], block[order], tail[order]
    new_key = np.concatenate([[True], k[1:] != k[:-1]])
    new = new_key | np.concatenate([[True], (h[1:] != h[:-1]) | (t[1:] != t[:-1])])
    group = np.cumsum(new) - 1
    same = np.bincount(group)[group]
    of_key = np.cumsum(new_key) - 1
    blocks = np.bincount(of_key, weights=new)[of_key]
    open_ = np.bincount(of_key, weights=new & (same == 1))[of_key] > 0
    return same, new, open_ & (blocks > 1), blocks


_FOUND = "kind int, key long, block long, tail long, id long, h long, at long"
#: Kinds of rows: all windows repeat; to be compared; of equal blocks, the one that others are
#: compared to; key too frequent, to be counted across buckets. Too many blocks: kind + 10.
_WHOLE, _OPEN, _MODEL, _SPREAD, _MANY = 0, 1, 2, 3, 10


def _bucketed(docs: DataFrame, length: int, splitters: np.ndarray, hot: np.ndarray, n: int) -> DataFrame:
    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hs = (np.asarray(batch.column(i)) for i in (0, 1))
            for row, a, b, p, key, block, tail in _batch_blocks(batch.column(2), length):
                bucket = np.searchsorted(splitters, key, "right").astype(np.int32)
                if len(hot):
                    spread = np.isin(key, hot)
                    bucket[spread] = ((block[spread] ^ (ids[row[spread]] + p[spread]).astype(np.uint64) * _M1) % np.uint64(n)).astype(np.int32)
                columns = (bucket, key.view(np.int64), block.view(np.int64), tail.view(np.int64), ids[row], hs[row], _pack_at(a, b, p))
                yield pa.record_batch([pa.array(x) for x in columns], names=[x.split()[0] for x in _ANCHORS.split(", ")])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        key, block, tail, ids, hs, at = (np.concatenate([np.asarray(b.column(i)) for b in parts]) for i in range(1, 7))
        spread = np.isin(key.view(np.uint64), hot)
        order = np.lexsort((tail, block, key.view(np.uint64)))
        order = order[~spread[order]]
        picks = [(np.flatnonzero(spread), np.full(int(spread.sum()), _SPREAD))]
        if len(order):
            same, new, open_, blocks = _status(key, block, tail, order)
            many = np.where(blocks > MOST_BLOCKS, _MANY, 0)
            for take, kind in ((same > 1, 0 * many + _WHOLE), (open_ & (same == 1), many + _OPEN), (open_ & (same > 1) & new, many + _MODEL)):
                picks.append((order[take], kind[take]))
        take, kind = (np.concatenate(x) for x in zip(*picks, strict=True))
        columns = (kind.astype(np.int32), key[take], block[take], tail[take], ids[take], hs[take], at[take])
        yield pa.record_batch([pa.array(x) for x in columns], names=[x.split()[0] for x in _FOUND.split(", ")])

    dealt = docs.mapInArrow(anchors, _ANCHORS).repartitionById(n, "bucket")
    return dealt.mapInArrow(compare, _FOUND)


def _across(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """The same decisions for keys spread over buckets, by counts combined before the shuffle.

    There is one row per spread key (fewer than buckets), so those are broadcast; the blocks that
    occur again are counted, and broadcast if few, so that rows of one block stay where they are.
    """
    same = scratch.write(rows.groupBy("key", "block", "tail").agg(F.count("*").alias("same"), F.min(F.struct("id", "h", "at")).alias("first")))
    of_key = same.groupBy("key").agg(F.count("*").alias("blocks"), F.sum((F.col("same") == 1).cast("int")).alias("single"))
    again = same.where("same > 1")
    side = F.broadcast(again) if again.count() <= _FEW_BLOCKS else again
    known = rows.join(F.broadcast(of_key), "key").join(side, ["key", "block", "tail"], "left")
    open_ = (F.col("single") > 0) & (F.col("blocks") > 1)
    many = F.when(F.col("blocks") > MOST_BLOCKS, _MANY).otherwise(0)
    first = F.struct("id", "h", "at") == F.col("first")
    kinds = F.array(
        F.when(F.col("same").isNotNull(), _WHOLE),
        F.when(open_ & F.col("same").isNull(), many + _OPEN),
        F.when(open_ & F.col("same").isNotNull() & first, many + _MODEL),
    )
    return known.select(F.explode(F.filter(kinds, lambda k: k.isNotNull())).alias("kind"), "key", "block", "tail", "id", "h", "at")


def sort_equal(data: np.ndarray, starts: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Which of the strings of ``length`` bytes at ``starts`` equal another one of their group.

    Multikey quicksort, all groups side by side: a group whose next eight bytes aren't all the same
    is sorted by them and falls into groups of equal bytes, which go on with the eight bytes after;
    a string that is alone has no equal and is done.
    """
    words = _words(data)
    order = np.argsort(group, kind="stable")
    group = group[order]
    depths = [*range(0, length - 7, 8)] + [length - 8] * (length % 8 > 0)
    for depth in depths:
        if not len(order):
            break
        new = np.concatenate([[True], group[1:] != group[:-1]])
        number = np.cumsum(new) - 1
        size = np.bincount(number)[number]
        order, group, number = order[size > 1], group[size > 1], number[size > 1]
        if not len(order):
            break
        new = np.concatenate([[True], number[1:] != number[:-1]])
        number = np.cumsum(new) - 1
        word = words[starts[order] + depth]
        differs = word != word[np.flatnonzero(new)][number]
        mixed = (np.bincount(number, weights=differs) > 0)[number]
        at = np.flatnonzero(mixed)
        if len(at):
            value = word[at].byteswap()
            resort = at[np.lexsort((value, number[at]))]
            order[at], word[at] = order[resort], word[resort]
            new[at[1:]] |= (word[at[1:]] != word[at[:-1]]) & (np.diff(at) == 1)
            number = np.cumsum(new) - 1
        group = number
    found = np.zeros(len(starts), bool)
    if len(order):
        size = np.bincount(group)[group]
        found[order[size > 1]] = True
    return found


def _runs(ids: np.ndarray, hs: np.ndarray, windows: np.ndarray, length: int) -> pa.RecordBatch:
    """Repeating windows, given in order of document and place, as spans."""
    cut = np.concatenate([[True], (np.diff(windows) != 1) | (np.diff(ids) != 0) | (np.diff(hs) != 0)]) if len(windows) else np.empty(0, bool)
    first = np.flatnonzero(cut)
    last = np.append(first[1:], len(windows)) - 1 if len(windows) else first
    span = (windows[first] << 32) | (windows[last] + length)
    return pa.record_batch([pa.array(ids[first], pa.int64()), pa.array(hs[first], pa.int64()), pa.array(span, pa.int64())], names=["id", "h", "span"])


_CUT = "bucket int, key long, kind int, id long, h long, at long, bytes binary"


def _compressed(docs: DataFrame) -> DataFrame:
    """Texts as they are dealt by document: a third of their size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = pa.array([pack.compress(x.as_buffer() or b"") for x in batch.column(2)], pa.binary())
            yield pa.record_batch([batch.column(0), batch.column(1), packed], names=["id", "h", "data"])

    return docs.mapInArrow(run, "id long, h long, data binary")


def _cut_blocks(packed: DataFrame, wanted: DataFrame, length: int, splitters: np.ndarray) -> DataFrame:
    """The bytes of the ``wanted`` blocks, from the documents that hold them."""
    of_doc = wanted.groupBy("id", "h").agg(F.collect_list(F.struct("key", "kind", "at")).alias("blocks"))
    once = packed.join(of_doc.hint("shuffle_hash"), ["id", "h"]).select("id", "h", "data", F.col("blocks.key").alias("key"), F.col("blocks.kind").alias("kind"), F.col("blocks.at").alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, done = zstandard.ZstdDecompressor(), None
        for batch in batches:
            for i in range(batch.num_rows):
                me = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
                if me == done:  # a row that repeats: its blocks are there already
                    continue
                done = me
                text = unpack.decompress(batch.column(2)[i].as_buffer())
                key, kind, at = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in (3, 4, 5))
                _, first = np.unique(at * 32 + kind, return_index=True)
                key, kind, at = key[first], kind[first], at[first]
                a, b, _ = _unpack_at(at)
                bucket = np.searchsorted(splitters, key.view(np.uint64), "right").astype(np.int32)
                n = len(at)
                cut = pa.array([text[x:y] for x, y in zip(a.tolist(), (b + length).tolist(), strict=True)], pa.binary())
                yield pa.record_batch([pa.array(bucket), pa.array(key), pa.array(kind), pa.array(np.full(n, me[0], np.int64)), pa.array(np.full(n, me[1], np.int64)), pa.array(at), cut], names=[x.split()[0] for x in _CUT.split(", ")])

    return once.mapInArrow(run, _CUT)


def _compare_blocks(cut: DataFrame, length: int, n: int) -> DataFrame:
    """(id, h, span): windows of the cut blocks that equal another's, each key in one bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        key, kind, ids, hs, at = (np.concatenate([np.asarray(b.column(i)) for b in parts]) for i in range(1, 6))
        data = np.concatenate([d[o[0] : o[-1]] for d, o in (_column_bytes(b.column(6)) for b in parts)])
        sizes = np.concatenate([np.diff(_column_bytes(b.column(6))[1]) for b in parts])
        begin = np.cumsum(sizes) - sizes
        order = np.argsort(key, kind="stable")
        limits = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0, [True]]))
        a, b, p = _unpack_at(at)
        at_once = 1 << 12  # blocks, about 60 windows each
        lo = 0
        while lo < len(limits) - 1:
            hi = max(lo + 1, int(np.searchsorted(limits, limits[lo] + at_once, "right")) - 1)
            rows = np.sort(order[limits[lo] : limits[hi]])
            lo = hi
            count = (b - a + 1)[rows]
            own = np.repeat(rows, count)
            step = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
            _, of_key = np.unique(key[own], return_inverse=True)
            group = of_key * 256 + (p[own] - a[own] - step)
            equal = sort_equal(data, begin[own] + step, group, length)
            equal &= kind[own] % _MANY == _OPEN  # the others are known to repeat
            hit = np.flatnonzero(equal)
            hit = hit[np.lexsort((a[own[hit]] + step[hit], hs[own[hit]], ids[own[hit]]))]
            if len(hit):
                yield _runs(ids[own[hit]], hs[own[hit]], a[own[hit]] + step[hit], length)

    return cut.repartitionById(n, "bucket").mapInArrow(run, "id long, h long, span long")


def _compare_windows(cut: DataFrame, length: int) -> DataFrame:
    """The same for suffixes with very many blocks: each window a row of its 128-bit digest, counted
    by digest before the shuffle, so that no task holds a suffix's blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column(6)[i].as_buffer().to_pybytes()
                a, b, _ = _unpack_at(np.array([batch.column(5)[i].as_py()]))
                n = int(b[0] - a[0]) + 1
                digests = [hashlib.blake2b(text[j : j + length], digest_size=16).digest() for j in range(n)]
                columns = [pa.array([batch.column(c)[i].as_py()] * n, t) for c, t in ((2, pa.int32()), (3, pa.int64()), (4, pa.int64()))]
                yield pa.record_batch([*columns, pa.array(np.arange(a[0], b[0] + 1), pa.int64()), pa.array(digests, pa.binary())], names=["kind", "id", "h", "start", "digest"])

    each = cut.mapInArrow(run, "kind int, id long, h long, start long, digest binary")
    twice = each.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1")
    hit = each.join(twice, "digest").where(F.col("kind") % _MANY == _OPEN)
    return hit.select("id", "h", (F.shiftleft("start", 32).bitwiseOR(F.col("start") + length)).alias("span"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, text: str = "text", id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(id, h, spans) for each document with repeats, spans being from << 32 | to; and the
    documents (id, h, data) that it is about, compressed."""
    if length < SPAN + 64:
        raise ValueError(f"length must be at least {SPAN + 64}")
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffixes")
    keyed = _keyed(docs, text, id_col)
    n, splitters, hot = _sample(keyed, length, partitions(spark))
    found = scratch.write(_bucketed(keyed, length, splitters, hot, n))
    rows = found.where(F.col("kind") != _SPREAD)
    if len(hot):
        rows = rows.unionByName(scratch.write(_across(found.where(F.col("kind") == _SPREAD), scratch)))
    packed = _compressed(keyed)
    cut = scratch.write(_cut_blocks(packed, rows.where(F.col("kind") != _WHOLE), length, splitters))
    p = F.shiftright("at", 16)
    from_, last = p - F.shiftright("at", 8).bitwiseAND(F.lit(255)), p - F.col("at").bitwiseAND(F.lit(255))
    whole = rows.where(F.col("kind") == _WHOLE).select("id", "h", F.shiftleft(from_, 32).bitwiseOR(last + length).alias("span"))
    spans = whole.unionByName(_compare_blocks(cut.where(F.col("kind") < _MANY), length, n)).unionByName(_compare_windows(cut.where(F.col("kind") >= _MANY), length))
    return spans.groupBy("id", "h").agg(F.collect_list("span").alias("spans")), packed


_KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def merge(spans: np.ndarray) -> list[tuple[int, int]]:
    """Spans (from << 32 | to) in order, overlapping and touching ones joined."""
    out: list[tuple[int, int]] = []
    for x in np.sort(spans).tolist():
        start, end = x >> 32, x & 0xFFFFFFFF
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text", id_col: str = "doc_id", keep_bytes: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, and kept if asked for): a row per row of ``docs``.

    Every byte that is in a string of ``length`` bytes which also starts anywhere else in the corpus
    (in UTF-8; the same document counts; judged on the input) is removed. Null texts are empty;
    texts of fewer than ``length`` bytes lose nothing; of repeated rows all lose what repeats.
    """
    spans, packed = repeated_spans(docs, length, text, id_col)
    schema = _KEPT + (", kept binary" if keep_bytes else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for i in range(batch.num_rows):
                data = unpack.decompress(batch.column(1)[i].as_buffer())
                own = batch.column(2)[i]
                runs = merge(own.values.to_numpy(zero_copy_only=False)) if own.is_valid else []
                kept, at = [], 0
                for start, end in runs:
                    kept.append(data[at:start])
                    at = end
                rest = b"".join([*kept, data[at:]])
                doc_id = batch.column(0)[i].as_py()
                for column, x in zip(out, (None if doc_id == -(1 << 63) else doc_id, len(data), len(data) - len(rest), len(runs), hashlib.sha256(rest).hexdigest(), rest if keep_bytes else None), strict=True):
                    column.append(x)
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            names = [x.split()[0] for x in schema.split(", ")]
            yield pa.record_batch([pa.array(x, t) for x, t in list(zip(out, kinds, strict=True))[: len(names)]], names=names)

    joined = packed.join(spans.hint("shuffle_hash"), ["id", "h"], "left").select("id", "data", "spans")
    return joined.mapInArrow(run, schema)

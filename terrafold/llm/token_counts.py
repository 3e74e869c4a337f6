"""Documents and their lengths in flat token files that have no index: separator scan."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrafold.llm.shared import Scratch
from terrafold.llm.tokens import END_OF_TEXT_ID, encoder

BLOCK_IDS = 1 << 16
#: Blocks that one task of the prefix scan takes together; of files read as they lie, bytes.
_GROUP, _GROUP_BYTES = 1024, 1 << 30
_BLOCKS = "file string, block long, data binary, first long, doc_ids array<long>"


def token_stream(docs: DataFrame, end_id: int = END_OF_TEXT_ID, block_ids: int = BLOCK_IDS, id_col: str = "doc_id", text_col: str = "text", json_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """(file, block, data, first, doc_ids): each task's documents as one flat file of 16-bit ids, a
    separator after each document, cut into blocks wherever ``block_ids`` are full.

    Rows with data are the file; the others (data null) list, in order from ordinal ``first``, which
    documents were written, and aren't seen by the scan. A separator's string inside a text is
    encoded as ordinary text, so that it can't end a document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, file = encoder(json_path, ranks_path), f"part-{TaskContext.get().partitionId():05d}"
        kinds = [pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64())]
        row = lambda *x: pa.record_batch([pa.array([v], t) for v, t in zip(x, kinds, strict=True)], names=[c.split()[0] for c in _BLOCKS.split(", ")])
        waiting: list[np.ndarray] = []
        held = block = written = 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for text in batch.column(1):
                own = np.append(encode.plain(text.as_py()), end_id).astype("<u2")
                waiting.append(own)
                held += len(own)
                if held >= block_ids:
                    stream = np.concatenate(waiting)
                    for at in range(0, held - held % block_ids, block_ids):
                        yield row(file, block, stream[at : at + block_ids].tobytes(), None, None)
                        block += 1
                    waiting, held = [stream[held - held % block_ids :]], held % block_ids
            yield row(file, None, None, written, ids)
            written += len(ids)
        if held:
            yield row(file, block, np.concatenate(waiting).tobytes(), None, None)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, _BLOCKS)


def scan(blocks: DataFrame, end_id: int = END_OF_TEXT_ID, id_bytes: int = 2) -> DataFrame:
    """(file, block, n, ends): the ids in a block and the places of separators among them, found by
    one vectorised comparison. Rows without data keep their other columns and have null n."""
    rest = [c for c in blocks.columns if c != "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ns, ends = [], []
            for value in batch.column(len(rest)):
                data = value.as_buffer()
                ids = None if data is None else np.frombuffer(data, f"<u{id_bytes}")
                ns.append(None if ids is None else len(ids))
                ends.append(None if ids is None else np.flatnonzero(ids == end_id))
            arrays = [batch.column(i) for i in range(len(rest))] + [pa.array(ns, pa.int64()), pa.array(ends, pa.list_(pa.int64()))]
            yield pa.record_batch(arrays, names=[*rest, "n", "ends"])

    schema = ", ".join(f"`{c}` {blocks.schema[c].dataType.simpleString()}" for c in rest)
    return blocks.select(*rest, "data").mapInArrow(run, f"{schema}, n long, ends array<long>")


def _before(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Adds, for each row, what stands before it among its keys: ids, documents, and where the last
    separator was (exclusive end; null if there was none), counted from the first row."""
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("ids_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    placed = placed.withColumn("docs_before", F.coalesce(F.sum("docs").over(before), F.lit(0)))
    return placed.withColumn("end_before", F.max(F.col("ids_before") + F.col("last_end")).over(before))


def stitch(scanned: DataFrame, unit: int = 1, group: int | None = None) -> DataFrame:
    """(file, ordinal, start, n_tokens, ended): a row per document, separators not counted.

    A prefix scan over blocks in two levels (groups of blocks, then groups), over counts only,
    gives each block the ids and documents before it and where its first document began. Ids
    after the last separator are a document that hasn't ended; a file that ends with a
    separator has none. An empty file has no rows. ``n`` and ``ends`` may count in parts of an id,
    ``unit`` to each; ``group`` is how far apart the numbers of blocks of one group may be.
    """
    blocks = scanned.select("file", "block", "n", "ends", F.size("ends").cast("long").alias("docs"), (F.array_max("ends") + unit).alias("last_end"))
    blocks = blocks.withColumn("group", F.expr(f"block div {group or _GROUP}"))
    inner = _before(blocks, ["file", "group"], "block")
    groups = inner.groupBy("file", "group").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.max(F.col("ids_before") + F.col("last_end")).alias("last_end"))
    outer = _before(groups, ["file"], "group").select("file", "group", *[F.col(c).alias(f"g_{c}") for c in ("ids_before", "docs_before", "end_before")])
    joined = inner.join(outer, ["file", "group"])
    base = F.col("g_ids_before") + F.col("ids_before")
    began = F.coalesce(F.col("g_ids_before") + F.col("end_before"), F.col("g_end_before"), F.lit(0).cast("long"))
    ends = joined.select("file", (F.col("g_docs_before") + F.col("docs_before")).alias("docs_before"), base.alias("base"), began.alias("began"), "ends", F.posexplode("ends").alias("i", "end"))
    start = F.when(F.col("i") == 0, F.col("began")).otherwise(F.col("base") + F.get("ends", F.col("i") - 1) + unit)
    done = ends.select("file", (F.col("docs_before") + F.col("i")).alias("ordinal"), start.alias("start"), (F.col("base") + F.col("end") - start).alias("n_tokens"), F.lit(True).alias("ended"))
    whole = groups.groupBy("file").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    last = done.groupBy("file").agg(F.max(F.col("start") + F.col("n_tokens") + unit).alias("end"))
    open_ = whole.join(last, "file", "left").withColumn("end", F.coalesce("end", F.lit(0).cast("long"))).where("n > end")
    every = done.unionByName(open_.select("file", F.col("docs").alias("ordinal"), F.col("end").alias("start"), (F.col("n") - F.col("end")).alias("n_tokens"), F.lit(False).alias("ended")))
    if unit == 1:
        return every
    return every.select("file", "ordinal", *[F.expr(f"{c} div {unit}").alias(c) for c in ("start", "n_tokens")], "ended").where("ended or n_tokens > 0")


_RUNS = "file string, size long, split long, at long, n long, ends array<long>"
#: What Spark's line reader takes off the start of a file.
_MARK = b"\xef\xbb\xbf"


def _scan_files(spark: SparkSession, path: str, end_id: int, id_bytes: int) -> DataFrame:
    """(file, size, split, at, n, ends): runs of bytes ``at`` a place in their split, and where in them
    a separator's bytes are, whether or not an id starts there.

    Spark's line reader deals a file of any length to tasks, wherever it is stored, if some byte
    is the end of a line; here it is one that no separator can be cut by, and it is put back.
    """
    wanted = end_id.to_bytes(id_bytes, "little")
    line = next(b for b in range(32, 127) if b not in wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, at, rest = None, 0, b""
        for batch in batches:
            files, sizes, splits = (batch.column(c).to_pylist() for c in range(3))
            cuts = [0, *[i for i in range(1, batch.num_rows) if splits[i] != splits[i - 1] or files[i] != files[i - 1]], batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                if (files[lo], splits[lo]) != before:
                    before, at, rest = (files[lo], splits[lo]), 0, b""
                data = bytes([line]).join([*batch.column(3).slice(lo, hi - lo).to_pylist(), b""])
                held = np.frombuffer(rest + data, np.uint8)
                hits = np.ones(max(len(held) - id_bytes + 1, 0), bool)
                for j, b in enumerate(wanted):
                    hits &= held[j : j + len(hits)] == b
                ends = np.flatnonzero(hits) - len(rest)
                columns = [[files[lo]], [sizes[lo]], [splits[lo]], [at], [len(data)], [ends]]
                kinds = [pa.string(), *[pa.int64()] * 4, pa.list_(pa.int64())]
                yield pa.record_batch([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in _RUNS.split(", ")])
                at, rest = at + len(data), (rest + data)[len(rest + data) - id_bytes + 1 :] if id_bytes > 1 else b""

    lines = spark.read.option("lineSep", chr(line)).text(path)
    facts = [F.col(f"_metadata.{a}").alias(b) for a, b in (("file_path", "file"), ("file_size", "size"), ("file_block_start", "split"))]
    return lines.select(*facts, F.col("value").cast("binary").alias("value")).mapInArrow(run, _RUNS)


def count_files(spark: SparkSession, path: str, end_id: int = END_OF_TEXT_ID, id_bytes: int = 2) -> DataFrame:
    """(file, ordinal, start, n_tokens, ended) of the flat files of little-endian ids at ``path``, of any
    length: as of ``stitch``. Bytes at a file's end that don't fill an id are no token.

    A prefix scan over the splits' bytes says where each run lies, and so which of the separators'
    byte strings are ids.
    """
    if set(end_id.to_bytes(id_bytes, "little")) & set(_MARK):
        raise ValueError("a separator with a byte of the mark that readers take off a file isn't supported")
    seen = Scratch(spark, "token-files").write(_scan_files(spark, path, end_id, id_bytes))
    of_file = Window.partitionBy("file")
    splits = seen.groupBy("file", "size", "split").agg(F.sum("n").alias("bytes")).withColumn("all", F.sum("bytes").over(of_file))
    # A mark that was taken off is missing; the end of a last line that has none in the file is too much.
    splits = splits.withColumn("lost", F.when(F.col("size") - F.col("all") >= len(_MARK) - 1, len(_MARK)).otherwise(0).cast("long"))
    before = F.coalesce(F.sum("bytes").over(of_file.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = splits.select("file", "split", "lost", (F.col("lost") + before).alias("base"))
    runs = seen.join(splits, ["file", "split"]).withColumn("first", F.col("base") + F.col("at"))
    runs = runs.withColumn("from", F.when(F.col("first") == F.col("lost"), 0).otherwise(F.col("first")))
    to = F.least(F.col("first") + F.col("n"), F.col("size"))
    ids = F.filter(F.transform("ends", lambda e: e + F.col("first")), lambda e: (e % id_bytes == 0) & (e + id_bytes <= F.col("size")))
    blocks = runs.select("file", F.col("from").alias("block"), (to - F.col("from")).alias("n"), F.transform(ids, lambda e: e - F.col("from")).alias("ends"))
    return stitch(blocks, id_bytes, _GROUP_BYTES)


def count_documents(docs: DataFrame, end_id: int = END_OF_TEXT_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, file, ordinal, start, n_tokens): ``docs`` as flat token files, scanned.

    A row per row of ``docs``: null and empty texts have 0 tokens, null ids and repeated rows are
    documents like others. The files are written first, as rows of blocks, and scanned by other
    tasks than those that wrote them, which know no lengths; only the scan's counts are shuffled.
    Columns other than the two are not looked at.
    """
    scratch = Scratch(docs.sparkSession, "tokens")
    files = scratch.write(token_stream(docs, end_id, id_col=id_col, text_col=text_col))
    seen = scratch.write(scan(files, end_id))
    scratch.drop(files)
    found = stitch(seen.where("n is not null"))
    order = seen.where("n is null").select("file", "first", F.posexplode("doc_ids").alias("i", "doc_id"))
    order = order.select("file", (F.col("first") + F.col("i")).alias("ordinal"), "doc_id")
    return order.join(found, ["file", "ordinal"]).select("doc_id", "file", "ordinal", "start", "n_tokens")

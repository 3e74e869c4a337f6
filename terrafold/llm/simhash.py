"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrafold.llm.components import components
from terrafold.llm.shared import Scratch, without

#: Hashes whose bits are counted at once.
_BLOCK = 1 << 15


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """The unsigned 64-bit fingerprint of one text; 0 if it has no words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < width:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    of = xxhash.xxh64_intdigest
    n = len(words) - width + 1
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    hashes = np.fromiter((of(s, seed) for s in shingles), "<u8", n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _BLOCK):
        part = hashes[at : at + _BLOCK]
        bits = np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, h, fp): one row per row of ``docs``; fp is the fingerprint's 64 bits as a signed long,
    h the xxhash64 of the text. A null text has no words, which gives 0. Other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), width, seed) for t in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], names=["doc_id", "h", "fp"])

    text = F.col(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, h long, fp long")


def _masks(radius: int) -> list[int]:
    """Every change of up to ``radius`` of 64 bits, as signed longs."""
    changes = [sum(1 << i for i in at) for n in range(radius + 1) for at in combinations(range(64), n)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in changes]


def links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """Links between different fingerprints (column ``fp``) that join all pairs within ``radius`` bits.

    Fingerprints at most ``radius`` (even) apart share a variant within half of it. All that share a
    variant are within ``radius`` of each other, so each is linked to the least of them: a
    spanning set of the pairs, not the pairs. A variant has no more than 65 fingerprints at
    radius 2, however often the texts repeat.
    """
    if radius % 2:
        raise ValueError("radius must be even")
    masks = F.array(*[F.lit(m).cast("long") for m in _masks(radius // 2)])
    emitted = fps.select("fp").distinct().select("fp", F.explode(masks).alias("mask"))
    near = emitted.select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))
    near = near.withColumn("least", F.min("fp").over(Window.partitionBy("variant")))
    pairs = near.where("least < fp").select("least", "fp").distinct()
    return pairs.where(F.bit_count(F.col("least").bitwiseXOR(F.col("fp"))) <= radius)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, seed: int = 42, radius: int = 2) -> DataFrame:
    """(doc_id, h, fp, root, component_id): a row per row of ``docs``.

    component_id is the smallest doc_id that can be reached over links, root the
    least fingerprint of the component. Equal fingerprints are one node, so copies cost one row each. Repeated rows are
    linked to each other; null ids get the component's smallest non-null id, or null if it has
    none. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.write(fingerprints(docs, id_col, text_col, width, seed))
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(rows, radius), scratch)
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_fp = rooted.join(least, "root").select("fp", "root", "component_id")
    return rows.join(of_fp, "fp").select("doc_id", "h", "fp", "root", "component_id")


def keep_one(docs: DataFrame, groups: Callable[[DataFrame], DataFrame] = near_duplicates) -> DataFrame:
    """``docs`` with one document of each component: that of the smallest doc_id (null ids last; of
    equal ids that of the least text hash; of rows equal in both, any one). ``groups`` gives
    (doc_id, h, root) of each row."""
    found = Scratch(docs.sparkSession, "found").write(groups(docs).select("doc_id", "h", "root"))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("h"))
    first = found.groupBy("root").agg(F.min(order).alias("first"))
    ranked = found.join(first, "root").select("doc_id", "h", order.eqNullSafe(F.col("first")).alias("stays"))
    out = without(docs, ranked.where("not stays"))
    repeated = Scratch(docs.sparkSession, "repeated").write(ranked.where("stays").groupBy("doc_id", "h").count().where("count > 1"))
    if repeated.isEmpty():
        return out
    again = docs.alias("docs").join(repeated.alias("r").hint("shuffle_hash"), F.expr("docs.doc_id <=> r.doc_id and xxhash64(docs.text) = r.h"), "left_semi")
    return without(out, repeated).unionByName(again.dropDuplicates(["doc_id", "text"]))

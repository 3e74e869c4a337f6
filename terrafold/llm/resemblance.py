"""Near-duplicates by resemblance: candidates from SimHash components and MinHash bands, decided by their
shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrafold.llm import simhash
from terrafold.llm.components import components
from terrafold.llm.shared import _FEW, Scratch, slices, small

#: Words of a shingle, and the Jaccard similarity of shingle sets from which texts are near copies.
WORDS, SIMILARITY = 5, 0.8
#: Bands, and minima in each: a pair of similarity s shares a band with probability
#: 1 - (1 - s ** DEPTH) ** BANDS, which is 0.99993 at 0.8.
BANDS, DEPTH = 24, 5
#: Shingles that are hashed at once.
_BLOCK = 4096
_rng = np.random.default_rng(5)
_FACTORS = _rng.integers(0, 1 << 63, BANDS * DEPTH, np.uint64) * np.uint64(2) + np.uint64(1)
_ADDED = _rng.integers(0, 1 << 63, BANDS * DEPTH, np.uint64)


def shingles(text: str | None, width: int = WORDS) -> np.ndarray:
    """The different hashes of a text's shingles in order; a text of fewer words is one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    n = max(1, len(words) - width + 1)
    of = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((of(b" ".join(words[i : i + width])) for i in range(n)), np.uint64, n))


def bands(hashes: np.ndarray) -> list[int]:
    """A key for each band of a set, as signed longs; none for an empty set."""
    if not len(hashes):
        return []
    least = np.full(BANDS * DEPTH, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), _BLOCK):
        np.minimum(least, (hashes[at : at + _BLOCK, None] * _FACTORS + _ADDED).min(axis=0), out=least)
    keys = [xxhash.xxh64_intdigest(x.tobytes(), k) for k, x in enumerate(least.reshape(BANDS, DEPTH))]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of hashes."""
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return shared / (len(both) - shared) if len(both) else 1.0


def _sets(docs: DataFrame) -> DataFrame:
    """(doc_id, h, node, hashes, keys, fp, rid): node stands for the set of shingles, fp is the text's
    SimHash fingerprint, rid stands for the row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(2).to_pylist()
            made = [shingles(t) for t in texts]
            fps = np.fromiter((simhash.fingerprint(t) for t in texts), np.uint64, len(texts))
            data = [x.tobytes() for x in made]
            nodes = np.array([xxhash.xxh64_intdigest(x) for x in data], np.uint64).view(np.int64)
            columns = [batch.column(0), batch.column(1), pa.array(nodes), pa.array(data, pa.binary()), pa.array([bands(x) for x in made], pa.list_(pa.int64())), pa.array(fps.view(np.int64))]
            yield pa.record_batch(columns, names=["doc_id", "h", "node", "hashes", "keys", "fp"])
        pa.default_memory_pool().release_unused()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text")
    return rows.mapInArrow(run, "doc_id long, h long, node long, hashes binary, keys array<long>, fp long").withColumn("rid", F.monotonically_increasing_id())


def _similar(pairs: DataFrame, made: DataFrame, scratch: Scratch) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets are similar, by the sets themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = ([np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column(i)] for i in (2, 3))
            keep = pa.array([similarity(p, q) >= SIMILARITY for p, q in zip(x, y, strict=True)], pa.bool_())
            yield batch.select(["a", "b"]).filter(keep)

    pairs = scratch.write(pairs)
    need = scratch.write(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
    side = F.broadcast(need) if need.count() <= _FEW else need.hint("shuffle_hash")
    sets = scratch.write(made.select("node", "hashes").join(side, "node", "left_semi").dropDuplicates(["node"]))
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b")
    found = scratch.write(both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long"))
    scratch.drop(sets)
    return found


def _exploded(sets: DataFrame) -> DataFrame:
    """(node, shingle): a row for each shingle of each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = np.frombuffer(value.as_buffer(), np.int64)
                for at in range(0, len(own), _BLOCK):
                    part = own[at : at + _BLOCK]
                    yield pa.record_batch([pa.array(np.full(len(part), node)), pa.array(part)], names=["node", "shingle"])

    return sets.select("node", "hashes").mapInArrow(run, "node long, shingle long")


_SIZE = "octet_length(hashes) div 8 as size"


def _sets_of(nodes: DataFrame, made: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, hashes, and the other columns of ``nodes``): each set once, from one of its rows, where that
    row lies if the nodes are few enough to be broadcast."""
    first = made.groupBy("node").agg(F.min("rid").alias("rid")).join(nodes, "node")
    return made.select("rid", "hashes").join(small(scratch.write(first)), "rid").drop("rid")


def _known(nodes: DataFrame, made: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, size, common): how many shingles each of ``nodes`` has, and how many of these stand in
    another of ``nodes``. A shingle of one set only is counted there, without a join back."""
    sets = _sets_of(nodes, made, scratch)
    once = _exploded(sets).groupBy("shingle").agg(F.min("node").alias("node"), F.count("*").alias("n")).where("n = 1")
    single = once.groupBy("node").agg(F.count("*").alias("single"))
    known = sets.selectExpr("node", _SIZE).join(single, "node", "left").select("node", "size", (F.col("size") - F.coalesce("single", F.lit(0))).alias("common"))
    return scratch.write(known)


def _across(rooted: DataFrame, made: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b): the pairs of ``rooted`` (node, root) that have different roots and may be similar.

    An exact prefix join: shingles are ordered by how rare they are, and sets that are similar share
    one among the first 1 - ``SIMILARITY`` of each. What they share can't begin before the first
    such shingle, so its places bound how much that is. Of each shingle's sets, those of the most
    frequent root are not compared with each other.
    """
    sets = scratch.write(_sets_of(rooted, made, scratch).selectExpr("node", "root", _SIZE, "hashes"))
    each = scratch.write(_exploded(sets))
    rarity = each.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    ranked = each.join(rarity, "shingle", "left").select("node", "shingle", F.coalesce("df", F.lit(1)).alias("df"))
    place = F.row_number().over(Window.partitionBy("node").orderBy("df", "shingle")) - 1
    first = ranked.withColumn("place", place).where("df > 1").join(sets.drop("hashes"), "node")
    left = (F.col("size") - F.col("place")).alias("left")
    first = scratch.write(first.where(F.col("place") <= F.col("size") - F.ceil(SIMILARITY * F.col("size") - 1e-6)).select("shingle", "node", "root", "size", left))
    of_root = first.groupBy("shingle", "root").agg(F.count("*").alias("n"))
    top = of_root.groupBy("shingle").agg(F.max_by("root", F.struct("n", "root")).alias("top"), F.count("*").alias("roots")).where("roots > 1").select("shingle", "top")
    others = first.join(top, "shingle").where("root <> top").drop("top").alias("x")
    enough = F.least("x.left", "y.left") * (1 + SIMILARITY) >= SIMILARITY * (F.col("x.size") + F.col("y.size")) - 1e-6
    pairs = others.join(first.alias("y"), F.expr("x.shingle = y.shingle and x.root <> y.root") & enough)
    pairs = scratch.write(pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct())
    for table in (sets, each, first):
        scratch.drop(table)
    return pairs


def _may_be(a: Column, b: Column) -> Column:
    """Whether sets with these sizes and shingles in common with any others can be similar at all:
    they share at most the lesser of what each has in common with others."""
    return F.least(a["common"], b["common"]) * (1 + SIMILARITY) >= SIMILARITY * (a["size"] + b["size"]) - 1e-6


def _by_fingerprint(made: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, key): a key for each set with words and each SimHash component that one of its texts is of
    (fingerprints linked at 2 or fewer differing bits, by ball hashing)."""
    own = scratch.write(made.where("octet_length(hashes) > 0").select("node", "fp").distinct())
    roots = components(simhash.links(own), scratch).withColumnRenamed("node", "fp")
    return own.join(roots, "fp", "left").select("node", F.xxhash64(F.lit("simhash"), F.coalesce("root", "fp")).alias("key"))


def similar_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, h, root): a row per row of ``docs``; rows whose sets are linked have the same root.

    Links are pairs that are similar and share a SimHash component or, as near copies can be further
    apart than its bits, a MinHash band; below, both are called bands. A set of which less than ``SIMILARITY`` stands
    in any other set is similar to none. The others of a band are first compared with the one that
    has the least share of its own (of near copies, the text that they are copies of), so that a
    group of near copies costs a pair for each; those that are then in different groups go through
    an exact prefix join. All bounds are exact, so no link is lost. Texts without words are one
    group.
    """
    scratch = Scratch(docs.sparkSession, "resemblance")
    made = scratch.write(_sets(docs))
    each = scratch.write(made.select("node", F.explode("keys").alias("key")).union(_by_fingerprint(made, scratch)).distinct())
    often = each.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    nodes = scratch.write(each.join(often, "key", "left_semi").select("node").distinct())
    known = _known(nodes, made, scratch).where(F.col("common") >= SIMILARITY * F.col("size") - 1e-6)
    member = F.struct("node", "size", "common").alias("x")
    banded = each.join(known, "node").select("key", member)
    own_share = (F.col("x.size") - F.col("x.common")) / F.col("x.size")
    least = banded.groupBy("key").agg(F.min_by("x", F.struct(own_share, "x.node")).alias("least"), F.count("*").alias("n")).where("n > 1")
    shared = scratch.write(banded.join(least, "key").select("key", "least", "x"))
    scratch.drop(each)
    ends = [F.least("least.node", "x.node").alias("a"), F.greatest("least.node", "x.node").alias("b")]
    tested = scratch.write(shared.where(F.col("x.node") != F.col("least.node")).where(_may_be(F.col("x"), F.col("least"))).select(*ends).distinct())
    stars = _similar(tested, made, scratch)
    label = components(stars, scratch)
    labelled = shared.join(label, F.col("x.node") == label["node"], "left").select("key", "x", F.coalesce("root", "x.node").alias("root"))
    mixed = labelled.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
    rest = scratch.write(labelled.join(mixed, "key").select("x.node", "root").distinct())
    apart = _across(rest, made, scratch)
    more = _similar(apart.join(tested, ["a", "b"], "left_anti"), made, scratch)
    roots = components(stars.union(more), scratch)
    return made.select("doc_id", "h", "node").join(roots, "node", "left").select("doc_id", "h", F.coalesce("root", "node").alias("root"))

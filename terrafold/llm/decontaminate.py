"""Benchmark passages in documents by a positional inverted index; native expressions only.

Documents are cut into words once. The index holds the places of the terms that decide a window: its
rarest two. It is written once, with places moved to where the window would start; exact phrases and
proximity matches both read it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrafold.llm.shared import Scratch, small, without

WINDOW = 10
#: Terms whose lists are intersected for each window, the rarest first.
LISTS = 2
#: Words by which the rarest terms of a proximity match may be off the distance that they have in the window.
SLOP = 5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _split(text: Column) -> Column:
    """Words of a text with A-Z in lower case; the first and the last may be empty strings."""
    plain = F.length(text) == F.octet_length(text)
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.split(F.coalesce(lowered, F.lit("")), _BETWEEN, -1)


def words(text: Column) -> Column:
    return F.filter(_split(text), lambda w: w != "")


def _count(split: Column) -> Column:
    n = F.size(split)
    return (n - (split[0] == "").cast("int") - ((n > 1) & (F.element_at(split, -1) == "")).cast("int")).cast("long")


def tokens(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, doc_id, h, n_words, w): the words of each row, written. rid is a number of the row, so that
    rows that are equal, or have no id, are told apart; h is the hash of the text."""
    text = F.col(text_col)
    cut = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), _split(text).alias("w"))
    return scratch.write(cut.select("rid", "doc_id", "h", _count(F.col("w")).alias("n_words"), "w"))


def windows(benchmark: DataFrame, scratch: Scratch, size: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(wid, n, words), the different windows of all items, and (wid, item_id), the items of each.

    Items without words have no windows, items of fewer than ``size`` words are one. Null ids have
    windows but aren't listed.
    """
    w = F.col("w")
    items = benchmark.select(F.col(id_col).cast("string").alias("item_id"), words(F.col(text_col)).alias("w")).where(F.size(w) > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size(w) - size + 1, F.lit(1)))
    each = items.select("item_id", F.explode(F.transform(starts, lambda i: F.slice(w, i, size))).alias("words"))
    found = scratch.write(each.select("words").distinct().select(F.monotonically_increasing_id().alias("wid"), F.size("words").alias("n"), "words"))
    return found, scratch.write(each.where("item_id is not null").join(found, "words").select("wid", "item_id").distinct())


def rarest(found: DataFrame, cut: DataFrame, scratch: Scratch) -> DataFrame:
    """(wid, rank, term, offset, n, whole): the LISTS rarest terms of each window that occur in the
    documents, by how often they do; whole if all its terms do."""
    at = scratch.write(found.select("wid", "n", F.posexplode("words").alias("offset", "term")))
    vocabulary = scratch.write(at.select("term").distinct())
    counts = cut.select(F.explode("w").alias("term")).join(small(vocabulary, "term"), "term").groupBy("term").count()
    by_window = Window.partitionBy("wid")
    ranked = at.join(counts, "term").withColumn("whole", F.count("*").over(by_window) == F.col("n"))
    rank = F.row_number().over(by_window.orderBy("count", "offset")) - 1
    return scratch.write(ranked.withColumn("rank", rank).where(F.col("rank") < LISTS).select("wid", "rank", "term", "offset", "n", "whole"))


class Index:
    """The written index of documents for a benchmark: ``cut`` words, ``found`` windows, ``items`` of
    windows, and ``lists`` (rid, wid, rank, start, n, whole): the places of the rarest terms of
    each window, less the term's offset in it: where the window would start. Places are counts of
    words from 0 (from 1 if the text begins with a separator)."""

    def __init__(self, docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"):
        self.scratch = scratch = Scratch(docs.sparkSession, "postings")
        self.cut = tokens(docs, scratch, id_col, text_col)
        self.found, self.items = windows(benchmark, scratch, size)
        terms = rarest(self.found, self.cut, scratch)
        each = self.cut.select("rid", F.posexplode("w").alias("pos", "term"))
        lists = each.join(small(terms, "term"), "term")
        self.lists = scratch.write(lists.select("rid", "wid", "rank", (F.col("pos") - F.col("offset")).alias("start"), "n", "whole"))

    def phrases(self) -> DataFrame:
        """(rid, wid, start, n): every occurrence of a window in a document.

        A start that the lists of all chosen terms share is a candidate. The other words of the
        candidates are looked up where they would stand, each by its own row and place.
        """
        near = self.lists.where("whole and start >= 0").groupBy("rid", "wid", "start", "n").agg(F.bit_count(F.bit_or(F.expr("1 << rank"))).alias("lists"))
        near = self.scratch.write(near.where(F.col("lists") == F.least("n", F.lit(LISTS))).drop("lists"))
        wanted = near.join(small(self.found.select("wid", "words"), "array_join(words, ' ')"), "wid").select("rid", "wid", "start", "n", F.posexplode("words").alias("k", "term"))
        wanted = wanted.select("rid", "wid", "start", "n", (F.col("start") + F.col("k")).alias("pos"), "term")
        rows = small(self.scratch.write(near.select("rid").distinct()))
        there = self.cut.join(rows, "rid").select("rid", F.posexplode("w").alias("pos", "term"))
        there = there.join(self.scratch.write(wanted.select("rid", "pos").distinct()).hint("shuffle_hash"), ["rid", "pos"], "left_semi")
        same = wanted.join(there, ["rid", "pos", "term"]).groupBy("rid", "wid", "start", "n").agg(F.count("*").alias("found"))
        return self.scratch.write(same.where("found = n").drop("found"))

    def near(self, slop: int = SLOP) -> DataFrame:
        """(rid, wid, start): where the two rarest terms of a window stand as far apart as in it, or up
        to ``slop`` words more or less, whatever stands between; the first such place of each
        document. The term itself, for a window of one word; other windows of which only one term
        occurs have none."""
        a = self.lists.where("rank = 0").select("rid", "wid", "start", "n", F.expr(f"start div {slop + 1}").alias("cell"))
        b = self.lists.where("rank = 1").select("rid", "wid", F.col("start").alias("other"), F.expr(f"start div {slop + 1}").alias("at"))
        cells = b.select("rid", "wid", "other", F.explode(F.expr("array(at - 1, at, at + 1)")).alias("cell"))
        cells = cells.groupBy("rid", "wid", "cell").agg(F.sort_array(F.collect_set("other")).alias("others"))
        close = F.exists("others", lambda o: F.abs(o - F.col("start")) <= slop)
        pairs = a.join(cells, ["rid", "wid", "cell"]).where(close).select("rid", "wid", "start")
        single = a.where("n = 1").select("rid", "wid", "start")
        return pairs.unionByName(single).groupBy("rid", "wid").agg(F.min("start").alias("start"))

    def listed(self, matches: DataFrame, name: str) -> DataFrame:
        """(rid, name): the sorted ids of the items whose windows ``matches`` has."""
        pairs = matches.select("rid", "wid").distinct().join(self.items, "wid").select("rid", "item_id").distinct()
        return pairs.groupBy("rid").agg(F.array_sort(F.collect_list("item_id")).alias(name))


def phrase_matches(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, start, n, wid): every occurrence of a window in a document, for each row."""
    index = Index(docs, benchmark, size, id_col, text_col)
    return index.phrases().join(index.cut.select("rid", "doc_id", "h"), "rid").drop("rid")


def proximity_matches(docs: DataFrame, benchmark: DataFrame, slop: int = SLOP, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, start, wid): the proximity matches (``Index.near``) of each row."""
    index = Index(docs, benchmark, size, id_col, text_col)
    return index.near(slop).join(index.cut.select("rid", "doc_id", "h"), "rid").drop("rid")


def _covered(hits: DataFrame) -> DataFrame:
    """(rid, n_hit): words inside any occurrence, counted once."""
    spans = hits.groupBy("rid", "start").agg(F.max(F.col("start") + F.col("n")).alias("end"))
    before = F.max("end").over(Window.partitionBy("rid").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.col("end") - F.greatest("start", F.coalesce("before", F.lit(0))), F.lit(0))
    return spans.withColumn("before", before).groupBy("rid").agg(F.sum(fresh).cast("long").alias("n_hit"))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", slop: int = SLOP) -> DataFrame:
    """(doc_id, n_words, n_hit, item_ids, near_ids): a row per row of ``docs``.

    item_ids are the items of which a window occurs; near_ids those of which one has a proximity
    match. Null and empty texts have no words. Repeated rows and null ids get the result of their
    text. An empty benchmark hits nothing; other columns are not read, whatever their names.
    """
    index = Index(docs, benchmark, size, id_col, text_col)
    hits = index.phrases()
    out = index.cut.select("rid", "doc_id", "n_words")
    for part in (_covered(hits), index.listed(hits, "item_ids"), index.listed(index.near(slop), "near_ids")):
        out = out.join(part, "rid", "left")
    none = F.expr("cast(array() as array<string>)")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("item_ids", none).alias("item_ids"), F.coalesce("near_ids", none).alias("near_ids"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` without those that hold a window of the benchmark: an exact one, as two rare terms near
    each other are also in clean documents. Null texts and null ids stay or go by their text."""
    return without(docs, phrase_matches(docs, benchmark, size))

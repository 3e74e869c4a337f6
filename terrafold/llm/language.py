"""Language identification by Bayesian fusion of text, markup, address and host evidence."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.llm.shared import Scratch, slices, small, without
from terrafold.runtime import ship_package

BINS = 1 << 16
#: Texts are scored together up to this many bytes; a longer one is scored in parts.
_CHUNK = 1 << 20
#: A text whose trigrams are, by the best language, hardly likelier than evenly spread ones is none.
_LEAST_MEAN = -np.log(BINS) + 0.75
#: Trigrams overlap, so their evidence is counted as a third.
_TEMPER = 1 / 3
#: Weight, in rows, of the wider level in host and suffix priors, and of each cell of the others.
_SMOOTH, _CELL = 20.0, 1.0


#: A-Z in lower case; ASCII that is no letter is a space: numbers, signs and marks say nothing.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def _trigrams(data: bytes) -> np.ndarray:
    """Bin of every three bytes of words and single spaces."""
    b = np.frombuffer(data.translate(_PLAIN), np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, np.uint32)
    bins = ((b[:-2] * np.uint32(2654435761)) ^ (b[1:-1] * np.uint32(40503 << 8)) ^ (b[2:] * np.uint32(2246822519))) >> np.uint32(16)
    space = b == 32
    return bins[~((space[:-2] & space[1:-1]) | (space[1:-1] & space[2:]))]


@dataclass
class TextModel:
    """log P(trigram | language) for each fold, language and bin; languages in order. Size: 512 kB for
    each language. A fold's table has seen no text of that fold (``fold_of``), so that no label is
    evidence for itself."""

    languages: list[str]
    table: np.ndarray

    def scores(self, text: str | None, fold: int = 0) -> tuple[np.ndarray, int]:
        """Sum of log-likelihoods by language over the whole text, and how many trigrams it has."""
        data = f" {text or ''} ".encode("utf-8", "surrogatepass")
        total, n = np.zeros(len(self.languages)), 0
        for at in range(0, len(data), _CHUNK):
            bins = _trigrams(data[at : at + _CHUNK + 2])
            n += len(bins)
            for k in range(len(self.languages)):
                total[k] += self.table[fold][k][bins].sum(dtype=np.float64)
        return total, n


FOLDS = 2


def fold_of(text: str | Column) -> Column:
    return F.pmod(F.shiftright(F.xxhash64(text), 40), F.lit(FOLDS)).cast("int")


def train(labelled: DataFrame, label: str = "lang", text: str = "text", per_language: int = 500, most_languages: int = 256) -> TextModel:
    """Fits the text model on about ``per_language`` different texts of each label, chosen by hash.

    The sample is bounded by ``per_language * most_languages`` texts, whatever the size of the
    table and however often a text is repeated; labels beyond the ``most_languages`` most frequent
    aren't languages of the model. Rows without label or text don't count; without any, the model has
    no languages.
    """
    ship_package(labelled.sparkSession)
    rows = labelled.select(F.col(label).alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null").withColumn("k", F.xxhash64("text"))
    per_label = rows.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("k").alias("texts"))
    counts = per_label.orderBy(F.desc("n"), "lang").limit(most_languages).collect()
    if not counts:
        return TextModel([], np.zeros((FOLDS, 0, BINS), np.float32))
    share = F.create_map(*[F.lit(x) for lang, _, n in counts for x in (lang, float(min(1.0, per_language / max(n, 1))))])
    drawn = F.pmod("k", F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int], np.ndarray] = {}
        for batch in batches:
            for lang, fold, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                bins = _trigrams(f" {value.as_py()} ".encode("utf-8", "surrogatepass"))
                own = sums.setdefault((lang, fold), np.zeros(BINS, np.int64))
                own += np.bincount(bins, minlength=BINS)
        names = list(sums)
        columns = [pa.array([x[0] for x in names], pa.string()), pa.array([x[1] for x in names], pa.int32()), pa.array([sums[x].astype("<i8").tobytes() for x in names], pa.binary())]
        yield pa.record_batch(columns, names=["lang", "fold", "counts"])

    sample = rows.where(drawn).dropDuplicates(["lang", "k"]).select("lang", fold_of("text").alias("fold"), "text")
    parts = sample.repartition(8, "lang").mapInArrow(count, "lang string, fold int, counts binary").collect()
    languages = sorted(lang for lang, _, _ in counts)
    table = np.full((FOLDS, len(languages), BINS), 0.5)
    for lang, fold, data in parts:
        others = [f for f in range(FOLDS) if f != fold]
        table[others, languages.index(lang)] += np.frombuffer(bytes(data), "<i8")
    return TextModel(languages, np.log(table / table.sum(axis=2, keepdims=True)).astype(np.float32))


def text_evidence(docs: DataFrame, model: TextModel, text: str = "text") -> DataFrame:
    """``docs`` without its text but with ll: array<double>, log P(text | language) by language,
    and trigrams: how many it was made of."""
    rest = [c for c in docs.columns if c != text]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared.value
        for batch in slices(batches):
            lls, ns = [], []
            for fold, value in zip(batch.column(len(rest)).to_pylist(), batch.column(len(rest) + 1), strict=True):
                ll, n = of.scores(value.as_py(), fold)
                lls.append(ll.tolist())
                ns.append(n)
            arrays = [batch.column(i) for i in range(len(rest))] + [pa.array(lls, pa.list_(pa.float64())), pa.array(ns, pa.int64())]
            yield pa.record_batch(arrays, names=[*rest, "ll", "trigrams"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest)
    return docs.select(*rest, F.coalesce(fold_of(text), F.lit(0)).alias("_fold"), text).mapInArrow(run, f"{schema}, ll array<double>, trigrams long")


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))


def suffix_of(url: Column) -> Column:
    return F.regexp_extract(host_of(url), r"\.([^.]+)$", 1)


def declared_in(html: Column) -> Column:
    return F.lower(F.regexp_extract(html, r"(?i)<html[^>]*?\blang\s*=\s*[\"']?([a-z]+)", 1))


def _sums(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Counts by language for each key, combined before the shuffle: a frequent key costs no more."""
    each = [F.sum((F.col("best") == i).cast("double")) for i in range(k)]
    return rows.groupBy(*keys).agg(F.array(*each).alias("n"))


def _totals(heard: DataFrame, k: int) -> list[list[float]]:
    """Rows by language: of all, of those with a declared language, of those with a suffix."""
    wheres = (F.lit(True), F.col("declared").isNotNull(), F.col("suffix") != "")
    sums = [F.coalesce(F.sum(((F.col("best") == i) & w).cast("double")), F.lit(0.0)) for w in wheres for i in range(k)]
    row = heard.agg(*[x.alias(f"n{j}") for j, x in enumerate(sums)]).first()
    return [list(row[i * k : (i + 1) * k]) for i in range(3)]


def _likelihoods(rows: DataFrame, key: str, whole: list[float], name: str) -> DataFrame:
    """log P(key | language) by language for each key."""
    all_rows = F.array(*[F.lit(x) for x in whole])
    log = F.zip_with("n", all_rows, lambda a, b: F.log((a + _CELL) / (b + 2 * _CELL)))
    return _sums(rows, [key], len(whole)).select(key, log.alias(name))


def identify(docs: DataFrame, model: TextModel, text: str = "text", declared: str | None = "lang", host: str | None = "source", suffix: str | None = None) -> DataFrame:
    """All columns of ``docs`` but the text, and lang, probability, text_lang, accepted (columns of
    these names are replaced; others keep theirs, whatever they are).

    Posterior = text likelihood (tempered) x P(declared | language) x P(suffix | language) x host
    prior. The last three are counted over all rows by grouped aggregation, rows standing for the
    language that their text alone gives. The host prior is smoothed with its suffix's
    distribution, that with all rows'. Missing evidence (null or empty) says nothing. A row is
    accepted unless it has no letter, its text is unlike every language, or no language has half
    of the posterior; then lang is null. Repeated rows are rows like others. With an empty model
    lang is null and every row with a letter is accepted. Of languages that are equally likely the
    first by name is taken. Null texts have no letter; null ids are ids like others; no rows
    give no rows.
    """
    k = len(model.languages)
    clean = lambda c: F.nullif(F.lower(F.trim(F.col(c).cast("string"))), F.lit("")) if c else F.lit(None).cast("string")
    made = ("lang", "probability", "text_lang", "accepted")
    kept = [c for c in docs.columns if c != text and c not in made]
    facts = docs.select(
        F.struct(F.lit(0).alias("_"), *[F.col(c) for c in kept]).alias("row"),
        clean(declared).alias("declared"),
        clean(host).alias("host"),
        F.coalesce(clean(suffix), F.lit("")).alias("suffix"),
        F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letters"),
        F.col(text).alias("text"),
    )
    scratch = Scratch(docs.sparkSession, "language")
    rows = scratch.write(text_evidence(facts, model))
    own = [F.col(f"row.{c}").alias(c) for c in kept]
    if not k:
        none = F.lit(None).cast("string")
        return rows.select(*own, none.alias("lang"), F.lit(0.0).alias("probability"), none.alias("text_lang"), F.col("letters").alias("accepted"))
    alike = F.col("letters") & (F.col("trigrams") > 0) & (F.array_max("ll") / F.greatest("trigrams", F.lit(1)) > _LEAST_MEAN)
    rows = rows.withColumn("best", F.expr("array_position(ll, array_max(ll))").cast("int") - 1).withColumn("alike", alike)
    heard = rows.where("alike")
    whole, marked, ended = _totals(heard, k)
    total = sum(whole) + k * _CELL
    overall = F.array(*[F.lit((n + _CELL) / total) for n in whole])
    mark = _likelihoods(heard.where("declared is not null"), "declared", marked, "mark")
    end = _likelihoods(heard.where("suffix <> ''"), "suffix", ended, "end")
    mix = lambda n, p: F.zip_with(n, p, lambda a, b: (a + _SMOOTH * b) / (F.aggregate(n, F.lit(0.0), lambda x, y: x + y) + _SMOOTH))
    p_suffix = _sums(heard, ["suffix"], k).select("suffix", mix("n", overall).alias("p"))
    hosts = _sums(heard.where("host is not null"), ["host", "suffix"], k)
    prior = hosts.join(p_suffix, "suffix").select("host", "suffix", F.transform(mix("n", "p"), lambda p: F.log(p)).alias("prior"))
    # Written and counted, so that a host with a third of all rows stays where its rows lie.
    mark, prior, end = (small(scratch.write(t), key) for t, key in ((mark, "declared"), (prior, "host"), (end, "suffix")))
    flat, base = F.array(*[F.lit(0.0)] * k), F.transform(overall, lambda p: F.log(p))
    fused = rows.join(mark, "declared", "left").join(prior, ["host", "suffix"], "left").join(end, "suffix", "left")
    terms = F.arrays_zip(F.col("ll").alias("a"), F.coalesce("mark", flat).alias("b"), F.coalesce("end", flat).alias("c"), F.coalesce("prior", base).alias("d"))
    fused = fused.withColumn("logs", F.transform(terms, lambda t: t["a"] * _TEMPER + t["b"] + t["c"] + t["d"]))
    odds = F.transform("logs", lambda x: F.exp(x - F.array_max("logs")))
    fused = fused.withColumn("probability", 1 / F.aggregate(odds, F.lit(0.0), lambda a, b: a + b))
    names = F.array(*[F.lit(x) for x in model.languages])
    accepted = F.col("alike") & (F.col("probability") >= 0.5)
    top = F.get(names, F.expr("array_position(logs, array_max(logs))").cast("int") - 1)
    return fused.select(*own, F.when(accepted, top).alias("lang"), F.round("probability", 6).alias("probability"), F.get(names, F.col("best")).alias("text_lang"), accepted.alias("accepted"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without those whose language is not accepted; the declared label stays as it is. Rows
    are told apart by doc_id, text, declared language and source; null ids are told apart by the rest."""
    keyed = docs.select("doc_id", "lang", "source", "text", F.xxhash64("text", "lang", "source").alias("h"))
    found = identify(keyed.withColumn("declared", F.col("lang")), train(docs), declared="declared")
    return without(docs, found.where("not accepted").select("doc_id", "h"), ("text", "lang", "source"))

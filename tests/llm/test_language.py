from __future__ import annotations

import numpy as np
import pytest
from data import empty, frame, rows
from pyspark.sql import functions as F

from terrafold.llm import language as L


@pytest.fixture(scope="module")
def halves(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang is not null")
    return docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1").withColumnRenamed("lang", "truth")


def test_held_out_accuracy(halves):
    seen, unseen = halves
    model = L.train(seen, per_language=100)
    got = L.identify(unseen.withColumn("nothing", F.lit(None).cast("string")), model, declared="nothing")
    row = got.agg(F.avg((F.col("lang") == F.col("truth")).cast("double")), F.avg(F.col("accepted").cast("double"))).first()
    assert row[0] > 0.97 and row[1] > 0.99


def test_evidence_beside_the_text_decides(spark, halves):
    model = L.train(halves[0], per_language=100)
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    plain = F.regexp_replace("html", "<[^>]*>", " ")
    facts = pages.select("page_id", plain.alias("text"), L.declared_in(F.col("html")).alias("declared"), L.host_of(F.col("url")).alias("host"), L.suffix_of(F.col("url")).alias("suffix"))
    got = L.identify(facts, model, declared="declared", host="host", suffix="suffix")
    assert got.where("lang = declared").count() > 0.9 * got.count()
    short = facts.select("page_id", F.lit("e").alias("text"), "declared", "host", "suffix").limit(1).unionByName(facts)
    assert L.identify(short, model, declared="declared", host="host", suffix="suffix").count() == facts.count() + 1


def plain_posterior(rows, model):
    """The fusion restated: rows (fold, text, declared, host, suffix) to posterior by language."""
    k = len(model.languages)
    scored = [model.scores(t, f) for f, t, *_ in rows]
    best = [int(np.argmax(s)) for s, _ in scored]
    total = np.bincount(best, minlength=k).astype(float)
    overall = (total + 1) / (total.sum() + k)

    def likelihood(i):
        own = [(r[i], b) for r, b in zip(rows, best, strict=True) if r[i]]
        whole = np.bincount([b for _, b in own], minlength=k)
        return {v: np.log((np.bincount([b for x, b in own if x == v], minlength=k) + 1) / (whole + 2)) for v in {x for x, _ in own}}

    marks, ends = likelihood(2), likelihood(4)
    by_suffix = {s: np.bincount([b for r, b in zip(rows, best, strict=True) if r[4] == s], minlength=k) for s in {r[4] for r in rows}}
    p_suffix = {s: (n + 20 * overall) / (n.sum() + 20) for s, n in by_suffix.items()}
    out = []
    for (ll, _), r in zip(scored, rows, strict=True):
        n = np.bincount([b for q, b in zip(rows, best, strict=True) if q[3] == r[3] and q[4] == r[4]], minlength=k)
        prior = (n + 20 * p_suffix[r[4]]) / (n.sum() + 20) if r[3] else overall
        logs = ll / 3 + marks.get(r[2], 0) + ends.get(r[4], 0) + np.log(prior)
        odds = np.exp(logs - logs.max())
        out.append((model.languages[int(np.argmax(logs))], float(odds.max() / odds.sum())))
    return out


def test_fusion_against_a_plain_version_and_where_it_decides(spark, halves):
    model = L.train(halves[0], per_language=60)
    texts = {r["lang"]: r["text"] for r in halves[0].where("length(text) > 200").groupBy("lang").agg(F.min_by("text", "doc_id").alias("text")).collect()}
    langs = sorted(texts)
    rows_ = [(i, texts[lang][10 * j : 10 * j + 120], lang, f"h{i % 3}.{lang}", lang) for i, (lang, j) in enumerate((x, j) for x in langs for j in range(8))]
    short = "st"
    rows_ += [(900 + i, short, lang, f"h{i % 3}.{lang}", lang) for i, lang in enumerate(langs)] + [(990, short, None, None, "")]
    df = spark.createDataFrame(rows_, "id long, text string, declared string, host string, suffix string")
    folds = {r["id"]: r["f"] for r in df.select("id", L.fold_of("text").alias("f")).collect()}
    got = {r["id"]: r for r in L.identify(df, model, declared="declared", host="host", suffix="suffix").collect()}
    want = plain_posterior([(folds[i], *rest) for i, *rest in rows_], model)
    for (i, *_), (lang, p) in zip(rows_, want, strict=True):
        assert abs(got[i]["probability"] - p) < 1e-5
        assert got[i]["lang"] == (lang if got[i]["accepted"] else None)
    decided = [got[900 + i]["lang"] for i in range(len(langs))]
    assert sum(a == b for a, b in zip(decided, langs, strict=True)) >= 3 and len({got[900 + i]["text_lang"] for i in range(len(langs))}) == 1


def test_sample_is_bounded_whatever_repeats(spark, halves):
    one = halves[0].where("lang is not null").limit(1)
    many = one.withColumn("doc_id", F.explode(F.sequence(F.lit(0), F.lit(4999)))).select("lang", "text")
    few = halves[0].limit(50).select("lang", "text")
    a, b = L.train(few.unionByName(many), per_language=40), L.train(few.unionByName(one.select("lang", "text")), per_language=40)
    assert a.languages == b.languages and np.allclose(a.table, b.table)


def test_no_text_is_in_its_own_fold(spark):
    df = spark.createDataFrame([("x", "zzz qqq zzz qqq"), ("x", "aaa bbb"), ("y", "ccc ddd eee")], "lang string, text string")
    model = L.train(df)
    fold = df.where("text like 'zzz%'").select(L.fold_of("text")).first()[0]
    (own, n), (other, _) = model.scores("zzz qqq zzz qqq", fold), model.scores("zzz qqq zzz qqq", 1 - fold)
    assert own[0] < other[0] and n > 0


def test_addresses(spark):
    url = F.col("u")
    df = spark.createDataFrame([("https://u:p@A.Example.co.fr:80/x?y#z",), ("no",), (None,)], "u string")
    assert [tuple(r) for r in df.select(L.host_of(url), L.suffix_of(url)).collect()] == [("a.example.co.fr", "fr"), ("", ""), (None, None)]


def test_odd_rows(spark, halves):
    model = L.train(halves[0], per_language=50)
    df = frame(spark, rows(4)).withColumn("lang", F.lit("en")).withColumn("source", F.lit(None).cast("string"))
    got = L.identify(df, model)
    assert got.count() == len(rows(4)) and set(got.columns) >= {"doc_id", "h", "row", "best", "lang", "accepted"}
    blank = {r["doc_id"]: r["accepted"] for r in got.collect() if r["doc_id"] in (71, 72)}
    assert blank == {71: False, 72: False}
    assert L.identify(df.where("false"), model).count() == 0


def test_without_labels(spark):
    df = empty(spark).withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit("s"))
    model = L.train(df)
    assert model.languages == []
    df = frame(spark, rows(4)[:5]).withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit("s"))
    assert [r["accepted"] for r in L.identify(df, model).collect()] == [True] * 5


def test_stage_keeps_clean_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = L.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() >= 0.999 * docs.where("length(text) > 30").count()

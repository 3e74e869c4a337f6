from __future__ import annotations

import hashlib
import random

import corpus_pipeline
import pytest
from data import prose, rows

from terrafold.llm import queries as Q

SCHEMAS = {
    "op1_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256", "op2_token_counts": "doc_id file ordinal start n_tokens", "op3_simhash": "doc_id fingerprint component_id",
    "op4_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset", "op5_language_id": "doc_id declared source lang probability text_lang accepted",
    "language_of_pages": "page_id declared host suffix lang probability text_lang accepted",
    "op6_audio_fingerprint": "vec_id class_id group_id is_query n_links best_class best_offset best_errors", "op7_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op8_html_extract": "page_id url text n_chars", "op9_decontaminate": "doc_id n_words n_hit n_items items_sha256 contaminated n_near near_sha256",
    "op10_chat_format": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
}


@pytest.mark.parametrize("name", list(SCHEMAS))
def test_columns_and_rows(spark, sf_dir, name):
    df = Q.queries()[name](spark, sf_dir)
    assert df.columns == SCHEMAS[name].split()
    table = {"op6": "embeddings", "op8": "pages", "op10": "conversations", "language": "pages"}.get(name.split("_")[0], "documents")
    n = spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
    assert df.count() >= n if name.startswith("op4") else df.count() == n or name.startswith("op10")


def test_no_personal_data_digest(spark, tmp_path):
    spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = Q.queries()["op7_pii"](spark, str(tmp_path)).collect()
    assert {r["base_sha256"] for r in got} == {hashlib.sha256(b"").hexdigest()} and {r["spans"] for r in got} == {""}


def documents(spark, path, data):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(data, "doc_id long, text string")
    df = df.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("src0").alias("source"), F.length("text").cast("long").alias("n_chars"))
    df.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, rows()[7][1])], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return spark.read.parquet(f"{path}/documents.parquet")


def test_pipeline_stages(spark, tmp_path):
    docs = documents(spark, tmp_path, [*rows(), (900, prose(random.Random(90), 80) + " mail me@example.com"), (901, rows()[7][1]), (902, rows()[14][1] + " mail me@example.com")])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString(), name
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert not {901, 7, 60, 72, 902} & set(left) and "[EMAIL]" in left[900]
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in packed.collect()} == set(left)


def test_pipeline_of_no_documents(spark, tmp_path):
    documents(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered():
    assert list(Q.queries()) == list(SCHEMAS)

from __future__ import annotations

import io
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrafold.llm import audio as A


def song(seed, notes=40, rate=8000):
    rng = np.random.default_rng(seed)
    t = np.arange(int(rate * 0.15)) / rate
    return np.concatenate([sum(rng.random() * np.sin(2 * np.pi * 440 * 2 ** (k / 12) * t) for k in range(12)) for _ in range(notes)])


def wav(x, rate=8000):
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes((x / np.abs(x).max() * 30000).astype("<i2").tobytes())
    return out.getvalue()


@pytest.fixture(scope="module")
def found(spark):
    noise = np.random.default_rng(0)
    songs = {i: song(i) for i in range(20, 32)}
    rows = [(i, bytearray(wav(x))) for i, x in songs.items()]
    rows += [(40, bytearray(wav(songs[20]))), (41, bytearray(wav(songs[20] + 0.01 * noise.standard_normal(len(songs[20]))))), (42, bytearray(wav(songs[21][128 * 16 :]))), (43, None), (44, bytearray(wav(np.ones(10)))), (60, bytearray(wav(songs[22])))]
    df = spark.createDataFrame(rows, "id long, media binary").selectExpr("*", "1 as key", "2 as place", "3 as query")
    return {r["id"]: r for r in A.linked(df, F.col("id") % 20 == 0).collect()}, len(rows)


def test_copies_are_one_class(found):
    got, n = found
    assert len(got) == n and got[40]["class_id"] == 20 and got[60]["class_id"] == 22


def test_noise_and_offsets_are_matched(found):
    got, _ = found
    assert got[20]["n_links"] >= 1 and got[20]["best_class"] == 41 and got[20]["best_offset"] == 0
    assert got[60]["n_links"] == 0 and got[43]["n_links"] == 0 and got[44]["class_id"] == 44
    a, b = (A.quantise(A.responses(A.chroma(*A.decode_wav(wav(x)))), np.zeros((16, 3))) for x in (song(21), song(21)[128 * 16 :]))
    assert A.bit_errors(a, b, -16)[0] < 0.05 < 0.2 < A.bit_errors(a, b, 3)[0]


def errors_of(a, b):
    """The least bit errors of any alignment that counts."""
    found = (A.bit_errors(a, b, k) for k in range(1 - len(a), len(b)))
    return min((e for e, n in found if n >= min(A.LEAST_OVERLAP, len(a), len(b))), default=1.0)


def recall(spark, rows, aligned, decode=A.render_vector):
    """Shares of the pairs of brute force that are found, by bit errors; none else may be found."""
    df = spark.createDataFrame(rows, "id long, media array<double>")
    model = A.fit_thresholds(df, "media", decode)
    prints = {i: A.quantise(A.responses(A.chroma(*decode(v))), model) for i, v in rows}
    members, matches = A.search(df, F.col("id") % 20 == 0, decode=decode)
    group = {r["id"]: r["group_id"] for r in members.collect()}
    got = {(r["query"], r["found"]) for r in matches.collect()} | {(q, r) for q in group for r in group if q != r and q % 20 == 0 and group[q] == group[r]}
    of = (lambda a, b: A.bit_errors(a, b, 0)[0]) if aligned else errors_of
    want = {(q, r): e for q in prints if q % 20 == 0 for r in prints if q != r and (e := of(prints[q], prints[r])) <= A.MOST_ERRORS}
    if aligned:
        assert got <= set(want)
    shares = []
    for low, high in ((0, 0.05), (0.05, 0.1), (0.1, 0.15)):
        of_range = [p for p, e in want.items() if low < e <= high]
        shares.append((len(of_range), sum(p in got for p in of_range)))
    return shares


def test_recall_over_all_bit_errors(spark, sf_dir):
    rng = np.random.default_rng(1)
    vectors = {r["vec_id"]: np.array(r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").limit(400).collect()}
    rows = [(int(i), v.tolist()) for i, v in vectors.items()]
    assert len(vectors) >= 200
    for i, v in vectors.items():
        if i % 20 == 0:
            rows += [(1001 + int(i) * 20 + k, (v + noise * rng.standard_normal(len(v))).tolist()) for k, noise in enumerate((0.01, 0.0125, 0.02, 0.02, 0.03, 0.03, 0.03, 0.035))]
    shares = recall(spark, rows, True)
    assert all(n >= 15 for n, _ in shares), shares
    assert sum(f for _, f in shares) >= 0.95 * sum(n for n, _ in shares) and all(found >= 0.85 * n for n, found in shares), shares


def test_recall_at_other_offsets(spark, sf_dir):
    rng = np.random.default_rng(2)
    long_ones = {20 * k: A.render_vector((rng.standard_normal(500) / 8).tolist())[0] for k in range(10)}
    rows = [(i, x.tolist()) for i, x in long_ones.items()]
    for i, x in long_ones.items():
        for k, (at, noise) in enumerate(((0, 0.3), (100, 0.3), (233, 0.6), (333, 1.0), (380, 1.5))):
            part = x[128 * at : 128 * (at + 100)]
            rows.append((1001 + i * 20 + k, (part + noise * rng.standard_normal(len(part))).tolist()))
    shares = recall(spark, rows, False, lambda v: (np.array(v), 2000))
    total, found = sum(n for n, _ in shares), sum(f for _, f in shares)
    assert total >= 40 and found >= 0.9 * total, shares


def test_a_large_group_of_near_copies_is_met_once(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal(64) / 8
    rows = [(i, (base + 0.01 * rng.standard_normal(64)).tolist()) for i in range(200)] + [(1000 + i, (rng.standard_normal(64) / 8).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, media array<double>")
    members, matches = A.search(df, F.col("id") % 20 == 0, decode=A.render_vector)
    sizes = {}
    for r in members.collect():
        sizes[r["group_id"]] = sizes.get(r["group_id"], 0) + 1
    assert max(sizes.values()) >= 190 and matches.count() <= 60
    got = {r["id"]: r for r in A.linked(df, F.col("id") % 20 == 0, decode=A.render_vector).collect()}
    assert got[20]["n_links"] >= 190 and got[21]["n_links"] in (0, got[20]["n_links"])


def test_filters_and_odd_vectors():
    assert len(A.FILTERS) == 16 and all(y + h <= 12 for _, y, h, _ in A.FILTERS)
    assert A.render_vector(None)[0].size == 0 and A.render_vector([float("nan"), None] * 10)[0].size > 0
    assert len(A.quantise(A.responses(np.zeros((2, 12))), np.zeros((16, 3)))) == 0


def test_empty_table(spark):
    df = spark.createDataFrame([], "id long, media binary")
    assert A.linked(df, F.col("id") % 20 == 0).count() == 0


def test_thresholds_are_quartiles_of_all_responses(spark):
    rng = np.random.default_rng(5)
    vectors = [(rng.standard_normal(64) / (8 if i < 600 else 2)).tolist() for i in range(900)]
    rows = [(i, v) for i, v in enumerate([*vectors, *[vectors[0]] * 50])] + [(2000, (rng.standard_normal(2000) / 2).tolist()), (2001, None), (2002, [])]
    df = spark.createDataFrame(rows, "id long, media array<double>").repartition(5)
    every = np.concatenate([A.responses(A.chroma(*A.render_vector(v))) for _, v in rows])
    assert (A.fit_thresholds(df, "media", A.render_vector) == np.quantile(every, [0.25, 0.5, 0.75], axis=0, method="inverted_cdf").T).all()
    assert not A.fit_thresholds(df.where("id > 2000"), "media", A.render_vector).any()

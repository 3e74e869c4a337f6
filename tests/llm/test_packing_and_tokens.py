from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import public_tokenizers as public
import pytest
from data import empty, frame, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from terrafold.llm import packing as P
from terrafold.llm import token_counts as K
from terrafold.llm.tokens import encoder

DATA = [*rows(3), (700, "some <|endoftext|> inside"), (701, "word " * 3000)]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(public.path("byte_bpe_50k.json"))


@given(st.text())
@settings(max_examples=200, deadline=None)
def test_same_ids_as_the_tokenizer(text):
    t = Tokenizer.from_file(public.path("byte_bpe_50k.json")) if not hasattr(test_same_ids_as_the_tokenizer, "t") else test_same_ids_as_the_tokenizer.t
    test_same_ids_as_the_tokenizer.t = t
    assert encoder()(text).tolist() == t.encode(text, add_special_tokens=False).ids


def plain_best_fit(lengths, size):
    gaps = []
    for length in sorted(lengths, reverse=True):
        at = bisect_left(gaps, length)
        left = (gaps.pop(at) if at < len(gaps) else size) - length
        insort(gaps, left)
    return len(gaps)


def sequences_of(got, size):
    found = defaultdict(list)
    for r in got:
        found[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in found.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(found)


@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 5)), max_size=12))
@settings(max_examples=300, deadline=None)
def test_leftovers_meet_as_on_one_stack(counts):
    links, found = P.carry([(part, a, b) for part, (a, b) in enumerate(counts)])
    want, stack = [], []
    for part, (a, b) in enumerate(counts):
        got = 0
        for place in range(a):
            if stack:
                want.append(((part, place), stack.pop()))
                got += 1
        assert found[part] == got
        stack += [(part, place) for place in range(b)]
    assert sorted(want) == sorted(((p, first + i), (q, top - i)) for _, p, first, n, q, top in links for i in range(n))
    assert len(links) <= 2 * len(counts)


@pytest.mark.parametrize(("size", "partitions"), [(1024, 1), (1024, 16), (64, 4), (1, 2)])
def test_about_as_few_sequences_as_plain_best_fit(spark, sf_dir, size, partitions):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet") if size == 1024 else frame(spark, DATA)
        got = P.pack(docs, size=size).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    plain = plain_best_fit([r["length"] for r in got], size)
    assert len({(r["doc_id"], r["piece"]) for r in got}) == len({(r["doc_id"], r["piece"]) for r in P.pieces(docs, size=size).collect()})
    assert plain <= sequences_of(got, size) <= plain * (1 if partitions == 1 else 1.03) + (partitions > 1)


def test_a_round_is_a_range_sort_and_a_sweep(spark):
    cut = P.pieces(frame(spark, DATA))
    gaps = spark.createDataFrame([(1, 500), (2, 30)], "seq long, width long")
    plan = P.sweep(cut.where("length <= 512"), gaps)._jdf.queryExecution().sparkPlan().toString()
    assert "rangepartitioning" in plan.lower() and "MapInArrow" in plan
    rows = P.sweep(cut.where("length <= 512"), gaps).collect()
    assert {r["seq"] for r in rows if r["state"] == P._MATCHED} == {1, 2}


def test_pack(spark, plain):
    got = [r.asDict() for r in P.pack(frame(spark, DATA)).collect()]
    n = sequences_of(got, 1024)
    want = []
    for doc_id, text in DATA:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        want += [(str(doc_id), k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    assert n == plain_best_fit([w[3] for w in want], 1024)
    assert P.pack(empty(spark)).count() == 0


def test_token_counts(spark, plain):
    got = sorted((str(r["doc_id"]), r["n_tokens"]) for r in K.count_documents(frame(spark, DATA)).collect())
    plain.encode_special_tokens = True
    assert got == sorted((str(i), len(plain.encode(t or "", add_special_tokens=False).ids)) for i, t in DATA)
    plain.encode_special_tokens = False
    assert K.count_documents(empty(spark)).count() == 0


def documents(k, ids, end):
    """(file, ordinal, start, tokens, ended) of the documents in a file of ids."""
    ends = [-1, *np.flatnonzero(ids == end).tolist()]
    own = [(k, i, a + 1, b - a - 1, True) for i, (a, b) in enumerate(zip(ends, ends[1:], strict=False))]
    return own + [(k, len(own), ends[-1] + 1, len(ids) - ends[-1] - 1, False)] * (ends[-1] < len(ids) - 1)


def counted(found):
    return sorted((int(r["file"].split("/")[-1].split(".")[0]), r["ordinal"], r["start"], r["n_tokens"], r["ended"]) for r in found.collect())


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
def test_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(K, "_GROUP", 4)
    rng = np.random.default_rng(block)
    want, cut = [], []
    for k in range(3):
        ids = rng.integers(0, 6, 200).astype("<u2")
        if k == 1:
            ids[-1] = 5
        if k == 2:
            ids[ids == 5] = 4
        want += documents(k, ids, 5)
        cut += [(str(k), i, ids[at : at + block].tobytes()) for i, at in enumerate(range(0, len(ids), block))]
    blocks = spark.createDataFrame(cut, "file string, block long, data binary").repartition(3)
    assert counted(K.stitch(K.scan(blocks, end_id=5))) == sorted(want)


@pytest.mark.parametrize(("width", "end", "high", "split"), [(2, 0x2021, 0x2323, "297"), (4, 0x20, 0x24, "500"), (2, 50256, 50258, "128m"), (1, 33, 40, "128m"), (2, 0x2020, 0x2323, "128m")])
def test_flat_files(spark, tmp_path, monkeypatch, width, end, high, split):
    monkeypatch.setattr(K, "_GROUP_BYTES", 128)
    rng = np.random.default_rng(width + end)
    kind = f"<u{width}"
    want = []
    for k in range(9):
        ids = rng.integers(max(0, end - 3), high, 400 + k).astype(kind)
        if k % 3 == 1:
            ids[-1] = end
        if k == 2:
            ids[ids == end] = end + 1
        if k == 4:  # ids whose bytes look like a separator across two ids
            ids[:200] = int.from_bytes(end.to_bytes(width, "little")[::-1], "little")
        if k >= 6:  # a mark of text files, which readers take off
            ids[: 12 // width] = np.frombuffer((b"\xef\xbb\xbf" + bytes([33 + k] * 9)), kind)
        if k >= 7:  # a last byte that is, or isn't, the end of a line
            ids[-1] = int.from_bytes(bytes([32 + 2 * (k - 7)] * width), "little")
        ids.tofile(tmp_path / f"{k}.bin")
        want += documents(k, ids, end)
    (tmp_path / "9.bin").write_bytes(b"")
    ids.tofile(tmp_path / "10.bin")
    if width > 1:
        with open(tmp_path / "10.bin", "ab") as f:
            f.write(b"\x01")
    want += documents(10, ids, end)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert counted(K.count_files(spark, str(tmp_path), end, width)) == sorted(want)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")

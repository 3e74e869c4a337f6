from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from data import empty, frame, prose, rows

from terrafold.llm import suffixes as S


def brute(data, length=200):
    seen = collections.Counter()
    for _, t in data:
        b = (t or "").encode()
        seen.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = []
    for i, t in data:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for j in range(len(b) - length + 1):
            if seen[b[j : j + length]] > 1:
                gone[j : j + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((str(i), len(b), sum(gone), sum(1 for x in bytes(gone).split(b"\0") if x), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def collected(df):
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


@pytest.fixture()
def crowded():
    """Passages and a line that many documents share, amid different texts."""
    rng = random.Random(5)
    line, passages = prose(rng, 30), [prose(rng, 60) for _ in range(3)]
    data = [(1000 + i, prose(rng, rng.randint(1, 120)) + (" " + line + " " + prose(rng, 30)) * (i % 2) + (" " + passages[i % 3]) * (i % 3 == 0)) for i in range(120)]
    return data + rows()


def test_against_brute_force(spark, crowded):
    assert collected(S.remove_repeats(frame(spark, crowded))) == brute(crowded)


@pytest.mark.parametrize("most", [4096, 2])
def test_frequent_keys_are_counted_across_buckets(spark, crowded, monkeypatch, most):
    plain = S._sample

    def half_hot(docs, length, n):
        texts = [bytes(r[0]) for r in docs.select("data").collect()]
        keys = np.unique(np.concatenate([x[4] for x in S._batch_blocks(pa.array(texts, pa.binary()), length)]))
        return *plain(docs, length, n)[:2], keys[::2]

    monkeypatch.setattr(S, "_sample", half_hot)
    monkeypatch.setattr(S, "MOST_BLOCKS", most)
    assert collected(S.remove_repeats(frame(spark, crowded))) == brute(crowded)


def test_long_documents_are_cut_into_segments(spark, monkeypatch, crowded):
    monkeypatch.setattr(S, "_SEGMENT", 1500)
    parts = [(str(i), *x) for i, x in enumerate(S._batch_blocks(pa.array([(t or "").encode() for _, t in crowded], pa.binary()), 200))]
    for _, row, a, b, p, *_ in parts:
        for r, x, y, z in zip(row.tolist(), a.tolist(), b.tolist(), p.tolist(), strict=True):
            assert 0 <= x <= y <= z <= x + 120 and y + 200 <= len((crowded[r][1] or "").encode())
    windows = sum(int((b - a + 1).sum()) for _, _, a, b, *_ in parts)
    assert windows == sum(max(0, len((t or "").encode()) - 199) for _, t in crowded)


def test_blocks_are_equal_by_bytes_and_place():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 256, 2000).astype(np.uint8)
    data[1000:1400] = data[:400]
    a, b, p = np.array([0, 0, 1000, 1]), np.array([50, 50, 1050, 50]), np.array([60, 61, 1060, 61])
    key, block, tail = S._hashes(data, a, b, p, 200)
    same = lambda i, j: (key[i], block[i], tail[i]) == (key[j], block[j], tail[j])
    assert same(0, 2) and not same(0, 1) and not same(1, 3)


def test_empty_table(spark):
    assert S.remove_repeats(empty(spark)).count() == 0


def test_kept_bytes(spark):
    rng = random.Random(3)
    shared, a, b = prose(rng, 80), prose(rng, 5), prose(rng, 6)
    got = {r["doc_id"]: bytes(r["kept"]) for r in S.remove_repeats(frame(spark, [(1, a + shared), (2, b + shared)]), keep_bytes=True).collect()}
    assert len(got[1]) <= len(a.encode()) + 3 and got[1] == a.encode()[: len(got[1])]


def test_multikey_sort():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    data[2000:2600] = data[100:700]
    starts = np.arange(0, 3900, 3)
    group = starts % 2
    found = S.sort_equal(data, starts, group, 40)
    seen = collections.Counter((int(g), data[s : s + 40].tobytes()) for s, g in zip(starts, group, strict=True))
    assert found.tolist() == [seen[int(g), data[s : s + 40].tobytes()] > 1 for s, g in zip(starts, group, strict=True)]


def test_length_has_a_least(spark):
    with pytest.raises(ValueError):
        S.remove_repeats(empty(spark), length=100)

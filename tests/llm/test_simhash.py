from __future__ import annotations

import random
import re

import xxhash
from data import empty, frame, rows

from terrafold.llm import components as C
from terrafold.llm import shared
from terrafold.llm import simhash as S
from terrafold.llm.shared import Scratch


def plain_fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode("utf-8").lower())
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def least(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_against_brute_force(spark):
    data = rows(2)
    got = S.near_duplicates(frame(spark, data)).collect()
    prints = [(i, plain_fingerprint(t)) for i, t in data]
    assert sorted((str(r["doc_id"]), r["fp"] % (1 << 64)) for r in got) == sorted((str(i), f) for i, f in prints)
    fps = sorted({f for _, f in prints})
    near = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 2]
    root = least(fps, near)
    first = {}
    for i, f in prints:
        if i is not None:
            first[root[f]] = min(i, first.get(root[f], i))
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in got) == sorted((str(i), str(first.get(root[f]))) for i, f in prints)


def test_links_cover_all_pairs_within_two_bits(spark):
    rng = random.Random(4)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for f in list(fps)[:40]:
        fps.add(f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
        fps.add(f ^ (1 << rng.randrange(64)))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    got = [(r[0] % (1 << 64), r[1] % (1 << 64)) for r in S.links(spark.createDataFrame([(signed(f),) for f in fps], "fp long")).collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in got)
    near = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 2]
    assert least(fps, got) == least(fps, near)


def test_components_of_a_chain_a_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 200)] + [(300, 300), (None, 3), (500, 501), (501, 500)]
    got = {r["node"]: r["root"] for r in C.components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 200)}, 501: 500}
    assert C.components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t")).count() == 0


def test_keep_one(spark):
    data = [*rows(2), rows(2)[3]]
    got = [(r["doc_id"], r["text"]) for r in S.keep_one(frame(spark, data)).collect()]
    want = S.near_duplicates(frame(spark, data)).select("root").distinct().count()
    assert len(got) == want and len(set(got)) == len(got) and set(frame(spark, data).columns) == set(S.keep_one(frame(spark, data)).columns)
    ids = {r["component_id"] for r in S.near_duplicates(frame(spark, data)).collect()}
    assert {i for i, _ in got} >= ids - {None}


def test_empty_table(spark):
    assert S.near_duplicates(empty(spark)).count() == 0 and S.keep_one(empty(spark)).count() == 0


def test_many_dropped_rows_are_joined_by_key(spark, monkeypatch):
    data = rows(2)
    few = sorted(map(str, S.keep_one(frame(spark, data)).select("doc_id", "text").collect()))
    monkeypatch.setattr(shared, "_FEW", -1)
    many = S.keep_one(frame(spark, data))
    assert "BroadcastHashJoin" not in many._jdf.queryExecution().sparkPlan().toString()
    assert sorted(map(str, many.select("doc_id", "text").collect())) == few

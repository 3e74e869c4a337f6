from __future__ import annotations

import random

import corpus_pipeline
from data import empty, frame, prose, rows
from test_simhash import least

from terrafold.llm import resemblance as R
from terrafold.llm import simhash as S


def near_copies(seed=3):
    """Rows with copies that differ in some words, from just above the threshold to just below."""
    rng = random.Random(seed)
    out = []
    for k in range(30):
        words = prose(rng, 200).split()
        out.append((1000 + 10 * k, " ".join(words)))
        for j, n in enumerate((1, 2, 3, 4, 5)):
            changed = list(words)
            for i in rng.sample(range(200), n):
                changed[i] = f"changed{i}"
            out.append((1000 + 10 * k + j + 1, " ".join(changed)))
    return out


def test_against_brute_force(spark):
    data = rows(2) + near_copies()
    sets = {i: frozenset(R.shingles(t).tolist()) for i, t in enumerate(t for _, t in data)}
    near = [(a, b) for a in sets for b in sets if a < b and (sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))]
    want = len(set(least(sets, near).values()))
    apart = S.near_duplicates(frame(spark, data)).select("root").distinct().count()
    got = corpus_pipeline.drop_near_duplicates(spark, frame(spark, data), "").collect()
    assert len(got) == want < apart - 50
    assert {1000 + 10 * k for k in range(30)} <= {r["doc_id"] for r in got}


def test_a_large_group_of_loose_copies(spark):
    rng = random.Random(9)
    words, edits = prose(rng, 150).split(), prose(rng, 6).split()
    data = []
    for i in range(120):
        copy = list(words)
        for at in rng.sample(range(150), rng.randint(1, 9)):
            copy[at] = rng.choice(edits)
        data.append((i, " ".join(copy)))
    sets = {i: R.shingles(t) for i, t in data}
    near = [(a, b) for a in sets for b in sets if a < b and R.similarity(sets[a], sets[b]) >= 0.8]
    want = least(sets, near)
    got = R.similar_groups(frame(spark, data)).collect()
    groups = {}
    for r in got:
        groups.setdefault(r["root"], set()).add(r["doc_id"])
    assert sorted(map(sorted, groups.values())) == sorted(sorted(i for i in want if want[i] == k) for k in set(want.values())) and len(groups) > 5


def test_a_chain_through_a_band(spark):
    words = prose(random.Random(6), 300).split()
    for at in range(8):  # each 12 words on from the one before: the ends are not similar
        words += prose(random.Random(70 + at), 12).split()
    data = [(at, " ".join(words[12 * at : 12 * at + 300])) for at in range(8)]
    assert R.similarity(R.shingles(data[0][1]), R.shingles(data[7][1])) < 0.6
    assert R.similar_groups(frame(spark, data)).select("root").distinct().count() == 1


def test_no_rows_and_no_words(spark):
    assert R.similar_groups(empty(spark)).count() == 0
    assert R.similar_groups(frame(spark, [(1, ""), (2, None), (3, " \n")])).select("root").distinct().count() == 1


def test_a_pair_that_only_simhash_finds(spark):
    rng = random.Random(2612)
    words = ["lo"] * 400 + [f"w{rng.getrandbits(30)}" for _ in range(44)]
    changed = [*words[:420], "changed", *words[421:]]
    a, b = (R.shingles(" ".join(x)) for x in (words, changed))
    assert R.similarity(a, b) >= R.SIMILARITY and not set(R.bands(a)) & set(R.bands(b))
    other = ["lo"] * 400 + [f"v{i}" for i in range(44)]  # the same fingerprint, but a different text
    data = [(1, " ".join(words)), (2, " ".join(changed)), (3, " ".join(other))]
    assert len({S.fingerprint(t) for _, t in data}) == 1
    got = corpus_pipeline.drop_near_duplicates(spark, frame(spark, data), "").collect()
    assert sorted(r["doc_id"] for r in got) == [1, 3]

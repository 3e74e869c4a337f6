from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections import Counter

from data import empty, frame, prose, rows

from terrafold.llm import decontaminate as D
from terrafold.llm import shared

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 9)) if w else []:
            windows.setdefault(tuple(w[k : k + 10]), set()).add(None if i is None else str(i))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out.append((str(i), len(w), len(hit), tuple(sorted(x for x in found if x is not None))))
    return sorted(out)


def tables(spark):
    rng = random.Random(8)
    items = [(i, prose(rng, rng.randint(10, 50))) for i in range(12)] + [(20, "Éaus lone"), (21, "single"), (22, ""), (23, None), (None, prose(rng, 12)), (3, prose(rng, 15)), (24, "the " * 12), (25, "A-b c. d")]
    items.append(items[2])
    docs = rows(9)
    for k, (_, t) in enumerate(items):
        w = (t or "").split()
        docs.append((1000 + k, prose(rng, 20) + " " + " ".join(w[3:14]).upper() + "! " + prose(rng, 5)))
        docs.append((2000 + k, (t or "") + "\n" + (t or "")))
    docs += [(3000, "Single"), (3001, "x éaus LONE y"), (3002, "the " * 40), (3003, ".a b,c--d"), (3004, "éAUS lone")]
    return docs, items, frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")


def collected(df):
    return sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], tuple(sorted(r["item_ids"]))) for r in df.collect())


def test_against_brute_force(spark):
    docs, items, d, b = tables(spark)
    assert collected(D.contamination(d, b)) == brute(docs, items)


def test_nothing_broadcast_gives_the_same(spark, monkeypatch):
    docs, items, d, b = tables(spark)
    monkeypatch.setattr(shared, "_FEW", -1)
    assert collected(D.contamination(d, b)) == brute(docs, items)


def test_drop(spark):
    docs, items, d, b = tables(spark)
    left = sorted(str(r["doc_id"]) for r in D.drop_contaminated(d, b).collect())
    assert left == sorted(x[0] for x in brute(docs, items) if not x[2])


def test_repeated_rows_and_null_ids_that_hold_a_window(spark):
    rng = random.Random(10)
    items = [(1, prose(rng, 30)), (2, "Lone")]
    held = prose(rng, 20) + " " + " ".join(items[0][1].split()[5:25])
    docs = [(1, held)] * 2 + [(None, held)] * 3 + [(2, "a lone word")] * 2 + [(None, "lone")] * 2 + [(3, "clean")] * 2
    d, b = frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    assert collected(D.contamination(d, b)) == brute(docs, items)
    assert [r["doc_id"] for r in D.drop_contaminated(d, b).collect()] == [3, 3]


def brute_near(docs, items, slop=D.SLOP):
    cut = [words(t) for _, t in docs]
    counts = Counter(x for w in cut for x in w)
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 9)) if w else []:
            windows.setdefault(tuple(w[k : k + 10]), set()).add(None if i is None else str(i))
    rare = {x: sorted((counts[t], o, t) for o, t in enumerate(x) if t in counts)[:2] for x in windows}
    out = []
    for (i, _), w in zip(docs, cut, strict=True):
        at, found = {}, set()
        for pos, x in enumerate(w):
            at.setdefault(x, []).append(pos)
        for x, r in rare.items():
            if r and len(x) == 1 and r[0][2] in at:
                found |= windows[x]
            if len(r) == 2 and r[0][2] in at and r[1][2] in at:
                later = sorted(p - r[1][1] for p in at[r[1][2]])
                for p in at[r[0][2]]:
                    k = bisect_left(later, p - r[0][1] - slop)
                    if k < len(later) and later[k] <= p - r[0][1] + slop:
                        found |= windows[x]
                        break
        out.append((str(i), tuple(sorted(x for x in found if x is not None))))
    return sorted(out)


def test_proximity_against_brute_force(spark):
    docs, items, d, b = tables(spark)
    rng = random.Random(12)
    for k, (_, t) in enumerate(items):  # passages with a word more, a word less and a word changed
        w = (t or "").split()
        for j, changed in enumerate((w[:6] + ["more"] + w[6:], w[:6] + w[7:], w[:6] + ["other"] + w[7:])):
            docs.append((4000 + 3 * k + j, prose(rng, 12) + " " + " ".join(changed)))
    got = D.contamination(frame(spark, docs), b).collect()
    assert sorted((str(r["doc_id"]), tuple(r["near_ids"])) for r in got) == brute_near(docs, items)
    assert any(r["near_ids"] and not r["item_ids"] for r in got)


def test_proximity(spark):
    b = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa")], "item_id long, text string")
    d = frame(spark, [(1, "x alpha beta gamma delta epsilon zeta eta theta iota kappa"), (2, "alpha z z beta gamma delta epsilon zeta eta theta iota kappa"), (3, "kappa " + "x " * 40 + "alpha beta gamma delta epsilon zeta eta theta iota"), (4, "alpha kappa " + "alpha " * 50)])
    assert {r["doc_id"] for r in D.proximity_matches(d, b, slop=3).collect()} == {1, 2, 3}
    assert {r["doc_id"] for r in D.phrase_matches(d, b).collect()} == {1}


def test_empty_tables(spark):
    docs, items, d, b = tables(spark)
    assert D.contamination(empty(spark), b).count() == 0
    assert all(x[2] == 0 for x in collected(D.contamination(d, b.where("false"))))


def test_no_python_in_the_plan(spark):
    _, _, d, b = tables(spark)
    plan = D.contamination(d, b)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

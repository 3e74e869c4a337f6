"""Random rows against plain Python versions of the rules."""

from __future__ import annotations

import math
import random
from collections import defaultdict

from terrafold.functions import text as T
from terrafold.operators import compare as C
from terrafold.operators import reduction as R
from terrafold.operators import spatial as S

SCHEMA = "id long, lat double, lon double, number string, street string, area string, village string"


def is_floor(n):
    n = n or ""
    at = n.find("號")
    return at >= 0 and max(n.find("樓"), n.find("層")) > at


def base(n):
    return n[: n.find("號") + 1] if is_floor(n) else n


def numbers(rng):
    return rng.choice([None, "", "".join(rng.choice("１２號樓層之大") for _ in range(rng.randint(1, 6)))])


def test_floors_and_bases(spark):
    rng = random.Random(1)
    data = [(numbers(rng),) for _ in range(2000)]
    df = spark.createDataFrame(data, "n string")
    got = df.select("n", T.is_floor("n"), T.base_number("n")).collect()
    assert [tuple(r) for r in got] == [(n, is_floor(n), base(n)) for (n,) in data]


def test_reduction(spark):
    rng = random.Random(2)
    rows = [
        (i, rng.choice([24.0, 24.1, -0.0, 0.0]), 120.0, rng.choice(["１號", "１號二樓", "１號三樓", "２號地下一層", "二樓", "２號"]), rng.choice([None, "", "S"]), rng.choice([None, "A"]), rng.choice([None, "", "里"]))
        for i in range(600)
    ]
    groups = defaultdict(list)
    fold = lambda r: (r[1] + 0.0, r[2], r[6] or "", r[4] if r[4] is not None else r[5] if r[5] is not None else "")
    for r in rows:
        groups[*fold(r), base(r[3])].append(r)
    left = []
    for key, members in groups.items():
        ground = [r for r in members if not is_floor(r[3])]
        left += [(r[0], key, r[3]) for r in ground] or [(min(members)[0], key, key[-1])]
    kept = {}
    for i, key, number in left:
        k = (*key[:-1], number)
        kept[k] = min(i, kept.get(k, i))
    got = R.reduce_addresses(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert sorted((r["id"], r["number"]) for r in got) == sorted((i, k[-1]) for k, i in kept.items())


def test_set_differences_with_nulls(spark):
    rng = random.Random(3)
    side = lambda: [(rng.choice([None, 1.0, 2.0]), rng.choice([None, 1.0]), rng.choice([None, "a", "b"])) for _ in range(8)]
    old, new = side(), side()
    frame = lambda rows: spark.createDataFrame(rows, "lat double, lon double, display_name string")
    o, n = frame(old), frame(new)
    assert {tuple(r) for r in C.only_in(n, o).collect()} == set(new) - set(old)
    assert tuple(C.overlap_counts(o, n).first()) == (len(set(old) - set(new)), len(set(new) - set(old)), len(set(old) & set(new)))


def test_nearest_point(spark):
    rng = random.Random(4)
    places = [(i, round(24 + rng.random() * 0.05, 4), round(120 + rng.random() * 0.05, 4)) for i in range(150)]
    asked = [(i, 24 + rng.random() * 0.08, 120 + rng.random() * 0.08) for i in range(80)]

    def metres(a, b, c, d):
        h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
        return 2 * 6371000 * math.asin(math.sqrt(h))

    want = {}
    for i, lat, lon in asked:
        for r in S.POINT_RADII:
            near = [(round(metres(lat, lon, a, b), 6), p) for p, a, b in places if abs(a - lat) <= r and abs(b - lon) <= r]
            if near:
                want[i] = (min(near)[1], len(near))
                break
    got = S.nearest_point(spark.createDataFrame(asked, "id long, lat double, lon double"), spark.createDataFrame(places, "place_id long, lat double, lon double")).collect()
    assert {r["id"]: (r["place_id"], r["candidates"]) for r in got} == want

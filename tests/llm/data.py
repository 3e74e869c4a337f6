"""Small tables with what operators must bear: nulls, empty and long texts, ties, repeated rows."""

from __future__ import annotations

import random

WORDS = [w + e for w in ("an", "the", "ou", "éau", "re", "ti", "st", "lo", "ka", "mi") for e in ("s", "ing", "ñe", "ßer", "x", "tion", "la", "do")]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


def rows(seed: int = 1, n: int = 60) -> list[tuple]:
    """(doc_id, text): with copies, near copies, shared passages, repeated rows and nulls."""
    rng = random.Random(seed)
    shared = [prose(rng, 60) for _ in range(3)]
    out: list[tuple] = []
    for i in range(n):
        text = prose(rng, rng.randint(1, 150))
        if i % 4 == 0:
            text += "\n" + shared[i % 3] + "\n" + prose(rng, 10)
        out.append((i, text))
    out += [(n + i, out[5][1]) for i in range(4)]
    changed = out[8][1].split()
    changed[len(changed) // 2] = "changed"
    out += [(n + 10, " ".join(changed)), (n + 11, ""), (n + 12, None), (None, out[9][1]), (None, None), out[3], (n + 13, "a" * 30_000), (n + 14, prose(rng, 20_000)), (n + 15, "\x00 \U0001f600 İ")]
    return out


def frame(spark, data: list[tuple], extra: bool = True):
    """The rows as a table, with further columns whose names the operators use themselves."""
    df = spark.createDataFrame(data, "doc_id long, text string")
    if extra:
        from pyspark.sql import functions as F

        names = ("h", "id", "key", "pii", "fp", "length", "start", "part", "count", "spans", "row", "best", "file")
        df = df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(names)])
    return df.repartition(3)


def empty(spark):
    return frame(spark, rows()[:1]).where("false")

from __future__ import annotations

import random
import re
import time

import pytest
from data import empty, frame, rows
from pyspark.sql import functions as F

from terrafold.llm import pii as P


def luhn(s):
    return sum(int(c) if i % 2 == 0 else (int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) for i, c in enumerate(reversed(s))) % 10 == 0


def digits(s):
    return re.sub("[^0-9]", "", s)


PLAIN = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
]


def base(text):
    out = [(m.start(), k, name, m.end()) for k, (name, p, ok) in enumerate(PLAIN) for m in re.finditer(p, text or "") if ok(m.group())]
    return [(n, a, b) for a, _, n, b in sorted(out)]


def texts():
    rng = random.Random(6)
    out = ["a@b.c_d@e.f", "x@y", "a.b+c@d-e.co.uk.", "@a.b", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.002.003.255", "1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1112", "41111111111111111111111", "12 34  5678", "+1 (555) 123-4567", "+1-2", "++12345678901", "é4111111111111111\U0001f600 a@b.cd", "1" * 5000, "a" * 5000 + "@", ("12-" * 4000) + "1", "+" * 100 + "1" * 3000, "0.0.0.0,1.1.1.1"]
    letters = "ab1234567890.-+@ ()_%é\U0001f600\n"
    out += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 200))) for _ in range(800)]
    out += ["".join(rng.choice("0123456789 -") for _ in range(60)) for _ in range(300)]
    return out


def test_base_spans_against_plain_patterns(spark):
    data = [*rows(7), *[(1000 + i, t) for i, t in enumerate(texts())]]
    got = P.find(frame(spark, data)).select("doc_id", "text", F.expr("filter(pii, s -> s.rank < 4)").alias("p")).collect()
    assert len(got) == len(data)
    for r in got:
        assert [(s["kind"], s["start"], s["end"]) for s in r["p"]] == base(r["text"]), r["text"]


@pytest.mark.parametrize(("text", "found"), [("IBAN GB82 WEST 1234 5698 7654 32 x", 1), ("DE89370400440532013000", 1), ("DE89370400440532013001", 0), ("xDE89370400440532013000", 0)])
def test_account_numbers(spark, text, found):
    row = P.find(frame(spark, [(1, text)])).first()
    assert len([s for s in row["pii"] if s["kind"] == "iban"]) == found


def test_context_raises_the_score(spark):
    got = P.find(frame(spark, [(1, "server 10.0.0.1"), (2, "x 10.0.0.1")])).orderBy("doc_id").collect()
    assert got[0]["pii"][0]["score"] > got[1]["pii"][0]["score"]


def test_context_decides_for_numbers_without_a_country(spark):
    rows_ = [(1, "call (555) 123-4567 now"), (2, "part 555 123-4567"), (3, "phone +1 555 123-4567"), (4, "tel 9555 123 4567"), (5, "555-123-4567, mobile"), (6, "555.123.4567" + " x" * 40 + " fax")]
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["pii"] if s["kind"] == "local"] for r in P.find(frame(spark, rows_)).collect()}
    assert got == {1: [(5, 19)], 2: [], 3: [], 4: [], 5: [(0, 12)], 6: []}
    assert P.find(frame(spark, rows_), least_score=0.4).where("exists(pii, s -> s.kind = 'local')").count() == 4


def plain_redact(text, spans):
    out, at = "", 0
    for s in spans:
        if s["start"] >= at:
            out += text[at : s["start"]] + "[" + s["kind"].upper() + "]"
        at = max(at, s["end"])
    return out + text[at:]


def test_redact_is_the_plain_replacement(spark):
    data = frame(spark, [(i, t) for i, t in enumerate(texts())])
    spans = {r["doc_id"]: (r["text"], r["pii"]) for r in P.find(data).collect()}
    assert all(r["text"] == plain_redact(*spans[r["doc_id"]]) for r in P.redact(data).collect())


def test_very_many_matches_of_one_text(spark):
    text = " ".join(f"é user{i}@mail{i}.org" + (", 10.0.0.1" if i % 5 == 0 else "") for i in range(50_000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.monotonic()
    found = P.find(df).first()["pii"]
    assert [(s["kind"], s["start"], s["end"]) for s in found if s["rank"] < 4] == base(text) and len(found) == 60_000
    assert P.redact(df).first()["text"] == plain_redact(text, found)
    assert time.monotonic() - began < 60


def test_redact(spark):
    out = {r["doc_id"]: r["text"] for r in P.redact(frame(spark, [(1, "é a@b.cd, 10.0.0.1!"), (2, None), (3, "none"), (4, "")])).collect()}
    assert out == {1: "é [EMAIL], [IP]!", 2: None, 3: "none", 4: ""}
    left = P.find(P.redact(frame(spark, [(i, t) for i, t in enumerate(texts()[:21])]))).where("exists(pii, s -> s.kind = 'email')")
    assert left.where("not contains(text, '@a')").count() == 0
    assert P.redact(frame(spark, [(1, "x")])).columns == frame(spark, [(1, "x")]).columns
    assert P.redact(empty(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = P.redact(frame(spark, rows(7)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

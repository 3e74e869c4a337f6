from __future__ import annotations

from terrafold.operators import compare as C
from terrafold.operators import profile as P
from terrafold.operators import reduction as R
from terrafold.operators import search as X

# A point with a base and two of its floors; one with floors of a number that has no base; one with two
# bases and a lone floor of a third; a mark without a number.
ROWS = [
    (10, 23.5, 121.0, "５８號"), (11, 23.5, 121.0, "５８號七樓"), (12, 23.5, 121.0, "５８號十二樓之３"), (20, 23.6, 121.2, "９之４號地下三層"), (21, 23.6, 121.2, "９之４號六樓"),
    (30, 22.9, 120.9, "７７號"), (31, 22.9, 120.9, "７９號"), (32, 22.9, 120.9, "８１號五樓"), (40, 22.8, 120.6, "地下一層"),
]
SCHEMA = "id long, lat double, lon double, number string, district_code string, county string, township string, village string, street string, area string, lane string, alley string, name string, display_name string, display_name_halfwidth string"


def places(spark, rows=ROWS):
    full = [(*r, "77", "甲縣", "乙鎮", "丙里", "丁街", None, None, None, "n", "d", "h") for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def test_stage_1_flags(spark):
    got = {r["id"]: (r["base_number"], r["to_drop"], r["to_synthesize"]) for r in R.floor_flags(places(spark)).collect()}
    assert got == {
        10: ("５８號", 0, 0), 11: ("５８號", 1, 0), 12: ("５８號", 1, 0), 20: ("９之４號", 0, 1), 21: ("９之４號", 1, 0),
        30: ("７７號", 0, 0), 31: ("７９號", 0, 0), 32: ("８１號", 0, 1), 40: ("地下一層", 0, 0),
    }


def test_stage_2_ranks(spark):
    rows = [(5, 23.1, 120.4, "６號"), (6, 23.1, 120.4, "６號"), (7, 23.1, 120.4, "８號"), (8, 23.2, 120.4, "６號"), (9, 23.1, 120.4, "６號")]
    assert {(r["id"], r["rn"]) for r in R.duplicate_ranks(places(spark, rows)).collect()} == {(5, 1), (6, 2), (9, 3), (7, 1), (8, 1)}


def test_both_stages_and_index(spark):
    rows = [(4, 23.4, 120.8, "１４之２號九樓"), (9, 23.3, 120.8, "１５號")]
    out = R.reduce_addresses(places(spark, rows))
    assert {(r["number"], r["display_name"]) for r in out.collect() if r["id"] == 4} == {("１４之２號", "甲縣乙鎮丙里丁街１４之２號")}
    index = X.postings(out)
    figures = C.accepted(C.inspect(out, index)).first()
    assert figures["rows"] == figures["indexed_ids"] == 2 and figures["accepted"]


def test_one_shuffle_for_both_stages(spark):
    plan = R.reduce_addresses(places(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_audits(spark):
    removed = {r["removed_id"]: (r["kept_id"], r["reason"]) for r in R.floor_removals(places(spark)).collect()}
    assert removed == {11: (10, "matched-existing-base"), 12: (10, "matched-existing-base"), 21: (20, "merged-floor-variants")}
    assert {r["kept_id"] for r in R.floor_syntheses(places(spark)).collect()} == {20, 32}
    assert tuple(R.floor_summary(places(spark)).first()) == (9, 3, 2, 1)
    assert tuple(R.floor_summary(places(spark).limit(0)).first()) == (0, 0, 0, 0)


def test_null_numbers_and_parts(spark):
    rows = [(6, 23.0, 120.7, "２號"), (7, 23.0, 120.7, None), (8, 23.0, 120.7, None)]
    assert sorted(r["id"] for r in R.reduce_addresses(places(spark, rows)).collect()) == [6, 7]


def test_buckets(spark):
    df = spark.createDataFrame([(n,) for n in (2, 4, 7, 10, 12, 50, 60, 1000)], "n long")
    assert [r[0] for r in df.select(P.bucket("n")).collect()] == ["2", "3-5", "6-10", "6-10", "11-50", "11-50", "51-200", "200+"]

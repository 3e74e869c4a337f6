"""Verification of a release against its source: extreme samples, checks, exceptions, outliers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.functions import geo as G
from terrafold.functions import text as T
from terrafold.operators import spatial as S
from terrafold.operators import search as X

# Directions of the samples, and metres that a stored coordinate may be off.
DIRECTIONS = ("north", "south", "east", "west")
COORDINATE_TOLERANCE_M = 1.0
# The fields by which a source row and a place are the same address.
KEY = ("district_code", "village", "neighbor", "street", "area", "lane", "alley", "number")


def extreme_samples(rows: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` rows farthest in each direction (ties by id), with the direction. Rows without a
    number or with a floor mark anywhere aren't sampled."""
    plain = rows.where((T.blank("number") != "") & ~T.has_marks("number")) if "number" in rows.columns else rows
    order = {"north": [F.desc("lat"), F.desc("id")], "south": [F.asc("lat"), F.asc("id")], "east": [F.desc("lon"), F.desc("id")], "west": [F.asc("lon"), F.asc("id")]}
    parts = [plain.orderBy(*order[d]).limit(n).withColumn("direction", F.lit(d)) for d in DIRECTIONS]
    return reduce(DataFrame.unionByName, parts)


def rule_matches(match: dict) -> Column:
    """Whether a row meets a rule: a prefix of the street, a value of a list, or an equal value; all
    of the rule's fields."""
    tests = []
    for field, want in match.items():
        many = isinstance(want, (list, tuple))
        if field == "street_prefix":
            tests.append(reduce(lambda a, b: a | b, [T.blank("street").startswith(p) for p in (want if many else [want])]))
        else:
            tests.append(T.blank(field).isin(*want) if many else T.blank(field) == want)
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def first_exception(rules: list[dict]) -> Column:
    """The reason of the first rule that a row meets, or null."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(rule_matches(rule.get("match", {})), rule["reason"]).otherwise(out)
    return out


def _folded(alias: str, c: str) -> Column:
    return F.coalesce(F.col(f"{alias}.{c}"), F.lit(""))


def checks(samples: DataFrame, places: DataFrame, codes: DataFrame, areas: DataFrame | None = None, area_edges: DataFrame | None = None, rules: list[dict] | None = None, index: DataFrame | None = None) -> DataFrame:
    """(sample_id, direction, check, ok, detail): a row per sample and check; ok is null for a
    failure that a boundary exception explains.

    coverage: the address is there; coord_match: within a metre (of rows with the same key the
    closest); display_name: both forms are as composed; fts5_search: the search ``index``
    (``search.postings``; without one it is made of the places) has the half-width name as a phrase; polygon_in, reverse_township and county_match: the areas that cover the
    point are the expected ones (only with ``areas``).
    """
    s = samples.select(F.xxhash64("id", "direction").alias("k"), F.col("id").alias("sample_id"), "direction", "lat", "lon", *KEY).alias("s")
    same = reduce(lambda a, b: a & b, [_folded("s", c) == _folded("p", c) for c in KEY])
    found = s.join(places.alias("p"), same, "left")
    found = found.withColumn("err", G.haversine_m("s.lat", "s.lon", "p.lat", "p.lon"))
    best = found.groupBy("s.k").agg(F.min_by(F.struct("p.id", "p.display_name", "p.display_name_halfwidth", "err"), F.struct(F.coalesce("err", F.lit(1e12)), "p.id")).alias("b"))
    known = codes.select(F.col("code").alias("district_code"), F.col("county").alias("want_county"), F.col("district").alias("want_town"))
    rows = s.join(best, "k").join(known, "district_code", "left")
    parts = (T.blank("want_county"), T.blank("want_town"), "village", "street", "area", "lane", "alley", "number")
    rows = rows.withColumn("want", T.display_name(*parts)).withColumn("want_half", T.display_name(*parts, half=True))
    there = F.col("b.id").isNotNull()
    hits = X.phrases_found(X.postings(places) if index is None else index, rows, "k", "want_half")
    rows = rows.join(hits.withColumn("hit", F.lit(True)), "k", "left")
    results = {
        "coverage": (there, F.lit("no row")),
        "coord_match": (there & (F.col("b.err") <= COORDINATE_TOLERANCE_M), F.concat(F.lit("err="), F.round("b.err", 2))),
        "display_name": (there & (F.col("b.display_name") == F.col("want")) & (F.col("b.display_name_halfwidth") == F.col("want_half")), F.concat(F.lit("want "), F.col("want"))),
        "fts5_search": (there & F.coalesce("hit", F.lit(False)), F.lit("no hit")),
    }
    soft: set[str] = set()
    if areas is not None:
        points = rows.select("k", "lat", "lon")
        covers = S.covering(points, area_edges, "k").join(areas, "area_id").where(F.col("level").isin(7, 8))
        names = covers.groupBy("k").agg(F.collect_set("name").alias("inside"))
        own = S.containing_area(points, areas, area_edges, "k").select("k", F.col("name").alias("got_town"), F.col("county").alias("got_county"))
        rows = rows.join(names, "k", "left").join(own, "k", "left")
        inside = F.coalesce(F.array_contains("inside", F.coalesce("want_town", F.lit(""))), F.lit(False))
        results |= {
            "polygon_in": (there & inside, F.concat(F.lit("not in "), T.blank("want_town"))),
            "reverse_township": (there & F.col("got_town").eqNullSafe(F.col("want_town")), F.concat(F.lit("got "), T.blank("got_town"))),
            "county_match": (there & F.col("got_county").eqNullSafe(F.col("want_county")), F.concat(F.lit("got "), T.blank("got_county"))),
        }
        soft = {"polygon_in", "reverse_township", "county_match"}
    rows = rows.withColumn("excuse", first_exception(rules or []))
    each = []
    for name, (ok, why) in results.items():
        good = F.coalesce(ok, F.lit(False))
        told = F.when(there, F.coalesce(why, F.lit(""))).otherwise("no match")
        if name in soft:
            excused = ~good & there & F.col("excuse").isNotNull()
            good, told = F.when(~excused, good), F.when(excused, F.concat(F.lit("INFO "), F.col("excuse"))).otherwise(told)
        each.append(F.struct(F.lit(name).alias("check"), good.alias("ok"), F.when(F.coalesce(good, F.lit(False)), "").otherwise(told).alias("detail")))
    return rows.select("sample_id", "direction", F.explode(F.array(*each)).alias("r")).select("sample_id", "direction", "r.check", "r.ok", "r.detail")


def matrix(results: DataFrame) -> DataFrame:
    """A row per check, and for each direction how many passed, failed and are explained."""
    counts = [F.count_if("ok").alias("passed"), F.count_if(~F.col("ok")).alias("failed"), F.count_if(F.col("ok").isNull()).alias("info")]
    return results.groupBy("check").pivot("direction", list(DIRECTIONS)).agg(*counts)


def failures(results: DataFrame) -> DataFrame:
    return results.where("ok = false")


def outliers(places: DataFrame, areas: DataFrame, area_edges: DataFrame, point_id: str = "id") -> DataFrame:
    """Places whose township isn't the one that covers them, with the one that does."""
    own = S.containing_area(places.select(point_id, "lat", "lon"), areas, area_edges, point_id).select(point_id, F.col("name").alias("found_township"))
    return places.join(own, point_id, "left").where(~F.col("found_township").eqNullSafe(F.col("township")))

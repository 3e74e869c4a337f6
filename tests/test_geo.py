from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from terrafold.functions import geo as G
from terrafold.operators import spatial as S
from terrafold.sources import wkb

LANDMARKS = [(217337.1278, 2671158.6333, 120.678601565596, 24.145357080518), (220537.631598, 2681215.7003, 120.709888447488, 24.236227780267), (236612.154, 2673787.926, 120.868240306006, 24.169379455535)]


def metres(lat1, lon1, lat2, lon2):
    p = math.radians
    a = math.sin(p(lat2 - lat1) / 2) ** 2 + math.cos(p(lat1)) * math.cos(p(lat2)) * math.sin(p(lon2 - lon1) / 2) ** 2
    return 2 * 6371000 * math.asin(math.sqrt(a))


@pytest.mark.parametrize(("x", "y", "lon", "lat"), LANDMARKS)
def test_projection(spark, x, y, lon, lat):
    la, lo = G.grid_to_wgs84(F.lit(x), F.lit(y))
    got = spark.range(1).select(la.alias("la"), lo.alias("lo"), *[c.alias(n) for n, c in zip("xy", G.wgs84_to_grid(la, lo), strict=True)]).first()
    assert metres(got["la"], got["lo"], lat, lon) < 0.01
    assert abs(got["x"] - x) < 0.01 and abs(got["y"] - y) < 0.01


def test_covers_with_hole_and_parts(spark):
    square = lambda x, y, n: [(x, y), (x + n, y), (x + n, y + n), (x, y + n), (x, y)]
    data = wkb.multipolygon_wkb([[square(0.0, 0.0, 4.0), square(1.0, 1.0, 1.0)], [square(10.0, 0.0, 1.0)]])
    edges = wkb.edges(spark.createDataFrame([(1, bytearray(data)), (2, None)], "area_id long, geometry_wkb binary"), "area_id")
    points = {1: (0.5, 0.5, True), 2: (1.5, 1.5, False), 3: (0.0, 2.0, True), 4: (4.0, 4.0, True), 5: (1.0, 1.5, True), 6: (10.5, 0.5, True), 7: (5.0, 0.5, False), 8: (3.0, 3.0, True)}
    df = spark.createDataFrame([(i, y, x) for i, (x, y, _) in points.items()], "id long, lat double, lon double")
    assert {r["id"] for r in S.covering(df, edges, size=1.0).collect()} == {i for i, p in points.items() if p[2]}


def test_wkb_rejects_other_types():
    with pytest.raises(ValueError):
        wkb.rings(bytes.fromhex("0107000000010000000101000000") + bytes(16))
    with pytest.raises(ValueError):
        wkb.multipolygon_wkb([])
    assert wkb.rings(wkb.line_wkb([(0.0, 1.0), (2.0, 3.0)])) == [[(0.0, 1.0), (2.0, 3.0)]]


def test_nearest_point_widens(spark):
    places = spark.createDataFrame([(1, 24.0, 120.0005), (2, 24.0, 120.004), (3, 24.2, 120.2), (4, 24.0, 120.0005)], "place_id long, lat double, lon double")
    asked = spark.createDataFrame([(1, 24.0, 120.0), (2, 24.0, 120.008), (3, 24.22, 120.2), (4, 25.0, 121.0)], "id long, lat double, lon double")
    got = {r["id"]: (r["place_id"], r["candidates"]) for r in S.nearest_point(asked, places).collect()}
    assert got == {1: (1, 2), 2: (2, 1), 3: (3, 1)}


def test_nearest_line_is_planar_within_a_line(spark):
    edges = spark.createDataFrame([(1, 120.0, 24.0, 120.01, 24.0), (2, 120.0, 24.003, 120.01, 24.003)], "line_id long, x1 double, y1 double, x2 double, y2 double")
    got = S.nearest_line(spark.createDataFrame([(1, 24.001, 120.005), (2, 24.5, 120.0)], "id long, lat double, lon double"), edges).collect()
    assert [(r["id"], r["line_id"]) for r in got] == [(1, 1)] and abs(got[0]["distance_m"] - 111.19) < 0.1


def test_reverse_geocode_text(spark):
    show = lambda d: S.location_text(F.lit("台中市"), F.lit("中區"), F.lit("中山路"), F.lit("x"), F.lit(d).cast("double"))
    row = spark.range(1).select(show(10.0).alias("a"), show(80.0).alias("b"), show(None).alias("c")).first()
    assert tuple(row) == ("x", "台中市中區 中山路 附近", "台中市中區 中山路 附近")


def test_places_at_one_spot_are_met_as_one(spark):
    places = spark.range(6000).selectExpr("10 + id as place_id", "24.0D + (id % 2) / 1000.0D as lat", "120.0D as lon")
    asked = spark.createDataFrame([(1, 24.0, 120.004), (2, 24.0012, 120.0), (3, 24.02, 120.0), (4, 25.0, 120.0)], "id long, lat double, lon double")
    found = S.nearest_point(asked, places)
    assert {r["id"]: (r["place_id"], r["candidates"]) for r in found.collect()} == {1: (10, 6000), 2: (11, 3000), 3: (11, 6000)}
    # The places reach the join summed up by spot.
    assert "Aggregate [lat" in found._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("snap_m", [0.0, 500.0])
def test_texts_of_addresses_stay_where_they_are(spark, snap_m):
    areas = spark.createDataFrame([(1, 8, "甲鎮", "乙縣")], "area_id int, level int, name string, county string")
    ring = [(120.0, 24.0), (120.1, 24.0), (120.1, 24.1), (120.0, 24.1), (120.0, 24.0)]
    area_edges = spark.createDataFrame([(1, *a, *b) for a, b in zip(ring, ring[1:], strict=False)], "area_id int, x1 double, y1 double, x2 double, y2 double")
    roads = spark.createDataFrame([(1, "中山路", "primary")], "line_id int, name string, highway string")
    road_edges = spark.createDataFrame([(1, 120.0, 24.05, 120.1, 24.05)], "line_id int, x1 double, y1 double, x2 double, y2 double")
    places = spark.range(1000).selectExpr("id as place_id", "24.0D + (id % 10) / 100.0D as lat", "120.05D as lon", "concat(id, '號') as display_name")
    points = spark.createDataFrame([(1, 24.0501, 120.05), (2, 24.06, 120.0502), (3, 24.2, 120.2)], "id long, lat double, lon double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = S.reverse_geocode(points, areas, area_edges, roads, road_edges, places, snap_m)
        assert {r["id"]: (r["town"], r["address"], r["shown"]) for r in found.collect()} == {1: ("甲鎮", "5號", "5號"), 2: ("甲鎮", "6號", "6號"), 3: (None, None, "  附近")}
        # The found addresses are sent to the table of places, not the places by id to them.
        assert "BroadcastHashJoin [place_id" in found._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_points_are_not_multiplied_near_lines_and_areas(spark):
    edges = [(1, 120.0, 24.0, 120.03, 24.0), (2, 120.3, 24.02, 120.3, 24.3)]
    points = [(i, 24.0 + y * step, 120.0 + x * step) for i, (step, x, y) in enumerate((s, x, y) for s in (0.01, 0.007) for x in range(-4, 35) for y in range(-4, 6))]
    asked, lines = spark.createDataFrame(points, "id long, lat double, lon double"), spark.createDataFrame(edges, "line_id int, x1 double, y1 double, x2 double, y2 double")
    near = lambda p, e, r: min(e[2], e[4]) <= p[1] + r and max(e[2], e[4]) >= p[1] - r and min(e[1], e[3]) <= p[2] + r and max(e[1], e[3]) >= p[2] - r
    for radius in (0.01, 0.007, 0.03):
        found = S.nearest_line(asked, lines, radius=radius)
        assert {r["id"] for r in found.collect()} == {p[0] for p in points if any(near(p, e, radius) for e in edges)}
    snapped = S.snapped_area(asked, lines.withColumnRenamed("line_id", "area_id"), 1500.0)
    # Cells of edges are listed, those of points are not.
    assert optimized(found).count("Generate explode") == optimized(snapped).count("Generate explode") == 2


def test_areas_of_points_are_met_once(spark, monkeypatch):
    monkeypatch.setattr(S, "LISTED", 2)
    square = lambda i, x, n: [(i, x, 24.0, x + n, 24.0), (i, x + n, 24.0, x + n, 24.1), (i, x + n, 24.1, x, 24.1), (i, x, 24.1, x, 24.0)]
    areas = spark.createDataFrame([(1, 8, "甲鎮", None), (2, 7, "乙區", "丙縣"), (3, 4, "丁縣", None)], "area_id int, level int, name string, county string")
    area_edges = spark.createDataFrame(square(1, 120.0, 0.1) + square(2, 120.05, 0.1) + square(3, 120.0, 0.3), "area_id int, x1 double, y1 double, x2 double, y2 double")
    roads = spark.createDataFrame([(1, "中山路", "primary")], "line_id int, name string, highway string")
    road_edges = spark.createDataFrame([(1, 120.0, 24.05, 120.1, 24.05)], "line_id int, x1 double, y1 double, x2 double, y2 double")
    places = spark.range(1000).selectExpr("id as place_id", "24.0D + (id % 10) / 100.0D as lat", "120.05D as lon", "nullif(concat(id, '號'), '6號') as display_name")
    points = spark.createDataFrame([(1, 24.0501, 120.05), (2, 24.06, 120.1), (3, 24.06, 120.12), (4, 24.06, 120.151), (5, 24.06, 120.2), (6, 24.0601, 120.0501), (7, 24.06, 121.0)], "id long, lat double, lon double")
    towns = {1: ("甲鎮", "丁縣", False, "5號"), 2: ("甲鎮", "丁縣", False, None), 3: ("乙區", "丙縣", False, None), 4: ("乙區", "丁縣", True, None), 5: (None, "丁縣", False, None), 6: ("甲鎮", "丁縣", False, None), 7: (None, None, False, None)}
    found = S.reverse_geocode(points, areas, area_edges, roads, road_edges, places, 500.0)
    assert {r["id"]: (r["town"], r["county"], r["approx"], r["address"]) for r in found.collect()} == towns
    plain = S.reverse_geocode(points, areas, area_edges, roads, road_edges, places)
    assert {r["id"]: r["town"] for r in plain.collect()} == {i: None if i == 4 else t[0] for i, t in towns.items()}
    # Areas are met once for all points, and once more to know which are snapped (three lists of cells each).
    lists = [optimized(S.reverse_geocode(points, areas, area_edges, roads, road_edges, None, m, with_addresses=False)).count("Generate explode") for m in (0.0, 500.0)]
    assert lists == [3 + 2, 3 + 3 + 2 + 2]
    # More points than are sent to all tasks: texts are summed up by spot before they are dealt.
    assert "min_by(display_name" in optimized(found)

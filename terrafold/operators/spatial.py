"""Spatial joins on grid cells: containing areas, nearest lines and points, reverse geocoding.

A join by distance or containment becomes an equi-join on cells and a residual test, so it shuffles
by cell and never compares all with all. Geometry is a table of edges: every segment of every ring
or line, with the latitude band(s) it lies in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.functions import geo as G
from terrafold.operators.ingest import LISTED

#: Degrees of a cell for areas; the other joins take cells of their search radius.
AREA_CELL = 0.05
#: Degrees of the search for lines, and of the steps of the search for points.
ROAD_RADIUS, POINT_RADII = 0.01, (0.001, 0.005, 0.025)
# Fixed value: metres up to which an address is shown itself.
SHOW_WITHIN_M = 50.0


def banded(edges: DataFrame, size: float = AREA_CELL) -> DataFrame:
    """Edges (x1, y1, x2, y2: longitudes and latitudes) once for each latitude band they cross."""
    return edges.withColumn("band", F.explode(G.cells(F.least("y1", "y2"), F.greatest("y1", "y2"), size)))


def _boxes(edges: DataFrame, key: str) -> DataFrame:
    return edges.groupBy(key).agg(
        F.min(F.least("y1", "y2")).alias("min_lat"), F.max(F.greatest("y1", "y2")).alias("max_lat"),
        F.min(F.least("x1", "x2")).alias("min_lon"), F.max(F.greatest("x1", "x2")).alias("max_lon"),
    )


def box_candidates(points: DataFrame, boxes: DataFrame, point_id: str, area_id: str, size: float = AREA_CELL) -> DataFrame:
    """(point_id, lat, lon, area_id): points inside the boxes (min_lat, max_lat, min_lon, max_lon) of areas."""
    left = points.select(point_id, "lat", "lon", G.cell("lat", size).alias("cy"), G.cell("lon", size).alias("cx"))
    right = boxes.withColumn("cy", F.explode(G.cells("min_lat", "max_lat", size))).withColumn("cx", F.explode(G.cells("min_lon", "max_lon", size)))
    inside = G.in_box("lat", "lon", "min_lat", "max_lat", "min_lon", "max_lon")
    return left.join(right, ["cy", "cx"]).where(inside).select(point_id, "lat", "lon", area_id)


def covering(points: DataFrame, edges: DataFrame, point_id: str = "id", area_id: str = "area_id", size: float = AREA_CELL) -> DataFrame:
    """(point_id, area_id): areas that cover a point, boundary included.

    Even-odd over all rings of an area, so holes and further parts need no mark of their own; a
    point on any ring is covered. Only edges in the point's latitude band are compared.
    """
    near = box_candidates(points, _boxes(edges, area_id), point_id, area_id, size).withColumn("band", G.cell("lat", size))
    met = near.join(banded(edges, size), [area_id, "band"])
    ends = ("lon", "lat", "x1", "y1", "x2", "y2")
    tested = met.groupBy(point_id, area_id).agg(
        F.sum(F.coalesce(G.ray_crosses(*ends), F.lit(False)).cast("int")).alias("crossings"), F.max(G.on_edge(*ends)).alias("touches")
    )
    return tested.where((F.col("crossings") % 2 == 1) | F.col("touches")).select(point_id, area_id)


def containing_area(points: DataFrame, areas: DataFrame, edges: DataFrame, point_id: str = "id", levels: tuple[int, ...] = (8, 7)) -> DataFrame:
    """(point_id, area_id, level, county, name): the area of each point, the first level that has one
    first, the lowest area id of those that share a boundary. ``areas``: area_id, level, name, county.

    A county that the area doesn't carry comes from the level-4 area that covers the point.
    """
    found = _own_and_county(points, areas, edges, point_id, levels).where("own is not null")
    return found.select(point_id, "own.area_id", "own.level", F.coalesce("own.county", "county_4").alias("county"), "own.name")


def _own_and_county(points: DataFrame, areas: DataFrame, edges: DataFrame, point_id: str, levels: tuple[int, ...] = (8, 7)) -> DataFrame:
    """(point_id, own, county_4): of each covered point the area that ``containing_area`` describes, null
    without one, and the name of its level-4 area (the lowest id of several), from one covering join."""
    order = F.lit(len(levels))
    for i, level in enumerate(levels):
        order = F.when(F.col("level") == level, i).otherwise(order)
    own = F.when(F.col("level").isin(*levels), F.struct(order.alias("order"), "area_id", "level", "county", "name"))
    county = [F.when(F.col("level") == 4, F.col(x)) for x in ("name", "area_id")]
    hits = covering(points, edges, point_id).join(areas, "area_id")
    return hits.groupBy(point_id).agg(F.min(own).alias("own"), F.min_by(*county).alias("county_4"))


def outside(points: DataFrame, areas: DataFrame, edges: DataFrame, names: list[str], point_id: str = "id") -> DataFrame:
    """``points`` that no area with one of the names covers."""
    chosen = areas.where(F.col("name").isin(*names)).select("area_id")
    inside = covering(points, edges.join(chosen, "area_id", "left_semi"), point_id)
    return points.join(inside.select(point_id).distinct(), point_id, "left_anti")


def _near_boxes(points: DataFrame, boxes: DataFrame, point_id: str, box: tuple[Column, Column, Column, Column], radius: float) -> DataFrame:
    """(point_id, lat, lon, ``boxes``): pairs of points and boxes (south, north, west, east) within a radius in degrees.

    Boxes are dealt to all cells within the radius, points to their own, so that a pair meets once and
    the points, which are the many, are not multiplied. The residual test decides; cells reach a little
    further, as it rounds otherwise.
    """
    south, north, west, east = box
    reach = radius * (1 + 1e-6)
    left = points.select(point_id, "lat", "lon", G.cell("lat", radius).alias("cy"), G.cell("lon", radius).alias("cx"))
    right = boxes.withColumn("cy", F.explode(G.cells(south - reach, north + reach, radius))).withColumn("cx", F.explode(G.cells(west - reach, east + reach, radius)))
    meets = G.boxes_overlap(*box, F.col("lat") - radius, F.col("lat") + radius, F.col("lon") - radius, F.col("lon") + radius)
    return left.join(right, ["cy", "cx"]).where(meets).drop("cy", "cx")


def nearest_line(points: DataFrame, edges: DataFrame, point_id: str = "id", line_id: str = "line_id", radius: float = ROAD_RADIUS) -> DataFrame:
    """(point_id, line_id, distance_m): the nearest line of those whose box meets the search window.

    For each line its nearest place is the one nearest in degrees; lines are then compared by the
    metres to that place (the lowest id of equals).
    """
    box = tuple(map(F.col, ("min_lat", "max_lat", "min_lon", "max_lon")))
    pairs = _near_boxes(points, _boxes(edges, line_id), point_id, box, radius).select(point_id, "lat", "lon", line_id)
    qx, qy = G.nearest_on_segment("lon", "lat", "x1", "y1", "x2", "y2")
    each = pairs.join(edges, line_id).withColumn("qx", qx).withColumn("qy", qy)
    planar = F.pow(F.col("lon") - F.col("qx"), 2) + F.pow(F.col("lat") - F.col("qy"), 2)
    place = F.min_by(F.struct("qx", "qy"), F.struct(planar, F.col("qx"), F.col("qy"))).alias("q")
    lines = each.groupBy(point_id, "lat", "lon", line_id).agg(place).withColumn("distance_m", G.haversine_m("lat", "lon", "q.qy", "q.qx"))
    best = F.min(F.struct("distance_m", line_id)).alias("b")
    return lines.groupBy(point_id).agg(best).select(point_id, F.col(f"b.{line_id}").alias(line_id), F.col("b.distance_m").alias("distance_m"))


def snapped_area(points: DataFrame, edges: DataFrame, tolerance_m: float, point_id: str = "id", area_id: str = "area_id") -> DataFrame:
    """(point_id, area_id, distance_m): the area whose boundary is nearest, within a tolerance.

    Areas count whose box meets the window of the tolerance in degrees of latitude. Edges are looked
    up twice as far, as degrees of longitude are shorter (up to 60 degrees from the equator).
    """
    radius = tolerance_m / G.METRES_PER_DEGREE
    window = (F.col("lat") - radius, F.col("lat") + radius, F.col("lon") - radius, F.col("lon") + radius)
    box = (F.least("y1", "y2"), F.greatest("y1", "y2"), F.least("x1", "x2"), F.greatest("x1", "x2"))
    near = _near_boxes(points, edges, point_id, box, 2 * radius).join(_boxes(edges, area_id), area_id)
    near = near.where(G.boxes_overlap("min_lat", "max_lat", "min_lon", "max_lon", *window))
    qx, qy = G.nearest_on_segment("lon", "lat", "x1", "y1", "x2", "y2")
    each = near.withColumn("qx", qx).withColumn("qy", qy)
    planar = F.pow(F.col("lon") - F.col("qx"), 2) + F.pow(F.col("lat") - F.col("qy"), 2)
    place = F.min_by(F.struct("qx", "qy"), F.struct(planar, F.col("qx"), F.col("qy"))).alias("q")
    areas = each.groupBy(point_id, "lat", "lon", area_id).agg(place).withColumn("distance_m", G.haversine_m("lat", "lon", "q.qy", "q.qx"))
    kept = areas.where(F.col("distance_m") <= tolerance_m)
    return kept.groupBy(point_id).agg(F.min(F.struct("distance_m", area_id)).alias("b")).select(point_id, F.col(f"b.{area_id}").alias(area_id), F.col("b.distance_m").alias("distance_m"))


def nearest_point(queries: DataFrame, places: DataFrame, query_id: str = "id", place_id: str = "place_id", radii: tuple[float, ...] = POINT_RADII, same: str | None = None) -> DataFrame:
    """(query_id, place_id, distance_m, candidates): the nearest place in the first window that has any.

    The window is a square of degrees, widened step by step; ties go to the lowest place id.
    ``same`` names a column that query and place must share (such as the township). Each step only
    takes queries that no step before has answered.

    Places at one spot are as far from any query, so they are met as one: the lowest of their ids, and
    how many they are. The first steps share cells, so that spots are dealt by them once.
    """
    spots = places.groupBy("lat", "lon", *([same] if same else [])).agg(F.min(place_id).alias(place_id), F.count("*").alias("there"))
    out, open_ = None, queries
    for radius in radii:
        size = max(radius, *radii[:2])
        left = open_.select(query_id, F.col("lat").alias("q_lat"), F.col("lon").alias("q_lon"), *([same] if same else []))
        left = left.withColumn("cy", F.explode(G.cells(F.col("q_lat") - radius, F.col("q_lat") + radius, size)))
        left = left.withColumn("cx", F.explode(G.cells(F.col("q_lon") - radius, F.col("q_lon") + radius, size)))
        right = spots.select(place_id, "there", "lat", "lon", G.cell("lat", size).alias("cy"), G.cell("lon", size).alias("cx"), *([same] if same else []))
        near = left.join(right, ["cy", "cx", *([same] if same else [])])
        near = near.where((F.abs(F.col("lat") - F.col("q_lat")) <= radius) & (F.abs(F.col("lon") - F.col("q_lon")) <= radius))
        near = near.withColumn("distance_m", G.haversine_m("q_lat", "q_lon", "lat", "lon"))
        best = near.groupBy(query_id).agg(F.min(F.struct("distance_m", place_id)).alias("b"), F.sum("there").alias("candidates"))
        # The test keeps both sums in every use of this step, so that its exchange is made once.
        found = best.where("b is not null and candidates > 0").select(query_id, F.col(f"b.{place_id}").alias(place_id), F.col("b.distance_m").alias("distance_m"), "candidates")
        out = found if out is None else out.unionByName(found)
        open_ = open_.join(found.select(query_id), query_id, "left_anti")
    return out


# The text after the name of a road.
NEARBY = " 附近"


def location_text(county: Column, town: Column, road: Column, address: Column, distance_m: Column) -> Column:
    """What is shown of a place: an address within reach, else the road (or the area) and 附近."""
    near = F.concat(F.coalesce(county, F.lit("")), F.coalesce(town, F.lit("")), F.lit(" "), F.coalesce(road, F.lit("")), F.lit(NEARBY))
    return F.when(distance_m < SHOW_WITHIN_M, address).otherwise(near)


def reverse_geocode(points: DataFrame, areas: DataFrame, area_edges: DataFrame, roads: DataFrame, road_edges: DataFrame, places: DataFrame, snap_m: float = 0.0, with_addresses: bool = True) -> DataFrame:
    """For each point (id, lat, lon): area, nearest road, nearest address, and the text to show.

    ``roads``: line_id, name, highway; ``places``: place_id, lat, lon, display_name. A point in no
    township takes the nearest one within ``snap_m`` (approx is then true); its county is the one
    that covers it, else the township's.
    """
    out = points.select("id", "lat", "lon").join(_own_and_county(points, areas, area_edges, "id"), "id", "left")
    county, town, approx = F.coalesce("own.county", "county_4"), F.col("own.name"), F.lit(False)
    if snap_m > 0:
        towns = areas.where(F.col("level").isin(7, 8)).select("area_id", F.col("county").alias("snapped_county"), F.col("name").alias("snapped"))
        near = snapped_area(out.where("own is null"), area_edges.join(towns.select("area_id"), "area_id", "left_semi"), snap_m).join(towns, "area_id")
        out = out.join(near.select("id", "snapped_county", "snapped"), "id", "left")
        county, town, approx = F.coalesce(county, "snapped_county"), F.coalesce(town, "snapped"), F.col("snapped").isNotNull()
    out = out.select("id", "lat", "lon", county.alias("county"), town.alias("town"), approx.alias("approx"))
    road = nearest_line(points, road_edges).join(roads, "line_id").select("id", F.col("name").alias("road"), "highway", F.col("distance_m").alias("road_m"))
    out = out.join(road, "id", "left")
    if with_addresses:
        found, texts = nearest_point(points, places), places.select("place_id", "display_name")
        # A point has one address at most, so counted points bound the rows that are sent to all tasks.
        # Of more points, texts are dealt once for each spot: only its lowest id can be found.
        if points.limit(LISTED + 1).count() <= LISTED:
            found = F.broadcast(found)
        else:
            texts = places.groupBy("lat", "lon").agg(F.min("place_id").alias("place_id"), F.min_by("display_name", "place_id").alias("display_name"))
        address = texts.join(found, "place_id")
        out = out.join(address.select("id", F.col("display_name").alias("address"), F.col("distance_m").alias("address_m")), "id", "left")
    else:
        out = out.withColumn("address", F.lit(None).cast("string")).withColumn("address_m", F.lit(None).cast("double"))
    return out.withColumn("shown", location_text(F.col("county"), F.col("town"), F.col("road"), F.col("address"), F.col("address_m")))

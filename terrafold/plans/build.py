"""Whole builds: a county's addresses, the area, road and landmark layers, and their release."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.functions import geo as G
from terrafold.functions import text as T
from terrafold.operators import ingest as I
from terrafold.operators import reduction as R
from terrafold.operators import spatial as S
from terrafold.sources import osm, wkb
from terrafold.sources.delimited import read_mapped

# Roads and landmarks that the layers hold.
HIGHWAYS = ("motorway", "trunk", "primary", "secondary", "tertiary", "residential", "unclassified", "service", "living_street")
LANDMARKS = ("city", "town", "village", "hamlet", "suburb", "neighbourhood")


def county(spark: SparkSession, config: dict, codes: DataFrame, bad: DataFrame | None = None) -> dict[str, DataFrame]:
    """Ingest and both reductions of a county: places, rejects and the audits. Nothing is written;
    the caller decides (a dry run looks at the audits only)."""
    raw = read_mapped(spark, config["path"], config["columns"], config.get("encoding", "utf-8"))
    rows, rejects = I.ingest(raw, codes, bad, grid=config.get("crs") == "EPSG:3826")
    flags = R.floor_flags(rows)
    stage1 = R.consolidate_floors(rows, flags)
    return {
        "rejects": rejects,
        "ingested": rows,
        "floor_removals": R.floor_removals(rows, flags),
        "floor_syntheses": R.floor_syntheses(rows, flags),
        "floor_summary": R.floor_summary(rows, flags),
        "duplicate_removals": R.duplicate_removals(stage1),
        "places": R.collapse_duplicates(stage1),
    }


def counties(parts: dict[str, DataFrame]) -> DataFrame:
    """All counties' places as one table."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn("county_id", F.lit(name)) for name, df in parts.items()])


#: Degrees of the cells by which stored places lie together.
STORED_CELL = 0.02


def clustered(places: DataFrame) -> DataFrame:
    """Places near each other in the same files and row groups: ranges of source, county and cell, in
    that order. What a row group says of its lat and lon then lets a search skip it."""
    order = ["source", "county", G.cell("lat", STORED_CELL), G.cell("lon", STORED_CELL)]
    return places.repartitionByRange(*order).sortWithinPartitions(*order, "id")


def write_places(places: DataFrame, path: str) -> None:
    """Places by source and county, so that a search of a county reads that county, and by cell."""
    clustered(places).write.mode("overwrite").partitionBy("source", "county").parquet(path)


def around(places: DataFrame, lat: float, lon: float, reach: float = S.POINT_RADII[-1]) -> DataFrame:
    """The stored places in a window of degrees: a filter that the scan gets."""
    return places.where(F.col("lat").between(lat - reach, lat + reach) & F.col("lon").between(lon - reach, lon + reach))


def route(places: DataFrame, county_name: str | None, covered: tuple[str, ...]) -> DataFrame:
    """The places that answer for a county: its own source, or the map's where it isn't covered."""
    if county_name in covered:
        return places.where((F.col("source") == "tgos") & (F.col("county") == county_name))
    return places.where(F.col("source") == "osm")


def townships(counties_: DataFrame, towns: DataFrame, detached: DataFrame | None = None, box: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """(areas, edges) of boundary shapes (attributes map<string,string>, geometry_wkb).

    Counties are level 4, districts of the special municipalities 7, other townships 8. Names are
    stripped and in usual glyphs. Shapes without geometry, or outside the box, are left out.
    """
    a = lambda k: T.strip_space(T.usual_glyphs(F.try_element_at("attributes", F.lit(k))))
    levels = [counties_.select(F.lit(4).alias("level"), a("COUNTYCODE").alias("code"), a("COUNTYNAME").alias("name"), a("COUNTYENG").alias("name_en"), F.lit(None).cast("string").alias("county"), "geometry_wkb")]
    for part in [towns] + ([detached] if detached is not None else []):
        own = a("COUNTYNAME")
        levels.append(part.select(T.admin_level(own).alias("level"), a("TOWNCODE").alias("code"), a("TOWNNAME").alias("name"), a("TOWNENG").alias("name_en"), own.alias("county"), "geometry_wkb"))
    whole = I.with_ids(reduce(DataFrame.unionByName, levels).where("geometry_wkb is not null"), name="area_id")
    lines = wkb.edges(whole, "area_id")
    areas = whole.join(wkb.bounds(lines, "area_id"), "area_id")
    if box:
        areas = areas.where(G.boxes_overlap("min_lat", "max_lat", "min_lon", "max_lon", box["south"], box["north"], box["west"], box["east"]))
        lines = lines.join(areas.select("area_id"), "area_id", "left_semi")
    return areas, lines


def roads(objects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(roads, edges): named ways of the listed kinds that have two or more known nodes."""
    name = T.usual_glyphs(T.tag_name("tags"))
    kind = F.try_element_at("tags", F.lit("highway"))
    ways = objects.where("kind = 'way'").where(kind.isin(*HIGHWAYS) & name.isNotNull())
    points = osm.way_points(objects.where("kind = 'node'").unionByName(ways))
    edges = osm.way_edges(points)
    named = ways.select(F.col("id").alias("line_id"), name.alias("name"), F.try_element_at("tags", F.lit("name:en")).alias("name_en"), kind.alias("highway"))
    return named.join(edges.select("line_id").distinct(), "line_id", "left_semi"), edges


def map_places(objects: DataFrame, areas: DataFrame, area_edges: DataFrame, covered: tuple[str, ...]) -> DataFrame:
    """Landmarks everywhere, and addresses outside the covered counties. A landmark's node is no
    address; a landmark without a name is nothing at all."""
    nodes = objects.where("kind = 'node'")
    place = F.try_element_at("tags", F.lit("place"))
    is_landmark = F.coalesce(place.isin(*LANDMARKS), F.lit(False))
    name = T.usual_glyphs(T.tag_name("tags"))
    text, none = "string", F.lit(None)
    landmarks = nodes.where(is_landmark & name.isNotNull()).select(
        F.lit("osm").alias("source"), F.col("id").alias("osm_id"), "lat", "lon", name.alias("name"), name.alias("display_name"), name.alias("display_name_halfwidth"),
        none.cast(text).alias("county"), none.cast(text).alias("township"), none.cast(text).alias("street"), none.cast(text).alias("number"), place.alias("place_type"),
    )
    numbered = nodes.where(~is_landmark & (T.blank(F.try_element_at("tags", F.lit("addr:housenumber"))) != ""))
    free = S.outside(numbered, areas.where("level = 4"), area_edges, list(covered))
    made = free.withColumn("a", T.map_address("tags"))
    addresses = made.select(
        F.lit("osm").alias("source"), F.col("id").alias("osm_id"), "lat", "lon", "a.name", "a.display_name", "a.display_name_halfwidth",
        "a.county", "a.township", "a.street", "a.number", none.cast(text).alias("place_type"),
    )
    return I.numbered(landmarks.unionByName(addresses), "osm_id")

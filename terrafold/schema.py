"""Schemas of the artifacts."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _D = T.StringType(), T.LongType(), T.DoubleType()


def _struct(required: dict, optional: dict) -> T.StructType:
    return T.StructType([T.StructField(k, v, False) for k, v in required.items()] + [T.StructField(k, v, True) for k, v in optional.items()])


PLACES = _struct(
    {"id": _L, "source": _S, "lat": _D, "lon": _D, "display_name": _S, "display_name_halfwidth": _S},
    {"osm_id": _L, "district_code": _S, "county": _S, "township": _S, "village": _S, "neighbor": _S, "street": _S, "area": _S, "lane": _S, "alley": _S, "number": _S, "name": _S, "place_type": _S},
)
TOWNSHIPS = _struct({"id": _L, "admin_level": T.IntegerType(), "name_zh": _S, "geometry_wkb": T.BinaryType(), "min_lat": _D, "max_lat": _D, "min_lon": _D, "max_lon": _D}, {"moi_code": _S, "name_en": _S, "county_zh": _S})
ROADS = _struct({"id": _L, "osm_id": _L, "name_zh": _S, "highway": _S, "geometry_wkb": T.BinaryType(), "min_lat": _D, "max_lat": _D, "min_lon": _D, "max_lon": _D}, {"name_en": _S})
METADATA = _struct({"artifact": _S, "key": _S}, {"value": _S})

"""The address and geometry functions by name in SQL, as SQL-defined functions: the optimizer sees
their bodies, so they cost what the expressions cost."""

from __future__ import annotations

from pyspark.sql import SparkSession

from terrafold.functions import geo as G
from terrafold.functions import text as T

_HALF = f"translate(s, '{T.FULL_WIDTH}', '{T.HALF_WIDTH}')"
_AT = f"instr(coalesce(s, ''), '{T.NUMBER_MARK}')"
_FLOOR = f"({_AT} > 0 AND greatest(instr(coalesce(s, ''), '{T.FLOOR_MARK}'), instr(coalesce(s, ''), '{T.LAYER_MARK}')) > {_AT})"

#: name: (parameters, type, body).
FUNCTIONS = {
    "half_width": ("s STRING", "STRING", _HALF),
    "hyphen_number": ("s STRING", "STRING", f"replace({_HALF}, '{T.SUB_MARK}', '-')"),
    "usual_glyphs": ("s STRING", "STRING", f"translate(s, '{T.GLYPH_FROM}', '{T.GLYPH_TO}')"),
    "is_floor": ("s STRING", "BOOLEAN", _FLOOR),
    "base_number": ("s STRING", "STRING", f"CASE WHEN {_FLOOR} THEN substring(s, 1, {_AT}) ELSE s END"),
    "haversine_m": (
        "lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE", "DOUBLE",
        f"{2 * G.EARTH_RADIUS_M} * asin(sqrt(least(1D, pow(sin(radians(lat2 - lat1) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2))))",
    ),
    "grid_cell": ("v DOUBLE, size DOUBLE", "BIGINT", "floor(v / size)"),
}


def register(spark: SparkSession) -> None:
    for name, (parameters, kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")

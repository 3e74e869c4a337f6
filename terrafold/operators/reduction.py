"""The two-stage reduction of address points: floors to base addresses, then exact duplicates.

Both stages are windows over the same coordinates; synthesised rows take their base number as their
number, so one distribution by coordinate serves both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrafold.functions import text as T

#: A hash of the coordinate, by which rows are dealt once for both stages.
_DEALT = "_dealt"


def _has(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _head(df: DataFrame) -> Column:
    """Street; where it is null, the area; else nothing (as stored, blank isn't null)."""
    return F.coalesce(_has(df, "street"), _has(df, "area"), F.lit(""))


def place_key(df: DataFrame, number: str | Column) -> list[Column]:
    """What makes two rows the same address at the same point. The neighbourhood isn't part of it."""
    folded = [T.blank(_has(df, c)) for c in ("village", "lane", "alley")]
    dealt = [F.col(_DEALT)] if _DEALT in df.columns else []
    return [*dealt, F.col("lat"), F.col("lon"), T.blank(_has(df, "district_code")), folded[0], _head(df), *folded[1:], F.col(number) if isinstance(number, str) else number]


def floor_flags(places: DataFrame) -> DataFrame:
    """``places`` with is_floor, base_number, ground_count, lowest_ground_id, lowest_floor_id, kept_id,
    to_drop and to_synthesize (0 or 1).

    A floor row goes if its base address has a row without floor; else the lowest id of the floors
    stays, to be rewritten as the base address. Rows without floor all stay.
    """
    marked = places.withColumn("is_floor", T.is_floor("number").cast("int")).withColumn("base_number", T.base_number("number"))
    group = Window.partitionBy(*place_key(marked, "base_number"))
    ground, floor = F.col("is_floor") == 0, F.col("is_floor") == 1
    counted = marked.select(
        "*",
        F.sum(ground.cast("int")).over(group).cast("long").alias("ground_count"),
        F.min(F.when(ground, F.col("id"))).over(group).alias("lowest_ground_id"),
        F.min(F.when(floor, F.col("id"))).over(group).alias("lowest_floor_id"),
    )
    alone, first = F.col("ground_count") == 0, F.col("id") == F.col("lowest_floor_id")
    return counted.select(
        "*",
        F.coalesce("lowest_ground_id", "lowest_floor_id").alias("kept_id"),
        (floor & (~alone | ~first)).cast("int").alias("to_drop"),
        (floor & alone & first).cast("int").alias("to_synthesize"),
    )


_MADE = ("is_floor", "base_number", "ground_count", "lowest_ground_id", "lowest_floor_id", "kept_id", "to_drop", "to_synthesize")


def consolidate_floors(places: DataFrame, flags: DataFrame | None = None) -> DataFrame:
    """Stage 1: rows to drop are gone, rows to synthesise rewritten (number and, where there are
    such columns, the names)."""
    kept = (flags if flags is not None else floor_flags(places)).where("to_drop = 0")
    fresh = F.col("to_synthesize") == 1
    parts = [_has(places, c) for c in ("county", "township", "village", "street", "area", "lane", "alley")]
    made = T.synthesised(*parts, F.col("base_number"))
    out = {c: F.when(fresh, made[c]).otherwise(F.col(c)) for c in ("number", "name", "display_name", "display_name_halfwidth") if c in places.columns}
    return kept.withColumns(out).select(*places.columns)


def floor_removals(places: DataFrame, flags: DataFrame | None = None) -> DataFrame:
    """The audit of stage 1: what is removed, for which row, and why."""
    marked = flags if flags is not None else floor_flags(places)
    group = Window.partitionBy(*place_key(marked, "base_number"))
    named = marked.withColumn("kept_display_name", F.min(F.when(F.col("id") == F.col("kept_id"), _has(marked, "display_name"))).over(group))
    why = F.when(F.col("ground_count") > 0, "matched-existing-base").otherwise("merged-floor-variants")
    return named.where("to_drop = 1").select(F.col("id").alias("removed_id"), "lat", "lon", "number", "base_number", _has(marked, "display_name").alias("display_name"), "kept_id", "kept_display_name", why.alias("reason"))


def floor_syntheses(places: DataFrame, flags: DataFrame | None = None) -> DataFrame:
    """The audit of stage 1: rows rewritten into base addresses."""
    marked = (flags if flags is not None else floor_flags(places)).where("to_synthesize = 1")
    parts = [_has(marked, c) for c in ("county", "township", "village", "street", "area", "lane", "alley")]
    return marked.select(
        F.col("id").alias("kept_id"), "lat", "lon", F.col("number").alias("original_number"), "base_number",
        _has(marked, "display_name").alias("original_display_name"), T.display_name(*parts, F.col("base_number")).alias("new_display_name"),
    )


def floor_summary(places: DataFrame, flags: DataFrame | None = None) -> DataFrame:
    """One row: total, to_drop, to_synthesize, and rows with a floor mark that isn't a floor."""
    marked = flags if flags is not None else floor_flags(places)
    odd = (F.col("is_floor") == 0) & T.has_marks("number")
    total = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0)).cast("long")
    return marked.agg(F.count("*").alias("total_rows"), total(F.col("to_drop")).alias("to_drop"), total(F.col("to_synthesize")).alias("to_synthesize"), total(odd).alias("ambiguous_markers"))


def duplicate_ranks(places: DataFrame) -> DataFrame:
    """``places`` with rn (by id, within the same address at the same point), group_size and kept_id."""
    group = Window.partitionBy(*place_key(places, "number"))
    return places.select(
        "*",
        F.row_number().over(group.orderBy("id")).alias("rn"),
        F.count("*").over(group).alias("group_size"),
        F.min("id").over(group).alias("kept_id"),
    )


def collapse_duplicates(places: DataFrame) -> DataFrame:
    """Stage 2: the lowest id of each address and point stays."""
    return duplicate_ranks(places).where("rn = 1").select(*places.columns)


def duplicate_removals(places: DataFrame) -> DataFrame:
    """The audit of stage 2: what is removed and for which row."""
    ranked = duplicate_ranks(places)
    group = Window.partitionBy(*place_key(ranked, "number"))
    named = ranked.withColumn("kept_display_name", F.min(F.when(F.col("rn") == 1, _has(ranked, "display_name"))).over(group))
    return named.where("rn > 1").select(F.col("id").alias("removed_id"), "lat", "lon", "number", _has(ranked, "display_name").alias("display_name"), "kept_id", "kept_display_name")


def duplicate_summary(places: DataFrame) -> DataFrame:
    ranked = duplicate_ranks(places)
    return ranked.agg(F.count("*").alias("total_rows"), F.coalesce(F.sum((F.col("rn") > 1).cast("long")), F.lit(0)).cast("long").alias("removed"))


def reduce_addresses(places: DataFrame) -> DataFrame:
    """Both stages over one distribution by coordinate: the keys of both windows have its hash (of
    the doubles themselves they would have a normalised form, and be dealt again)."""
    dealt = places.withColumn(_DEALT, F.xxhash64(F.col("lat") + 0.0, F.col("lon") + 0.0)).repartition(_DEALT)
    return collapse_duplicates(consolidate_floors(dealt)).select(*places.columns)

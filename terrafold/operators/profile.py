"""Profiles of coordinates that several rows share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrafold.functions import text as T
from terrafold.operators.reduction import place_key

# Bounds and labels of the histogram.
BUCKETS = ((2, "2"), (5, "3-5"), (10, "6-10"), (50, "11-50"), (200, "51-200"), (None, "200+"))
_XY = ("lat", "lon")


def duplicate_groups(places: DataFrame, keys: tuple[str, ...] = _XY) -> DataFrame:
    """(keys, c, floor_c): coordinates of more than one row, and how many of these are floors."""
    floors = F.sum(T.is_floor("number").cast("long")) if "number" in places.columns else F.lit(0).cast("long")
    return places.groupBy(*keys).agg(F.count("*").alias("c"), floors.alias("floor_c")).where("c > 1")


def group_totals(places: DataFrame, keys: tuple[str, ...] = _XY) -> DataFrame:
    """One row: groups, rows in them, floors, rows beyond one of each group, and their share of all."""
    flagged = places.groupBy(*keys).agg(F.count("*").alias("c"), (F.sum(T.is_floor("number").cast("long")) if "number" in places.columns else F.lit(0).cast("long")).alias("f"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    many = F.col("c") > 1
    sums = flagged.agg(total(F.when(many, 1)).alias("groups"), total(F.when(many, F.col("c"))).alias("rows_in_groups"), total(F.when(many, F.col("f"))).alias("floor_rows"), total(F.col("c")).alias("total_rows"))
    redundant = (F.col("rows_in_groups") - F.col("groups")).alias("redundant")
    share = F.round(F.try_divide(F.lit(100.0) * (F.col("rows_in_groups") - F.col("groups")).cast("double"), F.col("total_rows").cast("double")), 4).alias("redundant_percent")
    return sums.select("*", redundant, share)


def bucket(n: str | Column) -> Column:
    c = F.col(n) if isinstance(n, str) else n
    out = F.lit(BUCKETS[-1][1])
    for bound, label in reversed(BUCKETS[:-1]):
        out = F.when(c <= bound, label).otherwise(out)
    return out


def _bucket_order(label: Column) -> Column:
    out = F.lit(len(BUCKETS))
    for i, (_, name) in enumerate(BUCKETS):
        out = F.when(label == name, i).otherwise(out)
    return out


def group_histogram(places: DataFrame, keys: tuple[str, ...] = _XY) -> DataFrame:
    """(bucket, groups, rows) by bucket; those without groups are left out."""
    sizes = duplicate_groups(places, keys).groupBy(bucket("c").alias("bucket")).agg(F.count("*").alias("groups"), F.sum("c").cast("long").alias("rows"))
    return sizes.orderBy(_bucket_order(F.col("bucket")))


def largest_groups(places: DataFrame, n: int = 10, keys: tuple[str, ...] = _XY) -> DataFrame:
    """The ``n`` largest groups (equal sizes by key)."""
    return duplicate_groups(places, keys).orderBy(F.desc("c"), *keys).limit(n)


def group_samples(places: DataFrame, n: int = 10, each: int = 3, keys: tuple[str, ...] = _XY) -> DataFrame:
    """Up to ``each`` rows, by id, of the largest groups."""
    top = largest_groups(places, n, keys)
    first = Window.partitionBy(*keys).orderBy("id")
    rows = places.join(top.select(*keys, "c"), list(keys)).withColumn("rn", F.row_number().over(first))
    return rows.where(F.col("rn") <= each)


def group_export(places: DataFrame, shown: str = "display_name", keys: tuple[str, ...] = _XY) -> DataFrame:
    """Each group with the name of its lowest id."""
    return places.groupBy(*keys).agg(F.count("*").alias("c"), F.min("id").alias("first_id"), F.min_by(shown, "id").alias("sample")).where("c > 1")


def shared_coordinates(places: DataFrame, keys: tuple[str, ...] = _XY) -> DataFrame:
    """All rows of coordinates that several rows share, with how many; one shuffle, no self-join."""
    return places.withColumn("address_count", F.count("*").over(Window.partitionBy(*keys))).where("address_count > 1")


def coordinate_counts(places: DataFrame, keys: tuple[str, ...] = _XY) -> DataFrame:
    """One row: rows, distinct coordinates, coordinates of several rows, and the most rows of one."""
    sizes = places.groupBy(*keys).agg(F.count("*").alias("c"))
    total = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return sizes.agg(total(F.sum("c")).alias("rows"), F.count("*").alias("unique_coordinates"), total(F.sum((F.col("c") > 1).cast("long"))).alias("shared_coordinates"), total(F.max("c")).alias("max_rows_per_coordinate"))


def duplicate_addresses(places: DataFrame) -> DataFrame:
    """One row: addresses (place and number) that occur more than once."""
    keys = [k.alias(f"k{i}") for i, k in enumerate(place_key(places, "number"))]
    return places.groupBy(*keys).agg(F.count("*").alias("c")).where("c > 1").agg(F.count("*").alias("duplicate_groups"))


def residual_floors(places: DataFrame) -> DataFrame:
    return places.agg(F.count_if(T.is_floor("number")).alias("floor_rows"))
